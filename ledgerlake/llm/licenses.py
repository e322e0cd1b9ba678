"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

A text matches a template if it holds at least CONTAINMENT of the template's five-word shingles,
wherever they are: words may be inserted at any place and in any number.

Templates are parted into classes of similar length. A text is cut into overlapping windows for each
class, so that every shingle lies whole in one. Window and template collide when one of b MinHash
values is equal. The template's least shingle under a hash function is any of its shingles with
equal probability; if the text has it, the windows around it collide unless a further shingle of the
window is less. So a matching text collides at one function with a probability of at least
least / (template + window), in shingles, however its shingles are spread; b follows from it, so that
a matching text is missed with a probability of at most MISS. Colliding pairs are kept if the whole
text holds CONTAINMENT. n_windows counts the colliding windows that hold as much by themselves, none
if a notice is spread out; first_word is where the first of these starts, else the fullest window.

Before any hashing, texts without an anchor word are put aside. A template's anchors are words that
together occur in more than 1 - CONTAINMENT of its shingles, so a text without one of them cannot
reach the containment. Windows are put aside if they have no cover word; a template's covers occur
in all of its shingles, together. Both filters lose nothing.

DataFrame functions only; the template table is a parameter and its join is broadcast while it is
small. Defined cases: null and empty texts match nothing; texts and templates under five words are
one shingle; rows that repeat an id and its text give their matches once; no templates, no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import doc_key, small, stored

CONTAINMENT = 0.8
MISS = 1e-4
SHINGLE = 5
WORDS = r"[^\p{L}\p{N}]+"

# Notices as their licenses publish them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted"
    ),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
}


def plain_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def shingles(words: list[str]) -> list[str]:
    k = min(SHINGLE, len(words))
    return list(dict.fromkeys(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))) if k else []


def anchors(words: list[str], share: float = 1 - CONTAINMENT) -> list[str]:
    """Longest words of a template until they touch more than a share of its shingles, or all of them."""
    made, chosen = [set(s.split()) for s in shingles(words)], []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        left = [s for s in made if not s & set(chosen)]
        if not left or len(made) - len(left) > share * len(made) + 1e-9:
            break
        if any(word in s for s in left):
            chosen.append(word)
    return chosen


def length_class(n: int) -> int:
    return max(3, math.ceil(math.log2(max(n, 1))))


class Plan:
    """Window, stride and bands of the templates of one length class."""

    def __init__(self, templates: dict[str, list[str]]):
        sizes = [len(w) for w in templates.values()]
        self.stride = max(1, min(sizes) // 2)
        self.window = max(sizes) + self.stride
        inside = max(1, self.window - SHINGLE + 1)
        made = [len(shingles(w)) for w in templates.values()]
        chance = min(0.999, *(max(1, math.ceil(CONTAINMENT * n)) / (inside + n) for n in made))
        self.bands = max(8, math.ceil(math.log(MISS) / math.log(1 - chance)))
        self.templates = templates
        self.anchors = sorted({a for w in templates.values() for a in anchors(w)})
        self.covers = sorted({a for w in templates.values() for a in anchors(w, 1)})


def shingle_hashes(words: Column) -> Column:
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.array_distinct(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, SHINGLE), " ")))
    )


def bands(hashes: Column, n: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda b: F.struct(b.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))).alias("value")),
    )


def license_matches(
    documents: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(k_id, k_text, license, containment, first_word, n_windows) of every document and license in it."""
    spark = documents.sparkSession
    known = {name: w for name, t in (TEMPLATES if templates is None else templates).items() if (w := plain_words(t))}
    classes: dict[int, dict[str, list[str]]] = {}
    for name, w in known.items():
        classes.setdefault(length_class(len(w)), {})[name] = w
    plans = [Plan(c) for c in classes.values()]
    schema = "k_id long, k_text long, license string, containment double, first_word int, n_windows long"
    if not plans:
        return spark.createDataFrame([], schema)
    every = sorted({a for p in plans for a in p.anchors})

    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    key_id, key_text = doc_key(id_col, text_col)
    docs = documents.select(key_id.cast("long").alias("k_id"), key_text, text.alias("text"))
    has_anchor = F.lit(False)
    for a in every:
        has_anchor = has_anchor | F.col("text").contains(a)
    docs = docs.where(has_anchor)
    docs = docs.select("k_id", "k_text", F.filter(F.split("text", WORDS), lambda w: w != "").alias("words"))
    docs = stored(docs, "licensed")

    hits = None
    for p in plans:
        listed = spark.createDataFrame([(n, w) for n, w in p.templates.items()], "license string, words array<string>")
        listed = listed.withColumn("wanted", shingle_hashes(F.col("words"))).drop("words")
        wanted = listed.select("license", "wanted", F.explode(bands(F.col("wanted"), p.bands)).alias("m")).select("license", "wanted", "m.*")
        starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(p.stride))
        windows = docs.select("k_id", "k_text", F.explode(F.filter(
            F.transform(starts, lambda s: F.struct(s.alias("first"), F.slice("words", s + 1, p.window).alias("w"))),
            lambda x: F.arrays_overlap(x["w"], F.array(*[F.lit(a) for a in p.covers])),
        )).alias("x"))
        windows = windows.select("k_id", "k_text", F.col("x.first").alias("first"), shingle_hashes(F.col("x.w")).alias("held"))
        signed = windows.select("k_id", "k_text", "first", "held", F.explode(bands(F.col("held"), p.bands)).alias("m"))
        signed = signed.select("k_id", "k_text", "first", "held", "m.*")
        rows = signed.join(small(wanted, len(p.templates) * p.bands, 64 + 8 * p.window), ["band", "value"])
        share = F.size(F.array_intersect("held", "wanted")) / F.size("wanted")
        rows = rows.select("k_id", "k_text", "license", "first", share.alias("share"))
        hits = rows if hits is None else hits.unionByName(rows)
    by_itself = F.col("share") >= CONTAINMENT
    found = stored(hits.distinct().groupBy("k_id", "k_text", "license").agg(
        F.coalesce(F.min(F.when(by_itself, F.col("first"))), F.min_by("first", F.struct(-F.col("share"), "first"))).alias("first_word"),
        F.count_if(by_itself).alias("n_windows"),
    ), "candidates")
    listed = spark.createDataFrame(list(known.items()), "license string, words array<string>")
    listed = listed.select("license", shingle_hashes(F.col("words")).alias("wanted"))
    row_bytes = 64 + 8 * max(map(len, known.values()))
    found = found.join(small(listed, len(known), row_bytes), "license")
    texts = found.groupBy("k_id", "k_text").agg(F.collect_list(F.struct("license", "wanted", "first_word", "n_windows")).alias("x"))
    texts = texts.select(F.col("k_id").alias("t_id"), F.col("k_text").alias("t_text"), "x")
    texts = small(texts, found.count(), row_bytes)
    same = F.col("k_id").eqNullSafe(F.col("t_id")) & (F.col("k_text") == F.col("t_text"))
    whole = docs.join(texts, same).select("k_id", "k_text", shingle_hashes(F.col("words")).alias("held"), "x")
    rows = whole.select("k_id", "k_text", "held", F.explode("x").alias("x")).select("k_id", "k_text", "held", "x.*")
    share = F.size(F.array_intersect("held", "wanted")) / F.size("wanted")
    rows = rows.select("k_id", "k_text", "license", share.alias("containment"), "first_word", "n_windows")
    return rows.where(F.col("containment") >= CONTAINMENT).dropDuplicates(["k_id", "k_text", "license"])


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    out = license_matches(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("k_id").alias("doc_id"), "license", "containment", "first_word", "n_windows")
