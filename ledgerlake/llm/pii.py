"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are what the fixed base patterns find: e-mail and IP addresses, card and phone numbers. Every
word with a digit is an instance; its context patterns are (word before, shape) and (shape, word
after). Seeds give their patterns a score per kind, patterns score their instances, and after
ROUNDS rounds over this graph the patterns with a score of CONFIDENCE and SUPPORT different seeds
add the instances that no base pattern finds, as ctx_<kind>.

Texts are read in one map; what is shuffled are hashes of instances and patterns, summed up per
task first. Defined cases: null and empty texts hold nothing; rows that repeat an id and its text
agree; in a table without seeds nothing is added. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import doc_key, small, stored

KINDS = ["email", "ip", "card", "phone"]
# The base patterns. Repetitions that cannot give characters back to a match are
# possessive, so that long runs take linear time and no deep stack; an address starts where the last
# match ended or a run of its letters begins, as no later place of a run can match where the first
# does not. The matches are the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without a match of this has no match that counts.
GUARDS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
CANDIDATE = r"(?<![^ \t\n\x0B\f\r])[^ \t\n\x0B\f\r0-9]*+[0-9][^ \t\n\x0B\f\r]*+"
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 5
SPAN = "array<struct<start:int,no:int,end:int,value:string>>"


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def running_sums(values: Column) -> Column:
    """Sum of the values before each position, in n**1.5 steps: blocks of about sqrt(n) are summed first."""

    def blocked(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))

        def add(a, b):
            return a + b

        def with_width(w: Column) -> Column:
            blocks = F.transform(
                F.sequence(F.lit(0), F.ceil(F.size(v) / w).cast("int")),
                lambda b: F.aggregate(F.slice(v, b * w + 1, w), F.lit(0), add),
            )

            def with_blocks(s: Column) -> Column:
                before = F.transform(s, lambda _, b: F.aggregate(F.slice(s, F.lit(1), b), F.lit(0), add))
                return let(
                    before,
                    lambda p: F.transform(
                        v,
                        lambda _, i: F.element_at(p, F.floor(i / w).cast("int") + 1)
                        + F.aggregate(F.slice(v, F.floor(i / w).cast("int") * w + 1, F.pmod(i, w)), F.lit(0), add),
                    ),
                )

            return let(blocks, with_blocks)

        return let(width, with_width)

    return let(values, blocked)


def found(text: Column, pattern: str) -> Column:
    """All leftmost matches as structs of start, end, value and the text before it since the last match."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def located(v: Column, b: Column) -> Column:
        sizes = F.zip_with(F.slice(b, F.lit(1), F.size(v)), v, lambda x, y: F.length(x) + F.length(y))
        parts = F.arrays_zip(running_sums(sizes).alias("at"), v.alias("v"), F.slice(b, F.lit(1), F.size(v)).alias("b"))
        return F.transform(
            parts,
            lambda p: F.struct(
                (p["at"] + F.length(p["b"])).alias("start"),
                (p["at"] + F.length(p["b"]) + F.length(p["v"])).alias("end"),
                p["v"].alias("value"),
                p["b"].alias("before"),
            ),
        )

    return let(values, lambda v: let(between, lambda b: located(v, b)))


def holds(kind: str, value: Column) -> Column:
    """The check that a base match has to pass."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        def small_part(part: Column) -> Column:
            plain = F.regexp_replace(part, "^0+", "")
            return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(value, r"\."), small_part)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid base spans by start, then by kind as listed: structs of start, kind number, end, value."""
    return F.array_sort(F.concat(*[_spans_of(text, no, kind) for no, kind in enumerate(KINDS)]))


def _spans_of(text: Column, no: int, kind: str) -> Column:
    valid = F.filter(found(text, PATTERNS[kind]), lambda m: holds(kind, m["value"]))
    spans = F.transform(
        valid,
        lambda m: F.struct(m["start"].alias("start"), F.lit(no).alias("no"), m["end"].alias("end"), m["value"].alias("value")),
    ).cast(SPAN)
    return F.when(text.rlike(GUARDS[kind]), spans).otherwise(F.array().cast(SPAN))


def candidates(text: Column, spans: Column) -> Column:
    """Words with a digit: span, instance, patterns by hash, and the kind number of a base span on it (else -1)."""

    def shape(word: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(word, "[0-9]", "0"), r"\p{L}+", "a")

    def one(m: Column, after: Column) -> Column:
        lead = F.length(F.regexp_extract(m["value"], r"^[^\p{L}0-9+]*+", 0))
        core = F.regexp_extract(m["value"], r"[\p{L}0-9+].*[\p{L}0-9]|[0-9]", 0)
        start = m["start"] + lead
        left = F.regexp_extract(F.lower(m["before"]), r"(?<![^ \t\n\x0B\f\r])([^ \t\n\x0B\f\r]++)[ \t\n\x0B\f\r]*+$", 1)
        right = F.regexp_extract(F.lower(after), r"^[ \t\n\x0B\f\r]*([^ \t\n\x0B\f\r]+)", 1)
        end = start + F.length(core)
        kind = F.filter(spans, lambda s: (s["start"] < end) & (s["end"] > start))
        return F.struct(
            start.alias("start"), end.alias("end"), F.xxhash64(F.lower(core)).alias("instance"),
            F.xxhash64(F.lit("L"), left, shape(core)).alias("left"), F.xxhash64(F.lit("R"), right, shape(core)).alias("right"),
            F.when(F.size(kind) > 0, kind[0]["no"]).otherwise(-1).alias("seed"),
        )

    def with_after(ms: Column) -> Column:
        tail = F.element_at(F.split(text, CANDIDATE, -1), -1)
        follow = F.concat(F.transform(F.slice(ms, F.lit(2), F.size(ms)), lambda m: m["before"]), F.array(tail))
        return F.zip_with(ms, follow, one)

    kind = "array<struct<start:int,end:int,instance:bigint,left:bigint,right:bigint,seed:int>>"
    usable = F.filter(let(found(text, CANDIDATE), with_after).cast(kind), lambda c: c["end"] - c["start"] >= 4)
    return F.when(text.rlike("[0-9]"), usable).otherwise(F.array().cast(kind))


def read(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k_id, k_text, spans, words) of every row: base spans and candidates of its whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(*doc_key(id_col, text_col), text.alias("text"))
    docs = docs.select("k_id", "k_text", "text", base_spans(F.col("text")).alias("spans"))
    slim = F.transform("spans", lambda s: F.struct(s["start"], s["no"], s["end"]))
    words = candidates(F.col("text"), F.col("spans"))
    return docs.select("k_id", "k_text", slim.cast("array<struct<start:int,no:int,end:int>>").alias("spans"), words.alias("words"))


def scored_patterns(rows: DataFrame) -> DataFrame:
    """(pattern, kind number): the patterns trusted after ROUNDS rounds over the pattern-instance graph."""
    words = rows.select(F.explode("words").alias("w")).select("w.*")
    edges = words.select("instance", "seed", F.explode(F.array("left", "right")).alias("pattern"))
    # An instance that is a seed anywhere is a seed; one edge for each pattern and instance.
    edges = stored(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    seeded = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    scores = stored(seeded.select("instance", "seed", *[(F.col("seed") == n).cast("double").alias(k) for n, k in enumerate(KINDS)]), "scores")
    edges = edges.drop("seed")
    for step in range(ROUNDS):
        patterns = edges.join(scores, "instance").groupBy("pattern").agg(
            *[(F.sum(k) / (F.count("*") + 1)).alias(k) for k in KINDS],
            *[F.sum((F.col("seed") == n).cast("long")).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        )
        patterns = stored(patterns.where(F.greatest(*KINDS) > 0), "patterns")
        if step + 1 < ROUNDS:
            reached = edges.join(patterns.select("pattern", *KINDS), "pattern").groupBy("instance").agg(*[F.max(k).alias(f"p_{k}") for k in KINDS])
            value = [F.when(F.col("seed") >= 0, F.col(k)).otherwise(F.coalesce(f"p_{k}", F.lit(0.0))).alias(k) for k in KINDS]
            scores = stored(scores.join(reached, "instance", "left").select("instance", "seed", *value), "scores")
    best = F.greatest(*KINDS)
    kind = F.coalesce(*[F.when((F.col(k) == best) & (F.col(f"n_{k}") >= SUPPORT), F.lit(n)) for n, k in enumerate(KINDS)])
    trusted = patterns.where(best >= CONFIDENCE).select("pattern", kind.alias("no")).where("no is not null")
    return stored(trusted, "trusted")


def discovered(rows: DataFrame) -> DataFrame:
    """(k_id, k_text, added): spans that trusted patterns add, for the rows that have any."""
    trusted = scored_patterns(rows)
    trusted = small(trusted, trusted.count(), 24)
    words = rows.select("k_id", "k_text", F.explode("words").alias("w")).where("w.seed < 0")
    words = words.select("k_id", "k_text", "w.start", "w.end", F.explode(F.array("w.left", "w.right")).alias("pattern"))
    hits = words.join(trusted, "pattern").groupBy("k_id", "k_text", "start", "end").agg(F.min("no").alias("no"))
    span = F.struct("start", (F.col("no") + len(KINDS)).alias("no"), "end")
    return hits.groupBy("k_id", "k_text").agg(F.sort_array(F.collect_list(span)).alias("added"))


def named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in [*KINDS, *(f"ctx_{k}" for k in KINDS)]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["no"] + 1), s["start"], s["end"])), ",")


def personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k_id, k_text, spans, added) of every row; spans: the base ones, added: those by context."""
    rows = stored(read(documents, id_col, text_col), "pii")
    added = stored(discovered(rows), "added").select(F.col("k_id").alias("a_id"), F.col("k_text").alias("a_text"), "added")
    same = F.col("k_id").eqNullSafe(F.col("a_id")) & (F.col("k_text") == F.col("a_text"))
    out = rows.select("k_id", "k_text", "spans").join(added, same, "left")
    none = F.array().cast("array<struct<start:int,no:int,end:int>>")
    return out.select("k_id", "k_text", "spans", F.coalesce("added", none).alias("added"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    kind = "array<struct<start:int,no:int,end:int>>"

    def join(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), last["no"].alias("no"), F.greatest(last["end"], s["end"]).alias("end"))
        apart = (F.size(done) == 0) | (s["start"] >= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer)))

    def rebuilt(parts: Column) -> Column:
        names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS * 2])
        ends = F.concat(F.array(F.lit(0)), F.transform(parts, lambda s: s["end"]))
        kept = F.zip_with(parts, F.slice(ends, F.lit(1), F.size(parts)), lambda s, e: F.concat(text.substr(e + 1, s["start"] - e), F.element_at(names, s["no"] + 1)))
        return F.concat(F.array_join(kept, ""), text.substr(F.element_at(ends, -1) + 1, F.length(text)))

    merged = F.aggregate(F.array_sort(spans), F.array().cast(kind), join)
    return F.when(F.size(spans) > 0, let(merged, rebuilt)).otherwise(text)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    rows = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(no: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["no"] == no)).cast("long")

    counts = [count(no).alias(f"n_{kind}") for no, kind in enumerate(KINDS)]
    every = F.array_sort(F.concat("spans", "added"))
    return rows.select(
        F.col("k_id").alias("doc_id"), *counts, F.sha2(named(F.col("spans")), 256).alias("base_sha256"), named(every).alias("spans")
    )
