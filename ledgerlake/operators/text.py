"""News enrichment: sentiment, topic and summary of whole texts."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import lexicons
from ledgerlake.functions.tokens import hits, sentences, tokens
from ledgerlake.operators.skew import lookup_join

# The batch function travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Word lists of up to this length travel as literals inside the plan; longer ones are joined.
MAX_WORDS = 20_000


def _checked(words: list[str]) -> list[str]:
    if len(words) > MAX_WORDS:
        raise ValueError(f"word list has {len(words)} entries, at most {MAX_WORDS} fit in a plan")
    return sorted(words)


def sentiment_score(token_array: Column, positive: list[str], negative: list[str]) -> Column:
    """(pos - neg) / (pos + neg) over the tokens, 0 when no listed word occurs; row-local."""
    pos = F.size(hits(token_array, _checked(positive))).cast("double")
    neg = F.size(hits(token_array, _checked(negative))).cast("double")
    return F.when(token_array.isNull(), F.lit(None).cast("double")).when(
        pos + neg == 0, F.lit(0.0)
    ).otherwise((pos - neg) / (pos + neg))


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0.2, "Positive").when(score < -0.2, "Negative").otherwise("Neutral")


def topic_of(
    token_array: Column, keywords: dict[str, dict[str, int]], labels: list[str], fallback: str
) -> Column:
    """Label with the largest weighted keyword count; ties go to the earlier label."""
    _checked([w for ws in keywords.values() for w in ws])
    scored = []
    for i, label in enumerate(labels):
        pairs = [F.lit(x) for word, weight in sorted(keywords.get(label, {}).items()) for x in (word, weight)]
        weights = F.create_map(*pairs) if pairs else None
        score = (
            F.aggregate(
                token_array, F.lit(0), lambda s, t: s + F.coalesce(F.try_element_at(weights, t), F.lit(0))
            )
            if pairs
            else F.lit(0)
        )
        scored.append(F.struct(score.alias("s"), F.lit(-i).alias("i"), F.lit(label).alias("label")))
    best = F.array_max(F.array(*scored))
    return F.when(token_array.isNull(), F.lit(None)).when(best["s"] > 0, best["label"]).otherwise(fallback)


def _best_sentences(n: int):
    """Arrow function: token lists per sentence to the positions of the n best sentences.

    A sentence's score is the mean count of its tokens within the article; ties go to the
    earlier sentence. The counts of a whole batch are taken at once.
    """

    @F.arrow_udf("array<int>")
    def best(batch: pa.Array) -> pa.Array:
        words = pc.list_flatten(batch)
        doc_of = pc.list_parent_indices(batch).to_numpy()
        sent_of = pc.list_parent_indices(words).to_numpy()
        coded = pc.list_flatten(words).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pair = doc_of[sent_of] * max(len(coded.dictionary), 1) + code
        _, at, count = np.unique(pair, return_inverse=True, return_counts=True)
        length = np.bincount(sent_of, minlength=len(doc_of))
        total = np.bincount(sent_of, weights=count[at], minlength=len(doc_of))
        kept = np.flatnonzero(length)
        score = np.round(total[kept] / length[kept], 6)
        order = kept[np.lexsort((kept, -score, doc_of[kept]))]
        # Rows are grouped by article; the rank restarts where the article changes.
        doc = doc_of[order]
        first = np.searchsorted(doc, doc)
        order = np.sort(order[np.arange(len(order)) - first < n])
        start = np.searchsorted(doc_of, np.arange(len(batch)))
        chosen = (order - start[doc_of[order]]).astype(np.int32)
        offsets = np.searchsorted(doc_of[order], np.arange(len(batch) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(chosen))

    return best


def summary_of(text: Column, n: int = 1) -> Column:
    """The n sentences with the highest mean term frequency, in text order; row-local.

    With explode and grouping the texts and all their tokens would be shuffled by article; here
    sentences and tokens are cut JVM-side and only the counting runs in Arrow batches.
    """
    parts = F.coalesce(sentences(text), F.array().cast("array<string>"))
    chosen = _best_sentences(n)(F.transform(parts, tokens))
    joined = F.array_join(F.transform(chosen, lambda i: F.trim(F.get(parts, i))), " ")
    return F.when(F.size(chosen) > 0, joined)


def summarize(news: DataFrame, n: int = 1) -> DataFrame:
    return news.select("news_id", summary_of(F.col("body"), n).alias("summary"))


def news_sentiment(
    news: DataFrame,
    positive: list[str] = lexicons.FINANCE_POSITIVE,
    negative: list[str] = lexicons.FINANCE_NEGATIVE,
    keywords: dict[str, dict[str, int]] = lexicons.FINANCE_TOPICS,
    labels: list[str] = lexicons.TOPICS,
    fallback: str = "Macroeconomy",
) -> DataFrame:
    """News with sentiment_score, topic and sentiment_label.

    With lists of up to MAX_WORDS words this is a map-only projection; longer lists are a table that
    the articles' words are joined with.
    """
    vocabulary = sorted({*positive, *negative, *(w for ws in keywords.values() for w in ws)})
    if len(vocabulary) > MAX_WORDS:
        return _sentiment_by_lookup(news, vocabulary, positive, negative, keywords, labels, fallback)
    # One pass over the text keeps only listed words; the scores then count in that short array.
    text = F.concat("headline", F.lit(". "), "body")
    known = news.withColumn("_known", hits(tokens(text), _checked(vocabulary)))
    scored = known.withColumn("sentiment_score", sentiment_score(F.col("_known"), positive, negative))
    return scored.withColumn("topic", topic_of(F.col("_known"), keywords, labels, fallback)).withColumn(
        "sentiment_label", sentiment_label(F.col("sentiment_score"))
    ).drop("_known")


def _sentiment_by_lookup(
    news: DataFrame, vocabulary: list[str], positive: list[str], negative: list[str],
    keywords: dict[str, dict[str, int]], labels: list[str], fallback: str,
) -> DataFrame:
    """The columns of news_sentiment() with the word lists as a table.

    Words are counted per article before they meet the table, which is broadcast if its measured size
    allows it and else joined with hot words split. Only counts move; the articles' texts are joined
    back by a key of their content, so rows that are alike get the same result.
    """
    ups, downs = set(positive), set(negative)
    rows = [(w, int(w in ups), int(w in downs), [int(keywords.get(label, {}).get(w, 0)) for label in labels]) for w in vocabulary]
    table = news.sparkSession.createDataFrame(rows, "term string, up int, down int, weights array<int>")
    text = F.concat("headline", F.lit(". "), "body")
    content = [F.coalesce(c, F.lit("")) for c in ("headline", "body")]
    keyed = news.withColumns({"_k1": F.xxhash64(*content), "_k2": F.xxhash64(F.lit(1), *content)})
    words = keyed.select("_k1", "_k2", text.alias("text")).dropDuplicates(["_k1", "_k2"]).select("_k1", "_k2", F.explode(tokens(F.col("text"))).alias("term"))
    counts = words.groupBy("_k1", "_k2", "term").agg(F.count("*").alias("n"))
    met = lookup_join(counts, table, ["term"], spread_by="_k1", max_broadcast_rows=len(vocabulary))
    sums = met.groupBy("_k1", "_k2").agg(
        F.sum(F.col("n") * F.col("up")).cast("double").alias("_up"), F.sum(F.col("n") * F.col("down")).cast("double").alias("_down"),
        *[F.sum(F.col("n") * F.col("weights")[i]).alias(f"_w{i}") for i in range(len(labels))],
    )
    up, down = F.coalesce("_up", F.lit(0.0)), F.coalesce("_down", F.lit(0.0))
    scored = [F.struct(F.coalesce(f"_w{i}", F.lit(0)).alias("s"), F.lit(-i).alias("i"), F.lit(label).alias("label")) for i, label in enumerate(labels)]
    best = F.array_max(F.array(*scored))
    score = F.when(text.isNull(), F.lit(None).cast("double")).when(up + down == 0, F.lit(0.0)).otherwise((up - down) / (up + down))
    topic = F.when(text.isNull(), F.lit(None)).when(best["s"] > 0, best["label"]).otherwise(fallback)
    out = keyed.join(sums, ["_k1", "_k2"], "left").withColumn("sentiment_score", score).withColumn("topic", topic)
    return out.withColumn("sentiment_label", sentiment_label(F.col("sentiment_score"))).select(
        *news.columns, "sentiment_score", "topic", "sentiment_label"
    )


def enrich_news(news: DataFrame, **lexicon) -> DataFrame:
    """All enrichment columns without moving a text between tasks."""
    return news_sentiment(news, **lexicon).withColumn("summary", summary_of(F.col("body"))).select(
        *news.columns, "sentiment_score", "topic", "summary", "sentiment_label"
    )
