"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features come from the whole text only: densities of insult and threat words, their nearness to
second-person words, capitals, punctuation and obfuscation. Beside the given lists, which know a few
languages only, a lexicon is taught by the labels: words and word starts (START code points) that
at least LEAST fitting texts hold and that occur in toxic ones more often by Z standard errors of
the log odds. Its density, its densest spot and the number of its different terms are features like
those of the given lists. Trees and calibration are Spark ML models; the lexicon and the trees see
the fitting rows, the calibration other rows, all of a sample of at most MAX_TRAIN labelled rows.
Scoring is one map over the texts.

Defined cases: null and empty texts have all-zero features and are scored like any other;
null labels are ignored, and of a document's different labels the largest holds; without both
kinds of label among the training rows the score is their mean (0 without rows). Rows that repeat
a doc_id are scored each by their own text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, bounded_memory, hashes_of, pieces, released, small, stored, utf8, within, words

MAX_TRAIN = 30_000
THRESHOLD = 0.3
NEAR = 5  # words between an insult and a second-person word
WINDOW = 50  # words over which the densest spot is looked for
START = 4  # code points of a word start
LEAST = 5
Z = 4.0
MAX_TERMS = 4_096  # of a taught lexicon, those of largest log odds in standard errors

INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass fool foolish imbecile cretin "
    "loser losers clown clowns pathetic worthless useless trash garbage scum filth filthy disgusting vile "
    "disgrace coward pig swine rat vermin parasite jerk ass asshole bastard bitch whore slut damn crap shit "
    "bullshit fuck fucking fucker retard retarded freak creep degenerate ugly liar lunatic brainless "
    "dumm dummkopf blöd blödmann trottel arsch arschloch scheisse scheiße hure abschaum versager widerlich "
    "tonto estúpido estúpida imbécil idiota mierda puta cabrón basura asqueroso inútil escoria perdedor "
    "idiote stupide imbécile crétin connard connasse salope merde pute ordure minable dégoûtant nul raclure"
).split()
THREATS = (
    "kill die death murder shoot stab hang burn destroy hurt beat rape hate töten stirb umbringen hassen "
    "matar muere muerte odio tuer crève mort haine"
).split()
SECOND = (
    "you your yours yourself u ur youre du dich dir dein deine ihr euch euer tú tu ti te usted ustedes vos "
    "toi vous votre vos ton ta"
).split()

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
NOT_LETTER = ~LETTER
LEET = LOWER.copy()
for _sign, _letter in zip(b"013457@$!", b"oieastasi"):
    LEET[_sign] = _letter
NOT_LEET = NOT_LETTER.copy()
NOT_LEET[list(b"013457@$!")] = False
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
MARKS = {"bang": b"!", "question": b"?", "stops": b".,;:", "signs": b"#$%&*@^~_|<>=+", "digits": b"0123456789"}

NAMES = [
    "insults", "insults_log", "densest", "threats", "second", "near", "capitals", "shouted", *MARKS,
    "hidden", "hidden_log", "masked", "spaced", "drawn", "foreign", "word_length", "words_log",
    "taught", "taught_log", "taught_densest", "taught_kinds",
]


@dataclass
class Lexicon:
    """Sorted hashes of terms (see terms()) and their weights."""

    terms: np.ndarray
    weights: np.ndarray

    def of(self, hashed: np.ndarray) -> np.ndarray:
        """The weight of each term, 0 for others."""
        if not len(self.terms):
            return np.zeros(len(hashed))
        at = np.minimum(np.searchsorted(self.terms, hashed), len(self.terms) - 1)
        return np.where(self.terms[at] == hashed, self.weights[at], 0.0)


NO_LEXICON = Lexicon(np.zeros(0, np.uint64), np.zeros(0))


def started(column: pa.Array) -> pa.Array:
    """The texts with every word cut to its first START code points; the rest is blank."""
    raw, at = utf8(column)
    letter = LETTER[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = letter[:-1]
    before[at[:-1][at[:-1] < len(raw)]] = False
    begins = letter & ~before
    point = np.cumsum((raw & 0xC0) != 0x80)  # continuation bytes belong to the code point before
    first = np.maximum.accumulate(np.where(begins, np.arange(len(raw)), 0))
    cut = np.where(letter & (point - point[first] >= START), np.uint8(32), raw)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(cut))


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words and of their starts, one start a word, and the texts' offsets into them."""
    hashed, where = words(column, gaps=NOT_LETTER)
    starts, _ = words(started(column), gaps=NOT_LETTER)
    return hashed, starts ^ np.uint64(0x5BD1E995), where


def _sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _features(column: pa.Array, lists: dict[str, np.ndarray], lexicon: Lexicon = NO_LEXICON) -> np.ndarray:
    raw, at = utf8(column)
    size = np.maximum(np.diff(at), 1)
    hashed, starts, where = terms(column)
    count = np.maximum(np.diff(where), 1)
    insult = within(hashed, lists["insults"])
    second = within(hashed, lists["second"])
    seen = np.concatenate([[0], np.cumsum(second)])
    hits = np.flatnonzero(insult)
    own = np.searchsorted(where, hits, "right") - 1
    near = np.zeros(len(hashed), bool)
    reach = np.minimum(hits + NEAR + 1, where[own + 1])
    near[hits] = seen[reach] > seen[np.maximum(hits - NEAR, where[own])]
    so_far = np.concatenate([[0], np.cumsum(insult)])
    densest = np.zeros(len(column))
    np.maximum.at(densest, own, so_far[np.minimum(hits + WINDOW, where[own + 1])] - so_far[hits])
    leet, leet_at = words(column, fold=LEET, gaps=NOT_LEET)
    n_insult = _sums(insult, where)
    hidden = np.maximum(_sums(within(leet, lists["leet"]), leet_at) - n_insult, 0)

    letter, upper = LETTER[raw], UPPER[raw]
    n_letter = np.maximum(_sums(letter, at), 1)
    inner = np.zeros(len(raw), bool)
    drawn = np.zeros(len(raw), bool)
    shouted = np.zeros(len(raw), bool)
    alone = np.zeros(len(raw), bool)
    if len(raw) > 2:
        inner[1:-1] = (raw[1:-1] == ord("*")) & letter[:-2] & letter[2:]
        drawn[2:] = letter[2:] & (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])
        shouted[2:] = upper[2:] & upper[1:-1] & upper[:-2]
        alone[1:-1] = letter[1:-1] & ~letter[:-2] & ~letter[2:] & (raw[1:-1] < 128)
    filled = at[1:] > at[:-1]  # neighbours of another text do not count
    first, last = at[:-1][filled], at[1:][filled] - 1
    for marks in (inner, alone):
        marks[first] = marks[last] = False
    for marks in (drawn, shouted):
        marks[first] = marks[np.minimum(first + 1, last)] = False
    weight = np.maximum(lexicon.of(hashed), lexicon.of(starts))
    told = np.flatnonzero(weight)
    holder = np.searchsorted(where, told, "right") - 1
    sums = np.concatenate([[0.0], np.cumsum(weight)])
    taught = sums[where[1:]] - sums[where[:-1]]
    taught_densest = np.zeros(len(column))
    np.maximum.at(taught_densest, holder, sums[np.minimum(told + WINDOW, where[holder + 1])] - sums[told])
    kinds = np.zeros(len(column))
    if len(told):
        pairs = np.unique(np.stack([holder, starts[told].view(np.int64)]), axis=1)
        np.add.at(kinds, pairs[0], 1)
    values = [
        n_insult / count, np.log1p(n_insult), densest, _sums(within(hashed, lists["threats"]), where) / count,
        _sums(second, where) / count, _sums(near, where) / count, _sums(upper, at) / n_letter,
        _sums(shouted, at) / n_letter,
        *(_sums(np.isin(raw, list(m)), at) / size for m in MARKS.values()),
        hidden / count, np.log1p(hidden), _sums(inner, at) / count, _sums(alone, at) / count,
        _sums(drawn, at) / n_letter, _sums(raw >= 128, at) / size, n_letter / count, np.log1p(np.diff(where)),
        taught / count, np.log1p(taught), taught_densest, np.log1p(kinds),
    ]
    return np.stack(values, axis=1)


def feature_column(text: Column, lexicon: Lexicon = NO_LEXICON) -> Column:
    """The features of whole texts as a vector."""

    @F.arrow_udf("array<double>")
    def features(column: pa.Array) -> pa.Array:
        lists = {"insults": hashes_of(INSULTS), "threats": hashes_of(THREATS), "second": hashes_of(SECOND)}
        lists["leet"] = hashes_of(INSULTS, fold=LEET, gaps=NOT_LEET)
        found = [released(_features(p, lists, lexicon)) for p in pieces(column)]
        flat = np.concatenate(found) if found else np.zeros((0, len(NAMES)))
        return pa.ListArray.from_arrays(np.arange(0, flat.size + 1, len(NAMES), dtype=np.int32), flat.ravel())

    return array_to_vector(features(F.coalesce(text, F.lit(""))))


def side(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; 2 marks held-out rows."""
    return F.crc32(doc_id.cast("string")) % 4


def taught(rows: DataFrame) -> Lexicon:
    """The lexicon of labelled texts (label, l_text): terms whose presence goes with the label."""

    @F.arrow_udf("array<long>")
    def present(column: pa.Array) -> pa.Array:
        held, at = [], [0]
        for piece in pieces(column):
            hashed, starts, where = terms(piece)
            for a, b in zip(where[:-1], where[1:]):
                held.append(np.unique(np.concatenate([hashed[a:b], starts[a:b]])).view(np.int64))
                at.append(at[-1] + len(held[-1]))
        flat = np.concatenate(held) if held else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(np.array(at, np.int32), flat)

    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    held = rows.select("label", F.explode(present(F.coalesce("l_text", F.lit("")))).alias("term"))
    counts = held.groupBy("term").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("c")).where(F.col("p") + F.col("c") >= LEAST)
    cells = [F.col("p") + 0.5, n.get(1.0, 0) - F.col("p") + 0.5, F.col("c") + 0.5, n.get(0.0, 0) - F.col("c") + 0.5]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    errors = odds / F.sqrt(sum((1 / c for c in cells), F.lit(0.0)))
    best = counts.select("term", odds.alias("odds"), errors.alias("z")).where(F.col("z") >= Z).orderBy(F.desc("z"), "term").limit(MAX_TERMS)
    found = sorted((np.int64(r.term).view(np.uint64), r.odds) for r in best.collect())
    return Lexicon(np.array([t for t, _ in found], np.uint64), np.array([w for _, w in found], float))


@dataclass
class ToxicityModel:
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float
    lexicon: Lexicon = field(default_factory=lambda: NO_LEXICON)

    def score(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """df with the columns score and predicted."""
        if self.trees is None:
            return df.withColumns({"score": F.lit(self.prior), "predicted": F.lit(int(self.prior >= THRESHOLD))})
        work = df.withColumn("tox_features", feature_column(F.col(text_col), self.lexicon))
        work = _margin(self.trees, work)
        # Calibrated steps are ties; the margin orders the rows within one.
        work = self.calibration.transform(work)
        fine = 1 / (1 + F.exp(-2 * F.col("tox_margin")))
        value = F.least(F.greatest(0.999 * F.col("tox_level") + 0.001 * fine, F.lit(0.0)), F.lit(1.0))
        work = work.withColumn("score", value)
        work = work.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
        return work.drop("tox_features", "tox_margin", "tox_level")


def _margin(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    out = trees.transform(df).withColumn("tox_margin", vector_to_array("tox_raw")[1])
    return out.drop("tox_raw", "tox_probability", "tox_class")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN
) -> ToxicityModel:
    """Fit on labelled rows whose side is not 2, at most about max_train of them, drawn by a hash of the id."""
    bounded_memory(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("double").alias("label"))
        .where(side(F.col("l_id")) != 2).groupBy("l_id").agg(F.max("label").alias("label")).where("label is not null")
    )
    known = stored(known, "labels")
    rows = known.count()
    share = min(1.0, max_train / max(rows, 1))
    drawn = known.where(F.pmod(F.xxhash64("l_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(id_col).alias("l_id"), F.col(text_col).alias("l_text"))
    train = texts.join(small(drawn, int(rows * share * 1.1), 24), "l_id").select("l_id", "label", "l_text")
    train = stored(train, "train")
    counts = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        return ToxicityModel(None, None, float(next(iter(counts), 0.0)))
    calibrating = F.pmod(F.xxhash64("l_id", F.lit(5)), F.lit(3)) == 0
    fitting = train.where(~calibrating)
    if fitting.select("label").distinct().count() < 2 or train.where(calibrating).isEmpty():
        fitting = train
        calibrating = F.lit(True)
    lexicon = taught(fitting)
    featured = stored(train.select("l_id", "label", calibrating.alias("calibrating"), feature_column(F.col("l_text"), lexicon).alias("tox_features")), "features")
    # At most MAX_TRAIN rows of numbers, read again for every level of every tree.
    featured = featured.repartition(docs.sparkSession.sparkContext.defaultParallelism, "l_id").persist()
    fitting = featured.where(~F.col("calibrating")) if fitting is not train else featured
    trees = GBTClassifier(
        featuresCol="tox_features", labelCol="label", predictionCol="tox_class", maxIter=20, maxDepth=3, stepSize=0.2, maxBins=64, minInstancesPerNode=5, seed=7,
    ).setRawPredictionCol("tox_raw").setProbabilityCol("tox_probability").fit(fitting)
    level = IsotonicRegression(featuresCol="tox_margin", labelCol="label", predictionCol="tox_level")
    calibrated = level.fit(_margin(trees, featured.where("calibrating")))
    featured.unpersist()
    return ToxicityModel(trees, calibrated, 0.0, lexicon)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(side(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return model.score(docs).select("doc_id", held_out, F.col("score").cast("double"), "predicted")
