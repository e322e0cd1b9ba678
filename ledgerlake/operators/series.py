"""Anomaly detection and forecasting: linear trend plus weekday effect with a normal band.

Everything is a grouped aggregate per series, so a single long series is never pulled into one
task; the fitted model is one row per series and weekday.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import AsOf, days_before

_DAY0 = "1970-01-01"


def _t(ts: Column) -> Column:
    return F.date_diff(ts, F.lit(_DAY0).cast("date")).cast("double")


def spend_series(spend_daily: DataFrame) -> DataFrame:
    return spend_daily.select(
        F.lit("spend").alias("series"),
        F.col("spend_date").cast("timestamp_ntz").alias("ts"),
        F.col("total_spend").cast("double").alias("y"),
    )


def volume_series(market_daily: DataFrame) -> DataFrame:
    return _ticker_series(market_daily, "volume")


def price_series(market_daily: DataFrame) -> DataFrame:
    return _ticker_series(market_daily, "close")


def _ticker_series(daily: DataFrame, value: str) -> DataFrame:
    return daily.where(F.col(value).isNotNull()).select(
        F.col("ticker").alias("series"),
        F.col("trade_date").cast("timestamp_ntz").alias("ts"),
        F.col(value).cast("double").alias("y"),
    )


def split_series(df: DataFrame, as_of: AsOf, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """Rows strictly before the cutoff for training, the rest for evaluation."""
    cut = days_before(as_of, days).cast("timestamp_ntz")
    return df.where(F.col("ts") < cut), df.where(F.col("ts") >= cut)


def fit(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(model per series, weekday effect per series and weekday)."""
    pts = train.where(F.col("y").isNotNull()).select(
        "series", "y", _t(F.col("ts")).alias("t"), F.dayofweek("ts").alias("dow")
    )
    line = pts.groupBy("series").agg(
        F.count("*").alias("n"),
        F.avg("t").alias("t_mean"),
        F.avg("y").alias("y_mean"),
        F.max("t").alias("t_last"),
        F.regr_sxx("y", "t").alias("sxx"),
        F.regr_slope("y", "t").alias("raw_slope"),
    )
    line = line.select(
        "series", "n", "t_mean", "y_mean", "t_last",
        F.coalesce("sxx", F.lit(0.0)).alias("sxx"),
        F.coalesce("raw_slope", F.lit(0.0)).alias("slope"),
    )
    resid = pts.join(line, "series").select(
        "series", "dow", (F.col("y") - _trend("t")).alias("r")
    )
    by_day = resid.groupBy("series", "dow").agg(
        F.count("*").alias("d_n"),
        F.avg("r").alias("effect"),
        F.var_pop("r").alias("d_var"),
    )
    noise = by_day.groupBy("series").agg(F.sum(F.col("d_n") * F.col("d_var")).alias("sse"))
    model = line.join(noise, "series").withColumn(
        "sigma", F.when(F.col("n") > 2, F.sqrt(F.col("sse") / (F.col("n") - 2))).otherwise(F.lit(0.0))
    )
    return model.drop("sse"), by_day.select("series", "dow", "effect")


def _trend(t: str) -> Column:
    return F.col("y_mean") + F.col("slope") * (F.col(t) - F.col("t_mean"))


def predict(points: DataFrame, model: DataFrame, effects: DataFrame, interval: float) -> DataFrame:
    """Adds forecast, lower_bound and upper_bound to (series, ts, ...)."""
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    at = points.withColumn("t", _t(F.col("ts"))).withColumn("dow", F.dayofweek("ts"))
    j = at.join(model, "series").join(effects, ["series", "dow"], "left")
    dt = F.col("t") - F.col("t_mean")
    leverage = F.when(F.col("sxx") > 0, dt * dt / F.col("sxx")).otherwise(F.lit(0.0))
    half = F.lit(z) * F.col("sigma") * F.sqrt(F.lit(1.0) + F.lit(1.0) / F.col("n") + leverage)
    mid = _trend("t") + F.coalesce("effect", F.lit(0.0))
    return j.select(
        *points.columns,
        mid.alias("forecast"),
        (mid - half).alias("lower_bound"),
        (mid + half).alias("upper_bound"),
    )


# ---- the same model from sums that are kept by day ---------------------------

SUMS = ["n", "st", "stt", "sy", "syy", "sty"]


def origins(points: DataFrame) -> DataFrame:
    """(series, t0, y0): the first point of each series. Sums are taken relative to it, which keeps them small."""
    known = points.where(F.col("y").isNotNull()).select("series", "y", _t(F.col("ts")).alias("t"))
    return known.groupBy("series").agg(F.min("t").alias("t0"), F.min_by("y", "t").alias("y0"))


def day_sums(points: DataFrame, start: DataFrame) -> DataFrame:
    """(series, dow, dt) with the sums of 1, t, t*t, y, y*y and t*y over a day's points.

    Sums of days can be added in any grouping, and a day that is corrected is replaced by itself.
    """
    at = points.where(F.col("y").isNotNull()).join(start, "series")
    at = at.select(
        "series", F.dayofweek("ts").alias("dow"), F.to_date("ts").alias("dt"),
        (_t(F.col("ts")) - F.col("t0")).alias("t"), (F.col("y") - F.col("y0")).alias("y"),
    )
    t, y = F.col("t"), F.col("y")
    sums = zip(SUMS, (F.lit(1.0), t, t * t, y, y * y, t * y))
    return at.groupBy("series", "dow", "dt").agg(*[F.sum(x).alias(name) for name, x in sums])


def fit_sums(sums: DataFrame, start: DataFrame, last: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The model and effects of fit() in closed form from day_sums(); no point is read.

    Residuals are taken about the line: with x = t - mean t, a weekday's sum of squared residuals
    follows from its own six sums.
    """
    by_day = sums.groupBy("series", "dow").agg(*[F.sum(c).alias(c) for c in SUMS])
    ends = sums.groupBy("series").agg(F.max("dt").alias("t_end")) if last is None else last
    whole = by_day.groupBy("series").agg(*[F.sum(c).alias(f"a_{c}") for c in SUMS])
    mean_t, mean_y = F.col("a_st") / F.col("a_n"), F.col("a_sy") / F.col("a_n")
    sxx = F.col("a_stt") - F.col("a_st") * mean_t
    sxy = F.col("a_sty") - F.col("a_st") * mean_y
    line = whole.select("series", "a_n", mean_t.alias("mt"), mean_y.alias("my"), sxx.alias("sxx"), F.when(sxx > 0, sxy / sxx).otherwise(0.0).alias("slope"))
    d = by_day.join(line, "series")
    n, st, stt, sy, syy, sty, mt, my, b = (F.col(c) for c in (*SUMS, "mt", "my", "slope"))
    x, xx = st - n * mt, stt - 2 * mt * st + n * mt * mt  # sums of t - mean, and of its square
    v, vv, xv = sy - n * my, syy - 2 * my * sy + n * my * my, sty - mt * sy - my * (st - n * mt)
    r, rr = v - b * x, vv - 2 * b * xv + b * b * xx
    d = d.select("series", "dow", "n", (r / n).alias("effect"), F.greatest(rr - r * r / n, F.lit(0.0)).alias("sse"))
    noise = d.groupBy("series").agg(F.sum("sse").alias("sse"))
    model = line.join(noise, "series").join(start, "series").join(ends, "series").select(
        "series", F.col("a_n").cast("long").alias("n"), (F.col("mt") + F.col("t0")).alias("t_mean"), (F.col("my") + F.col("y0")).alias("y_mean"),
        _t(F.col("t_end")).alias("t_last"), "sxx", "slope",
        F.when(F.col("a_n") > 2, F.sqrt(F.col("sse") / (F.col("a_n") - 2))).otherwise(F.lit(0.0)).alias("sigma"),
    )
    return model, d.select("series", "dow", "effect")


def ahead(model: DataFrame, effects: DataFrame, horizon: int, interval: float = 0.90) -> DataFrame:
    """The `horizon` days after each series' last point, by a fitted model."""
    future = model.select("series", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"), "t_last").select(
        "series",
        F.date_add(F.lit(_DAY0).cast("date"), (F.col("t_last").cast("int") + F.col("h"))).cast("timestamp_ntz").alias("ts"),
    )
    return predict(future, model, effects, interval).withColumnRenamed("ts", "forecast_date")


def flagged(evaluate: DataFrame, model: DataFrame, effects: DataFrame, interval: float = 0.95) -> DataFrame:
    """Points outside the band of a fitted model are anomalies."""
    p = predict(evaluate.select("series", "ts", "y"), model, effects, interval)
    return p.withColumn("is_anomaly", (F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound")))


def detect_anomalies(train: DataFrame, evaluate: DataFrame, interval: float = 0.95) -> DataFrame:
    return flagged(evaluate, *fit(train), interval)


def forecast(series: DataFrame, horizon: int, interval: float = 0.90) -> DataFrame:
    """The `horizon` days after each series' last point."""
    return ahead(*fit(series), horizon, interval)


def anomaly_counts(**tables: DataFrame) -> DataFrame:
    """Flagged rows against all rows for each named anomaly table."""
    parts = [
        df.agg(F.count_if("is_anomaly").alias("anomalies"), F.count("*").alias("points")).select(
            F.lit(kind).alias("kind"), "anomalies", "points"
        )
        for kind, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def spend_anomaly_view(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        F.col("ts").cast("date").alias("day"),
        F.col("y").alias("actual_spend"),
        F.col("forecast").alias("expected_spend"),
        "lower_bound",
        "upper_bound",
        "is_anomaly",
    )


def volume_anomaly_view(anomalies: DataFrame) -> DataFrame:
    return anomalies.where("is_anomaly").select(
        F.col("series").cast("string").alias("ticker"),
        F.col("ts").cast("date").alias("day"),
        F.col("y").alias("actual_volume"),
        F.col("forecast").alias("expected_volume"),
        "is_anomaly",
    )


def spend_forecast_view(fc: DataFrame) -> DataFrame:
    return fc.select("forecast_date", "forecast", "lower_bound", "upper_bound")


def price_forecast_view(fc: DataFrame) -> DataFrame:
    return fc.select(
        F.col("series").cast("string").alias("ticker"),
        "forecast_date", "forecast", "lower_bound", "upper_bound",
    )


def history_and_forecast(history: DataFrame, fc: DataFrame) -> DataFrame:
    """Actual points and forecast band of the same series stacked under a `kind` column."""
    actual = history.select(F.lit("actual").alias("kind"), "series", F.col("ts").alias("d"), "y")
    ahead = fc.select(
        F.lit("forecast").alias("kind"),
        "series",
        F.col("forecast_date").alias("d"),
        F.col("forecast").alias("y"),
        "lower_bound",
        "upper_bound",
    )
    return actual.unionByName(ahead, allowMissingColumns=True)
