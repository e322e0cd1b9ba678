"""State of the streaming operators: newest version wins, daily marts by updates, late rows."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from ledgerlake.operators import series
from ledgerlake.plans.queries import REGISTRY
from ledgerlake.streaming import daily, models, newest

CANDLE = "ticker string, ts timestamp_ntz, close double, ingested_at timestamp_ntz"


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def run_newest(spark, root, rows, **how):
    spark.createDataFrame(rows, CANDLE).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(CANDLE).parquet(f"{root}/in")
    q = newest.newest_to_table(stream, ["ticker", "ts"], "ts", ["ingested_at"], f"{root}/out", f"{root}/cp", **how)
    q.awaitTermination()
    return q


def table(spark, root):
    schema = spark.createDataFrame([], CANDLE).schema
    return sorted(tuple(r) for r in newest.read_newest(spark, f"{root}/out", schema, ["ticker", "ts"]).collect())


def test_newest_version_wins_whatever_the_order(spark, tmp_path):
    root = str(tmp_path)
    run_newest(spark, root, [("a", at(1, 9), 1.0, at(2)), ("a", at(1, 9), 2.0, at(4)), ("a", at(1, 9), 9.0, at(3)), ("b", at(1, 9), 5.0, at(2)), ("a", None, 1.0, at(2))])
    assert table(spark, root) == [("a", at(1, 9), 2.0, at(4)), ("b", at(1, 9), 5.0, at(2))]
    # An older version changes nothing, a newer one is a correction, equal stamps go by the values.
    run_newest(spark, root, [("a", at(1, 9), 7.0, at(3)), ("b", at(1, 9), 6.0, at(5)), ("b", at(1, 9, 5), 1.0, at(5)), ("b", at(1, 9, 5), 3.0, at(5))])
    assert table(spark, root) == [("a", at(1, 9), 2.0, at(4)), ("b", at(1, 9), 6.0, at(5)), ("b", at(1, 9, 5), 3.0, at(5))]
    marks = {(r.batch_id, r.ticker, r.close): r.is_correction for r in spark.read.parquet(f"{root}/out").where("batch_id > 0").collect()}
    assert {k[1:]: v for k, v in marks.items()} == {("b", 6.0): True, ("b", 3.0): False}


def test_state_is_dropped_behind_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    run_newest(spark, root, [("a", at(1, h), 1.0, at(1)) for h in range(24)], watermark="1 hour")
    q = run_newest(spark, root, [("a", at(9), 1.0, at(9))], watermark="1 hour")
    q = run_newest(spark, root, [("a", at(9, 1), 1.0, at(9)), ("a", at(1, 3), 8.0, at(9))], watermark="1 hour")
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    assert len(table(spark, root)) == 26 and ("a", at(1, 3), 1.0, at(1)) in table(spark, root)


TXN = "txn_id string, txn_ts timestamp_ntz, amount double"


def run_daily(spark, root, mart, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(schema).parquet(f"{root}/in")
    q = daily.run_updates(stream, mart, f"{root}/lake", f"{root}/cp-open")
    q.awaitTermination()
    daily.run_rows(stream, mart, f"{root}/lake", f"{root}/cp-rows").awaitTermination()
    every = spark.read.schema(schema).parquet(f"{root}/in")
    got = sorted(map(tuple, daily.read_daily(spark, f"{root}/lake", mart).collect()))
    want = sorted(map(tuple, mart.batch(every.where(F.col(mart.ts).isNotNull())).select(*mart.columns).collect()))
    assert got == want
    return q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None


def test_days_leave_the_state_and_late_days_are_rebuilt(spark, tmp_path):
    root = str(tmp_path)
    first = run_daily(spark, root, daily.SPEND, TXN, [(str(i), at(1 + i, 5), float(i)) for i in range(8)] + [("n", None, 1.0)])
    # The watermark follows the first batch; it drops the days before from the state of the next.
    run_daily(spark, root, daily.SPEND, TXN, [("a", at(20), 1.0)])
    last = run_daily(spark, root, daily.SPEND, TXN, [("b", at(20, 1), 2.0), ("late", at(2, 7), 100.0)])
    assert first >= 2 and last <= 2
    run_daily(spark, root, daily.SPEND, TXN, [("late2", at(2, 8), 50.0), ("new", at(4, 8), 7.0), ("late3", at(25, 8), 7.0)])
    run_daily(spark, root, daily.SPEND, TXN, [("x", at(24, 9), 1.0), ("y", at(2, 9), 1.0)])


def test_bars_by_updates(spark, tmp_path):
    root = str(tmp_path)
    schema = "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume long"
    bar = lambda t, d, h, x: (t, at(d, h), x, x + 1, x - 1, x + 0.5, 3)
    run_daily(spark, root, daily.BARS, schema, [bar("a", 1, 9, 1.0), bar("a", 1, 10, 2.0), bar("b", 1, 9, 5.0), bar("b", 2, 9, 6.0)])
    # One ticker of a day changes, the other keeps its row; then a late bar opens an old day.
    run_daily(spark, root, daily.BARS, schema, [bar("a", 2, 9, 7.0), bar("b", 9, 9, 8.0)])
    run_daily(spark, root, daily.BARS, schema, [bar("a", 1, 8, 0.5), bar("b", 9, 10, 9.0)])


def test_models_from_kept_sums(spark, tmp_path):
    """Closed-form fits equal the batch fit after appends and corrected days, with bounded reads."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(n)
    value = lambda s, n: {"a": 1e6 + 37.5 * n + (n * 7919 % 13) * 11.0, "b": 5.0, "c": -3.0 * n + (n % 7)}[s]
    rows = [(s, day(n), value(s, n)) for n in range(70) for s in "abc" if s != "c" or n > 30] + [("d", day(3), 2.0), ("a", day(5), None)]
    schema = "series string, ts timestamp_ntz, y double"
    points = spark.createDataFrame(rows, schema)
    stale = points.withColumn("y", F.when(F.dayofmonth("ts") == 9, F.col("y") + 100).otherwise(F.col("y")))
    parts = [stale.where("ts < '2024-01-20'"), points.where("ts >= '2024-01-20' and ts < '2024-02-25'"), points.where("ts >= '2024-02-25' or dayofmonth(ts) = 9")]
    root = str(tmp_path)
    for i, part in enumerate(parts):
        models.append_days(part, root, batch_id=i)
    models.append_days(parts[0], root, batch_id=0)  # a replay has nothing to do

    def rounded(df):
        return sorted(tuple(round(x, 8) if isinstance(x, float) else x for x in r) for r in df.select("series", "forecast_date", "forecast", "lower_bound", "upper_bound").collect())

    got, want = rounded(models.forecast(spark, root, 7)), rounded(series.forecast(points, 7))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(x - y) <= 1e-8 * max(1.0, abs(y)) for g, w in zip(got, want) for x, y in zip(g[2:], w[2:]))
    train, evaluate = series.split_series(points, "2024-03-10", 20)
    flags = {(r.series, r.ts): r.is_anomaly for r in models.anomalies(evaluate, root, "2024-02-19").collect()}
    assert flags == {(r.series, r.ts): r.is_anomaly for r in series.detect_anomalies(train, evaluate).collect()} and flags


def test_candles_of_one_stamp_are_all_kept(spark, tmp_path):
    """Events of one type and time are two candles, each corrected for itself."""
    events = [(i, at(1 + i % 4, 9), 7, "view", float(i), '{"k": 1}') for i in range(16)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(str(tmp_path / "events.parquet"))
    got = REGISTRY["stream_newest"](spark, str(tmp_path)).collect()
    close = lambda e: round(e[4] * (1 + ((e[0] % 7) - 3) / 100.0), 4) + (0.5 if e[1].day % 2 == 0 else 0)
    assert sorted((r.ticker, r.ts, round(r.close, 4)) for r in got) == sorted(("view", e[1], round(close(e), 4)) for e in events)
