"""Streams: files loaded once, duplicates, and batch parity."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold, search, silver
from ledgerlake.streaming import ingest, marts

from tests.test_files import rec


def put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(records))


def test_files_are_loaded_once(spark, tmp_path):
    put(tmp_path / "in", "a.json", [rec(1), rec(2)])
    (tmp_path / "in" / "bad.json").write_text("[{")
    run = lambda: ingest.stream_bronze(spark, str(tmp_path / "in"), str(tmp_path / "b"), str(tmp_path / "cp")).awaitTermination()
    run()
    put(tmp_path / "in", "b.json", rec(3))
    run()
    run()
    raw = ingest.read_bronze(spark, str(tmp_path / "b"))
    assert silver.typed(raw, silver.TRANSACTION_FIELDS).select("txn_id").count() == 3
    assert spark.read.parquet(str(tmp_path / "b_bad") + "/*").count() == 1


def test_trigger_arguments():
    assert ingest.trigger_args(None) == {"availableNow": True}
    assert ingest.trigger_args("15 seconds") == {"processingTime": "15 seconds"}


def medallion(spark, tmp_path):
    marts.run_medallion(spark, str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "cp")).awaitTermination()
    return str(tmp_path / "lake")


def test_refresh_takes_corrections_and_moves_between_days(spark, tmp_path):
    put(tmp_path / "in", "a.json", [rec(1, 10.0, "2024-01-01T01:00:00"), rec(2, 20.0, "2024-01-02T01:00:00"), rec(3, 5.0, "2024-01-03T01:00:00")])
    m = medallion(spark, tmp_path)
    # 1 is corrected in place, 2 moves to an existing day and empties its old one, 4 is new.
    put(tmp_path / "in", "b.json", [rec(1, 11.0, "2024-01-01T01:00:00"), rec(2, 20.0, "2024-01-03T01:00:00"), rec(4, 1.0, "2024-01-04T01:00:00")])
    medallion(spark, tmp_path)
    live = {(r["txn_id"], str(r["dt"]), r["amount"]) for r in marts.read_silver(spark, m).collect()}
    assert live == {("1", "2024-01-01", 11.0), ("2", "2024-01-03", 20.0), ("3", "2024-01-03", 5.0), ("4", "2024-01-04", 1.0)}
    daily = {(str(r["spend_date"]), r["txn_count"], r["total_spend"]) for r in marts.read_spend_daily(spark, m).collect()}
    assert daily == {("2024-01-01", 1, 11.0), ("2024-01-03", 2, 25.0), ("2024-01-04", 1, 1.0)}
    cats = {(str(r["spend_date"]), r["category"], r["total_spend"]) for r in marts.read_spend_by_category(spark, m).collect()}
    assert cats == {("2024-01-01", "c", 11.0), ("2024-01-03", "c", 25.0), ("2024-01-04", "c", 1.0)}


def test_refresh_twice_changes_nothing(spark, tmp_path):
    rows = [("1", "A", dt.datetime(2024, 1, 1), 1.0, "c", "m", "x", "US", "online", False, dt.datetime(2024, 2, 1))]
    batch = spark.createDataFrame(rows, marts.TRANSACTIONS.typed_schema)
    m = str(tmp_path / "lake")
    marts.refresh(batch, m)
    before = sorted(map(str, marts.read_silver(spark, m).collect()))
    marts.refresh(batch, m)
    assert sorted(map(str, marts.read_silver(spark, m).collect())) == before


@pytest.fixture()
def txn_files(spark, tmp_path):
    rows = [(str(i), "A", dt.datetime(2024, 1, 1 + i % 5, i % 24), float(i), "c", "m", "x", "US", "online", False) for i in range(200)]
    schema = ", ".join(f"{n} {t}" for n, _, t in silver.TRANSACTION_FIELDS)
    df = spark.createDataFrame(rows, schema)
    df.repartition(4).write.parquet(str(tmp_path / "txn"))
    return df, spark.readStream.schema(schema).parquet(str(tmp_path / "txn")), tmp_path


def test_streamed_spend_equals_batch(spark, txn_files):
    df, stream, tmp = txn_files
    marts.write_table(marts.stream_spend_daily(stream), str(tmp / "o"), str(tmp / "c"), "complete").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp / "o")).collect())) == sorted(map(tuple, gold.spend_daily(df).collect()))


def test_stream_dedup_drops_resends(spark, txn_files):
    _, stream, tmp = txn_files
    both = stream.unionByName(stream)
    marts.write_table(marts.stream_dedup(both, ["txn_id"], "txn_ts", "30 days"), str(tmp / "o"), str(tmp / "c")).awaitTermination()
    out = spark.read.parquet(str(tmp / "o"))
    assert out.count() == 200 and out.select("txn_id").distinct().count() == 200


def test_index_refresh_finds_new_articles(spark, tmp_path):
    schema = "news_id string, published_at timestamp_ntz, ticker string, headline string, body string, source string"
    def write(i, body):
        spark.createDataFrame([(str(i), dt.datetime(2024, 1, 1), "A", "h", body, "s")], schema).write.mode("append").parquet(str(tmp_path / "n"))
    def run():
        marts.refresh_index(spark, spark.readStream.schema(schema).parquet(str(tmp_path / "n")), str(tmp_path / "i"), str(tmp_path / "c")).awaitTermination()
    write(1, "plain words about markets")
    run()
    write(2, "a zebra appears in markets")
    run()
    q = spark.createDataFrame([("q", "zebra markets")], "query_id string, query string")
    hits = search.search(search.read_index(spark, str(tmp_path / "i")), q, 5, ["ticker"]).orderBy("rank").collect()
    assert [h["news_id"] for h in hits] == ["2", "1"]
    assert spark.read.parquet(str(tmp_path / "i" / "docs")).agg(F.count("*")).first()[0] == 2


def test_news_lane_keeps_the_newest_version(spark, tmp_path):
    article = lambda i, day, body: {"news_id": i, "ts": f"2024-01-0{day}T00:00:00", "ticker": "A", "headline": "h", "body": body, "source": "s"}
    run = lambda: marts.run_medallion(spark, str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "cp"), marts.NEWS).awaitTermination()
    put(tmp_path / "in", "a.json", [article("1", 1, "old"), article("2", 1, "same")])
    run()
    put(tmp_path / "in", "b.json", [article("1", 2, "new")])
    run()
    got = {(r["news_id"], r["body"], str(r["dt"])) for r in marts.read_silver(spark, str(tmp_path / "lake"), marts.NEWS).collect()}
    assert got == {("1", "new", "2024-01-02"), ("2", "same", "2024-01-01")}


def test_a_record_without_a_time_is_kept(spark, tmp_path):
    put(tmp_path / "in", "a.json", [{**rec(1), "ts": "never"}, rec(2)])
    m = medallion(spark, tmp_path)
    put(tmp_path / "in", "b.json", [rec(3)])
    medallion(spark, tmp_path)
    assert {r["txn_id"] for r in marts.read_silver(spark, m).collect()} == {"1", "2", "3"}


def test_the_refresh_keeps_raw_and_malformed_records(spark, tmp_path):
    put(tmp_path / "in", "a.json", [rec(1)])
    (tmp_path / "in" / "bad.json").write_text('{"txn_id": "9", "amo')
    m = medallion(spark, tmp_path)
    assert [r["text"] for r in ingest.read_bad(spark, f"{m}/raw").collect()] == ['{"txn_id": "9", "amo']
    assert ingest.read_bronze(spark, f"{m}/raw").count() == 1


def test_late_first_records_stay(spark, tmp_path):
    schema = "id string, ts timestamp_ntz, v long"

    def batch(*rows):
        spark.createDataFrame([(i, dt.datetime(2024, 1, day), v) for i, day, v in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        marts.dedup_to_table(stream, ["id"], "ts", str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
        return {(r.id, r.v) for r in marts.read_deduped(spark, str(tmp_path / "o"), stream.schema).collect()}

    assert batch(("a", 20, 1), ("a", 20, 1)) == {("a", 1)}
    assert batch(("b", 3, 2), ("a", 20, 1)) == {("a", 1), ("b", 2)}  # b is 17 days late, a is a re-send
    assert batch(("b", 3, 2), ("c", 1, 3)) == {("a", 1), ("b", 2), ("c", 3)}


def test_dedup_keeps_records_without_time_or_key(spark, tmp_path):
    schema = "id string, part string, ts timestamp_ntz, v long"

    def batch(*rows):
        rows = [(i, p, day and dt.datetime(2024, 1, day), v) for i, p, day, v in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        marts.dedup_to_table(stream, ["id", "part"], "ts", str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
        return sorted(((r.id, r.part, r.v) for r in marts.read_deduped(spark, str(tmp_path / "o"), stream.schema).collect()), key=str)

    got = batch(("a", "p", None, 2), ("a", "p", None, 1), ("b", "p", None, 4), ("b", "p", 3, 5), (None, "p", 1, 6), (None, "p", 1, 6), ("c", None, None, 7), ("f", "p", 1, 0))
    want = [("a", "p", 1), ("b", "p", 5), ("c", None, 7), (None, "p", 6), (None, "p", 6), ("f", "p", 0)]
    assert got == sorted(want, key=str)
    got = batch(("a", "p", None, 9), ("b", "p", None, 9), ("f", "p", None, 9), ("d", "p", None, 8), (None, "p", 20, 6), ("c", None, None, 7), ("e", "p", 25, 3))
    want += [("d", "p", 8), (None, "p", 6), ("c", None, 7), ("e", "p", 3)]  # a, b and f are known, whatever their day
    assert got == sorted(want, key=str)


def test_resent_articles_count_once(spark, tmp_path):
    schema = "news_id string, published_at timestamp_ntz, ticker string, headline string, body string, source string"

    def run(*rows):
        spark.createDataFrame([(i, dt.datetime(2024, 1, 1), "A", "h", body, "s") for i, body in rows], schema).write.mode("append").parquet(str(tmp_path / "n"))
        marts.refresh_index(spark, spark.readStream.schema(schema).parquet(str(tmp_path / "n")), str(tmp_path / "i"), str(tmp_path / "c")).awaitTermination()
        q = spark.createDataFrame([("q", "zebra markets")], "query_id string, query string")
        found = search.search(search.read_index(spark, str(tmp_path / "i")), q, 5, ["ticker"])
        return [(r["rank"], r["news_id"], r["score"]) for r in found.orderBy("rank").collect()]

    first = run(("1", "plain words about markets"), ("2", "a zebra appears in markets"))
    assert run(("1", "plain words about markets")) == first
    assert [h[1] for h in run(("2", "nothing of the kind here"))] == ["1"]


def lake_rows(spark, rows):
    """Typed transactions (txn_id, account, day, amount, category, version day)."""
    made = [(i, a, day and dt.datetime(2024, 1, day), x, c, "m", "x", "US", "online", False, dt.datetime(2024, 2, v)) for i, a, day, x, c, v in rows]
    return spark.createDataFrame(made, marts.TRANSACTIONS.typed_schema)


def means_of_rows(spark, root):
    kept = sorted(map(tuple, marts.read_account_means(spark, root).collect()))
    return kept, sorted(map(tuple, gold.account_means(marts.read_silver(spark, root)).collect()))


def test_account_means_follow_corrections_and_deletions(spark, tmp_path):
    root = str(tmp_path)
    first = [(str(i), f"A{i % 3}", 1 + i % 5, i + 0.25, "cd"[i % 2], 1) for i in range(60)] + [(None, "A1", 2, 7.0, "c", 1), ("x", "A9", None, 1.0, "c", 1), ("y", "A1", 3, None, "d", 1)]
    marts.refresh(lake_rows(spark, first), root)
    kept, want = means_of_rows(spark, root)
    assert kept == want and len(kept) == 7
    # Corrected, moved to another day and account, out of date, the only row of an account gone elsewhere.
    again = [("3", "A0", 4, 99.5, "d", 2), ("4", "A7", 9, 1.5, "c", 2), ("5", "A2", 1, 1000.0, "c", 0), ("x", "A0", 1, 2.0, "c", 3), ("61", "A8", 2, 3.0, "e", 1)]
    marts.refresh(lake_rows(spark, [r if r[5] else (*r[:5], 1) for r in again if r[5]]), root)
    kept, want = means_of_rows(spark, root)
    assert kept == want and "A9" not in {k[0] for k in kept}
    marts.forget_days(spark, root, [dt.date(2024, 1, 1), dt.date(2024, 1, 9), None])
    kept, want = means_of_rows(spark, root)
    assert kept == want and "A7" not in {k[0] for k in kept}
    days = {r["spend_date"].day for r in marts.read_spend_daily(spark, root).collect()}
    assert days == {2, 3, 4, 5} and {r["dt"].day for r in marts.read_silver(spark, root).collect()} == days
    # A deleted record can come back.
    marts.refresh(lake_rows(spark, [("4", "A7", 2, 1.5, "c", 2)]), root)
    kept, want = means_of_rows(spark, root)
    assert kept == want and "A7" in {k[0] for k in kept}


def everything(spark, root):
    return [sorted(map(str, f(spark, root).collect())) for f in (marts.read_silver, marts.read_spend_daily, marts.read_spend_by_category, marts.read_account_means)]


def test_a_failed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    marts.refresh(lake_rows(spark, [(str(i), "A", 1 + i % 3, 1.0, "c", 1) for i in range(9)]), root, batch_id=0)
    before = everything(spark, root)
    batch = lake_rows(spark, [("1", "A", 3, 5.0, "c", 2), ("20", "B", 1, 5.0, "c", 2)])
    with monkeypatch.context() as m:
        m.setattr(marts.Lake, "publish", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            marts.refresh(batch, root, batch_id=1)
    assert everything(spark, root) == before
    marts.refresh(batch, root, batch_id=1)
    after = everything(spark, root)
    assert after != before and len(after[0]) == 10
    # A replay of a published batch has nothing to do; what the failed one left behind can go.
    marts.refresh(batch, root, batch_id=1)
    assert everything(spark, root) == after
    assert marts.Lake(spark, root).vacuum(keep=1) > 0
    assert everything(spark, root) == after


def test_a_batch_reads_a_bounded_part_of_the_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(marts, "KEYS_PER_BUCKET", 40)
    read = marts.Lake.read
    seen = []

    def spy(self, table, schema, folders=None):
        out = read(self, table, schema, folders)
        seen.append((table, 0 if folders is None else out.count()))
        return out

    cost = []
    for step in range(4):
        root = str(tmp_path)
        rows = [(f"{step}-{i}", "A", 1 + (step * 7 + i) % 28, 1.0, "c", 1) for i in range(400 * 4**step if step < 3 else 1)]
        marts.refresh(lake_rows(spark, rows), root)
        seen.clear()
        with monkeypatch.context() as m:
            m.setattr(marts.Lake, "read", spy)
            marts.refresh(lake_rows(spark, [("0-1", "A", 1 + step % 2, float(step), "c", 2 + step)]), root)
        cost.append(max(n for t, n in seen if t == "keys"))
    assert max(cost) <= 3 * 40 and cost[2] <= 2 * max(cost[0], 40)
    assert marts.read_silver(spark, str(tmp_path)).count() == 400 + 1600 + 6400 + 1
    assert marts.read_silver(spark, str(tmp_path)).where("txn_id = '0-1'").count() == 1
