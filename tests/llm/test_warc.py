import base64
import hashlib
import io
import random

from ledgerlake.llm import warc


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROLL_BYTES", 2_000)
    htmls = ["a", None, "", "a", "b", "é" * 1000, "x" * 3_000_000, "b"]
    rows = [(i, "u\r\nv", h, 1) for i, h in enumerate(htmls)] + [(None, "q", "a", 1), (None, None, "zz", 1), (3, "u", "a", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, warc.op5_warc(spark, str(tmp_path)).collect()), key=str)
    last = {}
    for i, _, h, _ in rows:
        data = (h or "").encode()
        if i is not None:
            last[data] = max(i, last.get(data, i))
    want = []
    for i, _, h, _ in rows:
        data = (h or "").encode()
        own = last.get(data, i) == i
        want.append((i, len(data), b32(data), "response" if own else "revisit", None if own else last[data]))
    assert got == sorted(want, key=str)
    full = warc.read(warc.write(pages)).where("record_type = 'response'").collect()
    assert {bytes(r.payload) for r in full} == {(h or "").encode() for _, _, h, _ in rows}
    assert warc.read(warc.write(pages.where("false"))).count() == 0


def records(n):
    random.seed(2)
    return [warc.member(warc.record(i, "u", random.randbytes(5000), None, False)) for i in range(n)]


def test_salvage(monkeypatch):
    made = records(30)
    at = [sum(map(len, made[:i])) for i in range(31)]
    data = bytearray(b"".join(made))
    data[at[3] + 2000] ^= 0xFF  # a flipped byte
    data[at[7] + 100 : at[7] + 900] = b""  # a hole
    cut = at[20] - 800
    data = bytes(data[:cut]) + b"garbage" * 100 + bytes(data[cut:]) + warc.record(99, "u", b"plain", None, False)
    tail = made[5][:300]  # a truncated last member
    for step in (1 << 20, 4096 * 3):
        monkeypatch.setattr(warc, "READ_BYTES", step)
        rows = list(warc.records("p", io.BytesIO(data + tail)))
        assert [r["page_id"] for r in rows if r["kind"] == "record"] == [i for i in range(30) if i not in (3, 7)] + [99]
        gaps = [r for r in rows if r["kind"] == "gap"]
        assert len(gaps) == 4 and all(r["reason"] for r in gaps)
        assert [r["offset"] for r in rows] == [sum(r["length"] for r in rows[:i]) for i in range(len(rows))]
        assert sum(r["length"] for r in rows) == len(data) + len(tail)


def test_a_wrong_digest_is_a_gap():
    bad = warc.record(1, "u", b"hello", None, False).replace(b"hello", b"hellp")
    rows = list(warc.records("p", io.BytesIO(warc.member(bad) + records(1)[0])))
    assert [(r["kind"], r.get("reason")) for r in rows] == [("gap", "digest differs"), ("record", None)]


def test_a_header_of_any_length(spark, tmp_path):
    urls = ["u", "data:text/html," + "a" * 100_000, "http://h/" + "b" * 3_000_000, "v" * 65_536]
    rows = [(i, u, h) for i, u in enumerate(urls) for h in (f"page {i}",)] + [(9, urls[1], "page 0")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(r.page_id for r in warc.op5_warc(spark, str(tmp_path)).collect()) == [0, 1, 2, 3, 9]
    got = warc.read(warc.write(pages)).collect()
    assert {(r.page_id, r.url) for r in got} == {(i, u) for i, u, _ in rows} and all(r.kind == "record" for r in got)


def test_a_plain_header_of_any_length(monkeypatch):
    long = [warc.record(i, "data:" + "a" * n, b"plain", None, False) for i, n in enumerate((10, 100_000, 65_400, 3_000_000))]
    cut = warc.record(7, "b" * 200_000, b"lost", None, False)[:150_000]
    for step in (64, 64 << 10):
        monkeypatch.setattr(warc, "HEADER_BYTES", step, raising=False)
        for tail in (records(1)[0], b"\r\n" + long[0], b""):
            data = b"".join(long) + cut + tail
            rows = list(warc.records("p", io.BytesIO(data)))
            assert [r.get("page_id") for r in rows] == [0, 1, 2, 3, None, *([0] if tail else [])]
            assert [r["kind"] for r in rows[:5]] == ["record"] * 4 + ["gap"] and rows[4]["reason"] == "header has no end"
            assert sum(r["length"] for r in rows) == len(data)


def test_query_matches_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    got = sorted(tuple(r) for r in warc.op5_warc(spark, sf).collect())
    assert got == sorted(duck.execute(warc.ORACLE).fetchall())
