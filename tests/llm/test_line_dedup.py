import hashlib
import re

import duckdb

from ledgerlake.llm import line_dedup
from tests.llm.conftest import prose


def brute(rows, min_docs=10, min_chars=1):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(i if i is not None else ("text", t or ""))
    goes = {k for k, ids in held.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if key(line) not in goes]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made():
    rows = []
    for i in range(60):
        lines = [prose(i, 6), "  Subscribe NOW\t", prose(1000 + i // 12, 4), "", "É " + str(i // 9), prose(2000 + i, 3)]
        rows.append((i, "\n".join(lines[i % 3 :])))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "subscribe now"), (104, "subscribe now\n\x0b SUBSCRIBE now \n"), (105, "\r\n")]
    rows += [(200, "only here\nonly here")] * 12  # one document, whatever its rows
    rows += [(None, "no id\nshared"), (None, "no id\nshared")] + [(None, f"no id\nshared\n{i}") for i in range(9)]
    rows += [(300, "é 1\nÉ 1"), (300, "another text under the same id\nsubscribe now")]
    return rows


def test_matches_brute_force(frame):
    rows = made()
    got = rows_of(line_dedup.drop_repeated_lines(frame(rows)).select("id", "n_lines", "n_dropped", "kept"))
    assert got == brute(rows)
    assert [r for r in got if r[0] == 103] == [(103, 1, 1, "")]
    assert {r[2] for r in got if r[0] == 200} == {0}


def test_parameters(frame):
    rows = made()
    got = line_dedup.drop_repeated_lines(frame(rows), min_docs=2, min_chars=8)
    assert rows_of(got) == brute(rows, 2, 8)


def test_shuffle_joins_give_the_same(frame, spark, monkeypatch):
    rows = made()
    monkeypatch.setattr(line_dedup, "small", lambda df, *_: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(line_dedup.drop_repeated_lines(frame(rows))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hard_texts(frame, hard):
    many = "\n".join(f"line {i % 5000}" for i in range(200_000))
    blank = "a" + " " * 1_000_000 + "b\n" + " " * 1_000_000
    rows = [(i, many if i < 11 else blank) for i in range(14)]
    got = {r.id: r for r in line_dedup.drop_repeated_lines(frame(rows)).collect()}
    assert (got[3].n_lines, got[3].n_dropped, got[3].kept) == (200_000, 200_000, "")
    assert (got[12].n_lines, got[12].n_dropped, got[12].kept) == (2, 0, blank)
    want = [(r.doc_id, r.text) for r in hard.collect()]
    assert rows_of(line_dedup.drop_repeated_lines(hard)) == brute(want)
    assert line_dedup.drop_repeated_lines(hard.where("false")).count() == 0


def test_query_matches_sql(spark, frame, tmp_path):
    rows = [r for r in dict(made()).items()]
    frame(rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(line_dedup.op13_line_dedup(spark, str(tmp_path)))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(duck.execute(line_dedup.ORACLE).fetchall(), key=str)
    want = [(i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, n, d, kept in brute(rows)]
    assert got == sorted(want, key=str)
