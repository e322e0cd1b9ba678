import time
import hashlib
import random
import re

from pyspark.sql import functions as F

from ledgerlake.llm import pii

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for no, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), no, m.end()))
    return sorted(out)


def test_base_spans_by_brute_force(spark, hard, tmp_path):
    random.seed(4)
    parts = ["a", ".", "@", "1", "22", " ", "-", "+", "(", ")", "é", "😀", "\n", "255", "4111111111111111", "a@b.c", "1.2.3.4", "+1 (555) 123-4567", "_"]
    rows = [(100 + i, "".join(random.choices(parts, k=random.choice([2, 8, 40]))), "", "", 0, 0.0, 0, "", "") for i in range(400)]
    rows += [(n, t, "", "", 0, 0.0, 0, "", "") for n, t in ((900, "1" * 50_000), (901, "1 " * 5_000), (902, "a@b.co " * 3_000), (903, "." * 3_000 + "@"))]
    docs = hard.unionByName(spark.createDataFrame(rows, hard.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op2_pii(spark, str(tmp_path)).collect()
    want = {}
    for r in docs.collect():
        spans = base(r.text)
        names = ",".join(f"{PLAIN[k][0]}:{a}:{b}" for a, k, b in spans)
        counts = tuple(sum(k == n for _, k, _ in spans) for n in range(4))
        want.setdefault(r.doc_id, set()).add((*counts, hashlib.sha256(names.encode()).hexdigest()))
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) in want[r.doc_id]


def test_context_finds_what_no_base_pattern_does(frame):
    def card(n):
        for c in range(10):
            if luhn(f"{n:015d}{c}"):
                return f"{n:015d}{c}", f"{n:015d}{(c + 1) % 10}"

    rows = [(i, f"please charge card {card(4_000_000 + 37 * i)[0]} before friday {i}") for i in range(40)]
    rows += [(100, f"please charge card {card(77)[1]} before friday"), (101, f"serial {card(78)[1]} of the part")]
    got = {r.k_id: r for r in pii.personal_data(frame(rows)).collect()}
    at = rows[40][1].index(card(77)[1])
    assert [(s.start, s.end, s.no) for s in got[100].added] == [(at, at + 16, len(pii.KINDS) + 2)]
    assert not got[101].added and all(len(got[i].spans) == 1 and not got[i].added for i in range(40))


def test_masking_and_running_sums(spark):
    df = spark.createDataFrame([("ab é😀 cdef", [(1, 0, 4), (3, 2, 5), (7, 1, 8)]), ("xy", [])], "t string, s array<struct<start:int,no:int,end:int>>")
    assert [r[0] for r in df.select(pii.masked(F.col("t"), F.col("s"))).collect()] == ["a<EMAIL> c<IP>ef", "xy"]
    for n in (0, 1, 2, 5, 50):
        got = spark.range(1).select(pii.running_sums(F.array(*[F.lit(i * i) for i in range(n)]).cast("array<int>"))).first()[0]
        assert got == [sum(i * i for i in range(k)) for k in range(n)]


def test_no_rows(hard):
    assert pii.personal_data(hard.where("false")).count() == 0


def test_native_plan(frame):
    plan = pii.personal_data(frame([(1, "a@b.co")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_long_runs_take_linear_time(frame):
    run = "x" * 1_000_000
    rows = [(1, f"{run} jane@mail.example.com {run}"), (2, f"{run}@{run}.com"), (3, f"5a {run} 6b {'y ' * 300_000} 7c"), (4, f"a@b.cc_d@e.ff%g@h.ii.{run}")]
    start = time.monotonic()
    got = {r.k_id: [(s.start, s.end) for s in r.spans if s.no == 0] for r in pii.personal_data(frame(rows)).collect()}
    assert time.monotonic() - start < 90
    whole = {i: [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)] for i, t in rows if i in (2, 4)}
    assert got[1] == [(1_000_001, 1_000_022)] and got[2] == whole[2] and got[4] == whole[4] and got[3] == []
