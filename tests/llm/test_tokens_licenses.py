import base64

import numpy as np
import public_tokenizers
import tiktoken

from ledgerlake.llm import licenses, tokens
from tests.llm.conftest import prose


def test_blocks_stitch(spark, tmp_path):
    def flat(name, ids):
        np.array(ids, "<u2").tofile(tmp_path / name)
        return str(tmp_path / name), len(ids)

    files = [flat("a", [1, 2, 9, 9, 3, 4, 5, 9, 7]), flat("b", []), flat("c", [9]), flat("d", [1] * 11), flat("e", [1, 9] * 3)]
    df = spark.createDataFrame(files, "path string, n_ids long")
    want = [("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 3, True), ("a", 3, 8, 1, False), ("c", 0, 0, 0, True), ("d", 0, 0, 11, False)]
    want += [("e", i, 2 * i, 1, True) for i in range(3)]
    for size in (1, 2, 3, 4, 100):
        got = sorted((r.path[-1], r.document, r.start, r.n_tokens, r.closed) for r in tokens.scan(df, 9, 2, size).collect())
        assert got == want
    assert tokens.scan(df.where("false"), 9).count() == 0


def test_counts_of_texts(spark, hard, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 1000)
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id is None, r.doc_id or 0, len(own.encode_ordinary(r.text or ""))) for r in hard.collect())
    got = tokens.op4_token_counts(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == want and all(r.closed for r in got)


def test_long_runs(spark, frame, monkeypatch):
    monkeypatch.setattr(tokens, "PLACES", 2)
    encoder = tokens._encoder(tokens.ranks(spark))
    texts = [f"a{b * 5000}{c}" for b in (" ", "\n", "\t ", "\u3000", "\xa0 ") for c in ("", "b", "\x1c", " 9", "\n!")] + [" " * 4096, "\n" * 9000 + "x" + " " * 4095 + "y"]
    for t in texts:
        assert tokens.encoded(encoder, t) == encoder.encode_ordinary(t)
    rows = [(i, t) for i, t in enumerate(["a" + " " * 5_000_000 + "b", "\n" * 5_000_000, "x" * 1_000_000, *texts])]
    got = {}
    files = tokens.write(frame(rows))
    counts = tokens.scan(files.where("n_ids is not null").select("path", "n_ids"), block_ids=1 << 16)
    for r in files.collect():
        got |= {(r.path, r.first + i): d for i, d in enumerate(r.ids)}
    counts = {got[r.path, r.document]: r.n_tokens for r in counts.collect()}
    assert counts[0] == 1 + 4_999_999 + 1 and counts[1] == 2_500_000
    assert {i: counts[i + 3] for i in range(len(texts))} == {i: len(encoder.encode_ordinary(t)) for i, t in enumerate(texts)}


def contained(text, template):
    a, b = (set(licenses.shingles(licenses.plain_words(t))) for t in (text or "", template))
    return bool(b) and len(a & b) >= licenses.CONTAINMENT * len(b)


def test_licenses_by_brute_force(frame, hard):
    t = licenses.TEMPLATES
    rows = [(1000 + i, f"{prose(i, i * 3)}\n{text.upper() if i % 2 else text} {prose(99 - i, 40)}") for i, text in enumerate(t.values())]
    words = t["BSD-grant"].split()
    rows += [(2000, " ".join(words[:-1])), (2001, " ".join(words[:8])), (2002, "released under the mit license " * 50), (2003, "licensed in compliance")]
    docs = hard.unionByName(frame(rows))
    got = {(r.k_id, r.license) for r in licenses.license_matches(docs).collect()}
    assert got == {(r.doc_id, name) for r in docs.collect() for name, text in t.items() if contained(r.text, text)}
    assert {(1000 + i, name) for i, name in enumerate(t)} <= got
    assert licenses.license_matches(docs, {}).count() == 0 and licenses.license_matches(docs.where("false")).count() == 0


def test_inserted_words_at_every_offset(frame):
    t = licenses.TEMPLATES
    rows = []
    for name in ("Apache-2.0-header", "GPL-header", "MIT-grant"):
        words = t[name].split()
        for i in range(32):
            for at, more in ((10 + i % 9, 10), (15, 400), (15, 0)):
                inside = [*words[:at], *prose(i, more).split(), *words[at:]]
                rows.append((len(rows), f"{prose(i + 100, i)} {' '.join(inside)} {prose(i + 200, 60)}"))
    got = {(r.k_id, r.license): r for r in licenses.license_matches(frame(rows)).collect()}
    assert set(got) == {(i, name) for i, text in rows for name, template in t.items() if contained(text, template)}
    assert len({i for i, _ in got}) == len(rows)
    for (i, name), r in got.items():
        a, b = (set(licenses.shingles(licenses.plain_words(x))) for x in (rows[i][1], t[name]))
        assert abs(r.containment - len(a & b) / len(b)) < 1e-9


def test_native_plan(frame):
    import re

    assert not re.search("Python|Arrow|Pandas", licenses.license_matches(frame([(1, "a")]))._jdf.queryExecution().toString())
