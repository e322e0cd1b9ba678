from pyspark.sql import functions as F

import corpus_pipeline as cp
from ledgerlake.llm.common import stored
from tests.llm.conftest import prose
from tests.llm.test_jaccard import brute


def test_stages(spark, hard, frame, tmp_path):
    item = prose(500, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(i, int(i % 5 == 0)) for i in range(3000, 3300)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, prose(i, 60) + (" you pathetic idiot you worthless clown" if i % 5 == 0 else "")) for i in range(3000, 3300)]
    rows += [(4000, prose(1, 50) + " " + item), (4001, prose(2, 60) + " mail to jane.doe@mail.example.com now"), (4002, rows[1][1])]
    docs = hard.unionByName(frame(rows)).withColumnRenamed("id", "row_")
    kept = {}
    for name, stage in cp.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        kept[name] = docs
        assert name == "bpe" or docs.columns == columns
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in kept.items()}
    assert not [i for i in ids["toxicity"] if i and 3000 <= i < 3300 and i % 5 == 0] and 3001 in ids["toxicity"]
    before = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    roots = brute(before)
    assert sorted(i for i in ids["near_duplicates"] if i is not None) == sorted(i for i, root in roots.items() if i == root)
    assert ids["near_duplicates"].count(None) == 1
    assert 4000 in ids["near_duplicates"] and 4000 not in ids["decontamination"]
    assert len(ids["decontamination"]) == len(ids["near_duplicates"]) - 1
    masked = {r.doc_id: (r.text, r.n_chars) for r in kept["personal_data"].collect()}
    assert "<EMAIL>" in masked[4001][0] and "@" not in masked[4001][0] and masked[4001][1] == len(masked[4001][0])
    assert masked[0] == (None, 0) and masked[1][0] == ""
    assert sorted(map(str, ids["bpe"])) == sorted(map(str, ids["personal_data"]))


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is cp.run
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def test_contaminated_rows_and_items_without_an_id(spark, frame, tmp_path):
    items = [(1, prose(61, 30)), (None, prose(62, 30)), (None, prose(63, 30)), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, items[0][1]), (None, items[1][1]), (2, f"{prose(64, 20)} {items[2][1]}"), (3, items[0][1]), (4, prose(65, 60)), (None, prose(66, 60)), (None, None), (None, "")]
    got = cp.drop_contaminated(spark, frame(rows), str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows[4:], key=str)


def test_unlike_texts_under_one_id_stay(spark):
    a, b, c = prose(71, 60), prose(72, 60), prose(73, 60)
    rows = [(5, a, 1), (5, b, 2), (5, b, 1), (6, a, 3), (7, c, 4), (8, c + " more", 5), (5, c, 6), (None, a, 7), (9, None, 8), (9, None, 9), (9, "", 10), (-3, prose(74, 50), 11)]
    made = [(i, t, {"k": v}, v) for i, t, v in rows]
    docs = spark.createDataFrame(made, "doc_id long, text string, extra map<string,int>, node int")
    docs = docs.withColumn("raw", F.parse_json(F.lit('{"x": 1}')))
    kept = cp.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.extra["k"]) for r in kept.collect()), key=str)
    # a: 6 stays for 5, as a real id comes before that of a clashing text; b once, c under 7.
    want = {(6, a, 3), (5, b, 1), (7, c, 4), (None, a, 7), (-3, rows[-1][1], 11)}
    assert want <= set(got)
    assert [x for x in got if x[0] == 5] == [(5, b, 1)] and len([x for x in got if x[0] == 9]) == 1
    assert len(got) == 6


def test_no_clash_takes_the_plain_way(spark, frame):
    docs = frame([(1, prose(1, 30)), (2, prose(1, 30)), (3, prose(3, 30))])
    assert sorted(r.doc_id for r in cp.drop_near_duplicates(spark, docs, "").collect()) == [1, 3]
