from ledgerlake.llm import decontaminate as dec
from tests.llm.conftest import prose, split_words


def brute_tiles(text, item, k):
    """Greedy string tiling by its definition: longest free match first, the leftmost at a tie."""
    marked_t, marked_i, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for a in range(len(text)):
            for p in range(len(item)):
                n = 0
                while a + n < len(text) and p + n < len(item) and text[a + n] == item[p + n] and a + n not in marked_t and p + n not in marked_i:
                    n += 1
                best = max(best, (n, -a, -p))
        n, a, p = best[0], -best[1], -best[2]
        if n < k:
            return sorted(out)
        out.append((a, p, n))
        marked_t |= set(range(a, a + n))
        marked_i |= set(range(p, p + n))


def test_against_brute_force(spark, frame):
    items = [(i, prose(50 + i, 30)) for i in range(4)] + [(10, "one two"), (11, ""), (12, None), (None, prose(3, 20))]
    w = items[0][1].split()
    rows = [
        (1, prose(1, 40) + " " + items[0][1].upper() + " " + prose(2, 20)),
        (2, " ".join(w[15:] + ["gap"] + w[:15])),  # another order
        (3, " ".join(w[:12])),  # too little
        (4, " ".join(w[:10] + ["gap"] + w[10:20] + w[:10])),
        (5, "say ONE two three"), (6, prose(9, 60)), (7, None), (8, ""), (None, items[1][1]), (2, " ".join(w[15:] + ["gap"] + w[:15])),
        (9, " ".join([items[2][1]] * 40)), (9, items[3][1]),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.k_id, r.item_id): (r.coverage, sorted(map(tuple, r.tiles))) for r in dec.contaminated(frame(rows), bench).collect()}
    want = {}
    for i, t in rows:
        for item, text in items:
            b = split_words(text)
            if item is None or not b:
                continue
            tiles = brute_tiles(split_words(t), b, min(dec.MIN_MATCH, len(b)))
            share = sum(n for _, _, n in tiles) / len(b)
            if share >= dec.THRESHOLD:
                want[i, item] = share, tiles
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert got == want
    assert (2, 0) in got and (3, 0) not in got


def test_blocks_of_items_give_the_same(spark, frame, monkeypatch):
    items = spark.createDataFrame([(i, prose(50 + i, 20)) for i in range(12)], "item_id long, text string")
    docs = frame([(i, prose(i, 10) + " " + prose(50 + i, 20)) for i in range(12)])
    one = sorted(map(str, dec.contaminated(docs, items).collect()))
    monkeypatch.setattr(dec, "SEED_LIMIT", 64)
    assert sorted(map(str, dec.contaminated(docs, items).collect())) == one and len(one) == 12


def test_empty_tables(spark, hard):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dec.contaminated(hard, none).count() == 0
    assert dec.contaminated(hard.where("false"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
