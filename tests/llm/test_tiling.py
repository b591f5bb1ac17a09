import random

import numpy as np

from helpers import docs
from stratalake.llm import bitmaps, tiling


def plain_tiles(item, doc, least):
    """Covered items by the textbook: all starts, longest first, until nothing of the least length is left."""
    used_item, used_doc, covered = set(), set(), 0
    while True:
        best, found = least - 1, []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and i + n not in used_item and j + n not in used_doc
                ):
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best and n >= least:
                    found.append((i, j))
        if best < least:
            return covered
        for i, j in found:
            if not (used_item & set(range(i, i + best)) or used_doc & set(range(j, j + best))):
                used_item |= set(range(i, i + best))
                used_doc |= set(range(j, j + best))
                covered += best


def test_tiles_are_the_greedy_ones():
    rng = random.Random(1)
    for _ in range(150):
        item = [rng.randint(1, 4) for _ in range(rng.randint(3, 40))]
        doc = [rng.randint(1, 4) for _ in range(rng.randint(3, 60))]
        got = tiling.tiles(np.array(item, np.int64), np.array(doc, np.int64), 3)
        assert sum(n for _, _, n in got) == plain_tiles(item, doc, 3)
        assert all(item[i : i + n] == doc[j : j + n] for i, j, n in got)


def test_bitmap_holds_all_values(spark):
    values = [0, 1, 32767, 32768, 32769, -1, 2**62, bitmaps.BITS, bitmaps.BITS - 1]
    made = np.frombuffer(bitmaps.build(spark.createDataFrame([(v,) for v in values], "v long"), "v"), np.uint8)
    assert bitmaps.contains(made, np.array(values)).all()
    assert bitmaps.contains(made, np.arange(2, 32000)).sum() == 0


def test_passages_in_any_order(spark):
    rng = random.Random(2)
    item = [f"w{rng.randrange(5000)}" for _ in range(40)]
    other = [f"z{rng.randrange(5000)}" for _ in range(300)]
    halves = item[20:] + other[:30] + item[:20]
    touched = list(item)
    touched[10] = touched[25] = "changed"
    rows = [
        (1, " ".join(other[:100] + item + other[100:])), (2, " ".join(other[:50] + halves)), (3, " ".join(touched).upper() + "!"),
        (4, " ".join(other)), (5, " ".join(item[:12] + other)), (6, None), (7, ""), (None, ", ".join(item)), (8, " ".join(item[:4])),
        (1, " ".join(other)),
    ]
    table = docs(spark, rows, part="clash", seeds="clash", item_id="clash")
    bench = spark.createDataFrame([(7, " ".join(item)), (3, " ".join(item)), (1, "too short"), (2, None), (4, "")], "item_id long, text string")
    got = tiling.judge(table, bench).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["best_item"], round(r["best_coverage"], 3), r["contaminated"]) for r in got if r["doc_id"] != 1}
    # two texts under one id are judged apart
    assert sorted((r["best_coverage"], r["contaminated"]) for r in got if r["doc_id"] == 1) == [(0.0, False), (1.0, True)]
    assert by[2] == (3, 1.0, True) and by[None] == (3, 1.0, True)
    assert by[3] == (3, 0.95, True) and by[5] == (3, 0.3, False)
    assert all(by[i] == (None, 0.0, False) for i in (4, 6, 7, 8))
    left = tiling.decontaminate(table, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4, 5, 6, 7, 8] and left.columns == table.columns
    assert tiling.judge(table, bench.limit(0)).where("contaminated").count() == 0
    assert tiling.judge(table.limit(0), bench).count() == 0


def test_query_against_substring_search(spark, sf_dir):
    from stratalake.llm.queries import QUERIES

    texts = {r["doc_id"]: " ".join((r["text"] or "").split()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    whole = {i for i, t in texts.items() if any(x in t for x in items)}
    got = {r["doc_id"]: r for r in QUERIES["op9_decontamination"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys() and whole
    assert {i for i, r in got.items() if r["best_coverage"] == 1.0} >= whole


def test_items_of_all_lengths_inside_a_document():
    rng = random.Random(8)
    for size in (64, 65, 100, 128, 129, 1000):
        item = [rng.randint(1, 10**6) for _ in range(size)]
        doc = [rng.randint(1, 10**6) for _ in range(200)]
        got = tiling.tiles(np.array(item, np.int64), np.array(doc[:100] + item + doc[100:], np.int64), 5)
        assert got == [(0, 100, size)]
        half = size // 2
        got = tiling.tiles(np.array(item, np.int64), np.array(item[half:] + doc + item[:half], np.int64), 5)
        assert sum(n for _, _, n in got) == size


def test_repeated_words_and_very_long_documents():
    rng = random.Random(9)
    for item, doc in (([1] * 60, [1] * 150), ([1, 2] * 20, [2, 1] * 60), ([1] * 30 + [2] * 30, [2] * 40 + [1] * 70)):
        got = tiling.tiles(np.array(item, np.int64), np.array(doc, np.int64), 5)
        assert sum(n for _, _, n in got) == plain_tiles(item, doc, 5)
    item = [rng.randint(1, 50) for _ in range(300)]
    long = np.array([rng.randint(1, 50) for _ in range(100_000)] + item + [7] * 100_000, np.int64)
    assert sum(n for _, _, n in tiling.tiles(np.array(item, np.int64), long, 5)) == 300
    assert sum(n for _, _, n in tiling.tiles(np.full(1000, 7), long, 5)) == 1000


def test_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(10)
    item = " ".join(f"w{rng.randrange(5000)}" for _ in range(120))
    clean = " ".join(f"z{rng.randrange(5000)}" for _ in range(120))
    table = docs(spark, [(None, item), (None, clean), (None, None), (4, f"{clean} {item}"), (4, clean), (4, clean)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = tiling.decontaminate(table, bench).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left) == [("4", clean)] * 2 + [("None", "None"), ("None", clean)]


def test_pairs_that_cannot_cover_enough_are_not_tiled(spark):
    rng = random.Random(11)
    item = [f"w{rng.randrange(5000)}" for _ in range(50)]
    table = docs(spark, [(i, " ".join(item[:n])) for i, n in enumerate((5, 9, 29, 30, 31, 50))])
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    every = {r["doc"]: r["covered"] for r in tiling.coverages(table, bench).collect()}
    some = {r["doc"]: r["covered"] for r in tiling.coverages(table, bench, least=0.6).collect()}
    assert every == {i: n / 50 for i, n in enumerate((5, 9, 29, 30, 31, 50))}
    assert some.keys() < every.keys() and {i for i, c in every.items() if c >= 0.6} <= some.keys()
