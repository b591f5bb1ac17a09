import random

import numpy as np
import pyarrow as pa

from helpers import docs
from stratalake.llm import toxicity

RUDE = ["idiot", "vequ", "lowei", "moron"]


def corpus(rng, size):
    vocabulary = [f"w{rng.randrange(3000)}x" for _ in range(800)]
    rows, marks = [], []
    for i in range(size):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(3, 6)):
                stem = rng.choice(RUDE)
                text[rng.randrange(len(text))] = stem + (rng.choice(vocabulary)[:4] if len(stem) < 5 or stem == "lowei" else "")
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    return rows, marks


def test_learns_words_and_beginnings(spark):
    rows, marks = corpus(random.Random(1), 900)
    table, labels = docs(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(table, labels, ~toxicity.held_out())
    got = toxicity.score(table, model).withColumn("held", toxicity.held_out()).collect()
    held = [(r["score"], dict(marks)[r["doc_id"]]) for r in got if r["held"]]
    assert len(held) > 150 and all(0 <= s <= 1 for s, _ in held)
    right = sum((s >= toxicity.CUT) == bool(y) for s, y in held)
    assert right / len(held) > 0.95


def test_held_out_labels_are_not_read(spark):
    rows, marks = corpus(random.Random(2), 300)
    table = docs(spark, rows)
    import zlib

    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in marks]
    scores = []
    for m in (marks, flipped):
        labels = spark.createDataFrame(m, "doc_id long, toxic int")
        model = toxicity.fit(table, labels, ~toxicity.held_out())
        scores.append({r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()})
    assert scores[0] == scores[1]


def test_features_by_hand():
    lexicon = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    got = toxicity.features(pa.array(["AB cd! a1b 22", "", None, "x x x x"]), lexicon)
    col = {n: i for i, n in enumerate(toxicity.FEATURES)}
    assert got.shape == (4, len(toxicity.FEATURES)) and np.isfinite(got).all()
    assert got[0, col["capitals"]] == 2 / 6 and got[0, col["digits"]] == 3 / 13
    assert got[0, col["exclamations"]] == 1 / 13 and got[0, col["obfuscated"]] == 1 / 4
    assert got[3, col["repeated"]] == 0.75 and (got[1] == 0).all() and (got[2] == 0).all()


def test_rows_of_all_kinds(spark):
    rows, marks = corpus(random.Random(3), 400)
    odd = [(None, "idiot idiot idiot you"), (5000, None), (5001, ""), (1, "again"), (1, "again"), (5002, "word " * 50000)]
    table = docs(spark, rows + odd, features="clash", probability="clash", rawPrediction="clash", raw="clash")
    labels = spark.createDataFrame(marks + [(None, 1), (2, None), (3, 0), (3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(table, labels, ~toxicity.held_out())
    got = toxicity.score(table, model)
    assert got.columns == [*table.columns, "score"]
    assert got.count() == len(rows) + len(odd) and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert got.where("probability = 'clash'").count() == len(rows) + len(odd)
    assert toxicity.score(table.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0")):
        plain = toxicity.fit(table, few, ~toxicity.held_out())
        assert {r["score"] for r in toxicity.score(table, plain).select("score").collect()} == {0.0}


def test_query_ranks_held_out_documents(spark):
    from stratalake.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = QUERIES["op6_toxicity"](spark, sf_dir).collect()
    assert len(got) == 1000
    held = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good = [s for s, y in held if y]
    bad = [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.8 and all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
