import random

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from stratalake.llm import pigeonring

from helpers import docs, groups, words


def plain_fingerprint(text):
    ws = words(text)
    if not ws:
        return 0
    n = min(3, len(ws))
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + n]).encode(), 42) for i in range(len(ws) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_links(values, distance=2):
    return {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= distance}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_follow_their_rule():
    texts = [None, "", " \t\n", "One", "one two", "ÀB c  d\x0be", "a b c " * 70_000, "x" * 200_000, "a b a b a b"]
    assert [pigeonring.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize(("distance", "segments"), [(1, 16), (2, 4), (2, 8), (2, 16), (2, 32), (2, 64)])
def test_every_start_and_pair_of_bits_shares_a_key(spark, distance, segments):
    rng = random.Random(distance + segments)
    base = rng.getrandbits(64)
    near = {base} | {base ^ 1 << rng.randrange(64) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(20)}
    nodes = spark.createDataFrame([(signed(x),) for x in near], "bits long")
    for crowd in (1, 4, 1000):
        made = pigeonring.links(nodes, distance, segments, crowd)
        found = {(r["a"] % 2**64, r["b"] % 2**64) for r in made.collect()}
        assert {(min(p), max(p)) for p in found} == plain_links(near, distance)


def test_all_pairs_of_differing_bits_are_met(spark):
    """Two differing bits at every pair of places around the ring."""
    nodes = spark.range(1).selectExpr("explode(sequence(0, 63)) AS i").selectExpr("i", "explode(sequence(0, 63)) AS j")
    nodes = nodes.where("i <= j").select(F.expr("shiftleft(1L, i) | shiftleft(1L, j)").alias("bits"))
    nodes = nodes.unionByName(nodes.sparkSession.createDataFrame([(0,)], "bits long"))
    made = pigeonring.links(nodes)
    assert made.where("a = 0 OR b = 0").count() == 64 + 64 * 63 // 2


def test_crowded_keys_grow_with_their_nodes(spark):
    """Fingerprints that agree in 44 bits: few rows meet around each one, and no link is lost."""
    values = [x << 44 for x in random.Random(5).sample(range(1 << 14), 1500)]
    nodes = spark.createDataFrame([(signed(x),) for x in values], "bits long")
    found = pigeonring.links(nodes)
    assert {(r["a"] % 2**64, r["b"] % 2**64) for r in found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).collect()} == {
        tuple(sorted(p, key=signed)) for p in plain_links(values)
    }


def test_groups_match_all_pairs(spark):
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    rows = [(i, None if i % 11 == 0 else "" if i % 13 == 0 else f"Text {i % 40} of a few words") for i in range(100)]
    for i in range(100, 160):
        ws = base.split()
        ws[rng.randrange(400)] = f"n{i}"
        rows.append((i, " ".join(ws) if i % 3 else base.upper()))
    marks = {i: plain_fingerprint(t) for i, t in rows}
    linked = [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 2]
    expected = groups(list(marks), linked)
    made = pigeonring.clusters(docs(spark, rows, bits="x", part="y", node="z", label="l").repartition(5)).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in made} == {(i, f"{marks[i]:016x}", expected[i]) for i in marks}
    assert any(marks[i] != marks[expected[i]] for i in marks)


def test_repeated_missing_ids_and_empty_tables(spark):
    rows = [(5, "a b c d"), (5, "other words stand here"), (None, "a b c d"), (9, "A  b c d"), (None, None), (None, "all alone here now")]
    made = pigeonring.clusters(docs(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in made) == [
        ("5", "5"), ("5", "5"), ("9", "5"), ("None", "5"), ("None", "None"), ("None", "None")]
    assert pigeonring.clusters(docs(spark, [])).count() == 0


def test_exploded_keys_are_not_broadcast(spark, monkeypatch):
    """Few nodes are a small table, their keys are not: a middling table must not go through the driver."""
    plans = []
    plain = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a: (plans.append(self._df), plain(self, path, *a))[1])
    nodes = spark.range(3000).select(F.xxhash64("id").alias("bits"))
    plans.append(pigeonring.links(nodes))
    rows = [(i, f"words of text {i // 2} of many") for i in range(200)]
    plans.append(pigeonring.clusters(docs(spark, rows)))
    first, direct, last = plans[0], plans[1], plans[-1]
    for frame in (first, direct, last):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
