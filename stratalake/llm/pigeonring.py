r"""SimHash near-duplicates by pigeonring filtering.

A text's fingerprint has 64 bits: XXH64 (seed 42) of its windows of ``WIDTH`` lower-cased words, repeats included, a bit
set where over half of the hashes have it set. Documents whose fingerprints differ in at most ``distance`` bits are
linked. Equal fingerprints are one *node*, so copies cost one row.

The bits lie on a ring of ``SEGMENTS`` segments. If two fingerprints differ in at most ``distance`` bits, some segment
starts a chain around the ring of which the first ``l`` segments differ in at most ``l * distance / SEGMENTS`` bits,
for every ``l`` (else the stretches that exceed their share would add up to more than ``distance``). The first segments
of that chain, whose budget is below one bit, are equal; of the segments after them, whose budget is below two bits,
one half is equal too. For every start these equal bits are a key: nodes that share no key are never compared. With
16 segments and two bits a key has 44 of the 64 bits, and a node has 32 keys. Pairs of a key are checked for the whole
chain, then for the distance.

A key of more than ``CROWD`` nodes pairs nobody directly. There every node is filed under itself and under each
fingerprint that differs from it in half the distance of the bits outside the key; two nodes within the distance
have such a fingerprint in common, and few nodes fit around one. So the rows grow with the nodes of a key, not with
their square, and no pair is lost. This second way takes distances up to two, the largest that is accepted.

Defined results: null and empty texts have no windows, their fingerprint is zero, and it is linked like any other.
Rows are judged one by one: repeated ids and null ids keep their rows, and a group's id is the least one that is not
null. An empty table gives an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import wordhash
from stratalake.llm.components import components
from stratalake.session import scratch

BITS = 64
WIDTH = 3
DISTANCE = 2
SEGMENTS = 16
SEED = 42
#: Nodes of a key that are paired directly.
CROWD = 32
#: Parts into which the rows of one fingerprint are dealt when they get their group.
SPREAD = 64
#: Windows hashed and counted at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """64-bit SimHash of a text's word windows."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    totals = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for a in range(0, len(first), BLOCK):
        spans = zip(first[a : a + BLOCK], last[a : a + BLOCK], strict=True)
        hashes = np.array([hashed(line[i:j], SEED) for i, j in spans], np.uint64)
        totals += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * totals > len(first), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``key`` and ``bits``, the fingerprint as a signed long, for every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=[key, "bits"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, bits long")


def _long(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def _turned(bits: Column, by: int) -> Column:
    """The ring turned so that bit ``by`` comes first (highest)."""
    return bits if by == 0 else F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, BITS - by))


def _mask(start: int, stop: int) -> int:
    """Bits ``start`` to ``stop`` from the highest one."""
    return (1 << (BITS - start)) - (1 << (BITS - stop))


def _reach(budget: int, distance: int, segments: int) -> int:
    """Segments of the longest chain that may differ in at most ``budget`` bits."""
    return max(n for n in range(segments + 1) if n * distance // segments <= budget)


def key_masks(distance: int = DISTANCE, segments: int = SEGMENTS) -> list[int]:
    """The bits, on the turned ring, that one key of a start holds: equal segments, and a half of those with one bit to spare."""
    if not 1 <= distance <= 2 or BITS % segments or segments <= distance:
        raise ValueError("distance is 1 or 2, segments divide the bits and are more than the distance")
    size = BITS // segments
    equal, spare = _reach(0, distance, segments) * size, _reach(1, distance, segments) * size
    if distance == 1:
        return [_mask(0, equal)]
    half = (equal + spare) // 2
    return [_mask(0, equal) | _mask(equal, half), _mask(0, equal) | _mask(half, spare)]


def chained(difference: Column, distance: int = DISTANCE, segments: int = SEGMENTS) -> Column:
    """Whether the first ``n`` segments of the turned difference hold at most ``n * distance / segments`` bits, for all n below ``segments``."""
    size, held = BITS // segments, F.lit(True)
    for budget in range(distance):
        n = min(_reach(budget, distance, segments), segments - 1)
        held = held & (F.bit_count(difference.bitwiseAND(_long(_mask(0, n * size)))) <= budget)
    return held


def _keys(nodes: DataFrame, distance: int, segments: int) -> DataFrame:
    """``slot`` (a start and a mask), ``key`` (the masked bits of the turned ring), ``turned`` and ``bits`` per node and slot."""
    size, masks = BITS // segments, key_masks(distance, segments)
    rows = []
    for start in range(segments):
        turned = _turned(F.col("bits"), start * size)
        for number, mask in enumerate(masks):
            slot = F.lit(start * len(masks) + number).alias("slot")
            rows.append(F.struct(slot, turned.bitwiseAND(_long(mask)).alias("key"), turned.alias("turned")))
    return nodes.select("bits", F.inline(F.array(*rows)))


def links(nodes: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """``a``, ``b``: all pairs of different ``bits`` of ``nodes`` within the distance, each at least once."""
    filed = _keys(nodes, distance, segments)
    counts = filed.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    path = scratch(nodes.sparkSession, "keys")
    # Spark sizes the rows of ``inline`` as those before it, so left alone it would broadcast all keys of a middling table
    filed.join(counts.hint("merge"), ["slot", "key"]).write.parquet(path)
    members = nodes.sparkSession.read.parquet(path)
    few = members.where(F.col("n") <= crowd).drop("n")
    x, y = few.alias("x"), few.alias("y")
    met = x.join(y.hint("merge"), (F.col("x.slot") == F.col("y.slot")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.bits") < F.col("y.bits")))
    met = met.where(chained(F.col("x.turned").bitwiseXOR(F.col("y.turned")), distance, segments))
    near = F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits"))) <= distance
    direct = met.where(near).select(F.col("x.bits").alias("a"), F.col("y.bits").alias("b"))

    # crowded keys: the least node around every fingerprint one free bit away meets all others there
    masks = key_masks(distance, segments)
    around = []
    for number, mask in enumerate(masks):
        free = [_long(1 << b) for b in range(BITS) if not mask >> b & 1]
        around.append(F.array(_long(0), *free))
    flips = F.element_at(F.array(*around), (F.col("slot") % len(masks) + 1).cast("int"))
    middles = members.where(F.col("n") > crowd).select("slot", "bits", "turned", F.explode(flips).alias("flip"))
    middles = middles.select("slot", "bits", F.col("turned").bitwiseXOR(F.col("flip")).alias("middle"))
    hubs = middles.groupBy("slot", "middle").agg(F.collect_set("bits").alias("around")).where(F.size("around") > 1)
    pairs = hubs.select("around", F.explode("around").alias("a")).select("a", F.explode("around").alias("b")).where("a < b")
    crowded = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return direct.unionByName(crowded).distinct()


def clusters(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """Per row: ``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the least id that links reach."""
    spark = docs.sparkSession
    folder = scratch(spark, "simhash")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    part = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int")
    rows = stored(fingerprints(docs, key, text, width).withColumn("part", part), "rows")
    # a hot fingerprint's rows stay apart in SPREAD parts
    parts = stored(rows.groupBy("bits", "part").agg(F.min(key).alias("least")), "parts")
    nodes = parts.groupBy("bits").agg(F.min("least").alias("least"))
    labels = components(stored(links(nodes.select("bits"), distance, segments), "links"))
    # stored columns are packed smaller than they are in memory: nothing that grows with the documents is broadcast by its file's size
    named = nodes.join(labels.hint("merge"), nodes["bits"] == labels["node"]).select("bits", "label", "least")
    groups = named.groupBy("label").agg(F.min("least").alias("component"))
    linked = named.select("bits", "label").join(groups.hint("merge"), "label").select("bits", "component")
    own = nodes.join(linked.hint("merge"), "bits", "left").select("bits", F.coalesce("component", "least").alias("component_id"))
    dealt = parts.select("bits", "part").join(own.hint("merge"), "bits")
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return rows.join(dealt.hint("merge"), ["bits", "part"]).select(key, digits.alias("fingerprint"), "component_id")
