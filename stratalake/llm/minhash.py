"""Near-duplicate documents by HyperMinHash registers, banding and exact confirmation.

A document's set holds the hashes of its word windows. One hash deals a window to one of ``REGISTERS`` buckets and
gives it a value there; the register of a bucket keeps the leading-zero count and ten mantissa bits of the least
value. Empty buckets borrow from full ones along fixed sequences. Documents with equal sets are one *node*, known
by a 128-bit key, so groups of exact copies cost one row from here on.

Five registers make a band key. Nodes with a common band key are candidates, settled in two rounds:

1. Every node meets the least node of each of its buckets. Register matches, corrected for chance collisions, give
   an estimate; pairs whose estimate is beyond five standard errors below the threshold are dropped, the rest are
   confirmed on full sets, and links are merged into components.
2. Buckets that still hold several components are settled on the windows of their nodes. A node of whose windows
   more than the threshold allows occur in no other such node can have no link. Of the others, two nodes of
   different components are paired if they share rare windows and enough of them, or if frequent windows alone
   could link them (:func:`_rare_pairs`, :func:`_covered_pairs`); every possible link is one or the other. Before
   that, nodes meet the best covered node of their bucket, which merges most of a large group of near copies.

So a bucket of copies costs rows in proportion to its members, and no link between candidates is lost: pairs that
are never compared already share a component. Band recall at similarity 0.8 is 1 - (1 - 0.8**5)**32 = 0.999997.

Null and empty texts have an empty set and no links. A null id never becomes the id of a component that has
others. Rows that share an id and a text are judged alike.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import bitmaps, wordhash
from stratalake.llm.components import components
from stratalake.session import scratch

REGISTERS = 160
BAND = 5
BANDS = REGISTERS // BAND
MANTISSA = 10

#: Pairs are confirmed by 100 * common >= PERCENT * together, where together is both sizes less what is common.
PERCENT = 80

#: Estimates this far below the threshold rule a link out: five standard errors of 160 registers at 0.8.
MARGIN = 0.16

#: Windows with so many open nodes count as frequent in the second round; any number gives the same links.
FREQUENT = 64

_BORROW = np.random.default_rng(7).integers(0, REGISTERS, (64, REGISTERS))
_BAND_KEYS = np.random.default_rng(8).integers(1, 1 << 63, (BANDS, BAND), dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct window hashes of every text, and where each text's begin.

    Words are runs of bytes other than white space, A-Z lower-cased; a text of fewer words is one window.
    """
    data, offsets = wordhash.buffer(column)
    words, before, _, _ = wordhash.hash_words(data, offsets, ~wordhash.SPACES)
    values, at = wordhash.windows(words, before, width)
    counts = np.diff(before)
    row = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        single = [wordhash.sequence_hash(words[before[i] : before[i + 1]]) for i in short]
        values = np.concatenate([values, np.array(single, np.uint64)])
        row = np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        values, row = values[order], row[order]
    starts = np.searchsorted(row, np.arange(len(counts) + 1))
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    row = row[fresh]
    return values[fresh], np.searchsorted(row, np.arange(len(counts) + 1))


def registers(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted sets, one row of 16-bit numbers per set; empty sets give zeros."""
    rows = len(starts) - 1
    row = np.repeat(np.arange(rows), np.diff(starts))
    low, high = values & np.uint64(0xFFFFFFFF), values >> np.uint64(32)
    count = np.uint64(REGISTERS)
    bucket = ((high * count + ((low * count) >> np.uint64(32))) >> np.uint64(32)).astype(np.int64)
    value = values * count  # what is left of the hash below its bucket, over all 64 bits
    least = np.ones(len(values), bool)
    least[1:] = (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])
    value = value[least] | np.uint64(1)
    exponent = np.frexp(value.astype(np.float64))[1]
    exponent -= (np.uint64(1) << np.minimum(exponent - 1, 63).astype(np.uint64)) > value  # rounding in the float
    zeros = np.minimum(64 - exponent, 62).astype(np.uint64)
    mantissa = (value << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros((rows, REGISTERS), np.uint16)
    full = np.zeros((rows, REGISTERS), bool)
    out[row[least], bucket[least]] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    full[row[least], bucket[least]] = True
    todo = np.flatnonzero(full.any(1) & ~full.all(1))
    open_ = ~full[todo]
    filled = out[todo].copy()
    for step in _BORROW:
        if not open_.any():
            break
        lends = full[todo][:, step] & open_
        filled[lends] = out[todo][:, step][lends]
        open_ &= ~lends
    for k in np.flatnonzero(open_.any(1)):  # very few full buckets: the next one to the right
        own = np.flatnonzero(full[todo[k]])
        gaps = np.flatnonzero(open_[k])
        filled[k, gaps] = out[todo[k], own[np.searchsorted(own, gaps) % len(own)]]
    out[todo] = filled
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = regs.reshape(len(regs), BANDS, BAND).astype(np.uint64) + np.uint64(1)
    return wordhash.mix((parts * _BAND_KEYS).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def chance_collisions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How often registers of unrelated sets of these sizes agree: same leading zeros, same mantissa."""
    zeros = np.arange(63)

    def shares(size: np.ndarray) -> np.ndarray:
        fill = np.maximum(size, 1)[:, None] / REGISTERS
        fill = fill / -np.expm1(-fill)  # of full buckets
        return np.exp(-fill * 2.0 ** -(zeros + 1)) - np.exp(-fill * 2.0**-zeros)

    return (shares(left) * shares(right)).sum(1) / (1 << MANTISSA)


def estimates(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of register rows."""
    chance = chance_collisions(left_size, right_size)
    return np.maximum(0, ((left == right).mean(1) - chance) / (1 - chance))


def sketches(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``doc``, ``n_shingles``, ``node`` (null for an empty set) and ``regs`` of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in (part for whole in batches for part in wordhash.slices(whole, 1)):
            values, starts = shingle_sets(batch.column(1), width)
            sizes = np.diff(starts)
            regs = registers(values, starts)
            nodes = [
                hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(starts[:-1], starts[1:], strict=True)
            ]
            blob = [r.tobytes() if n else None for r, n in zip(regs, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(blob, pa.binary())],
                names=["doc", "n_shingles", "node", "regs"],
            )

    return docs.select(key, text).mapInArrow(run, f"doc {kind}, n_shingles long, node binary, regs binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _banded(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column(1))).view(np.int64)
                offsets = pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=["node", "keys"]
                )

    listed = nodes.select("node", "regs").mapInArrow(run, "node binary, keys array<long>")
    return listed.select("node", F.explode("keys").alias("bucket"))


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose estimate leaves a link possible."""
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("regs").alias("ra"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("regs").alias("rb"))
    sized = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    both = pairs.join(left, "a").join(right, "b").where(sized).select("a", "b", "na", "nb", "ra", "rb")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3))
                likely = estimates(_matrix(batch.column(4)), _matrix(batch.column(5)), na, nb)
                keep = pa.array(likely >= PERCENT / 100 - MARGIN)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return both.mapInArrow(run, "a binary, b binary")


def _full_sets(docs: DataFrame, key: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """``node``, ``shingles`` of the wanted nodes (node, doc), made again from one of their texts.

    A fixed-size bitmap keeps most other texts out of the shuffle.
    """
    schema = f"doc {docs.schema[key].dataType.simpleString()}, mark long, text string"
    marked = docs.select(F.col(key).alias("doc"), F.xxhash64(key).alias("mark"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps.build(wanted.select(F.xxhash64("doc").alias("m")), "m"))

    def pick(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(bitmaps.contains(bits, batch.column(1).to_numpy())))

    def shingles(batches):
        for batch in (part for whole in batches for part in wordhash.slices(whole, 1)):
            values, starts = shingle_sets(batch.column(1), width)
            hit = [
                hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() == n
                for a, b, n in zip(starts[:-1], starts[1:], batch.column(0).to_pylist(), strict=True)
            ]
            sets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["node", "shingles"]).filter(pa.array(hit))

    picked = marked.mapInArrow(pick, schema).drop("mark")
    found = wanted.join(picked, wanted["doc"].eqNullSafe(picked["doc"])).select("node", "text")
    # several rows with one id and one text would repeat a node
    return found.mapInArrow(shingles, "node binary, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return both.where((100 + PERCENT) * F.col("common") >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def clusters(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """Per row: ``doc``, ``n_shingles``, ``component_id`` (least id reachable) and ``kept`` (it is its own)."""
    spark = docs.sparkSession
    folder = scratch(spark, "minhash")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = stored(sketches(docs, key, text, width), "rows")
    nodes = stored(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc").alias("doc"), F.max("n_shingles").alias("n_shingles"), F.max("regs").alias("regs")),
        "nodes",
    )
    banded = _banded(nodes)
    hubs = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("far")).where("hub < far")
    # members of buckets with two nodes or more
    shared = stored(banded.join(hubs.drop("far"), "bucket"), "shared")
    star = shared.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    likely = stored(_estimated(star, nodes), "likely")
    ends = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(_full_sets(docs, key, text, width, ends.join(nodes.select("node", "doc"), "node")), "sets")
    links = stored(_confirmed(likely, sets), "links")
    labels = components(links)

    named = shared.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    mixed = _mixed(named)
    open_nodes = stored(mixed.select("node").distinct(), "open")
    open_sets = stored(
        _full_sets(docs, key, text, width, open_nodes.join(nodes.select("node", "doc"), "node")), "open_sets"
    )
    lone = (
        open_sets.select(F.xxhash64("node").alias("mark"), F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("mark").alias("mark"), F.max("mark").alias("last"))
        .where("mark = last")
        .groupBy("mark")
        .agg(F.count(F.lit(1)).alias("lone"))
    )
    size = F.size("shingles")
    live = (
        open_sets.withColumn("mark", F.xxhash64("node"))
        .join(lone, "mark", "left")
        .where(100 * (size - F.coalesce("lone", F.lit(0))) >= PERCENT * size)
        .select("node", size.alias("n"))
    )
    again = stored(_mixed(mixed.join(live, "node")), "again")
    members = again.select("node", "label", "n").distinct()
    ranked = stored(_ranked(members.join(open_sets, "node")), "ranked")
    central = stored(_central_pairs(again, ranked), "central")
    links = links.unionByName(stored(_confirmed(_estimated(central, nodes), open_sets), "central_links"))
    labels = components(links)

    def renamed(df: DataFrame) -> DataFrame:
        new = df.drop("label").join(labels, "node", "left")
        return new.withColumn("label", F.coalesce("label", "node"))

    ranked = stored(renamed(ranked), "named")
    crossed = stored(_rare_pairs(ranked).unionByName(_covered_pairs(renamed(again), ranked)).distinct(), "crossed")
    labels = components(links.unionByName(_confirmed(_estimated(crossed, nodes), open_sets)))

    owned = rows.drop("regs").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = owned.where("label IS NOT NULL").groupBy("label").agg(F.min("doc").alias("least"))
    least_or_own: Column = F.when(F.col("label").isNull(), F.col("doc")).otherwise(F.col("least"))
    return owned.join(least, "label", "left").select(
        "doc",
        "n_shingles",
        least_or_own.alias("component_id"),
        F.col("doc").eqNullSafe(least_or_own).alias("kept"),
    )


def _ranked(sets: DataFrame) -> DataFrame:
    """Per node (node, label, n, shingles): ``covered``, its number of frequent windows, and its rare ones, ``ranked``.

    A window is frequent with ``FREQUENT`` nodes or more. Rare windows count only if nodes of different components
    have them; they come as (members, shingle), rarest first.
    """
    rows = sets.select("node", "label", "n", F.explode("shingles").alias("shingle"))
    mark = F.xxhash64("label")
    known = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("members"), F.min(mark).alias("low"), F.max(mark).alias("high")
    )
    known = known.where((F.col("members") >= FREQUENT) | (F.col("low") < F.col("high"))).select("shingle", "members")
    rare = F.when(F.col("members") < FREQUENT, F.struct("members", "shingle"))
    return (
        rows.join(known, "shingle")
        .groupBy("node", "label", "n")
        .agg(F.count_if(F.col("members") >= FREQUENT).alias("covered"), F.sort_array(F.collect_list(rare)).alias("ranked"))
    )


def _rare_pairs(ranked: DataFrame) -> DataFrame:
    """Pairs of different components that share a rare window, as far as they can be linked.

    Linked sets x and y, x no larger, have at least 2 PERCENT / (100 + PERCENT) of x in common. What of it x's frequent
    windows cannot give, ``need``, must be shared rare windows; of ``k`` rare windows of x one of the
    ``k - need + 1`` rarest is then among them. A rare window has fewer than ``FREQUENT`` nodes, so rows grow in
    proportion to windows.
    """
    least = F.ceil(2 * PERCENT * F.col("n") / (100 + PERCENT))
    need = F.greatest(F.lit(1), least - F.col("covered")).cast("int")
    probes = ranked.withColumn("need", need).where("size(ranked) >= need")
    probes = probes.select("node", "label", "n", F.explode(F.expr("slice(ranked, 1, size(ranked) - need + 1)")).alias("r"))
    probes = probes.select("node", "label", "n", F.col("r.shingle").alias("shingle"))
    others = ranked.select(
        F.col("node").alias("y"), F.col("label").alias("other"), F.col("n").alias("ny"), F.explode("ranked").alias("r")
    ).select("y", "other", "ny", F.col("r.shingle").alias("shingle"))
    fits = (F.col("label") != F.col("other")) & (F.col("ny") >= F.col("n")) & (100 * F.col("n") >= PERCENT * F.col("ny"))
    met = probes.join(others, "shingle").where(fits)
    return met.select(F.least("node", "y").alias("a"), F.greatest("node", "y").alias("b"))


def _central_pairs(members: DataFrame, ranked: DataFrame) -> DataFrame:
    """Every node with the node of its bucket that frequent windows cover best, if they alone could link the two.

    Copies with few changes of their own meet this way and become one component before pairs are looked for.
    """
    known = members.join(ranked.select("node", "covered"), "node")
    best = known.groupBy("bucket").agg(F.max(F.struct("covered", "node", "label", "n")).alias("best"))
    low = F.least("covered", "best.covered")
    enough = (100 + PERCENT) * low >= PERCENT * (F.col("n") + F.col("best.n"))
    met = known.join(best, "bucket").where((F.col("label") != F.col("best.label")) & enough)
    return met.select(F.least("node", "best.node").alias("a"), F.greatest("node", "best.node").alias("b")).distinct()


def _covered_pairs(members: DataFrame, ranked: DataFrame) -> DataFrame:
    """Pairs of a bucket, of different components, that frequent windows alone could link."""
    known = members.join(ranked.select("node", "covered"), "node")
    a, b = known.alias("a"), known.alias("b")
    enough = (100 + PERCENT) * F.least("a.covered", "b.covered") >= PERCENT * (F.col("a.n") + F.col("b.n"))
    met = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.label") < F.col("b.label")) & enough)
    return met.select(
        F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    )


def _mixed(named: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    several = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return named.join(several.select("bucket"), "bucket")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """One row of each group of near-duplicates, unchanged: those with the group's least id (null last), then text hash.

    Rows are told apart by id and text, so different texts under one id, or without one, keep their rows; rows equal in
    both are one document and stay or go together.
    """
    name = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.xxhash64(text).alias("mark"))
    named = docs.select(name.alias("row"), F.col(text).alias("text"))
    dropped = clusters(named, "row", "text", width).where("NOT kept").select(F.col("doc").alias("dropped")).distinct()
    same = docs[key].eqNullSafe(F.col("dropped.id")) & (F.xxhash64(docs[text]) == F.col("dropped.mark"))
    return docs.join(dropped, same, "left_anti")


#: The query over ``documents`` for DuckDB: all pairs with a common window, and everything reachable.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles FROM w),
u AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN c ON s.doc_id = c.doc_id
"""
