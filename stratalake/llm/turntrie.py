"""Prefix trie of conversations, from ternary search trees over range shards.

A turn is its role and text, known by a 16-byte digest; a conversation is the bytes of its turns' digests, its *path*, so
paths sort like sequences of turns. ``shards`` deals the conversations out by ranges of (path, id), so the copies of one
conversation, or those with one first turn, spread over as many shards as they need. Every shard numbers its own turns
(its dictionary) and puts its different sequences into a ternary search tree, the middle one of each range first, which
keeps the tree balanced. Nodes are made after their parents, so one loop from the last node to the first adds up members,
leaves and savings below each node.

A prefix can lie in several shards only if it is a prefix of the last sequence of one and of the first of the next. How
far those agree is known per shard from its neighbours. All sums are made so that shards add up: a node's own text and
its place among the children of its parent count where it stands first, a leaf where it stands last. So only these
boundary nodes are merged, by the digest of their path; everything else is final in its shard. Ids that end at a boundary
node are digested as a sorted stream of pieces, which is held nowhere as a whole.

Defined results: a null role or text is empty; turns are ordered by turn, null first, and repeated turn numbers by digest;
a repeated turn counts twice. Rows without a conversation id belong to no conversation. A conversation without
turns is a member of the root and ends there. An empty table has no nodes, not even a root. A conversation is one row of 20 bytes
a turn; texts are never shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.session import scratch

#: Conversations of one family share the first turns of its first member.
FAMILY = 100
#: A conversation shares fewer turns than this.
HEADS = 6
#: Turns of a shard, about.
SHARD = 40_000
#: Ids of one piece of a list that spans shards.
PIECE = 400
#: Parts into which the children of one boundary node are dealt.
SPREAD = 32

_TOKEN = 16
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, node_key binary, parent_key binary, piece string"
)


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id``, ``turn``, the turn's ``token`` and the ``size`` of its text in code points."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said))
    return conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.unhex(digest).alias("token"), F.length(said).alias("size")).alias("t"),
    )


def _paths(sequence: Column) -> list[Column]:
    path = F.unhex(F.array_join(F.transform(sequence, lambda t: F.hex(t["token"])), ""))
    return [F.coalesce(path, F.lit(b"")).alias("path"), F.transform(sequence, lambda t: t["size"]).alias("sizes")]


def sequences(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id``, ``path`` and ``sizes`` of every conversation as it is."""
    turns = _turns(conversations, conv, turn, role, text)
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("s")).select("conv_id", *_paths(F.col("s")))


def rebuilt(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    family: int = FAMILY, heads: int = HEADS,
) -> DataFrame:
    """``sequences`` in which the first turns, crc32(id) modulo ``heads`` of them, are those of the family's first member."""
    turns = _turns(conversations, conv, turn, role, text)
    base = F.col("conv_id") - F.col("conv_id") % family
    whole = (
        turns.withColumn("base", base)
        .repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("s"))
    )
    # at most `family` conversations meet here
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("s", 1, heads - 1))).over(Window.partitionBy("base"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    known = whole.withColumn("head", F.coalesce(first, F.slice("s", 1, 0))).withColumn("h", shared)
    joined = F.concat(F.expr("slice(head, 1, h)"), F.expr("slice(s, h + 1, greatest(size(s) - h, 0))"))
    return known.select("conv_id", joined.alias("s")).select("conv_id", *_paths(F.col("s")))


def shards(sequences: DataFrame, size: int = SHARD) -> DataFrame:
    """``sequences`` with their ``shard`` and how many turns its ends share with its neighbours, ``before`` and ``after``.

    Both are -1 at the ends of all. Stored twice; per shard two sequences meet in one window.
    """
    spark = sequences.sparkSession
    folder = scratch(spark, "shards")
    sequences.select("conv_id", "path", "sizes").write.parquet(f"{folder}/sequences")
    rows = spark.read.parquet(f"{folder}/sequences")
    total = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, -(-total // size)), "path", "conv_id")
    dealt.withColumn("shard", F.spark_partition_id()).write.parquet(f"{folder}/shards")
    dealt = spark.read.schema("conv_id long, path binary, sizes array<int>, shard int").parquet(f"{folder}/shards")
    ends = dealt.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    order = Window.orderBy("shard")
    around = ends.select("shard", "low", "high", F.lag("high").over(order).alias("last"), F.lead("low").over(order).alias("next"))

    def run(batches):
        for batch in batches:
            low, high, last, following = (batch.column(i).to_pylist() for i in range(1, 5))
            before = [_common(a, b) for a, b in zip(last, low, strict=True)]
            after = [_common(a, b) for a, b in zip(high, following, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(before, pa.int32()), pa.array(after, pa.int32())], names=["shard", "before", "after"]
            )

    return dealt.join(around.mapInArrow(run, "shard int, before int, after int"), "shard")


def _common(a: bytes | None, b: bytes | None) -> int:
    """Number of turns at which two paths agree from the start; -1 without one of them."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    unequal = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(unequal[0] if len(unequal) else n) // _TOKEN


def _medians(n: int):
    """The numbers below ``n``, the middle one of each range before those around it."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            ranges += [(middle + 1, b), (a, middle)]


class SearchTree:
    """Ternary search tree over sequences of numbers; node 0 is the empty sequence."""

    def __init__(self) -> None:
        self.turn, self.size, self.parent, self.depth = [-1], [0], [-1], [0]
        self.low, self.high, self.below = [-1], [-1], [-1]

    def _add(self, turn: int, size: int, parent: int) -> int:
        self.turn.append(turn)
        self.size.append(size)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.high, self.below):
            links.append(-1)
        return len(self.turn) - 1

    def insert(self, sequence: list[int], sizes: list[int]) -> int:
        """The node of the whole sequence; missing ones are made on the way."""
        node = 0
        for turn, size in zip(sequence, sizes, strict=True):
            links, at = self.below, node
            while (child := links[at]) >= 0 and self.turn[child] != turn:
                links, at = self.low if turn < self.turn[child] else self.high, child
            if child < 0:
                child = links[at] = self._add(turn, size, node)
            node = child
        return node

    def find(self, sequence: list[int]) -> list[int]:
        """The nodes of all prefixes of an inserted sequence, from the empty one."""
        found = [0]
        for turn in sequence:
            child = self.below[found[-1]]
            while self.turn[child] != turn:
                child = self.low[child] if turn < self.turn[child] else self.high[child]
            found.append(child)
        return found


def shard_nodes(shard: pa.Table) -> pa.Table:
    """The nodes of one shard, with keys for those that may continue in another one."""
    shard = shard.take(pc.sort_indices(shard, [("path", "ascending"), ("conv_id", "ascending")])).combine_chunks()
    ids = shard["conv_id"].to_numpy()
    paths = shard["path"].to_pylist()
    sizes = shard["sizes"].to_pylist()
    before, after = shard["before"][0].as_py(), shard["after"][0].as_py()
    first = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]]
    stops = [*first[1:], len(paths)]

    # the shard's dictionary: every different digest gets a number in the order of digests
    halves = np.frombuffer(b"".join(paths[i] for i in first), ">u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), np.int64)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    cuts = np.cumsum([0] + [len(paths[i]) // _TOKEN for i in first])
    coded = [number[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    tree = SearchTree()
    ending = {}
    for k in _medians(len(first)):
        ending[tree.insert(coded[k], sizes[first[k]])] = k

    keys: dict[int, bytes] = {}
    for k, shared in ((0, before), (len(first) - 1, after)):
        digest = hashlib.blake2b(digest_size=_TOKEN)
        for d, node in enumerate(tree.find(coded[k])[: shared + 1]):
            if d:
                digest.update(paths[first[k]][_TOKEN * (d - 1) : _TOKEN * d])
            keys[node] = digest.copy().digest()
    earlier = set(tree.find(coded[0])[: before + 1])
    later = set(tree.find(coded[-1])[: after + 1])

    count = len(tree.turn)
    members, least, leaves, saved, children, inner = ([0] * count for _ in range(6))
    for node in range(count - 1, -1, -1):
        k = ending.get(node)
        if k is not None:
            # the ids of equal sequences are sorted
            members[node] += stops[k] - first[k]
            own = int(ids[first[k]])
            least[node] = min(least[node], own) if inner[node] else own
        leaves[node] += not inner[node] and node not in later
        saved[node] += tree.size[node] * (members[node] - (node not in earlier))
        parent = tree.parent[node]
        if parent >= 0:
            least[parent] = min(least[parent], least[node]) if inner[parent] else least[node]
            inner[parent] += 1
            members[parent] += members[node]
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
            children[parent] += node not in earlier

    ends: list[str | None] = [None] * count
    pieces = []
    for node, k in ending.items():
        if node not in keys:
            ends[node] = hashlib.sha256(",".join(map(str, ids[first[k] : stops[k]].tolist())).encode()).hexdigest()
            continue
        for a in range(first[k], stops[k], PIECE):
            part = ids[a : min(a + PIECE, stops[k])].tolist()
            pieces.append((part[0], keys[node], ",".join(map(str, part))))
    parents = tree.parent
    columns = {
        "conv_id": least,
        "depth": tree.depth,
        "parent_conv_id": [None if p < 0 or p in keys else least[p] for p in parents],
        "n_convs": members,
        "n_children": children,
        "n_leaves": leaves,
        "saved_tokens": saved,
        "ends_sha256": ends,
        "node_key": [keys.get(n) for n in range(count)],
        "parent_key": [keys.get(p) for p in parents],
        "piece": [None] * count,
    }
    for id_, key, text in pieces:
        for name, values in columns.items():
            values.append({"conv_id": id_, "node_key": key, "piece": text}.get(name))
    kinds = {"ends_sha256": pa.string(), "node_key": pa.binary(), "parent_key": pa.binary(), "piece": pa.string()}
    return pa.table({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in columns.items()})


def _streamed_digests(pieces: DataFrame) -> DataFrame:
    """``node_key``, ``ends_sha256``: the digest of all pieces of a key, joined by commas in the order of their ids."""

    def run(batches):
        key, digest = None, None
        for batch in batches:
            keys, ends = [], []
            for now, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now != key:
                    if digest:
                        keys.append(key)
                        ends.append(digest.hexdigest())
                    key, digest = now, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["node_key", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["node_key", "ends_sha256"]
            )

    ordered = pieces.repartition("node_key").sortWithinPartitions("node_key", "conv_id").select("node_key", "piece")
    return ordered.mapInArrow(run, "node_key binary, ends_sha256 string")


def nodes(sequences: DataFrame, size: int = SHARD) -> DataFrame:
    """One row per different prefix: ``conv_id`` (its least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    spark = sequences.sparkSession
    path = scratch(spark, "trie")
    made = shards(sequences, size).groupBy("shard").applyInArrow(shard_nodes, _NODE)
    made.write.parquet(f"{path}/nodes")
    raw = spark.read.schema(_NODE).parquet(f"{path}/nodes")
    names = [c.split()[0] for c in _NODE.split(", ")][:8]
    none = F.sha2(F.lit(""), 256)

    inside = raw.where("node_key IS NULL")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    merged = raw.where("node_key IS NOT NULL AND piece IS NULL").groupBy("node_key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in sums],
    )
    merged = merged.join(_streamed_digests(raw.where("piece IS NOT NULL")), "node_key", "left")
    merged.write.parquet(f"{path}/boundary")
    boundary = spark.read.parquet(f"{path}/boundary")

    part = F.pmod(F.col("conv_id"), F.lit(SPREAD)).cast("int")
    parents = boundary.select(
        F.col("node_key").alias("parent_key"),
        F.col("conv_id").alias("parent_conv_id"),
        F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"),
    )
    rest = [n for n in names if n != "parent_conv_id"]
    waiting = inside.where("parent_key IS NOT NULL").select(*rest, "parent_key")
    waiting = waiting.unionByName(boundary.select(*rest, "parent_key")).withColumn("part", part)
    found = waiting.join(parents, ["parent_key", "part"], "left")
    out = inside.where("parent_key IS NULL").select(names).unionByName(found.select(names))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", none))


#: The query over ``conversations`` for DuckDB; paths are joined digests, ancestors their prefixes.
ORACLE = r"""
WITH crc AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
    FROM range(256) r(b)),
t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token,
    length(coalesce(text, '')) AS size, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, token, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS i FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda d: unicode(d)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM t), crc),
u AS (SELECT c.conv_id, 0 AS part, i, token, size FROM c JOIN o ON o.conv_id = c.base AND i <= h
  UNION ALL SELECT c.conv_id, 1, i, token, size FROM c JOIN o ON o.conv_id = c.conv_id AND i > h),
s AS (SELECT conv_id, size, row_number() OVER w AS depth, string_agg(token, '') OVER w AS path,
    count(*) OVER (PARTITION BY conv_id) AS n FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
p AS (SELECT conv_id, size, depth, path, depth = n AS ends FROM s
  UNION ALL SELECT conv_id, 0, 0, '', NOT EXISTS (SELECT 1 FROM u WHERE u.conv_id = c.conv_id) FROM c),
n AS (SELECT path, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY path),
k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
a AS (SELECT left(path, 32 * CAST(d AS INT)) AS path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
    FROM (SELECT n.path, n_convs, size, n_children, unnest(range(0, n.depth + 1)) AS d FROM n LEFT JOIN k ON n.path = k.path) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN k ON n.path = k.path JOIN a ON n.path = a.path
LEFT JOIN n m ON n.depth > 0 AND m.path = left(n.path, 32 * (CAST(n.depth AS INT) - 1))
"""
