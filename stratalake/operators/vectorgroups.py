"""Exact vector top-k that opens only the groups of chunks a query cannot rule out.

Chunk vectors are put into groups of like direction (the signs of projections on fixed planes), each with
a centre and a radius: the widest angle between the centre and a member. By the triangle inequality no
member of a group lies nearer to a query than the angle to the centre less the radius.

* First round: a query opens the group with the nearest centre, whose k-th score is the query's floor.
* Second round: it opens the other groups whose bound reaches the floor; all others are skipped.

Groups hold a bounded number of rows: a crowded direction, such as that of many copies, is cut into parts by
a hash of the tie columns. So queries meet one row for every ``ROWS`` chunks, and chunks of opened groups only.

Vectors that are null, zero or hold no numbers score nothing and belong to no group. Shorter vectors count as
filled up with zeros. ``query_id`` and the tie columns are unique.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import scratch

#: Chunks of a group, on average at most.
ROWS = 2_000
#: Queries that meet a group, or a block of centres, at once.
QUERIES = 4_096
#: Centres that meet a block of queries at once.
CENTRES = 2_000
MAX_PLANES, SEED = 30, 20240131
#: Angles of nearly equal vectors are known to about 2e-8 only; bounds are widened by more.
SLACK = 1e-6

#: Finds the best of a frame of chunks for a frame of queries: columns query_id, list, score and the carried ones.
Best = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]


@dataclass(frozen=True)
class Groups:
    """``members``: the chunks with their group; ``centres``: rows group, vector, radius, rows."""

    members: DataFrame
    centres: DataFrame


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def units(vectors: Sequence[Sequence[float] | None], width: int) -> np.ndarray:
    """Vectors of length one, filled up with zeros to ``width``; those without a direction are all zeros."""
    out = np.zeros((len(vectors), width))
    for row, vector in enumerate(vectors):
        if vector is not None and len(vector):
            values = np.asarray(vector, dtype=float)
            with np.errstate(over="ignore", invalid="ignore"):
                values = values / (np.sqrt(np.square(values).sum()) or 1.0)
            if np.isfinite(values).all():
                out[row, : len(values)] = values
    return out


def build(chunks: DataFrame, ties: Sequence[str], rows: int = ROWS) -> Groups:
    """Chunks (the tie columns, ``vector`` and others) put into groups; both tables are stored."""
    size = chunks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    width = max(size["width"], 1)
    planes = min(MAX_PLANES, max(0, math.ceil(math.log2(max(size["n"], 1) / rows))))
    normals = np.random.default_rng(SEED).normal(size=(width, planes))
    weights = 2 ** np.arange(planes, dtype=np.int64)
    placed = T.StructType([*chunks.schema.fields, T.StructField("_side", T.LongType())])

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            mine = units(frame["vector"], width)
            kept = mine.any(axis=1)
            yield frame[kept].assign(_side=(mine[kept] @ normals > 0).astype(np.int64) @ weights)

    sides = _kept(chunks.mapInPandas(place, placed), "vector-sides")
    parts = sides.groupBy("_side").agg(F.ceil(F.count(F.lit(1)) / rows).cast("long").alias("_parts"))
    part = F.pmod(F.xxhash64(*ties), F.col("_parts"))
    group = F.shiftleft(F.col("_side"), 31) + part
    members = _kept(sides.join(parts, "_side").withColumn("group", group).drop("_side", "_parts"), "vector-members")

    def centre(frame: pd.DataFrame) -> pd.DataFrame:
        mine = units(frame["vector"], width)
        middle = units([mine.sum(axis=0)], width)[0]
        # Opposite vectors may have no middle; then any member serves.
        middle = middle if middle.any() else mine[0]
        radius = float(np.arccos(np.clip(mine @ middle, -1, 1)).max())
        return pd.DataFrame({"group": frame["group"].iloc[:1], "vector": [middle], "radius": radius, "rows": len(frame)})

    middles = members.select("group", "vector").groupBy("group")
    found = middles.applyInPandas(centre, "group bigint, vector array<double>, radius double, rows bigint")
    return Groups(members, _kept(found, "vector-centres"))


def bounds(queries: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The most that any member of each group can score for each query."""
    angle = np.arccos(np.clip(queries @ centres.T, -1, 1))
    return np.cos(np.maximum(angle - radius[None, :], 0)) + SLACK


def _blocks(df: DataFrame, size: int) -> DataFrame:
    return df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / (0.75 * size))).cast("int").alias("n"))


def _meet(queries: DataFrame, groups: Groups, judge: Callable[[pd.DataFrame, pd.DataFrame, int], pd.DataFrame], schema: T.StructType) -> DataFrame:
    """Every block of queries with every block of centres, in groups of bounded size."""
    query_blocks, centre_blocks = _blocks(queries, QUERIES), _blocks(groups.centres, CENTRES)

    def spread(df: DataFrame, own: str, mine: DataFrame, other: str, theirs: DataFrame, key: str) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64(key), mine.scalar()).cast("int")).withColumn("_n", theirs.scalar())
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")

    left = spread(queries, "_qb", query_blocks, "_cb", centre_blocks, "query_id")
    right = spread(groups.centres, "_cb", centre_blocks, "_qb", query_blocks, "group")

    def per_pair(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or theirs.empty:
            return pd.DataFrame(columns=schema.names)
        width = max(max(len(v) for v in mine["vector"]), max(len(v) for v in theirs["vector"]))
        return judge(mine.reset_index(drop=True), theirs.reset_index(drop=True), width)

    keys = ["_qb", "_cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(per_pair, schema)


def nearest(queries: DataFrame, groups: Groups, k: int) -> DataFrame:
    """Rows (query_id, group): the group with the nearest centre, of those with ``k`` rows if there are any."""
    key = T.StructField("query_id", queries.schema["query_id"].dataType)
    schema = T.StructType([key, T.StructField("group", T.LongType()), T.StructField("near", T.DoubleType())])

    def judge(mine: pd.DataFrame, theirs: pd.DataFrame, width: int) -> pd.DataFrame:
        near = units(mine["vector"], width) @ units(theirs["vector"], width).T
        near = near - 4.0 * (theirs["rows"].to_numpy() < k)
        best = near.argmax(axis=1)
        return pd.DataFrame({"query_id": mine["query_id"], "group": theirs["group"].to_numpy()[best], "near": near[np.arange(len(mine)), best]})

    found = _meet(queries, groups, judge, schema)
    return found.groupBy("query_id").agg(F.max(F.struct("near", "group")).alias("_best")).select("query_id", F.col("_best.group").alias("group"))


def reached(queries: DataFrame, groups: Groups) -> DataFrame:
    """Rows (query_id, group): the groups that may hold a score of at least the query's ``floor``, but not its ``group``."""
    key = T.StructField("query_id", queries.schema["query_id"].dataType)
    schema = T.StructType([key, T.StructField("group", T.LongType())])

    def judge(mine: pd.DataFrame, theirs: pd.DataFrame, width: int) -> pd.DataFrame:
        most = bounds(units(mine["vector"], width), units(theirs["vector"], width), theirs["radius"].to_numpy())
        open_ = most >= mine["floor"].to_numpy()[:, None]
        open_ &= mine["group"].to_numpy()[:, None] != theirs["group"].to_numpy()[None, :]
        rows, cols = np.nonzero(open_)
        return pd.DataFrame({"query_id": mine["query_id"].to_numpy()[rows], "group": theirs["group"].to_numpy()[cols]})

    return _meet(queries, groups, judge, schema)


def opened(pairs: DataFrame, queries: DataFrame, members: DataFrame, best: Best, schema: T.StructType) -> DataFrame:
    """The best chunks of each (query_id, group) pair; a group asked for by many queries is read by several tasks."""
    asked = pairs.join(queries.select("query_id", "vector"), "query_id")
    tasks = pairs.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("long").alias("_tasks"))
    left = asked.join(tasks, "group").withColumn("_task", F.pmod(F.xxhash64("query_id"), F.col("_tasks"))).drop("_tasks")
    right = members.join(tasks, "group").withColumn("_task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tasks") - 1))).drop("_tasks")

    def per_group(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or theirs.empty:
            return pd.DataFrame(columns=schema.names)
        return best(mine.reset_index(drop=True), theirs)

    keys = ["group", "_task"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(per_group, schema)


def candidates(queries: DataFrame, groups: Groups, best: Best, schema: T.StructType, k: int) -> DataFrame:
    """Rows of ``schema`` among which are the ``k`` best of every query (query_id, vector)."""
    width = groups.centres.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return queries.sparkSession.createDataFrame([], schema)
    asked = _kept(queries.where(F.size("vector") > 0).select("query_id", "vector"), "vector-queries")
    first = _kept(nearest(asked, groups, k), "vector-nearest")
    found = _kept(opened(first, asked, groups.members, best, schema), "vector-first")
    floor = F.sort_array(F.collect_list("score"), asc=False)
    floors = found.groupBy("query_id").agg(F.try_element_at(floor, F.lit(k)).alias("floor"))
    known = asked.join(first, "query_id").join(floors, "query_id", "left")
    # Scores must be positive, so a query without k hits opens every group that may hold one.
    known = known.withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    more = _kept(reached(known, groups), "vector-reached")
    return found.unionByName(opened(more, asked, groups.members, best, schema))
