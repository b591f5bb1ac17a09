"""Versions of a record: current flag, last one wins, latest per key, running numbers.

A single key may hold a large share of all rows, so nothing here sorts one key's rows in a
single task: winners come from aggregates that combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratalake.session import scratch


def _require(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def flag_current(df: DataFrame, key: str, version: str, order: str) -> DataFrame:
    """``is_current`` on the greatest version of each key; of equal versions the first arrival.

    ``order`` is the unique numeric arrival position; a key with a null position, or with its
    current one twice, fails the job. The flag joins back on key *and* position, so the rows of a
    hot key spread over all partitions.
    """
    _require(df, key, version, order)
    # Equal positions of a key are counted before the shuffle, per position.
    spots = df.groupBy(key, order).agg(F.max(version).alias("_v"), F.count(F.lit(1)).alias("_n"))
    best = F.max(F.struct(F.col("_v").alias("v"), (-F.col(order)).alias("p"), F.col("_n").alias("n")))
    nulls = F.count_if(F.col(order).isNull())
    fails = F.raise_error(F.concat(F.lit("arrival position is null or repeated for "), F.col(key).cast("string")))
    winners = (
        spots.groupBy(key)
        .agg(best.alias("w"), nulls.alias("nulls"))
        .select(
            F.col(key).alias("_key"), (-F.col("w.p")).alias("_pos"),
            F.when((F.col("w.n") > 1) | (F.col("nulls") > 0), fails.cast("boolean")).otherwise(F.lit(True)).alias("_won"),
        )
    )
    hit = F.col(key).eqNullSafe(F.col("_key")) & (F.col(order) == F.col("_pos"))
    return df.join(winners, hit, "left").select(
        *df.columns, F.coalesce(F.col("_won"), F.lit(False)).alias("is_current")
    )


def current_versions(df: DataFrame, key: str, version: str, order: str) -> DataFrame:
    """Only the rows ``flag_current`` would mark, in one pass over the data."""
    _require(df, key, version, order)
    return latest_per_key(df, [key], F.struct(F.col(version), -F.col(order)))


def sort_versions(df: DataFrame, key: str, version: str, order: str) -> DataFrame:
    """Keys and versions descending, arrival order among equals."""
    return df.orderBy(F.desc(key), F.desc(version), F.asc(order))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row with the greatest ``order`` for each key, combined before the shuffle."""
    rest = [name for name in df.columns if name not in keys]
    picked = F.max_by(F.struct(*rest), order).alias("_row")
    return (
        df.groupBy(*keys)
        .agg(picked)
        .select(*[F.col(n) if n in keys else F.col(f"_row.{n}").alias(n) for n in df.columns])
    )


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last arrival; rows without a key are dropped."""
    _require(df, key, order)
    keyed = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return latest_per_key(keyed, [key], F.col(order))


def upsert(old: DataFrame, new: DataFrame, key: str, order: str = "_batch") -> DataFrame:
    """Old and new rows by key, the new one winning; ``new`` itself may repeat no key."""
    both = old.withColumn(order, F.lit(0)).unionByName(new.withColumn(order, F.lit(1)))
    return last_wins(both, key, order).drop(order)


def number_rows(df: DataFrame, order: str, name: str, start: int = 1) -> DataFrame:
    """Gapless running number by a unique ``order`` without one task seeing all rows.

    Rows are dealt out by ranges of the order that Spark cuts from a sample, so outliers do not
    unbalance them, and stored. They are numbered inside their range; only one count per range
    meets in a window. A null, of which a unique order holds one at most, comes first.
    """
    spark = df.sparkSession
    path = scratch(spark, "numbered")
    df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType())])).parquet(path)
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return dealt.join(offsets, "_range").select(
        *df.columns, (F.lit(start - 1) + F.col("_before") + inside).alias(name)
    )
