"""Tables kept in buckets by a hash of their key, so that an upsert rewrites the touched buckets only.

Layout: ``path/buckets=<n>/bucket=<i>/*.parquet``. The number of buckets is fixed when the table is made and read
from its folder afterwards; ``rebucket`` changes it. Keys are unique: a null or blank key is no row of the table, a
key that a batch repeats fails the batch before anything is replaced. Finished buckets are written beside the table
first and moved into place one by one, each old one being set aside until the new one stands; a batch that was cut
short is sent again, which gives the same table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import scratch
from stratalake.sources.files import delete_path, move_path, path_exists

BUCKETS = 64
_COUNT, _BUCKET = "buckets", "bucket"


def _bucket_of(key: str, count: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(count)).cast("int")


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a table, or None where there is no table."""
    if not path_exists(spark, path):
        return None
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    found = [int(m[1]) for m in (re.fullmatch(rf"{_COUNT}=(\d+)", name) for name in names) if m]
    if len(found) != 1:
        raise ValueError(f"{path} is no table of buckets")
    return found[0]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table, without its bucket columns."""
    return spark.read.parquet(f"{path}/{_COUNT}={bucket_count(spark, path)}").drop(_BUCKET)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    clash = {_COUNT, _BUCKET} & set(df.columns)
    if clash:
        raise ValueError(f"the table has columns of its own named {sorted(clash)}")
    return df.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))


def _write(df: DataFrame, key: str, count: int, path: str) -> None:
    placed = df.withColumn(_BUCKET, _bucket_of(key, count))
    placed.repartition(count, _BUCKET).write.partitionBy(_BUCKET).parquet(path)


def upsert_table(new: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> dict[str, int]:
    """Rows of ``new`` replace those of the same key and are added where there is none.

    Returns how many rows were sent, in how many buckets, and how many rows these hold now. ``buckets`` counts
    for a new table only. The batch is stored first, so it is made once.
    """
    spark, staged, sent = new.sparkSession, scratch(new.sparkSession, "upsert"), scratch(new.sparkSession, "batch")
    count = bucket_count(spark, path)
    known, count = count is not None, count or buckets
    _keyed(new, key).withColumn(_BUCKET, _bucket_of(key, count)).write.parquet(sent)
    kinds = spark.read.parquet(sent).schema
    batch = spark.read.schema(kinds).parquet(sent)
    repeated = batch.groupBy(key).count().where("count > 1").first()
    if repeated:
        raise ValueError(f"the batch repeats key {repeated[0]}")
    per_bucket = {row[0]: row[1] for row in batch.groupBy(_BUCKET).count().collect()}
    rows = batch.drop(_BUCKET)
    home = f"{path}/{_COUNT}={count}"
    if known:
        # The bucket is a folder, so only the touched ones are read.
        old = spark.read.parquet(home).where(F.col(_BUCKET).isin(*per_bucket)).drop(_BUCKET)
        rows = rows.unionByName(old.join(rows.select(key), key, "left_anti").select(*rows.columns))
    elif not per_bucket:
        # A table without rows still has its columns.
        rows.write.parquet(f"{home}/{_BUCKET}=0")
    if not per_bucket:
        return {"rows": 0, "buckets": 0, "rewritten": 0}
    _write(rows, key, count, staged)
    written = spark.read.parquet(staged).count()
    for bucket in sorted(per_bucket):
        move_path(spark, f"{staged}/{_BUCKET}={bucket}", f"{home}/{_BUCKET}={bucket}")
    delete_path(spark, staged)
    delete_path(spark, sent)
    return {"rows": sum(per_bucket.values()), "buckets": len(per_bucket), "rewritten": written}


def rebucket(spark: SparkSession, path: str, key: str, buckets: int) -> None:
    """The same rows in another number of buckets, as a table grows."""
    if bucket_count(spark, path) == buckets:
        return
    staged = f"{scratch(spark, 'rebucket')}/{_COUNT}={buckets}"
    rows = read_table(spark, path)
    if rows.isEmpty():
        rows.write.parquet(f"{staged}/{_BUCKET}=0")
    else:
        _write(rows, key, buckets, staged)
    move_path(spark, staged.rsplit("/", 1)[0], path)
