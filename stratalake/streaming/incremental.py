"""Incremental runs with Structured Streaming: new landing files into bronze and silver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.history import latest_per_key
from stratalake.sources.files import path_exists
from stratalake.sources.sinks import stored, write_partitions

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None, **options: str) -> DataFrame:
    """Files as they arrive below ``path``; a batch may be bounded by a number of files."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def incremental_silver(
    stream: DataFrame,
    to_bronze: Callable[[DataFrame], DataFrame],
    bronze: str,
    silver: str,
    checkpoint: str,
    key: str,
    order: str,
    load_date: str = "load_date",
    extra_keys: Sequence[str] = (),
) -> StreamingQuery:
    """Appends each batch to bronze and merges it into the silver partitions of its load dates.

    Bronze keeps one folder per load date and batch, so a batch run again after a failure
    overwrites its own files. The batch's last arrival of each key meets what silver holds for
    the same dates, the last arrival winning; merging a batch again changes nothing. A batch
    costs its own rows and the silver rows of its dates, however many batches came before.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = to_bronze(batch).withColumn("batch_id", F.lit(batch_id))
        written = write_partitions(rows, bronze, [load_date, "batch_id"])["rows"]
        if not written:
            return
        # Only the folders this batch wrote are opened.
        own = spark.read.schema(rows.schema).parquet(bronze).where(F.col("batch_id") == batch_id)
        current = last_wins_per(own.drop("batch_id"), [load_date, key], order)
        if path_exists(spark, silver):
            held = spark.read.schema(current.schema).parquet(silver)
            held = held.join(current.select(load_date).distinct(), load_date, "left_semi")
            merged = last_wins_per(held.select(current.columns).unionByName(current), [load_date, key], order)
            # Silver's partitions are inputs of their own replacement, so that is stored first.
            current = stored(merged, "silver")
        write_partitions(current, silver, [*extra_keys, load_date])

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_wins_per(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last arrival per key within a load date; rows without a key are dropped."""
    keyed = df.where(F.col(keys[-1]).isNotNull() & (F.col(keys[-1]).cast("string") != ""))
    return latest_per_key(keyed, keys, F.col(order))


def first_wins(stream: DataFrame, keys: Sequence[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """One row per key of a stream, the first to arrive.

    With an event time and a delay, keys are forgotten after the delay and later rows are
    dropped as too late. Without them every key is remembered, which is exact; set the
    RocksDB state store (``ROCKSDB``) so that state lives on disk.
    """
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    return stream.dropDuplicates(list(keys))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream over everything there is now into Parquet and returns the table."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    if not path_exists(spark, path):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path)
