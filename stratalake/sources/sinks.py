"""Writers: every count comes from an Observation on the write itself, never a second pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from stratalake.functions.text import numbered_id
from stratalake.operators.history import number_rows
from stratalake.operators.normalize import RULE, FilterRule, match_rules
from stratalake.session import scratch
from stratalake.sources.files import CLOUD_CSV, PLAIN_CSV, delete_path, move_path


class EmptyWrite(ValueError):
    """Raised when a sink that needs rows gets none."""


def counted(df: DataFrame, write: Callable[[DataFrame], None], measures: Mapping[str, object] | None = None) -> dict[str, int]:
    """Runs a write and returns its row count and other measures, observed on the way."""
    seen = Observation()
    extra = [col.alias(name) for name, col in (measures or {}).items()]
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra))
    return {name: value or 0 for name, value in seen.get.items()}


def _replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> int:
    """Writes beside the target and puts the result in its place, in one pass over ``df``.

    Without rows the target stays as it was and the write fails.
    """
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    rows = counted(df, lambda d: write(d, staged))["rows"]
    if not rows:
        delete_path(df.sparkSession, staged)
        raise EmptyWrite(f"cannot write an empty table: {path}")
    move_path(df.sparkSession, staged, path)
    return rows


def write_csv(df: DataFrame, path: str, cloud: bool = False) -> int:
    """Overwrite as CSV with a header; an empty table is an error. Returns the rows written."""
    options = {**(CLOUD_CSV if cloud else PLAIN_CSV), "quoteAll": str(cloud).lower()}
    options.pop("multiLine", None)
    return _replace(df, path, lambda d, to: d.write.options(**options).csv(to))


def write_json(df: DataFrame, path: str) -> int:
    """Overwrite as JSON rows; empty tables are allowed and null fields are kept."""
    return counted(
        df, lambda d: d.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    )["rows"]


def write_parquet(df: DataFrame, path: str, allow_empty: bool = False) -> int:
    """Overwrite as snappy Parquet; an empty table is an error unless allowed."""
    if not allow_empty:
        return _replace(df, path, lambda d, to: d.write.option("compression", "snappy").parquet(to))
    return counted(
        df, lambda d: d.write.mode("overwrite").option("compression", "snappy").parquet(path)
    )["rows"]


def write_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("p_country", "p_state", "load_date"),
    fmt: str = "parquet",
    measures: Mapping[str, object] | None = None,
) -> dict[str, int]:
    """Overwrite only the partitions present in ``df``; returns the measured counts.

    The rebalance hint groups a partition's rows into few files and lets adaptive
    execution split a partition that holds far more rows than the others.
    """

    def write(d: DataFrame) -> None:
        (
            d.write.mode("overwrite")
            .format(fmt)
            .option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", "false")
            .partitionBy(*keys)
            .save(path)
        )

    # Counting comes after the exchange: tasks that only write are counted once each, while
    # tasks before an exchange may run again when an executor is lost.
    return counted(df.hint("rebalance", *keys), write, measures)


def write_matched(df: DataFrame, rules: Sequence[FilterRule], processing: str, curated: str) -> dict[str, int]:
    """Each rule's rows as Parquet, then as CSV from that Parquet; returns row counts by output.

    The table is scanned once for all rules: rows go to a folder per rule in one write, counted on the way, and the
    folders are moved into place. A rule that keeps nothing still leaves a table with its columns. Of rules with one
    output the last counts. The table may not have a column ``_rule`` of its own.
    """
    spark, kinds = df.sparkSession, df.schema
    rules = list({rule.output: rule for rule in rules}.values())
    if not rules:
        return {}
    staged = f"{processing.rstrip('/')}/.staged-{uuid.uuid4().hex}"
    sizes = {str(n): F.count(F.when(F.col(RULE) == n, 1)) for n in range(len(rules))}
    tagged = match_rules(df, rules).hint("rebalance", RULE)
    seen = counted(tagged, lambda d: d.write.option("compression", "snappy").partitionBy(RULE).parquet(staged), sizes)
    counts = {}
    for place, rule in enumerate(rules):
        counts[rule.output], target = seen[str(place)], f"{processing}/{rule.output}"
        if counts[rule.output]:
            move_path(spark, f"{staged}/{RULE}={place}", target)
        else:
            spark.createDataFrame([], kinds).write.mode("overwrite").parquet(target)
        kept = spark.read.schema(kinds).parquet(target)
        options = {k: v for k, v in PLAIN_CSV.items() if k != "multiLine"}
        kept.write.mode("overwrite").options(**options).csv(f"{curated}/{rule.output}")
    delete_path(spark, staged)
    return counts


def for_each_table(
    spark: SparkSession, names: Sequence[str], job: Callable[[str], object], parallel: int = 4
) -> dict[str, object]:
    """Run one Spark job per table, a few side by side; returns each job's result."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # Threads carry the caller's local properties such as the scheduler pool.
        wrapped = inheritable_thread_target(spark)(job)
        return dict(zip(names, pool.map(wrapped, names)))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for results that are used twice."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_numbered(existing: DataFrame | None, fresh: DataFrame, order: str, name: str = "note_key", prefix: str = "NOTE-", width: int = 4) -> DataFrame:
    """Rows of ``fresh`` with keys that go on counting after the existing rows."""
    numbered = number_rows(fresh, order, "_n")
    if existing is not None:
        # One row: the count so far.
        so_far = existing.agg(F.count(F.lit(1)).alias("_so_far"))
        numbered = numbered.join(F.broadcast(so_far)).withColumn("_n", F.col("_n") + F.col("_so_far"))
        numbered = numbered.drop("_so_far")
    return numbered.withColumn(name, numbered_id(prefix, F.col("_n"), width)).drop("_n")


def as_text_table(df: DataFrame) -> DataFrame:
    """Every column cast to text, nested ones as JSON."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")).alias(f.name)
            for f in df.schema.fields
        ]
    )
