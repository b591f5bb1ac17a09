"""Relational source and publish target through Spark's JDBC connector."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.sinks import as_text_table, counted, for_each_table, stored

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
#: Lake zone and file format behind each published schema.
PUBLISH_LAYERS = {
    "bronze": ("landing", "csv"),
    "silver": ("processing", "parquet"),
    "gold": ("curated", "csv"),
}


def check_identifier(*names: str) -> None:
    for name in names:
        if not IDENTIFIER.fullmatch(name):
            raise ValueError(f"invalid SQL identifier: {name!r}")


@dataclass(frozen=True)
class Split:
    """Bounds for a parallel read over a numeric or date column."""

    column: str
    lower: object
    upper: object
    parts: int


def read_options(url: str, table: str, split: Split | None = None, fetch: int = 10_000) -> dict[str, str]:
    """Connector options for one table; with a split every part is read by its own task."""
    check_identifier(*table.split("."))
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch)}
    if split:
        check_identifier(split.column)
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, split: Split | None = None, where: str | None = None, **properties: str) -> DataFrame:
    """A table, or the rows a condition keeps; Spark hands the condition to the database."""
    df = spark.read.format("jdbc").options(**read_options(url, table, split), **properties).load()
    return df.where(where) if where else df


def publish_options(columns: Sequence[str], url: str, layer: str, table: str, refresh: str = "replace", column_type: str | None = None, batch: int = 10_000) -> dict[str, str]:
    """Connector options that replace ``layer.table``, or empty and refill it.

    Without a column type the database's own long text type is used.
    """
    check_identifier(layer, table, *columns)
    if layer not in PUBLISH_LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {tuple(PUBLISH_LAYERS)}")
    if refresh not in ("replace", "truncate"):
        raise ValueError("refresh must be 'replace' or 'truncate'")
    options = {"url": url, "dbtable": f"{layer}.{table}", "batchsize": str(batch)}
    if refresh == "truncate":
        options["truncate"] = "true"
    elif column_type:
        options["createTableColumnTypes"] = ", ".join(f"{c} {column_type}" for c in columns)
    return options


def publish_table(df: DataFrame, url: str, layer: str, table: str, refresh: str = "replace", column_type: str | None = None, **properties: str) -> int:
    """Publishes one table and returns its rows; an empty source is skipped and counts zero.

    ``replace`` makes every column text. ``truncate`` keeps the target's types; cut long
    text to the target's lengths with ``typed_copy`` first.
    """
    options = publish_options(df.columns, url, layer, table, refresh, column_type)
    # Stored, since the rows are asked for twice: whether there are any, and to send them.
    rows = stored(as_text_table(df) if refresh == "replace" else df, "publish")
    if rows.isEmpty():
        return 0
    return counted(
        rows, lambda d: d.write.format("jdbc").mode("overwrite").options(**options, **properties).save()
    )["rows"]


def publish_all(frames: Mapping[tuple[str, str], DataFrame], url: str, base: Sequence[str], filtered: Sequence[str], parallel: int = 2, **properties: str) -> dict[str, object]:
    """Publishes every (layer, table) of the plan, a few at a time; returns rows and their sum."""
    plan = publish_plan(base, filtered)
    spark = next(iter(frames.values())).sparkSession
    names = [f"{layer}.{table}" for layer, table in plan]

    def job(name: str) -> int:
        layer, table = name.split(".", 1)
        return publish_table(frames[layer, table], url, layer, table, **properties)

    rows = for_each_table(spark, names, job, parallel)
    return {"tables": rows, "total_rows": sum(rows.values())}


def publish_plan(base: Sequence[str], filtered: Sequence[str]) -> list[tuple[str, str]]:
    """(layer, table) pairs: base tables in bronze, both kinds in silver, filtered ones in gold."""
    tables = {"bronze": list(base), "silver": [*base, *filtered], "gold": list(filtered)}
    return [(layer, name) for layer, names in tables.items() for name in names]


def publish_summary(frames: Mapping[str, DataFrame], base: Sequence[str], filtered: Sequence[str]) -> DataFrame:
    """Rows each planned table would publish, with the total; empty tables count zero.

    A table in two layers is counted once.
    """
    plan = publish_plan(base, filtered)
    check_identifier(*{name for pair in plan for name in pair})
    layers: dict[str, list[str]] = {}
    for layer, name in plan:
        layers.setdefault(name, []).append(layer)
    parts = []
    for name, wanted in layers.items():
        counted = frames[name].agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            counted.select(
                F.explode(F.array(*[F.lit(layer) for layer in wanted])).alias("layer"),
                F.lit(name).alias("table_name"),
                "rows",
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    total = out.agg(F.sum("rows").alias("rows")).select(
        F.lit("all").alias("layer"), F.lit("total").alias("table_name"), "rows"
    )
    return out.unionByName(total)
