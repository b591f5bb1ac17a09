"""Whole runs put together from the operators: orders, entities, shop tables, knowledge."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators import quality
from stratalake.operators.chunking import chunk_texts
from stratalake.operators.history import current_versions, flag_current, last_wins
from stratalake.operators.metrics import order_kpis
from stratalake.operators.normalize import (
    FilterRule,
    current_rows,
    entity_bronze,
    export_rows,
    known_rules,
    orders_bronze,
    with_partition_keys,
)
from stratalake.operators.retrieval import with_hashed_vectors
from stratalake.session import scratch
from stratalake.sources import buckets, catalog, files, sinks

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Layers:
    """Paths of a table's layers."""

    root: str
    table: str

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}/{self.table}"


def same(df: DataFrame) -> DataFrame:
    """The step that changes nothing, such as silver to gold after its gate."""
    return df


def run_layers(
    landing: DataFrame, layers: Layers, to_bronze: Step, to_silver: Step
) -> dict[str, object]:
    """Landing to bronze to silver; each layer is written once and read back by the next.

    An empty landing is an error, an empty later layer is not.
    """
    spark = landing.sparkSession
    write = partial(sinks.write_parquet, allow_empty=True)
    counts = {"landing": sinks.write_parquet(landing, layers.path("landing"))}
    stored = spark.read.schema(landing.schema).parquet(layers.path("landing"))
    bronze = stored.transform(to_bronze)
    counts["bronze"] = write(bronze, layers.path("bronze"))
    silver = spark.read.schema(bronze.schema).parquet(layers.path("bronze")).transform(to_silver)
    counts["silver"] = write(silver, layers.path("silver"))
    return counts


def run_step(spark: SparkSession, source: str, target: str, step: Step, fmt: str = "parquet") -> int:
    """One table to another by address."""
    return sinks.write_parquet(spark.read.format(fmt).load(source).transform(step), target, allow_empty=True)


def orders_silver(bronze: DataFrame) -> DataFrame:
    return flag_current(bronze, "order_id", "load_at", "_ord")


def current_orders(bronze: DataFrame) -> DataFrame:
    """The current rows alone, for metrics that need no history."""
    return current_versions(bronze, "order_id", "load_at", "_ord")


def run_orders(landing: DataFrame, root: str) -> dict[str, object]:
    """Orders through all layers to the gated KPI export. ``landing`` carries ``_ord``."""
    spark = landing.sparkSession
    layers = Layers(root, "orders")
    stats = run_layers(landing, layers, lambda d: orders_bronze(d, keep=("_ord",)), orders_silver)
    silver = spark.read.parquet(layers.path("silver"))
    kpis = order_kpis(current_rows(silver))
    stats["gold"] = sinks.write_json(kpis, f"{root}/gold/kpi/orders_daily")
    gold = files.read_json(spark, f"{root}/gold/kpi/orders_daily", kpis.schema)
    quality.gate(quality.report(gold, quality.export_checks(gold)))
    stats["export"] = sinks.write_json(export_rows(gold), f"{root}/gold/analytics/kpi_export")
    stats["current"] = silver.where("is_current").count()
    return stats


def run_entities(
    landing: DataFrame, root: str, loaded: dt.date | str | None = None, minimum: int = 1, to_gold: Step = same
) -> dict[str, int]:
    """Entity records, partitioned by country, state and load date, through the silver gate to gold.

    ``landing`` carries ``_ord``; only the partitions of this load date are replaced.
    """
    spark = landing.sparkSession
    day = dt.datetime.now(dt.timezone.utc).date().isoformat() if loaded is None else str(loaded)
    paths = {layer: f"{root}/{layer}/entities" for layer in files.LAYERS}
    stats: dict[str, int] = {}

    def land(layer: str, rows: DataFrame) -> DataFrame:
        """Writes a layer and reads this load date back; keys stay text, so codes keep their zeros."""
        stats[layer] = sinks.write_partitions(rows, paths[layer])["rows"]
        return files.read_partition(spark, paths[layer], day, schema=rows.schema)

    first = land("landing", with_partition_keys(landing, day))
    keys = ("_ord", "p_country", "p_state", "load_date")
    bronze = land("bronze", entity_bronze(first, keep=keys))
    silver = land("silver", last_wins(bronze, "id", "_ord"))
    quality.gate(quality.report(silver, quality.entity_checks(silver, minimum=minimum)))
    land("gold", to_gold(silver))
    return stats


def run_shop(
    spark: SparkSession,
    landing: str,
    processing: str,
    curated: str,
    tables: Mapping[str, Sequence[str]],
    rules: Mapping[str, Sequence[FilterRule]],
    database: str | None = None,
) -> dict[str, object]:
    """Landing CSV to processing Parquet, filtered tables to Parquet and CSV, and the catalog.

    ``tables`` names each table's columns; text stays text, so codes keep their zeros.
    """
    frames = {n: files.read_csv(spark, f"{landing}/{n}", cols) for n, cols in tables.items()}
    copied = sinks.for_each_table(
        spark, list(frames), lambda n: sinks.write_parquet(frames[n], f"{processing}/{n}")
    )
    stored = {n: spark.read.parquet(f"{processing}/{n}") for n in frames}
    filtered: dict[str, int] = {}
    for name, table_rules in known_rules(stored, rules).items():
        filtered |= sinks.write_matched(stored[name], table_rules, processing, curated)
    out: dict[str, object] = {"processing": copied, "filtered": filtered}
    if database:
        parquet = {n: f"{processing}/{n}" for n in [*tables, *filtered]}
        csv = {n: f"{curated}/{n}" for n in filtered}
        out["tables"] = catalog.register_tables(spark, database, parquet, csv)
    return out


def run_knowledge(texts: DataFrame, chunk_path: str, vector_path: str | None = None, **sizes: int) -> dict[str, int]:
    """Texts to the chunk table and, when asked, the vector table keyed by chunk id.

    The vector table is kept in buckets (``sources.buckets``), of which a run rewrites those that its chunks touch.
    """
    spark = texts.sparkSession
    chunks = chunk_texts(texts, **sizes)
    stats = {"chunks": sinks.write_parquet(chunks, chunk_path, allow_empty=True), "indexed": 0}
    if vector_path:
        stored = spark.read.schema(chunks.schema).parquet(chunk_path)
        fresh = with_hashed_vectors(stored).select("id", "vector")
        stats["indexed"] = buckets.upsert_table(fresh, vector_path, "id")["rows"]
    return stats
