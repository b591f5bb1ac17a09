"""External tables over lake paths in Spark's own catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.files import row_counts
from stratalake.sources.jdbc import check_identifier


def register_tables(
    spark: SparkSession,
    database: str,
    parquet: Mapping[str, str],
    csv: Mapping[str, str] | None = None,
    location: str | None = None,
) -> dict[str, str]:
    """Replaces ``<name>_pqt`` and ``<name>_csv`` over the given paths; returns qualified names to paths.

    ``location`` is the folder of a new database; the warehouse of the session otherwise.
    """
    csv = csv or {}
    check_identifier(database, *parquet, *csv)
    place = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    made: dict[str, str] = {}
    wanted = [(f"{n}_pqt", "parquet", p) for n, p in parquet.items()]
    wanted += [(f"{n}_csv", "csv", p) for n, p in csv.items()]
    for name, fmt, path in wanted:
        table = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        # Text columns: inferring types would change values such as zip codes.
        extra = {"header": "true", "inferSchema": "false"} if fmt == "csv" else {}
        spark.catalog.createTable(table, path=path, source=fmt, **extra)
        made[table] = path
    return made


def catalog_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Row count of every registered table, in one plan."""
    return row_counts({name.split(".", 1)[-1]: spark.table(name) for name in tables})
