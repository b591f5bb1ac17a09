"""File sources: CSV, JSON, Parquet, whole text, partition-pruned layers, lake inventory."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CSV = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: CSV options by dialect. The cloud one quotes all text and escapes with a backslash.
PLAIN_CSV = {**_CSV, "escape": '"', "multiLine": "true"}
CLOUD_CSV = {**_CSV, "escape": "\\"}

LAYERS = ("landing", "bronze", "silver", "gold")


def table_path(root: str, environment: str, prefix: str, layer: str, domain: str, table: str) -> str:
    """Address of a layer table below a local root or a bucket URI."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return "/".join([root.rstrip("/"), environment, prefix, layer, domain, table])


def zone_path(container_uri: str, zone: str, name: str, zones: Sequence[str] = ("landing", "processing", "curated")) -> str:
    """Address of a file in a zone; ``{zone}`` in the URI names the container."""
    if zone not in zones:
        raise ValueError(f"unknown lake zone {zone!r}, expected one of {tuple(zones)}")
    if "{zone}" in container_uri:
        return container_uri.format(zone=zone).rstrip("/") + "/" + name
    return f"{container_uri.rstrip('/')}/{zone}/{name}"


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | Sequence[str] | None = None,
    dialect: Mapping[str, str] = PLAIN_CSV,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header. Names alone, or nothing, give text columns; types are inferred on request only.

    The plain dialect lets a quoted value span lines, so a file is not split; pass
    ``{**PLAIN_CSV, "multiLine": "false"}`` for large files known to have one row a line.
    """
    reader = spark.read.options(**dialect).option("mode", "FAILFAST")
    if isinstance(schema, T.StructType):
        reader = reader.schema(schema).option("enforceSchema", "false")
    elif schema is not None:
        reader = reader.schema(text_schema(schema)).option("enforceSchema", "false")
    else:
        reader = reader.option("inferSchema", str(infer).lower())
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON rows, one object a line as our writers leave them; a broken line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole files that each hold one list of objects; other content fails the job.

    Spark skips files of no length.
    """
    content = F.btrim(F.col("value"), F.lit(" \n\r\t\ufeff"))
    listed = F.when(content.startswith("["), content).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON list: "), F.left(content, F.lit(40))))
    )
    rows = F.from_json(listed, T.ArrayType(schema), {"mode": "FAILFAST"})
    return spark.read.text(path, wholetext=True).select(F.inline(rows))


def read_partition(spark: SparkSession, base: str, load_date: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """All countries and states of one load date; only the matching folders are opened.

    Give the schema where folder names hold codes: Spark guesses numbers from them otherwise.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(base).where(F.col("load_date") == F.lit(load_date))


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: source_path (below ``path``), source_id (the same without extension) and its text.

    Files of one name in several folders stay apart. Bytes that are no UTF-8 become replacement
    characters; a missing path fails.
    """
    place = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(?=/)", "", path)
    place = re.sub(r"^/+", "/", place)
    # Below the last folder before a pattern, or below the path itself.
    fixed = re.split(r"[*?\[{]", place)[0]
    root = fixed.rstrip("/") + "/" if fixed == place else fixed[: fixed.rfind("/") + 1]
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    at = F.locate(root, full)
    below = F.expr("substr(_full, _at + length(_root))")
    name = F.when(F.col("_at") > 0, below).otherwise(F.regexp_extract("_full", r"([^/]+)$", 1))
    read = spark.read.text(path, wholetext=True)
    placed = read.select("value", full.alias("_full"), at.alias("_at"), F.lit(root).alias("_root"))
    return placed.select(
        name.alias("source_path"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("source_id"),
        F.col("value").alias("text"),
    )


class MissingFields(RuntimeError):
    """Raised when a payload lacks required fields."""


def require_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Fails at once when a required column is not part of the payload's schema."""
    missing = sorted(set(fields) - set(df.columns))
    if missing:
        raise MissingFields(f"payload lacks required fields: {', '.join(missing)}")
    return df


def missing_fields(payload: Column, fields: Sequence[str]) -> Column:
    """Required keys a JSON object text does not have, sorted; null text lacks them all."""
    required = F.array(*[F.lit(name) for name in sorted(fields)])
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    return F.array_except(required, keys)


def choose_source(
    fixture: Callable[[str], DataFrame],
    api: Callable[[], DataFrame],
    path: str | None = None,
    default_path: str | None = None,
    use_fixture: bool = False,
) -> DataFrame:
    """An explicit path wins, then the configured fixture, then the service."""
    if path:
        return fixture(path)
    if use_fixture:
        if not default_path:
            raise ValueError("use_fixture needs a default_path")
        return fixture(default_path)
    return api()


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` with its relative path and size, without reading contents."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.col("path"), F.col("length").alias("size_bytes"))
    )
    relative = F.regexp_replace(F.col("path"), r"^[a-z0-9]+:/*", "/")
    prefix = "/" + root.split("://", 1)[-1].strip("/") + "/"
    return listing.select(
        F.replace(relative, F.lit(prefix), F.lit("")).alias("path"), "size_bytes"
    ).orderBy("path")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path is there, on any file system Spark reads."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Puts a finished folder in the place of another on the same file system.

    The other is set aside first and deleted last, so a crash on the way loses neither; if the move fails it is put back.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    # Readers skip names that begin with a dot.
    aside = hadoop.Path(new.getParent() or hadoop.Path("."), f".{new.getName()}.replaced-{uuid.uuid4().hex}")
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(old):
        raise OSError(f"cannot move {source} to {target}: it is not there")
    if new.getParent() is not None:
        system.mkdirs(new.getParent())
    had = system.exists(new)
    if had and not system.rename(new, aside):
        raise OSError(f"cannot set {target} aside")
    if not system.rename(old, new):
        if had:
            system.rename(aside, new)
        raise OSError(f"cannot move {source} to {target}")
    if had:
        system.delete(aside, True)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, as one plan."""
    parts = [
        df.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def layer_inventory(spark: SparkSession, layers: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Existence and row count of each named layer path; missing layers count zero rows."""
    present = {n: spark.read.format(fmt).load(p) for n, p in layers.items() if path_exists(spark, p)}
    absent = [(name, 0, False) for name in layers if name not in present]
    gone = spark.createDataFrame(absent, "table_name string, rows bigint, exists boolean")
    if not present:
        return gone
    return row_counts(present).withColumn("exists", F.lit(True)).unionByName(gone)


def partition_inventory(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of partitions and rows of a partitioned layer."""
    per_partition = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_partition.agg(
        F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows")
    )


def inventory_report(files: DataFrame, layers: DataFrame, title: str = "lake") -> DataFrame:
    """The inventory as text lines: a header, one line per layer, one per file.

    Lines keep their order in ``section`` and ``line`` and stay distributed.
    """
    head = layers.sparkSession.createDataFrame([(0, f"=== {title} ===")], "section int, line string")
    state = F.when(
        F.col("exists"), F.concat(F.lit("  [OK] "), F.col("table_name"), F.lit(": rows="), F.col("rows"))
    ).otherwise(F.concat(F.lit("  [MISSING] "), F.col("table_name")))
    layer_lines = layers.select(F.lit(1).alias("section"), state.alias("line"))
    file_lines = files.select(
        F.lit(2).alias("section"),
        F.concat(F.lit("  "), F.col("path"), F.lit("  ("), F.col("size_bytes"), F.lit(" B)")).alias("line"),
    )
    return head.unionByName(layer_lines).unionByName(file_lines).orderBy("section", "line")
