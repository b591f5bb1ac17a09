"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK: dict[str, str] = {}


def local_session(name: str = "stratalake", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="stratalake-")
    return _FALLBACK[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, so reruns never meet old files."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now instead of at its next periodic collection.

    Only files that nothing can read any more go: Spark's cleaner follows references.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
