"""Connected components of edge tables, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import scratch
from stratalake.sources.files import delete_path

#: Label tables of so many rows (two ids each) are broadcast; larger ones meet their edges in joins that Spark can split.
SMALL = 100_000


def components(edges: DataFrame, left: str = "a", right: str = "b", small: int = SMALL) -> DataFrame:
    """``node``, ``label``: every node of an edge with the least node it can reach.

    Each round a node takes the least label among its neighbours, then the label of its label. Neighbours are
    combined before the shuffle. Every round is stored in the shared folder, so a lost executor costs one round at
    most, and a round that nothing reads any more is deleted. Edges with a null end are dropped; an empty table has no nodes.
    """
    spark = edges.sparkSession
    folder = scratch(spark, "components")
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    around = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")),
                     F.struct(F.col("b").alias("a"), "b"))
    # every edge from both ends, and every node with itself
    ends.select(F.inline(around)).distinct().write.parquet(f"{folder}/edges")
    both = spark.read.parquet(f"{folder}/edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).withColumn("changed", F.lit(True))
    number, few = 0, False
    while True:
        labels.write.parquet(f"{folder}/{number}")
        labels = spark.read.parquet(f"{folder}/{number}")
        if number:
            delete_path(spark, f"{folder}/{number - 1}")
        if labels.where("changed").isEmpty():
            delete_path(spark, f"{folder}/edges")
            return labels.select("node", "label")
        few = few or (number == 0 and labels.count() <= small)
        known = F.broadcast(labels) if few else labels
        met = both.join(known.select(F.col("node").alias("b"), "label"), "b")
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("label")))
        near = met.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("next"), own.alias("old"))
        jump = known.select(F.col("node").alias("next"), F.col("label").alias("jumped"))
        labels = near.join(jump, "next").select(
            "node", F.least("next", "jumped").alias("label"), (F.least("next", "jumped") != F.col("old")).alias("changed")
        )
        number += 1
