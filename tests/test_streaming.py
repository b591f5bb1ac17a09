from pyspark.sql import functions as F

from stratalake.streaming import incremental

SCHEMA = "id string, x int, _ord long, load_date string"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, root, files_per_batch=None):
    stream = incremental.landing_stream(spark, f"{root}/landing", spark.createDataFrame([], SCHEMA).schema, files_per_batch=files_per_batch)
    query = incremental.incremental_silver(
        stream, lambda d: d.withColumn("x", F.col("x") * 10), f"{root}/bronze", f"{root}/silver", f"{root}/check", "id", "_ord"
    )
    query.awaitTermination()
    return {(r.id, str(r.load_date)): r.x for r in spark.read.parquet(f"{root}/silver").collect()}


def test_incremental_silver(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/landing", [("a", 1, 1, "2024-01-01"), ("a", 2, 2, "2024-01-01"), ("b", 3, 3, "2024-01-02"), (None, 9, 4, "2024-01-02")])
    assert run(spark, root) == {("a", "2024-01-01"): 20, ("b", "2024-01-02"): 30}
    # Nothing new: nothing changes. Then a late row for the first day only.
    assert run(spark, root) == {("a", "2024-01-01"): 20, ("b", "2024-01-02"): 30}
    land(spark, f"{root}/landing", [("a", 5, 9, "2024-01-01"), ("c", 6, 8, "2024-01-01")])
    assert run(spark, root) == {("a", "2024-01-01"): 50, ("c", "2024-01-01"): 60, ("b", "2024-01-02"): 30}
    assert spark.read.parquet(f"{root}/bronze").count() == 6


def test_incremental_in_small_batches(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        land(spark, f"{root}/landing", [("a", i, i, "2024-01-01")])
    assert run(spark, root, files_per_batch=1) == {("a", "2024-01-01"): 20}
    assert spark.read.parquet(f"{root}/bronze").select("batch_id").distinct().count() == 3


def test_first_wins(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", [("a", 1, 1, "d"), ("a", 1, 1, "d"), ("b", 2, 2, "d")])
    schema = spark.createDataFrame([], SCHEMA).schema

    def dedupe():
        stream = incremental.landing_stream(spark, f"{root}/in", schema)
        return incremental.run_to_table(incremental.first_wins(stream, ["id"]), f"{root}/out", f"{root}/c")

    assert dedupe().count() == 2
    land(spark, f"{root}/in", [("a", 7, 7, "d"), ("c", 3, 3, "d")])
    assert {(r.id, r.x) for r in dedupe().collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_first_wins_within_watermark(spark, tmp_path):
    root = str(tmp_path)
    df = spark.sql("select * from values ('a', timestamp'2024-01-01 10:00:00'), ('a', timestamp'2024-01-01 10:05:00'), ('b', timestamp'2024-01-01 10:01:00') t(id, ts)")
    df.coalesce(1).write.parquet(f"{root}/in")
    stream = incremental.landing_stream(spark, f"{root}/in", df.schema)
    got = incremental.run_to_table(incremental.first_wins(stream, ["id"], "ts", "1 hour"), f"{root}/out", f"{root}/c")
    assert sorted(r.id for r in got.collect()) == ["a", "b"]
