import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import generate, history, metrics, normalize, quality
from stratalake.plans import flows

ORDERS = [
    ("o-1001", "c-01", "120.50", "completed", "BR", "2026-08-10T10:00:00Z", "2026-08-11"),
    ("o-1002", "c-02", "80.00", "pending", "BR", "2026-08-10T11:00:00Z", "2026-08-11"),
    ("o-1003", "c-01", "45.25", "completed", "BR", "2026-08-11T09:00:00Z", "2026-08-11"),
    ("o-1004", "c-03", "200.00", "cancelled", "BR", "2026-08-11T12:00:00Z", "2026-08-11"),
    ("o-1005", "c-02", "15.00", "completed", "BR", "2026-08-11T15:00:00Z", "2026-08-11"),
    ("o-1001", "c-01", "120.50", "completed", "BR", "2026-08-10T10:00:00Z", "2026-08-12"),
]
ORDER_COLUMNS = "order_id string, customer_id string, amount string, status string, country string, event_ts string, load_at string, _ord long"


def landing(spark):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(ORDERS)], ORDER_COLUMNS)


def test_orders_run(spark, tmp_path):
    stats = flows.run_orders(landing(spark), str(tmp_path))
    assert (stats["bronze"], stats["silver"], stats["current"], stats["gold"], stats["export"]) == (6, 6, 5, 3, 3)
    rows = spark.read.json(f"{tmp_path}/gold/analytics/kpi_export").collect()
    assert {r.kpi_name: r.kpi_value for r in rows} == {"gmv_completed": 180.75, "active_customers": 3.0, "completion_rate": 0.6}
    assert {r.export_channel for r in rows} == {"analytics"}


def test_bronze_rules(spark):
    row = spark.createDataFrame([(" o ", " c ", "1.0", " DONE ", None, None)], "order_id string, customer_id string, amount string, status string, event_ts string, load_at string")
    got = normalize.orders_bronze(row).first()
    assert (got.order_id, got.customer_id, got.amount, got.status, got.country) == ("o", "c", 1.0, "done", "BR")
    with pytest.raises(Exception, match="amount is not a number"):
        normalize.orders_bronze(row.withColumn("amount", F.lit("x"))).collect()


def test_kpis_and_empty(spark):
    rows = [("a", "c1", 100.0, "completed"), ("b", "c2", 50.0, "pending")]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, amount double, status string")
    assert [r.kpi_value for r in metrics.order_kpis(df).collect()] == [100.0, 2.0, 0.5]
    assert [r.kpi_value for r in metrics.order_kpis(df.limit(0)).collect()] == [0.0, 0.0, 0.0]


def test_null_customer_counts_once(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", "x")], "order_id string, customer_id string")
    df = df.withColumn("amount", F.lit(1.0)).withColumn("status", F.lit("pending"))
    values = {r.kpi_name: r.kpi_value for r in metrics.order_kpis(df).collect()}
    assert values["active_customers"] == 2.0


def test_current_flag_against_loop(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        # One hot key holds about a third of the rows.
        key = "hot" if rng.random() < 0.35 else rng.choice("abcdefgh")
        rows.append((key, f"2024-01-{rng.randint(1, 9):02d}", i))
    df = spark.createDataFrame(rows, "k string, v string, p long").repartition(4)
    best = {}
    for key, version, place in rows:
        if key not in best or version > best[key][0]:
            best[key] = (version, place)
    flagged = history.flag_current(df, "k", "v", "p").collect()
    assert len(flagged) == len(rows)
    assert {(r.k, r.v, r.p) for r in flagged if r.is_current} == {(k, *w) for k, w in best.items()}
    only = history.current_versions(df, "k", "v", "p").collect()
    assert {(r.k, r.v, r.p) for r in only} == {(k, *w) for k, w in best.items()}
    assert [tuple(r) for r in history.sort_versions(df, "k", "v", "p").collect()] == sorted(
        sorted(rows, key=lambda r: r[2]), key=lambda r: (r[0], r[1]), reverse=True
    )


def test_hot_key_spreads_over_partitions(spark):
    count = 20_000
    df = spark.range(count).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("2024-01-01").alias("v"),
        F.col("id").alias("p"),
    )
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        flagged = history.flag_current(df, "k", "v", "p")
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == count and max(sizes) < count * 0.4
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_flag_needs_order(spark):
    with pytest.raises(ValueError, match="missing columns"):
        history.flag_current(spark.createDataFrame([("a", "b")], "k string, v string"), "k", "v", "p")


def test_last_wins_and_upsert(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("a", 3, 2), ("", 4, 3), (None, 5, 4)], "id string, x int, p long")
    assert {(r.id, r.x) for r in history.last_wins(df, "id", "p").collect()} == {("a", 3), ("b", 2)}
    new = spark.createDataFrame([("b", 9), ("c", 7)], "id string, x int")
    merged = history.upsert(df.where("p < 2").select("id", "x"), new, "id")
    assert {tuple(r) for r in merged.collect()} == {("a", 1), ("b", 9), ("c", 7)}


def test_number_rows(spark):
    rng = random.Random(3)
    keys = rng.sample(range(-500, 5000), 700)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    got = {r.k: r.n for r in history.number_rows(df, "k", "n", start=5).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), start=5)}


def test_number_rows_with_an_outlier(spark):
    keys = [*range(1000), 2**60, 2**60 + 1, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    numbered = history.number_rows(df, "k", "n")
    assert {r.k: r.n for r in numbered.collect()} == {k: i for i, k in enumerate([None, *keys[:-1]], start=1)}
    # a closed plan keeps the ranges: none holds nearly everything
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan
    assert history.number_rows(df.limit(0), "k", "n").count() == 0


def test_current_flag_needs_unique_positions(spark):
    schema = "id string, v int, p long"
    good = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("b", 1, 2), (None, 1, 3)], schema)
    flags = {(r.id, r.p): r.is_current for r in history.flag_current(good, "id", "v", "p").collect()}
    assert flags == {("a", 0): True, ("a", 1): False, ("b", 2): True, (None, 3): True}
    for rows in ([("a", 1, 0), ("a", 1, 0)], [("a", 1, None), ("a", 2, 0)]):
        with pytest.raises(Exception, match="null or repeated"):
            history.flag_current(spark.createDataFrame(rows, schema), "id", "v", "p").collect()


def test_entities_run(spark, tmp_path):
    base = {"brewery_type": "regional", "city": "Cincinnati", "state": "Ohio", "country": "United States"}
    rows = [
        {**base, "id": "0", "name": "MadTree", "longitude": "-84.42", "_ord": 0},
        {**base, "id": "1", "name": "n" * 300, "longitude": "bad", "state": "", "state_province": "New  York", "_ord": 1},
        {**base, "id": "2", "name": "Dog", "country": "", "state": "007", "_ord": 2},
        {**base, "id": "0", "name": "MadTree Duplicate", "_ord": 3},
    ]
    schema = "id string, name string, brewery_type string, city string, state string, state_province string, country string, longitude string, _ord long"
    df = spark.createDataFrame([{n.split()[0]: r.get(n.split()[0]) for n in schema.split(", ")} for r in rows], schema)
    stats = flows.run_entities(df, str(tmp_path), "2026-08-11")
    assert stats == {"landing": 4, "bronze": 4, "silver": 3, "gold": 3}
    again = flows.run_entities(df, str(tmp_path), "2026-08-11")
    assert again == stats
    gold = {r.id: r for r in spark.read.parquet(f"{tmp_path}/gold/entities").collect()}
    assert os.path.isdir(f"{tmp_path}/gold/entities/p_country=UNKNOWN/p_state=007")
    assert gold["0"].name == "MadTree Duplicate" and gold["0"].longitude is None
    assert len(gold["1"].name) == 255 and gold["1"].p_state == "NEW__YORK"
    assert (gold["0"].p_country, gold["0"].p_state, gold["2"].p_country) == ("UNITED STATES", "OHIO", "UNKNOWN")
    assert gold["0"].country == "United States"
    with pytest.raises(quality.DataQualityError, match="min_volume"):
        flows.run_entities(df, str(tmp_path), "2026-08-12", minimum=10)


def test_filters(spark):
    df = spark.createDataFrame([("1", "RJ"), ("2", "SP"), ("3", " RJ ")], "customer_id string, customer_state string")
    rules = {"customers": [normalize.FilterRule("customers_RJ", "customer_state", "RJ")], "missing": [normalize.FilterRule("x", "y", "z")]}
    out = normalize.apply_filters({"customers": df}, rules)
    assert list(out) == ["customers_RJ"] and out["customers_RJ"].count() == 2


def test_date_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 11)], "d date")
    end = dt.date(2024, 1, 9)
    assert df.where(normalize.date_window(F.col("d"), end, 3)).count() == 3
    moments = df.select(F.col("d").cast("timestamp_ntz").alias("t"))
    assert moments.where(normalize.time_window(F.col("t"), end, 3)).count() == 3
    with pytest.raises(ValueError):
        normalize.date_window(F.col("d"), end, 0)


def test_quality_report(spark):
    df = spark.createDataFrame([("1", 10.0), ("2", None), ("2", float("nan"))], "id string, amount double")
    checks = [
        quality.null_rate("id"), quality.null_rate("amount", 0.1), quality.in_range("amount", 0, 100),
        quality.in_range("amount", 20, None), quality.volume(3), quality.volume(2, 20), quality.no_duplicates("id"), quality.min_volume(4),
    ]
    rows = quality.report(df, checks).orderBy("position").collect()
    assert [r.passed for r in rows] == [True, False, True, False, True, False, False, False]
    assert rows[1].metrics == {"rows": 3.0, "nulls": 1.0, "rate": pytest.approx(1 / 3)}
    assert rows[5].message == "variance=50.00% max=20.00%"
    assert quality.gate(quality.report(df, checks), raise_on_fail=False) is False
    with pytest.raises(quality.DataQualityError, match="null_rate:amount, range:amount"):
        quality.gate(quality.report(df, checks))


def test_quality_on_empty(spark):
    empty = spark.createDataFrame([], "id string")
    row = quality.report(empty, [quality.null_rate("id")]).first()
    assert (row.name, row.passed, row.message, row.metrics) == ("null_rate", False, "empty dataset", {"rows": 0.0})


def test_export_gate_fails_on_missing_kpi(spark):
    gold = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "kpi_name string, kpi_value double")
    with pytest.raises(quality.DataQualityError, match="range:kpi_value, volume_vs_baseline"):
        quality.gate(quality.report(gold, quality.export_checks(gold)))


def test_generated_tables(spark):
    made = generate.demo_tables(spark)
    counts = {name: df.count() for name, df in made.items()}
    assert counts == {"customers": 300, "sellers": 20, "orders": 1000, "items": 1000, "payments": 1000, "reviews": 400}
    assert made["customers"].where("customer_state = 'RJ'").count() == 60
    first = made["orders"].orderBy("order_id").first()
    assert first.order_id == "ord-00001" and first.customer_id == "cust-0001" and first.order_status == "processing"
    assert first.order_purchase_timestamp == dt.datetime(2017, 1, 1, 0, 17) and first.order_delivered_carrier_date is None
    item = made["items"].orderBy("order_id").first()
    assert (str(item.price), str(item.freight_value), item.product_id) == ("23.75", "6.25", "prod-00002")
    for child, ckey, parent, pkey in (("orders", "customer_id", "customers", "customer_id"), ("items", "order_id", "orders", "order_id"), ("items", "seller_id", "sellers", "seller_id"), ("reviews", "order_id", "orders", "order_id")):
        assert quality.orphan_keys(made[child], ckey, made[parent], pkey).isEmpty()
    for name, key in (("customers", "customer_id"), ("orders", "order_id"), ("reviews", "review_id")):
        assert quality.key_duplicates(made[name], key).isEmpty()


def test_typed_copy(spark):
    df = spark.createDataFrame([("01000", " 5 ", "12.345", "longer", "2024-01-02", "")], "zip string, n string, p string, t string, d string, e string")
    schema = T.StructType([
        T.StructField("zip", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("p", T.DecimalType(10, 2)),
        T.StructField("t", T.StringType()), T.StructField("d", T.DateType()), T.StructField("e", T.DoubleType()),
    ])
    got = normalize.typed_copy(df, schema, {"t": 3}).first()
    assert (got.zip, got.n, str(got.p), got.t, got.d, got.e) == ("01000", 5, "12.35", "lon", dt.date(2024, 1, 2), None)
