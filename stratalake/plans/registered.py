"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import payload
from stratalake.functions import text as tx
from stratalake.functions.embedding import hash_vectors
from stratalake.operators import cards, generate, history, metrics, normalize, quality, retrieval, sessions, tokenindex
from stratalake.operators.chunking import chunk_defaults, chunk_texts, split_pages
from stratalake.plans import flows
from stratalake.session import scratch
from stratalake.sources import buckets, catalog, files, jdbc, paged, sinks
from stratalake.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """The same rows dealt out to the session's shuffle partitions before a query widens them.

    A well-packed file is one task's otherwise. The number is given, so Spark does not merge parts by their packed size.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *df.columns)


def day_text(col: Column, shift: Column | int = 0) -> Column:
    return F.date_add(col.cast("date"), shift).cast("string")


# Orders ---------------------------------------------------------------------------------

#: Order states as the delivery feed words them.
STATUS = {"F": " Completed ", "O": "PENDING", "P": "cancelled"}


def _status(col: Column) -> Column:
    out = F.when(col == "F", STATUS["F"])
    return out.when(col == "O", STATUS["O"]).otherwise(STATUS["P"])


def orders_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order delivered twice: finished ones again a day later, open ones the same day, the rest with an older date."""
    o = table(spark, sf_dir, "orders")
    state = F.col("o_orderstatus")
    shift = F.when(state == "F", 1).when(state == "O", 0).otherwise(-1)

    def delivery(number: int) -> Column:
        return F.struct(
            F.lit(number).alias("number"),
            (_status(state) if number == 0 else F.lit("COMPLETED")).alias("status"),
            (day_text(F.col("o_orderdate")) if number == 0 else day_text(F.col("o_orderdate"), shift)).alias("load_at"),
        )

    return o.select(
        F.concat(F.lit(" o-"), F.col("o_orderkey"), F.lit(" ")).alias("order_id"),
        F.concat(F.lit("c-"), F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_ts"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey").alias("_key"),
        F.explode(F.array(delivery(0), delivery(1))).alias("d"),
    ).select(
        "order_id", "customer_id", "amount", "event_ts", "priority",
        F.col("d.status").alias("status"),
        F.col("d.load_at").alias("load_at"),
        (F.col("_key") * 2 + F.col("d.number")).alias("_ord"),
    )


def orders_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.orders_bronze(orders_landing(spark, sf_dir), keep=("_ord", "priority"))


def orders_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.orders_silver(orders_bronze(spark, sf_dir))


def orders_versions_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.sort_versions(orders_bronze(spark, sf_dir), "order_id", "load_at", "_ord")
    return rows.select("order_id", "load_at", "_ord", "status")


def orders_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.last_wins(orders_bronze(spark, sf_dir), "order_id", "_ord")


def shop_orders_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    later = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 5), "yyyy-MM-dd HH:mm:ss")
    state = F.col("o_orderstatus")
    landing = o.select(
        F.concat(F.lit("\t"), F.col("o_orderkey"), F.lit(" ")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        _status(state).alias("order_status"),
        day.alias("order_purchase_timestamp"),
        F.when(state == "P", "").otherwise(day).alias("order_approved_at"),
        F.when(state == "F", later).alias("order_delivered_carrier_date"),
        F.when(state == "F", later).otherwise("").alias("order_delivered_customer_date"),
        later.alias("order_estimated_delivery_date"),
    )
    return normalize.shop_orders_bronze(landing)


def kpi_orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.order_kpis(flows.current_orders(orders_bronze(spark, sf_dir)))


def kpi_metric_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = ("status", "completed")
    specs = [
        metrics.Metric("gmv_completed", "sum", "amount", done, 2),
        metrics.Metric("gmv", "sum", "amount", digits=2),
        metrics.Metric("active_customers", "count_distinct", "customer_id"),
        metrics.Metric("completing_customers", "count_distinct", "customer_id", done),
        metrics.Metric("completion_rate", "ratio", where=done, digits=4),
    ]
    return metrics.metrics(flows.current_orders(orders_bronze(spark, sf_dir)), specs, ["priority"])


def completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.completed_rows(orders_silver(spark, sf_dir)).select("order_id", "amount", "load_at")


def analytics_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.export_rows(kpi_orders_daily(spark, sf_dir))


def export_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = kpi_orders_daily(spark, sf_dir)
    return flat_report(quality.report(gold, quality.export_checks(gold)))


def layer_row_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders run over all layers in a scratch lake; its counts come from the writes."""
    stats = flows.run_orders(orders_landing(spark, sf_dir).drop("priority"), scratch(spark, "orders"))
    rows = [(name, int(value)) for name, value in stats.items()]
    return spark.createDataFrame(rows, "step string, rows bigint")


# Entities -------------------------------------------------------------------------------


def entity_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as brewery-like records: padded and blank text, unreadable numbers, two deliveries each."""
    c = dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    wide = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    segment = F.col("c_mktsegment")
    first = F.col("number") == 0
    record = wide.withColumn("number", F.explode(F.array(F.lit(0), F.lit(1))))
    return record.select(
        F.concat(F.lit("b-"), F.col("c_custkey")).alias("id"),
        F.concat(F.lit("  "), F.repeat(F.col("c_name"), 20), F.lit("\t")).alias("name"),
        F.when(first, F.lower(segment)).otherwise(segment).alias("brewery_type"),
        F.when(segment == "BUILDING", "   ").otherwise(F.concat(F.lit("Street "), F.col("c_nationkey"))).alias("address_1"),
        F.when(first, F.concat(F.lit(" "), F.col("n_name"))).alias("city"),
        F.concat(F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))), F.lit(" province")).alias("state_province"),
        F.when(segment == "MACHINERY", "").when(first, F.concat(F.lit(" "), F.lower("r_name"))).otherwise(F.col("r_name")).alias("country"),
        F.when(c.c_acctbal < 0, "bad").otherwise(F.concat(F.lit(" "), c.c_acctbal.cast("string"))).alias("longitude"),
        F.when(segment == "FURNITURE", F.concat(F.col("c_nationkey").cast("string"), F.lit("d"))).otherwise(F.col("c_nationkey").cast("string")).alias("latitude"),
        F.when(segment == "HOUSEHOLD", "").otherwise(F.col("n_name")).alias("state"),
        (F.col("c_custkey") * 2 + F.col("number")).alias("_ord"),
    )


def entity_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.entity_bronze(entity_landing(spark, sf_dir), keep=("_ord",))


def entity_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.last_wins(entity_bronze(spark, sf_dir), "id", "_ord")


def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = normalize.with_partition_keys(entity_landing(spark, sf_dir), "2024-01-30")
    return keyed.groupBy("p_country", "p_state", "load_date").agg(F.count(F.lit(1)).alias("rows"))


def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two load dates written, the first one again with fewer rows; one date read back."""
    path = scratch(spark, "partitions")
    rows = entity_silver(spark, sf_dir)
    for day, part in (
        ("2024-01-29", rows),
        ("2024-01-30", rows),
        ("2024-01-29", rows.where("brewery_type = 'BUILDING'")),
    ):
        keyed = normalize.with_partition_keys(part, day)
        sinks.write_partitions(keyed, path)
    found = files.read_partition(spark, path, "2024-01-30", schema=keyed.schema)
    return found.select("id", "p_country", "p_state", "load_date", "longitude")


def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = normalize.with_partition_keys(entity_landing(spark, sf_dir), "2024-01-30")
    return files.partition_inventory(keyed, ["p_country", "p_state", "load_date"])


def entity_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned run through all layers and its gate."""
    landing = entity_landing(spark, sf_dir)
    stats = flows.run_entities(landing, scratch(spark, "entities"), "2024-01-30")
    return spark.createDataFrame(list(stats.items()), "layer string, rows bigint")


def filter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "customer": [
            normalize.FilterRule("customer_BUILDING", "c_mktsegment", " BUILDING "),
            normalize.FilterRule("customer_MACHINERY", "c_mktsegment", "MACHINERY"),
        ],
        "unknown": [normalize.FilterRule("nothing", "x", "y")],
    }
    padded = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.concat(F.lit(" "), F.col("c_mktsegment"))
    )
    found = normalize.known_rules({"customer": padded}, rules)["customer"]
    names = F.array(*[F.lit(rule.output) for rule in found])
    kept = normalize.match_rules(padded, found)
    return kept.select(names[F.col(normalize.RULE)].alias("output"), "c_custkey", "c_mktsegment")


def filter_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of two segments written as Parquet and CSV in one scan; the CSV rows counted again."""
    customers = table(spark, sf_dir, "customer")
    rules = [normalize.FilterRule(f"customer_{name}", "c_mktsegment", name) for name in ("BUILDING", "NONE")]
    root = scratch(spark, "filtered")
    counts = sinks.write_matched(customers, rules, f"{root}/processing", f"{root}/curated")
    again = {n: files.read_csv(spark, f"{root}/curated/{n}", customers.columns) for n in counts}
    written = spark.createDataFrame(list(counts.items()), "table_name string, written bigint")
    return files.row_counts(again).join(written, "table_name")


def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kept = e.where(normalize.time_window(F.col("ts"), dt.date(2024, 1, 30), 7))
    return kept.groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type"
    ).agg(F.count(F.lit(1)).alias("events"))


# Round trips, typed copies, relational publish ------------------------------------------


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.as_text_table(table(spark, sf_dir, "conversations"))
    path = scratch(spark, "csv")
    sinks.write_csv(rows, path)
    return files.read_csv(spark, path, rows.columns)


def csv_cloud_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.as_text_table(table(spark, sf_dir, "part"))
    path = scratch(spark, "csv-cloud")
    sinks.write_csv(rows, path, cloud=True)
    return files.read_csv(spark, path, rows.columns, files.CLOUD_CSV)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").withColumn(
        "s_rating", F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))
    )
    path = scratch(spark, "json")
    sinks.write_json(rows, path)
    return files.read_json(spark, path, rows.schema)


def json_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's nation as one file that holds a JSON list, read back as records."""
    rows = table(spark, sf_dir, "supplier")
    root = scratch(spark, "lists")
    listed = F.to_json(F.array_sort(F.collect_list(F.struct(*rows.columns))))
    lists = rows.groupBy(F.col("s_nationkey").alias("nation")).agg(listed.alias("value"))
    lists.write.partitionBy("nation").text(root)
    return files.read_json_list(spark, f"{root}/*/*", rows.schema)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as CSV and read with inferred types."""
    path = scratch(spark, "inferred")
    sinks.write_csv(table(spark, sf_dir, "part"), path)
    read = files.read_csv(spark, path, infer=True)
    kinds = F.lit(",".join(f"{name}:{kind}" for name, kind in read.dtypes))
    return read.select("p_partkey", "p_name", "p_size", F.round("p_retailprice", 2).alias("p_retailprice"), kinds.alias("kinds"))


def shop_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shop run over customers and orders: landing CSV, processing, filtered outputs; rows of each table."""
    root = scratch(spark, "shop")
    names = ("customer", "orders", "nation")
    for name in names:
        sinks.write_csv(sinks.as_text_table(table(spark, sf_dir, name)), f"{root}/landing/{name}")
    rules = {"customer": [normalize.FilterRule("customer_building", "c_mktsegment", "BUILDING")]}
    columns = {name: table(spark, sf_dir, name).columns for name in names}
    made = flows.run_shop(spark, f"{root}/landing", f"{root}/processing", f"{root}/curated", columns, rules)
    counts = {f"processing/{n}": c for n, c in made["processing"].items()}
    counts |= {f"filtered/{n}": c for n, c in made["filtered"].items()}
    step = flows.run_step(spark, f"{root}/processing/orders", f"{root}/gold/open", lambda d: d.where("o_orderstatus = 'O'"))
    counts["gold/open"] = step
    return spark.createDataFrame(list(counts.items()), "place string, rows bigint")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    path = scratch(spark, "parquet")
    sinks.write_parquet(rows, path)
    return spark.read.parquet(path)


LINEITEM_TYPES = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DecimalType(12, 2)),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_shipdate", T.DateType()),
    ]
)


def typed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    text = li.select(
        F.concat(F.lit(" "), F.col("l_orderkey")).alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.col("l_quantity").cast("string").alias("l_quantity"),
        F.col("l_extendedprice").cast("string").alias("l_extendedprice"),
        F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("l_returnflag"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )
    path = scratch(spark, "typed")
    sinks.write_csv(text, path)
    landed = files.read_csv(spark, path, text.columns, {**files.PLAIN_CSV, "multiLine": "false"})
    typed = normalize.typed_copy(landed, LINEITEM_TYPES, {"l_returnflag": 1})
    return typed.groupBy("l_returnflag", F.date_format("l_shipdate", "yyyy").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("l_extendedprice").cast("double").alias("price"),
        F.sum("l_quantity").alias("quantity"),
        F.max("l_orderkey").alias("last_order"),
        F.sum("l_linenumber").alias("lines"),
    )


def publish_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a publish would send: every column as text, names checked."""
    rows = table(spark, sf_dir, "supplier")
    jdbc.check_identifier("silver", "supplier", *rows.columns)
    return sinks.as_text_table(rows)


def publish_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = list(TABLES)
    frames = {name: table(spark, sf_dir, name) for name in base}
    frames["customer_BUILDING"] = frames["customer"].where("c_mktsegment = 'BUILDING'")
    return jdbc.publish_summary(frames, base, ["customer_BUILDING"])


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.row_counts({name: table(spark, sf_dir, name) for name in TABLES})


def table_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables exported side by side as CSV, every column as text, with their counts."""
    root = scratch(spark, "export")
    counts = sinks.for_each_table(
        spark, TABLES, lambda n: sinks.write_csv(sinks.as_text_table(table(spark, sf_dir, n)), f"{root}/{n}")
    )
    return spark.createDataFrame(list(counts.items()), "table_name string, rows bigint")


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = scratch(spark, "catalog")
    sinks.write_csv(table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'"), csv)
    parquet = {name: f"{sf_dir}/{name}.parquet" for name in TABLES}
    # A database of its own, so that runs in one session do not disturb each other.
    root = scratch(spark, "lake")
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    made = catalog.register_tables(spark, database, parquet, {"customer_BUILDING": csv}, root)
    return catalog.catalog_counts(spark, made)


def lake_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = {name: f"{sf_dir}/{name}.parquet" for name in TABLES}
    layers["gold/missing"] = f"{sf_dir}/no_such_table.parquet"
    return files.layer_inventory(spark, layers)


def lake_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.lake_files(spark, sf_dir)


def lake_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.lake_files(spark, sf_dir)
    return files.inventory_report(found, lake_inventory(spark, sf_dir)).select("section", "line")


# Data quality ---------------------------------------------------------------------------


def flat_report(rows: DataFrame) -> DataFrame:
    return rows.select(
        "position", "name", "passed", "message",
        F.coalesce(*[F.col("metrics")[k] for k in ("rows", "count", "actual", "violations")]).alias("first_metric"),
    )


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") == "click", F.lit("NaN").cast("double")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("event_type"),
    )
    checks = [
        quality.null_rate("event_id"),
        quality.null_rate("user_id", 0.05),
        quality.null_rate("user_id", 0.9),
        quality.null_rate("nowhere", present=False),
        quality.in_range("value", 0, 10),
        quality.in_range("value", low=0),
        quality.in_range("user_id", 0),
        quality.volume(12_000),
        quality.volume(100, 5.0),
        quality.volume(0),
        quality.no_duplicates("event_id"),
        quality.no_duplicates("event_type"),
        quality.min_volume(100),
    ]
    return flat_report(quality.report(e, checks))


def dq_silver_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = entity_silver(spark, sf_dir)
    return flat_report(quality.report(silver, quality.entity_checks(silver)))


def dq_bronze_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = entity_bronze(spark, sf_dir)
    return flat_report(quality.report(bronze, quality.entity_checks(bronze, minimum=10**9)))


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def declared_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = quality.table_rules(table(spark, sf_dir, "orders"), ["o_orderkey"], ["o_custkey", "o_orderdate"])
    li = quality.table_rules(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_suppkey"])
    tag = lambda df, name: flat_report(df).withColumn("table_name", F.lit(name))
    return tag(o, "orders").unionByName(tag(li, "lineitem"))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders as parents leave the lines of all others without one."""
    parents = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return quality.orphan_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.orphan_keys(docs, "doc_id", labels, "doc_id")


# Reports --------------------------------------------------------------------------------


def distinct_customers_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_card(table(spark, sf_dir, "orders"), "o_custkey")


def customers_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = metrics.counts_by(table(spark, sf_dir, "customer"), "c_nationkey")
    n = table(spark, sf_dir, "nation")
    return counted.join(n, counted.c_nationkey == n.n_nationkey).select("n_name", "row_count")


def bi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold customers next to their order totals; customers without orders stay."""
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    totals = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    )
    return c.join(totals, c.c_custkey == totals.o_custkey, "left").select(
        "c_custkey", "c_name", "orders", "spent"
    )


# Generated tables -----------------------------------------------------------------------


def _numbers(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).select((F.col(key) + 1).alias("i"))


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and amounts as doubles, so two engines compare alike."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def seed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.customers(_numbers(spark, sf_dir, "customer", "c_custkey"))


def seed_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.sellers(_numbers(spark, sf_dir, "supplier", "s_suppkey"))


def seed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(generate.orders(_numbers(spark, sf_dir, "orders", "o_orderkey")))


def seed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(generate.order_items(_numbers(spark, sf_dir, "orders", "o_orderkey")))


def seed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(generate.order_payments(_numbers(spark, sf_dir, "orders", "o_orderkey")))


def seed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(generate.order_reviews(_numbers(spark, sf_dir, "orders", "o_orderkey")))


# Pages and payloads ---------------------------------------------------------------------

PER_PAGE = 50


def page_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events as pages by user number; the pull ends at the first user with few events."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") + 1).alias("page"))
    return paged.cut_pages(e, PER_PAGE)


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "click", F.concat(F.lit('{"id": 1, "name": "x", '), F.expr("substr(props, 2)"))).otherwise(F.col("props"))
    missing = files.missing_fields(text, ["id", "name", "k"])
    return e.select("event_type", F.array_join(missing, ",").alias("missing")).groupBy(
        "event_type", "missing"
    ).agg(F.count(F.lit(1)).alias("rows"))


def llm_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts dressed as model responses: fenced, with prose around, bare, broken."""
    b = table(spark, sf_dir, "benchmark")
    body = F.to_json(F.struct(F.col("text").alias("Claim"), F.array(F.lit(" a "), F.lit(""), F.substring_index("text", "\n", 1)).alias("Evidence")))
    shapes = F.array(
        F.struct(F.lit("fenced").alias("shape"), F.concat(F.lit("Here:\n```JSON\n"), body, F.lit("\n```\nbye")).alias("response")),
        F.struct(F.lit("prose").alias("shape"), F.concat(F.lit("The note is "), body, F.lit(" as asked.")).alias("response")),
        F.struct(F.lit("bare").alias("shape"), body.alias("response")),
        F.struct(F.lit("broken").alias("shape"), F.col("text").alias("response")),
    )
    rows = b.select("item_id", F.inline(shapes))
    note = payload.note_payload(F.col("response"))
    return rows.select("item_id", "shape", note.alias("note")).select(
        "item_id", "shape", F.col("note.claim").alias("claim"), F.col("note.evidence").alias("evidence")
    )


def route_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages routed by a payload whose tool and mark follow from the text."""
    c = table(spark, sf_dir, "conversations").where("role = 'user'")
    tool = F.when(F.col("turn") == 0, " ASK ").when(F.col("turn") == 2, "feedback").when(F.col("turn") == 4, "quote").otherwise("paint")
    mark = F.when(F.length("text") % 2 == 0, "SIM").otherwise("no")
    body = F.to_json(F.struct(tool.alias("Tool"), F.col("text").alias("query"), mark.alias("feedback_positive")))
    made = payload.route_payload(body)
    return c.select("conv_id", "turn", made.alias("route")).select(
        "conv_id", "turn", "route.tool", F.col("route.query").alias("query"), F.col("route.feedback_positive").alias("feedback_positive")
    )


def prompt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select("item_id", tx.fingerprint(F.col("text")).alias("prompt_sha"))


def storage_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses rewritten as storage addresses and taken apart again."""
    p = table(spark, sf_dir, "pages")
    uri = F.regexp_replace("url", r"^https?://([^./]+)\.[^/]*/", r"abfss://landing@$1.dfs.core.windows.net/")
    parts = tx.storage_uri_parts(uri)
    return p.select("page_id", *[col.alias(name) for name, col in parts.items()])


# Chunks ---------------------------------------------------------------------------------


def document_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", "text",
        F.concat(F.lit("d"), F.col("doc_id")).alias("source_id"),
        F.concat(F.col("source"), F.lit(".txt")).alias("source_path"),
    )


def paged_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out as books: each line a page, each sentence a paragraph."""
    d = document_sources(spark, sf_dir)
    text = F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit("\f")), F.lit(". "), F.lit(". \r\n\r\n"))
    return d.withColumn("text", text)


def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_texts(document_sources(spark, sf_dir))


def chunk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_texts(paged_sources(spark, sf_dir), max_chars=200, overlap=40, min_chars=20)


def page_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = split_pages(paged_sources(spark, sf_dir).select("doc_id", "text"))
    return pages.select("doc_id", "page", F.length("body").alias("chars"), F.md5(F.col("body").cast("binary")).alias("body_md5"))


def chunk_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as incomplete chunk rows, defaults filled in."""
    l = table(spark, sf_dir, "labels")  # noqa: E741
    loose = l.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, F.lit("good")).alias("title"),
        F.when(F.col("toxic") == 1, F.lit(3)).alias("page"),
    )
    return chunk_defaults(loose)


def whole_text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as one text file each, read whole and chunked by the knowledge run.

    Files of several folders share their names; the folder keeps their ids apart.
    """
    c = table(spark, sf_dir, "conversations")
    root = scratch(spark, "books")
    turns = F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("line"))))
    books = c.groupBy("conv_id").agg(F.array_join(turns["line"], "\n").alias("value"))
    books.write.partitionBy("conv_id").text(f"{root}/texts")
    texts = files.read_whole_text(spark, f"{root}/texts")
    flows.run_knowledge(texts, f"{root}/chunks", f"{root}/vectors")
    made = spark.read.parquet(f"{root}/chunks")
    vectors = buckets.read_table(spark, f"{root}/vectors")
    return retrieval.attach_vectors(made, vectors).select(
        F.regexp_extract("source_id", "^conv_id=([0-9]+)/", 1).cast("long").alias("conv_id"),
        F.regexp_extract("id", "-p([0-9]+-[0-9]+)$", 1).alias("place"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        F.size("vector").alias("dimensions"),
    )


# Vectors and retrieval ------------------------------------------------------------------


def hashed_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = retrieval.with_hashed_vectors(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.posexplode_outer("vector").alias("dimension", "weight")).where(
        "weight > 0"
    ).withColumn("weight", F.round("weight", 9))


def custom_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors through the hook for any Python embedder, in batches of sixteen."""

    def embed(texts: list[str]) -> list[list[float]]:
        return hash_vectors(texts).tolist()

    d = retrieval.embed_with(table(spark, sf_dir, "documents").select("doc_id", "text"), embed)
    return d.select("doc_id", F.posexplode_outer("vector").alias("dimension", "weight")).where(
        "weight > 0"
    ).withColumn("weight", F.round("weight", 9))


def label_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every vector with the mean vector of its label."""
    e = table(spark, sf_dir, "embeddings")
    means = label_means(e)
    paired = e.join(means, e.label == means.query_id)
    return paired.select("vec_id", F.round(tx.cosine(F.col("embedding"), F.col("vector")), 9).alias("cosine"))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one chunk; the document number keeps the input order."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"),
        F.col("lang").alias("title"),
        "text",
        F.col("source").alias("source_id"),
        (F.col("doc_id") % 7).cast("int").alias("page"),
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


HIT = ["id", "page", "title", "text"]


def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = document_chunks(spark, sf_dir)
    return retrieval.keyword_top_k(benchmark_queries(spark, sf_dir), chunks, ["doc_id"], HIT)


def _scored(df: DataFrame) -> DataFrame:
    return df.select("query_id", "id", "rank", F.round("score", 9).alias("score"))


def keyword_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = document_chunks(spark, sf_dir)
    return _scored(retrieval.keyword_top_k(benchmark_queries(spark, sf_dir), chunks, ["doc_id"]))


def keyword_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search through the token index, which large query tables take."""
    chunks = document_chunks(spark, sf_dir)
    return _scored(tokenindex.keyword_top_k(benchmark_queries(spark, sf_dir), chunks, ["doc_id"], ["id"], retrieval.TOP_K))


def label_means(e: DataFrame) -> DataFrame:
    return (
        e.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
        .select("query_id", F.transform("v", lambda p: p["x"]).alias("vector"))
    )


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label against all vectors."""
    e = table(spark, sf_dir, "embeddings")
    means = label_means(e)
    chunks = e.select("vec_id", F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"))
    return _scored(retrieval.vector_top_k(means, chunks, ["vec_id"]))


def vector_groups_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by groups of chunks, which large query tables take."""
    e = table(spark, sf_dir, "embeddings")
    chunks = e.select("vec_id", F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"))
    return _scored(retrieval.grouped_vector_top_k(label_means(e), chunks, ["vec_id"]))


def vector_topk_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label against all vectors, those of label 3 spoilt: they score no number and are no hits."""
    e = table(spark, sf_dir, "embeddings")
    spoilt = F.transform("embedding", lambda x: F.when(F.col("label") == 3, F.lit(float("nan"))).otherwise(x))
    chunks = e.select("vec_id", F.col("vec_id").cast("string").alias("id"), spoilt.alias("vector"))
    return _scored(retrieval.vector_top_k(label_means(e), chunks, ["vec_id"]))


def text_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts against documents by hashed vectors."""
    chunks = document_chunks(spark, sf_dir)
    return _scored(retrieval.text_vector_top_k(benchmark_queries(spark, sf_dir), chunks, ["doc_id"]))


def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = document_chunks(spark, sf_dir)
    return _scored(retrieval.hybrid_top_k(benchmark_queries(spark, sf_dir), chunks, ["doc_id"]))


def hybrid_stored_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hybrid search over a stored vector table, joined to its chunks one to one."""
    chunks = document_chunks(spark, sf_dir)
    vectors = sinks.stored(retrieval.with_hashed_vectors(chunks).select("id", "vector"), "vectors")
    asked = retrieval.with_hashed_vectors(benchmark_queries(spark, sf_dir), "query")
    return _scored(retrieval.hybrid_top_k(asked, retrieval.attach_vectors(chunks, vectors), ["doc_id"], stored=True))


def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label sent again with turned signs, and as many new ids; one row per number."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    again = e.where("label = 3").withColumn("embedding", F.transform("embedding", lambda x: -x))
    fresh = again.unionByName(again.withColumn("vec_id", -F.col("vec_id") - 1))
    made = history.upsert(e, fresh, "vec_id").select("vec_id", "label", F.posexplode("embedding").alias("dimension", "x"))
    return made.withColumn("x", F.round(F.col("x").cast("double"), 6))


def bucket_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch sent to a stored table in buckets, of which the touched ones are rewritten."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    again = e.where("label = 3").withColumn("embedding", F.transform("embedding", lambda x: -x))
    path = scratch(spark, "vectors")
    buckets.upsert_table(e, path, "vec_id")
    buckets.upsert_table(again.unionByName(again.withColumn("vec_id", -F.col("vec_id") - 1)), path, "vec_id")
    made = buckets.read_table(spark, path).select("vec_id", "label", F.posexplode("embedding").alias("dimension", "x"))
    return made.withColumn("x", F.round(F.col("x").cast("double"), 6))


def found_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts and a question nothing answers, each with its hits.

    The unanswerable one is derived from each text by turning its letters into digits.
    """
    b = benchmark_queries(spark, sf_dir)
    odd = b.select(
        (-F.col("query_id") - 1).alias("query_id"),
        F.translate(F.lower("query"), "abcdefghijklmnopqrstuvwxyz", "0123456789").alias("query"),
    )
    asked = b.unionByName(odd.withColumn("query", F.concat(F.lit("#"), F.replace("query", F.lit(" "), F.lit("#")))))
    hits = retrieval.keyword_top_k(asked, document_chunks(spark, sf_dir), ["doc_id"], HIT)
    return cards.with_hits(asked, hits)


def retrieval_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cards.answer_cards(found_queries(spark, sf_dir))
    cited = F.array_join(F.transform("citations", lambda c: F.concat(c["chunk_id"], F.lit(":"), c["page"])), ",")
    return made.select("query_id", "answer", cited.alias("cited"), "covered", "offer_example")


def example_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.example_cards(found_queries(spark, sf_dir)).select("query_id", "scenario", "covered")


def quote_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cards.quote_cards(found_queries(spark, sf_dir))
    return made.select(
        "query_id",
        F.posexplode_outer("passages").alias("position", "p"),
        "covered",
    ).select("query_id", "position", F.col("p.chunk_id").alias("chunk_id"), F.col("p.page").alias("page"), F.md5(F.col("p.text").cast("binary")).alias("text_md5"), "covered")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered notes of the covered queries, with their filled template."""
    # Numbering reads the notes twice, so they are stored first.
    made = cards.render_notes(cards.note_records(found_queries(spark, sf_dir)))
    made = sinks.stored(made, "notes")
    existing = table(spark, sf_dir, "region")
    keyed = sinks.append_numbered(existing, made, "query_id")
    return keyed.select(
        "query_id", "note_key", "claim", F.md5(F.col("evidence").cast("binary")).alias("evidence_md5"),
        F.col("template.pages").alias("pages"), F.array_join("chunk_ids", ",").alias("chunk_ids"),
    )


def golden_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases built on the benchmark: expectations that hold for some and fail for others."""
    found = found_queries(spark, sf_dir)
    i = F.abs("query_id")
    return found.select(
        "*",
        F.when(F.length("query") % 3 == 0, "quote").when(F.length("query") % 3 == 1, "note").otherwise("ask").alias("task"),
        (F.col("query_id") >= 0).alias("expect_covered"),
        F.when(F.col("query_id") >= 0, F.array((i % 7).cast("int"), (i % 3).cast("int"))).alias("pages"),
        F.array(F.substring_index("query", " ", 1), F.lit("no such term")).alias("terms"),
        (F.length("query") % 2 == 0).alias("cite_pages"),
    )


def retrieval_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = cards.evaluate_cases(golden_cases(spark, sf_dir))
    return judged.select("query_id", "ok", F.array_join("errors", " | ").alias("errors"))


def eval_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.pass_rate(cards.evaluate_cases(golden_cases(spark, sf_dir))).withColumn("rate", F.round("rate", 6))


def prompt_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_queries(spark, sf_dir)
    return found.select("query_id", F.md5(cards.hits_as_text(F.col("hits")).cast("binary")).alias("context_md5"))


# Sessions -------------------------------------------------------------------------------


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages with a short one after each: its last words, a question, or an opening."""
    c = table(spark, sf_dir, "conversations").where("role = 'user'")
    words = F.split(F.col("text"), r"\s+")
    kind = F.length("text") % 4
    short = (
        F.when(kind == 0, F.array_join(F.slice(words, 1, 2), " "))
        .when(kind == 1, F.lit("explica melhor"))
        .when(kind == 2, F.concat(F.lit("E "), F.col("text")))
        .otherwise(F.lit("  "))
    )
    both = F.array(F.struct(F.lit(0).alias("n"), F.col("text").alias("message")), F.struct(F.lit(1).alias("n"), short.alias("message")))
    return c.select("conv_id", "turn", F.inline(both)).select(
        "conv_id", (F.col("turn") * 2 + F.col("n")).alias("turn"), "message"
    )


def followup_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.bind_followups(user_messages(spark, sf_dir), "conv_id", "turn", "message")


def last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return sessions.last_turns(c, "conv_id", "turn", "text").select("conv_id", "turn", "role", "snippet")


def feedback_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "user_id",
        "event_id",
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" "), F.get_json_object("props", "$.k"), F.lit(" ")).alias("comment"),
        (F.col("event_type") != "error").alias("positive"),
        F.when(F.col("value") > 20, "long").when(F.col("value") > 5, "odd").alias("length"),
        F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type")).alias("tone"),
    )


def preference_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sessions.preference_profiles(
        feedback_rows(spark, sf_dir), "user_id", "event_id", "comment", "positive", ("length", "tone")
    )
    return sessions.style_block(made).select(
        "user_id", "positive_count", "updated_at", "length", "tone", F.array_join("likes", "|").alias("likes"), "style_block"
    )


def preference_profile_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the event type as comment: no user has more than eight."""
    rows = feedback_rows(spark, sf_dir).withColumn("comment", F.split_part(F.btrim("comment"), F.lit(" "), F.lit(1)))
    made = sessions.preference_profiles(rows, "user_id", "event_id", "comment", "positive")
    return made.select("user_id", "positive_count", F.array_join("likes", "|").alias("likes"))


def _traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    words = F.size(F.split(F.col("text"), r"\s+"))
    return sessions.trace_rows(
        c,
        ["expand", "retrieve", "ask"],
        F.concat(F.col("role"), F.lit(".v1")),
        F.col("text"),
        tokens_in=words,
        tokens_out=F.when(F.col("role") == "assistant", words),
        elapsed_ms=F.length("text"),
    )


def trace_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sessions.trace_summary(_traces(spark, sf_dir))
    return made.withColumn("avg_elapsed_ms", F.round("avg_elapsed_ms", 6))


def last_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sessions.last_turns(_traces(spark, sf_dir), "conv_id", "turn")
    return made.select("conv_id", "turn", "prompt_id", "prompt_sha", F.array_join("steps", ">").alias("steps"), "tokens_in")


# Streams --------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, since a stream takes a folder or a pattern but no single file.
    schema = table(spark, sf_dir, "events").schema
    return incremental.landing_stream(spark, f"{sf_dir}/event[s].parquet", schema)


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice; one whole row per event remains."""
    return _deduped(spark, sf_dir)


def stream_dedupe_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with keys that are forgotten 40 days after their event, so that state is bounded."""
    return _deduped(spark, sf_dir, "40 days")


def _deduped(spark: SparkSession, sf_dir: str, delay: str | None = None) -> DataFrame:
    # A session of its own, whose state store is set without touching the caller's.
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", incremental.ROCKSDB)
    twice = _event_stream(own, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(1)))).drop("copy")
    root = scratch(spark, "stream-dedupe")
    schema = twice.schema
    # A watermark needs an instant; the session's time zone does not change distances.
    timed = twice.withColumn("_at", F.col("ts").cast("timestamp")) if delay else twice
    once = incremental.first_wins(timed, ["event_id"], "_at" if delay else None, delay)
    incremental.run_to_table(once.select(schema.names), f"{root}/rows", f"{root}/checkpoint")
    return spark.read.schema(schema).parquet(f"{root}/rows")


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing events into bronze and silver by day; per user and day the last event stays."""
    root = scratch(spark, "stream-silver")

    def to_bronze(df: DataFrame) -> DataFrame:
        return df.select(
            F.concat(F.lit("u-"), F.col("user_id")).alias("id"),
            F.upper("event_type").alias("kind"),
            F.col("event_id").alias("_ord"),
            F.date_format("ts", "yyyy-MM-dd").alias("load_date"),
        )

    incremental.incremental_silver(
        _event_stream(spark, sf_dir), to_bronze, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", "id", "_ord"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/silver").withColumn("load_date", F.col("load_date").cast("string"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        orders_bronze, shop_orders_bronze, entity_bronze, orders_silver, orders_versions_sorted,
        orders_latest, entity_silver, kpi_orders_daily, kpi_metric_spec, completed_orders,
        analytics_export, export_gate, layer_row_stats, filter_rules, filter_outputs, partition_keys,
        partition_roundtrip, partition_inventory, entity_layers, date_window, csv_roundtrip,
        csv_cloud_roundtrip, json_roundtrip, json_list_roundtrip, csv_inferred, shop_flow, parquet_roundtrip, typed_copy, publish_text,
        publish_summary, layer_counts, table_exports, catalog_tables, lake_inventory,
        lake_file_list, lake_report, dq_report, dq_silver_gate, dq_bronze_duplicates, pk_duplicates,
        declared_rules, fk_orphans, unlabelled_documents, distinct_customers_card,
        customers_by_nation, bi_join, seed_customers, seed_sellers, seed_orders, seed_items,
        seed_payments, seed_reviews, page_cut, required_fields, llm_json_extract, route_extract,
        prompt_fingerprint, storage_uris, chunk_documents, chunk_pages, page_split,
        chunk_projection, whole_text_chunks, hashed_embeddings, custom_embeddings, label_cosine, keyword_topk, keyword_index_topk, vector_topk, vector_groups_topk,
        vector_topk_gaps, text_vector_topk, hybrid_topk, hybrid_stored_topk, vector_upsert, bucket_upsert, retrieval_cards, example_cards, quote_cards,
        notes, retrieval_eval, eval_pass_rate, prompt_context, followup_binding, last_turn,
        preference_profile, preference_profile_few, trace_summary, last_trace, stream_dedupe,
        stream_dedupe_watermark, stream_incremental,
    )
}
