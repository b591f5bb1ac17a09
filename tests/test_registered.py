"""Every registered query against its SQL counterpart on the small tables, and its plan."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from stratalake.plans import registered
from stratalake.plans.oracles import ORACLES
from stratalake.plans.registered import QUERIES, TABLES

#: No SQL counterpart: these depend on how files are laid out.
LAYOUT_ONLY = {"lake_file_list", "lake_report"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if value is None or value is pd.NA or (isinstance(value, float) and np.isnan(value)):
        return "null"
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (float, np.floating, int, np.integer)):
        return f"{float(value):.9g}"
    return str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def test_every_query_has_a_counterpart():
    assert set(QUERIES) - set(ORACLES) == LAYOUT_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)


@pytest.mark.parametrize("name", sorted(LAYOUT_ONLY))
def test_layout_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_points_offer_them_all():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["kpi_name", "kpi_value", "country", "grain"]


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


#: These write files before they return, so their plan is only the read at the end.
WRITERS = {
    "layer_row_stats", "entity_layers", "partition_roundtrip", "filter_outputs", "csv_roundtrip", "csv_cloud_roundtrip",
    "json_roundtrip", "json_list_roundtrip", "csv_inferred", "shop_flow", "parquet_roundtrip", "typed_copy", "table_exports", "catalog_tables", "whole_text_chunks",
    "stream_dedupe", "stream_dedupe_watermark", "stream_incremental", "notes",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_pairwise_joins_and_no_row_udfs(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    # A nested-loop join only ever meets a one-row side: the page cut.
    assert plan.count("BroadcastNestedLoopJoin") <= (1 if name == "page_cut" else 0)


@pytest.mark.parametrize("name", ["chunk_documents", "chunk_pages", "orders_bronze", "seed_orders", "hashed_embeddings", "page_split", "llm_json_extract"])
def test_row_local_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(spark, sf_dir, name)


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "date_window")
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan and "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = plan_of(spark, sf_dir, "fk_orphans")
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_entity_rows_are_dealt_out_before_they_are_widened(spark, tmp_path):
    """One small file of many customers, one of them twice and one without a key: no task gets most of the wide rows."""
    keys = "CASE WHEN id = 999 THEN NULL WHEN id = 998 THEN 1 ELSE id END"
    customers = spark.range(1000).selectExpr(
        f"{keys} AS c_custkey", f"concat('Customer#', {keys}) AS c_name", "cast(id % 2 AS int) AS c_nationkey",
        "cast(id AS double) AS c_acctbal", "'BUILDING' AS c_mktsegment",
    )
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    nations = "SELECT * FROM VALUES (0, 'A_B', 0), (1, 'C', 0) AS t(n_nationkey, n_name, n_regionkey)"
    spark.sql(nations).write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0 AS r_regionkey, 'EUROPE' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    sizes = registered.entity_landing(spark, str(tmp_path)).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 2000 and max(sizes) < 1000
    made = QUERIES["entity_silver"](spark, str(tmp_path)).collect()
    assert sorted(r["id"] for r in made) == sorted(f"b-{n}" for n in range(998))
