"""The registered queries of this folder: results over whole tables, and DuckDB where SQL can express them."""

import duckdb
import pytest

from stratalake.llm import queries

TABLES = ("documents", "pages", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_duckdb(spark, sf_dir, name):
    link = duckdb.connect()
    for t in TABLES:
        link.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    made = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(made.columns)
    cursor = link.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in made.select(columns).collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_one_row_per_document_or_page(spark, sf_dir, name):
    table = "pages" if name.startswith("op10") else "documents"
    key = table[:-1].replace("document", "doc") + "_id"
    ids = [r[0] for r in queries.QUERIES[name](spark, sf_dir).select(key).collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())


def test_numbering():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
