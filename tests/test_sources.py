import json
import os
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import normalize
from stratalake.operators.normalize import FilterRule
from stratalake.plans import flows
from stratalake.session import scratch, shared_root
from stratalake.sources import buckets, catalog, files, jdbc, paged, sinks

ZIPS = [("c1", "01000", "RJ", 'say "hi", x'), ("c2", "20000", "SP", "back\\slash"), ("c3", "00001", " RJ ", None)]
ZIP_COLUMNS = "customer_id string, zip string, customer_state string, note string"


def zips(spark):
    return spark.createDataFrame(ZIPS, ZIP_COLUMNS)


@pytest.mark.parametrize("cloud", [False, True])
def test_csv_keeps_text(spark, tmp_path, cloud):
    path = str(tmp_path / "csv")
    df = zips(spark)
    assert sinks.write_csv(df, path, cloud) == 3
    got = files.read_csv(spark, path, df.columns, files.CLOUD_CSV if cloud else files.PLAIN_CSV)
    assert {tuple(r) for r in got.collect()} == set(ZIPS)


def test_csv_spans_lines(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", '"q"')], "x string, y string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "c"), df.columns).collect()] == [("a\nb", '"q"')]


def test_inference_is_opt_in(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(zips(spark), path)
    assert dict(files.read_csv(spark, path).dtypes)["zip"] == "string"
    assert dict(files.read_csv(spark, path, infer=True).dtypes)["zip"] == "int"


def test_empty_writes(spark, tmp_path):
    empty = zips(spark).limit(0)
    for write in (sinks.write_csv, sinks.write_parquet):
        with pytest.raises(sinks.EmptyWrite):
            write(empty, str(tmp_path / "x"))
    assert sinks.write_json(empty, str(tmp_path / "j")) == 0
    counts = sinks.write_matched(empty, [FilterRule("none", "zip", "x")], str(tmp_path / "p"), str(tmp_path / "c"))
    assert counts == {"none": 0} and spark.read.parquet(str(tmp_path / "p" / "none")).columns == empty.columns


def test_json_keeps_nulls_and_refuses_objects(spark, tmp_path):
    sinks.write_json(zips(spark), str(tmp_path / "j"))
    lines = spark.read.text(str(tmp_path / "j")).collect()
    assert sum('"note":null' in r.value for r in lines) == 1
    listed = tmp_path / "list.json"
    listed.write_text(json.dumps([{"customer_id": "c", "zip": "01"}, {"customer_id": "d"}], indent=1))
    rows = files.read_json_list(spark, str(listed), zips(spark).schema).collect()
    assert [(r.customer_id, r.zip) for r in rows] == [("c", "01"), ("d", None)]
    listed.write_text("[]")
    assert files.read_json_list(spark, str(listed), zips(spark).schema).count() == 0
    for broken in ('"text"', '{"customer_id": "c"}', "[1", "[1]"):
        listed.write_text(broken)
        with pytest.raises(Exception):
            files.read_json_list(spark, str(listed), zips(spark).schema).collect()


def test_partition_overwrite_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "BR" if i % 3 else "US", f"2024-01-0{1 + i % 2}") for i in range(40)]
    df = spark.createDataFrame(rows, "i int, p_country string, load_date string").withColumn("p_state", F.lit("X"))
    assert sinks.write_partitions(df, path)["rows"] == 40
    assert sinks.write_partitions(df.where("load_date = '2024-01-01' and p_country = 'BR'").limit(1), path)["rows"] == 1
    assert files.read_partition(spark, path, "2024-01-02").count() == 20
    assert files.read_partition(spark, path, "2024-01-01").where("p_country = 'BR'").count() == 1
    plan = files.read_partition(spark, path, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan


def test_inventory(spark, tmp_path):
    root = str(tmp_path / "lake")
    sinks.write_parquet(zips(spark), f"{root}/bronze/customers")
    listing = files.lake_files(spark, root).collect()
    assert [r.path for r in listing] == sorted(r.path for r in listing)
    assert all(r.path.startswith("bronze/customers/part-") and r.size_bytes > 0 for r in listing)
    layers = {"bronze": f"{root}/bronze/customers", "gold": f"{root}/gold/customers"}
    found = files.layer_inventory(spark, layers)
    assert {tuple(r) for r in found.select("table_name", "rows", "exists").collect()} == {("bronze", 3, True), ("gold", 0, False)}
    lines = [r.line for r in files.inventory_report(files.lake_files(spark, root), found, "demo").collect()]
    assert lines[:3] == ["=== demo ===", "  [MISSING] gold", "  [OK] bronze: rows=3"]
    summary = files.partition_inventory(zips(spark), ["customer_state"]).first()
    assert (summary.partitions, summary.total_rows) == (3, 3)


def test_whole_text(spark, tmp_path):
    (tmp_path / "book.txt").write_bytes("é one\n\ntwo".encode() + b"\xff")
    row = files.read_whole_text(spark, str(tmp_path / "book.txt")).first()
    assert (row.source_path, row.source_id, row.text) == ("book.txt", "book", "é one\n\ntwo\ufffd")
    with pytest.raises(Exception):
        files.read_whole_text(spark, str(tmp_path / "none.txt")).collect()


def test_whole_text_ids_are_unique(spark, tmp_path):
    from stratalake.operators import retrieval
    from stratalake.plans import flows

    for folder in ("a", "b c", "d+e"):
        (tmp_path / "texts" / folder).mkdir(parents=True)
        (tmp_path / "texts" / folder / "same.txt").write_text(f"The text of {folder}. " * 20)
    for path in (str(tmp_path / "texts"), str(tmp_path / "texts" / "*"), f"file://{tmp_path}/texts"):
        ids = sorted(r.source_id for r in files.read_whole_text(spark.newSession() if path.endswith("*") else spark, path + ("" if path.endswith("*") else "/*/*.txt")).collect())
        assert ids == ["a/same", "b c/same", "d+e/same"]
    flows.run_knowledge(files.read_whole_text(spark, str(tmp_path / "texts" / "*")), str(tmp_path / "chunks"), str(tmp_path / "vectors"))
    chunks, vectors = spark.read.parquet(str(tmp_path / "chunks")), buckets.read_table(spark, str(tmp_path / "vectors"))
    joined = retrieval.attach_vectors(chunks, vectors)
    assert joined.count() == chunks.count() == 3 and joined.columns == [*chunks.columns, "vector"]
    few = chunks.limit(2)
    for bad in ((few, vectors), (chunks, vectors.limit(2)), (chunks.union(few), vectors), (chunks, vectors.union(vectors))):
        with pytest.raises(Exception, match="no chunk|no vector|more than one"):
            retrieval.attach_vectors(*bad).collect()


def test_empty_writes_leave_the_target(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    for write, name in ((sinks.write_csv, "c"), (sinks.write_parquet, "p")):
        path = str(tmp_path / "deep" / name)
        assert write(df, path) == 2 and write(df.limit(1), path) == 1
        with pytest.raises(sinks.EmptyWrite):
            write(df.limit(0), path)
        assert sorted(p.name for p in (tmp_path / "deep").iterdir() if p.name.startswith(name)) == [name]
        assert spark.read.option("header", "true").format("csv" if name == "c" else "parquet").load(path).count() == 1


def test_long_payloads_keep_their_keys(spark, tmp_path):
    from stratalake.plans.registered import QUERIES

    long = '{"k": 1, "pad": "' + "x" * 20_000 + '"}'
    spark.createDataFrame([("click", long), ("view", long)], "event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_type: r.missing for r in QUERIES["required_fields"](spark, str(tmp_path)).collect()}
    assert got == {"click": "", "view": "id,name"}


def test_pages_are_fetched_once(spark, tmp_path, monkeypatch):
    import json

    for n in (1, 2, 3):
        (tmp_path / f"{n}.json").write_text(json.dumps([{"id": i} for i in range(2 if n < 3 else 1)]))
    got = paged.read_pages(spark, f"file://{tmp_path}/{{page}}.json", per_page=2, max_pages=4)
    for n in (1, 2, 3):
        (tmp_path / f"{n}.json").unlink()
    # the files are gone, so whatever is read now was stored by the one pull
    assert got.count() == 5 and got.agg(F.max("page")).first()[0] == 3
    with pytest.raises(Exception, match="max_pages"):
        spark.read.format("paged_json").option("url", "file:///none").load().collect()


def test_pull_ends_with_the_wave_of_the_short_page(spark, tmp_path):
    """A page past the first wave is no JSON, so a pull that asked for it would fail."""
    for n in range(1, 13):
        body = json.dumps([{"id": i} for i in range(1 if n == 3 else 2)]) if n <= 4 else "broken"
        (tmp_path / f"{n}.json").write_text(body)
    url = f"file://{tmp_path}/{{page}}.json"
    got = paged.read_pages(spark, url, per_page=2, max_pages=1000, wave=4)
    assert got.count() == 5
    with pytest.raises(Exception):
        paged.read_pages(spark, url, per_page=2, max_pages=1000, wave=5).count()
    # Full pages up to the end of a wave: the next wave has the end, even if it is empty.
    (tmp_path / "3.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    for n in range(5, 13):
        (tmp_path / f"{n}.json").unlink()
    for wave in (1, 2, 3, 4, 9):
        assert paged.read_pages(spark, url, per_page=2, max_pages=1000, wave=wave).count() == 8
    assert paged.read_pages(spark, url, per_page=2, max_pages=3, wave=2).count() == 6
    assert paged.read_pages(spark, url, per_page=2, max_pages=0).count() == 0
    with pytest.raises(ValueError):
        paged.read_pages(spark, url, per_page=2, max_pages=3, wave=0)


def test_rules_share_one_scan(spark, tmp_path):
    rows = [(i, [" a ", "b", "c", None][i % 4], str(i % 3)) for i in range(40)]
    spark.createDataFrame(rows, "id int, kind string, code string").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    rules = [FilterRule("a", "kind", "a"), FilterRule("b=/x", "kind", " b"), FilterRule("one", "code", "1"), FilterRule("no", "kind", "z"), FilterRule("a", "id", "7")]
    plan = normalize.match_rules(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    counts = sinks.write_matched(df, rules, str(tmp_path / "p"), str(tmp_path / "c"))
    frames = normalize.apply_filters({"t": df}, {"t": rules, "gone": rules})
    assert counts == {name: frame.count() for name, frame in frames.items()} == {"a": 1, "b=/x": 10, "one": 13, "no": 0}
    for name, frame in frames.items():
        kept = spark.read.parquet(str(tmp_path / "p" / name))
        assert kept.columns == df.columns and sorted(kept.collect(), key=str) == sorted(frame.collect(), key=str)
    again = sinks.write_matched(df, rules[2:3], str(tmp_path / "p"), str(tmp_path / "c"))
    assert again == {"one": 13} and sorted(os.listdir(tmp_path / "p")) == ["a", "b=", "no", "one"]
    assert sinks.write_matched(df, [], str(tmp_path / "p"), str(tmp_path / "c")) == {}
    with pytest.raises(ValueError):
        normalize.match_rules(df.withColumn("_rule", F.lit(1)), rules)


def test_replacing_keeps_the_old_table_until_the_new_one_stands(spark, tmp_path):
    old = tmp_path / "t"
    sinks.write_parquet(zips(spark), str(old))
    with pytest.raises(OSError):
        files.move_path(spark, str(tmp_path / "nowhere"), str(old))
    assert spark.read.parquet(str(old)).count() == zips(spark).count()
    sinks.write_parquet(zips(spark).limit(1), str(old))
    assert spark.read.parquet(str(old)).count() == 1 and os.listdir(tmp_path) == ["t"]


def test_required_fields(spark):
    files.require_fields(zips(spark), ["zip"])
    with pytest.raises(files.MissingFields, match="id, name"):
        files.require_fields(zips(spark), ["id", "name", "zip"])
    df = spark.createDataFrame([('{"id": 1}',), (None,), ("[]",)], "j string")
    got = [r.o for r in df.select(files.missing_fields(F.col("j"), ["name", "id"]).alias("o")).collect()]
    assert got == [["name"], ["id", "name"], ["id", "name"]]


def test_choose_source():
    pick = lambda **kw: files.choose_source(lambda p: p, lambda: "api", **kw)
    assert pick(path="x", use_fixture=True, default_path="d") == "x"
    assert pick(use_fixture=True, default_path="d") == "d"
    assert pick() == "api"


def test_addresses():
    assert files.table_path("s3a://b", "dev", "app", "gold", "kpi", "t") == "s3a://b/dev/app/gold/kpi/t"
    assert files.zone_path("abfss://{zone}@a.dfs.core.windows.net/", "curated", "t.csv") == "abfss://curated@a.dfs.core.windows.net/t.csv"
    with pytest.raises(ValueError):
        files.zone_path("/x", "nowhere", "t")
    with pytest.raises(ValueError):
        files.table_path("/x", "dev", "app", "copper", "a", "b")


def plain_cut(counts, per_page, limit):
    page = 1
    while page <= limit and counts.get(page, 0) == per_page:
        page += 1
    return page


def test_page_cut_against_loop(spark):
    rng = random.Random(1)
    for _ in range(6):
        counts = {p: (5 if rng.random() < 0.8 else rng.randint(0, 4)) for p in range(1, 9)}
        rows = [(p, i) for p, n in counts.items() for i in range(n)]
        df = spark.createDataFrame(rows, "page int, i int")
        limit = rng.randint(1, 9)
        last = plain_cut(counts, 5, limit)
        expected = {r for r in rows if r[0] <= min(last, limit)}
        assert {tuple(r) for r in paged.cut_pages(df, 5, limit).collect()} == expected


def test_paged_source_reads_page_files(spark, tmp_path):
    for page, size in ((1, 3), (2, 3), (3, 1), (4, 3)):
        (tmp_path / f"p{page}.json").write_text(json.dumps([{"id": f"{page}-{i}", "name": "é"} for i in range(size)]))
    url = f"file://{tmp_path}/p{{page}}.json"
    got = paged.read_pages(spark, url, per_page=3, max_pages=6, required_fields="id,name", by_city=None)
    assert got.count() == 7 and got.select("page").distinct().count() == 3
    assert json.loads(got.orderBy("page", "position").first().record) == {"id": "1-0", "name": "é"}
    assert paged.read_pages(spark, url, per_page=3, max_pages=1).count() == 3
    with pytest.raises(Exception, match="required"):
        paged.read_pages(spark, url, per_page=3, max_pages=2, required_fields="missing").collect()


def test_page_url():
    reader = paged.PagedReader({"url": "http://x/b", "per_page": "2", "max_pages": "3", "filter.by_city": "rio"})
    assert reader.page_url(3) == "http://x/b?by_city=rio&per_page=2&page=3"
    assert len(reader.partitions()) == 3


def test_identifiers_and_publish_options():
    for bad in ("customers; DROP TABLE", "1a", "", "a-b", "a\n"):
        with pytest.raises(ValueError):
            jdbc.check_identifier(bad)
    with pytest.raises(ValueError):
        jdbc.publish_options(["a b"], "u", "gold", "t")
    with pytest.raises(ValueError):
        jdbc.publish_options(["a"], "u", "copper", "t")
    options = jdbc.publish_options(["a", "b"], "u", "gold", "t", column_type="VARCHAR(50)")
    assert options["dbtable"] == "gold.t" and options["createTableColumnTypes"] == "a VARCHAR(50), b VARCHAR(50)"
    assert jdbc.publish_options(["a"], "u", "gold", "t", "truncate")["truncate"] == "true"
    read = jdbc.read_options("u", "dbo.orders", jdbc.Split("id", 1, 100, 8))
    assert (read["partitionColumn"], read["numPartitions"], read["upperBound"]) == ("id", "8", "100")


def test_publish_plan_and_empty_source(spark):
    assert jdbc.publish_plan(["a", "b"], ["f"]) == [("bronze", "a"), ("bronze", "b"), ("silver", "a"), ("silver", "b"), ("silver", "f"), ("gold", "f")]
    # An empty source never opens a connection.
    assert jdbc.publish_table(zips(spark).limit(0), "jdbc:none", "gold", "t") == 0
    frames = {("bronze", "a"): zips(spark).limit(0), ("silver", "a"): zips(spark).limit(0)}
    assert jdbc.publish_all(frames, "jdbc:none", ["a"], [])["total_rows"] == 0
    text = sinks.as_text_table(spark.sql("select 1 as a, 2.50 as b, array(1,2) as c, true as d"))
    assert tuple(text.first()) == ("1", "2.50", "[1,2]", "true")


def test_shop_run_and_catalog(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_csv(zips(spark), f"{root}/landing/customers")
    out = flows.run_shop(
        spark, f"{root}/landing", f"{root}/processing", f"{root}/curated",
        {"customers": zips(spark).columns}, {"customers": [FilterRule("customers_RJ", "customer_state", "RJ")]}, "shop_db",
    )
    assert out["processing"] == {"customers": 3} and out["filtered"] == {"customers_RJ": 2}
    counts = {r.table_name: r.rows for r in catalog.catalog_counts(spark, out["tables"]).collect()}
    assert counts == {"customers_pqt": 3, "customers_RJ_pqt": 2, "customers_RJ_csv": 2}
    assert spark.table("shop_db.customers_RJ_csv").orderBy("customer_id").first().zip == "01000"


def test_knowledge_run_upserts(spark, tmp_path):
    df = spark.createDataFrame([("b", "b.txt", "data warehouse " * 20)], "source_id string, source_path string, text string")
    paths = (str(tmp_path / "chunks"), str(tmp_path / "vectors"))
    assert flows.run_knowledge(df, *paths) == {"chunks": 1, "indexed": 1}
    more = df.unionByName(df.withColumn("source_id", F.lit("c")))
    assert flows.run_knowledge(more, *paths) == {"chunks": 2, "indexed": 2}
    assert flows.run_knowledge(df, paths[0])["indexed"] == 0


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    columns = "id string, x int"
    rows = [(f"k{i}", i) for i in range(500)]
    made = buckets.upsert_table(spark.createDataFrame([*rows, (None, 1), (" ", 2)], columns), path, "id", 16)
    assert made == {"rows": 500, "buckets": 16, "rewritten": 500}

    def folders():
        return {name: sorted(os.listdir(tmp_path / "t" / "buckets=16" / name)) for name in os.listdir(tmp_path / "t" / "buckets=16")}

    before = folders()
    batch = spark.createDataFrame([("k7", -7), ("new", 1)], columns)
    sent = buckets.upsert_table(batch, path, "id", 99)
    after = folders()
    changed = {name for name in after if after[name] != before.get(name)}
    assert sent["rows"] == 2 and len(changed) == sent["buckets"] <= 2 and set(after) == set(before)
    assert 2 <= sent["rewritten"] < 150
    expected = {**dict(rows), "k7": -7, "new": 1}
    assert {tuple(r) for r in buckets.read_table(spark, path).collect()} == set(expected.items())
    # Sent again, as after a run that was cut short, it gives the same table.
    assert buckets.upsert_table(batch, path, "id") == sent
    assert buckets.upsert_table(batch.limit(0), path, "id") == {"rows": 0, "buckets": 0, "rewritten": 0}
    before = folders()
    with pytest.raises(ValueError, match="repeats key new"):
        buckets.upsert_table(spark.createDataFrame([("new", 5), ("new", 6)], columns), path, "id")
    assert folders() == before
    buckets.rebucket(spark, path, "id", 5)
    assert buckets.bucket_count(spark, path) == 5 and os.listdir(tmp_path / "t") == ["buckets=5"]
    assert {tuple(r) for r in buckets.read_table(spark, path).collect()} == set(expected.items())


def test_bucket_table_edges(spark, tmp_path):
    path = str(tmp_path / "none")
    assert buckets.bucket_count(spark, path) is None
    empty = spark.createDataFrame([], "id long, x array<double>")
    assert buckets.upsert_table(empty, path, "id") == {"rows": 0, "buckets": 0, "rewritten": 0}
    assert buckets.read_table(spark, path).columns == ["id", "x"] and buckets.read_table(spark, path).count() == 0
    buckets.upsert_table(spark.createDataFrame([(1, [1.0]), (-5, None)], empty.schema), path, "id")
    assert sorted(r.id for r in buckets.read_table(spark, path).collect()) == [-5, 1]
    with pytest.raises(ValueError, match="of its own"):
        buckets.upsert_table(empty.withColumn("bucket", F.lit(1)), path, "id")
    (tmp_path / "other").mkdir()
    with pytest.raises(ValueError, match="no table"):
        buckets.read_table(spark, str(tmp_path / "other"))


def test_shared_folder(spark):
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and first.startswith(shared_root(spark).rstrip("/"))
