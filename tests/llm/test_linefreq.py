import re

from pyspark.sql import types as T

from stratalake.llm import linefreq

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + j for places in seen.values() if len(places) > 1 for i in places for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_numbers(spark):
    texts = ["", None, "a", "a b", "a b c", "a b c a b c", "x x x x x", "a  b\tc\n\na b c\n \né#| z a b", "#" * 10, "l\nl\n l\nl",
             "\n".join(f"w{i % 7} w{i % 5}" for i in range(500)), "p q " * 30000]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = linefreq.base_numbers(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in got] == [base(t) for t in texts]


def test_common_lines_deplete(spark):
    # digits do not tell lines apart, letters do
    own = " ".join(chr(97 + i % 26) * (1 + i // 26) for i in range(80))
    common = "Call 555 now   for the best offer of the whole year in town"
    rows = [(i, f"{common.replace('555', str(i))}\n{own} {chr(97 + i % 26) * (5 + i // 26)}", "hot") for i in range(40)]
    rows += [(100 + i, "\n".join([common] * 9) + " " + own[:30], "hot") for i in range(3)]
    rows += [(200, f"{common}\n" * 12, "cold"), (201, common, None), (202, None, None), (203, own, "hot"), (203, own, "hot")]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS kept", "'clash' AS h", "'other' AS n")
    got = linefreq.judge(table, min_docs=20, share=0.1).collect()
    assert len(got) == len(rows) and "text" not in got[0]
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["kept"] and by[i]["n_common"] == 1 and 0 < by[i]["common_share"] < 0.5 for i in range(40))
    assert all(by[100 + i]["depleted"] and not by[100 + i]["kept"] and by[100 + i]["n_common"] == 8 for i in range(3))
    # another host does not know the line; repeated words fail it by the base rules
    assert by[200]["n_common"] == 0 and by[200]["base_failed"] and not by[200]["kept"]
    assert by[201]["n_common"] == 0 and by[202]["n_words"] == 0 and by[202]["base_failed"] and by[203]["kept"]
    assert linefreq.judge(table.limit(0)).count() == 0


def test_common_lines_are_taken_out(spark):
    own = " ".join(chr(97 + i % 26) * (1 + i // 26) for i in range(80))
    common = "Call %d now   for the best offer of the whole year in town"
    rows = [(i, f"{common % i}\n\n {own} {chr(97 + i % 26) * (5 + i // 26)}\n  {common % 7} ", "hot") for i in range(40)]
    rows += [(100 + i, "\n".join([common % i] * 9) + "\n" + own[:30], "hot") for i in range(3)]
    rows += [(200, f"{common % 1}\n{own}", "cold"), (201, f"{common % 1}\n{own}", None), (202, None, None), (203, f"{own}\n\n", "hot")]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS kept", "'clash' AS _host", "'other' AS n_lines")
    every = {r["doc_id"]: r for r in linefreq.take_out(table, min_docs=20, share=0.1).collect()}
    assert len(every) == len(rows) and every[0]["n_common"] == 2 and every[0]["n_lines"] == 3
    assert every[100]["depleted"] and every[100]["text"] == own[:30] and every[202]["text"] is None
    got = linefreq.clean(table, min_docs=20, share=0.1)
    assert got.columns == ["doc_id", "text", "source", "kept", "_host", "n_lines"]
    by = {r["doc_id"]: r for r in got.collect()}
    # depleted documents and those that fail the base rules are rejected; other hosts keep the line
    assert set(by) == {*range(40), 200, 201, 203}
    assert all(by[i]["text"] == "\n" + rows[i][1].split("\n")[2] and by[i]["kept"] == "clash" for i in range(40))
    assert by[200]["text"] == rows[43][1] and by[201]["text"] == rows[44][1] and by[203]["text"] == f"{own}\n\n"
    assert linefreq.clean(table.limit(0)).count() == 0


def test_query_matches_sql(spark, sf_dir):
    import duckdb

    from stratalake.llm.queries import QUERIES

    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        found = con.execute(linefreq.ORACLE)
        names, want = [c[0] for c in found.description], found.fetchall()
    got = QUERIES["op1_line_frequency"](spark, sf_dir).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_no_python_in_the_plan(spark, sf_dir):
    from stratalake.llm.queries import QUERIES

    for name in ("op1_line_frequency", "op8_personal_data"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
