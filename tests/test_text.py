import pytest
from pyspark.sql import functions as F

from stratalake.functions import payload
from stratalake.functions import text as tx
from stratalake.functions.embedding import hash_vectors, hashed_vector


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize("raw", ["  a b \t", "\u00a0x\u3000", "\x1cq\x1f", "", " \n "])
def test_strip_matches_python(spark, raw):
    assert one(spark, raw, tx.strip) == raw.strip()


def test_safe_str(spark):
    assert one(spark, " " + "n" * 300, lambda c: tx.safe_str(c, 255)) == "n" * 255
    assert one(spark, "   ", lambda c: tx.safe_str(c, 5)) is None
    assert one(spark, None, lambda c: tx.safe_str(c, 5)) is None


@pytest.mark.parametrize(
    "raw", ["1.5", " 2 ", "-3e2", ".5", "5.", "bad", "", "1.5d", "1_000", "inf", "-Infinity", "0x10", "1e", "--1"]
)
def test_safe_float_matches_python(spark, raw):
    try:
        expected = float(raw)
    except ValueError:
        expected = None
    assert one(spark, raw, tx.safe_float) == expected


def test_strict_float_raises(spark):
    for raw in ("x", None, ""):
        with pytest.raises(Exception, match="not a number"):
            one(spark, raw, lambda c: tx.strict_float(c, "amount"))


def test_first_non_empty(spark):
    df = spark.createDataFrame([("", None, "z")], "a string, b string, c string")
    assert df.select(tx.first_non_empty(F.col("a"), F.col("b"), F.col("c")).alias("o")).first().o == "z"


def test_snippet(spark):
    assert one(spark, " a\nb ", lambda c: tx.snippet(c, 10)) == "a b"
    assert one(spark, "abcd efgh", lambda c: tx.snippet(c, 5)) == "abcd…"


def test_template_and_ids(spark):
    filled = one(spark, "X", lambda c: tx.fill_template("{{a}}-{{b}}-{{a}}", {"a": c, "b": F.lit("q")}))
    assert filled == "X-q-X"
    ids = [one(spark, "v", lambda c: tx.numbered_id("N-", F.lit(n), 4)) for n in (7, 12345)]
    assert ids == ["N-0007", "N-12345"]


def test_storage_uri(spark):
    parts = lambda c, k: tx.storage_uri_parts(c)[k]
    uri = "abfss://curated@acct.dfs.core.windows.net/a/b.csv"
    assert [one(spark, uri, lambda c: parts(c, k)) for k in ("container", "account", "path")] == ["curated", "acct", "a/b.csv"]
    assert one(spark, "s3a://x/y", lambda c: parts(c, "path")) is None


def test_cosine_rules(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0, 3.0]), ([0.0], [0.0])], "a array<double>, b array<double>")
    got = [r.o for r in df.select(tx.cosine(F.col("a"), F.col("b")).alias("o")).collect()]
    assert got[0] == pytest.approx(5 / (5**0.5 * 14**0.5)) and got[1] == 0.0


def test_md5_vector_overlap(spark):
    texts = ["ciclo de vida da engenharia de dados", "o ciclo de vida cobre ingestao", "quantum qubits teleport"]
    q, close, far = hash_vectors(texts)
    assert q @ close > q @ far
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + [None, "a b"])], "i int, t string")
    rows = df.select("i", hashed_vector(F.col("t")).alias("v")).orderBy("i").collect()
    assert [list(r.v) for r in rows[:3]] == [list(v) for v in (q, close, far)]
    assert rows[3].v == [0.0] * 32 and rows[4].v == [0.0] * 32


NOTES = {
    '```json\n{"claim": "tese", "evidence": ["p.1 geracao", " ", "p.2 warehouse"]}\n```': ("tese", "p.1 geracao\np.2 warehouse"),
    '{"Claim": "Tese", "Evidence": "p.1"}': ("Tese", "p.1"),
    'so: {"claim": " a ", "evidence": null} done': ("a", ""),
    '{"claim": "", "evidence": "x"}': None,
    "not json": None,
    '[{"claim": "a"}]': None,
    '{"claim": "a"} and {"claim": "b"}': None,
    '{"claim": "old", "CLAIM": "new"}': ("new", ""),
}


def test_note_payload(spark):
    for raw, expected in NOTES.items():
        got = one(spark, raw, payload.note_payload)
        assert (None if got is None else (got.claim, got.evidence)) == expected, raw


ROUTES = {
    '{"tool": " ASK ", "query": " q ", "feedback_positive": "Sim"}': ("ask", "q", True),
    '{"tool": "quote", "feedback_positive": "no"}': ("quote", "", False),
    '{"tool": "note", "feedback_positive": true}': ("note", "", True),
    '{"tool": "note", "feedback_positive": 0}': ("note", "", False),
    '{"tool": "feedback", "feedback_positive": false}': ("feedback", "", True),
    '{"tool": "paint"}': None,
    "nothing": None,
}


def test_route_payload(spark):
    for raw, expected in ROUTES.items():
        got = one(spark, raw, payload.route_payload)
        assert (None if got is None else tuple(got)) == expected, raw
