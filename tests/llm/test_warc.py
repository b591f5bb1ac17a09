from pyspark.sql import functions as F

from stratalake.llm import warc

SCHEMA = "record_id long, kind string, url string, captured_at long, headers map<string,string>, digest string"


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.com:80/A/b/?utm_source=x&b=2&a=1#top": "example.com/A/b?a=1&b=2",
        "https://user@example.com/": "example.com", "https://m.example.com/x?ref=1": "m.example.com/x", "example.com/?q": "example.com?q",
        "https://example.com:8080/x//": "example.com:8080/x", "": "",
    }
    table = spark.createDataFrame([(k, v) for k, v in cases.items()], "url string, want string")
    assert table.where(~warc.canonical_url(F.col("url")).eqNullSafe(F.col("want"))).count() == 0
    assert spark.createDataFrame([(None,)], "url string").select(warc.canonical_url(F.col("url")).alias("u")).first()["u"] is None


def plain(records):
    out = {}
    for r in records:
        if r[1] != "revisit":
            continue
        earlier = [x for x in records if x[1] == "response" and x[2] and x[2] == r[2] and x[3] is not None and r[3] is not None and x[3] < r[3]]
        target = max(earlier, key=lambda x: (x[3], x[0]), default=None)
        mine, theirs = r[4] or {}, (target[4] or {}) if target else {}
        if target is None:
            outcome = "missing"
        elif "etag" in mine:
            outcome = "resolved" if mine["etag"].removeprefix("W/") == theirs.get("etag", "").removeprefix("W/") else "changed"
        elif "last-modified" in mine:
            outcome = "resolved" if mine["last-modified"] == theirs.get("last-modified") else "changed"
        elif r[5] and target[5]:
            outcome = "resolved" if r[5] == target[5] else "changed"
        else:
            outcome = "unverified"
        merged = theirs | {k: v for k, v in mine.items() if k in warc.UPDATES}
        out[r[0]] = (target[0] if outcome == "resolved" else None, outcome, merged if outcome == "resolved" else None)
    return out


def test_against_a_plain_search(spark):
    import random

    rng = random.Random(1)
    records = []
    for i in range(1500):
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        heads = {}
        if rng.random() < 0.5:
            heads["etag"] = rng.choice(["", "W/"]) + rng.choice(["a", "b"])
        if rng.random() < 0.5:
            heads["last-modified"] = rng.choice(["x", "y"])
        heads |= {"content-length": str(rng.randrange(9)), "date": str(i)}
        # one URL holds a third of all captures
        url = "hot.com/a" if rng.random() < 0.4 else f"site{rng.randrange(30)}.com/p"
        records.append((i, kind, url, rng.randrange(700), heads if rng.random() < 0.95 else None, rng.choice(["p", "q", None])))
    records += [(5000, "revisit", None, 5, {}, "p"), (5001, "revisit", "hot.com/a", None, {}, "p"), (5002, "response", "hot.com/a", None, {}, "p")]
    table = spark.createDataFrame(records, SCHEMA).selectExpr("*", "'clash' AS part", "'clash' AS near")
    got = {r["record_id"]: (r["target_id"], r["outcome"], r["headers"]) for r in warc.resolve_revisits(table).collect()}
    assert got == plain(records)
    assert {v[1] for v in got.values()} == {"resolved", "changed", "missing", "unverified"}
    assert warc.resolve_revisits(table.limit(0)).count() == 0


def test_repeated_revisits_repeat(spark):
    rows = [(1, "response", "a.com", 1, {"etag": "x"}, None), (2, "revisit", "a.com", 2, {"etag": "x"}, None), (2, "revisit", "a.com", 2, {"etag": "x"}, None)]
    got = warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["target_id"] for r in got] == [1, 1]


def test_times_with_fractions(spark):
    heads = {"etag": "x"}
    rows = [(1, "response", "a.com", 1.2, heads, None), (2, "revisit", "a.com", 1.7, heads, None), (3, "revisit", "a.com", 1.2, heads, None),
            (4, "response", "a.com", 1.65, heads, None), (5, "revisit", "a.com", 1.201, heads, None)]
    table = spark.createDataFrame(rows, SCHEMA.replace("captured_at long", "captured_at double"))
    got = {r["record_id"]: (r["target_id"], r["outcome"]) for r in warc.resolve_revisits(table).collect()}
    assert got == {2: (4, "resolved"), 3: (None, "missing"), 5: (1, "resolved")}
