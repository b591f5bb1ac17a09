r"""Quality rules with cross-document line frequency.

Lines are normalised (lower case, every run of digits as 0, white space as one blank, trimmed) and hashed to 64
bits. For every host the documents with a line are counted; a line in more than ``min_docs`` documents and more than
``share`` of the host's documents is furniture and is taken out of the text. A document is depleted, and rejected, if
furniture makes up more than ``depleted`` of its normalised characters.

Everything runs in built-in functions. A row's own numbers are made in place; only line hashes are shuffled, and
counted before they are. A host's common lines are one array, as long as 1 / ``share`` documents at most, that meets
its documents in a join of hosts; each line is then looked up in its place, so no text is numbered or grouped.

Every row is one document, repeated rows and ids included. A null text has no words and fails the base rules; a
null host is a host of its own. Windows of words are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import scratch

MIN_DOCS = 20
SHARE = 0.01
DEPLETED = 0.5

#: Base rules: fewer words, or a larger percentage of words in repeated windows, fail.
LEAST_WORDS = 50
MOST_REPEATED = 50

SPACE = r"[\x20\x09-\x0D]"


def base_numbers(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.withColumns(
        {
            "_words": F.filter(F.split(whole, f"{SPACE}+", -1), lambda x: x != ""),
            "_lines": lines,
            "n_symbols": F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long"),
        }
    )
    window = F.transform(
        F.expr("CASE WHEN size(_words) > 2 THEN sequence(1, size(_words) - 2) ELSE array() END"),
        lambda i: F.struct(
            F.xxhash64(F.get("_words", i - 1), F.get("_words", i), F.get("_words", i + 1)).alias("h"), i.alias("i")
        ),
    )
    step = step.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.sort_array(window),
        }
    ).drop("_words", "_lines")
    again = F.filter(
        "_windows",
        lambda x, k: (x["h"] == F.get("_windows", k - 1)["h"]) | (x["h"] == F.get("_windows", k + 1)["h"]),
    )
    step = step.withColumn("_again", F.transform(again, lambda x: x["i"])).drop("_windows")
    covered = F.array_union(
        F.array_union("_again", F.transform("_again", lambda i: i + 1)), F.transform("_again", lambda i: i + 2)
    )
    return step.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("_again")


def normalised_lines(text: Column) -> Column:
    """The normalised lines of a text, without empty ones."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[0-9]+", "0")
    flat = F.regexp_replace(flat, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.filter(F.transform(F.split(flat, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def _looked_up(text: Column) -> Column:
    """Hash and length of the normalised line at each place of a text; empty lines have length 0."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[0-9]+", "0")
    flat = F.regexp_replace(flat, r"[\x20\x09\x0B-\x0D]+", " ")
    line = F.transform(F.split(flat, "\n", -1), lambda x: F.trim(x))
    return F.transform(line, lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n")))


def common_lines(
    docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE
) -> DataFrame:
    """``_host``, ``_common``: the hashes of the furniture lines of every host that has some, stored."""
    spark = docs.sparkSession
    path = scratch(spark, "lines")
    own = F.transform(normalised_lines(F.col(text)), lambda x: F.xxhash64(x))
    once = docs.select(F.col(host).alias("_host"), F.explode(F.array_distinct(own)).alias("h"))
    hosts = docs.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("docs"))
    counts = once.groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min_docs)
    same = counts["_host"].eqNullSafe(hosts["_host"])
    common = counts.join(hosts, same).where(F.col("n_docs") > share * F.col("docs")).select(counts["_host"], "h")
    common.groupBy("_host").agg(F.collect_set("h").alias("_common")).write.parquet(path)
    return spark.read.parquet(path)


def take_out(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    min_docs: int = MIN_DOCS,
    share: float = SHARE,
    depleted: float = DEPLETED,
) -> DataFrame:
    """``docs`` with furniture lines taken out of the text, and with the columns of :func:`judge`; no row is rejected.

    The numbers are those of the text as it came. A text without furniture stays as it is, null included.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    made += ("n_lines", "n_common", "common_share", "depleted", "kept")
    base = docs.drop(*[c for c in made if c not in (text, host)])
    columns = base.columns
    common = common_lines(base, text, host, min_docs, share)
    met = base.join(common, base[host].eqNullSafe(common["_host"]), "left").drop(common["_host"])
    step = base_numbers(met, text).withColumn("_looked", _looked_up(F.col(text)))
    full = F.filter("_looked", lambda x: x["n"] > 0)
    known = F.coalesce(F.array_intersect(F.transform(full, lambda x: x["h"]), "_common"), F.array().cast("array<bigint>"))
    step = step.withColumn("_known", known).drop("_common")
    furniture = lambda x: (x["n"] > 0) & F.array_contains("_known", x["h"])
    step = step.withColumns(
        {
            "n_lines": F.size(full).cast("long"),
            "_gone": F.filter("_looked", furniture),
            "_left": F.filter(
                F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda _, i: ~furniture(F.get("_looked", i))
            ),
        }
    )
    add = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    total = add("_looked")
    gone = F.when(total > 0, add("_gone") / total).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    step = step.withColumns({"_share": gone, "base_failed": failed, "n_common": F.size("_gone").cast("long")})
    left = F.when(F.col("n_common") > 0, F.array_join("_left", "\n")).otherwise(F.col(text))
    return step.withColumns(
        {
            "common_share": F.round("_share", 6),
            "depleted": F.col("_share") > depleted,
            "kept": ~F.col("base_failed") & (F.col("_share") <= depleted),
            text: left,
        }
    ).select(*columns, *made)


def clean(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The documents that are kept, without furniture lines in their text; no other column is added."""
    made = take_out(docs.withColumn("_as_came", F.struct(*docs.columns)), text, host, **limits).where("kept")
    return made.select(*[F.col(c) if c == text else F.col("_as_came")[c].alias(c) for c in docs.columns])


def judge(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """``docs`` without the text, with the base numbers, ``base_failed``, line counts, ``depleted`` and ``kept``.

    ``n_lines`` counts lines with characters, ``n_common`` those that :func:`take_out` removes; ``common_share`` is
    their share of the normalised characters.
    """
    return take_out(docs, text, host, **limits).drop(text)


#: The same rules for the test tables, with lines as texts instead of hashes.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS i, ws FROM w),
g2 AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k FROM g),
g3 AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM g2),
r AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM g3, range(3) s(j) WHERE n > 1 GROUP BY rid),
l AS (SELECT rid, source, unnest(string_split(regexp_replace(regexp_replace(lower(t), '[0-9]+', '0', 'g'),
        '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS x FROM d),
l2 AS (SELECT rid, source, trim(x, ' ') AS x FROM l WHERE trim(x, ' ') <> ''),
h AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
c AS (SELECT l2.source, x FROM l2 JOIN h ON l2.source IS NOT DISTINCT FROM h.source GROUP BY l2.source, x, docs
        HAVING count(DISTINCT rid) > {MIN_DOCS} AND count(DISTINCT rid) > {SHARE} * docs),
s AS (SELECT rid, count(*) AS n_lines, sum(length(l2.x)) AS total, count(c.x) AS n_common,
        coalesce(sum(length(l2.x)) FILTER (WHERE c.x IS NOT NULL), 0) AS lost
      FROM l2 LEFT JOIN c ON l2.source IS NOT DISTINCT FROM c.source AND l2.x = c.x GROUP BY rid),
f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
        coalesce(s.n_lines, 0) AS n_lines, coalesce(s.n_common, 0) AS n_common, coalesce(lost / total, 0.0) AS gone
      FROM w LEFT JOIN r USING (rid) LEFT JOIN s USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  n_lines, n_common, round(gone, 6) AS common_share, gone > {DEPLETED} AS depleted,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND gone <= {DEPLETED} AS kept
FROM f
"""
