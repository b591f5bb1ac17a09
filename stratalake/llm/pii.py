r"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score.

A text is cut at the matches of a pattern: the pieces between matches and the matches themselves, in order, give
every start and end in code points. Patterns use possessive loops and start at the start of a run, so a text of any
length is read in linear time and without deep recursion.

Kinds: ``email``, ``ip`` (four parts of at most 255), ``card`` (14 to 19 digits that pass Luhn) and ``phone`` (a
plus sign and 10 to 15 digits) are base kinds and stay whatever surrounds them. ``iban`` (an account number that
leaves 1 modulo 97) and ``ssn`` (three groups of digits without impossible ones, not part of a longer number) stay
if their score reaches ``cut``. A span's score is that of its kind, raised by a word of the kind within ``REACH``
code points before or after it and no farther than the next span of its kind.

Everything is a built-in function on one row. Null and empty texts have no spans; repeated rows repeat results; an
input column with the name of the output is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 40
CUT = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Texts with a match fit this cheap test.
    hint: str
    score: float
    lift: float
    words: str
    base: bool


_LOCAL = "A-Za-z0-9._%+-"

KINDS = (
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]",
         0.8, 0.2, "mail|contact|kontakt|correo|courriel", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, 0.3, "ip|address|host|server|adresse", True),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9][\x20-]?[0-9]", 0.8, 0.2, "card|visa|credit|karte|tarjeta|carte", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, 0.3, "phone|tel|call|mobil|fon|fax", True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}){2,7}(?:\x20?+[0-9]{1,3})?", r"[A-Z]{2}[0-9]{2}",
         0.7, 0.3, "iban|bank|konto|account|cuenta|compte", False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]-[0-9]", 0.2, 0.5, "ssn|social|security|insurance", False),
)

_SPANS = "array<struct<start:int,rank:int,stop:int,kind:string,score:double>>"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    value = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(value, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def mod97(code: Column) -> Column:
    """The remainder of an account code modulo 97: its first four characters last, letters as 10 to 35."""
    turned = F.split(F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4)), "")
    number = F.transform(turned, lambda c: F.conv(c, 36, 10).cast("int"))
    return F.aggregate(number, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _valid(kind: str, hit: Column, before: Column, after: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]+", "")
    if kind == "ip":
        # leading zeros do not make a part large
        parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) < 4) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(hit, " ", "")) == 1
    if kind == "ssn":
        area = F.substring(hit, 1, 3)
        alone = ~F.right(before, F.lit(1)).rlike("[0-9-]") & ~F.left(after, F.lit(1)).rlike("[0-9-]")
        return alone & ~area.isin("000", "666") & (area < "900") & ~hit.like("%-00-%") & ~hit.like("%-0000")
    return F.lit(True)


def running(sizes: Column, block: int = 64) -> Column:
    """For every number of an array the sum of those before it, by blocks, so that long arrays stay cheap."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, v: a + v)

    def in_block(part: Column) -> Column:
        return F.transform(part, lambda _, i: total(F.slice(part, 1, i)))

    starts = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int"))
    blocks = F.transform(starts, lambda b: F.slice(sizes, b * block + 1, block))
    sums = F.transform(blocks, total)

    def shifted(parts: Column, offsets: Column) -> Column:
        return F.flatten(
            F.transform(parts, lambda part, b: F.transform(in_block(part), lambda x: x + F.get(offsets, b)))
        )

    made = F.transform(F.array(F.struct(blocks.alias("blocks"), sums.alias("sums"))), lambda x: shifted(x["blocks"], in_block(x["sums"])))
    return F.when(F.size(sizes) > 0, made[0]).otherwise(F.expr("cast(array() as array<int>)"))


def _found(kind: Kind, rank: int, text: Column) -> Column:
    """All valid matches of a kind with their scores."""

    def spans(row: Column) -> Column:
        gaps, hits = row["gaps"], row["hits"]
        steps = F.transform(hits, lambda hit, i: F.length(F.get(gaps, i)) + F.length(hit))

        def span(hit: Column, i: Column, at: Column) -> Column:
            before, after = F.get(gaps, i), F.get(gaps, i + 1)
            start = at + F.length(before)
            around = F.lower(F.concat(F.right(before, F.lit(REACH)), F.lit("\n"), F.left(after, F.lit(REACH))))
            score = kind.score + F.when(around.rlike(f"(?<![a-z])(?:{kind.words})"), kind.lift).otherwise(0.0)
            return F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(hit)).alias("stop"),
                F.lit(kind.name).alias("kind"), F.round(score, 3).alias("score"),
                _valid(kind.name, hit, before, after).alias("valid"),
            )

        # one-element arrays bind a value that is used often
        placed = F.transform(F.array(running(steps)), lambda at: F.transform(hits, lambda hit, i: span(hit, i, F.get(at, i))))
        return placed[0]

    gaps = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    made = F.transform(F.array(F.struct(gaps.alias("gaps"), hits.alias("hits"))), spans)[0]
    valid = F.transform(
        F.filter(made, lambda s: s["valid"]),
        lambda s: F.struct(s["start"], s["rank"], s["stop"], s["kind"], s["score"]),
    )
    return F.when(text.rlike(kind.hint), valid).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def find(docs: DataFrame, text: str = "text", name: str = "spans", cut: float = CUT) -> DataFrame:
    """``docs`` with all spans by start, then kind: array of (start, rank, stop, kind, score)."""
    base = tuple(k.name for k in KINDS if k.base)
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = {f"_{k.name}": _found(k, i, whole) for i, k in enumerate(KINDS)}
    every = F.sort_array(F.concat(*parts))
    stays = F.filter(every, lambda s: s["kind"].isin(*base) | (s["score"] >= cut))
    return docs.drop(name).withColumns(parts).withColumn(name, stays).drop(*parts)


def counted(spans: Column, kind: str) -> Column:
    """The number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _oracle_kind(k: Kind, rank: int, pattern: str, valid: str) -> str:
    """The matches of one kind for DuckDB: pieces and matches numbered, then summed up."""
    return f"""
{k.name}_h AS (SELECT rid, unnest(range(1, len(hits) + 1)) AS i, hits, gaps FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS hits,
    string_split_regex(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}'))),
{k.name}_p AS (SELECT rid, hits[i] AS hit, gaps[i] AS before, gaps[i + 1] AS after,
    CAST(sum(length(gaps[i])) OVER (PARTITION BY rid ORDER BY i) + coalesce(sum(length(hits[i])) OVER (PARTITION BY rid ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM {k.name}_h),
{k.name}_s AS (SELECT rid, start, {rank} AS rank, start + length(hit) AS stop, '{k.name}' AS kind FROM {k.name}_p
    WHERE {valid} AND ({"true" if k.base else f"{k.score} + CASE WHEN regexp_matches(' ' || lower(concat(right(before, {REACH}), chr(10), left(after, {REACH}))), '[^a-z]({k.words})') THEN {k.lift} ELSE 0 END >= {CUT}"}))"""


def oracle() -> str:
    """The query over ``documents`` for DuckDB, with plain patterns."""
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    doubled = f"list_transform(string_split(reverse({digits}), ''), lambda c, i: CAST(c AS INT) * (1 + (i - 1) % 2))"
    plain = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "list_max(list_transform(string_split(hit, '.'), lambda p: CAST(p AS HUGEINT))) <= 255",
        ),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            f"length({digits}) BETWEEN 14 AND 19 AND list_sum(list_transform({doubled}, lambda v: CASE WHEN v > 9 THEN v - 9 ELSE v END)) % 10 = 0",
        ),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 10 AND 15"),
        "iban": (
            r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[0-9]{1,3})?",
            "list_reduce(list_prepend(0, list_transform(string_split(substr(replace(hit, ' ', ''), 5) || left(hit, 4), ''), lambda c: "
            "CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE CAST(c AS INT) END)), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1",
        ),
        "ssn": (
            r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
            "NOT regexp_matches(right(before, 1) || left(after, 1), '[0-9-]') AND left(hit, 3) NOT IN ('000', '666') AND left(hit, 3) < '900' "
            "AND hit NOT LIKE '%-00-%' AND hit NOT LIKE '%-0000'",
        ),
    }
    kinds = ",".join(_oracle_kind(k, i, *plain[k.name]) for i, k in enumerate(KINDS))
    every = " UNION ALL ".join(f"SELECT * FROM {k.name}_s" for k in KINDS)
    base = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)
    names = ", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS if k.base)
    line = "kind || ':' || start || ':' || stop"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),{kinds},
s AS ({every}),
g AS (SELECT rid, {counts}, string_agg({line}, ',' ORDER BY start, rank) AS spans,
        string_agg({line}, ',' ORDER BY start, rank) FILTER (WHERE kind IN ({base})) AS based FROM s GROUP BY rid)
SELECT doc_id, {names}, sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)
"""
