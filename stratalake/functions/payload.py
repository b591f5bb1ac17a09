"""Read JSON objects out of model responses that carry fences or prose around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.functions.text import let, strip

#: The tools a message may be routed to, and the words that mean yes.
BOOK_TOOLS = ("ask", "note", "example", "quote")
ROUTE_TOOLS = (*BOOK_TOOLS, "feedback")
YES_WORDS = ("true", "1", "yes", "sim")

_FENCE = r"(?is)```(?:json)?\s*(.*?)```"
_OBJECT = r"(?s)\{.*\}"


def _is_json(raw: Column) -> Column:
    """True for one JSON value and nothing after it; brackets around it refuse a second one."""
    items = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))), "$", "array<variant>"
    )
    return F.coalesce(F.size(items) == 1, F.lit(False))


def response_json(text: Column) -> Column:
    """The JSON text of a response: inside a fence, else the whole, else its outermost braces."""
    stripped = strip(F.coalesce(text, F.lit("")))
    raw = F.when(
        stripped.rlike(_FENCE), strip(F.regexp_extract(stripped, _FENCE, 1))
    ).otherwise(stripped)
    return let(
        raw, lambda body: F.when(_is_json(body), body).otherwise(F.regexp_extract(body, _OBJECT, 0))
    )


def object_entries(text: Column) -> Column:
    """Key/value entries in text order with lower-cased keys; null unless the response is an object."""
    wrapped = F.concat(F.lit("["), response_json(text), F.lit("]"))
    return let(
        F.from_json(wrapped, "array<map<string,variant>>"),
        lambda objects: F.when(
            F.size(objects) == 1,
            F.transform(
                F.map_entries(F.element_at(objects, 1)),
                lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
            ),
        ),
    )


def entry(entries: Column, key: str) -> Column:
    """The last value stored under ``key``, as variant."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return let(hits, lambda found: F.when(F.size(found) > 0, F.element_at(found, -1)["value"]))


def _text(value: Column) -> Column:
    return strip(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("")))


def _joined(value: Column) -> Column:
    parts = F.transform(
        F.try_variant_get(value, "$", "array<string>"), lambda s: strip(F.coalesce(s, F.lit("None")))
    )
    return F.when(
        F.schema_of_variant(value).startswith("ARRAY"),
        F.array_join(F.filter(parts, lambda s: s != ""), "\n"),
    ).otherwise(_text(value))


def note_payload(text: Column) -> Column:
    """Struct(claim, evidence); null without an object or without a claim."""

    def build(entries: Column) -> Column:
        claim = _text(entry(entries, "claim"))
        return F.when(
            claim != "",
            F.struct(claim.alias("claim"), _joined(entry(entries, "evidence")).alias("evidence")),
        )

    return let(object_entries(text), build)


def route_payload(text: Column, tools: Sequence[str] = ROUTE_TOOLS) -> Column:
    """Struct(tool, query, feedback_positive); null without an object or with an unknown tool."""

    def build(entries: Column) -> Column:
        tool = F.lower(_text(entry(entries, "tool")))
        mark = entry(entries, "feedback_positive")
        kind = F.coalesce(F.schema_of_variant(mark), F.lit("VOID"))
        said_yes = F.lower(_text(mark)).isin(*YES_WORDS)
        truthy = (
            F.when(kind == "STRING", said_yes)
            .when(kind == "BOOLEAN", F.try_variant_get(mark, "$", "boolean"))
            .when(kind == "VOID", F.lit(False))
            .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(mark, "$", "array<variant>")) > 0)
            .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
            .otherwise(F.try_variant_get(mark, "$", "double") != 0)
        )
        return F.when(
            tool.isin(*tools),
            F.struct(
                tool.alias("tool"),
                _text(entry(entries, "query")).alias("query"),
                F.when(tool == "feedback", F.lit(True)).otherwise(truthy).alias("feedback_positive"),
            ),
        )

    return let(object_entries(text), build)
