"""Cited records from ranked hits: answers, examples, quotes, notes, and their evaluation.

Hits are at most ``k`` rows per query, so collecting one query's hits is bounded.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import fill_template, snippet

#: The answer to an uncovered question and the lines that open a card.
UNCOVERED = "O livro não cobre este assunto nos trechos indexados."
ANSWER_HEAD = "Pergunta: "
ANSWER_LEAD = "Segundo o livro:"
EXAMPLE_HEAD = ("Contexto: ", " no dia a dia de engenharia de dados.")
EXAMPLE_LEAD = "Situação: um time aplica o conceito do livro neste cenário:"
#: Longest excerpt in a claim, an example and an answer.
CLAIM_CHARS, EXAMPLE_CHARS, ANSWER_CHARS = 220, 280, 360
NOTE_TEMPLATE = {
    "claim": "{{claim}}",
    "evidence": "{{evidence}}",
    "pages": "{{pages}}",
    "topic": "{{topic}}",
}

_HIT = ("rank", "id", "page", "title", "text")


def with_hits(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Every query with its ordered hits array (empty without hits) and the covered flag."""
    gathered = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct(*_HIT))).alias("hits")
    )
    joined = queries.join(gathered, "query_id", "left")
    return joined.withColumn("covered", F.col("hits").isNotNull()).withColumn(
        "hits", F.coalesce("hits", F.array().cast(gathered.schema["hits"].dataType))
    )


def citations(hits: Column) -> Column:
    return F.transform(
        hits,
        lambda h: F.struct(h["id"].alias("chunk_id"), h["page"].alias("page"), h["title"].alias("title")),
    )


def passages(hits: Column) -> Column:
    return F.transform(
        hits,
        lambda h: F.struct(
            h["id"].alias("chunk_id"),
            h["page"].alias("page"),
            h["title"].alias("title"),
            h["text"].alias("text"),
        ),
    )


def hits_as_text(hits: Column) -> Column:
    """All hits under headings, as the context of a prompt."""
    blocks = F.transform(
        hits,
        lambda h: F.concat(
            F.lit("### p."), h["page"], F.lit(" "), h["title"], F.lit(" ("), h["id"], F.lit(")\n"), h["text"]
        ),
    )
    return F.array_join(blocks, "\n\n")


def _lines(head: Column, lead: str, items: Column) -> Column:
    return F.array_join(F.concat(F.array(head, F.lit(""), F.lit(lead)), items), "\n")


def answer_text(query: Column, hits: Column) -> Column:
    items = F.transform(
        hits,
        lambda h: F.concat(
            F.lit("- p."), h["page"], F.lit(" ["), h["id"], F.lit("]: "), snippet(h["text"], ANSWER_CHARS)
        ),
    )
    return _lines(F.concat(F.lit(ANSWER_HEAD), query), ANSWER_LEAD, items)


def example_text(topic: Column, hits: Column) -> Column:
    items = F.transform(
        hits,
        lambda h: F.concat(F.lit("- p."), h["page"], F.lit(": "), snippet(h["text"], EXAMPLE_CHARS)),
    )
    head = F.concat(F.lit(EXAMPLE_HEAD[0]), topic, F.lit(EXAMPLE_HEAD[1]))
    return _lines(head, EXAMPLE_LEAD, items)


def _or_uncovered(text: Column) -> Column:
    return F.when(F.col("covered"), text).otherwise(F.lit(UNCOVERED))


def answer_cards(found: DataFrame) -> DataFrame:
    """question, answer, citations, covered, offer_example for rows of ``with_hits``."""
    return found.select(
        "query_id",
        F.col("query").alias("question"),
        _or_uncovered(answer_text(F.col("query"), F.col("hits"))).alias("answer"),
        citations(F.col("hits")).alias("citations"),
        "covered",
        F.col("covered").alias("offer_example"),
    )


def example_cards(found: DataFrame) -> DataFrame:
    return found.select(
        "query_id",
        F.col("query").alias("topic"),
        _or_uncovered(example_text(F.col("query"), F.col("hits"))).alias("scenario"),
        citations(F.col("hits")).alias("citations"),
        "covered",
    )


def quote_cards(found: DataFrame) -> DataFrame:
    return found.select(
        "query_id",
        "query",
        passages(F.col("hits")).alias("passages"),
        citations(F.col("hits")).alias("citations"),
        "covered",
    )


def note_records(found: DataFrame, synthesis: str | None = None) -> DataFrame:
    """topic, claim, evidence, pages, chunk_ids for the covered queries.

    ``synthesis`` names a struct(claim, evidence) column that replaces the excerpt.
    """
    hits = F.col("hits")
    quoted = F.array_join(
        F.transform(hits, lambda h: F.concat(F.lit("[p."), h["page"], F.lit("] "), h["text"])), "\n\n"
    )
    claim = F.concat(
        F.col("query"), F.lit(": "), snippet(F.element_at(hits, 1)["text"], CLAIM_CHARS)
    )
    evidence = quoted
    if synthesis:
        made = F.coalesce(F.col(f"{synthesis}.claim"), F.lit("")) != ""
        own = F.nullif(F.btrim(F.col(f"{synthesis}.evidence")), F.lit(""))
        claim = F.when(made, F.btrim(F.col(f"{synthesis}.claim"))).otherwise(claim)
        evidence = F.when(made, F.coalesce(own, quoted)).otherwise(quoted)
    pages = F.array_sort(
        F.array_distinct(F.filter(F.transform(hits, lambda h: h["page"]), lambda p: p != 0))
    )
    return found.where("covered").select(
        "query_id",
        F.col("query").alias("topic"),
        claim.alias("claim"),
        evidence.alias("evidence"),
        pages.alias("pages"),
        F.transform(hits, lambda h: h["id"]).alias("chunk_ids"),
    )


def render_notes(notes: DataFrame, template: Mapping[str, str] = NOTE_TEMPLATE) -> DataFrame:
    """Adds ``template``: a struct with each template line filled in."""
    listed = F.array_join(F.transform("pages", lambda p: p.cast("string")), ", ")
    values = {
        "claim": F.col("claim"),
        "evidence": F.col("evidence"),
        "pages": F.coalesce(F.nullif(listed, F.lit("")), F.lit("n/a")),
        "topic": F.col("topic"),
    }
    lines = [fill_template(text, values).alias(name) for name, text in template.items()]
    return notes.withColumn("template", F.struct(*lines))


def _ints(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", "), F.lit("]"))


def _words(values: Column) -> Column:
    joined = F.array_join(values, "', '")
    return F.when(F.size(values) == 0, F.lit("[]")).otherwise(F.concat(F.lit("['"), joined, F.lit("']")))


def body_of(task: Column, found_query: Column, hits: Column, covered: Column) -> Column:
    """The text an evaluation looks at: answer, scenario, claim and evidence, or passages."""
    claim = F.concat(found_query, F.lit(": "), snippet(F.element_at(hits, 1)["text"], CLAIM_CHARS))
    quoted = F.array_join(
        F.transform(hits, lambda h: F.concat(F.lit("[p."), h["page"], F.lit("] "), h["text"])), "\n\n"
    )
    texts = F.array_join(F.transform(hits, lambda h: h["text"]), " ")
    return (
        F.when(task == "note", F.when(covered, F.concat(claim, F.lit(" "), quoted)).otherwise(F.lit(" ")))
        .when(task == "quote", texts)
        .when(~covered, F.lit(UNCOVERED))
        .when(task == "example", example_text(found_query, hits))
        .otherwise(answer_text(found_query, hits))
    )


def evaluate_cases(found: DataFrame) -> DataFrame:
    """query_id, ok and the errors of each golden case.

    Cases carry task, expect_covered, pages, terms and cite_pages next to their hits.
    """
    hits, covered = F.col("hits"), F.col("covered")
    wanted = F.coalesce("expect_covered", F.lit(False))
    task = F.coalesce("task", F.lit("ask"))
    text = F.lower(body_of(task, F.col("query"), hits, covered))
    expected = F.array_distinct(F.coalesce("pages", F.array().cast("array<int>")))
    # Notes answer with pages only, so their citations are empty.
    cited = F.when(task == "note", F.array().cast("array<int>")).otherwise(
        F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["page"])))
    )
    missing = F.array_sort(F.array_except(expected, cited))
    terms = F.transform(F.coalesce("terms", F.array().cast("array<string>")), F.lower)

    def flag(value: Column) -> Column:
        return F.when(value, F.lit("True")).otherwise(F.lit("False"))

    # The wording of the findings.
    checks = F.array(
        F.when(
            covered != wanted,
            F.concat(F.lit("covered="), flag(covered), F.lit(" expected "), flag(wanted)),
        ),
        F.when(
            F.size(missing) > 0,
            F.concat(F.lit("missing pages "), _ints(missing), F.lit(" in "), _ints(cited)),
        ),
        F.when(
            wanted & (F.size(terms) > 0) & ~F.exists(terms, lambda t: F.contains(F.col("_body"), t)),
            F.concat(F.lit("missing terms "), _words(terms), F.lit(" in answer")),
        ),
        F.when(
            wanted & F.coalesce("cite_pages", F.lit(False)) & ~F.contains(F.col("_body"), F.lit("p.")),
            F.lit("answer missing page citation (p.N)"),
        ),
        F.when(
            ~wanted & (task == "ask") & covered,
            F.lit("uncovered topic must use the uncovered string"),
        ),
    )
    errors = F.array_compact(checks)
    judged = found.withColumn("_body", text).withColumn("errors", errors)
    return judged.select("query_id", (F.size("errors") == 0).alias("ok"), "errors")


def pass_rate(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if("ok").alias("passed"),
        F.try_divide(F.count_if("ok"), F.count(F.lit(1))).alias("rate"),
    )
