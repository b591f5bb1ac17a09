"""Page-aware chunking as row-local expressions: a text becomes its chunks without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import INNER_WS_CLASS, LINE_ENDS, let, strip

PAGE_BREAK = "\f"
#: Longest chunk, characters shared by neighbouring windows, shortest chunk.
MAX_CHARS, OVERLAP, MIN_CHARS = 1200, 180, 80
TITLE_CHARS = 120
PARAGRAPHS_PER_BLOCK = 256


def normalize_body(text: Column) -> Column:
    """Unix line ends, no trailing blanks on any line, no blank ends.

    A run of blanks is looked at once, from its first one, however long it is; the
    carriage return of a Windows line end is one of them.
    """
    blank = f"[{INNER_WS_CLASS}]"
    trailing = f"{blank}(?<!{blank}{blank}){blank}*+(?=\\n)"
    return strip(F.regexp_replace(text, trailing, ""))


def numbered_pages(text: Column) -> Column:
    """Array of struct(page, body) for the pages that are not blank.

    Pages keep their position in the text; a text of blank pages is one blank page.
    """
    pages = F.transform(
        F.split(text, PAGE_BREAK),
        lambda raw, i: F.struct((i + 1).alias("page"), normalize_body(raw).alias("body")),
    )
    kept = F.filter(pages, lambda p: p["body"] != "")
    blank = F.array(F.struct(F.lit(1).alias("page"), normalize_body(text).alias("body")))
    return let(kept, lambda found: F.when(F.size(found) > 0, found).otherwise(blank))


def split_pages(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per page: the row's other columns, page and body."""
    others = [name for name in df.columns if name != text]
    return df.select(*others, F.inline(numbered_pages(F.col(text))))


def page_title(body: Column) -> Column:
    """The first line that is not blank, cut."""
    first = F.regexp_extract(strip(body), f"^[^{LINE_ENDS}]*", 0)
    return F.left(strip(first), F.lit(TITLE_CHARS))


def windows(text: Column, max_chars: int, overlap: int) -> Column:
    """Overlapping cuts of a long text; a short one is its own only cut.

    The pattern looks ahead for a whole window and then moves on by one step, so all
    windows come out of a single walk over the text.
    """
    step = max(max_chars - overlap, 1)
    pattern = f"(?s)(?=(.{{1,{max_chars}}})).{{1,{step}}}"
    return F.when(F.length(text) <= max_chars, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    )


def pack_paragraphs(body: Column, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """Paragraphs joined while they fit; one that never fits is cut into windows.

    Every paragraph either extends the open run or closes it. An oversize paragraph is a
    run of its own, longer than the limit, so nothing can join it. Paragraphs are taken in
    blocks: appending copies a list, so lists stay short and the time linear.
    """
    paragraphs = F.filter(F.transform(F.split(body, "\n\n"), strip), lambda p: p != "")
    none = F.array().cast("array<string>")

    def step(state: Column, para: Column) -> Column:
        opened, done = state["open"], state["done"]
        fits = F.length(opened) + 2 + F.length(para) <= max_chars
        return (
            F.when(opened.isNull(), F.struct(para.alias("open"), done.alias("done")))
            .when(fits, F.struct(F.concat(opened, F.lit("\n\n"), para).alias("open"), done.alias("done")))
            .otherwise(F.struct(para.alias("open"), F.array_append(done, opened).alias("done")))
        )

    def block_step(state: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(state["open"].alias("open"), none.alias("done")), step)
        return let(
            inner,
            lambda s: F.struct(s["open"].alias("open"), F.array_append(state["parts"], s["done"]).alias("parts")),
        )

    def blocks_of(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.size(found) / PARAGRAPHS_PER_BLOCK).cast("int"))
        return F.transform(starts, lambda i: F.slice(found, i * PARAGRAPHS_PER_BLOCK + 1, PARAGRAPHS_PER_BLOCK))

    start = F.struct(
        F.lit(None).cast("string").alias("open"), F.array().cast("array<array<string>>").alias("parts")
    )
    runs = F.aggregate(
        let(paragraphs, blocks_of),
        start,
        block_step,
        lambda s: F.when(s["open"].isNull(), F.array(body)).otherwise(
            F.array_append(F.flatten(s["parts"]), s["open"])
        ),
    )
    return F.flatten(F.transform(runs, lambda run: windows(run, max_chars, overlap)))


def chunk_texts(
    df: DataFrame,
    text: str = "text",
    source_id: str = "source_id",
    source_path: str = "source_path",
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """Chunks id, source_id, source_path, title, page, text and their serial within the source.

    A source is one row, so its chunks are numbered by their place in the row's array and
    no two sources ever meet.
    """

    def of_page(page: Column) -> Column:
        pieces = F.filter(
            pack_paragraphs(page["body"], max_chars, overlap), lambda t: F.length(t) >= min_chars
        )
        return let(
            page_title(page["body"]),
            lambda title: F.transform(
                pieces,
                lambda piece: F.struct(
                    title.alias("title"), page["page"].alias("page"), piece.alias("text")
                ),
            ),
        )

    long_pages = F.filter(numbered_pages(F.col(text)), lambda p: F.length(p["body"]) >= min_chars)
    chunks = F.flatten(F.transform(long_pages, of_page))
    exploded = df.select(
        F.col(source_id).cast("string").alias("source_id"),
        F.col(source_path).cast("string").alias("source_path"),
        F.posexplode(chunks).alias("_pos", "_chunk"),
    )
    serial = F.col("_pos") + 1
    return exploded.select(
        F.concat(
            F.col("source_id"), F.lit("-p"), F.col("_chunk.page"), F.lit("-"), serial
        ).alias("id"),
        "source_id",
        "source_path",
        F.col("_chunk.title").alias("title"),
        F.col("_chunk.page").alias("page"),
        F.col("_chunk.text").alias("text"),
        serial.alias("serial"),
    )


def chunk_defaults(df: DataFrame) -> DataFrame:
    """The chunk columns of any table: missing text is empty, a missing page is 0."""

    def text_of(name: str) -> Column:
        col = F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
        return F.coalesce(col, F.lit("")).alias(name)

    page = F.col("page").cast("int") if "page" in df.columns else F.lit(None).cast("int")
    names = ("id", "source_id", "source_path", "title", "text")
    others = [F.col(c) for c in df.columns if c not in (*names, "page")]
    return df.select(*[text_of(n) for n in names], F.coalesce(page, F.lit(0)).alias("page"), *others)
