import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import chunking as ck

FIXTURE = (
    "Capitulo 1\nO ciclo de vida da engenharia de dados cobre geracao, armazenamento,\n"
    "ingestao, transformacao e servico de dados.\n\n\x0cCapitulo 2\n"
    "O data warehouse e um padrao para analise. Bill Inmon descreve o warehouse\n"
    "como a base da disciplina. Engenharia de dados nao e so uma ferramenta.\n\n\x0cCapitulo 3\n"
    "Arquitetura medallion usa camadas bronze, silver e gold. Este fixture nao\n"
    "substitui o livro; so testa o pipeline de chunks.\n"
)


def plain_body(text):
    return "\n".join(part.rstrip() for part in text.replace("\r\n", "\n").split("\n")).strip()


def plain_cuts(text, size, overlap):
    if len(text) <= size:
        return [text]
    return [text[i : i + size] for i in range(0, len(text), max(size - overlap, 1))]


def plain_chunks(text, size, overlap, least):
    """(page, title, text) of every chunk, by the plainest loop."""
    out = []
    for number, raw in enumerate(text.split("\f"), 1):
        body = plain_body(raw)
        if not body or len(body) < least:
            continue
        title = next(line.strip() for line in body.splitlines() if line.strip())[:120]
        runs = []
        for para in (p.strip() for p in body.split("\n\n")):
            if not para:
                continue
            if runs and len(runs[-1]) + 2 + len(para) <= size:
                runs[-1] += "\n\n" + para
            else:
                runs.append(para)
        for run in runs:
            out += [(number, title, cut) for cut in plain_cuts(run, size, overlap) if len(cut) >= least]
    return out


def random_text(rng):
    bits = ["a", "é", "word ", "lorem ipsum dolor ", " ", "\t", "\n", "\n\n", "\n\n\n", " \n \n", "\r\n", "\r\n\r\n", "\f", "😀", "\u00a0", "x" * 90, "\x0b"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 80)))


def test_chunks_against_plain_loop(spark):
    rng = random.Random(11)
    texts = [FIXTURE, "", "\f\f", "y" * 500] + [random_text(rng) for _ in range(150)]
    df = spark.createDataFrame([(f"s{i}", "p", t) for i, t in enumerate(texts)], "source_id string, source_path string, text string")
    for size, overlap, least in ((60, 15, 5), (200, 40, 20), (30, 40, 1)):
        got = {}
        rows = ck.chunk_texts(df, max_chars=size, overlap=overlap, min_chars=least).collect()
        for r in sorted(rows, key=lambda r: r.serial):
            got.setdefault(r.source_id, []).append((r.page, r.title, r.text))
            assert r.id == f"{r.source_id}-p{r.page}-{r.serial}"
        for i, text in enumerate(texts):
            assert got.get(f"s{i}", []) == plain_chunks(text, size, overlap, least), (i, text)


def test_pages(spark):
    df = spark.createDataFrame([(1, "um\n\ndois.\n\x0c \n\x0ctres\n"), (2, " \x0c ")], "k int, text string")
    rows = {(r.k, r.page): r.body for r in ck.split_pages(df).collect()}
    assert rows == {(1, 1): "um\n\ndois.", (1, 3): "tres", (2, 1): ""}


def test_fixture_has_three_pages(spark):
    df = spark.createDataFrame([("book", "book.txt", FIXTURE)], "source_id string, source_path string, text string")
    rows = ck.chunk_texts(df).orderBy("serial").collect()
    assert [(r.id, r.title) for r in rows] == [(f"book-p{i}-{i}", f"Capitulo {i}") for i in (1, 2, 3)]


def test_long_text_is_one_walk(spark):
    text = "ab" * 200_000
    df = spark.createDataFrame([(text,)], "t string")
    cuts = df.select(F.explode(ck.windows(F.col("t"), 1200, 180)).alias("c")).collect()
    assert [r.c for r in cuts] == plain_cuts(text, 1200, 180)


def test_chunking_moves_no_rows(spark):
    df = spark.createDataFrame([("s", "p", "t")], "source_id string, source_path string, text string")
    plan = ck.chunk_texts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("page", [None, 4])
def test_chunk_defaults(spark, page):
    df = spark.createDataFrame([("c", page)], "id string, page int")
    row = ck.chunk_defaults(df).first()
    assert (row.id, row.text, row.title, row.page) == ("c", "", "", page or 0)


def test_packing_time_grows_with_the_text(spark):
    import time

    def seconds(paragraphs):
        text = "\n\n".join(f"paragraph {i} " + "x" * (i % 50) for i in range(paragraphs))
        df = spark.createDataFrame([("s", "p", text)], "source_id string, source_path string, text string")
        begun = time.perf_counter()
        rows = ck.chunk_texts(df, max_chars=200, overlap=40, min_chars=1).collect()
        return time.perf_counter() - begun, rows

    seconds(100)
    few, _ = seconds(10_000)
    many, rows = seconds(100_000)
    assert "".join(r.text for r in rows).count("paragraph ") == 100_000
    assert many < 40 * max(few, 0.3)
