import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratalake.functions.embedding import hash_vectors, words_of
from stratalake.operators import cards, retrieval, tokenindex, vectorgroups
from stratalake.operators.chunking import chunk_texts
from stratalake.sources import sinks
from tests.test_chunking import FIXTURE

WORDS = "data warehouse lake silver gold bronze the and of ciclo vida a/b query plan é".split()


def corpus(spark, count=120, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 12)))
        # A third of the chunks are copies of one text, so scores tie.
        rows.append((f"c{i}", i, i % 4, rng.choice(["Intro", ""]), "data lake plan" if i % 3 == 0 else text, "src"))
    df = spark.createDataFrame(rows, "id string, ord long, page int, title string, text string, source_id string")
    return rows, df.repartition(5)


def asked(spark, count=25, seed=4):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice([*WORDS, "zzz", "arehou"]) for _ in range(rng.randint(0, 5)))) for i in range(count)]
    return rows, spark.createDataFrame(rows, "query_id long, query string")


def plain_keyword(queries, chunks, k):
    out = set()
    for qid, query in queries:
        wanted = {w for w in query.lower().replace("/", " ").split() if len(w) > 2}
        scored = []
        for cid, order, _, title, text, source in chunks:
            hay = f"{title} {text} {source}".lower()
            share = sum(w in hay for w in wanted) / len(wanted) if wanted else 0
            if share > 0:
                scored.append((-share, order, cid))
        out |= {(qid, cid, rank, round(-share, 9)) for rank, (share, _, cid) in enumerate(sorted(scored)[:k], 1)}
    return out


def as_set(df):
    return {(r.query_id, r.id, r.rank, round(r.score, 9)) for r in df.collect()}


@pytest.mark.parametrize("common", [0, 5, 40, 1000])
def test_index_against_loop(spark, common):
    """From every word common to every word rare, the rows are those of the loop over all pairs."""
    chunks, cdf = corpus(spark)
    queries, qdf = asked(spark)
    for k in (1, 4):
        got = as_set(tokenindex.keyword_top_k(qdf, cdf, ["ord"], ["id"], k, common))
        assert got == plain_keyword(queries, chunks, k)


def test_walk_and_index_agree(spark, monkeypatch):
    chunks, cdf = corpus(spark)
    queries, qdf = asked(spark)
    expected = plain_keyword(queries, chunks, 4)
    walk = retrieval.keyword_top_k(qdf, cdf, ["ord"])
    assert "FlatMapCoGroups" in walk._jdf.queryExecution().executedPlan().toString()
    assert as_set(walk) == expected
    monkeypatch.setattr(retrieval, "PARTS_PER_BLOCK", 1)
    assert as_set(retrieval.keyword_top_k(qdf, cdf, ["ord"], max_chunks=30)) == expected
    # Too many queries, or too long ones, for one walk.
    for bounds in ({"max_queries": 7}, {"max_bytes": 100}):
        index = retrieval.keyword_top_k(qdf, cdf, ["ord"], **bounds)
        assert "FlatMapCoGroups" not in index._jdf.queryExecution().executedPlan().toString()
        assert as_set(index) == expected and index.columns == walk.columns


def test_words_are_cut_as_in_the_embedding(spark):
    texts = ["A/bcd  ÉTÉ\u00a0Straße\u3000ab abc\x1cdef", "", None, "\t\n", "ΟΔΟΣ x😀y 😀😀😀", "naïve\x85word"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in df.select("i", tokenindex.words(F.col("t")).alias("w")).collect():
        assert sorted(row.w) == sorted(set(words_of(texts[row.i])))


def test_containing_against_loop(spark):
    rng = random.Random(5)
    vocabulary = sorted({"".join(rng.choice("ab😀é.") for _ in range(rng.randint(3, 9))) for _ in range(300)})
    tokens = sorted({"".join(rng.choice("ab😀é.") for _ in range(rng.randint(3, 5))) for _ in range(60)} | {"zzz"})
    v = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    t = spark.createDataFrame([(w,) for w in tokens], "token string")
    got = sorted((r.token, r.word) for r in tokenindex.containing(t, v).collect())
    assert got == sorted((t, w) for t in tokens for w in vocabulary if t in w)


def test_keyword_edges(spark):
    """Null and empty cells, a word of half a million characters, repeated queries, an empty table."""
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefghij") for _ in range(500_000))
    rows = [(1, None, None, None), (2, "", "alpha", ""), (3, None, long, "x"), (4, "Alphabet", None, None)]
    cdf = spark.createDataFrame(rows, "ord long, title string, text string, source_id string")
    cdf = cdf.withColumn("id", F.col("ord").cast("string")).withColumn("word", F.lit("clash")).withColumn("chunk", F.lit(1))
    asked_rows = [(1, "alpha"), (2, "alpha ALPHA"), (3, None), (4, ""), (5, long[1000:1040]), (6, long), (7, "none")]
    qdf = spark.createDataFrame(asked_rows, "query_id long, query string")
    ways = [tokenindex.keyword_top_k(qdf, cdf, ["ord"], ["id"], 4, common) for common in (0, 1000)]
    for way in [*ways, retrieval.keyword_top_k(qdf, cdf, ["ord"])]:
        got = {(r.query_id, r.id, r.rank) for r in way.collect()}
        assert got == {(1, "2", 1), (1, "4", 2), (2, "2", 1), (2, "4", 2), (5, "3", 1), (6, "3", 1)}
    assert tokenindex.keyword_top_k(qdf, cdf.limit(0), ["ord"], ["id"], 4).count() == 0


def test_scored_pairs_grow_with_hits(spark):
    """A word of every chunk and query makes one class, and rare words meet their chunks only."""
    chunks = spark.range(3000).select(
        F.col("id").alias("ord"), F.lit("").alias("title"), F.concat(F.lit("everywhere word"), F.col("id")).alias("text"), F.lit("").alias("source_id")
    )
    queries = [(i, f"everywhere word{i}") for i in range(1000, 1200)]
    qdf = spark.createDataFrame(queries, "query_id long, query string")
    held = tokenindex.postings(chunks, ["ord"])
    best = tokenindex.search(qdf, held, 2)
    got = {(r.query_id, r.chunk.ord, r["rank"], r.score) for r in best.collect()}
    assert got == {(i, i, 1, 1.0) for i, _ in queries} | {(i, 0, 2, 0.5) for i, _ in queries}
    tokens = qdf.select(F.explode(tokenindex.words(F.col("query"))).alias("token")).distinct()
    sizes = tokenindex.hits(tokens, held).groupBy("token").count()
    assert sizes.agg(F.sum("count")).first()[0] == 3000 + len(queries)


def test_plain_search_equals_one_walk():
    few = {w: i for i, w in enumerate(WORDS)}
    many = {**few, **{f"filler{i}": len(few) + i for i in range(100)}}
    text = "the data warehouses of silvergold"
    assert retrieval._finder(few)(text) == {t for t in retrieval._finder(many)(text) if t < len(few)}


def test_vector_against_loop(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(90, 8))
    vectors[10] = vectors[11] = vectors[12]
    vectors[20] = 0
    queries = np.vstack([vectors[12], -vectors[3], np.zeros(8), rng.normal(size=8)])
    cdf = spark.createDataFrame([(str(i), i, v.tolist()) for i, v in enumerate(vectors)], "id string, ord long, vector array<double>")
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, vector array<double>")
    expected = set()
    for qid, q in enumerate(queries):
        scored = []
        for i, v in enumerate(vectors):
            score = round(float(q @ v) / ((np.linalg.norm(q) or 1) * (np.linalg.norm(v) or 1)), 12)
            if score > 0:
                scored.append((-score, i))
        expected |= {(qid, str(i), rank, round(-s, 9)) for rank, (s, i) in enumerate(sorted(scored)[:4], 1)}
    assert as_set(retrieval.vector_top_k(qdf, cdf.repartition(4), ["ord"])) == expected
    assert as_set(retrieval.vector_top_k(qdf, cdf.repartition(4), ["ord"], max_queries=1)) == expected


def clustered(spark, centres=12, each=40, width=16, seed=3):
    """Tight clusters, one of them of copies, with null, empty, zero, spoilt and short vectors among them."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    vectors = [(middle[c] + 0.02 * rng.normal(size=width)).tolist() for c in range(centres) for _ in range(each)]
    vectors += [middle[0].tolist()] * 150
    vectors += [None, [], [0.0] * width, [float("nan")] * width, [1.0, 2.0], [-1.0], [float("inf")] * width]
    chunks = spark.createDataFrame([(str(i), i, v) for i, v in enumerate(vectors)], "id string, ord long, vector array<double>")
    asked_vectors = [(middle[i % centres] + 0.05 * rng.normal(size=width)).tolist() for i in range(60)]
    asked_vectors += [None, [], [0.0] * width, [1.0], rng.normal(size=width + 3).tolist(), middle[0].tolist()]
    queries = spark.createDataFrame(list(enumerate(asked_vectors)), "query_id long, vector array<double>")
    return queries, chunks.repartition(4)


@pytest.mark.parametrize("rows, k", [(20, 4), (7, 1), (50, 30), (10_000, 4)])
def test_groups_and_walk_agree(spark, rows, k):
    queries, chunks = clustered(spark)
    walk = retrieval.vector_top_k(queries, chunks, ["ord"], k=k)
    got = retrieval.grouped_vector_top_k(queries, chunks, ["ord"], k=k, rows=rows)
    assert got.columns == walk.columns and as_set(got) == as_set(walk) and walk.count() > 0


def test_groups_are_skipped(spark):
    queries, chunks = clustered(spark)
    groups = vectorgroups.build(chunks, ["ord"], 20)
    centres = groups.centres.collect()
    assert sum(c.rows for c in centres) == groups.members.count() == 12 * 40 + 150 + 2
    # Copies of one vector do not make one large group.
    assert max(c.rows for c in centres) <= 60 and len(centres) > 20
    first = vectorgroups.nearest(queries.where("query_id < 60"), groups, 4)
    known = queries.join(first, "query_id").withColumn("floor", F.lit(0.98))
    more = vectorgroups.reached(known, groups).count()
    assert first.count() == 60 and more < 60 * len(centres) / 4


def test_group_bounds_hold():
    rng = np.random.default_rng(8)
    for spread in (1e-9, 0.01, 0.5, 3.0):
        members = vectorgroups.units((rng.normal(size=8) + spread * rng.normal(size=(50, 8))).tolist(), 8)
        centre = vectorgroups.units([members.sum(axis=0)], 8)
        radius = np.array([np.arccos(np.clip(members @ centre[0], -1, 1)).max()])
        queries = np.vstack([vectorgroups.units(rng.normal(size=(200, 8)).tolist(), 8), members, -members])
        assert ((queries @ members.T).max(axis=1) <= vectorgroups.bounds(queries, centre, radius)[:, 0]).all()


def test_no_vectors(spark):
    queries, chunks = clustered(spark)
    assert retrieval.grouped_vector_top_k(queries, chunks.limit(0), ["ord"]).count() == 0
    assert retrieval.grouped_vector_top_k(queries.limit(0), chunks, ["ord"]).count() == 0
    assert as_set(retrieval.vector_top_k(queries, chunks, ["ord"], max_queries=9)) == as_set(retrieval.vector_top_k(queries, chunks, ["ord"]))


def test_nearest_chunk(spark):
    rows = [("a", 1, "o ciclo de vida da engenharia de dados cobre geracao e ingestao"), ("b", 2, "receitas de cerveja artesanal e lupulo")]
    chunks = spark.createDataFrame(rows, "id string, ord int, text string")
    query = spark.createDataFrame([(1, "ciclo de vida engenharia de dados")], "query_id int, query string")
    assert retrieval.text_vector_top_k(query, chunks, ["ord"], k=2).orderBy("rank").first().id == "a"
    stored = retrieval.with_hashed_vectors(chunks)
    by_vector = retrieval.vector_top_k(retrieval.with_hashed_vectors(query, "query"), stored, ["ord"], k=2)
    assert by_vector.orderBy("rank").first().id == "a"


def test_hybrid_adds_both_lists(spark):
    _, cdf = corpus(spark)
    _, qdf = asked(spark)
    keyword = {(r.query_id, r.id): r.rank for r in retrieval.keyword_top_k(qdf, cdf, ["ord"]).collect()}
    vector = {(r.query_id, r.id): r.rank for r in retrieval.text_vector_top_k(qdf, cdf, ["ord"]).collect()}
    pool = {}
    for ranks in (keyword, vector):
        for key, rank in ranks.items():
            pool[key] = pool.get(key, 0) + 1 / (60 + rank)
    for r in retrieval.hybrid_top_k(qdf, cdf, ["ord"]).collect():
        assert r.score == pytest.approx(pool[r.query_id, r.id])
    apart = retrieval.hybrid_top_k(qdf, cdf, ["ord"], max_queries=5)
    assert as_set(apart) == as_set(retrieval.hybrid_top_k(qdf, cdf, ["ord"]))
    assert len(pool) >= retrieval.hybrid_top_k(qdf, cdf, ["ord"]).count() > 0


def test_no_queries(spark):
    _, cdf = corpus(spark)
    none = spark.createDataFrame([], "query_id long, query string")
    assert retrieval.keyword_top_k(none, cdf, ["ord"]).count() == 0


def test_embed_with(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "i int, text string").coalesce(1)
    sizes = []

    def embed(texts):
        assert len(texts) <= 16
        return [[float(t[1:])] for t in texts]

    got = retrieval.embed_with(df, embed).collect()
    assert [(r.i, r.vector) for r in sorted(got)] == [(i, [float(i)]) for i in range(40)] and not sizes
    with pytest.raises(Exception, match="returned 0 vectors"):
        retrieval.embed_with(df, lambda texts: []).collect()


def test_attach_vectors(spark):
    chunks = spark.createDataFrame([("a",), ("b",)], "id string")
    vectors = spark.createDataFrame([("a", [1.0])], "id string, vector array<double>")
    with pytest.raises(Exception, match="no vector for b"):
        retrieval.attach_vectors(chunks, vectors).collect()


CASES = [
    (1, "ask", "O que e o ciclo de vida da engenharia de dados?", True, [1], ["ciclo", "geracao"], True),
    (2, "ask", "data warehouse", True, [2], ["warehouse"], True),
    (3, "ask", "arquitetura medallion", True, [3], ["medallion", "bronze"], True),
    (4, "ask", "How do quantum qubits teleport beer recipes?", False, [], None, None),
    (5, "quote", "data warehouse", True, [2], ["warehouse"], None),
    (6, "note", "data warehouse", True, [], ["data warehouse"], True),
    (7, "example", "data warehouse", True, [2], ["dia a dia"], True),
    (8, "ask", "data warehouse", False, [3, 9], ["x"], True),
]


def golden(spark):
    book = spark.createDataFrame([("book", "book.txt", FIXTURE)], "source_id string, source_path string, text string")
    chunks = chunk_texts(book)
    cases = spark.createDataFrame(CASES, "query_id int, task string, query string, expect_covered boolean, pages array<int>, terms array<string>, cite_pages boolean")
    hits = retrieval.keyword_top_k(cases, chunks, ["serial"], ["id", "page", "title", "text"])
    return cards.with_hits(cases, hits)


def test_golden_cases(spark):
    judged = {r.query_id: r.errors for r in cards.evaluate_cases(golden(spark)).collect()}
    assert all(not judged[i] for i in range(1, 8))
    assert judged[8] == ["covered=True expected False", "missing pages [3, 9] in [2]", "uncovered topic must use the uncovered string"] or judged[8][0] == "covered=True expected False"
    rate = cards.pass_rate(cards.evaluate_cases(golden(spark))).first()
    assert (rate.cases, rate.passed, rate.rate) == (8, 7, 0.875)


def test_cards(spark):
    found = golden(spark)
    answers = {r.query_id: r for r in cards.answer_cards(found).collect()}
    assert answers[4].answer == cards.UNCOVERED and answers[4].citations == [] and not answers[4].offer_example
    lines = answers[2].answer.split("\n")
    assert lines[:3] == ["Pergunta: data warehouse", "", "Segundo o livro:"]
    assert lines[3].startswith("- p.2 [book-p2-2]: Capitulo 2 O data warehouse")
    assert (answers[2].citations[0].chunk_id, answers[2].citations[0].page) == ("book-p2-2", 2)
    examples = {r.query_id: r for r in cards.example_cards(found).collect()}
    assert examples[2].scenario.startswith("Contexto: data warehouse no dia a dia")
    quotes = {r.query_id: r for r in cards.quote_cards(found).collect()}
    assert quotes[5].passages[0].text.startswith("Capitulo 2\n") and quotes[4].passages == []


def test_notes(spark):
    notes = cards.render_notes(cards.note_records(golden(spark)))
    keyed = {r.query_id: r for r in sinks.append_numbered(None, notes, "query_id").collect()}
    assert 4 not in keyed and [keyed[i].note_key for i in (1, 2, 3, 5)] == ["NOTE-0001", "NOTE-0002", "NOTE-0003", "NOTE-0004"]
    note = keyed[2]
    assert note.claim.startswith("data warehouse: Capitulo 2 O data") and note.pages[0] == 2
    assert note.evidence.startswith("[p.2] Capitulo 2\n") and note.template.claim == note.claim
    more = sinks.append_numbered(notes, notes, "query_id").orderBy("query_id").first()
    assert more.note_key == "NOTE-0008"
    made = golden(spark).withColumn("syn", F.struct(F.lit(" own ").alias("claim"), F.lit("").alias("evidence")))
    own = cards.note_records(made, "syn").where("query_id = 2").first()
    assert own.claim == "own" and own.evidence == note.evidence


def test_hits_as_text(spark):
    row = golden(spark).where("query_id = 2").select(cards.hits_as_text(F.col("hits")).alias("t")).first()
    assert row.t.startswith("### p.2 Capitulo 2 (book-p2-2)\nCapitulo 2\n")


def test_hash_vectors_cache_limit(monkeypatch):
    from stratalake.functions import embedding

    texts = ["alpha beta gamma delta"] * 3
    full = hash_vectors(texts)
    monkeypatch.setattr(embedding, "CACHE_TOKENS", 2)
    assert (hash_vectors(texts) == full).all()


def test_scores_that_are_no_numbers_lose_no_hits(spark):
    nan = float("nan")
    query = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    good = [(i, str(i), [1.0, i / 10]) for i in range(4)]
    for spoilt in (1, 4, 9):
        rows = good + [(100 + i, "x", [nan, 1.0]) for i in range(spoilt)]
        chunks = spark.createDataFrame(rows, "n long, id string, vector array<double>").coalesce(1)
        hits = retrieval.vector_top_k(query, chunks, ["n"], k=4).orderBy("rank").collect()
        assert [r.id for r in hits] == ["0", "1", "2", "3"]


def test_keyword_scorer_counts_hits_in_bounded_parts(monkeypatch):
    """Many queries of common words: what is held at a time does not grow with queries x words x chunks."""
    words = [f"word{i:02d}" for i in range(20)]
    queries = pd.DataFrame({"query": [" ".join(words[i % 5 :]) for i in range(300)] + ["", None]})
    texts = [None, "", *[" ".join(words[: i % 21]) for i in range(400)]]
    chunks = pd.DataFrame({"title": None, "text": texts, "source_id": "s"}, dtype=object)
    score = retrieval.keyword_scorer(queries)
    tracemalloc.start()
    whole = score(chunks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * 2**20
    for row in (0, 4, 300, 301):
        mine = words[row % 5 :] if row < 300 else []
        want = [sum(w in (t or "") for w in mine) / max(len(mine), 1) for t in texts]
        assert whole[row].tolist() == want
    monkeypatch.setattr(retrieval, "_TRIPLES", 1)
    assert (score(chunks) == whole).all()
    assert score(chunks.iloc[:0]).shape == (302, 0)


@pytest.mark.parametrize("common", [0, 3, 1000])
def test_index_in_small_blocks(spark, monkeypatch, common):
    """Blocks of few query words, sets and cells give the rows of a plain loop, also over stored postings."""
    chunks, cdf = corpus(spark)
    queries, qdf = asked(spark)
    monkeypatch.setattr(tokenindex, "CELLS", 40)
    walked, by_common = tokenindex.walked, tokenindex._by_common_words
    monkeypatch.setattr(tokenindex, "walked", lambda *a: walked(*a, walk=300))
    monkeypatch.setattr(tokenindex, "_by_common_words", lambda *a: by_common(*a, block=7))
    expected = plain_keyword(queries, chunks, 3)
    assert as_set(tokenindex.keyword_top_k(qdf, cdf, ["ord"], ["id"], 3, common)) == expected
    held = tokenindex.search(qdf, tokenindex.postings(cdf, ["ord"]), 3, common)
    assert as_set(held.select("query_id", F.concat(F.lit("c"), "chunk.ord").alias("id"), "rank", "score")) == expected


def test_index_stores_a_row_a_chunk(spark, monkeypatch):
    """Words that stand in every chunk are no rows of their own: hits once took more disk than the texts."""
    rows = []
    kept = tokenindex._kept
    monkeypatch.setattr(tokenindex, "_kept", lambda df, label: (rows.append(kept(df, label)), rows[-1])[1])
    text = " ".join(f"word{i}" for i in range(40))
    cdf = spark.range(500).select(F.col("id").alias("ord"), F.lit("").alias("title"), F.lit(text).alias("text"), F.lit("").alias("source_id"))
    qdf = spark.range(30).select(F.col("id").alias("query_id"), F.lit(text).alias("query"))
    assert tokenindex.keyword_top_k(qdf, cdf, ["ord"], [], 2).count() == 60
    assert max(df.count() for df in rows) <= 500


@pytest.mark.parametrize("common", [0, 2, 1000])
def test_index_over_repeated_and_missing_ties(spark, common):
    """Rows of one tie value, null included, are one chunk; stored postings give the same rows."""
    texts = [(1, "alpha beta"), (1, "alpha beta"), (1, "alpha gamma"), (2, "beta"), (None, "alpha"), (None, "gamma delta")]
    cdf = spark.createDataFrame([(o, "", t, "") for o, t in texts], "ord long, title string, text string, source_id string").repartition(3)
    qdf = spark.createDataFrame([(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, "gamma delta")], "query_id long, query string")
    found = tokenindex.search(qdf, tokenindex.postings(cdf, ["ord"]), 2, common)
    named = cdf.select(F.struct("ord").alias("chunk"), "ord")
    expected = sorted((r.query_id, str(r.ord), r["rank"], r.score) for r in found.join(named, "chunk").collect())
    got = sorted((r.query_id, str(r.ord), r["rank"], r.score) for r in tokenindex.keyword_top_k(qdf, cdf, ["ord"], [], 2, common).collect())
    assert got == expected
    assert {(1, "1", 1, 1.0), (1, "None", 2, round(2 / 3, 12)), (2, "None", 1, 1.0), (2, "1", 2, 0.5)} == set(got)
