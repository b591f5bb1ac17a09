"""Keyword, vector and hybrid top-k for a table of queries over a table of chunks.

Query and chunk pairs never become rows. Queries and chunks are cut into blocks of bounded
size that meet group by group; a group keeps the best few per query, so only ``k`` rows per
query and block reach the shuffle that picks the winners.

For keywords that is one walk over the chunks while the queries fit one block, which no index
can beat; more queries go through the token index (``tokenindex``), whose work grows with hits.
For vectors more queries than a block open only the groups of chunks they cannot rule out
(``vectorgroups``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratalake.functions.embedding import DIMENSIONS, hash_vectors, hashed_vector, words_of
from stratalake.operators import tokenindex, vectorgroups

TOP_K = 4
MAX_QUERIES = 4096
MAX_QUERY_BYTES = 64 * 2**20
CHUNKS_PER_BLOCK, BLOCK_BYTES = 2_000, 16 * 2**20
PARTS_PER_BLOCK = 16
_CELLS = 4_000_000
#: Found (token, query, chunk) triples that a keyword scorer counts at a time; one chunk may hold more.
_TRIPLES = 500_000

#: Scores a frame of chunks against the prepared queries: array (queries, chunks).
Scorer = Callable[[pd.DataFrame], np.ndarray]
#: Builds a scorer from a frame of queries.
Prepare = Callable[[pd.DataFrame], Scorer]


# Scoring ------------------------------------------------------------------------------


def keyword_scorer(queries: pd.DataFrame) -> Scorer:
    """Share of a query's distinct tokens found anywhere in title, text and source id."""
    per_query = [list(dict.fromkeys(words_of(text))) for text in queries["query"]]
    vocabulary: dict[str, int] = {}
    for words in per_query:
        for word in words:
            vocabulary.setdefault(word, len(vocabulary))
    sizes = np.array([max(len(words), 1) for words in per_query], dtype=float)
    # Queries of each token, one after the other, with where each token's list starts.
    pairs = sorted((vocabulary[w], row) for row, words in enumerate(per_query) for w in words)
    users = np.array([row for _, row in pairs], dtype=np.int64)
    degree = np.bincount([t for t, _ in pairs], minlength=len(vocabulary)).astype(np.int64)
    starts = np.cumsum(degree) - degree
    tokens_in = _finder(vocabulary)

    def counted(found: list[np.ndarray]) -> np.ndarray:
        """How many tokens of each query stand in each of some chunks: array (queries, chunks)."""
        count = len(found)
        token = np.concatenate(found)
        owners = np.repeat(np.arange(count), [len(tokens) for tokens in found])
        many = degree[token]
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        # Position of every (token, query) pair in the lists of queries.
        place = np.arange(total) - np.repeat(ends - many, many) + np.repeat(starts[token], many)
        cell = users[place] * count + np.repeat(owners, many)
        return np.bincount(cell, minlength=len(sizes) * count).reshape(len(sizes), count)

    def score(chunks: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(sizes), len(chunks)))
        held: list[np.ndarray] = []
        triples = 0
        cells = zip(chunks["title"], chunks["text"], chunks["source_id"])
        for column, (title, text, source) in enumerate(cells):
            tokens = tokens_in(f"{title or ''} {text or ''} {source or ''}".lower())
            found = np.fromiter(tokens, dtype=np.int64, count=len(tokens))
            more = int(degree[found].sum())
            # Counted a few chunks at a time: the triples grow with the queries as well as with the chunks.
            if held and triples + more > _TRIPLES:
                out[:, column - len(held) : column] = counted(held)
                held, triples = [], 0
            held.append(found)
            triples += more
        if held:
            out[:, len(chunks) - len(held) :] = counted(held)
        out /= sizes[:, None]
        return out

    return score


def _finder(vocabulary: dict[str, int]) -> Callable[[str], set[int]]:
    """Token numbers inside a text, all found in one walk over it."""
    machine = ahocorasick.Automaton()
    for token, number in vocabulary.items():
        machine.add_word(token, number)
    if not vocabulary:
        return lambda text: set()
    machine.make_automaton()
    return lambda text: {number for _, number in machine.iter(text)}


def _padded(vectors: Sequence[Sequence[float]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, vec in enumerate(vectors):
        if vec is not None:
            out[i, : min(len(vec), width)] = vec[:width]
    return out


def _lengths(vectors: Sequence[Sequence[float]]) -> np.ndarray:
    norms = np.array(
        [0.0 if v is None else float(np.sqrt(np.square(np.asarray(v, dtype=float)).sum())) for v in vectors]
    )
    return np.where(norms == 0, 1.0, norms)


def vector_scorer(queries: pd.DataFrame) -> Scorer:
    """Cosine over the shorter of two vectors; a zero vector counts as length one."""
    mine = list(queries["vector"])
    width = max((len(v) for v in mine if v is not None), default=0)
    matrix = _padded(mine, width) / _lengths(mine)[:, None]

    def score(chunks: pd.DataFrame) -> np.ndarray:
        theirs = list(chunks["vector"])
        return matrix @ (_padded(theirs, width) / _lengths(theirs)[:, None]).T

    return score


def text_scorer(dimensions: int = DIMENSIONS) -> Prepare:
    """Cosine of hashed vectors made on the spot from query and chunk texts."""

    def prepare(queries: pd.DataFrame) -> Scorer:
        known: dict[str, int] = {}
        matrix = hash_vectors(queries["query"], dimensions, known)
        return lambda chunks: matrix @ hash_vectors(chunks["text"], dimensions, known).T

    return prepare


# Top-k --------------------------------------------------------------------------------


def _best(scores: np.ndarray, ties: Sequence[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, chunk) positions of each query's top k: score descending, then the tie columns.

    Scores that are not positive, or no numbers, never qualify.
    """
    scores = np.where(np.isnan(scores), -np.inf, scores)
    count = scores.shape[1]
    floor = np.zeros(scores.shape[0])
    if count > k:
        floor = np.maximum(floor, np.partition(scores, count - k, axis=1)[:, count - k])
    rows, cols = np.nonzero((scores >= floor[:, None]) & (scores > 0))
    keys = [tie[cols] for tie in reversed(ties)]
    order = np.lexsort([*keys, -scores[rows, cols], rows])
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep]


def _merge(held: pd.DataFrame | None, found: pd.DataFrame, ties: Sequence[str], k: int) -> pd.DataFrame:
    if held is None or held.empty:
        return found
    both = pd.concat([held, found], ignore_index=True)
    both = both.sort_values(["_q", "score", *ties], ascending=[True, False, *[True] * len(ties)])
    return both.groupby("_q", sort=False).head(k)


def _top_of(frames: Iterator[pd.DataFrame], queries: pd.DataFrame, lists: Mapping[str, Prepare], ties: Sequence[str], carry: Sequence[str], k: int) -> pd.DataFrame:
    """The best k chunks per list and query over a stream of chunk frames; only those stay in memory."""
    scorers = {name: prepare(queries) for name, prepare in lists.items()}
    width = max(1, _CELLS // max(1, len(queries)))
    held: dict[str, pd.DataFrame | None] = dict.fromkeys(lists)
    for frame in frames:
        for start in range(0, len(frame), width):
            part = frame.iloc[start : start + width]
            tie_values = [part[t].to_numpy() for t in ties]
            for name, score in scorers.items():
                # Twelve digits: equal chunks score equal whatever their place in the block.
                scores = np.round(score(part), 12)
                rows, cols = _best(scores, tie_values, k)
                found = part.iloc[cols][[*carry]].reset_index(drop=True)
                found["_q"] = rows
                found["score"] = scores[rows, cols]
                held[name] = _merge(held[name], found, ties, k)
    kept = [frame.assign(list=name) for name, frame in held.items() if frame is not None]
    if not kept:
        return pd.DataFrame(columns=["query_id", "list", "score", *carry])
    all_of = pd.concat(kept, ignore_index=True)
    ids = queries["query_id"].to_numpy()
    all_of.insert(0, "query_id", ids[all_of["_q"].to_numpy(dtype=int)])
    return all_of[["query_id", "list", "score", *carry]]


def _blocks(df: DataFrame, rows: int, size: int) -> DataFrame:
    """One row ``n``: how many blocks of at most about ``rows`` rows and ``size`` bytes the table needs."""
    weight = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        if kind == "string":
            weight = weight + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            weight = weight + F.greatest(F.size(name), F.lit(0)) * 8
    # Rows go to blocks by hash, so blocks are filled to three quarters on average.
    need = F.greatest(F.count(F.lit(1)) / (0.75 * rows), F.coalesce(F.sum(weight), F.lit(0)) / (0.75 * size))
    return df.agg(F.greatest(F.lit(1), F.ceil(need)).cast("int").alias("n"))


def _found_schema(queries: DataFrame, chunks: DataFrame, carry: Sequence[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("list", T.StringType()),
            T.StructField("score", T.DoubleType()),
            *[T.StructField(name, chunks.schema[name].dataType) for name in carry],
        ]
    )


def _candidates(queries: DataFrame, chunks: DataFrame, lists: Mapping[str, Prepare], ties: Sequence[str], carry: Sequence[str], k: int, max_queries: int, max_bytes: int, max_chunks: int) -> DataFrame:
    """The best of every pair of blocks: a block of queries meets a block of chunks in one bounded group.

    The numbers of blocks are one-row aggregates inside the plan, so nothing runs while it is built
    and every size takes the same way.
    """
    out = _found_schema(queries, chunks, carry)
    # A group takes its queries a few at a time, which saves copies of the chunks.
    query_blocks = _blocks(queries, max_queries * PARTS_PER_BLOCK, max_bytes)
    chunk_blocks = _blocks(chunks, max_chunks, BLOCK_BYTES)

    def spread(df: DataFrame, own: str, mine: DataFrame, other: str, theirs: DataFrame, *names: str) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64(*names), mine.scalar()).cast("int")).withColumn("_n", theirs.scalar())
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")

    left = spread(queries, "_qb", query_blocks, "_cb", chunk_blocks, "query_id")
    right = spread(chunks, "_cb", chunk_blocks, "_qb", query_blocks, *ties)

    def per_pair(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or theirs.empty:
            return pd.DataFrame(columns=out.names)
        parts = [
            mine.iloc[start : start + max_queries].reset_index(drop=True)
            for start in range(0, len(mine), max_queries)
        ]
        found = [_top_of(iter([theirs]), part, lists, ties, carry, k) for part in parts]
        return pd.concat(found, ignore_index=True)

    keys = ["_qb", "_cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(per_pair, out)


def _ranked(candidates: DataFrame, ties: Sequence[str], k: int, *groups: str) -> DataFrame:
    best = Window.partitionBy(*groups, "query_id").orderBy(F.desc("score"), *ties)
    return candidates.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, chunks: DataFrame, lists: Mapping[str, Prepare], needs: Sequence[str], ties: Sequence[str], carry: Sequence[str] = ("id",), k: int = TOP_K, max_queries: int = MAX_QUERIES, max_bytes: int = MAX_QUERY_BYTES, max_chunks: int = CHUNKS_PER_BLOCK) -> DataFrame:
    """Rows query_id, list, score, rank and the carried chunk columns; one pass for all lists.

    ``ties`` are unique numeric chunk columns that order chunks of equal score.
    """
    carried = list(dict.fromkeys([*carry, *ties]))
    read = chunks.select(*dict.fromkeys([*carried, *needs]))
    found = _candidates(queries, read, lists, ties, carried, k, max_queries, max_bytes, max_chunks)
    return _ranked(found, ties, k, "list")


_KEYWORD_NEEDS = ("title", "text", "source_id")


def _asked(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.coalesce("query", F.lit("")).alias("query"))


def _one_block(asked: DataFrame, max_queries: int, max_bytes: int) -> bool:
    """Whether the queries fit one block of a walk; at most one row more than that is read."""
    weight = F.octet_length("query") if "query" in asked.columns else F.size("vector") * 8
    size = F.coalesce(F.sum(weight), F.lit(0)).alias("bytes")
    found = asked.limit(max_queries + 1).agg(F.count(F.lit(1)).alias("rows"), size).first()
    return found["rows"] <= max_queries and found["bytes"] <= max_bytes


def keyword_top_k(queries: DataFrame, chunks: DataFrame, ties: Sequence[str], carry: Sequence[str] = ("id",), k: int = TOP_K, max_queries: int = MAX_QUERIES, max_bytes: int = MAX_QUERY_BYTES, max_chunks: int = CHUNKS_PER_BLOCK) -> DataFrame:
    """Queries (query_id, query) over chunks with title, text and source_id.

    Up to ``max_queries`` queries of ``max_bytes`` in all are answered by one walk over the chunks, more by the
    token index. Both ways give the same rows.
    """
    asked = _asked(queries)
    if not _one_block(asked, max_queries, max_bytes):
        return tokenindex.keyword_top_k(asked, chunks, ties, carry, k)
    lists = {"keyword": keyword_scorer}
    return top_k(asked, chunks, lists, _KEYWORD_NEEDS, ties, carry, k, max_queries, max_bytes, max_chunks).drop("list")


def grouped_vector_top_k(queries: DataFrame, chunks: DataFrame, ties: Sequence[str], carry: Sequence[str] = ("id",), k: int = TOP_K, rows: int = vectorgroups.ROWS) -> DataFrame:
    """Queries (query_id, vector) over chunks with a vector column, by groups of ``rows`` chunks."""
    carried = list(dict.fromkeys([*carry, *ties]))
    read = chunks.select(*dict.fromkeys([*carried, "vector"]))
    groups = vectorgroups.build(read, ties, rows)
    lists = {"vector": vector_scorer}
    schema = _found_schema(queries, chunks, carried)

    def best(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        return _top_of(iter([theirs]), mine, lists, ties, carried, k)

    found = vectorgroups.candidates(queries.select("query_id", "vector"), groups, best, schema, k)
    return _ranked(found, ties, k).drop("list")


def vector_top_k(queries: DataFrame, chunks: DataFrame, ties: Sequence[str], carry: Sequence[str] = ("id",), k: int = TOP_K, max_queries: int = MAX_QUERIES, max_bytes: int = MAX_QUERY_BYTES, max_chunks: int = CHUNKS_PER_BLOCK) -> DataFrame:
    """Queries (query_id, vector) over chunks with a vector column.

    Up to ``max_queries`` queries of ``max_bytes`` in all are answered by one walk over the chunks, more by groups
    of about ``max_chunks`` chunks. Both ways give the same rows.
    """
    wanted = queries.select("query_id", "vector")
    if not _one_block(wanted, max_queries, max_bytes):
        return grouped_vector_top_k(wanted, chunks, ties, carry, k, max_chunks)
    lists = {"vector": vector_scorer}
    return top_k(wanted, chunks, lists, ("vector",), ties, carry, k, max_queries, max_bytes, max_chunks).drop("list")


def text_vector_top_k(queries: DataFrame, chunks: DataFrame, ties: Sequence[str], carry: Sequence[str] = ("id",), k: int = TOP_K, dimensions: int = DIMENSIONS, max_queries: int = MAX_QUERIES, max_bytes: int = MAX_QUERY_BYTES, max_chunks: int = CHUNKS_PER_BLOCK) -> DataFrame:
    """Queries (query_id, query) over chunk texts by hashed vectors; stored only where groups are made of them."""
    asked = _asked(queries)
    if not _one_block(asked, max_queries, max_bytes):
        made = with_hashed_vectors(chunks, "text", dimensions)
        return grouped_vector_top_k(with_hashed_vectors(asked, "query", dimensions), made, ties, carry, k, max_chunks)
    lists = {"vector": text_scorer(dimensions)}
    return top_k(asked, chunks, lists, ("text",), ties, carry, k, max_queries, max_bytes, max_chunks).drop("list")


def hybrid_top_k(queries: DataFrame, chunks: DataFrame, ties: Sequence[str], carry: Sequence[str] = ("id",), k: int = TOP_K, dimensions: int = DIMENSIONS, constant: int = 60, stored: bool = False, max_queries: int = MAX_QUERIES, max_bytes: int = MAX_QUERY_BYTES, max_chunks: int = CHUNKS_PER_BLOCK) -> DataFrame:
    """Keyword and vector lists joined by reciprocal rank: a hit adds 1 / (constant + rank).

    With ``stored`` the vectors of both sides are columns; otherwise texts are hashed on the spot.
    """
    asked, needs = _asked(queries), _KEYWORD_NEEDS
    if stored:
        lists = {"keyword": keyword_scorer, "vector": vector_scorer}
        asked = queries.select("query_id", F.coalesce("query", F.lit("")).alias("query"), "vector")
        needs = (*needs, "vector")
    else:
        lists = {"keyword": keyword_scorer, "vector": text_scorer(dimensions)}
    bounds = (max_queries, max_bytes, max_chunks)
    if _one_block(asked, max_queries, max_bytes):
        hits = top_k(asked, chunks, lists, needs, ties, carry, k, *bounds)
    else:
        if stored:
            by_vector = grouped_vector_top_k(asked, chunks, ties, carry, k, max_chunks)
        else:
            by_vector = text_vector_top_k(asked, chunks, ties, carry, k, dimensions, *bounds)
        by_words = tokenindex.keyword_top_k(asked, chunks, ties, carry, k)
        hits = by_vector.unionByName(by_words)
    keys = list(dict.fromkeys(["query_id", *carry, *ties]))
    part = F.sum(F.lit(1.0) / (F.col("rank") + constant))
    return _ranked(hits.groupBy(*keys).agg(F.round(part, 12).alias("score")), ties, k)


# Embedding ----------------------------------------------------------------------------


def with_hashed_vectors(df: DataFrame, text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    return df.withColumn("vector", hashed_vector(F.col(text), dimensions))


def embed_with(df: DataFrame, embed: Callable[[list[str]], list[list[float]]], text: str = "text", batch: int = 16) -> DataFrame:
    """Vectors from any Python embedder, called with ``batch`` texts at a time, order kept."""
    schema = T.StructType([*df.schema.fields, T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame[text].fillna("").tolist()
            vectors: list[list[float]] = []
            for start in range(0, len(texts), batch):
                part = texts[start : start + batch]
                made = embed(part)
                if len(made) != len(part):
                    raise ValueError(f"embedder returned {len(made)} vectors for {len(part)} texts")
                vectors.extend([list(map(float, v)) for v in made])
            yield frame.assign(vector=vectors)

    return df.mapInPandas(run, schema)


def attach_vectors(chunks: DataFrame, vectors: DataFrame, key: str = "id") -> DataFrame:
    """Chunks with the vector of the same id, one to one.

    A chunk without a vector, a vector without a chunk and an id that repeats on either side fail the job.
    """
    kind = vectors.schema["vector"].dataType
    one = F.count(F.lit(1)).alias("_vectors")
    mine = vectors.groupBy(F.col(key).alias("_id")).agg(one, F.first("vector").alias("vector"))
    repeated = chunks.groupBy(F.col(key).alias("_twice")).agg(F.count(F.lit(1)).alias("_chunks")).where("_chunks > 1")
    known = chunks.drop("vector").withColumn("_chunk", F.lit(True))
    joined = known.join(mine, known[key] == mine["_id"], "full").join(repeated, F.col("_id") == F.col("_twice"), "left")
    what = (
        F.when(F.col("_chunk").isNull(), "no chunk for vector ")
        .when(F.col("_chunks") > 1, "more than one chunk with id ")
        .when(F.col("_vectors") > 1, "more than one vector for ")
        .when(F.col("vector").isNull(), "no vector for ")
    )
    fails = F.raise_error(F.concat(what, F.coalesce(F.col(key), F.col("_id")).cast("string"))).cast(kind)
    return joined.withColumn("vector", F.when(what.isNotNull(), fails).otherwise(F.col("vector"))).select(
        *[c for c in chunks.columns if c != "vector"], "vector"
    )
