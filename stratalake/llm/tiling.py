"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and non-ASCII bytes, lower-cased. A seed is a window of ``min_match`` words.
One pass over the documents keeps the words under seeds that a bitmap of the benchmark's seeds lets through; the
bitmap has a fixed size, and what it lets through wrongly is dropped by the join on seeds that follows. Every
document and item with a common seed is then tiled: the longest common unmarked run is found by Karp-Rabin hashes
and marked, again and again, until no run of ``min_match`` words is left. A common run of that length lies wholly
under seeds, so tiling the kept words is tiling the whole text. A document is contaminated by an item of which the
tiles cover at least ``coverage``; as tiles may lie anywhere, passages in another order are caught as well. Where only
that verdict counts, pairs whose common seeds cannot cover so much (each covers ``min_match`` words at most) are not tiled.

Rows with one id (null included) and one text are one document; rows with one id and different texts are judged apart. Null and empty texts are never contaminated; an item with
fewer than ``min_match`` words contaminates nothing; items with equal texts count once, under the smallest id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import bitmaps, wordhash
from stratalake.session import scratch

MIN_MATCH = 5
COVERAGE = 0.6


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = wordhash.buffer(column)
    hashes, before, _, _ = wordhash.hash_words(data, offsets, wordhash.PLAIN)
    return hashes, before


def _longs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def item_words(benchmark: DataFrame, item: str, text: str, min_match: int) -> DataFrame:
    """One row per distinct item text: ``item_id``, its ``words`` and its ``seeds``."""
    items = benchmark.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(item).alias("item_id"))
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            words, before = _words(batch.column(0))
            seeds, at = wordhash.windows(words, before, min_match)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), _longs(words, before), _longs(seeds, np.searchsorted(at, before))],
                names=["item_id", "words", "seeds"],
            )

    return items.mapInArrow(run, f"item_id {kind}, words array<long>, seeds array<long>")


def seeded_words(docs: DataFrame, bitmap: bytes, key: str, text: str, min_match: int) -> DataFrame:
    """Per row with a seed in the bitmap: ``doc``, ``mark`` (the text's hash), its ``runs`` of words under such seeds, and those ``seeds``.

    Runs are separated by a zero.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in (part for whole in batches for part in wordhash.slices(whole, 2)):
            words, before = _words(batch.column(2))
            seeds, at = wordhash.windows(words, before, min_match)
            hit = bitmaps.contains(bits, seeds)
            seeds, at = seeds[hit], at[hit]
            row = np.searchsorted(before, at, "right") - 1
            rows, first = np.unique(row, return_index=True)
            bounds = np.append(first, len(at))
            runs = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                places = at[a:b]
                gaps = np.flatnonzero(np.diff(places) > min_match) + 1
                pieces = []
                for group in np.split(places, gaps):
                    pieces += [words[group[0] : group[-1] + min_match], np.zeros(1, np.uint64)]
                runs.append(np.concatenate(pieces).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(rows)) for i in (0, 1)), pa.array(runs, pa.list_(pa.int64())), _longs(seeds, bounds)],
                names=["doc", "mark", "runs", "seeds"],
            )

    marked = docs.select(key, F.xxhash64(text), text)
    return marked.mapInArrow(run, f"doc {kind}, mark long, runs array<long>, seeds array<long>")


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in doc, length), longest first, no word used twice.

    Seeds that match at neighbouring places of both are one run, so runs are counted seed by seed: one step per seed of the
    item, over the places in the document that it matches.
    """
    item_free, doc_free = item != 0, doc != 0
    out: list[tuple[int, int, int]] = []

    def rolling(words: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, at = wordhash.windows(words.view(np.uint64), np.array([0, len(words)]), min_match)
        whole = np.convolve(free, np.ones(min_match, int), "valid") == min_match if len(at) else np.zeros(0, bool)
        return hashes[whole], at[whole]

    while True:
        doc_hash, doc_at = rolling(doc, doc_free)
        item_hash, item_at = rolling(item, item_free)
        order = np.argsort(doc_hash, kind="stable")
        lows = np.searchsorted(doc_hash, item_hash, "left", sorter=order)
        highs = np.searchsorted(doc_hash, item_hash, "right", sorter=order)
        behind = np.zeros(len(doc) + 1, np.int64)  # seeds in a row that end before each place
        last, previous = np.zeros(0, np.int64), -2
        most, found = 0, []
        for i, low, high in zip(item_at.tolist(), lows, highs, strict=True):
            places = doc_at[order[low:high]]
            seeds = (behind[places] if i == previous + 1 else 0) + np.ones(len(places), np.int64)
            behind[last] = 0
            last, previous = places + 1, i
            behind[last] = seeds
            if len(places) and seeds.max() >= most:
                if seeds.max() > most:
                    most, found = int(seeds.max()), []
                found += [(i - most + 1, j - most + 1) for j in places[seeds == most].tolist()]
        if not found:
            return out
        longest = most + min_match - 1
        for i, j in found:
            if item_free[i] and item_free[i : i + longest].all() and doc_free[j : j + longest].all():
                item_free[i : i + longest] = doc_free[j : j + longest] = False
                out.append((i, j, longest))


def _tiled(pairs: DataFrame, min_match: int) -> DataFrame:
    doc, item = (pairs.schema[c].dataType.simpleString() for c in ("doc", "item_id"))

    def run(batches):
        for batch in batches:
            covered = []
            for runs, words in zip(batch.column(3), batch.column(4), strict=True):
                a = np.asarray(words.values.to_numpy(zero_copy_only=False), np.int64)
                b = np.asarray(runs.values.to_numpy(zero_copy_only=False), np.int64)
                covered.append(sum(n for _, _, n in tiles(a, b, min_match)) / len(a))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(covered, pa.float64())],
                names=["doc", "mark", "item_id", "covered"],
            )

    chosen = pairs.select("doc", "mark", "item_id", "runs", "words")
    return chosen.mapInArrow(run, f"doc {doc}, mark long, item_id {item}, covered double")


def coverages(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    min_match: int = MIN_MATCH,
    least: float = 0.0,
) -> DataFrame:
    """``doc``, ``mark``, ``item_id``, ``covered``: the share of the item's words under tiles, for all with a common seed.

    Pairs that cannot cover ``least`` of the item are left out.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "tiling")
    item_words(benchmark, item, item_text, min_match).write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    seeds = items.select("item_id", F.explode("seeds").alias("seed")).groupBy("item_id", "seed").agg(F.count(F.lit(1)).alias("times"))
    found = seeded_words(docs, bitmaps.build(seeds, "seed"), key, text, min_match)
    found.withColumn("part", F.monotonically_increasing_id()).write.parquet(f"{folder}/docs")
    seeded = spark.read.parquet(f"{folder}/docs")
    pairs = (
        seeded.select("part", F.explode(F.array_distinct("seeds")).alias("seed"))
        .join(seeds, "seed")
        .groupBy("part", "item_id")
        .agg(F.sum("times").alias("seen"))
        .join(items.select("item_id", F.size("words").alias("n")), "item_id")
        .where(F.col("seen") * min_match >= F.lit(least) * F.col("n"))
        .select("part", "item_id")
    )
    return _tiled(seeded.join(pairs, "part").join(items, "item_id"), min_match)


def verdicts(covered: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Per document with any tile: ``doc``, ``mark``, ``best_item`` (ties: the smallest), its ``best_coverage``, ``contaminated``."""
    best: Column = F.min(F.struct((-F.col("covered")).alias("less"), "item_id"))
    return covered.groupBy("doc", "mark").agg(best.alias("best")).select(
        "doc",
        "mark",
        F.col("best.item_id").alias("best_item"),
        (-F.col("best.less")).alias("best_coverage"),
        (-F.col("best.less") >= coverage).alias("contaminated"),
    )


def judge(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", coverage: float = COVERAGE, **options) -> DataFrame:
    """Every row's id with ``best_item``, ``best_coverage`` (0 without a tile) and ``contaminated``."""
    found = verdicts(coverages(docs, benchmark, key, **options), coverage)
    rows = docs.select(key, F.xxhash64(options.get("text", "text")).alias("_mark"))
    same = rows[key].eqNullSafe(found["doc"]) & (rows["_mark"] == found["mark"])
    return rows.join(found, same, "left").select(
        key,
        "best_item",
        F.coalesce("best_coverage", F.lit(0.0)).alias("best_coverage"),
        F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, unchanged."""
    coverage = options.pop("coverage", COVERAGE)
    bad = verdicts(coverages(docs, benchmark, key, least=coverage, **options), coverage).where("contaminated")
    same = docs[key].eqNullSafe(bad["doc"]) & (F.xxhash64(docs[options.get("text", "text")]) == bad["mark"])
    return docs.join(bad, same, "left_anti")
