r"""Target-distribution importance resampling over hashed word features.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; features are the runs of one and two
consecutive words, joined by one space, repeats counted. A feature's bucket is the CRC-32 of its UTF-8 bytes modulo
``BUCKETS``. CRC-32 is linear but for a constant per length, so the CRC of a span is the XOR of what each byte adds at
its distance from the span's end, looked up in a table of ``REACH`` distances, and the constant: one gather and one
``bitwise_xor.reduceat`` for all spans of a batch. Spans longer than the table are cut into blocks of ``REACH`` bytes,
aligned at their ends; neighbouring blocks are folded, the left one advanced by the right one's length, until one
is left.

Two passes: the first adds up features per bucket over all source and all target texts (one row per bucket and task),
the second weighs every text by the mean gain of its features. A text's score adds Gumbel noise drawn from its id, so
the highest scores are a sample without replacement. Scores are whole numbers in a narrow range, so a histogram of
them, which does not grow with the rows, finds the lowest score that is drawn; only rows from there on are ranked, by
ranges of score and id.

Defined results: null and empty texts have no features and weight 0. Rows with equal ids have equal noise; ties go to
the smaller id (null, which draws as the empty string, first), then by row. Rows are never merged. An empty source
or target has no features, so that every gain is what the counts of the other leave. Columns named like the new
ones are replaced.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import wordhash
from stratalake.operators.history import number_rows
from stratalake.session import scratch

BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
PERCENT = 25

#: Distances from a span's end in the table, and the length of a block of a longer span.
REACH = 128
#: Bytes of feature spans that are looked up at once.
SPAN_BYTES = 1 << 21

_POLYNOMIAL = 0xEDB88320
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _position_table() -> np.ndarray:
    """What byte ``b`` with ``d`` bytes after it adds to a CRC without constants, at ``[d, b]``."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(_POLYNOMIAL), step >> 1).astype(np.uint32)
    rows = [step]
    for _ in range(REACH - 1):
        rows.append(rows[-1] >> 8 ^ step[rows[-1] & 255])
    return np.stack(rows)


_TABLE = _position_table()
_FLAT = _TABLE.ravel()
_CONSTANT = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def _apply(advance: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRCs after a number of zero bytes; ``advance`` has a row of 256 entries for each of their four bytes."""
    parts = crc[..., None] >> np.arange(0, 32, 8, dtype=np.uint32) & np.uint32(255)
    return np.bitwise_xor.reduce(advance[np.arange(4), parts], axis=-1)


#: Advances by REACH, 2 REACH, 4 REACH ... bytes, made as they are needed.
_ADVANCES = [_TABLE[[REACH - 1, REACH - 2, REACH - 3, REACH - 4]]]


def _advance(level: int) -> np.ndarray:
    while len(_ADVANCES) <= level:
        _ADVANCES.append(_apply(_ADVANCES[-1], _ADVANCES[-1]))
    return _ADVANCES[level]


def _sums(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XOR of the contributions over every span of at most ``REACH`` bytes; none may be empty."""
    first = np.cumsum(sizes) - sizes
    distance = np.repeat(sizes + first - 1, sizes) - np.arange(int(sizes.sum()))
    at = np.repeat(ends - 1, sizes) - distance
    return np.bitwise_xor.reduceat(_FLAT[(distance << 8) + data[at]], first)


def _folded(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRCs of spans of any length, block by block."""
    blocks = -(-sizes // REACH)
    levels = np.ceil(np.log2(blocks)).astype(np.int64)
    out = np.zeros(len(sizes), np.uint32)
    for level in np.unique(levels):
        for span in np.flatnonzero(levels == level):
            # zero blocks in front change nothing
            parts = np.zeros(1 << level, np.uint32)
            n, size = int(blocks[span]), int(sizes[span])
            last = int(ends[span]) - REACH * np.arange(n - 1, -1, -1)
            lengths = np.full(n, REACH)
            lengths[0] = size - REACH * (n - 1)
            step = max(1, SPAN_BYTES // REACH)
            for a in range(0, n, step):
                parts[len(parts) - n + a : len(parts) - n + min(n, a + step)] = _sums(data, last[a : a + step], lengths[a : a + step])
            for k in range(int(level)):
                parts = _apply(_advance(k), parts[0::2]) ^ parts[1::2]
            out[span] = parts[0] ^ np.uint32(_zeros_crc(size))
    return out


def _zeros_crc(size: int) -> int:
    """The CRC of so many zero bytes."""
    crc = np.array([0xFFFFFFFF], np.uint32)
    blocks, rest = divmod(size, REACH)
    level = 0
    while blocks >> level:
        if blocks >> level & 1:
            crc = _apply(_advance(level), crc)
        level += 1
    # the constant of a length is its register after the usual start, inverted
    return zlib.crc32(bytes(rest), int(crc[0]) ^ 0xFFFFFFFF)


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every span ``data[start:end]``; no span may be empty."""
    sizes = ends - starts
    out = np.zeros(len(sizes), np.uint32)
    long = sizes > REACH
    short = np.flatnonzero(~long)
    cuts = np.searchsorted(np.cumsum(sizes[short]), np.arange(SPAN_BYTES, int(sizes[short].sum()), SPAN_BYTES))
    for part in np.split(short, cuts):
        if len(part):
            out[part] = _sums(data, ends[part], sizes[part]) ^ _CONSTANT[sizes[part]]
    out[long] = _folded(data, ends[long], sizes[long])
    return out


def feature_buckets(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, row by row, the number of features before each row, and every row's number of words."""
    data, offsets = wordhash.buffer(column)
    inside = wordhash.PLAIN[data]
    edge = np.ones(len(data) + 1, bool)
    if len(data):
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[offsets] = True
        edge[[0, -1]] = True
    cuts = np.flatnonzero(edge)
    whole = inside[cuts[:-1]] if len(cuts) > 1 else np.zeros(0, bool)
    first, last = cuts[:-1][whole], cuts[1:][whole]
    # the words one after another with one space between them
    sizes = last - first
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    text = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
    keep = np.ones(len(text), bool)
    keep[ends] = False
    spaceless = np.zeros(len(data) + 1, np.int32)
    spaceless[first] += 1
    spaceless[last] -= 1
    text[keep] = _LOWER[data[np.cumsum(spaceless[:-1]) > 0]]
    row = np.searchsorted(offsets, first, "right") - 1
    pair = np.flatnonzero(row[1:] == row[:-1])
    crcs = span_crcs(text, np.concatenate([starts, starts[pair]]), np.concatenate([ends, ends[pair + 1]]))
    rows = np.concatenate([row, row[pair]])
    order = np.argsort(rows, kind="stable")
    words = np.bincount(row, minlength=len(column))
    counts = np.bincount(rows, minlength=len(column))
    return (crcs % np.uint32(buckets))[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts)]), words


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; every task sends one row per bucket, the driver keeps ``buckets`` sums."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in wordhash.slices(batch, 0):
                total += np.bincount(feature_buckets(part.column(0), buckets)[0], minlength=buckets)
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], names=["bucket", "n"])

    found = texts.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the logarithm of how much likelier it is in the target, one feature added to every bucket."""
    more = len(source)
    s_all, t_all = float(source.sum() + more), float(target.sum() + more)
    ratios = [(float(t) + 1) * s_all / ((float(s) + 1) * t_all) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``, the mean gain of the features, rounded down."""
    made = ("n_words", "n_features", "weight")
    base = docs.drop(*made)
    place = base.columns.index(text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"{m} long" for m in made])

    def run(batches):
        for batch in batches:
            for part in wordhash.slices(batch, place):
                found, before, words = feature_buckets(part.column(place), len(gains))
                total = np.concatenate([[0], np.cumsum(gains[found])])
                n = np.diff(before)
                weight = (total[before[1:]] - total[before[:-1]]) // np.maximum(n, 1)
                more = [pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, *made])

    return base.mapInArrow(run, schema)


def with_scores(weighed: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """``score``: the weight and 1000 times Gumbel noise from the id's hash, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") + 0.5) / 4294967296.0
    return weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))))


def draw(scored: DataFrame, key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank`` (1, 2, 3 ... from the highest score) for the drawn ``percent`` of rows with enough words.

    ``scored`` is stored once. The histogram on the driver has one row per different score.
    """
    spark = scored.sparkSession
    path = scratch(spark, "scored")
    scored.drop("rank").withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    able = rows.where(F.col("n_words") >= min_words)
    counts = sorted(able.groupBy("score").count().collect(), reverse=True)
    left = sum(n for _, n in counts) * percent // 100
    want, lowest = left, None
    for score, n in counts:
        if left > 0:
            lowest, left = score, left - n
    names = [c for c in rows.columns if c != "_row"]
    if lowest is None:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    high = (F.col("n_words") >= min_words) & (F.col("score") >= lowest)
    order = F.struct((-F.col("score")).alias("less"), F.col(key).alias("id"), "_row")
    ranked = number_rows(rows.where(high).withColumn("_order", order), "_order", "_rank")
    drawn = ranked.select(*names, F.when(F.col("_rank") <= want, F.col("_rank")).cast("long").alias("rank"))
    return drawn.unionByName(rows.where(~high).select(*names, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """The drawn rows of ``docs``, with their ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``."""
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = with_scores(weigh(docs, gains, text), key, seed)
    return draw(scored, key, percent, min_words).where("rank IS NOT NULL")


#: The query over ``documents`` and ``benchmark`` for DuckDB, with the CRC bit by bit and byte by byte.
ORACLE = r"""
WITH crc AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
    FROM range(256) r(b)),
w AS (SELECT 's' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL SELECT 't', row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (SELECT kind, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM w),
d AS (SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM f)),
b AS (SELECT f, xor(list_reduce(list_transform(range(0, len(h), 2), lambda i: CAST('0x' || h[i + 1:i + 2] AS BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM d, crc),
n AS (SELECT bucket, count(*) FILTER (kind = 's') AS s, count(*) FILTER (kind = 't') AS t FROM f JOIN b USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM n),
m AS (SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN b USING (f) JOIN g USING (bucket) WHERE kind = 's' GROUP BY id),
x AS (SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features,
    CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
    CAST('0x' || left(sha256('7:' || w.id), 8) AS BIGINT) AS h FROM w LEFT JOIN m ON w.id = m.id WHERE kind = 's'),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT y.doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN rank <= 25 * n // 100 THEN rank END AS BIGINT) AS rank
FROM y LEFT JOIN r ON y.doc_id = r.doc_id
"""
