"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a text: densities and counts of words and word beginnings from a learned lexicon, hits close to a
second-person word, rates of capitals, punctuation, digits and obfuscated words, word repetition and length. The
lexicon holds words and beginnings that stand far more often in toxic than in other labelled texts. Labelled rows
are a sample of at most ``SAMPLE`` rows, dealt into three folds; a row's features come from the lexicon of the other
folds, so the trees see no term that was learned from the row itself. The trees are fitted on two folds and
calibrated on the third. Everything that does not follow from the text (labels, ids, language, source) stays out of
the features.

Null and empty texts get features of zero and so a score like any other. A document with several labels is toxic if
one of them says so; rows that share an id stand in the sample once, with their least text. Without labels of both
kinds the score is the share of toxic labels, 0 without labels. A null id is scored and never trains.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import wordhash
from stratalake.session import scratch

#: Labelled rows that train the model, and lexicon entries, at most.
SAMPLE = 10_000
LEXICON = 4_000
#: A term enters the lexicon if it is so much likelier in toxic texts, and not by chance: its likelihood-ratio
#: statistic against equal rates must reach this (about one in ten thousand for a term without a bias).
RATIO = 8.0
EVIDENCE = 15.0
FOLDS = 3
#: Beginnings of words, in bytes.
BEGINNINGS = (4, 5, 6)
#: Words between a hit and a second-person word, at most.
REACH = 5
TREES, DEPTH = 24, 4
CUT = 0.3

#: Second-person words of the languages at hand.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos usted ustedes tú ti tus su vosotros os"
).split()

FEATURES = (
    "word_density", "word_hits", "beginning_density", "beginning_hits", "strongest", "addressed_density",
    "capitals", "exclamations", "punctuation", "digits", "obfuscated", "repeated", "length",
)

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_EXCLAIM = np.isin(_BYTE, [ord("!"), ord("?")])
_PUNCT = ~wordhash.PLAIN & ~wordhash.SPACES & (_BYTE > 32)
_DISGUISE = _DIGIT | np.isin(_BYTE, [ord(c) for c in "@$*#"])


@dataclass
class Lexicon:
    """Term hashes in order, and how much likelier (as a logarithm) each is in toxic texts."""

    terms: np.ndarray
    weights: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The weight of every hash, 0 for those outside the lexicon."""
        if not len(self.terms):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, self.weights[at], 0.0)


@dataclass
class Toxicity:
    lexicon: Lexicon
    trees: Model | None
    calibration: Model | None
    share: float


def _parsed(column: pa.Array):
    data, rows = wordhash.buffer(column)
    words, before, first, last = wordhash.hash_words(data, rows, wordhash.PLAIN)
    return data, rows, words, before, first, last


def _beginnings(data: np.ndarray, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """For every length the hashes of the words' beginnings; words that are no longer give 0."""
    out = []
    for size in BEGINNINGS:
        total = np.zeros(len(words), np.uint64)
        long = np.flatnonzero(last - first > size)
        for k in range(size):
            total[long] = wordhash.mix(total[long] + wordhash.VALUES[data[first[long] + k]])
        out.append(total)
    return out


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of :data:`FEATURES` per text."""
    data, rows, words, before, first, last = _parsed(column)
    count = np.diff(before)
    size = np.diff(rows)
    per_word, per_byte = 1 / np.maximum(count, 1), 1 / np.maximum(size, 1)

    def by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[bounds[1:]] - total[bounds[:-1]]

    def rate(kind: np.ndarray) -> np.ndarray:
        return by_row(kind[data], rows) * per_byte

    word = lexicon.find(words)
    start = np.max([lexicon.find(x) for x in _beginnings(data, words, first, last)], axis=0) if len(words) else word
    hit = (word > 0) | (start > 0)
    second = np.isin(words, _second_person())
    near = np.zeros(len(words), bool)
    row = np.repeat(np.arange(len(count)), count)
    for shift in range(-REACH, REACH + 1):
        a, b = max(0, -shift), len(words) - max(0, shift)
        if b > a:
            near[a:b] |= second[a + shift : b + shift] & (row[a:b] == row[a + shift : b + shift])
    strongest = np.zeros(len(count))
    np.maximum.at(strongest, row, np.maximum(word, start))
    token, token_before, token_first, token_last = wordhash.hash_words(data, rows, ~wordhash.SPACES)

    def inside(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data])])
        return total[token_last] - total[token_first]

    disguised = (inside(_LETTER) >= 2) & (inside(_DISGUISE) >= 1)
    fresh = np.ones(len(words), bool)
    order = np.lexsort((words, row))
    fresh[1:] = (np.diff(row[order]) != 0) | (words[order][1:] != words[order][:-1])
    return np.stack(
        [
            100 * by_row(word > 0, before) * per_word,
            np.log1p(by_row(word > 0, before)),
            100 * by_row(start > 0, before) * per_word,
            np.log1p(by_row(start > 0, before)),
            strongest,
            100 * by_row(hit & near, before) * per_word,
            rate(_UPPER) / np.maximum(rate(_LETTER), 1e-9),
            rate(_EXCLAIM),
            rate(_PUNCT),
            rate(_DIGIT),
            by_row(disguised, token_before) / np.maximum(np.diff(token_before), 1),
            1 - by_row(fresh, before) * per_word * (count > 0) - (count == 0),
            np.log1p(count),
        ],
        axis=1,
    )


def _second_person() -> np.ndarray:
    data, rows = wordhash.buffer(pa.array(SECOND_PERSON))
    return wordhash.hash_words(data, rows, wordhash.PLAIN)[0]


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "features") -> DataFrame:
    """``docs`` with the features of each text as an array of doubles."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.terms, lexicon.weights))
    base = docs.drop(name)
    names = base.columns

    def run(batches):
        known = Lexicon(*shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for part in wordhash.slices(batch, at):
                made = features(part.column(at), known)
                offsets = pa.array(np.arange(len(made) + 1) * len(FEATURES), pa.int32())
                made = pa.ListArray.from_arrays(offsets, pa.array(made.ravel()))
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, made], names=[*names, name])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))


def _terms(sample: DataFrame) -> DataFrame:
    """``fold``, ``toxic``, ``term``, ``n``: in how many texts of a batch each word or beginning stands."""

    def run(batches):
        for batch in batches:
            for part in wordhash.slices(batch, 0):
                data, _, words, before, first, last = _parsed(part.column(0))
                row = np.repeat(np.arange(part.num_rows), np.diff(before))
                starts = _beginnings(data, words, first, last)
                terms = np.concatenate([words, *starts])
                rows = np.concatenate([row] * (1 + len(starts)))
                order = np.lexsort((terms, rows))
                terms, rows = terms[order], rows[order]
                keep = terms != 0
                keep[1:] &= (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])
                group = 2 * part.column(1).to_numpy()[rows] + part.column(2).to_numpy()[rows]
                for g in range(2 * FOLDS):
                    found, n = np.unique(terms[keep & (group == g)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), g)), pa.array(found.view(np.int64)), pa.array(n)],
                        names=["kind", "term", "n"],
                    )

    return sample.select("text", "fold", "toxic").mapInArrow(run, "kind long, term long, n long")


def _lexicon(table: np.ndarray, terms: np.ndarray, toxic: np.ndarray, other: np.ndarray, left_out: int | None) -> Lexicon:
    use = [f for f in range(FOLDS) if f != left_out]
    n1, n0 = table[:, [2 * f + 1 for f in use]].sum(1), table[:, [2 * f for f in use]].sum(1)
    likelier = np.log((n1 + 0.5) / (toxic[use].sum() + 1)) - np.log((n0 + 0.5) / (other[use].sum() + 1))
    share = toxic[use].sum() / max(1.0, toxic[use].sum() + other[use].sum())
    both = np.maximum(n1 + n0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = 2 * sum(np.where(n > 0, n * np.log(n / (both * p)), 0) for n, p in ((n1, share), (n0, 1 - share)))
    good = np.flatnonzero((evidence >= EVIDENCE) & (likelier >= np.log(RATIO)))
    best = good[np.lexsort((terms[good], -evidence[good]))[:LEXICON]]
    best = best[np.argsort(terms[best])]
    return Lexicon(terms[best], likelier[best])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, trains: Column, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """``text``, ``toxic``, ``fold`` of at most ``SAMPLE`` labelled rows, the first in the order of an id hash."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & trains)
    known = known.groupBy(F.col(key).alias("_id")).agg(F.max(F.col(label).cast("long")).alias("toxic"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
    # at most SAMPLE short rows
    both = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(known), "_id")
    one = both.groupBy("_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return one.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).alias("fold"))


def fit(docs: DataFrame, labels: DataFrame, trains: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Toxicity:
    """Learns lexicon, trees and calibration from the labelled rows for which ``trains`` (of ``labels``) holds."""
    spark = docs.sparkSession
    folder = scratch(spark, "toxicity")
    labelled_sample(docs, labels, trains, key, text, label).write.parquet(f"{folder}/sample")
    sample = spark.read.parquet(f"{folder}/sample")
    toxic, other = np.zeros(FOLDS), np.zeros(FOLDS)
    for row in sample.groupBy("fold", "toxic").count().collect():
        (toxic if row["toxic"] else other)[row["fold"]] += row["count"]
    total = toxic.sum() + other.sum()
    share = float(toxic.sum() / total) if total else 0.0
    per = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k{k}") for k in range(2 * FOLDS)]
    counts = _terms(sample).groupBy("term").agg(*per)
    n1 = sum((F.col(f"k{2 * f + 1}") for f in range(FOLDS)), F.lit(0))
    n0 = sum((F.col(f"k{2 * f}") for f in range(FOLDS)), F.lit(0))
    # enough in one pair of folds implies something close to it in all three
    likelier = (n1 + 0.5) * (float(other.sum()) + 1) >= RATIO / 2 * (n0 + 0.5) * (float(toxic.sum()) + 1)
    expected = (n1 + n0) * share
    evidence = 2 * n1 * F.log(n1 / expected) if share else F.lit(0.0)
    found = counts.where((n1 > 0) & likelier & (evidence >= EVIDENCE / 2))
    found = found.orderBy(evidence.desc(), "term").limit(4 * LEXICON).toPandas()
    terms = found["term"].to_numpy().astype(np.int64).view(np.uint64)
    table = found[[f"k{k}" for k in range(2 * FOLDS)]].to_numpy().astype(float).reshape(-1, 2 * FOLDS)
    lexicon = _lexicon(table, terms, toxic, other, None)
    fitted, held = np.array([0, 1]), 2
    if not (toxic[fitted].sum() and other[fitted].sum() and toxic[held] + other[held]):
        return Toxicity(lexicon, None, None, share)
    parts = [
        with_features(sample.where(F.col("fold") == f), _lexicon(table, terms, toxic, other, f)) for f in range(FOLDS)
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rows = rows.select("fold", F.col("toxic").cast("double").alias("label"), "features")
    rows.coalesce(4).write.parquet(f"{folder}/features")
    rows = spark.read.parquet(f"{folder}/features").withColumn("features", array_to_vector("features")).coalesce(4)
    rows = rows.persist()
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=1)
    trees = trees.fit(rows.where(F.col("fold") != held))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score")
    calibration = calibration.fit(_raw(trees, rows.where(F.col("fold") == held)).select("raw", "label"))
    rows.unpersist()
    return Toxicity(lexicon, trees, calibration, share)


def _raw(trees: Model, df: DataFrame) -> DataFrame:
    made = trees.transform(df)
    return made.withColumn("raw", vector_to_array("probability")[1])


def score(docs: DataFrame, model: Toxicity, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row."""
    if model.trees is None or model.calibration is None:
        return docs.withColumn(name, F.lit(model.share))
    # the models add columns of their own, so the row travels in a struct
    boxed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    made = with_features(boxed, model.lexicon).withColumn("features", array_to_vector("features")).drop("text")
    made = model.calibration.transform(_raw(model.trees, made))
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return made.select("row", bounded.alias("_score")).select("row.*", F.col("_score").alias(name))


def held_out(key: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
