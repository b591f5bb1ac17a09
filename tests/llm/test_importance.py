import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratalake.llm import importance

from helpers import docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = WORD.findall(low)
    return ws, [zlib.crc32(f.encode()) % 10_000 for f in [*ws, *(f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False))]]


def plain(rows, target):
    found = {i: features(t) for i, t in rows}
    s, t = Counter(b for _, bs in found.values() for b in bs), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)}
    out = {}
    for i, (ws, bs) in found.items():
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ws)]
    able = sorted((i for i in out if out[i][4] >= 20), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(able[: 25 * len(able) // 100], 1):
        out[i][3] = rank
    return {(i, *v[:4]) for i, v in out.items()}


def test_spans_of_any_length_have_their_crc():
    rng = random.Random(3)
    data = np.frombuffer(rng.randbytes(400_000), np.uint8)
    reach = importance.REACH
    sizes = [1, 2, reach - 1, reach, reach + 1, 2 * reach, 2 * reach + 1, 3 * reach, 7 * reach + 5, 65_536, 300_001]
    sizes += [rng.randrange(1, 600) for _ in range(400)]
    starts = np.array([rng.randrange(len(data) - n) for n in sizes])
    ends = starts + np.array(sizes)
    expected = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert importance.span_crcs(data, starts, ends).tolist() == expected


def test_many_spans_are_cut_into_parts(monkeypatch):
    monkeypatch.setattr(importance, "SPAN_BYTES", 300)
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    starts = np.arange(0, 4000, 3)
    ends = starts + 1 + np.arange(len(starts)) % 700
    got = importance.span_crcs(data, starts, ends).tolist()
    assert got == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


@pytest.mark.parametrize(
    "texts",
    [
        ["One two, THREE", None, "", "é日本 x", "---", "a", "b"],
        [""],
        [None, None],
        ["x" * 100_000 + " y", "日本語" * 50_000, "word " * 3],
        ["a\x00b\x7fc", "end.", ".start", "a b"],
    ],
)
def test_features_match_the_rule(texts):
    got, before, words = importance.feature_buckets(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        ws, expected = features(text)
        assert sorted(got[before[i] : before[i + 1]].tolist()) == sorted(expected)
        assert words[i] == len(ws)


def small(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(f"W{rng.randrange(40)}é" for _ in range(rng.choice([3, 19, 20, 60])))) for i in range(n)]


def drawn(spark, frame, target):
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    gains = importance.bucket_gains(importance.bucket_counts(frame), importance.bucket_counts(bench))
    made = importance.draw(importance.with_scores(importance.weigh(frame, gains)))
    return {(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in made.collect()}


def test_draw_matches_a_plain_version(spark):
    rows = [*small(4, 400), (1000, None), (1001, ""), (1002, "日本 " * 30)]
    target = ["w1é w2é w3é w1é w2é", None, "", "w5é w6é"]
    clashing = docs(spark, rows, score="x", rank="y", weight="z", n_words="n", _row="r").repartition(5)
    assert drawn(spark, clashing, target) == plain(rows, target)


def test_empty_targets_few_rows_and_empty_tables(spark):
    rows = small(5, 3)
    assert drawn(spark, docs(spark, rows), []) == plain(rows, [])
    assert drawn(spark, docs(spark, []), ["a b"]) == set()
    with_one = importance.resample(docs(spark, rows), spark.createDataFrame([("w1é",)], "text string"))
    assert with_one.count() == 0


def test_repeated_and_missing_ids_keep_their_rows(spark):
    rows = [(i % 5 if i % 5 else None, "same words " * 12) for i in range(40)]
    made = importance.resample(docs(spark, rows), spark.createDataFrame([("same",)], "text string")).collect()
    assert sorted(r["rank"] for r in made) == list(range(1, 11))
    scores = [r["score"] for r in sorted(made, key=lambda r: r["rank"])]
    assert scores == sorted(scores, reverse=True)
