import random

import numpy as np
import pyarrow as pa

from helpers import docs, groups, words
from stratalake.llm import minhash


def plain_set(text, width):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def brute(rows, width=4):
    sets = {i: plain_set(t, width) for i, t in rows}
    ids = sorted(sets)
    linked = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), g, g == i) for i, g in groups(ids, linked).items()}, len(linked)


def result(table, **options):
    got = minhash.clusters(table, **options).collect()
    return {r["doc"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}


def edited(rng, base, edits, vocabulary):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return " ".join(out)


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    for common in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            size = 600
            shared = rng.integers(1, 1 << 63, int(size * common), dtype=np.uint64)
            sets = [np.sort(np.concatenate([shared, rng.integers(1, 1 << 63, size - len(shared), dtype=np.uint64)])) for _ in range(2)]
            regs = minhash.registers(np.concatenate(sets), np.array([0, size, 2 * size]))
            exact = len(shared) / (2 * size - len(shared))
            sizes = np.array([size]), np.array([size])
            errors.append(minhash.estimates(regs[:1], regs[1:], *sizes)[0] - exact)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_chance_collisions_are_corrected():
    rng = np.random.default_rng(2)
    matches = []
    for _ in range(60):
        values = [np.sort(rng.integers(1, 1 << 63, 2000, dtype=np.uint64)) for _ in range(2)]
        regs = minhash.registers(np.concatenate(values), np.array([0, 2000, 4000]))
        matches.append((regs[0] == regs[1]).mean())
    expected = minhash.chance_collisions(np.array([2000]), np.array([2000]))[0]
    assert expected / 3 < np.mean(matches) + 1e-4 < expected * 3 + 1e-4


def test_equal_sets_have_equal_registers():
    column = pa.array(["a b c d e", "A  b\tC d E", "x", "", None, "a b c d e f"])
    values, starts = minhash.shingle_sets(column, 4)
    assert np.diff(starts).tolist() == [2, 2, 1, 0, 0, 3]
    regs = minhash.registers(values, starts)
    assert (regs[0] == regs[1]).all() and (regs[0] != regs[5]).any() and (regs[3] == 0).all()


def test_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 60, 200]))]
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows), edited(rng, base, rng.choice([0, 0, 1, 2, 4]), vocabulary)))
    expected, linked = brute(rows)
    assert linked > 20
    assert result(docs(spark, rows)) == expected


def test_large_group_of_unequal_copies(spark):
    # from close copies to copies beyond the threshold, and copies of copies
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(220):
        source = base if i < 100 or rng.random() < 0.5 else rows[rng.randrange(len(rows))][1].split()
        rows.append((i, edited(rng, source, rng.choice([1, 2, 3, 5, 8, 12]), vocabulary)))
    expected, linked = brute(rows)
    assert linked > 1000 and len({g for _, g, _ in expected.values()}) > 20
    assert result(docs(spark, rows)) == expected


def test_rows_of_all_kinds(spark):
    long = " ".join(f"x{i % 977}" for i in range(30000))
    rows = [(9, "same words in here"), (4, "Same words\nin here"), (7, None), (8, ""), (5, " \n\t"), (6, "two words"),
            (None, "same words in here"), (3, long), (2, long + " more"), (6, "two words")]
    table = docs(spark, rows, node="clash", label="clash", bucket="clash")
    got = minhash.clusters(table).collect()
    assert len(got) == len(rows)
    by = {r["doc"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}
    assert by[9] == (1, 4, False) and by[4] == (1, 4, True) and by[None] == (1, 4, False)
    assert by[7] == (0, 7, True) and by[8] == (0, 8, True) and by[5] == (0, 5, True) and by[6] == (1, 6, True)
    assert by[2][1:] == (2, True) and by[3][1:] == (2, False)
    left = minhash.deduplicate(table, width=4)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 5, 6, 6, 7, 8] and left.columns == table.columns
    assert minhash.clusters(table.limit(0)).count() == 0


def test_different_texts_under_one_id_or_none_stay(spark):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(None, texts[0]), (None, texts[1]), (3, texts[2]), (3, texts[3]), (7, texts[0].upper()), (8, texts[3]), (None, None), (3, "")]
    left = minhash.deduplicate(docs(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left) == sorted(
        (str(i), str(t)) for i, t in rows if (i, t) not in ((None, texts[0]), (8, texts[3]))
    )
