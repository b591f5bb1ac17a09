import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stratalake.llm import turntrie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(rows):
    """Turns of every conversation as (role, text), repeated turn numbers by digest."""

    def digest(turn):
        role, text = turn
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            own[conv].append(((turn is not None, turn or 0, digest(said)), said))
    return {c: [said for _, said in sorted(turns)] for c, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        todo = [node]
        while todo:
            now = todo.pop()
            yield now
            todo += kids[now]

    rows = []
    for node in members:
        under = list(below(node))
        rows.append(
            (
                members[node][0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(members[node]),
                len(kids[node]),
                sum(not kids[x] for x in under),
                sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x),
                hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def collected(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def random_rows(seed, convs):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1000), convs):
        for t in range(rng.choice([1, 1, 2, 3, 7, 12])):
            turn = rng.choice([t, t, t, None, 0])
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["a", "bé", "😀c", "", None])))
    return rows


@pytest.mark.parametrize(("seed", "convs", "size"), [(1, 300, 7), (2, 300, 60), (3, 300, 10**6), (4, 1, 5)])
def test_any_shards_give_the_trie_of_all_rebuilt_conversations(spark, seed, convs, size):
    rows = random_rows(seed, convs)
    made = turntrie.nodes(turntrie.rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(3)), size)
    assert collected(made) == plain_trie(rebuilt(sequences(rows)))


def test_copies_that_span_shards_are_one_node_with_one_digest(spark):
    rows = [(c, t, "user", f"x{t}") for c in range(900) for t in range(3)] + [(901, 0, "user", "x0"), (902, 0, "user", "y")]
    plain = plain_trie(sequences(rows))
    made = turntrie.nodes(turntrie.sequences(spark.createDataFrame(rows, SCHEMA)), 150)
    assert collected(made) == plain
    assert max(r[3] for r in plain) == 902


def test_long_conversations_and_texts(spark):
    rows = [(c, t, "user", f"{t % 5}") for c in (1, 2) for t in range(3000)] + [(3, 0, "user", "0" * 300_000)]
    made = turntrie.nodes(turntrie.sequences(spark.createDataFrame(rows, SCHEMA)), 2000)
    top = made.where("depth = 0").collect()[0]
    assert made.count() == 3002
    assert (top["n_convs"], top["n_children"], top["n_leaves"], top["saved_tokens"]) == (3, 2, 2, 3000)


def test_empty_tables_missing_ids_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turntrie.nodes(turntrie.rebuilt(empty)).count() == 0
    rows = [(None, 0, "user", "lost"), (7, None, None, None)]
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS path", "1 AS shard", "'k' AS node_key", "2 AS base")
    made = turntrie.nodes(turntrie.rebuilt(more))
    assert collected(made) == plain_trie(rebuilt(sequences(rows)))


def test_conversations_without_turns_end_at_the_root(spark):
    # ids whose share is larger than what they have, in a family without a first member
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1][:5]
    rows = [(c, 0, "user", "only") for c in ids]
    made = collected(turntrie.nodes(turntrie.rebuilt(spark.createDataFrame(rows, SCHEMA)), 2))
    assert made == plain_trie(rebuilt(sequences(rows)))
    assert made[0][1] == 0 and made[0][4] == 0 and made[0][5] == 1


def test_the_tree_is_balanced():
    tree = turntrie.SearchTree()
    for k in turntrie._medians(1023):
        tree.insert([k], [1])
    deep, todo = 0, [(tree.below[0], 1)]
    while todo:
        node, d = todo.pop()
        if node >= 0:
            deep = max(deep, d)
            todo += [(tree.low[node], d + 1), (tree.high[node], d + 1)]
    assert deep == 10
