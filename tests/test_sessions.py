import random

from pyspark.sql import functions as F

from stratalake.operators import folds, sessions

SAMPLES = [
    "nao entendi", "e no Spark?", "o que e data warehouse?", "explica melhor", "", "  ", "???", "ok", "OK", "and then what happened next",
    "também quero saber mais sobre isso aqui", "data warehouse and lakes for large teams of people", "x" * 600, "data warehouse", "E " + "y" * 300,
]


def weak(message):
    text = message.strip().lower()
    words = text.replace("?", " ").split()
    if not words:
        return False
    if any(text.startswith(o) for o in ("e ", "and ", "também ", "tambem ")):
        return True
    return not ("?" in text and len(words) >= 4) and len(words) <= 4


def plain_fold(messages):
    out, prior = [], ""
    for message in messages:
        now = message.strip()
        prior = prior.strip()
        if not now:
            out.append(("", False))
            continue
        if prior and weak(now):
            if prior.lower() in now.lower():
                bound, mark = now, now.lower() != prior.lower()
            else:
                bound, mark = f"{prior}. {now}"[:500], True
        else:
            bound, mark = now, False
        out.append((bound, mark))
        prior = bound
    return out


def test_underspecified(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    assert [r.o for r in df.select(sessions.underspecified(F.col("s")).alias("o")).collect()] == [weak(s) for s in SAMPLES]


def test_followups_against_loop(spark):
    rng = random.Random(8)
    talks = {c: [rng.choice(SAMPLES) for _ in range(rng.randint(1, 15))] for c in range(30)}
    # One conversation holds a large share of all turns, another never names a topic.
    talks[99] = [rng.choice(SAMPLES) for _ in range(300)]
    talks[100] = ["ok", "explica melhor", "e no Spark?"] * 20
    rows = [(c, t, m) for c, ms in talks.items() for t, m in enumerate(ms)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv long, turn long, text string").repartition(4)
    expected = {(c, t): o for c, ms in talks.items() for t, o in enumerate(plain_fold(ms))}
    for made in (sessions.bind_followups(df, "conv", "turn", "text"), in_ranges(spark, 13, lambda: sessions.bind_followups(df, "conv", "turn", "text"))):
        got = made.collect()
        assert {(r.conv, r.turn): (r.bound_query, r.followup) for r in got} == expected
        assert len(got) == len(rows)


def in_ranges(spark, number, make):
    """What ``make`` builds while rows are dealt out into so many ranges."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", number)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return make()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_one_run_spans_all_ranges(spark, monkeypatch):
    """A run of short messages with sparse turn numbers, in which long ones that repeat the topic change it."""
    rng = random.Random(18)
    said = ["what is a data warehouse and what is it good for"] + [rng.choice(["ok", "and then?", "explica melhor", ""]) for _ in range(900)]
    topic = ""
    for i in range(len(said)):
        if i in (300, 301, 640):
            said[i] = "and " + topic + " once more, please, at length"
        topic = plain_fold(said[: i + 1])[-1][0] or topic if i in (299, 300, 639) else topic
    rows = [(1, t**3, m) for t, m in enumerate(said)] + [(None, 5, "ok"), (None, 9, "ok"), (2, 1, "explica melhor")]
    df = spark.createDataFrame(rows, "conv long, turn long, text string").repartition(5)
    expected = {(1, t**3): o for t, o in enumerate(plain_fold(said))}
    expected |= {(None, 5): ("ok", False), (None, 9): ("ok", False), (2, 1): ("explica melhor", False)}
    rounds = []
    real = folds._exits
    monkeypatch.setattr(folds, "_exits", lambda rows, entries, *rest: rounds.append(sorted(entries)) or real(rows, entries, *rest))
    got = in_ranges(spark, 16, lambda: sessions.bind_followups(df, "conv", "turn", "text")).collect()
    assert {(r.conv, r.turn): (r.bound_query, r.followup) for r in got} == expected
    # many ranges hold the run, few rounds settle them, each with fewer of them
    assert len(rounds[0]) > 10 and len(rounds) <= 7 and len(rounds[-1]) < len(rounds[0])


def plain_likes(likes):
    held = []
    for like in likes:
        if like not in held:
            held = (held + [like])[-8:]
    return held


def test_likes_against_loop(spark):
    rng = random.Random(9)
    rows = []
    for user in range(40):
        kinds = rng.choice([1, 5, 8, 9, 12, 40, 400])
        for _ in range(rng.choice([1, 10, 60, 200])):
            rows.append((user, len(rows), f"k{rng.randint(1, kinds)}"))
    # A hot user cycling through few likes, which only the full fold can settle.
    rows += [(77, 10_000 + i, f"z{(i * i) % 11}") for i in range(1500)]
    df = spark.createDataFrame(rows, "u int, o long, l string").repartition(4)
    expected = {u: plain_likes([r[2] for r in sorted(rows, key=lambda r: r[1]) if r[0] == u]) for u in {r[0] for r in rows}}
    for made in (sessions.recent_likes(df, "u", "o", "l"), in_ranges(spark, 11, lambda: sessions.recent_likes(df, "u", "o", "l"))):
        got = made.collect()
        assert len(got) == len(expected) and {r.u: r.likes for r in got} == expected


def test_histories_that_never_settle(spark, monkeypatch):
    """Likes that cycle through nine and more values; where guesses do not help, one stream settles the rest."""
    rng = random.Random(19)
    cycles = [f"c{i % 9}" for i in range(700)] + [f"d{rng.randrange(10)}" for _ in range(700)]
    rows = [(1, i, like) for i, like in enumerate(cycles)] + [(2, i, f"e{i % 12}") for i in range(400)] + [(0, 5, "only")]
    df = spark.createDataFrame(rows, "u int, o long, l string").repartition(4)
    expected = {u: plain_likes([r[2] for r in rows if r[0] == u]) for u in (0, 1, 2)}
    for limit in (0, 1, 2, folds.ROUNDS):
        real = folds.entry_states
        with monkeypatch.context() as m:
            m.setattr(folds, "entry_states", lambda *a, limit=limit, **k: real(*a, rounds=limit, **k))
            made = in_ranges(spark, 14, lambda: sessions.recent_likes(df, "u", "o", "l"))
        assert {r.u: r.likes for r in made.collect()} == expected


def test_profiles(spark):
    rows = [
        (1, 1, " gostei, bem objetiva ", True, "short", "warm"),
        (1, 2, "", True, "huge", ""),
        (1, 3, "nao gostei", False, "long", "cold"),
        (2, 1, "nao", False, None, None),
        (3, 5, "a" * 200, True, None, None),
    ]
    df = spark.createDataFrame(rows, "u int, o int, c string, p boolean, length string, tone string")
    got = {r.u: r for r in sessions.style_block(sessions.preference_profiles(df, "u", "o", "c", "p", ("length", "tone"))).collect()}
    assert set(got) == {1, 3}
    assert (got[1].positive_count, got[1].updated_at, got[1].length, got[1].tone, got[1].likes) == (2, 2, "short", "warm", ["gostei, bem objetiva"])
    assert (got[3].length, got[3].tone, got[3].likes) == ("medium", "practical", ["a" * 160])
    assert got[1].style_block.split("\n") == [
        "User style (from positive feedback — follow this):", "- length: short", "- tone: warm", "- always cite pages", "- gostei, bem objetiva",
    ]


def test_last_turn_and_traces(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b" * 900), (2, 1, None)], "c int, t int, x string")
    got = {r.c: r for r in sessions.last_turns(df, "c", "t", "x").collect()}
    assert (got[1].t, got[1].snippet, got[2].snippet) == (2, "b" * 800, "")
    traced = sessions.trace_rows(df, ["ask"], F.lit("ask.v1"), F.col("x"), tokens_in=F.length("x"), tokens_out=F.lit(None).cast("int"), elapsed_ms=F.col("t"))
    row = sessions.trace_summary(traced).first()
    assert (row.prompt_id, row.calls, row.tokens_in, row.tokens_out, row.max_elapsed_ms) == ("ask.v1", 3, 901, 0, 2)
