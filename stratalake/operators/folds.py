"""Ordered folds over groups of any size, in parallel.

Rows are dealt out by ranges of (group, order), so a group that owns a third of all rows lies in a third of the ranges,
whatever its order values look like. Every range is folded on its own. Only the first group of a range may have
begun in an earlier one; the state it enters with is guessed, and a range whose guess proves wrong is folded again. A
guess is proved by the range before it, so after every round at least one more range of each long group is settled,
and none is wrong at the end. Folds that forget where they started settle in two or three rounds. What is still open
after ``ROUNDS`` rounds is settled by one sorted stream over the open ranges, which keeps a single state.

One state per range is kept on the driver, never rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratalake.session import scratch

ROUNDS = 12
RANGE = "_range"

State = Any
Step = Callable[..., State]


def ranges(df: DataFrame, group: str, order: str) -> DataFrame:
    """``df`` stored by ranges of (group, order), with the number of each row's range."""
    path = scratch(df.sparkSession, "ranges")
    df.repartitionByRange(group, order).withColumn(RANGE, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(path)


def in_order(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Whole ranges in tasks, their rows sorted."""
    return rows.repartition(RANGE).sortWithinPartitions(RANGE, group, order)


def same(key: Any) -> Any:
    """A group's key as something that equals itself; null and NaN are one key."""
    return None if pd.isna(key) else key


def _exits(rows: DataFrame, entries: dict[int, State], group: str, order: str, columns: Sequence[str], start: State, step: Step, through: bool) -> dict[int, State]:
    """The state at the end of every range in ``entries``; ``through`` carries it on from range to range in one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, key, state = None, None, start
        for frame in frames:
            done = []
            for here, now, *values in zip(frame[RANGE], frame[group], *[frame[c] for c in columns]):
                now = same(now)
                if here != place:
                    if place is not None:
                        done.append((place, json.dumps(state)))
                    if not through or place is None or here in entries and entries[here] is not None:
                        state = entries[here]
                    elif now != key:
                        state = start
                    place = here
                elif now != key:
                    state = start
                key = now
                state = step(state, *values)
            yield pd.DataFrame(done, columns=[RANGE, "state"])
        if place is not None:
            yield pd.DataFrame([(place, json.dumps(state))], columns=[RANGE, "state"])

    chosen = rows.where(F.col(RANGE).isin(sorted(entries))).select(RANGE, group, order, *[c for c in columns if c not in (group, order)])
    sent = chosen.repartition(1).sortWithinPartitions(RANGE, group, order) if through else in_order(chosen, group, order)
    return {r[RANGE]: json.loads(r["state"]) for r in sent.mapInPandas(run, f"{RANGE} int, state string").collect()}


def entry_states(
    rows: DataFrame, group: str, order: str, columns: Sequence[str], start: State, step: Step,
    steady: bool = False, rounds: int = ROUNDS,
) -> tuple[dict[int, State], set[int]]:
    """The state every range of ``ranges`` enters with, and the ranges whose last group goes on in the next one.

    ``step(state, *values)`` returns a new state, which JSON can hold. A ``steady`` fold's state mostly stays what it
    is, so a range is guessed to leave as it entered; otherwise what it left with under the last guess counts.
    """
    ends = rows.groupBy(RANGE).agg(F.min(F.struct(group)).alias("low"), F.max(F.struct(group)).alias("high"))
    before = Window.orderBy(RANGE)  # one row per range
    met = ends.select(
        RANGE,
        (F.lag("high").over(before).isNotNull() & F.lag("high").over(before).eqNullSafe(F.col("low"))).alias("goes_on"),
        F.col("low").eqNullSafe(F.col("high")).alias("single"),
    )
    known = sorted(met.collect(), key=lambda r: r[RANGE])
    places = [r[RANGE] for r in known]
    previous = {r[RANGE]: places[i - 1] for i, r in enumerate(known) if r["goes_on"]}
    single = {r[RANGE]: r["single"] for r in known}
    open_ended = set(previous.values())
    entries: dict[int, State] = {p: start for p in places}
    exits: dict[int, State] = {}
    todo = open_ended
    number = 0
    while todo:
        if number < rounds:
            exits |= _exits(rows, {p: entries[p] for p in todo}, group, order, columns, start, step, False)
        else:
            # the first open range of a group has its right state; the others follow it
            first = {p: entries[p] if previous.get(p) not in todo else None for p in todo}
            exits |= _exits(rows, first, group, order, columns, start, step, True)
        number += 1
        changed: set[int] = set()
        for place in places:
            if place not in previous:
                continue
            last = previous[place]
            guess = entries[last] if steady and last in changed else exits[last]
            if guess != entries[place]:
                entries[place] = guess
                if single[place]:  # what a range of several groups leaves with does not depend on its entry
                    changed.add(place)
        todo = changed & open_ended
    return entries, open_ended
