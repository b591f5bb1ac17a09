import random

import pytest

from helpers import groups
from stratalake.llm.components import components


@pytest.mark.parametrize("small", [0, 10**6])
def test_against_a_plain_union(spark, small):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1200)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    table = spark.createDataFrame([*edges, *edges[:5], (None, 1), (7, None)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(table, small=small).collect()}
    assert got == groups(sorted({x for e in edges for x in e}), edges)
    assert components(table.limit(0), small=small).count() == 0
