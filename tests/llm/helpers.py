"""Small tables and plain versions for the tests of this folder."""

import re

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def docs(spark, rows, **more):
    """Documents from (id, text) pairs; ``more`` adds text columns of one value, names that clash on purpose."""
    out = spark.createDataFrame(rows, DOCS)
    for name, value in more.items():
        out = out.selectExpr("*", f"'{value}' AS {name}")
    return out


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SPACES.split(low) if w]


def groups(items, linked):
    """Least member reachable, for every item, by a plain union of the linked pairs."""
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}
