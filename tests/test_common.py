"""Ordered index and connected components against plain Python."""

import random

from pyspark.sql import functions as F

from casebook.operators.common import connected_components, ordered_index


def test_ordered_index_is_gap_free(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    rows = ordered_index(df, ["k"], name="i").collect()
    pairs = sorted((r["i"], r["k"]) for r in rows)
    assert [p[0] for p in pairs] == list(range(1, 5001))
    assert [p[1] for p in pairs] == sorted(p[1] for p in pairs)


def test_connected_components_random(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    members = {}
    for v in range(200):
        members.setdefault(find(v), []).append(v)
    expected = {v: min(m) for m in members.values() for v in m}
    e = spark.createDataFrame(edges, "src long, dst long")
    verts = spark.range(200)
    got = {r["id"]: r["component"] for r in connected_components(e, verts).collect()}
    assert got == expected
