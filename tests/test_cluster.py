"""DBSCAN and agglomerative clustering against brute force."""

import math
import os
import random

import numpy as np

import pytest

from casebook.operators import cluster, graph
from casebook.session import ensure_checkpoint_dir


def brute_dbscan(points, eps, min_samples):
    ids = sorted(points)
    nb = {i: [j for j in ids if math.dist(points[i], points[j]) <= eps] for i in ids}
    core = {i for i in ids if len(nb[i]) >= min_samples}
    root = {}
    for i in sorted(core):
        if i in root:
            continue
        stack = [i]
        root[i] = i
        while stack:
            x = stack.pop()
            for y in nb[x]:
                if y in core and y not in root:
                    root[y] = i
                    stack.append(y)
    roots = sorted(set(root.values()))
    num = {r: k for k, r in enumerate(roots)}
    label = {}
    for i in ids:
        if i in core:
            label[i] = num[root[i]]
        else:
            cands = [num[root[j]] for j in nb[i] if j in core]
            label[i] = min(cands) if cands else -1
    return label, core


@pytest.mark.parametrize("seed", [1, 2])
def test_dbscan_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    pts = {}
    for i in range(300):
        cx, cy = rnd.choice([(0.2, 0.2), (0.7, 0.3), (0.5, 0.8)])
        pts[i] = (cx + rnd.gauss(0, 0.05), cy + rnd.gauss(0, 0.05)) if i % 5 else (rnd.random(), rnd.random())
    expected, core = brute_dbscan(pts, 0.04, 5)
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in pts.items()], "id long, x double, y double")
    for parts in (1, 6):
        rows = cluster.dbscan(df.repartition(parts), "id", ["x", "y"], eps=0.04, min_samples=5).collect()
        assert {r["id"]: r["cluster"] for r in rows} == expected
        assert {r["id"] for r in rows if r["is_core"]} == core


@pytest.mark.parametrize("d, eps, n", [(5, 0.12, 400)])
def test_dbscan_in_many_dimensions(spark, d, eps, n):
    rnd = random.Random(d)
    centres = [[rnd.random() for _ in range(d)] for _ in range(3)]
    pts = {}
    for i in range(n):
        if i < 60:  # a crowded cell beside others, with equal points
            pts[i] = tuple(c + rnd.choice([0.0, 0.01]) for c in centres[0])
        elif i % 6:
            pts[i] = tuple(c + rnd.gauss(0, 0.03) for c in rnd.choice(centres))
        else:
            pts[i] = tuple(rnd.uniform(-1, 1) for _ in range(d))
    expected, core = brute_dbscan(pts, eps, 6)
    assert len(set(expected.values())) > 2
    cols = [f"x{k}" for k in range(d)]
    df = spark.createDataFrame([(i, *x) for i, x in pts.items()], "id long, " + ", ".join(f"{c} double" for c in cols))
    rows = cluster.dbscan(df, "id", cols, eps=eps, min_samples=6).collect()
    assert {r["id"]: r["cluster"] for r in rows} == expected
    assert {r["id"] for r in rows if r["is_core"]} == core


def test_nothing_is_left_behind(spark):
    """Operators that iterate leave one table a result and no cache."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")

    def left():
        return len([f for f in os.listdir(folder) if f.startswith("casebook-")])

    rnd = random.Random(6)
    df = spark.createDataFrame([(i, rnd.random(), rnd.random()) for i in range(120)], "id long, x double, y double")
    edges = spark.createDataFrame([(i, j) for i in range(5) for j in range(i)], "a long, b long")
    for results, run in ((1, lambda: cluster.dbscan(df, "id", ["x", "y"], eps=0.1, min_samples=3)),
                         (2, lambda: cluster.agglomerative_grid(df, "id", ["x", "y"], k=3, cell=0.3)),
                         (1, lambda: graph.simple_cycles(edges, "a", "b", max_len=4))):
        tables, caches = left(), spark.sparkContext._jsc.getPersistentRDDs().size()
        out = run()
        assert left() == tables + results
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == caches
        for frame in out if isinstance(out, tuple) else [out]:
            assert frame.count() > 0
    tables = left()
    with pytest.raises(Exception, match="no_such"):
        cluster.dbscan(df, "id", ["x", "no_such"], eps=0.1, min_samples=3)
    assert left() == tables


def test_neighbours_are_looked_up_among_occupied_cells(spark):
    rnd = random.Random(3)
    cells = sorted({tuple(rnd.randrange(-4, 5) for _ in range(6)) for _ in range(500)})
    df = spark.createDataFrame([(list(c),) for c in cells], "cell array<bigint>")
    got = {(tuple(r["cell"]), tuple(r["ncell"])) for r in cluster._beside(df.union(df), 6).collect()}
    near = {(a, b) for a in cells for b in cells if a != b and
            sum(max(abs(x - y) - 1, 0) ** 2 for x, y in zip(a, b)) <= 6}
    assert got == near
    assert cluster._beside(df.limit(0), 6).isEmpty()


def brute_average_linkage(points, k):
    clusters = {i: [i] for i in points}
    def d(a, b):
        return sum(sum(abs(x - y) for x, y in zip(points[i], points[j]))
                   for i in clusters[a] for j in clusters[b]) / (len(clusters[a]) * len(clusters[b]))
    while len(clusters) > k:
        keys = sorted(clusters)
        best = min(((d(a, b), a, b) for ai, a in enumerate(keys) for b in keys[ai + 1:]))
        _, a, b = best
        clusters[a] += clusters.pop(b)
    return sorted(sorted(m) for m in clusters.values())


def test_average_linkage_matches_greedy():
    rnd = random.Random(5)
    pts = {i: (rnd.random(), rnd.random()) for i in range(30)}
    labels, merges = cluster.average_linkage(np.array(list(pts.values())), np.ones(30), 4)
    groups = {}
    for i, c in enumerate(labels):
        groups.setdefault(c, []).append(i)
    assert sorted(sorted(m) for m in groups.values()) == brute_average_linkage(pts, 4)
    assert len(merges) == 29 and [h for _, _, h in merges] == sorted(h for _, _, h in merges)


def test_average_linkage_weighs_centres():
    """A centre of weight 2 counts as two points on one spot."""
    spots = np.array([[0.0], [1.0], [2.1], [4.0], [7.0]])
    heavy = cluster.average_linkage(spots, np.array([1, 2, 1, 1, 1]), 2)[1]
    twice = cluster.average_linkage(spots[[0, 1, 1, 2, 3, 4]], np.ones(6), 2)[1]
    assert [h for _, _, h in heavy] == [h for _, _, h in twice][1:] and twice[0][2] == 0.0


def test_agglomerative_finds_separated_groups(spark):
    rnd = random.Random(5)
    pts = {f"p{i}": (10.0 * (i % 4) + rnd.random(), 5.0 * (i % 2) + rnd.random()) for i in range(400)}
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in pts.items()], "id string, x double, y double")
    labels, _ = cluster.agglomerative(df, "id", ["x", "y"], k=4, m=20)
    groups = {}
    for r in labels.collect():
        groups.setdefault(r["cluster"], set()).add(int(r["id"][1:]) % 4)
    assert sorted(map(sorted, groups.values())) == [[0], [1], [2], [3]]
    assert labels.count() == 400


def test_kmeans_cost_non_increasing(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, rnd.random(), rnd.random()) for i in range(200)], "id long, x double, y double")
    costs = [cluster.kmeans(df, ["x", "y"], k=k, seed=22)[1].summary.trainingCost for k in (2, 4, 8)]
    assert costs[0] >= costs[1] >= costs[2]


def test_profile(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "c int, v double")
    got = {r["c"]: (r["size"], r["mean_v"]) for r in cluster.profile(df, "c", ["v"]).collect()}
    assert got == {0: (2, 2.0), 1: (1, 5.0)}


def test_dbscan_hot_spot_refinement(spark):
    """A third of all points on one spot plus crowded neighbours: the
    bounding-box refinement (forced with a tiny brute_limit) stays exact."""
    rnd = random.Random(11)
    pts = {}
    for i in range(120):
        pts[i] = (0.5, 0.5)
    for i in range(120, 360):
        pts[i] = (0.5 + rnd.uniform(-0.12, 0.12), 0.5 + rnd.uniform(-0.12, 0.12))
    expected, core = brute_dbscan(pts, 0.03, 4)
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in pts.items()], "id long, x double, y double")
    rows = cluster.dbscan(df, "id", ["x", "y"], eps=0.03, min_samples=4, brute_limit=4).collect()
    assert {r["id"]: r["cluster"] for r in rows} == expected
    assert {r["id"] for r in rows if r["is_core"]} == core


def greedy_linkage(cells, k):
    """Average linkage one merge at a time: cells are (n, centre); names are the smallest members."""
    members, height = {i: [i] for i in range(len(cells))}, []

    def gap(a, b):
        w = [(cells[i][0] * cells[j][0], sum(abs(p - q) for p, q in zip(cells[i][1], cells[j][1]))) for i in a for j in b]
        return round(sum(x * d for x, d in w) / sum(x for x, _ in w), 9)
    at = None
    while True:
        if len(members) == k:
            at = {i: name for name, own in members.items() for i in own}
        if len(members) == 1:
            break
        h, a, b = min((gap(members[a], members[b]), a, b) for a in members for b in members if a < b)
        height.append(h)
        members[a] = members[a] + members.pop(b)
    names = sorted(set(at.values())) if at else []
    return {i: names.index(n) for i, n in (at or {}).items()}, height


@pytest.mark.parametrize("seed", [1, 2])
def test_linkage_rounds_equal_greedy_merges(spark, seed):
    rnd = random.Random(seed)
    cells = [(rnd.randint(1, 50), [rnd.random(), rnd.random() * 3]) for _ in range(24)]
    micro = spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(cells)], "micro long, n long, centre array<double>")
    merges = cluster.linkage(micro)
    rows = merges.collect()
    for k in (4, 24):
        want, heights = greedy_linkage(cells, k)
        assert {r["micro"]: r["cluster"] for r in cluster.cut(micro, merges, k).collect()} == want
    assert sorted(r["height"] for r in rows) == pytest.approx(sorted(heights)) and max(r["round"] for r in rows) < 23


def test_agglomerative_grid_labels_every_point(spark):
    rnd = random.Random(6)
    pts = [(f"p{i}", 10.0 * (i % 4) + rnd.random(), 5.0 * (i % 2) + rnd.random()) for i in range(300)] + \
        [(f"hot{i}", 0.5, 0.5) for i in range(150)] + [("none", None, 1.0)]
    df = spark.createDataFrame(pts, "id string, x double, y double")
    for parts in (2, 9):
        labels, merges = cluster.agglomerative_grid(df.repartition(parts), "id", ["x", "y"], k=4, cell=0.5)
        got = {r["id"]: r["cluster"] for r in labels.collect()}
        assert len(got) == 450 and {got[f"hot{i}"] for i in range(150)} == {got["p0"]}
        assert all(got[f"p{i}"] == got[f"p{i % 4}"] for i in range(300)) and len(set(got.values())) == 4
    one = cluster.agglomerative_grid(df.limit(1), "id", ["x", "y"], k=4, cell=0.5)
    assert [tuple(r) for r in one[0].collect()] == [("p0", 0)] and one[1].count() == 0
    assert cluster.agglomerative_grid(df.filter("id = 'none'"), "id", ["x", "y"], k=4, cell=0.5)[0].count() == 0
