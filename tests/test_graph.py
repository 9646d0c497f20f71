"""Accident graph: golden fixtures, brute-force cycles, partition invariance."""

import itertools
import random

from casebook.operators import graph


def pairs_df(spark, pairs):
    return spark.createDataFrame(pairs, "a string, b string")


def test_degrees_golden(spark):
    p = pairs_df(spark, [("A", "B"), ("B", "C"), ("C", "A"), ("C", "D")])
    got = {r["person"]: r["accidents"] for r in graph.degrees(p, "a", "b").collect()}
    assert got == {"A": 2, "B": 2, "C": 3, "D": 1}
    assert graph.suspicious(p, "a", "b", threshold=3).count() == 0
    # degree sum = 2 * pairs
    assert sum(got.values()) == 8


def test_repeat_edges_golden(spark):
    p = pairs_df(spark, [("A", "B"), ("B", "C"), ("C", "A"), ("C", "D")])
    got = {(r["src"], r["dst"]) for r in graph.repeat_edges(p, "a", "b").collect()}
    assert got == {("A", "B"), ("A", "C"), ("B", "A"), ("B", "C"), ("C", "B"), ("C", "A"), ("C", "D")}


def test_cycles_triangle_with_pendant(spark):
    p = pairs_df(spark, [("A", "B"), ("B", "C"), ("C", "A"), ("C", "D")])
    rows = graph.simple_cycles(p, "a", "b", max_len=6).collect()
    assert [(r["group"], r["members"]) for r in rows] == [(1, "A, B, C")]


def test_two_accidents_one_pair_is_no_cycle(spark):
    p = pairs_df(spark, [("A", "B"), ("A", "B")])
    assert graph.simple_cycles(p, "a", "b", max_len=5).count() == 0


def test_complete_graph_k4(spark):
    p = pairs_df(spark, [(x, y) for x, y in itertools.combinations("ABCD", 2)])
    got = sorted(r["members"] for r in graph.simple_cycles(p, "a", "b", max_len=4).collect())
    assert got == ["A, B, C", "A, B, C, D", "A, B, D", "A, C, D", "B, C, D"]


def brute_cycles(edges, max_len):
    adj = {}
    for u, v in edges:
        if u == v:
            continue
        adj.setdefault(u, set()).add(v)
        adj.setdefault(v, set()).add(u)
    found = set()

    def walk(path):
        if len(path) >= 3 and path[0] in adj[path[-1]]:
            found.add(", ".join(sorted(str(x) for x in path)))
        if len(path) == max_len:
            return
        for n in adj[path[-1]]:
            if n > path[0] and n not in path:
                walk(path + [n])
    for s in adj:
        walk([s])
    return found


def test_cycles_match_brute_force_and_partitioning(spark):
    rnd = random.Random(7)
    edges = [(rnd.randrange(30), rnd.randrange(30)) for _ in range(70)]
    expected = brute_cycles(edges, 5)
    df = spark.createDataFrame(edges, "a long, b long")
    for parts in (1, 4, 16):
        got = {r["members"] for r in graph.simple_cycles(df.repartition(parts), "a", "b", max_len=5).collect()}
        assert got == expected
    rows = graph.simple_cycles(df, "a", "b", max_len=5).collect()
    assert [r["group"] for r in rows] == list(range(1, len(rows) + 1)) or \
        sorted(r["group"] for r in rows) == list(range(1, len(rows) + 1))


def test_cycles_with_hub_vertex(spark):
    """One person in a third of all accidents: degree ranking keeps it a
    path start only; the result still equals brute force."""
    edges = [("H", f"v{i:02d}") for i in range(30)]
    edges += [(f"v{i:02d}", f"v{(i + 1) % 30:02d}") for i in range(30)]
    edges += [("H", "v03"), ("v05", "v17"), ("x", "y")]
    expected = brute_cycles(edges, 4)
    df = spark.createDataFrame(edges, "a string, b string")
    got = {r["members"] for r in graph.simple_cycles(df, "a", "b", max_len=4).collect()}
    assert got == expected and len(got) > 30


def test_cycle_halves_travel_as_numbers(spark, monkeypatch):
    """Paths hold rank numbers only, and the longest halves, the most by far, are not written as a table."""
    edges = [(f"person {a}", f"person {b}") for a, b in itertools.combinations(range(7), 2)]
    df = spark.createDataFrame(edges, "a string, b string")
    written = []

    def cut(frame):
        written.append(frame.dtypes)
        return frame.localCheckpoint()

    monkeypatch.setattr(graph, "cut_lineage", cut)
    for max_len, tables in ((4, 0), (6, 1)):
        written.clear()
        got = [r["members"] for r in graph.simple_cycles(df, "a", "b", max_len=max_len).collect()]
        assert len(got) == len(set(got)) and set(got) == brute_cycles(edges, max_len)
        halves = [kinds for kinds in written if {"s", "end"} <= {name for name, _ in kinds}]
        assert len(halves) == tables and all(kind == "bigint" for kinds in halves for _, kind in kinds)
