"""Accident graph: participants as vertices, accidents as edges.

* degrees / suspicious persons: endpoints exploded from one pass over the
  pairs, one hash aggregate (a person in a third of all accidents is
  pre-combined map-side);
* repeat-accident edges: edge multiplicities, then a semi-join with the
  persons in at least two accidents;
* simple cycles: a round of leaf peeling, then a meet-in-the-middle path
  join. Each cycle is built exactly once from its highest-ranked vertex
  (rank = degree, then id) and one orientation, from two half paths that
  meet at the opposite vertex, so the work is the half-path count plus the
  output, not every full path, and hubs never sit inside quadratic path sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators.common import ordered_index
from casebook.session import cut_lineage, settled


def endpoints(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Every participant occurrence (person); null participants are not
    vertices. One pass over the pairs (explode, not a union of two scans)."""
    return (pairs.select(F.explode(F.array(F.col(a), F.col(b))).alias("person"))
            .filter(F.col("person").isNotNull()))


def edges_from_adjacency(adj: DataFrame, vertex: str, neighbours: str) -> DataFrame:
    """Adjacency lists (vertex, array of neighbours) -> directed edge rows."""
    return adj.select(F.col(vertex).alias("src"), F.explode(neighbours).alias("dst"))


def degrees(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Accidents per person in the multigraph (a self-pair counts twice)."""
    return endpoints(pairs, a, b).groupBy("person").agg(F.count(F.lit(1)).alias("accidents"))


def suspicious(pairs: DataFrame, a: str, b: str, threshold: int = 3) -> DataFrame:
    """Persons with strictly more than ``threshold`` accidents."""
    return degrees(pairs, a, b).filter(F.col("accidents") > F.lit(threshold))


def directed_edges(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Both directions of every accident (one pass); src is never null, a
    null dst stands for an unknown partner."""
    both = F.array(F.struct(F.col(a).alias("src"), F.col(b).alias("dst")),
                   F.struct(F.col(b).alias("src"), F.col(a).alias("dst")))
    return pairs.select(F.inline(both)).filter(F.col("src").isNotNull())


def repeat_edges(pairs: DataFrame, a: str, b: str, min_accidents: int = 2) -> DataFrame:
    """Directed edges whose source took part in ``min_accidents`` or more
    accidents (neighbours of any degree kept), with their multiplicity.

    The pairs are read once: edge multiplicities are one partial/final
    aggregate, and the source degree is a second aggregate over those
    counts (the identical exchange is reused by the planner)."""
    counts = (directed_edges(pairs, a, b).groupBy("src", "dst")
              .agg(F.count(F.lit(1)).alias("n")))
    deg = counts.groupBy("src").agg(F.sum("n").alias("accidents"))
    keep = deg.filter(F.col("accidents") >= F.lit(min_accidents)).select("src")
    return counts.join(keep, "src", "left_semi").filter(F.col("dst").isNotNull())


def simple_edges(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Undirected simple graph: (u < v), parallel edges and self-pairs removed."""
    return (pairs.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
            .filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
            .distinct())


def peel(edges: DataFrame, rounds: int = 1) -> DataFrame:
    """Remove vertices of degree < 2 for a few rounds (no cycle passes
    them). Only a pruning step: correctness does not depend on reaching the
    full 2-core, so long tails never cost one round per vertex."""
    e = cut_lineage(edges)
    n = e.count()
    for _ in range(rounds):
        deg = (e.select(F.explode(F.array("u", "v")).alias("x"))
               .groupBy("x").agg(F.count(F.lit(1)).alias("d")))
        keep = deg.filter(F.col("d") >= 2).select("x")
        nxt = (e.join(keep.withColumnRenamed("x", "u"), "u", "left_semi")
               .join(keep.withColumnRenamed("x", "v"), "v", "left_semi").select("u", "v"))
        nxt = cut_lineage(nxt)
        m = nxt.count()
        if m == n:
            break
        e, n = nxt, m
    return e


def _half_paths(adj: DataFrame, down: DataFrame, length: int, longest: int, cache: dict) -> DataFrame:
    """Paths s, p1..p_(length-1), end of distinct vertices, all ranked below s.

    Vertices are rank numbers and a path is plain long columns, 8 bytes a
    vertex. Only paths that grow further are written as a table; those of the
    last length, the most by far, go straight to their meeting."""
    if length in cache:
        return cache[length]
    if length == 1:
        p = down.select(F.col("u").alias("s"), F.col("v").alias("end"))
    else:
        inner = [f"p{k}" for k in range(1, length - 1)]
        prev = _half_paths(adj, down, length - 1, longest, cache)
        p = prev.join(adj.select(F.col("u").alias("end"), "v"), "end").filter(F.col("v") < F.col("s"))
        for k in inner:
            p = p.filter(F.col("v") != F.col(k))
        p = p.select("s", *inner, F.col("end").alias(f"p{length - 1}"), F.col("v").alias("end"))
        if length < longest:
            p = cut_lineage(p)
    cache[length] = p
    return p


@settled
def simple_cycles(pairs: DataFrame, a: str, b: str, max_len: int,
                  min_len: int = 3) -> DataFrame:
    """Distinct member sets of simple cycles with ``min_len``..``max_len``
    persons. Returns (group, size, members) where ``members`` is the sorted
    names joined by ', ', numbered 1.. by (size, members).

    Vertices are ranked by (degree, id); a cycle is built once, from its
    highest-ranked vertex, in one orientation, from two half paths through
    lower-ranked vertices that meet at the opposite vertex. A hub (a person in
    a large share of all accidents) therefore only starts paths and is never
    the middle of a quadratic number of them.

    ``max_len`` is the longest cycle searched; it is part of the question
    (the count of cycles grows exponentially with their length)."""
    if min_len < 3 or max_len < min_len:
        raise ValueError("need 3 <= min_len <= max_len")
    core = peel(simple_edges(pairs, a, b))
    deg = (core.select(F.explode(F.array("u", "v")).alias("id"))
           .groupBy("id").agg(F.count(F.lit(1)).alias("d")))
    ranks = cut_lineage(ordered_index(deg, ["d", "id"], name="rank").select("rank", "id"))
    ranked = (core.join(ranks.select(F.col("id").alias("u"), F.col("rank").alias("ru")), "u")
              .join(ranks.select(F.col("id").alias("v"), F.col("rank").alias("rv")), "v"))
    down = cut_lineage(ranked.select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v")))
    adj = down.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    cache: dict = {}
    longest = (max_len + 1) // 2
    found = None
    for length in range(min_len, max_len + 1):
        h1, h2 = (length + 1) // 2, length // 2
        pa = _half_paths(adj, down, h1, longest, cache)
        pb = _half_paths(adj, down, h2, longest, cache)
        inner_a, inner_b = [f"a{k}" for k in range(1, h1)], [f"b{k}" for k in range(1, h2)]
        # both sides are renamed alike, so that halves of one length are dealt out once
        pa = pa.select("s", "end", *(F.col(f"p{k}").alias(f"a{k}") for k in range(1, h1)))
        pb = pb.select("s", "end", *(F.col(f"p{k}").alias(f"b{k}") for k in range(1, h2)))
        # orientation: second vertex of A below second vertex of B; interiors disjoint
        cyc = pa.join(pb, ["s", "end"]).filter(F.col("a1") < F.col(inner_b[0] if inner_b else "end"))
        for x in inner_a:
            for y in inner_b:
                cyc = cyc.filter(F.col(x) != F.col(y))
        cyc = cyc.select(F.array_sort(F.array("s", "end", *inner_a, *inner_b)).alias("cycle"))
        found = cyc if found is None else found.unionAll(cyc)
    found = cut_lineage(found.distinct())
    named = (found.select("cycle", F.explode("cycle").alias("rank")).join(ranks, "rank")
             .groupBy("cycle").agg(F.collect_list(F.col("id").cast("string")).alias("members")))
    groups = named.select(F.size("members").alias("size"),
                          F.array_join(F.array_sort("members"), ", ").alias("members")).distinct()
    return ordered_index(groups, ["size", "members"], name="group").select("group", "size", "members")
