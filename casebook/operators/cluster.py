"""Clustering: DBSCAN, average-linkage agglomerative, k-means, profiles.

DBSCAN runs on a grid of cells of side eps/sqrt(d): any two points of one
cell are within eps, so a cell holding ``min_samples`` points is all core
without a single distance check, and the neighbour search only touches
points of sparse cells and points of neighbouring cells (an equi-join on the
cell key). Core cells are linked into clusters by distributed connected
components.

In up to ``OFFSET_DIMS`` dimensions the neighbours of a cell are a short list of
offsets; beyond, where that list would grow exponentially, they are looked up
among the occupied cells, one coordinate at a time (``_beside``).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.operators.common import connected_components, ordered_index
from casebook.session import cut_lineage, reuse, settled


# ------------------------------------------------------------------ DBSCAN
def _offsets(d: int, side: float, eps: float, half: bool) -> list[list[int]]:
    reach = math.ceil(math.sqrt(d))
    out = []
    for off in itertools.product(range(-reach, reach + 1), repeat=d):
        if all(o == 0 for o in off):
            continue
        if half and off <= tuple(0 for _ in off):  # keep one of each +/- pair
            continue
        gap = side * math.sqrt(sum(max(abs(o) - 1, 0) ** 2 for o in off))
        if gap <= eps:
            out.append(list(off))
    return out


OFFSET_DIMS = 3


def _beside(cells: DataFrame, d: int) -> DataFrame:
    """Pairs (cell, ncell) of different occupied cells that may hold points within eps, both ways round.

    Pairs of occupied prefixes (the first j coordinates) that are near enough
    so far get the next coordinate: the children of the one are joined to it,
    each offset of that coordinate is tried, and an equi-join keeps what is an
    occupied prefix too. A row is never made for a cell that holds no point, and
    the work is d joins of pairs of occupied prefixes, written one after the
    other. Cells are eps/sqrt(d) wide, so offsets o are out of reach when the
    sum of (abs(o) - 1)^2 exceeds d."""
    cells = cut_lineage(cells.select("cell").distinct())
    reach = math.isqrt(d) + 1
    offsets = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(max(abs(o) - 1, 0) ** 2).alias("cost"))
                        for o in range(-reach, reach + 1)])
    pairs = None
    for j in range(d):
        prefixes = cells.select(F.slice("cell", 1, j + 1).alias("next")).distinct()
        if pairs is None:
            grown = prefixes.select(F.col("next").alias("a"), F.array().cast("array<bigint>").alias("b"),
                                    F.lit(0).alias("used"))
        else:
            grown = (pairs.join(prefixes.select(F.slice("next", 1, j).alias("a"), "next"), "a")
                     .select(F.col("next").alias("a"), "b", "used"))
        grown = (grown.withColumn("_off", F.explode(offsets))
                 .withColumn("used", F.col("used") + F.col("_off.cost")).filter(F.col("used") <= F.lit(d))
                 .select("a", F.concat("b", F.array(F.element_at("a", j + 1) + F.col("_off.o"))).alias("b"), "used"))
        pairs = cut_lineage(grown.join(prefixes.withColumnRenamed("next", "b"), "b").select("a", "b", "used"))
    return pairs.filter(F.col("a") != F.col("b")).select(F.col("a").alias("cell"), F.col("b").alias("ncell"))


def _dist(a: str, b: str, cols: Sequence[str]):
    return F.sqrt(sum(((F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) ** 2 for c in cols), F.lit(0.0)))


def _box_gap(cols, far: bool):
    """Smallest (far=False) or largest (far=True) distance between the
    bounding boxes a_lo..a_hi and b_lo..b_hi."""
    terms = []
    for c in cols:
        if far:
            t = F.greatest(F.col(f"a_hi_{c}") - F.col(f"b_lo_{c}"), F.col(f"b_hi_{c}") - F.col(f"a_lo_{c}"))
        else:
            t = F.greatest(F.lit(0.0), F.col(f"a_lo_{c}") - F.col(f"b_hi_{c}"),
                           F.col(f"b_lo_{c}") - F.col(f"a_hi_{c}"))
        terms.append(t * t)
    return F.sqrt(sum(terms[1:], terms[0]))


def _link_cells(core: DataFrame, cols, eps: float, side: float, neighbours,
                brute_limit: int = 256, max_levels: int = 48) -> DataFrame:
    """Pairs of cell nodes (src, dst) holding core points within eps.

    Exact, without comparing all point pairs of two crowded cells: the
    bounding boxes of the core points of both (sub)cells decide a pair when
    their smallest distance exceeds eps (no link) or their largest distance
    is within eps (link). Only undecided pairs are split into half-size
    sub-cells, level by level; a pair is checked point by point once the
    product of its point counts is at most ``brute_limit``."""
    cells = core.select("cell", "node").distinct()
    cand = (neighbours(cells, half=True)
            .join(cells.select(F.col("cell").alias("ncell"), F.col("node").alias("nnode")), "ncell")
            .select(F.col("node").alias("na"), F.col("nnode").alias("nb"),
                    F.col("cell").alias("ca"), F.col("ncell").alias("cb"),
                    F.col("cell").alias("ka"), F.col("ncell").alias("kb")))
    pts = core.select("id", "cell", *cols, F.col("cell").alias("key"))
    done = None
    for level in range(max_levels + 1):
        boxes = pts.groupBy("cell", "key").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols])

        def side_box(tag):
            return boxes.select(F.col("cell").alias(f"c{tag}"), F.col("key").alias(f"k{tag}"),
                                F.col("n").alias(f"cnt_{tag}"),
                                *[F.col(f"lo_{c}").alias(f"{tag}_lo_{c}") for c in cols],
                                *[F.col(f"hi_{c}").alias(f"{tag}_hi_{c}") for c in cols])
        pairs = cand.join(side_box("a"), ["ca", "ka"]).join(side_box("b"), ["cb", "kb"])
        pairs = pairs.filter(_box_gap(cols, far=False) <= F.lit(eps))
        if done is not None:
            pairs = pairs.join(done, ["na", "nb"], "left_anti")
        pairs = reuse(pairs.withColumn("_sure", _box_gap(cols, far=True) <= F.lit(eps)))
        sure = pairs.filter("_sure").select("na", "nb")
        last = level == max_levels
        work = F.col("cnt_a") * F.col("cnt_b")
        small = pairs.filter(~F.col("_sure") & ((work <= F.lit(brute_limit)) | F.lit(last)))
        pa = pts.select(F.col("cell").alias("ca"), F.col("key").alias("ka"),
                        *[F.col(c).alias(f"pa_{c}") for c in cols])
        pb = pts.select(F.col("cell").alias("cb"), F.col("key").alias("kb"),
                        *[F.col(c).alias(f"pb_{c}") for c in cols])
        dist = F.sqrt(sum(((F.col(f"pa_{c}") - F.col(f"pb_{c}")) ** 2 for c in cols), F.lit(0.0)))
        brute = (small.select("na", "nb", "ca", "ka", "cb", "kb").join(pa, ["ca", "ka"]).join(pb, ["cb", "kb"])
                 .filter(dist <= F.lit(eps)).select("na", "nb"))
        new = reuse(sure.unionAll(brute).distinct())
        done = cut_lineage(new if done is None else done.unionAll(new).distinct())
        rest = (pairs.filter(~F.col("_sure") & (work > F.lit(brute_limit)))
                .join(new, ["na", "nb"], "left_anti").select("na", "nb", "ca", "cb", "ka", "kb"))
        rest = cut_lineage(rest)
        pairs.unpersist()
        new.unpersist()
        if last or rest.isEmpty():
            break
        # split the undecided (sub)cells into half-size children
        width = side / (2 ** (level + 1))
        involved = (rest.select(F.col("ca").alias("cell"), F.col("ka").alias("key"))
                    .unionAll(rest.select(F.col("cb").alias("cell"), F.col("kb").alias("key"))).distinct())
        pts = (pts.join(involved, ["cell", "key"], "left_semi")
               .withColumn("parent", F.col("key"))
               .withColumn("key", F.array(*[F.floor(F.col(c) / F.lit(width)) for c in cols])))
        pts = cut_lineage(pts)
        kids = pts.select("cell", "parent", "key").distinct()
        cand = (rest.join(kids.select(F.col("cell").alias("ca"), F.col("parent").alias("ka"),
                                      F.col("key").alias("ka2")), ["ca", "ka"])
                .join(kids.select(F.col("cell").alias("cb"), F.col("parent").alias("kb"),
                                  F.col("key").alias("kb2")), ["cb", "kb"])
                .select("na", "nb", "ca", "cb", F.col("ka2").alias("ka"), F.col("kb2").alias("kb")))
        pts = pts.drop("parent")
    return done.select(F.col("na").alias("src"), F.col("nb").alias("dst"))


@settled
def dbscan(df: DataFrame, id_col: str, cols: Sequence[str], eps: float,
           min_samples: int, brute_limit: int = 256) -> DataFrame:
    """Label every row: ``cluster`` 0.. (numbered by smallest core id) or -1
    for noise, plus ``is_core``. A point counts itself; neighbours are at
    Euclidean distance <= eps. A border point joins the smallest-numbered
    cluster among its core neighbours."""
    cols = list(cols)
    d = len(cols)
    side = eps / math.sqrt(d)
    pts = df.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(c) for c in cols])
    pts = pts.withColumn("cell", F.array(*[F.floor(F.col(c) / F.lit(side)) for c in cols]))
    pts = reuse(pts)
    n_cell = pts.groupBy("cell").agg(F.count(F.lit(1)).alias("n_cell"),
                                     F.min("id").alias("cell_min"))
    pts = pts.join(n_cell, "cell")

    beside = _beside(pts, d) if d > OFFSET_DIMS else None

    def neighbours(frame: DataFrame, half: bool) -> DataFrame:
        """``frame`` with a row per cell ``ncell`` beside its ``cell``; ``half``: one of both directions."""
        if beside is not None:
            return frame.join(beside.filter("cell < ncell") if half else beside, "cell")
        lit_offs = F.array(*[F.array(*[F.lit(o) for o in off]) for off in _offsets(d, side, eps, half)])
        return (frame.withColumn("_off", F.explode(lit_offs))
                .withColumn("ncell", F.zip_with("cell", "_off", lambda c, o: c + o))
                .drop("_off"))

    # neighbour counts, only for points of sparse cells
    sparse = pts.filter(F.col("n_cell") < F.lit(min_samples))
    probe = neighbours(sparse.select("id", "cell", *cols), half=False).alias("p")
    other = pts.select(F.col("id").alias("nid"), F.col("cell").alias("ncell"), *cols).alias("q")
    near = (probe.join(other, "ncell").filter(_dist("p", "q", cols) <= F.lit(eps))
                 .select(F.col("p.id").alias("id"), F.col("nid")))
    near = reuse(near)
    cnt = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"))
    pts = (pts.join(cnt, "id", "left")
           .withColumn("is_core", (F.col("n_cell") + F.coalesce("n_near", F.lit(0)))
                       >= F.lit(min_samples)))
    pts = reuse(pts)
    core = pts.filter("is_core")

    # one node per cell that has a core point: its smallest core id
    node = core.groupBy("cell").agg(F.min("id").alias("node"))
    core = core.join(node, "cell")
    links = _link_cells(core, cols, eps, side, neighbours, brute_limit=brute_limit)
    comp = connected_components(links, node.select(F.col("node").alias("id")),
                                src="src", dst="dst", vid="id")
    cell_root = node.join(comp.select(F.col("id").alias("node"), "component"), "node") \
                    .select("cell", F.col("component").alias("root"))

    # roots: core points take their cell's root; border points the smallest
    # root among core neighbours (same cell or a neighbouring cell)
    labelled = pts.join(cell_root, "cell", "left")
    core_root = labelled.filter("is_core").select(F.col("id").alias("nid"), F.col("root").alias("nroot"))
    border_via = (near.join(core_root, "nid").groupBy("id").agg(F.min("nroot").alias("broot")))
    labelled = labelled.join(border_via, "id", "left").withColumn(
        "root", F.when(F.col("is_core"), F.col("root"))
        .otherwise(F.least(F.col("root"), F.col("broot"))))
    roots = labelled.select("root").filter(F.col("root").isNotNull()).distinct()
    numbered = ordered_index(roots, ["root"], name="cluster", start=0)
    out = (labelled.join(numbered, "root", "left")
           .select(F.col("id").alias(id_col), *cols, "is_core",
                   F.coalesce(F.col("cluster"), F.lit(-1)).cast("int").alias("cluster")))
    return out


# ---------------------------------------------------------------- profiles
def profile(df: DataFrame, label: str, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Size and mean of every column per cluster label (one aggregate)."""
    aggs = [F.count(F.lit(1)).alias("size")]
    aggs += [(F.round(F.avg(c), digits) if digits is not None else F.avg(c)).alias(f"mean_{c}")
             for c in cols]
    return df.groupBy(label).agg(*aggs)


# ----------------------------------------------------------------- k-means
def kmeans(df: DataFrame, cols: Sequence[str], k: int = 4, max_iter: int = 50,
           seed: int = 22, label: str = "cluster"):
    """Spark ML k-means on the given columns; returns (labelled df, model)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    vec = VectorAssembler(inputCols=list(cols), outputCol="_features").transform(df)
    model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="_features",
                   predictionCol=label).fit(vec)
    out = model.transform(vec).drop("_features").withColumn(label, F.col(label).cast("int"))
    return out, model


# ------------------------------------------------------------ agglomerative
def average_linkage(centres: np.ndarray, weights: np.ndarray, k: int,
                    metric: str = "manhattan") -> tuple[list[int], list[tuple[int, int, float]]]:
    """Average linkage of weighted centres down to ``k`` clusters: the cluster
    number of each centre (by first centre, from 0) and all merges (a, b,
    height). A centre stands for ``weight`` points on one spot; heights are
    rounded to 9 places and ties go to the smallest pair."""
    gaps = centres[:, None, :] - centres[None, :, :]
    dist = np.abs(gaps).sum(axis=2) if metric == "manhattan" else np.sqrt((gaps * gaps).sum(axis=2))
    dist[np.tril_indices(len(centres))] = np.inf
    n, root, merges = weights.astype(float), np.arange(len(centres)), []
    labels = root.copy()
    while True:
        if len(centres) - len(merges) >= k:
            labels = root.copy()
        a, b = divmod(int(np.argmin(np.round(dist, 9))), max(1, len(centres)))
        if not len(centres) or not np.isfinite(dist[a, b]):
            break
        merges.append((a, b, float(round(dist[a, b], 9))))
        both = np.minimum(dist, dist.T)
        mean = (n[a] * both[a] + n[b] * both[b]) / (n[a] + n[b])
        n[a] += n[b]
        root[root == b] = a
        dist[a, a + 1:], dist[:a, a] = mean[a + 1:], mean[:a]
        dist[b, :] = dist[:, b] = np.inf
    firsts = sorted(set(labels.tolist()))
    return [firsts.index(r) for r in labels.tolist()], merges


def grid_cells(points: DataFrame, id_col: str, cols: Sequence[str], cell: float) -> tuple[DataFrame, DataFrame]:
    """Micro-clusters on a grid of side ``cell``: the points with their cell (id, cell: array of whole numbers) and the
    occupied cells (micro: from 0 in the order of their places, cell, n, centre: mean of the cell's points)."""
    at = points.select(id_col, *cols, F.array(*[F.floor(F.col(c) / F.lit(cell)).cast("long") for c in cols]).alias("cell"))
    cells = at.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("centre"))
    return at.select(id_col, "cell"), ordered_index(cells, ["cell"], name="micro", start=0)


def linkage(micro: DataFrame, metric: str = "manhattan") -> DataFrame:
    """Average linkage of micro-clusters (micro, n, centre) -> all merges (a, b, height, round), a < b; a cluster is
    named by its smallest member.

    The pair table keeps, of each pair of clusters, the sum of n_i * n_j * distance and of n_i * n_j over its members;
    their quotient is the average distance, and merging adds rows up. In each round every cluster looks for its
    nearest (heights to 9 places, ties to the smallest pair), and all pairs that chose each other merge: average
    linkage never brings a merged cluster nearer to a third than its parts were, so such pairs merge in any order.
    The table has one row per pair of micro-clusters, whose number the caller sets; nothing goes through the driver
    but row counts."""
    gap = X.manhattan("centre", "other") if metric == "manhattan" else X.euclidean("centre", "other")
    everyone = micro.agg(F.sort_array(F.collect_list(F.struct("micro", "n", "centre"))).alias("e")).scalar()
    pairs = (micro.withColumn("_all", everyone).select("micro", "n", "centre", F.inline(F.transform("_all", lambda x: F.struct(
        x["micro"].alias("b"), x["n"].alias("nb"), x["centre"].alias("other")))))
        .filter(F.col("micro") < F.col("b"))
        .select(F.col("micro").alias("a"), "b", (F.col("n") * F.col("nb")).cast("double").alias("w"), gap.alias("gap"))
        .select("a", "b", "w", (F.col("w") * F.col("gap")).alias("s")))
    pairs, merges, round_ = cut_lineage(pairs), None, 0
    while not pairs.isEmpty():
        round_ += 1
        height = F.round(F.col("s") / F.col("w"), 9)
        key = F.struct(height.alias("height"), "a", "b")
        ends = pairs.select(key.alias("k"), F.explode(F.array("a", "b")).alias("x"))
        best = ends.groupBy("x").agg(F.min("k").alias("k"))
        chosen = cut_lineage(best.groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter("c = 2").select("k.*")
                             .withColumn("round", F.lit(round_)))
        merges = chosen if merges is None else merges.unionByName(chosen)
        into = chosen.select(F.col("b").alias("old"), F.col("a").alias("new"))
        moved = (pairs.join(into.select(F.col("old").alias("a"), F.col("new").alias("na")), "a", "left")
                 .join(into.select(F.col("old").alias("b"), F.col("new").alias("nb")), "b", "left")
                 .select(F.coalesce("na", "a").alias("a"), F.coalesce("nb", "b").alias("b"), "w", "s"))
        pairs = cut_lineage(moved.filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                            .agg(F.sum("w").alias("w"), F.sum("s").alias("s")))
    if merges is None:
        return micro.sparkSession.createDataFrame([], "a long, b long, height double, round int")
    return merges.select(F.col("a").cast("long"), F.col("b").cast("long"), "height", "round")


def cut(micro: DataFrame, merges: DataFrame, k: int) -> DataFrame:
    """(micro, cluster): the merges of lowest height are done until ``k`` clusters are left; clusters are numbered from
    0 by their smallest micro-cluster."""
    done = merges.orderBy("height", "round", "a", "b").limit(max(0, micro.count() - k))
    at = connected_components(done, micro.select(F.col("micro").alias("id")), src="a", dst="b")
    firsts = ordered_index(at.select("component").distinct(), ["component"], name="cluster", start=0)
    return at.join(firsts, "component").select(F.col("id").alias("micro"), F.col("cluster").cast("int").alias("cluster"))


@settled
def agglomerative_grid(points: DataFrame, id_col: str, cols: Sequence[str], k: int, cell: float,
                       metric: str = "manhattan") -> tuple[DataFrame, DataFrame]:
    """Average-linkage clustering of any number of points, cut at ``k`` clusters: points of one grid cell of side
    ``cell`` are one micro-cluster on their mean, micro-clusters are linked by ``linkage``. ``cell`` is the resolution
    asked for. Points with a null coordinate take no part. Returns (labels (id, cluster), merges)."""
    good = points
    for c in cols:
        good = good.filter(F.col(c).isNotNull())
    at, micro = grid_cells(good, id_col, cols, cell)
    micro = cut_lineage(micro.select("micro", "cell", "n", "centre"))
    merges = linkage(micro, metric)
    labels = at.join(micro.select("cell", "micro"), "cell").join(cut(micro, merges, k), "micro")
    return labels.select(id_col, "cluster"), merges


@settled
def agglomerative(points: DataFrame, id_col: str, cols: Sequence[str], k: int, m: int,
                  metric: str = "manhattan", seed: int = 22) -> tuple[DataFrame, DataFrame]:
    """Average-linkage clustering of any number of points, cut at ``k`` clusters.

    Every point goes to one of ``m`` k-means centres, and the centres, each
    weighing as many points as it has, are linked; ``m`` is the resolution
    asked for and holds at every size, so the driver sees ``m`` rows and no
    table of point pairs is built. Points within one centre are linked at
    height 0. Returns (labels (id, cluster), merges (a, b, height) of centres)."""
    spark = points.sparkSession
    src = reuse(points.select(id_col, *cols))
    near, model = kmeans(src, cols, k=m, seed=seed, label="_centre")
    sizes = {r["_centre"]: r["n"] for r in near.groupBy("_centre").agg(F.count(F.lit(1)).alias("n")).collect()}
    used = sorted(sizes)
    centres = np.array([model.clusterCenters()[c] for c in used]).reshape(len(used), len(cols))
    number, merges = average_linkage(centres, np.array([sizes[c] for c in used]), k, metric)
    chosen = F.create_map(*[F.lit(x) for pair in zip(used, number) for x in pair])
    labels = near.select(id_col, F.element_at(chosen, F.col("_centre")).cast("int").alias("cluster"))
    return labels, spark.createDataFrame(merges, "a int, b int, height double")
