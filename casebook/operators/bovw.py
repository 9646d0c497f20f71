"""Bag of visual words: descriptors -> codebook -> words -> histograms ->
chi-squared similarity search.

Plan shape: descriptors are one row each (``posexplode``), the codebook is a
matrix broadcast in blocks of bounded size, assignment is one vectorised numpy
step per Arrow batch of descriptors, histograms are two partial/final
aggregates, and search is a top-k (TakeOrderedAndProject): every task keeps
k rows, nothing else reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions import exprs as X
from casebook.session import cut_lineage, ship_package, spark_context

# Most codebook bytes broadcast at once; a larger codebook goes in several blocks.
MAX_BROADCAST_BYTES = 64 << 20


# ------------------------------------------------------------ descriptors
def explode_descriptors(features: DataFrame, image: str = "image",
                        features_col: str = "features") -> DataFrame:
    """(image, features array<array>) -> one row per descriptor (image, pos, descriptor)."""
    return features.select(image, F.posexplode(features_col).alias("pos", "descriptor"))


def collect_features(descriptors: DataFrame, image: str = "image", pos: str = "pos",
                     descriptor: str = "descriptor") -> DataFrame:
    """One row per image holding its descriptors in ``pos`` order (the
    persisted feature layout). Group size = descriptors of one image."""
    return (descriptors.groupBy(image)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"),
                                                     F.col(descriptor).alias("d")))).alias("_s"))
            .select(image, F.transform("_s", lambda s: s["d"]).alias("features")))


def decode_netpbm(content: bytes) -> np.ndarray:
    """Pixels of a binary PGM or PPM file (maximum 255): height x width, or height x width x 3 (red, green, blue)."""
    kind, at, numbers = content[:2], 2, []
    if kind not in (b"P5", b"P6"):
        raise ValueError("not a binary PGM or PPM file")
    while len(numbers) < 3:
        line_end = content.index(b"\n", at) if content[at:at + 1] == b"#" else at
        if line_end > at:  # a comment
            at = line_end + 1
            continue
        start = at
        while content[at:at + 1].isdigit():
            at += 1
        if at > start:
            numbers.append(int(content[start:at]))
        else:
            at += 1
        if at > len(content):
            raise ValueError("the header ends early")
    width, height, most = numbers
    if most > 255:
        raise ValueError("two bytes a sample are not read")
    shape = (height, width) if kind == b"P5" else (height, width, 3)
    return np.frombuffer(content, dtype=np.uint8, count=int(np.prod(shape)), offset=at + 1).reshape(shape)


def decode_images(files: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_netpbm, image: str = "image",
                  content: str = "content") -> DataFrame:
    """File contents (``read_sequence_images``, ``read_image_files``) -> decoded images as ``read_images`` gives them:
    image, height, width, n_channels, data (blue, green, red), valid.

    ``decode(content)`` returns gray pixels (height x width) or red, green, blue (height x width x 3), as 8-bit
    numbers; whatever it cannot decode (null content, an exception, no pixels) keeps its row with ``valid`` false and
    no data, so nothing is lost without a trace. Only the content enters Python, in Arrow batches."""
    ship_package(files.sparkSession)

    def pixels(raw):
        try:
            got = None if raw is None else np.asarray(decode(raw))
        except Exception:  # noqa: BLE001 - a user function on any bytes; the row tells
            got = None
        if got is None or got.ndim not in (2, 3) or not got.size or (got.ndim == 3 and got.shape[2] not in (1, 3)):
            return -1, -1, -1, None, False
        got = np.ascontiguousarray(got[..., ::-1] if got.ndim == 3 else got, dtype=np.uint8)
        return got.shape[0], got.shape[1], 1 if got.ndim == 2 else got.shape[2], got.tobytes(), True

    @F.arrow_udf("height int, width int, n_channels int, data binary, valid boolean")
    def run(values: pa.Array) -> pa.Array:
        rows = [pixels(v.as_py()) for v in values]  # one picture's bytes at a time
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                                          names=["height", "width", "n_channels", "data", "valid"])

    return files.select(image, run(F.col(content)).alias("_i")).select(image, "_i.*")


def describe_images(images: DataFrame, describe: Callable[[np.ndarray], np.ndarray],
                    image: str = "image", dim: int = 64) -> DataFrame:
    """Run a user descriptor function on every decoded image (``mapInPandas``).

    ``images`` has (image, height, width, n_channels, data) as produced by
    ``sources.io.read_images``; ``describe(gray2d) -> n x dim`` array. An image
    without descriptors yields an empty array (its histogram is all zeros).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            feats = []
            for h, w, c, data in zip(pdf["height"], pdf["width"], pdf["n_channels"], pdf["data"]):
                if h <= 0:  # a file that could not be decoded has no descriptors
                    feats.append([])
                    continue
                arr = np.frombuffer(data, dtype=np.uint8).reshape(h, w, c).astype(np.float64)
                # BGR(A) -> luminance
                gray = arr[..., 0] if c == 1 else (0.114 * arr[..., 0] + 0.587 * arr[..., 1]
                                                   + 0.299 * arr[..., 2])
                d = describe(gray)
                d = np.zeros((0, dim)) if d is None else np.asarray(d, dtype=np.float64)
                feats.append([row.tolist() for row in d])
            yield pd.DataFrame({image: pdf[image], "features": feats})

    schema = T.StructType([T.StructField(image, T.StringType()),
                           T.StructField("features", T.ArrayType(T.ArrayType(T.DoubleType())))])
    ship_package(images.sparkSession)
    return images.select(image, "height", "width", "n_channels", "data").mapInPandas(run, schema)


def grid_gradient_descriptor(cell: int = 8, bins: int = 8, grid: int = 4):
    """Default ``describe``: dense, non-overlapping patches of ``grid*cell``
    pixels, each a concatenation of ``grid*grid`` gradient-orientation
    histograms (``bins`` each) weighted by magnitude and L2-normalised.
    One weighted ``bincount`` per image builds every cell histogram."""
    patch = grid * cell
    dim = grid * grid * bins

    def describe(gray: np.ndarray) -> np.ndarray:
        h, w = gray.shape
        ny, nx = h // patch, w // patch
        if ny == 0 or nx == 0:
            return np.zeros((0, dim))
        gy, gx = np.gradient(gray)
        mag = np.hypot(gx, gy)[: ny * patch, : nx * patch]
        ang = (np.arctan2(gy, gx) % (2 * np.pi)) / (2 * np.pi) * bins
        obin = np.minimum(ang.astype(int), bins - 1)[: ny * patch, : nx * patch]
        cy = np.arange(ny * patch)[:, None] // cell
        cx = np.arange(nx * patch)[None, :] // cell
        flat = (cy * (nx * grid) + cx) * bins + obin
        hist = np.bincount(flat.ravel(), weights=mag.ravel(), minlength=ny * grid * nx * grid * bins)
        hist = (hist.reshape(ny, grid, nx, grid, bins).transpose(0, 2, 1, 3, 4)
                .reshape(ny * nx, dim))
        norm = np.linalg.norm(hist, axis=1, keepdims=True)
        return np.divide(hist, norm, out=np.zeros_like(hist), where=norm > 0)

    return describe


# --------------------------------------------------------------- codebook
def train_codebook(descriptors: DataFrame, k: int, max_iter: int = 10, restarts: int = 1,
                   seed: int = 1, tol: float = 1e-4, init_mode: str = "random",
                   descriptor: str = "descriptor") -> DataFrame:
    """k-means codebook (Spark ML); with ``restarts`` > 1 the lowest-cost run
    of several seeds wins. Returns (centre_id, centre array<double>)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vecs = descriptors.select(array_to_vector(X.to_double_array(descriptor)).alias("v")).persist()
    try:
        best = None
        for r in range(restarts):
            km = KMeans(k=k, maxIter=max_iter, seed=seed + r, initMode=init_mode, tol=tol,
                        featuresCol="v")
            model = km.fit(vecs)
            cost = model.summary.trainingCost
            if best is None or cost < best[0]:
                best = (cost, model)
    finally:
        vecs.unpersist()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(best[1].clusterCenters())]
    spark = descriptors.sparkSession
    return spark.createDataFrame(centres, "centre_id int, centre array<double>")


def train_codebooks(descriptors: DataFrame, k: int, restarts: int = 10, max_iter: int = 10, tol: float = 1.0,
                    seed: int = 1, descriptor: str = "descriptor") -> tuple[DataFrame, DataFrame]:
    """k-means from ``restarts`` random starts at once: the centres of all starts that still move are moved in one pass
    over the descriptors per round. A start ends when no centre moves by ``tol`` or more, or after ``max_iter`` rounds;
    the start with the least cost (of its final centres, ties to the earlier one) wins.

    A start's centres are the descriptors with the smallest hashes under its own seed, so they do not depend on
    partitioning; a centre that no descriptor is nearest to stays where it is. A task sends one row per start and
    centre; the driver holds the centres (restarts x k). Descriptors that are null take no part.

    Returns the winner (centre_id, centre) and all starts (start, rounds, cost, moved (largest last move), best)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    spark = descriptors.sparkSession
    ship_package(spark)
    data = descriptors.select(X.to_double_array(descriptor).alias("d")).filter(F.col("d").isNotNull())
    data = cut_lineage(data)  # read once a round
    first = (data.select("d", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("start"))
             .withColumn("h", F.xxhash64("d", "start", F.lit(seed))))
    chosen = (first.withColumn("n", F.row_number().over(Window.partitionBy("start").orderBy("h", "d")))
              .filter(F.col("n") <= k).select("start", "n", "d").collect())  # restarts x k rows
    empty = spark.createDataFrame([], "centre_id int, centre array<double>")
    if not chosen:
        return empty, spark.createDataFrame([], "start int, rounds int, cost double, moved double, best boolean")
    centres = {s: np.array([r["d"] for r in sorted(chosen, key=lambda r: r["n"]) if r["start"] == s]) for s in range(restarts)}
    rounds, moved = dict.fromkeys(centres, 0), dict.fromkeys(centres, float("inf"))

    def one_pass(live: dict[int, np.ndarray]) -> dict[tuple[int, int], tuple]:
        """(start, centre) -> number of its descriptors, their sum, their squared distances."""
        def run(batches):
            total = {s: [np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))] for s, c in live.items()}
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for s, c in live.items():
                    word, dist = _nearest(c, 0)(x)
                    n, sums, cost = total[s]
                    n += np.bincount(word, minlength=len(c))
                    np.add.at(sums, word, x)
                    cost += np.bincount(word, dist ** 2, len(c))
            rows = [(s, j, n[j], sums[j].tolist(), cost[j]) for s, (n, sums, cost) in total.items() for j in np.flatnonzero(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.float64()))],
                names=["start", "centre", "n", "sums", "cost"])
        parts = data.mapInArrow(run, "start int, centre int, n double, sums array<double>, cost double")
        added = parts.groupBy("start", "centre").agg(
            F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"), F.sum("cost").alias("cost"))
        return {(r["start"], r["centre"]): (r["n"], np.array(r["sums"]), r["cost"]) for r in added.collect()}

    live = dict(centres)
    while live:
        found = one_pass(live)
        for s in list(live):
            new = live[s].copy()
            for j in range(len(new)):
                if (s, j) in found:
                    new[j] = found[s, j][1] / found[s, j][0]
            rounds[s] += 1
            moved[s] = float(np.sqrt(((new - live[s]) ** 2).sum(axis=1)).max())
            centres[s] = live[s] = new
            if moved[s] < tol or moved[s] == 0 or rounds[s] >= max_iter:
                del live[s]
    final = one_pass(centres)
    cost = {s: float(sum(v[2] for (t, _), v in final.items() if t == s)) for s in centres}
    best = min(cost, key=lambda s: (cost[s], s))
    codebook = spark.createDataFrame([(j, c.tolist()) for j, c in enumerate(centres[best])], empty.schema)
    starts = spark.createDataFrame([(s, rounds[s], cost[s], moved[s], s == best) for s in sorted(centres)],
                                   "start int, rounds int, cost double, moved double, best boolean")
    return codebook, starts


def codebook_from_groups(descriptors: DataFrame, group: str,
                         descriptor: str = "descriptor") -> DataFrame:
    """Centroid of every group of descriptors as a codebook (centre_id = rank
    of the group value, from 0): one partial/final vector mean over whole
    descriptors, numbered by the distributed ordered index. Descriptors of
    one group that differ in length are an error."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    from casebook.operators.common import ordered_index

    means = descriptors.groupBy(group).agg(
        Summarizer.mean(array_to_vector(X.to_double_array(descriptor))).alias("_mean"))
    numbered = ordered_index(means.select(group, vector_to_array("_mean").alias("centre")),
                             [group], name="centre_id", start=0)
    return numbered.select(F.col("centre_id").cast("int"), F.col(group), "centre")


def codebook_matrix(codebook: DataFrame, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Rows lo..hi-1 of the codebook as a dense matrix ordered by centre_id
    (callers check the size first; only one broadcast-sized block is ever
    brought to the driver)."""
    part = codebook.filter(F.col("centre_id") >= lo)
    if hi is not None:
        part = part.filter(F.col("centre_id") < hi)
    rows = part.select("centre_id", "centre").orderBy("centre_id").collect()
    ids = [r[0] for r in rows]
    if ids != list(range(lo, lo + len(ids))):
        raise ValueError("centre_id must be 0..k-1")
    return np.array([r[1] for r in rows], dtype=np.float64)


# ------------------------------------------------------------- assignment
# Elements of one rows x centres matrix in a worker (64 MB of doubles).
TILE = 8 << 20


def _nearest(block: np.ndarray, offset: int):
    """Nearest centre of ``block`` per row of a matrix, ties to the lowest
    centre id, in tiles of rows whose product matrix holds ``TILE`` elements.

    One matrix product per batch gives |x|^2 - 2 x.c + |c|^2 for every
    centre; the expansion can be off by rounding, so every centre within a
    tolerance of a row's minimum is re-measured with direct float64
    differences and the exact winner is kept."""
    cc = (block * block).sum(axis=1)
    tile = max(1, TILE // len(block))

    def nearest(x: np.ndarray):
        parts = [one_tile(x[s:s + tile]) for s in range(0, len(x), tile)]
        if not parts:
            return np.zeros(0, dtype=np.int32), np.zeros(0)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def one_tile(x: np.ndarray):
        xx = (x * x).sum(axis=1)
        approx = xx[:, None] - 2.0 * (x @ block.T) + cc[None, :]
        low = approx.min(axis=1)
        tol = 1e-9 * (xx + cc.max()) + 1e-12
        cand = approx <= (low + tol)[:, None]
        best_w = np.argmax(cand, axis=1).astype(np.int32)
        best_d = ((x - block[best_w]) ** 2).sum(axis=1)
        multi = np.nonzero(cand.sum(axis=1) > 1)[0]
        for i in multi:  # near-ties only
            ids = np.nonzero(cand[i])[0]
            d = ((block[ids] - x[i]) ** 2).sum(axis=1)
            j = int(np.argmin(d))  # first minimum = lowest id
            best_w[i], best_d[i] = ids[j], d[j]
        return best_w + offset, np.sqrt(best_d)
    return nearest


def assign(descriptors: DataFrame, codebook: DataFrame, descriptor: str = "descriptor",
           max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Append ``word`` (nearest centre id) and ``dist`` (Euclidean) to every
    descriptor; both are null without a descriptor or without centres.

    The codebook is passed in blocks of at most ``max_broadcast_bytes``: one
    block at a time is brought to the driver and broadcast, every row keeps
    its best centre so far, and the table is written between blocks so that a
    worker holds one block. Only the descriptor enters Python; no shuffle, no
    key, and rows and columns stay as they are. A codebook of one block is one
    pass without a written table."""
    shape = codebook.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("centre")).alias("dim")).first()
    k, dim = int(shape["k"]), int(shape["dim"] or 0)
    ship_package(descriptors.sparkSession)
    per = max(1, max_broadcast_bytes // max(1, dim * 8))
    out = descriptors.withColumn("_best", F.lit(None).cast("struct<word:int,dist:double>"))
    for lo in range(0, k, per):
        if lo:
            out = cut_lineage(out)
        found = _nearest_udf(out.sparkSession, codebook_matrix(codebook, lo, lo + per), lo)
        out = out.withColumn("_new", found(X.to_double_array(descriptor)))
        if lo:  # an earlier block has the lower ids, so it keeps ties
            out = out.withColumn("_new", F.when(F.col("_new.dist") < F.col("_best.dist"), F.col("_new"))
                                 .otherwise(F.col("_best")))
        out = out.withColumn("_best", F.col("_new")).drop("_new")
    return out.select(*[F.col(f"`{c}`") for c in descriptors.columns], "_best.word", "_best.dist")


def _nearest_udf(spark, block: np.ndarray, offset: int):
    """Arrow function: descriptors (array<double>) -> struct(word, dist) within one codebook block."""
    sc = spark_context(spark)
    if sc is not None:
        holder = sc.broadcast(block)   # shipped once per executor
        del block
        get = lambda: holder.value
    else:  # Spark Connect: ship with the function
        get = lambda: block

    @F.arrow_udf("word int, dist double")
    def nearest(values: pa.Array) -> pa.Array:
        centres = get()
        there = values.drop_null()
        if not (there.value_lengths().to_numpy(zero_copy_only=False) == centres.shape[1]).all():
            raise ValueError(f"descriptors must have {centres.shape[1]} components, as the codebook has")
        x = there.flatten().to_numpy(zero_copy_only=False).reshape(len(there), centres.shape[1])
        w, d = _nearest(centres, offset)(x)
        missing = values.is_null().to_numpy(zero_copy_only=False)
        words, dists = np.zeros(len(values), dtype=np.int32), np.zeros(len(values))
        words[~missing], dists[~missing] = w, d
        return pa.StructArray.from_arrays([pa.array(words, mask=missing), pa.array(dists, mask=missing)],
                                          names=["word", "dist"])
    return nearest


# ------------------------------------------------------------- histograms
def histogram(assigned: DataFrame, k: int, image: str = "image", word: str = "word",
              images: DataFrame | None = None) -> DataFrame:
    """Dense length-k word histogram per image (zeros kept) and descriptor
    count. Two partial/final aggregates: (image, word) then image, so even
    an image with a huge share of descriptors is pre-combined map-side.
    ``images`` (one column ``image``) adds all-zero rows for images without
    descriptors."""
    counts = assigned.groupBy(image, word).agg(F.count(F.lit(1)).alias("_n"))
    per = counts.groupBy(image).agg(
        F.collect_list(F.struct(F.col(word).cast("int"), F.col("_n"))).alias("_e"),
        F.sum("_n").alias("n_desc"))
    out = per.select(image, "n_desc", X.dense_histogram("_e", k).alias("hist"))
    if images is not None:
        out = (images.select(image).distinct().join(out, image, "left")
               .select(image, F.coalesce("n_desc", F.lit(0)).alias("n_desc"),
                       F.coalesce("hist", F.array_repeat(F.lit(0.0), k)).alias("hist")))
    return out


# ----------------------------------------------------------------- search
def search(index: DataFrame, query_hist, k: int = 20, image: str = "image",
           hist: str = "hist", query_id=None, digits: int = 6) -> DataFrame:
    """Top-k images by chi-squared distance to one query histogram.

    ``query_hist`` is a list of numbers or a one-row DataFrame with ``hist``.
    The distance is rounded before ordering so ties break by image id
    deterministically. TakeOrderedAndProject keeps k rows per task."""
    if isinstance(query_hist, DataFrame):
        rows = query_hist.select(hist).take(2)
        if len(rows) != 1:
            raise ValueError("query_hist must hold exactly one row")
        query_hist = rows[0][0]
    # one array value, however long: not a literal per word
    q = index.sparkSession.createDataFrame([([float(v) for v in query_hist],)], "q array<double>").scalar()
    scored = index.withColumn("_query", q).select(
        F.col(image), F.round(X.chi2_distance(F.col(hist), F.col("_query")), digits).alias("distance"))
    top = scored.orderBy("distance", image).limit(k)
    w = Window.orderBy("distance", image)  # k rows
    out = top.select(image, "distance", F.row_number().over(w).alias("rank"))
    if query_id is not None:
        out = out.select(F.lit(query_id).alias("query"), "*")
    return out


def search_many(index: DataFrame, queries: DataFrame, k: int = 20, image: str = "image",
                hist: str = "hist", block: int = 256, digits: int = 6) -> DataFrame:
    """Top-k per query image, for any number of queries, in one plan.

    Query histograms are numbered and gathered ``block`` to a row; every index
    row meets each block once and is scored against all its queries there.
    The rank filter keeps k rows per query in each task before the shuffle
    (window group limit), ties by image id."""
    from casebook.operators.common import ordered_index

    numbered = ordered_index(queries.select(F.col(image).alias("_q"), F.col(hist).alias("_h")), ["_q"],
                             name="_nth", start=0)
    blocks = numbered.groupBy(F.expr(f"cast(_nth div {int(block)} as int)").alias("_blk")).agg(
        F.collect_list(F.struct("_q", "_h")).alias("_queries"))
    n = queries.count()
    meet = index.select(image, hist, F.explode(F.sequence(F.lit(0), F.lit(max(0, (n - 1) // block)))).alias("_blk"))
    scored = meet.join(blocks, "_blk").select(F.inline(F.transform("_queries", lambda q: F.struct(
        q["_q"].alias("query"), F.col(image).alias(image),
        F.round(X.chi2_distance(F.col(hist), q["_h"]), digits).alias("distance")))))
    w = Window.partitionBy("query").orderBy("distance", image)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search_lists(index: DataFrame, queries: DataFrame, k: int = 20, image: str = "image",
                 hist: str = "hist", digits: int = 6, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The rows of ``search_many`` by inverted lists, for histograms that are mostly zeros.

    The distance to an image without a common word is a constant of the query
    plus one of the image; only words that both have change it. Each Arrow
    batch of the index becomes lists word -> (image, count); a query adds up the
    corrections of its own words' lists, so its cost is the length of these
    lists and not images times words. The index stays where it is: queries come
    to it as lists of their words, in blocks dealt by hash, of at most half of
    ``max_broadcast_bytes`` on average (one scan of the index a block), and each
    batch gives at most ``k`` images a query (more where distances agree to
    ``digits`` places but not exactly).

    Counts must not be negative. Rows without ``hist`` take no part; of
    histograms of several lengths the shorter have zeros. Repeated queries give
    the rows of one."""
    spark = index.sparkSession
    ship_package(spark)
    sparse = queries.filter(F.col(hist).isNotNull()).select(
        F.col(image).alias("query"), X.to_double_array(hist).alias("_h")).dropDuplicates(["query"])
    sparse = cut_lineage(sparse.select("query", F.filter(F.transform("_h", lambda x, i: F.struct(
        i.cast("int").alias("word"), x.alias("n"))), lambda e: e["n"] != 0).alias("entries")))
    size = sparse.agg(F.sum(F.size("entries") * F.lit(12) + F.lit(64)).alias("b")).first()["b"] or 0
    blocks = max(1, -(-int(size) // max(1, max_broadcast_bytes // 2)))  # by hash, so half of the bound on average
    base = index.filter(F.col(hist).isNotNull()).select(F.col(image).alias("image"), X.to_double_array(hist).alias("_h"))
    kind = {f.name: f.dataType.simpleString() for f in base.schema.fields}["image"]
    found = None
    for b in range(blocks):
        mine = sparse.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == F.lit(b)).toArrow()
        part = base.mapInArrow(_scan_lists(mine, k, digits),
                               f"query {sparse.schema['query'].dataType.simpleString()}, image {kind}, distance double")
        found = part if found is None else found.unionAll(part)
    out = found.select("query", F.col("image").alias(image), F.round("distance", digits).alias("distance"))
    w = Window.partitionBy("query").orderBy("distance", image)
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _alone(n: np.ndarray) -> np.ndarray:
    """A word's share of the distance where the other histogram lacks it."""
    return n * n / (n + X.CHI2_EPS)


def _scan_lists(queries: pa.Table, k: int, digits: int):
    ids = queries.column("query").combine_chunks()
    entries = queries.column("entries").combine_chunks()
    off = np.r_[0, np.cumsum(entries.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
    flat = entries.flatten()
    q_word, q_n = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("word", "n"))
    constant = np.array([_alone(q_n[lo:hi]).sum() for lo, hi in zip(off, off[1:])])

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            if not rows or not len(ids):
                continue
            names, hists = batch.column(0), batch.column(1)
            lengths = hists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = hists.flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(rows), lengths)
            word = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            there = values != 0
            of, word, n = of[there], word[there], values[there]
            own = np.bincount(of, weights=_alone(n), minlength=rows)
            order = np.argsort(word, kind="stable")
            of, word, n = of[order], word[order], n[order]
            place = np.argsort(np.argsort(names.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
            starts, ends = np.searchsorted(word, q_word), np.searchsorted(word, q_word, side="right")
            query, image, distance = [], [], []
            for q in range(len(ids)):
                change = np.zeros(rows)
                for e in range(off[q], off[q + 1]):
                    at = slice(starts[e], ends[e])  # an image once a list
                    x, y = q_n[e], n[at]
                    change[of[at]] += (x - y) ** 2 / (x + y + X.CHI2_EPS) - _alone(x) - _alone(y)
                best = _first(constant[q] + own + change, place, k, digits)
                query.append(np.full(len(best[0]), q))
                image.append(best[0])
                distance.append(best[1])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.concatenate(query))), names.take(pa.array(np.concatenate(image))),
                 pa.array(np.concatenate(distance))], names=["query", "image", "distance"])
    return run


def _first(distance: np.ndarray, place: np.ndarray, k: int, digits: int):
    """Every row that can be among the first ``k`` by rounded distance, then id (``place``: order of ids)."""
    at = np.arange(len(distance))
    if len(at) > k:
        bound = np.partition(distance, k - 1)[k - 1] + 2 * 10.0 ** -digits
        at = at[distance <= bound]
        at = at[np.lexsort((place[at], distance[at]))]
        d = distance[at]
        head = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        nth = np.arange(len(at)) - np.repeat(head, np.diff(np.r_[head, len(at)]))
        at = at[nth < k]  # of equal distances the first k ids are enough
    return at, distance[at]
