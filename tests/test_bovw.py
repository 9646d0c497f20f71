"""Visual words: assignment vs brute force, histogram properties, search,
image source + descriptor function on generated PNGs."""

import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.operators import bovw
from casebook.sources import io


def write_png(path, gray):
    h, w = gray.shape
    raw = b"".join(b"\x00" + bytes(row) for row in gray.astype(np.uint8))

    def chunk(tag, data):
        c = struct.pack(">I", len(data)) + tag + data
        return c + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) \
        + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(png)


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(4)
    desc = [(img, pos, rnd.normal(size=8).tolist()) for img in range(20) for pos in range(rnd.integers(1, 9))]
    df = spark.createDataFrame(desc, "image long, pos int, descriptor array<double>")
    cb = spark.createDataFrame([(i, rnd.normal(size=8).tolist()) for i in range(5)],
                               "centre_id int, centre array<double>")
    return desc, df, cb


def test_assign_matches_brute_force(spark, data):
    desc, df, cb = data
    centres = np.array([r[1] for r in cb.orderBy("centre_id").collect()])
    got = {(r["image"], r["pos"]): (r["word"], r["dist"]) for r in bovw.assign(df, cb).collect()}
    for img, pos, d in desc:
        dists = np.sqrt(((centres - np.array(d)) ** 2).sum(axis=1))
        w, dist = got[(img, pos)]
        assert w == int(np.argmin(dists)) and dist == pytest.approx(dists.min())


def test_blocked_assign_equals_single_broadcast(spark, data):
    """Blocks need no key: repeated and null descriptors and all columns stay."""
    _, df, cb = data
    more = df.unionAll(df).unionByName(spark.createDataFrame([(99, 0, None)], df.schema))
    single, blocked = bovw.assign(more, cb), bovw.assign(more, cb, max_broadcast_bytes=8 * 8 * 2)
    assert single.columns == blocked.columns == [*df.columns, "word", "dist"]
    assert sorted(map(str, single.collect())) == sorted(map(str, blocked.collect()))
    assert single.filter("image = 99").first()["word"] is None


def test_assign_rejects_other_lengths(spark, data):
    _, df, cb = data
    longer = df.withColumn("descriptor", F.concat("descriptor", F.array(F.lit(0.0))))
    with pytest.raises(Exception, match="components"):
        bovw.assign(longer, cb).collect()


def test_long_descriptors_keep_their_length(spark):
    d = spark.createDataFrame([(0, [float(i) for i in range(128)])], "g int, descriptor array<double>")
    assert len(bovw.codebook_from_groups(d, "g").first()["centre"]) == 128


def test_assign_only_the_descriptor_enters_python(spark, data):
    _, df, cb = data
    plan = bovw.assign(df, cb)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan and "Exchange" not in plan


def test_search_many_takes_any_number_of_queries(spark):
    rnd = random.Random(8)
    idx = spark.createDataFrame([(i, [float(rnd.randrange(4)) for _ in range(3)]) for i in range(300)],
                                "image long, hist array<double>")
    many = bovw.search_many(idx, idx, k=2, block=64).collect()
    assert len(many) == 600
    for q in (0, 63, 64, 299):
        one = bovw.search(idx, idx.filter(F.col("image") == q), k=2).collect()
        assert [(r["image"], r["distance"]) for r in one] == \
            [(r["image"], r["distance"]) for r in sorted(many, key=lambda r: r["rank"]) if r["query"] == q]


@pytest.mark.parametrize("bound", [1 << 20, 4000])
def test_search_by_inverted_lists_equals_scoring_all(spark, bound):
    rnd = random.Random(12)
    rows = []
    for i in range(240):
        h = [0.0] * 40
        for _ in range(rnd.randrange(7)):  # some have no word at all, many are equal
            h[min(rnd.randrange(40), rnd.randrange(40))] += rnd.choice([1.0, 2.0, 0.5])
        rows.append((f"im{i:03d}", rows[i % 5][1] if i % 3 == 0 and i > 5 else h))
    idx = spark.createDataFrame(rows, "image string, hist array<double>").repartition(3)
    queries = idx.filter("substr(image, 5) in ('0', '7')")
    want = {tuple(r) for r in bovw.search_many(idx, queries, k=7).select("query", "image", "distance", "rank").collect()}
    lists = bovw.search_lists(idx.unionByName(spark.createDataFrame([("none", None)], idx.schema)),
                              queries.unionByName(queries), k=7, max_broadcast_bytes=bound)
    assert lists.columns == ["query", "image", "distance", "rank"]
    assert {tuple(r) for r in lists.collect()} == want and len(want) == 48 * 7
    assert bovw.search_lists(idx.limit(0), queries).isEmpty()
    assert bovw.search_lists(idx, queries.limit(0)).isEmpty()


def test_histogram_sums_to_descriptor_count(spark, data):
    desc, df, cb = data
    a = bovw.assign(df, cb)
    images = spark.range(25).withColumnRenamed("id", "image")
    rows = bovw.histogram(a, 5, images=images).collect()
    counts = {}
    for img, _, _ in desc:
        counts[img] = counts.get(img, 0) + 1
    assert len(rows) == 25
    for r in rows:
        assert len(r["hist"]) == 5
        assert sum(r["hist"]) == counts.get(r["image"], 0) == r["n_desc"]


def test_search_orders_by_distance_then_id(spark):
    idx = spark.createDataFrame([(1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 2.0]), (4, [2.0, 0.0])],
                                "image long, hist array<double>")
    rows = bovw.search(idx, [1.0, 1.0], k=3).collect()
    assert [(r["image"], r["rank"]) for r in rows] == [(1, 1), (2, 2), (3, 3)]
    assert rows[0]["distance"] == 0.0 and rows[2]["distance"] == pytest.approx(1.333333)
    many = bovw.search_many(idx, idx.filter("image in (1, 3)"), k=2).collect()
    assert {(r["query"], r["image"]) for r in many} == {(1, 1), (1, 2), (3, 3), (3, 1)}


def test_codebook_training_and_groups(spark, data):
    _, df, _ = data
    cb = bovw.train_codebook(df, k=3, max_iter=10, restarts=2, seed=1)
    assert cb.count() == 3 and len(cb.first()["centre"]) == 8
    g = bovw.codebook_from_groups(df.withColumn("g", F.col("image") % 2), "g")
    assert [r["centre_id"] for r in g.orderBy("centre_id").collect()] == [0, 1]
    sums = df.filter("image % 2 = 1").selectExpr(*[f"avg(descriptor[{i}])" for i in range(8)]).first()
    assert g.filter("centre_id = 1").first()["centre"] == pytest.approx(list(sums))


def test_images_to_histograms(spark, tmp_dir):
    rnd = np.random.default_rng(1)
    for i in range(4):
        write_png(os.path.join(tmp_dir, f"img{i}.png"), rnd.integers(0, 255, size=(64, 64)))
    write_png(os.path.join(tmp_dir, "flat.png"), np.zeros((16, 16)))
    imgs = io.read_images(spark, tmp_dir, glob="*.png")
    assert imgs.count() == 5
    feats = bovw.describe_images(imgs, bovw.grid_gradient_descriptor(), dim=128)
    by = {r["image"]: r["features"] for r in feats.collect()}
    assert len(by["img0.png"]) == 4 and len(by["img0.png"][0]) == 128
    assert by["flat.png"] == []  # too small for a patch: empty, not an error
    desc = bovw.explode_descriptors(feats, "image", "features")
    cb = bovw.train_codebook(desc, k=3, seed=2)
    hist = bovw.histogram(bovw.assign(desc, cb), 3, images=imgs.select("image")).collect()
    h = {r["image"]: r["hist"] for r in hist}
    assert h["flat.png"] == [0.0, 0.0, 0.0] and sum(h["img1.png"]) == 4


def test_codebook_and_index_csv_round_trip(spark, tmp_dir):
    cb = spark.createDataFrame([(i, [float(i), i + 0.5]) for i in range(6)], "centre_id int, centre array<double>")
    io.write_codebook_csv(cb, os.path.join(tmp_dir, "cb"))
    back = io.read_codebook_csv(spark, os.path.join(tmp_dir, "cb"), dim=2)
    assert [(r[0], list(r[1])) for r in back.orderBy("centre_id").collect()] == \
        [(i, [float(i), i + 0.5]) for i in range(6)]
    path = os.path.join(tmp_dir, "index.csv")
    with open(path, "w") as f:
        f.write("a,1,2\nb,3,4\na,5,6\n")
    got = {r["image"]: list(r["hist"]) for r in io.read_index_csv(spark, path).collect()}
    assert got == {"a": [5.0, 6.0], "b": [3.0, 4.0]}


def test_index_csv_and_model_round_trip(spark, tmp_dir):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    idx = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [0.0, 3.5])], "image string, hist array<double>")
    io.write_index_csv(idx, os.path.join(tmp_dir, "idx"))
    back = {r["image"]: list(r["hist"]) for r in io.read_index_csv(spark, os.path.join(tmp_dir, "idx")).collect()}
    assert back == {"a": [1.0, 2.0], "b": [0.0, 3.5]}
    pts = spark.createDataFrame([([0.0, 0.0],), ([0.1, 0.0],), ([5.0, 5.0],), ([5.1, 5.0],)], "v array<double>")
    model = KMeans(k=2, seed=1, featuresCol="f").fit(pts.select(array_to_vector("v").alias("f")))
    io.save_model(model, os.path.join(tmp_dir, "km"))
    cb = io.load_kmeans_centres(spark, os.path.join(tmp_dir, "km"))
    assert cb.count() == 2 and len(cb.first()["centre"]) == 2
    io.register_view(cb, "codebook_view")
    assert spark.sql("select count(*) from codebook_view").first()[0] == 2


def test_assign_exact_on_ties(spark):
    """Equidistant centres: the lowest id wins, distances exact."""
    cb = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])],
                               "centre_id int, centre array<double>")
    d = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.5])], "image long, descriptor array<double>")
    got = {r["image"]: (r["word"], r["dist"]) for r in bovw.assign(d, cb).collect()}
    assert got[0] == (0, 1.0) and got[1] == (0, 0.0) and got[2] == (2, 0.5)


def test_assign_large_codebook_matches_direct(spark):
    rnd = np.random.default_rng(7)
    cents = rnd.normal(size=(300, 16))
    xs = rnd.normal(size=(500, 16))
    cb = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(cents)], "centre_id int, centre array<double>")
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(xs)], "image long, descriptor array<double>")
    got = {r["image"]: (r["word"], r["dist"]) for r in bovw.assign(d, cb).collect()}
    for i, x in enumerate(xs):
        dist = np.sqrt(((cents - x) ** 2).sum(axis=1))
        assert got[i][0] == int(np.argmin(dist)) and got[i][1] == pytest.approx(dist.min(), abs=1e-12)


def loop_descriptor(gray, cell=8, bins=8, grid=4):
    patch = grid * cell
    gy, gx = np.gradient(gray)
    mag = np.hypot(gx, gy)
    idx = np.minimum(((np.arctan2(gy, gx) % (2 * np.pi)) / (2 * np.pi) * bins).astype(int), bins - 1)
    out = []
    for y in range(0, gray.shape[0] - patch + 1, patch):
        for x in range(0, gray.shape[1] - patch + 1, patch):
            v = np.concatenate([np.bincount(idx[y + a * cell:y + (a + 1) * cell, x + b * cell:x + (b + 1) * cell].ravel(),
                                            weights=mag[y + a * cell:y + (a + 1) * cell, x + b * cell:x + (b + 1) * cell].ravel(),
                                            minlength=bins) for a in range(grid) for b in range(grid)])
            n = np.linalg.norm(v)
            out.append(v / n if n > 0 else v)
    return np.array(out).reshape(-1, grid * grid * bins)


def test_vectorised_descriptor_equals_loop():
    rnd = np.random.default_rng(3)
    for shape in [(64, 96), (70, 33), (31, 200)]:
        g = rnd.integers(0, 255, size=shape).astype(float)
        assert np.allclose(bovw.grid_gradient_descriptor()(g), loop_descriptor(g))


def ppm(pixels: np.ndarray, comment: bytes = b"") -> bytes:
    kind = b"P5" if pixels.ndim == 2 else b"P6"
    return kind + b"\n" + comment + f"{pixels.shape[1]} {pixels.shape[0]}\n255\n".encode() + pixels.astype(np.uint8).tobytes()


def test_sequence_file_to_search(spark, tmp_dir):
    """The whole extraction job: sequence file, pixels, descriptors, codebook, words, histograms, search."""
    rnd = np.random.default_rng(3)
    pictures = {f"i{k}.ppm": rnd.integers(0, 255, size=(64, 96)) for k in range(5)}
    pictures["colour.ppm"] = rnd.integers(0, 255, size=(64, 64, 3))
    records = [(n, bytearray(ppm(p, b"# made here\n"))) for n, p in pictures.items()]
    records += [("copy.ppm", bytearray(ppm(pictures["i2.ppm"]))), ("broken.ppm", bytearray(b"P5\n9 9\n255\nxx")),
                ("other.bin", bytearray(b"\x00\x01")), ("empty.ppm", bytearray(b""))]
    path = os.path.join(tmp_dir, "seq")
    spark.sparkContext.parallelize(records, 3).saveAsSequenceFile(path)
    images = bovw.decode_images(io.read_sequence_images(spark, path))
    rows = {r["image"]: r for r in images.collect()}
    assert {n for n, r in rows.items() if not r["valid"]} == {"broken.ppm", "other.bin", "empty.ppm"}
    assert bytes(rows["i0.ppm"]["data"]) == pictures["i0.ppm"].astype(np.uint8).tobytes()
    assert bytes(rows["colour.ppm"]["data"]) == pictures["colour.ppm"][..., ::-1].astype(np.uint8).tobytes()
    feats = bovw.describe_images(images, bovw.grid_gradient_descriptor(), dim=128)
    desc = bovw.explode_descriptors(feats)
    assert desc.count() == 5 * 6 + 4 + 6
    codebook, starts = bovw.train_codebooks(desc, 4, restarts=3, max_iter=20, tol=0.0)
    index = bovw.histogram(bovw.assign(desc, codebook), 4, images=images.select("image"))
    query = index.filter("image = 'i2.ppm'")
    got = [(r["image"], r["distance"]) for r in bovw.search(index, query, k=3).collect()]
    assert got[0] == ("copy.ppm", 0.0) and got[1] == ("i2.ppm", 0.0)
    assert {r["image"]: sum(r["hist"]) for r in index.collect()}["broken.ppm"] == 0

    def boom(_):
        raise RuntimeError("no such format")
    assert not bovw.decode_images(io.read_sequence_images(spark, path), boom).filter("valid").count()


def test_query_image_is_one_row(spark, tmp_dir):
    write_png(os.path.join(tmp_dir, "one.png"), np.full((8, 8), 7))
    write_png(os.path.join(tmp_dir, "two.png"), np.full((8, 8), 9))
    got = io.read_query_image(spark, os.path.join(tmp_dir, "one.png")).collect()
    assert [(r["image"], r["height"]) for r in got] == [("one.png", 8)]


def plain_lloyd(x, c, rounds, tol):
    for n in range(1, rounds + 1):
        near = np.argmin(((x[:, None, :] - c[None]) ** 2).sum(axis=2), axis=1)
        new = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        move = np.sqrt(((new - c) ** 2).sum(axis=1)).max()
        c = new
        if move < tol or move == 0:
            break
    return c, n, ((x[:, None, :] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.parametrize("rounds,tol", [(10, 1.0), (3, 0.0), (50, 0.0)])
def test_codebooks_from_many_starts_equal_plain_runs(spark, rounds, tol):
    rnd = np.random.default_rng(12)
    x = np.concatenate([rnd.normal(4 * c, 1, size=(40, 3)) for c in range(4)] + [np.full((60, 3), 2.5)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id long, descriptor array<double>")
    codebook, starts = bovw.train_codebooks(df.repartition(5), 4, restarts=6, max_iter=rounds, tol=tol, seed=9)
    hashed = df.filter("descriptor is not null").select("descriptor", *[
        F.xxhash64("descriptor", F.lit(s), F.lit(9)).alias(f"h{s}") for s in range(6)]).collect()
    plain = []
    for s in range(6):
        first = sorted((r[f"h{s}"], r["descriptor"]) for r in hashed)[:4]
        plain.append(plain_lloyd(x, np.array([d for _, d in first]), rounds, tol))
    got = starts.orderBy("start").collect()
    assert [r["rounds"] for r in got] == [p[1] for p in plain]
    assert [r["cost"] for r in got] == pytest.approx([p[2] for p in plain])
    won = int(np.argmin([p[2] for p in plain]))
    assert [r["best"] for r in got] == [s == won for s in range(6)]
    assert np.allclose([r["centre"] for r in codebook.orderBy("centre_id").collect()], plain[won][0])


def test_codebooks_of_nothing(spark):
    none = spark.createDataFrame([], "descriptor array<double>")
    codebook, starts = bovw.train_codebooks(none, 3)
    assert codebook.count() == 0 and starts.count() == 0
