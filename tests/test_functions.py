"""Golden values for the expression library (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.operators import prep, stats


def test_normal_quantiles():
    assert X.normal_quantile(0.95) == pytest.approx(1.9599639845, abs=1e-9)
    assert X.normal_quantile(0.95, two_sided=False) == pytest.approx(1.6448536270, abs=1e-9)


def test_share_interval_golden(spark):
    df = spark.createDataFrame([("a", 1)] * 6 + [("a", 0)] * 4 + [("b", 1)] * 3 + [("b", 0)] * 7,
                               "k string, f int")
    got = {r["k"]: r for r in stats.share_interval(df, "k", "f", digits=None).collect()}
    assert got["a"]["lo"] == pytest.approx(0.2963637, abs=1e-6)
    assert got["a"]["hi"] == pytest.approx(0.9036363, abs=1e-6)
    assert got["b"]["lo"] == pytest.approx(0.0159742, abs=1e-6)
    assert got["b"]["hi"] == pytest.approx(0.5840258, abs=1e-6)
    assert got["a"]["n"] == 10 and got["a"]["m"] == 6


def test_size_counts_null_flags(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 0)], "k string, f int")
    r = stats.group_shares(df, "k", "f").first()
    assert r["n"] == 3 and r["m"] == 1 and r["p"] == pytest.approx(0.5)


def test_two_share_z_golden(spark):
    row = spark.range(1).select(
        X.two_share_z(F.lit(6), F.lit(10), F.lit(3), F.lit(10)).alias("z1"),
        X.two_share_z(F.lit(60), F.lit(100), F.lit(30), F.lit(100)).alias("z2")).first()
    assert row["z1"] == pytest.approx(1.3483997, abs=1e-6)
    assert row["z2"] == pytest.approx(4.2640143, abs=1e-6)


def test_ztest_against_control(spark):
    df = spark.createDataFrame([("i", 1)] * 60 + [("i", 0)] * 40 + [("t", 1)] * 30 + [("t", 0)] * 70,
                               "k string, f int")
    r = stats.two_share_ztest(df, "k", "f", control="i").first()
    assert r["treatment"] == "t" and r["z"] == pytest.approx(4.264014, abs=1e-6)
    assert r["equal_shares"] is False


def test_chi2_golden(spark):
    row = spark.range(1).select(
        X.chi2_distance(F.array(*map(F.lit, [2.0, 0.0, 1.0])), F.array(*map(F.lit, [1.0, 1.0, 1.0]))).alias("a"),
        X.chi2_distance(F.array(*map(F.lit, [0.0, 0.0, 0.0])), F.array(*map(F.lit, [1.0, 1.0, 1.0]))).alias("b"),
        X.chi2_distance(F.array(*map(F.lit, [4.0, 2.0])), F.array(*map(F.lit, [4.0, 2.0]))).alias("c"),
    ).first()
    assert row["a"] == pytest.approx(1.3333333, abs=1e-6)
    assert row["b"] == pytest.approx(3.0, abs=1e-6)
    assert row["c"] == 0


def test_age_bands(spark):
    df = spark.createDataFrame([(17,), (25,), (40,), (64,), (65,), (None,)], "age int")
    rows = df.select(*X.band_flags("age", X.AGE_BANDS)).collect()
    got = ["".join(str(v) for v in r) for r in rows]
    assert got == ["1000", "0100", "0110", "0010", "0001", "0000"]


def test_experience_bands_with_year_fix(spark):
    df = spark.createDataFrame([(2,), (3,), (10,), (20,), (2006,)], "e int")
    rows = df.select(*X.band_flags(X.fix_year("e"), X.EXPERIENCE_BANDS)).collect()
    assert ["".join(str(v) for v in r) for r in rows] == ["1000", "0100", "0010", "0001", "0010"]


def test_binary_map_null_is_one(spark):
    df = spark.createDataFrame([("M",), ("F",), (None,)], "g string")
    assert [r[0] for r in df.select(X.binary_map("g", "M")).collect()] == [0, 1, 1]


def test_constant_minmax_is_zero(spark):
    df = spark.createDataFrame([(7.0,), (7.0,), (7.0,)], "x double")
    assert [r[0] for r in prep.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0, 0.0]


def test_minmax_fit_on_train_no_clipping(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    test = spark.createDataFrame([(20.0,), (-5.0,)], "x double")
    assert [r[0] for r in prep.minmax_scale(test, ["x"], fit_on=train).collect()] == [2.0, -0.5]


def test_first_wins_dedup(spark):
    train = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id long, x double")
    test = spark.createDataFrame([(1, 99.0), (3, 30.0)], "id long, x double")
    got = {r["id"]: (r["split"], r["x"]) for r in
           prep.union_first_wins([("train", train), ("test", test)], "id").collect()}
    assert got == {1: ("train", 10.0), 2: ("train", 20.0), 3: ("test", 30.0)}


def test_hash_split_is_partition_invariant(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r["k"] for r in prep.hash_split(df.repartition(1), "k").filter("is_valid").collect()}
    b = {r["k"] for r in prep.hash_split(df.repartition(13), "k").filter("is_valid").collect()}
    assert a == b and 300 < len(a) < 500


def test_constant_drop(spark):
    from casebook.operators import graph, profile
    wide = spark.createDataFrame([(1, 5, 1.0), (2, 5, 2.0)], "id long, c int, x double")
    assert profile.drop_constant_columns(wide, keep=["id"]).columns == ["id", "x"]
    adj = spark.createDataFrame([("A", ["B", "C"])], "v string, n array<string>")
    assert graph.edges_from_adjacency(adj, "v", "n").count() == 2


def test_first_wins_dedup_partition_invariant(spark):
    from pyspark.sql import functions as F
    base = spark.range(3000).select((F.col("id") % 1000).alias("id"), F.col("id").alias("x"))
    train, test = base.filter("x < 1500"), base.filter("x >= 1200")
    def run(n):
        out = prep.union_first_wins([("train", train.repartition(n)), ("test", test.repartition(n))],
                                    "id", tie=["x"])
        return sorted(tuple(r) for r in out.collect())
    assert run(1) == run(4) == run(32)


def test_first_wins_inside_one_part(spark):
    """Duplicates inside a part, no tie columns: the same row under any partitioning."""
    part = spark.range(600).selectExpr("id % 50 AS id", "id * 7 % 601 AS x", "id AS y")
    runs = [sorted(map(tuple, prep.union_first_wins([("a", part.repartition(n))], "id").collect())) for n in (1, 3, 16)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 50


def test_ztest_without_variance(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)] * 2, "type string, f int")
    assert stats.two_share_ztest(df, "type", "f", "a").first()["z"] is None


def test_correlation_names_with_underscores(spark):
    from casebook.operators import profile
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], "x__1 double, `a.b` double")
    assert {(r.a, r.b) for r in profile.correlation(df, ["x__1", "a.b"]).collect()} == {
        (a, b) for a in ("x__1", "a.b") for b in ("x__1", "a.b")}


def test_scaling_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, x double")
    assert [r.x for r in prep.minmax_scale(df, ["x"]).collect()] == [None, None]
    assert [r.x for r in prep.maxabs_scale(df, ["x"]).collect()] == [None, None]


def test_category_with_a_dot(spark):
    df = spark.createDataFrame([(1, "a.b"), (2, "c")], "id long, k string")
    wide = prep.auto_prepare(df)
    rows = prep.to_sparse_long(wide, "id", [c for c in wide.columns if c != "id"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "k_a.b", 1.0), (2, "k_c", 1.0)]


def test_stratified_folds(spark):
    from collections import Counter

    from casebook.operators import model
    df = spark.range(203).selectExpr("id", "CAST(id % 7 = 0 AS double) AS label")
    runs = []
    for n in (1, 4, 32):
        rows = model.stratified_folds(df.repartition(n), "id", 4).collect()
        runs.append(sorted((r.id, r.fold) for r in rows))
        for label in (0.0, 1.0):
            sizes = Counter(r.fold for r in rows if r.label == label).values()
            assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    assert runs[0] == runs[1] == runs[2]
