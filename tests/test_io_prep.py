"""Readers, writers, profiling, encoding."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators import prep, profile
from casebook.sources import io


def test_cp1251_semicolon_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "acc.csv")
    with open(path, "wb") as f:
        f.write("Участник 1;Участник 2\nИванов;Петров\nПетров;Сидоров\n".encode("cp1251"))
    df = io.read_delimited(spark, path, "`Участник 1` string, `Участник 2` string", sep=";",
                           encoding="cp1251")
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"
    assert [tuple(r) for r in df.collect()] == [("Иванов", "Петров"), ("Петров", "Сидоров")]


def test_null_tokens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.csv")
    with open(path, "w") as f:
        f.write("id,x,s\n1,?,a\n2,3.5,NA\n3,,?\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()),
                           T.StructField("s", T.StringType())])
    rows = io.read_with_null_tokens(spark, path, schema, tokens=["?"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, "a"), (2, 3.5, None), (3, None, None)]


def test_request_log_and_scored_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log.txt")
    with open(path, "w") as f:
        f.write("1,/index,1\n2,/test,0\n")
    df = io.read_request_log(spark, path)
    assert df.columns == ["N", "type", "from_mobile"] and df.count() == 2
    io.write_scored_csv(df, os.path.join(tmp_dir, "out"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "out"))
    assert back.columns == ["N", "type", "from_mobile"]


def test_sequence_file_round_trip(spark, tmp_dir):
    sc = spark.sparkContext
    path = os.path.join(tmp_dir, "seq")
    sc.parallelize([("a.jpg", bytearray(b"\x01\x02")), ("b.jpg", bytearray(b"\x03"))]).saveAsSequenceFile(path)
    got = {r["image"]: bytes(r["content"]) for r in io.read_sequence_images(spark, path, 2).collect()}
    assert got == {"a.jpg": b"\x01\x02", "b.jpg": b"\x03"}


def test_parquet_write_fails_when_present(spark, tmp_dir):
    df = spark.range(3)
    io.write_parquet(df, os.path.join(tmp_dir, "x"))
    try:
        io.write_parquet(df, os.path.join(tmp_dir, "x"))
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "PATH_ALREADY_EXISTS" in str(e)


def test_auto_prepare(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5, "a", None, "train"), (2, 3.0, 5, "b", "q", "train"), (3, 2.0, 5, "a", "r", "test")],
        "id long, x double, c int, s string, gone string, split string")
    out = prep.auto_prepare(df, "id", "split")
    assert sorted(out.columns) == sorted(["id", "split", "x", "s_a", "s_b"])
    rows = {r["id"]: (r["x"], r["s_a"], r["s_b"]) for r in out.collect()}
    assert rows == {1: (0.0, 1, 0), 2: (1.0, 0, 1), 3: (0.5, 1, 0)}


def test_one_hot_unseen_is_zero(spark):
    fit = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    cats = prep.categories(fit, ["v"])
    app = spark.createDataFrame([("b",), ("z",), (None,)], "v string")
    rows = [tuple(r) for r in prep.one_hot(app, ["v"], cats).collect()]
    assert rows == [(0, 1, 0), (0, 0, 0), (0, 0, 0)]


def test_binariser_unseen_zero_vector(spark):
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    fit = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    si = StringIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc", handleInvalid="keep").fit(fit)
    ohe = OneHotEncoder(inputCol="i", outputCol="o", dropLast=True, handleInvalid="error").fit(si.transform(fit))
    app = spark.createDataFrame([("b",), ("z",), (None,)], "v string")
    vecs = [r["o"].toArray().tolist() for r in ohe.transform(si.transform(app)).collect()]
    assert vecs == [[0.0, 1.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def test_modes_tie_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "v string")
    assert profile.modes(df, ["v"]).first()["mode"] == "a"
    filled = profile.fill_with_mode(df, ["v"])
    assert filled.filter("v is null").count() == 0


def test_null_profile_and_drop(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3.0, "y")], "a long, b double, c string")
    got = {r["column"]: r["null_count"] for r in profile.null_counts(df).collect()}
    assert got == {"a": 0, "b": 1, "c": 0}
    assert profile.drop_null_columns(df).columns == ["a", "c"]


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "x double, y double")
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation(df, ["x", "y"]).collect()}
    assert got[("x", "y")] == 1.0 and got[("x", "x")] == 1.0


def test_correlation_of_a_wide_table_equals_corr(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 300)) + 1e6 * np.arange(300)
    rows = [[None if (i * 7 + j) % 11 == 0 else float(v) for j, v in enumerate(r)] for i, r in enumerate(base)]
    for r in rows:
        r[3], r[4] = 5.25, None  # no spread, no value
    rows[9][5], rows[10][6] = float("nan"), float("inf")
    cols = [f"c.{j}" for j in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in cols)).repartition(5)
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation(df, cols, digits=None).collect()}
    assert len(got) == 300 * 300
    few = cols[:9] + cols[290:292]
    want = profile.correlation(df, few, digits=None).collect()
    for r in want:
        mine = got[r["a"], r["b"]]
        if r["corr"] is None or mine is None:
            assert mine is None and r["corr"] is None, r
        else:
            assert np.isclose(mine, r["corr"], rtol=0, atol=1e-7, equal_nan=True), (r, mine)
    empty = profile.correlation(df.limit(0), cols, digits=None)
    assert empty.filter("corr IS NOT NULL").isEmpty()


def test_cardinality_exact_and_approx(spark):
    df = spark.range(1000).selectExpr("id % 37 AS a", "cast(id % 5 AS string) AS b")
    exact = {r["column"]: r["n_distinct"] for r in profile.cardinality(df, ["a", "b"]).collect()}
    approx = {r["column"]: r["n_distinct"] for r in profile.cardinality(df, ["a", "b"], exact=False).collect()}
    assert exact == {"a": 37, "b": 5} and approx == {"a": 37, "b": 5}


def test_auto_prepare_long_equals_wide(spark):
    rows = [(i, "train" if i % 3 else "test", float(i % 5), f"v.{i % 4}", f"w{i}", 7, None if i == 2 else 1.0)
            for i in range(30)]
    df = spark.createDataFrame(rows, "id long, split string, x double, s string, t string, c int, n double")
    for fit_on in ("all", "train"):
        wide = prep.auto_prepare(df, "id", "split", fit_on)
        want = prep.to_sparse_long(wide, "id", [c for c in wide.columns if c not in ("id", "split")])
        got = prep.auto_prepare_long(df, "id", "split", fit_on).select("id", "feature", "value")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_draws_have_a_fixed_size_under_any_partitioning(spark):
    import hashlib
    rows = [(i, f"r{i}") for i in range(37)]
    df = spark.createDataFrame(rows, "id long, v string")
    want = {}
    for k in range(200):
        at = int(hashlib.md5(f"5:{k}".encode()).hexdigest()[:12], 16) % 37
        want[at] = want.get(at, 0) + 1
    for parts in (1, 6):
        got = {r["id"]: r["times"] for r in prep.draw_rows(df.repartition(parts), ["id"], 200, 5).collect()}
        assert got == want and sum(got.values()) == 200
    assert prep.draw_rows(df.filter("id < 0"), ["id"], 10, 5).count() == 0


def test_binarise_one_two_and_more_classes(spark):
    df = spark.createDataFrame([("a", "x", "k", 1), ("b", "y", "k", 2), (None, "z", "k", 3)], "two string, many string, one string, id int")
    out = prep.binarise(df, ["two", "many", "one"]).orderBy("id")
    assert out.columns == ["id", "two_b", "many_x", "many_y", "many_z", "one_k"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 1, 0, 0, 0), (2, 1, 0, 1, 0, 0), (3, 0, 0, 0, 1, 0)]
    unseen = spark.createDataFrame([("q", 9)], "two string, id int")
    assert [tuple(r) for r in prep.binarise(unseen, ["two"], {"two": ["a", "b"]}).collect()] == [(9, 0)]


def test_pick_groups_and_side_by_side(spark):
    from casebook.operators import stats
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("c", 1), ("c", 0), ("c", 0)], "k string, f int")
    assert {r["k"] for r in stats.pick_groups(stats.group_shares(df, "k", "f"), "k", ["a", "c"]).collect()} == {"a", "c"}
    row = stats.side_by_side(df, "k", "f", ["c", "a"]).first()
    assert (row["c_p"], row["c_m"], row["c_n"], row["a_p"], row["a_m"], row["a_n"]) == (1 / 3, 1, 3, 0.5, 1, 2)


def test_unseen_category_is_an_error_where_asked(spark):
    from casebook.operators import policy
    from tests.test_model import _policies
    train = policy.prepare(_policies(spark, 60))
    enc = policy.fit_encoders(train)
    other = train.limit(1).withColumn("POLICY_SALES_CHANNEL_GROUP", F.lit(99))
    with pytest.raises(Exception, match="(?i)unseen label"):
        policy.design_matrix(other, enc).collect()
