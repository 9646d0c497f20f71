"""Models on small separable data; renewal recipe end to end."""

import random

import pytest
from pyspark.sql import functions as F

from casebook.operators import boosting, model, policy, prep


def test_multilabel_separable(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        x, y = rnd.uniform(-1, 1), rnd.uniform(-1, 1)
        rows.append((i, x, y, int(x > 0), int(y > 0)))
    df = spark.createDataFrame(rows, "id long, x double, y double, l0 int, l1 int")
    df = model.assemble(df, ["x", "y"])
    models = model.fit_multilabel(df, "features", ["l0", "l1"])
    scored = model.score_multilabel(models, df, "id", "features").join(df.select("id", "l0", "l1"), "id")
    acc0 = scored.select(F.avg(((F.col("class_0") > 0.5).cast("int") == F.col("l0")).cast("double"))).first()[0]
    acc1 = scored.select(F.avg(((F.col("class_1") > 0.5).cast("int") == F.col("l1")).cast("double"))).first()[0]
    assert acc0 > 0.97 and acc1 > 0.97
    rep = model.log_loss_wide(scored, ["l0", "l1"], ["class_0", "class_1"]).collect()
    assert len(rep) == 2 and all(r["loss"] >= 0 for r in rep)


def test_log_loss_value(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.2)], "c string, y int, p double")
    r = model.log_loss_by_class(df, "c", "y", "p", digits=None).first()
    import math
    assert r["loss"] == pytest.approx(-math.log(0.9 + 1e-8) - math.log(0.8 + 1e-8), rel=1e-9)


def _policies(spark, n=600, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        age = rnd.randint(18, 80)
        renewed = int(age > 40)
        rows.append((i, "TRAIN" if i < n * 0.8 else "TEST ", renewed, 1, 12, rnd.randint(1, 60), rnd.randint(1, 4),
                     rnd.choice(["Москва", "Other"]), age,
                     rnd.choice([1, 5, 12, 25, 2005]), rnd.choice(["m1", "m2"]) if i < n * 0.8 else "unseen",
                     rnd.choice(["x", "y"]), rnd.uniform(50, 300), rnd.uniform(1e5, 1e6), rnd.randint(0, 1),
                     rnd.uniform(0, 5), rnd.uniform(0, 1e4), rnd.uniform(-0.1, 0.1),
                     rnd.choice(["r1", "r2", "r3"]), "int", rnd.choice(["M", "F"]),
                     rnd.choice(["0", "1", "N", "n/d"]), rnd.choice(["0", "N", "n/d"]),
                     rnd.choice(["0", "1", "N"]), rnd.choice(["0", "n/d"]),
                     rnd.choice(["1", "2", "N"]), rnd.randint(0, 1), rnd.randint(0, 1), 0, 0))
    schema = ("POLICY_ID long, DATA_TYPE string, POLICY_IS_RENEWED int, POLICY_BEGIN_MONTH int, "
              "POLICY_END_MONTH int, POLICY_SALES_CHANNEL int, POLICY_SALES_CHANNEL_GROUP int, "
              "POLICY_BRANCH string, POLICY_MIN_AGE int, POLICY_MIN_DRIVING_EXPERIENCE int, "
              "VEHICLE_MAKE string, VEHICLE_MODEL string, VEHICLE_ENGINE_POWER double, "
              "VEHICLE_SUM_INSURED double, VEHICLE_IN_CREDIT int, CLAIM_AVG_ACC_ST_PRD double, "
              "POLICY_DEDUCT_VALUE double, POLICY_PRICE_CHANGE double, CLIENT_REGISTRATION_REGION string, "
              "POLICY_INTERMEDIARY string, INSURER_GENDER string, POLICY_CLM_N string, "
              "POLICY_CLM_GLT_N string, POLICY_PRV_CLM_N string, POLICY_PRV_CLM_GLT_N string, "
              "POLICY_YEARS_RENEWED_N string, CLIENT_HAS_DAGO int, CLIENT_HAS_OSAGO int, "
              "POLICY_COURT_SIGN int, POLICY_HAS_COMPLAINTS int")
    return spark.createDataFrame(rows, schema)


def test_renewal_recipe(spark):
    pol = policy.prepare(_policies(spark))
    train = prep.take_split(pol, "DATA_TYPE", "TRAIN")
    test = prep.take_split(pol, "DATA_TYPE", "TEST ")
    assert train.count() == 480 and test.count() == 120  # trailing blank matters
    grid = {"maxIter": [5, 10], "maxDepth": [3], "featureSubsetStrategy": ["all"]}
    enc, cv, acc = policy.fit(train, grid=grid, folds=2)
    assert len(cv.avgMetrics) == 2 and acc > 0.9
    out = policy.score(enc, cv, test.drop("POLICY_IS_RENEWED"))
    assert out.columns == ["POLICY_ID", "POLICY_IS_RENEWED", "POLICY_IS_RENEWED_PROBABILITY"]
    assert out.count() == 120  # unseen vehicle make scored as all zeros, not an error


def test_renewal_query_searches_the_whole_grid(spark, monkeypatch):
    from casebook.plans import catalogue

    class Stop(Exception):
        pass

    def search(train, id_col, grid, folds, rows, **kw):
        assert grid == policy.GRID and [len(v) for v in grid.values()] == [3, 3, 3] and folds == 4
        assert rows == boosting.FIT_ROWS
        raise Stop

    monkeypatch.setattr(boosting, "search", search)
    with pytest.raises(Stop):
        catalogue.QUERIES["renewal_scores"](spark, "/root/testdata/sf0.001")


def _noisy(spark, n=300):
    rnd = random.Random(4)
    rows = [(i, float(rnd.randint(0, 1)), rnd.gauss(0, 1), float(rnd.choice([0, 0, 0, 2])), i % 3) for i in range(n)]
    rows = [(i, a, b, c, int((a > 0) ^ (b > 0.3)) if rnd.random() < 0.85 else 1, f) for i, a, b, c, f in rows]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int, fold int")
    return model.assemble(df.withColumn("label", F.col("label").cast("double")), ["a", "b", "c"])


def test_search_over_trees_equals_separate_fits(spark):
    df = _noisy(spark)
    grid = {"maxIter": [3, 9], "maxDepth": [2, 4], "featureSubsetStrategy": ["0.6", "all"]}
    found = boosting.search(df, "id", grid, folds=3, seed=5)
    assert found.fits == 12 and len(found.settings) == 8
    x, y, part = boosting.fitting_rows(df, "id", "features", "label", "fold", 1000)
    data = boosting.binned(x)
    for setting, got in zip(found.settings, found.avgMetrics, strict=True):
        each = []
        for f in range(3):  # one fit of its own for every setting and fold, scored from its trees' raw cuts
            trees, _ = boosting.grow(data, y, part != f, setting["maxDepth"],
                                     boosting.share_of(setting["featureSubsetStrategy"]), [setting["maxIter"]], 5)
            right = (boosting.margins(x[part == f], trees.arrays()) >= 0) == (y[part == f] == 1)
            each.append(right.mean())
        assert got == pytest.approx(sum(each) / 3, abs=1e-12)
    assert found.bestIndex == max(range(8), key=lambda k: found.avgMetrics[k])
    assert [r["best"] for r in found.results(spark).collect()].count(True) == 1
    scored = found.bestModel.transform(df).collect()
    assert sum(r["prediction"] == r["label"] for r in scored) / len(scored) > 0.85


def test_search_has_the_same_rows_under_any_partitioning(spark):
    df = _noisy(spark)
    grid = {"maxIter": [4], "maxDepth": [3], "featureSubsetStrategy": ["0.6"]}
    a, b = (boosting.search(d, "id", grid, folds=2, rows=90) for d in (df, df.repartition(7)))
    assert a.avgMetrics == b.avgMetrics
    assert all((u == v).all() for u, v in zip(a.bestModel.arrays, b.bestModel.arrays, strict=True))


def test_boosted_tree_takes_the_best_cut(spark):
    rnd = random.Random(8)
    import numpy as np
    x = np.array([[rnd.choice([0, 0, 1, 3]), rnd.gauss(0, 1)] for _ in range(40)], dtype=float)
    y = np.array([float(a[0] > 0 or a[1] > 1) if rnd.random() < 0.9 else 0.0 for a in x])
    trees, _ = boosting.grow(boosting.binned(x, bins=64), y, np.ones(40, dtype=bool), 1, 1.0, [1], 0)

    def part(mask):
        g, h = (0.5 - y[mask]).sum(), 0.25 * mask.sum()
        return g * g / (h + boosting.RIDGE), h
    best = max(((part(x[:, f] <= c)[0] + part(x[:, f] > c)[0], -f, -c) for f in (0, 1)
                for c in boosting.cut_points(x[:, f], 64)
                if min(part(x[:, f] <= c)[1], part(x[:, f] > c)[1]) >= boosting.LEAST_CURVATURE))
    assert (trees.feature[0], trees.cut[0]) == (-best[1], pytest.approx(-best[2]))
    left = x[:, trees.feature[0]] <= trees.cut[0]
    want = -boosting.ETA * (0.5 - y[left]).sum() / (0.25 * left.sum() + boosting.RIDGE)
    assert trees.value[1] == pytest.approx(want)


def test_search_without_rows(spark):
    df = _noisy(spark).filter("id < 0")
    found = boosting.search(df, "id", {"maxIter": [2], "maxDepth": [2], "featureSubsetStrategy": ["all"]}, folds=2)
    assert found.avgMetrics == [0.0]
    assert {r["probability"] for r in found.bestModel.transform(_noisy(spark, 5)).collect()} == {0.5}


def test_prefix_search_equals_cross_validator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    df = _noisy(spark, 200).coalesce(1).persist()
    est = model.estimator("gbt", seed=3)
    got = model.grid_search(df, est, {"maxIter": [2, 5], "maxDepth": [2]}, folds=3, fold_col="fold")
    plain = CrossValidator(estimator=est, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), numFolds=3,
                           estimatorParamMaps=ParamGridBuilder().addGrid(est.maxIter, [2, 5]).addGrid(est.maxDepth, [2]).build(),
                           foldCol="fold").fit(df)
    assert got.avgMetrics == pytest.approx(plain.avgMetrics)
    assert got.bestModel.getNumTrees == plain.bestModel.getNumTrees
    assert model.search_results(got).filter("best").count() == 1
    df.unpersist()


@pytest.mark.parametrize("kind", ["logistic", "forest", "mlp"])
def test_other_classifiers(spark, kind):
    df = _noisy(spark).withColumn("label", (F.col("a") > 0).cast("double"))
    fitted = model.estimator(kind, seed=2, layers=[3, 4, 2]).fit(df)
    assert model.accuracy(fitted.transform(df), "label") > 0.95


def test_joint_fit_equals_single_fits(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        a, b, c = rnd.gauss(0, 1), rnd.gauss(2, 3), rnd.randint(0, 1)
        rows.append((i, a, b, float(c), 1.0 - c, int(a + rnd.gauss(0, 1) > 0), int(b + c + rnd.gauss(0, 3) > 2),
                     rnd.randint(0, 1) if i % 7 else None))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, l0 int, l1 int, l2 int")
    df = model.assemble(df, ["a", "b", "c", "d"])  # c and d say the same
    labels = ["l0", "l1", "l2"]
    for reg in (0.0, 0.05):
        weights, rounds = model.fit_multilabel_joint(df.repartition(3), "features", labels, reg=reg)
        assert weights.shape == (3, 5) and max(rounds) < 15
        got = {r["id"]: r for r in model.score_multilabel_joint(weights, df, "id", "features").collect()}
        for k, name in enumerate(labels):
            from pyspark.ml.classification import LogisticRegression
            known = df.filter(F.col(name).isNotNull()).withColumn("y", F.col(name).cast("double"))
            one = LogisticRegression(labelCol="y", regParam=2 * reg, maxIter=500, tol=1e-12, standardization=False).fit(known)
            for r in one.transform(df).select("id", model.positive_probability().alias("p")).collect():
                assert got[r["id"]][f"class_{k}"] == pytest.approx(r["p"], abs=2e-4)
    assert model.fit_multilabel_joint(df.filter("id < 0"), "features", labels)[1] == [0, 0, 0]
