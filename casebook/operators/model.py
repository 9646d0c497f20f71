"""Models on Spark ML: multi-label logistic outputs, boosted-tree classifier
with grid search, log-loss reports, accuracy.

Training data is a cached vector column; each fit is a set of distributed
jobs (tree aggregation of gradients / histograms), never a driver loop over
rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.operators.common import ordered_index
from casebook.session import cut_lineage, ship_package


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def positive_probability(col: str = "probability"):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[1]


# --------------------------------------------------------------- multi-label
def fit_multilabel(df: DataFrame, features: str, labels: Sequence[str], reg: float = 0.0,
                   max_iter: int = 100, parallelism: int = 4) -> list:
    """One independent logistic regression (sigmoid output) per label column,
    fitted on every training row. Fits are submitted from a small thread pool
    over one cached input."""
    from pyspark.ml.classification import LogisticRegression

    data = df.select(features, *[F.col(c).cast("double").alias(c) for c in labels]).persist()
    try:
        def fit(lbl):
            lr = LogisticRegression(featuresCol=features, labelCol=lbl, regParam=reg,
                                    maxIter=max_iter, family="binomial",
                                    predictionCol=f"_pred_{lbl}", probabilityCol=f"_prob_{lbl}",
                                    rawPredictionCol=f"_raw_{lbl}")
            return lr.fit(data)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            models = list(pool.map(fit, labels))
    finally:
        data.unpersist()
    return models


JOINT_WIDTH = 1500  # features of a joint fit: its curvature is a square matrix per label


def fit_multilabel_joint(df: DataFrame, features: str, labels: Sequence[str], reg: float = 0.0, max_iter: int = 50,
                         tol: float = 1e-6) -> tuple[np.ndarray, list[int]]:
    """Logistic regressions (sigmoid outputs) of all labels at once: one pass over the rows per round gives the loss,
    gradient and curvature of every label that still moves, and each takes its own Newton step (halved while its loss
    does not fall, which a pass shows for all labels together). ``reg`` is half the ridge on the mean loss, not on the
    intercept. A label stops when no component of its mean gradient passes ``tol``.

    Rows with a null label count for the other labels only. Tasks send one row per label; the driver holds a matrix
    of curvature per label, so tables wider than JOINT_WIDTH are refused (``fit_multilabel`` takes them).
    Returns (weights: labels x (features + 1), the last being the intercept; rounds per label)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    data = cut_lineage(df.filter(F.col(features).isNotNull()).select(
        vector_to_array(F.col(features)).alias("x"), F.array(*[F.col(c).cast("double") for c in labels]).alias("y")))
    width = data.agg(F.max(F.size("x")).alias("d")).first()["d"]
    if width is None:
        return np.zeros((len(labels), 1)), [0] * len(labels)
    if width > JOINT_WIDTH:
        raise ValueError(f"{width} features are too many for a joint fit, which takes {JOINT_WIDTH}")
    d = width + 1

    def one_pass(weights: dict[int, np.ndarray]) -> dict[int, tuple]:
        """label -> rows, loss, gradient, curvature (sums) at its weights."""
        def run(batches):
            total = {k: [0.0, 0.0, np.zeros(d), np.zeros((d, d))] for k in weights}
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    part = batch.slice(lo, 4096)
                    x = np.c_[part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width), np.ones(part.num_rows)]
                    y = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(labels))
                    for k, w in weights.items():
                        there = ~np.isnan(y[:, k])
                        xs, ys, z = x[there], y[there, k], x[there] @ w
                        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                        t = total[k]
                        t[0] += len(ys)
                        t[1] += float((np.logaddexp(0, z) - ys * z).sum())
                        t[2] += xs.T @ (p - ys)
                        t[3] += (xs * (p * (1 - p))[:, None]).T @ xs
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([np.r_[n, loss, g, h.ravel()].tolist() for n, loss, g, h in total.values()], pa.list_(pa.float64()))],
                names=["label", "sums"])
        rows = data.mapInArrow(run, "label int, sums array<double>").groupBy("label").agg(
            vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).collect()
        found = {r["label"]: np.array(r["sums"]) for r in rows}
        return {k: (v[0], v[1], v[2:2 + d], v[2 + d:].reshape(d, d)) for k, v in found.items()}

    ridge = np.r_[np.full(width, 2 * reg), 0.0]

    def mean(w, sums):
        n, loss, g, h = sums
        n = max(n, 1.0)
        return loss / n + float((ridge * w * w).sum()) / 2, g / n + ridge * w, h / n + np.diag(ridge)

    ship_package(df.sparkSession)
    best = {k: np.zeros(d) for k in range(len(labels))}
    at = {k: mean(best[k], v) for k, v in one_pass(best).items()}
    rounds, step, live = [0] * len(labels), {}, set(at)
    for _ in range(max_iter):
        for k in list(live):
            if np.abs(at[k][1]).max() <= tol:
                live.discard(k)
            elif k not in step:  # columns that say the same leave the curvature singular: the shortest step
                step[k] = np.linalg.lstsq(at[k][2], at[k][1], rcond=1e-10)[0]
        if not live:
            break
        trial = {k: best[k] - step[k] for k in live}
        for k, sums in one_pass(trial).items():
            rounds[k] += 1
            new = mean(trial[k], sums)
            if new[0] <= at[k][0] + 1e-12:
                best[k], at[k] = trial[k], new
                del step[k]
            elif np.abs(step[k]).max() < 1e-12:
                live.discard(k)
            else:
                step[k] = step[k] / 2
    return np.stack([best[k] for k in range(len(labels))]), rounds


def score_multilabel_joint(weights: np.ndarray, df: DataFrame, id_col: str, features: str, prefix: str = "class_") -> DataFrame:
    """Wide table id, class_0 .. class_{n-1} of probabilities, by expressions over the feature array."""
    from pyspark.ml.functions import vector_to_array
    x = df.select(id_col, vector_to_array(F.col(features)).alias("_x"))

    def probability(w):
        at = F.array(*[F.lit(float(v)) for v in w[:-1]])
        z = F.aggregate(F.zip_with("_x", at, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.lit(float(w[-1]))
        return X.sigmoid(z)
    return x.select(id_col, *[probability(w).alias(f"{prefix}{k}") for k, w in enumerate(weights)])


def score_multilabel(models: list, df: DataFrame, id_col: str, features: str,
                     prefix: str = "class_") -> DataFrame:
    """Wide table id, class_0 .. class_{n-1} of positive-class probabilities."""
    out = df.select(id_col, features)
    names = []
    for i, m in enumerate(models):
        out = m.transform(out)
        name = f"{prefix}{i}"
        out = out.withColumn(name, positive_probability(m.getProbabilityCol()))
        out = out.drop(m.getProbabilityCol(), m.getPredictionCol(), m.getRawPredictionCol())
        names.append(name)
    return out.select(id_col, *names)


# ------------------------------------------------------------------ log-loss
def log_loss_by_class(df: DataFrame, class_col: str, y: str, p: str,
                      eps: float = X.LOG_LOSS_EPS, digits: int | None = 6) -> DataFrame:
    """Per class: rows and summed element log-loss, plus the mean over
    classes. The mean is one aggregated row brought back as a literal."""
    from casebook.session import reuse

    per = reuse(df.groupBy(class_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(X.log_loss(F.col(y).cast("double"), F.col(p), eps)).alias("loss")))
    mean = per.agg(F.avg("loss")).first()[0]
    out = per.withColumn("mean_loss", F.lit(mean).cast("double"))
    if digits is not None:
        out = out.withColumn("loss", F.round("loss", digits)).withColumn(
            "mean_loss", F.round("mean_loss", digits))
    return out


def log_loss_wide(df: DataFrame, labels: Sequence[str], probs: Sequence[str],
                  eps: float = X.LOG_LOSS_EPS) -> DataFrame:
    """Wide labels/probabilities -> (class, loss) rows and their mean, from
    one aggregate pass (a single row holding every class sum)."""
    aggs = [F.sum(X.log_loss(F.col(l).cast("double"), F.col(p), eps)).alias(f"c{i}")
            for i, (l, p) in enumerate(zip(labels, probs))]
    row = df.agg(*aggs).first()
    losses = [float(row[f"c{i}"]) for i in range(len(aggs))]
    mean = sum(losses) / len(losses) if losses else None
    spark = df.sparkSession
    return spark.createDataFrame([(i, v, mean) for i, v in enumerate(losses)],
                                 "class int, loss double, mean_loss double")


# ----------------------------------------------------------- classification
def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> float:
    row = df.agg(F.avg((F.col(label).cast("double") == F.col(prediction).cast("double"))
                       .cast("double")).alias("acc")).first()
    return float(row["acc"])


def estimator(kind: str = "gbt", features: str = "features", label: str = "label", seed: int = 1,
              layers: Sequence[int] | None = None):
    """The classifiers the original authors compared, behind one argument.
    ``layers`` (inputs, hidden, classes) is needed for the network ("mlp")."""
    from pyspark.ml import classification as C
    common = dict(featuresCol=features, labelCol=label)
    if kind == "gbt":
        return C.GBTClassifier(seed=seed, **common)
    if kind == "logistic":
        return C.LogisticRegression(**common)
    if kind == "forest":
        return C.RandomForestClassifier(seed=seed, **common)
    if kind == "mlp":
        if not layers:
            raise ValueError("mlp needs its layers")
        return C.MultilayerPerceptronClassifier(layers=list(layers), seed=seed, **common)
    raise ValueError(kind)


def grid_search(train: DataFrame, est, grid: dict, folds: int = 4, parallelism: int = 2,
                label: str = "label", seed: int = 1, fold_col: str | None = None):
    """Exhaustive grid + k-fold cross-validation on accuracy; refits the best
    setting on all rows. Returns the CrossValidatorModel (``bestModel``,
    ``avgMetrics``). Settings of boosted trees that differ in their tree count
    only are prefixes of one fit where folds are given by ``fold_col``: one fit
    a fold with the most trees serves them all. For many small fits see
    ``boosting.search``."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    settings = builder.build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    if fold_col and isinstance(est, GBTClassifier) and len(grid.get("maxIter", ())) > 1:
        return _prefix_search(train, est, settings, ev, folds, parallelism, fold_col)
    cv = CrossValidator(estimator=est, estimatorParamMaps=settings, evaluator=ev,
                        numFolds=folds, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(train)


def first_trees(model, n: int):
    """The boosted classifier of the first ``n`` trees of ``model`` (trees and weights as they are)."""
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel

    whole, gateway = model._java_obj, SparkContext._gateway
    trees = whole.trees()
    part = gateway.new_array(SparkContext._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for k in range(n):
        part[k], weights[k] = trees[k], whole.treeWeights()[k]
    made = SparkContext._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{whole.uid()}_{n}", part, weights, whole.numFeatures(), 2)
    for name in ("FeaturesCol", "PredictionCol", "ProbabilityCol", "RawPredictionCol"):
        getattr(made, f"set{name}")(getattr(whole, f"get{name}")())
    return GBTClassificationModel(made)


def _prefix_search(train, est, settings, ev, folds, parallelism, fold_col):
    from pyspark.ml.tuning import CrossValidator, CrossValidatorModel

    families: dict[tuple, list[int]] = {}
    for j, s in enumerate(settings):
        families.setdefault(tuple(sorted((p.name, v) for p, v in s.items() if p.name != "maxIter")), []).append(j)
    length = [s[est.maxIter] for s in settings]

    def one(job):
        members, fold = job
        longest = max(members, key=lambda j: length[j])
        fitted = est.fit(train.filter(F.col(fold_col) != fold), settings[longest])
        valid = train.filter(F.col(fold_col) == fold)
        return [(j, ev.evaluate(first_trees(fitted, length[j]).transform(valid))) for j in members]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scores = list(pool.map(one, [(m, f) for m in families.values() for f in range(folds)]))
    total = [0.0] * len(settings)
    for j, score in (x for part in scores for x in part):
        total[j] += score / folds
    best = max(range(len(settings)), key=lambda j: total[j])
    cv = CrossValidator(estimator=est, estimatorParamMaps=settings, evaluator=ev, numFolds=folds)
    return cv._copyValues(CrossValidatorModel(est.fit(train, settings[best]), total))


def search_results(cv_model) -> DataFrame:
    """One row per setting of a grid search: its parameters, mean accuracy over the folds, best (true once)."""
    spark = SparkSession.getActiveSession()
    rows = [({p.name: str(v) for p, v in setting.items()}, float(score))
            for setting, score in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, strict=True)]
    first = max(range(len(rows)), key=lambda k: rows[k][1])
    return spark.createDataFrame([(s, a, k == first) for k, (s, a) in enumerate(rows)],
                                 "setting map<string,string>, accuracy double, best boolean")


def stratified_folds(df: DataFrame, key: str, k: int, seed: int = 1, name: str = "fold",
                     label: str = "label") -> DataFrame:
    """Fold numbers 0..k-1 with equal shares of each label: rows are numbered by
    (label, hash of the key, key) without gaps, and the number's remainder is
    the fold, so folds of one label differ by one row at most, under any
    partitioning. ``key`` must be unique."""
    numbered = ordered_index(df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), [label, "_h", key], name="_nth")
    return numbered.withColumn(name, (F.col("_nth") % k).cast("int")).drop("_h", "_nth")
