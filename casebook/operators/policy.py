"""Policy-renewal recipe: one ``prepare`` for train and test, encoders fitted
once on train, boosted trees with grid search, scored output.

All column edits collapse into one Project over the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.operators import boosting
from casebook.operators import model as M
from casebook.operators import prep

# Fixed values of the original recipe: names, codes and column groups.
BRANCH_HOME = "Москва"
GENDER_ZERO = "M"
UNDEFINED_CODES = ("n/d", "N")
DROPPED = ("POLICY_BEGIN_MONTH", "POLICY_END_MONTH", "POLICY_SALES_CHANNEL", "POLICY_INTERMEDIARY")
NUMERIC = ("VEHICLE_ENGINE_POWER", "VEHICLE_SUM_INSURED", "CLAIM_AVG_ACC_ST_PRD",
           "POLICY_YEARS_RENEWED_N", "POLICY_DEDUCT_VALUE", "POLICY_PRICE_CHANGE")
BINARY = ("POLICY_BRANCH", "INSURER_GENDER", "AGE_18-25", "AGE_25-40", "AGE_40-65", "AGE_65+",
          "DRV_EXP_0-3", "DRV_EXP_3-10", "DRV_EXP_10-20", "DRV_EXP_20+",
          "VEHICLE_IN_CREDIT", "CLIENT_HAS_DAGO", "CLIENT_HAS_OSAGO",
          "POLICY_COURT_SIGN", "POLICY_HAS_COMPLAINTS")
CATEGORY_NUM = ("POLICY_SALES_CHANNEL_GROUP",)
CLAIM_COLS = ("POLICY_CLM_N", "POLICY_CLM_GLT_N", "POLICY_PRV_CLM_N", "POLICY_PRV_CLM_GLT_N")
CLAIM_REPLACED = ("POLICY_CLM_N", "POLICY_CLM_GLT_N")
OWN_VOCAB = ("CLIENT_REGISTRATION_REGION", "VEHICLE_MAKE", "VEHICLE_MODEL")
# grid of the original search: trees, depth, feature share
GRID = {"maxIter": [50, 100, 150], "maxDepth": [6, 8, 10],
        "featureSubsetStrategy": ["0.6", "0.8", "1.0"]}


def prepare(df: DataFrame, fix_year_values: bool = True,
            replace_cols: Sequence[str] = CLAIM_REPLACED) -> DataFrame:
    """Row-wise feature edits shared by train and test: binary maps, age and
    experience bands, year repair, 'n/d' -> 'N', renewal count as int."""
    exp = F.col("POLICY_MIN_DRIVING_EXPERIENCE")
    if fix_year_values:
        exp = X.fix_year(exp)
    edits = {
        "POLICY_BRANCH": X.binary_map("POLICY_BRANCH", BRANCH_HOME),
        "INSURER_GENDER": X.binary_map("INSURER_GENDER", GENDER_ZERO),
        "POLICY_YEARS_RENEWED_N": X.int_with_code("POLICY_YEARS_RENEWED_N", "N", 1),
    }
    for c in replace_cols:
        edits[c] = X.replace_code(c, UNDEFINED_CODES[0], UNDEFINED_CODES[1])
    out = df.withColumns(edits)
    bands = X.band_flags("POLICY_MIN_AGE", X.AGE_BANDS) + X.band_flags(exp, X.EXPERIENCE_BANDS)
    out = out.select("*", *bands)
    return out.drop("POLICY_MIN_AGE", "POLICY_MIN_DRIVING_EXPERIENCE",
                    *[c for c in DROPPED if c in df.columns])


@dataclass
class Encoders:
    minmax: dict
    stages: list = field(default_factory=list)
    feature_cols: list = field(default_factory=list)


def fit_encoders(train: DataFrame, numeric=NUMERIC, binary=BINARY, category_num=CATEGORY_NUM,
                 claim_cols=CLAIM_COLS, own_vocab=OWN_VOCAB) -> Encoders:
    """Fit scaling and category vocabularies on the training rows only."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel

    stats = prep.fit_minmax(train, list(numeric))
    indexed = []
    stages = []
    # numeric category: every value its own column, unseen = error
    for c in category_num:
        si = StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                           handleInvalid="error").fit(train)
        stages.append(si)
        indexed.append((f"{c}_idx", False))
    # one pass counts the vocabularies of the first claim column (shared by
    # all four claim columns) and of the columns with their own vocabulary;
    # unseen values and nulls -> zeros
    vocab_cols = [claim_cols[0], *own_vocab]
    multi = StringIndexer(inputCols=vocab_cols, outputCols=[f"_v{i}" for i in range(len(vocab_cols))],
                          stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    labels = dict(zip(vocab_cols, multi.labelsArray))
    for c in claim_cols:
        stages.append(StringIndexerModel.from_labels(labels[claim_cols[0]], inputCol=c,
                                                     outputCol=f"{c}_idx", handleInvalid="keep"))
        indexed.append((f"{c}_idx", True))
    for c in own_vocab:
        stages.append(StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=f"{c}_idx",
                                                     handleInvalid="keep"))
        indexed.append((f"{c}_idx", True))
    cur = train
    for st in stages:
        cur = st.transform(cur)
    vecs = []
    for col, keep_invalid in indexed:
        # keep_invalid: the indexer's metadata ends with an "unknown" slot;
        # dropping that last slot maps unseen values and nulls to all zeros
        ohe = OneHotEncoder(inputCol=col, outputCol=f"{col}_vec", dropLast=keep_invalid,
                            handleInvalid="error").fit(cur)
        stages.append(ohe)
        vecs.append(f"{col}_vec")
    return Encoders(minmax=stats, stages=stages, feature_cols=list(numeric) + list(binary) + vecs)


def design_matrix(df: DataFrame, enc: Encoders, features: str = "features") -> DataFrame:
    """Scale with the fitted statistics, apply the fitted encoders, assemble."""
    from pyspark.ml import PipelineModel

    out = PipelineModel(enc.stages).transform(prep.apply_minmax(df, enc.minmax))
    return M.assemble(out, enc.feature_cols, features)


def fit(train: DataFrame, label: str = "POLICY_IS_RENEWED", grid: dict | None = None,
        folds: int = 4, seed: int = 1, id_col: str = "POLICY_ID", valid_share: float = 0.2,
        rows: int = boosting.FIT_ROWS, **enc_kw):
    """Encoders on train, hash-based validation split, grid search on at most
    ``rows`` of the rest (one Spark task a fit), accuracy on all held-out rows.
    Returns (encoders, search, accuracy)."""
    enc = fit_encoders(train, **enc_kw)
    data = design_matrix(train, enc).withColumn("label", F.col(label).cast("double"))
    data = prep.hash_split(data, id_col, valid_share, seed).select(id_col, "features", "label", "is_valid")
    data = M.stratified_folds(data, id_col, folds, seed).persist()
    try:
        tr, va = data.filter(~F.col("is_valid")), data.filter("is_valid")
        found = boosting.search(tr, id_col, grid or GRID, folds=folds, seed=seed, rows=rows)
        acc = M.accuracy(found.bestModel.transform(va), "label")
    finally:
        data.unpersist()
    return enc, found, acc


def score(enc: Encoders, found: boosting.Search, test: DataFrame, id_col: str = "POLICY_ID",
          label: str = "POLICY_IS_RENEWED") -> DataFrame:
    """POLICY_ID, predicted label, class-1 probability."""
    scored = found.bestModel.transform(design_matrix(test, enc))
    return scored.select(id_col, F.col("prediction").cast("int").alias(label),
                         F.col("probability").alias(f"{label}_PROBABILITY"))
