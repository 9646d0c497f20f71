"""A training corpus from ``documents``: quality rules, language ID, near-duplicates, repeated passages, packing.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's ``docs`` - the columns of ``documents``, but for the
last, which returns packed pieces. Rows without ``doc_id`` go at the first
stage: nothing could be said about them afterwards.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import exchange, jaccard_join, language_id, packing, quality, substring_dedup
from casebook.session import ensure_checkpoint_dir, ship_package
from casebook.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the hard rules, or that the forest rejects, go."""
    ship_package(spark)
    forest = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    judged = quality.judge(docs.select(*COLUMNS).filter(F.col("doc_id").isNotNull()), forest)
    return judged.filter(F.col("quality.kept")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or between two, go; ``lang`` becomes the predicted language."""
    ship_package(spark)
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = language_id.predict(docs.select(*COLUMNS), model)
    found = found.filter((F.col("language.lang_pred") != language_id.UNKNOWN) & ~F.col("language.ambiguous"))
    return found.withColumn("lang", F.col("language.lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest ``doc_id`` stays."""
    ship_package(spark)
    groups = jaccard_join.jaccard_components(docs.select("doc_id", "text"))
    gone = groups.filter(F.col("component_id") != F.col("doc_id")).select("doc_id")
    return docs.select(*COLUMNS).dropDuplicates(["doc_id"]).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of an earlier document go from the later ones; texts that lose nothing stay as they are."""
    ship_package(spark)
    kept = substring_dedup.remove_repeats(docs.select("doc_id", "text"), normalise=False).select("doc_id", "kept")
    rest = docs.select("doc_id", "lang", "source").join(kept, "doc_id")
    return rest.select("doc_id", F.col("kept").alias("text"), "lang", "source",
                       F.length("kept").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids."""
    ship_package(spark)
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("language ID", language), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", substrings), ("best-fit packing", packed)]

#: The forest and the classifiers of the first stages have no SQL form; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{exchange.fresh()}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
