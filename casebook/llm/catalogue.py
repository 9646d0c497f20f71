"""Queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm import (alignment, hard_negatives, jaccard_join, language_id, licenses, packing, piece_lattice, quality,
                          substring_dedup, suffix_dedup, token_files, topk, toxicity)
from casebook.session import ensure_checkpoint_dir
from casebook.sources.tables import table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~held))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "language.*")


def _paths(docs: DataFrame) -> DataFrame:
    """A file path for each document, of four depths from source down; some are named as license files."""
    k = F.col("doc_id")
    source, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))
    part, sub = F.concat(F.lit("part"), k % 10), F.concat(F.lit("sub"), k % 3)
    home = (F.when(k % 4 == 0, source).when(k % 4 == 1, F.concat_ws("/", source, lang))
            .when(k % 4 == 2, F.concat_ws("/", source, lang, part)).otherwise(F.concat_ws("/", source, lang, part, sub)))
    name = (F.when(k % 50 == 0, F.concat(F.lit("LICENSE-"), k)).when(k % 50 == 1, F.concat(F.lit("COPYING."), k))
            .otherwise(F.concat(k, F.lit(".txt"))))
    return docs.select("doc_id", "text", F.concat(home, F.lit("/"), name).alias("path"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document; each with one of its own speaks for its folder and those below."""
    docs = _paths(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return licenses.scan(docs, gives=F.lit(True)).withColumn("cosine", F.round("cosine", 6))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
                       F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op7_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and every turn of every conversation, encoded and decoded again."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(
        table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), allowMissingColumns=True)
    pieces = piece_lattice.piece_table(spark, public_tokenizers.path(PIECES))
    back = piece_lattice.decode(piece_lattice.encode(texts, pieces), pieces)
    return back.select("doc_id", "conv_id", "turn", F.size("ids").cast("long").alias("n_pieces"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.judge(docs, forest).select(
        "doc_id", *(f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                             "base_failed", "kept", "score")))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{X.fresh()}"
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(TOKENIZER), out)
    return token_files.digests(token_files.read(spark, out))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; every seventh row's label moves on by one first."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.filter(~held), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "toxicity.*")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.count_links(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_license_scans, op3_substring_dedup, op4_exact_topk, op5_best_fit_packing,
    op6_suffix_array_dedup, op7_piece_lattice, op8_jaccard_join, op9_quality_rules, op10_token_files,
    op11_hard_negatives, op12_toxicity, op13_token_alignment)}

ORACLE: dict[str, str] = {
    "op4_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
             CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
}
