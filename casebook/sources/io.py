"""Readers and writers with declared schemas.

Readers never infer types from data (inference is a full extra scan); every
reader takes or builds a ``StructType``. Writers default to failing when the
target exists, as the original jobs did.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions import exprs as X

# pandas' default missing-value tokens (read_csv), to which a
# job may add its own (e.g. "?").
PANDAS_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")


# ------------------------------------------------------------ delimited text
def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = ",", header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a declared schema. Spark reads few encodings by
    itself; any other single-byte one that keeps ASCII, such as cp1251, is
    read byte for byte as ISO-8859-1 and its upper half translated, so no
    session setting is needed. A byte without a character becomes U+FFFD."""
    own = encoding.upper().replace("-", "") in ("UTF8", "UTF16", "USASCII", "ISO88591")
    df = (spark.read.schema(schema).option("sep", sep).option("header", header)
          .option("encoding", encoding if own else "ISO-8859-1").option("mode", "FAILFAST").csv(path))
    if own:
        return df
    ascii_, upper = bytes(range(128)), bytes(range(128, 256))
    chars = "".join(bytes([b]).decode(encoding, errors="replace") for b in upper)
    if ascii_.decode(encoding, errors="replace") != ascii_.decode("ascii") or len(chars) != 128:
        raise ValueError(f"{encoding} is not a single-byte extension of ASCII")
    return df.select(*[
        (F.translate(F.col(f"`{f.name}`"), upper.decode("latin-1"), chars).alias(f.name)
         if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")) for f in df.schema.fields])


def read_with_null_tokens(spark: SparkSession, path: str, schema: T.StructType,
                          tokens: Sequence[str] = ("?",), keep_defaults: bool = True,
                          sep: str = ",", header: bool = True) -> DataFrame:
    """CSV where several tokens mean missing (Spark's ``nullValue`` takes
    one). Read as strings, null the tokens, then cast to the declared types;
    a value that does not parse is an error when the rows are read."""
    toks = list(tokens) + (list(PANDAS_NA) if keep_defaults else [])
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(as_text).option("sep", sep).option("header", header)
           .option("nullValue", None).option("emptyValue", "").csv(path))
    lit_toks = [F.lit(t) for t in toks]
    cols = []
    for f in schema.fields:
        c = F.when(F.col(f.name).isin(*lit_toks), F.lit(None)).otherwise(F.col(f.name))
        if not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """Header-less request log: N, type, from_mobile."""
    return read_delimited(spark, path, "N long, type string, from_mobile int", header=False)


# --------------------------------------------------------------------- images
def read_images(spark: SparkSession, path: str, glob: str = "*.jpg",
                min_partitions: int | None = None, recursive: bool = False) -> DataFrame:
    """Decoded images: image (file name), height, width, n_channels, data
    (BGR bytes, as Spark's image source gives them), valid. Files that cannot
    be decoded keep their row, with ``valid`` false and no data."""
    df = (spark.read.format("image").option("pathGlobFilter", glob)
          .option("dropInvalid", False).option("recursiveFileLookup", recursive).load(path))
    out = df.select(X.file_name("image.origin").alias("image"), "image.height", "image.width",
                    F.col("image.nChannels").alias("n_channels"), "image.data",
                    (F.col("image.height") > 0).alias("valid"))
    if min_partitions:
        out = out.repartition(min_partitions)
    return out


def read_query_image(spark: SparkSession, path: str) -> DataFrame:
    """One image file as a one-row decoded-image DataFrame."""
    import os
    return read_images(spark, path, glob=os.path.basename(path) or "*")


def read_image_files(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Raw files: image (file name), content bytes (no decoding)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(X.file_name("path").alias("image"), "content")


def read_sequence_images(spark: SparkSession, path: str, min_splits: int | None = None) -> DataFrame:
    """Hadoop sequence file of (name, bytes) records as a DataFrame."""
    sc = spark.sparkContext
    rdd = sc.sequenceFile(path, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.BytesWritable",
                          minSplits=min_splits)
    return rdd.toDF(T.StructType([T.StructField("image", T.StringType()),
                                  T.StructField("content", T.BinaryType())]))


# ----------------------------------------------------------- codebook / index
def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with a sortable position: (file, block start, position
    inside the block); the block-local position is exact because a task
    reads its block in order."""
    return spark.read.text(path).select(
        "value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                          F.monotonically_increasing_id()).alias("_n"))


def read_codebook_csv(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """One centre per line, comma-separated floats -> (centre_id, centre).
    centre_id follows line order (file order = codebook order)."""
    lines = _numbered_lines(spark, path)
    parsed = lines.select("_n", F.transform(F.split(F.trim("value"), ","),
                                            lambda x: x.cast("double")).alias("centre"))
    if dim is not None:
        bad = parsed.filter(F.size("centre") != dim).limit(1).count()
        if bad:
            raise ValueError(f"codebook rows must have {dim} values")
    from casebook.operators.common import ordered_index
    return ordered_index(parsed, ["_n"], name="centre_id", start=0).select(
        F.col("centre_id").cast("int"), "centre")


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    """Histogram index lines ``id,h0,h1,...`` -> (image, hist); when an id
    repeats, the line that comes last in the file wins."""
    lines = _numbered_lines(spark, path)
    parts = lines.select("_n", F.split(F.trim("value"), ",").alias("p"))
    rows = parts.select("_n", F.col("p")[0].alias("image"),
                        F.transform(F.slice("p", 2, F.size("p") - 1), lambda x: x.cast("double")).alias("hist"))
    return rows.groupBy("image").agg(F.max_by("hist", "_n").alias("hist"))


def load_kmeans_centres(spark: SparkSession, path: str) -> DataFrame:
    """Saved Spark ML k-means model -> codebook (centre_id, centre)."""
    from pyspark.ml.clustering import KMeansModel
    centres = KMeansModel.load(path).clusterCenters()
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)],
                                 "centre_id int, centre array<double>")


# ---------------------------------------------------------------------- sinks
def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def register_view(df: DataFrame, name: str = "images") -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_scored_csv(df: DataFrame, path: str, cols: Sequence[str] | None = None,
                     mode: str = "errorifexists") -> None:
    """Scored rows (key, label, probabilities) as CSV with a header."""
    (df.select(*(cols or df.columns)).write.mode(mode).option("header", True).csv(path))


def write_codebook_csv(codebook: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One centre per line in centre_id order (range-partitioned sort, so
    part files concatenate in order)."""
    line = F.array_join(F.transform("centre", lambda x: x.cast("string")), ",")
    (codebook.orderBy("centre_id").select(line.alias("value")).write.mode(mode).text(path))


def write_index_csv(index: DataFrame, path: str, image: str = "image", hist: str = "hist",
                    mode: str = "errorifexists") -> None:
    """Histogram index lines ``id,h0,h1,...``."""
    line = F.concat_ws(",", F.col(image).cast("string"),
                       F.array_join(F.transform(hist, lambda x: x.cast("string")), ","))
    index.select(line.alias("value")).write.mode(mode).text(path)


def save_model(model, path: str, overwrite: bool = False) -> None:
    w = model.write()
    (w.overwrite() if overwrite else w).save(path)
