"""Parquet table access for the query catalogue (S8)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; projections and filters push into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
