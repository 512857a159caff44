"""Parquet table access."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filter push-down happen at the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
