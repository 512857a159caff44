"""Hash-based splits and bagging assignments (repeatable under any partitioning)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit


def train_test_split(df: DataFrame, key: str, test_fraction: float = 0.2, salt: str = "split") -> DataFrame:
    """split = 'test' when hash(key) <= test_fraction, else 'train'."""
    return df.withColumn("split", F.when(hash_unit(key, salt) <= test_fraction, "test").otherwise("train"))


def kfold_assign(df: DataFrame, key: str, k: int = 5, salt: str = "kfold") -> DataFrame:
    """fold in 0..k-1 from the hash of the key."""
    return df.withColumn("fold", F.floor(hash_unit(key, salt) * k).cast("int"))


def shuffle_split(df: DataFrame, key: str, iterations: int = 5, test_fraction: float = 0.2,
                  salt: str = "ss") -> DataFrame:
    """Repeated random split: one row per (iteration, key) with its split."""
    it = df.withColumn("iteration", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))))
    u = hash_unit(key, F.concat(F.lit(salt), F.col("iteration").cast("string"), F.lit("-")))
    return it.withColumn("split", F.when(u < test_fraction, "test").otherwise("train"))


def bagging_sample(df: DataFrame, key: str, n_models: int, ratio: float, salt: str = "bag") -> DataFrame:
    """Each row goes to model i with probability ``ratio`` (independently per model)."""
    it = df.withColumn("model_id", F.explode(F.sequence(F.lit(0), F.lit(n_models - 1))))
    u = hash_unit(key, F.concat(F.lit(salt), F.col("model_id").cast("string"), F.lit("-")))
    return it.filter(u < ratio)
