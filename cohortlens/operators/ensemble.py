"""Bagged SGD logistic regression and ensemble scoring.

Training is the one place where sequential per-row Python logic is needed: each model
makes one SGD pass over its bag.  A bag is split into ``shards`` (hash of the row key), a fixed
number whatever the data's size, so the same bag always gives the same weights.
Spark sorts the rows by (model, shard, key) and a task streams through its shards; the shard weights are
averaged (one-shot parameter mixing).  ``shards=1`` is exactly the sequential
pass; a larger corpus may take a larger number, chosen by the caller, for more parallel passes (a task's
memory is a batch of rows and the weights of one shard, whatever its size).  Scoring is plain SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from ..functions.sparse import sigmoid
from .indexing import BROADCAST_ROWS

WEIGHT_SCHEMA = "model_id int, shard int, feature_id long, weight double"
SHARDS = 16


def _logistic(z: float) -> float:
    return 1.0 / (1.0 + np.exp(-z)) if z >= 0 else np.exp(z) / (1.0 + np.exp(z))


def _shard_trainer(eta: float, mu: float):
    """One pass in row order; a step changes (and decays) only the weights of the row's features.

    The rows come as a stream, shard after shard; a task holds a batch of them and one shard's weights.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, known, weights = None, np.zeros(0, np.int64), np.zeros(0)

        def trained() -> pa.RecordBatch:
            columns = [np.full(len(known), shard[0], np.int32), np.full(len(known), shard[1], np.int32), known, weights]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["model_id", "shard", "feature_id", "weight"])

        for batch in batches:
            models, shards, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("model_id", "shard", "label"))
            lists = batch.column("features")
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(), dtype=np.int64)
            begins = np.concatenate([np.zeros(1, np.int64), ends])
            ids, values = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            cuts = np.flatnonzero((np.diff(models) != 0) | (np.diff(shards) != 0)) + 1
            for first, last in zip([0, *cuts], [*cuts, len(models)]):
                if first == last:
                    continue
                if shard != (models[first], shards[first]):
                    if shard is not None:
                        yield trained()
                    shard, known, weights = (models[first], shards[first]), np.zeros(0, np.int64), np.zeros(0)
                own = ids[begins[first]:begins[last]]
                every = np.union1d(known, own)
                if len(every) > len(known):
                    wider = np.zeros(len(every))
                    wider[np.searchsorted(every, known)] = weights
                    known, weights = every, wider
                places = np.searchsorted(known, own)
                for k in range(first, last):
                    at = places[begins[k] - begins[first]:begins[k + 1] - begins[first]]
                    x = values[begins[k]:begins[k + 1]]
                    error = labels[k] - _logistic(float(weights[at] @ x))
                    weights[at] += eta * error * x - 2.0 * eta * mu * weights[at]
        if shard is not None:
            yield trained()
    return run


def sgd_train(bagged: DataFrame, eta: float = 0.01, mu: float = 0.0, shards: int = SHARDS,
              key: str = "patient_id") -> DataFrame:
    """(model_id, feature_id, weight) from rows (model_id, key, label, features array<struct>)."""
    rows = bagged.select(
        F.col("model_id").cast("int").alias("model_id"), F.col(key).alias("row_key"),
        F.col("label").cast("double").alias("label"),
        F.col("features").cast("array<struct<feature_id:bigint,feature_value:double>>").alias("features"),
        F.floor(hash_unit(key, "shard") * shards).cast("int").alias("shard"))
    ordered = rows.repartition("model_id", "shard").sortWithinPartitions("model_id", "shard", F.col("row_key").asc_nulls_last())
    per_shard = ordered.mapInArrow(_shard_trainer(eta, mu), WEIGHT_SCHEMA)
    return per_shard.groupBy("model_id", "feature_id").agg(
        (F.sum("weight") / F.lit(float(shards))).alias("weight"))


def store_weights(weights: DataFrame, path: str) -> None:
    """The trained weights table, one folder per model."""
    weights.write.mode("errorifexists").partitionBy("model_id").parquet(path)


def load_weights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature_id long, weight double, model_id int").parquet(path).select("model_id", "feature_id", "weight")


def ensemble_score(rows: DataFrame, weights: DataFrame, n_models: int, key: str = "patient_id") -> DataFrame:
    """(key, score): mean over models of sigmoid(w·x).  Rows are (key, features array<struct>).

    The sparse dot product is explode ⋈ weights → sum per (row, model); a model that
    shares no feature with a row contributes sigmoid(0) = 0.5.
    """
    exploded = rows.select(key, F.explode("features").alias("f")).select(
        key, F.col("f.feature_id").alias("feature_id"), F.col("f.feature_value").alias("v"))
    near = F.broadcast(weights) if weights.count() <= BROADCAST_ROWS else weights  # the rows then stay where they are
    dots = (exploded.join(near, "feature_id")
            .groupBy(key, "model_id").agg(F.sum(F.col("v") * F.col("weight")).alias("z")))
    grid = rows.select(key).withColumn("model_id", F.explode(F.sequence(F.lit(0), F.lit(n_models - 1))))
    z = grid.join(dots, [key, "model_id"], "left").select(key, F.coalesce(F.col("z"), F.lit(0.0)).alias("z"))
    return z.groupBy(key).agg(F.avg(sigmoid("z")).alias("score"))


def hash_weights(feature_map: DataFrame, n_models: int, salt: str = "w") -> DataFrame:
    """A reproducible weights table (model_id, feature_id, weight in [-0.5, 0.5)) from id hashes."""
    g = feature_map.select(F.col("idx").alias("feature_id")).withColumn(
        "model_id", F.explode(F.sequence(F.lit(0), F.lit(n_models - 1))))
    u = hash_unit(F.col("feature_id"), F.concat(F.lit(salt), F.col("model_id").cast("string"), F.lit("-")))
    return g.select("model_id", "feature_id", (u - 0.5).alias("weight"))


def decide(score_col: str = "score", threshold: float = 0.5):
    return F.when(F.col(score_col) > threshold, 1).otherwise(0)
