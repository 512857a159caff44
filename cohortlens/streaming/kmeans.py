"""Streaming k-means on Structured Streaming.

Each micro-batch (``foreachBatch``) assigns its points to the nearest current centre
with array expressions (centres are k literal arrays: k×d numbers, a proven bound),
aggregates per-cluster sums and counts on the executors, and only those k rows reach
the driver, where the forgetful update rule of streaming k-means is applied:

    discount = decay (per batch) or decay^m (per point); w ← w·discount
    w' = w + n;  λ = n / w';  c ← (1−λ)·c + (λ/n)·Σx

A cluster whose weight falls below 1e-8 of the largest is re-seeded by splitting the
largest cluster, as MLlib does.

The model outlives the process: after every epoch the centres and weights are written to the
stream's checkpoint folder, before the epoch is committed.  A restarted stream goes on from the last one stored; an epoch
that was stored but not committed is replayed by Spark and then left out, so that no batch counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "cluster int, center array<double>, weight double, batches int"


@dataclass
class StreamingKMeansState:
    centers: np.ndarray
    weights: np.ndarray
    decay: float = 1.0
    time_unit: str = "batches"
    batches: int = 0
    history: list = field(default_factory=list)
    epoch: int = -1  # the last one that the centres hold

    @classmethod
    def random(cls, k: int, dim: int, weight: float, seed: int, decay: float = 1.0,
               time_unit: str = "batches") -> "StreamingKMeansState":
        rng = np.random.default_rng(seed)
        return cls(rng.standard_normal((k, dim)), np.full(k, float(weight)), decay, time_unit)

    def update(self, sums: np.ndarray, counts: np.ndarray) -> None:
        m = counts.sum()
        discount = self.decay if self.time_unit == "batches" else self.decay ** m
        self.weights = self.weights * discount
        for j in np.nonzero(counts > 0)[0]:
            new_w = self.weights[j] + counts[j]
            lam = counts[j] / max(new_w, 1e-16)
            self.weights[j] = new_w
            self.centers[j] = (1.0 - lam) * self.centers[j] + (lam / counts[j]) * sums[j]
        big, small = int(np.argmax(self.weights)), int(np.argmin(self.weights))
        if self.weights[small] < 1e-8 * self.weights[big]:
            w = (self.weights[big] + self.weights[small]) / 2.0
            self.weights[big] = self.weights[small] = w
            x = self.centers[big].copy()
            p = 1e-14 * np.maximum(np.abs(x), 1.0)
            self.centers[big], self.centers[small] = x + p, x - p
        self.batches += 1


def nearest_center(vec: Column, centers: np.ndarray) -> Column:
    """Index of the closest centre (squared Euclidean; first one on ties)."""
    dists = []
    for c in centers:
        lit = F.array(*[F.lit(float(x)) for x in c])
        diff = F.zip_with(vec, lit, lambda a, b: (a - b) * (a - b))
        dists.append(F.aggregate(diff, F.lit(0.0), lambda acc, x: acc + x))
    best, best_i = dists[0], F.lit(0)
    for i, d in enumerate(dists[1:], start=1):
        best_i = F.when(d < best, F.lit(i)).otherwise(best_i)
        best = F.least(best, d)
    return best_i


def batch_stats(batch: DataFrame, vec_col: str, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per-cluster vector sums and counts of one batch (k rows collected)."""
    k, dim = centers.shape
    assigned = batch.select(nearest_center(F.col(vec_col), centers).alias("c"), F.col(vec_col).alias("v"))
    per = assigned.groupBy("c").agg(Summarizer.sum(array_to_vector("v")).alias("s"), F.count(F.lit(1)).alias("n"))
    sums, counts = np.zeros((k, dim)), np.zeros(k)
    for r in per.collect():          # one pass over the batch, at most k rows of d numbers
        sums[r["c"]], counts[r["c"]] = r["s"].toArray(), r["n"]
    return sums, counts


def store_model(spark: SparkSession, state: StreamingKMeansState, path: str) -> None:
    """Writes the centres as they are after ``state.epoch`` (k rows) into a folder of the epoch's own."""
    rows = [(j, c.tolist(), float(w), state.batches) for j, (c, w) in enumerate(zip(state.centers, state.weights))]
    spark.createDataFrame(rows, MODEL).coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={state.epoch}")


def load_model(spark: SparkSession, path: str, state: StreamingKMeansState) -> bool:
    """Sets the state to the last stored epoch; False if none is stored (folders of broken writes hold no rows)."""
    try:
        stored = spark.read.schema(MODEL + ", epoch int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    last = stored.agg(F.max("epoch")).first()[0]
    if last is None:
        return False
    rows = stored.filter(F.col("epoch") == last).orderBy("cluster").collect()  # k rows
    state.centers, state.weights = np.array([r["center"] for r in rows]), np.array([r["weight"] for r in rows])
    state.batches, state.epoch = rows[0]["batches"], last
    return True


def run_streaming_kmeans(stream: DataFrame, vec_col: str, state: StreamingKMeansState, checkpoint: str,
                         trigger_available_now: bool = True, on_stored: Callable[[int], None] | None = None) -> StreamingKMeansState:
    """Drive ``stream`` to completion (availableNow) updating ``state`` after every batch.

    If the checkpoint folder holds a model, ``state`` becomes that one first.  ``on_stored`` is
    called with each epoch once its centres are written.
    """
    spark, model = stream.sparkSession, checkpoint.rstrip("/") + "/model"
    load_model(spark, model, state)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        if epoch <= state.epoch:  # replayed: the stored centres hold it
            return
        sums, counts = batch_stats(batch.select(F.col(vec_col).cast("array<double>").alias(vec_col)), vec_col,
                                   state.centers)
        if counts.sum() > 0:
            state.update(sums, counts)
            state.history.append((epoch, int(counts.sum())))
        state.epoch = epoch
        store_model(spark, state, model)
        if on_stored:
            on_stored(epoch)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    q = writer.start()
    q.awaitTermination()
    return state


def assign(df: DataFrame, vec_col: str, state: StreamingKMeansState) -> DataFrame:
    """Predict the nearest centre for every row of a (static) frame."""
    return df.withColumn("cluster", nearest_center(F.col(vec_col).cast("array<double>"), state.centers))
