"""Per-cohort event statistics (event count, encounter count, record length, top events).

Two-level aggregates: first one row per patient (partial aggregation before the
shuffle, so a patient holding a third of all events costs one map-side combine), then
a tiny per-status aggregate.  The exact median comes from ``quantiles.group_quantiles``:
histograms of bounded size refined until a bin is one value, so no task holds a group's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .cohort import with_status
from .quantiles import group_quantiles


def _metrics(summary: DataFrame, mortality: DataFrame, metric: str, median: bool,
             digits: int = 6) -> DataFrame:
    s = with_status(summary.select("patient_id", metric), mortality)
    aggs = [
        F.round(F.avg(metric), digits).alias(f"avg_{metric}"),
        F.min(metric).cast("bigint").alias(f"min_{metric}"),
        F.max(metric).cast("bigint").alias(f"max_{metric}"),
    ]
    if not median:
        return s.groupBy("status").agg(*aggs)
    ensure_checkpoint_dir(s.sparkSession)
    counts = s.groupBy("status", metric).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    total = F.sum(F.when(F.col(metric).isNotNull(), F.col("n")))
    out = counts.groupBy("status").agg(F.round(F.sum(F.col(metric) * F.col("n")) / total, digits).alias(f"avg_{metric}"), *aggs[1:])
    medians = group_quantiles(counts, "status", metric, [0.5], weight="n")
    return out.join(medians.select("status", F.round("quantile", digits).alias(f"median_{metric}")), "status", "left")


def event_count_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """status, avg/min/max of events per patient."""
    summary = events.groupBy("patient_id").agg(F.count(F.col("event_id")).alias("event_count"))
    return _metrics(summary, mortality, "event_count", median=False)


def encounter_count_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """status, avg/min/max/median of distinct event dates per patient."""
    summary = events.groupBy("patient_id").agg(F.count_distinct("event_date").alias("encounter_count"))
    return _metrics(summary, mortality, "encounter_count", median=True)


def record_length_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """status, avg/min/max/median of days between first and last event."""
    summary = events.groupBy("patient_id").agg(
        F.datediff(F.max("event_date"), F.min("event_date")).alias("record_length"))
    return _metrics(summary, mortality, "record_length", median=True)


def top_events(events: DataFrame, mortality: DataFrame, k: int = 5,
               classes: tuple[str, ...] = ("DIAG", "LAB", "DRUG")) -> DataFrame:
    """Top-k event ids by count per (status, event class); ties broken by event_id.

    Events are first counted per (patient, event) so that the status join sees one
    row per pair instead of one per event; the ranking window then runs over the
    distinct event vocabulary of one (status, class).
    """
    cls = F.coalesce(*[F.when(F.col("event_id").startswith(c), F.lit(c)) for c in classes])
    per_pair = (
        events.filter(cls.isNotNull())
        .groupBy("patient_id", "event_id").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = (
        with_status(per_pair, mortality)
        .groupBy("status", "event_id").agg(F.sum("n").alias("event_count"))
        .withColumn("event_class", cls)
    )
    w = Window.partitionBy("status", "event_class").orderBy(F.col("event_count").desc(), F.col("event_id"))
    return (
        counted.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("status", "event_class", "rank", "event_id", "event_count")
    )
