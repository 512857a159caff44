"""Cohort split, index dates and observation windows.

All joins against ``mortality`` are keyed by patient_id.  mortality has one row per
deceased patient, so it grows with the patient count: we never force a broadcast and
let AQE pick broadcast vs. shuffle from the runtime size.  Per-patient aggregates are
computed *before* they are joined back to the (much larger) event table, so the skew
of one very active patient is absorbed by partial aggregation and AQE skew-join
splitting instead of a single window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alive_events(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """Events of patients absent from mortality (left anti join; ids are non-null)."""
    return events.join(mortality.select("patient_id"), "patient_id", "left_anti")


def dead_events(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """Events of patients present in mortality (left semi join)."""
    return events.join(mortality.select("patient_id"), "patient_id", "left_semi")


def with_status(per_patient: DataFrame, mortality: DataFrame) -> DataFrame:
    """Tag a per-patient frame with is_dead 0/1 and status 'alive'/'dead'.

    Mortality ids are de-duplicated first, so a repeated mortality row cannot repeat
    the per-patient rows.
    """
    m = mortality.select("patient_id").distinct().withColumn("_dead", F.lit(1))
    return (
        per_patient.join(m, "patient_id", "left")
        .withColumn("is_dead", F.coalesce(F.col("_dead"), F.lit(0)))
        .withColumn("status", F.when(F.col("is_dead") == 1, "dead").otherwise("alive"))
        .drop("_dead")
    )


def alive_dead_label(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """(patient_id, is_dead) for every patient with events."""
    pts = events.select("patient_id").distinct()
    return with_status(pts, mortality).select("patient_id", "is_dead")


def index_dates(events: DataFrame, mortality: DataFrame, lead_days: int = 30) -> DataFrame:
    """(patient_id, indx_date): alive → last event date; deceased → death_date − lead_days.

    Every mortality row gets an index date, even without events.
    """
    alive_last = (
        events.groupBy("patient_id").agg(F.max("event_date").alias("indx_date"))
        .join(mortality.select("patient_id"), "patient_id", "left_anti")
    )
    dead = mortality.select("patient_id", F.date_sub("death_date", lead_days).alias("indx_date"))
    return alive_last.unionByName(dead)


def window_filter(events: DataFrame, idx: DataFrame, window_days: int = 2000,
                  keep: tuple[str, ...] = ("patient_id", "event_id", "value")) -> DataFrame:
    """Keep events with 0 <= indx_date − event_date <= window_days (whole days)."""
    diff = F.datediff(F.col("indx_date"), F.col("event_date"))
    return events.join(idx, "patient_id").filter(diff.between(0, window_days)).select(*keep)


def time_difference(events: DataFrame, mortality: DataFrame, status: str,
                    lead_days: int = 30) -> DataFrame:
    """Events of one cohort with days before its index date.

    status='dead': DaysBetween(death_date − lead, event_date), label 1.
    status='alive': DaysBetween(last event date, event_date), label 0.
    """
    if status == "dead":
        m = mortality.select("patient_id", F.date_sub("death_date", lead_days).alias("_idx"), "label")
        out = events.join(m, "patient_id")
    elif status == "alive":
        alive = alive_events(events, mortality)
        last = alive.groupBy("patient_id").agg(F.max("event_date").alias("_idx"))
        out = alive.join(last, "patient_id").withColumn("label", F.lit(0))
    else:
        raise ValueError(f"status must be 'alive' or 'dead', not {status!r}")
    return out.select(
        "patient_id", "event_id", "value", "label",
        F.datediff("_idx", "event_date").alias("time_difference"),
    )
