"""Exact quantiles of integers per group, without a buffer of a group's values.

``percentile`` merges one value-to-count map per group in one task.  Here each wanted rank keeps an interval of
values that must hold it; one aggregation counts the interval's rows in ``BINS`` equal bins, the bin with the rank
becomes the next interval, until it is a single value.  A round reads the rows once, combines them map-side and shuffles at
most BINS counts per group, rank and task, so a group with a third of all rows is no hot task.  Whatever the range,
64-bit values need at most seven rounds; a range within BINS values needs one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BINS = 1024


def order_statistics(rows: DataFrame, group: str, value: str, ranks: DataFrame, weight: str | None = None, bins: int = BINS) -> DataFrame:
    """(group, rank, value): the value at each 0-based ``rank`` of ``ranks`` (group, rank) in the group's ascending integer values.

    ``weight`` names a column of how often each row counts.  Null values take no part, a null group is a group; a rank
    outside a group has no row.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    n = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    src = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("long").alias("v"), n.alias("n")).where("n > 0")
    ends = src.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("size"))
    wanted = ranks.select(F.col(group).alias("gw"), F.col("rank").cast("long").alias("rank")).distinct()
    # before: rows of the group below the interval [lo, hi]
    open_ = wanted.join(ends, F.col("gw").eqNullSafe(F.col("g"))).where("rank between 0 and size - 1").select(
        "g", "rank", "lo", "hi", F.lit(0).cast("long").alias("before")).checkpoint(eager=True)
    done = []
    while True:
        done.append(open_.where("lo = hi").select("g", "rank", F.col("lo").alias("v")))
        open_ = open_.where("lo < hi")
        if open_.isEmpty():
            break
        open_ = _refined(src, open_, bins).checkpoint(eager=True)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(F.col("g").alias(group), "rank", F.col("v").alias(value))


def _refined(src: DataFrame, open_: DataFrame, bins: int) -> DataFrame:
    """The intervals narrowed to the bin that holds their rank."""
    span = lambda: F.col("hi").cast("decimal(20,0)") - F.col("lo") + 1  # noqa: E731  (may exceed a long)
    width = F.ceil(span() / F.lit(bins).cast("decimal(20,0)")).cast("long")
    cuts = open_.select(F.col("g").alias("gi"), "rank", "lo", "hi", "before", width.alias("width"))
    inside = src.join(cuts, F.col("g").eqNullSafe(F.col("gi")) & F.col("v").between(F.col("lo"), F.col("hi")))
    at = F.floor((F.col("v").cast("decimal(20,0)") - F.col("lo")) / F.col("width").cast("decimal(20,0)")).cast("long")
    binned = inside.groupBy("gi", "rank", "lo", "hi", "before", "width", at.alias("bin")).agg(F.sum("n").alias("n"))
    below = Window.partitionBy("gi", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most ``bins`` rows
    found = binned.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(below), F.lit(0))).where(
        "start <= rank and rank < start + n")
    first = F.col("lo").cast("decimal(20,0)") + F.col("bin") * F.col("width").cast("decimal(20,0)")
    last = F.least(F.col("hi").cast("decimal(20,0)"), first + F.col("width") - 1)
    return found.select(F.col("gi").alias("g"), "rank", first.cast("long").alias("lo"), last.cast("long").alias("hi"), F.col("start").alias("before"))


def group_quantiles(rows: DataFrame, group: str, value: str, fractions: list[float], weight: str | None = None, bins: int = BINS) -> DataFrame:
    """(group, fraction, quantile): exact quantiles with linear interpolation between the two nearest values, as ``percentile`` gives them.

    A group without a value gives no row.  ``value`` must be an integer column.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    n = F.col(weight).cast("long") if weight else F.lit(1)
    sizes = rows.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g")).agg(F.sum(n).alias("size")).where("size > 0")
    places = F.array(*[F.lit(float(f)) for f in fractions])
    wanted = sizes.select("g", F.explode(places).alias("fraction"), "size").withColumn("place", F.col("fraction") * (F.col("size") - 1)).select(
        "g", "fraction", "place", F.floor("place").cast("long").alias("low"), F.ceil("place").cast("long").alias("high")).checkpoint(eager=True)
    ranks = wanted.select(F.col("g").alias(group), F.explode(F.array("low", "high")).alias("rank"))
    found = order_statistics(rows, group, value, ranks, weight, bins).select(F.col(group).alias("gf"), "rank", F.col(value).alias("v")).checkpoint(eager=True)
    at = lambda side: F.col("g").eqNullSafe(F.col(f"{side}.gf")) & (F.col(side.replace("_v", "")) == F.col(f"{side}.rank"))
    both = wanted.join(found.alias("low_v"), at("low_v")).join(found.alias("high_v"), at("high_v"))
    share = F.col("place") - F.col("low")
    mid = F.when(F.col("low") == F.col("high"), F.col("low_v.v").cast("double")).otherwise(
        F.col("low_v.v") * (1 - share) + F.col("high_v.v") * share)
    return both.select(F.col("g").alias(group), "fraction", mid.alias("quantile"))
