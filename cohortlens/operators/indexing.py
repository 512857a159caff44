"""Dense 0..n-1 indices and running sums in sort order without a single-task window.

``row_number().over(Window.orderBy(...))`` (or over a partition that one key
dominates) moves all of a group's rows into one task.  Here rows are
range-partitioned on (group, sort key) and sorted inside each range partition; a row's
position there is the low part of ``monotonically_increasing_id()``, so numbering takes no
second shuffle.  Each (partition, group) gets an offset = running total of the counts of the
earlier partitions of the same group.  The count table has one row per (partition, group).

The partition count is left to adaptive execution: it starts at
``spark.sql.shuffle.partitions`` and is coalesced by the data's size, unless a caller names one.

The numbered rows are checkpointed (reliable checkpoint in the shared
``spark.checkpoint.dir``) before the two branches read them: range bounds come from
sampling, and a recomputed branch could otherwise see other bounds (after an executor
loss, or when the two branches are planned differently) and misalign the offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, LongType

from ..session import ensure_checkpoint_dir

ROW_BITS = 33  # of monotonically_increasing_id(): the row's number in its partition
BROADCAST_ROWS = 500_000  # of an offset table (a few numbers each) that may be broadcast


def _numbered(df: DataFrame, ordering: list[Column], num_partitions: int | None) -> DataFrame:
    """The rows in range partitions, with their partition (__pid) and position in it (__pos), stored."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *ordering) if num_partitions else df.repartitionByRange(*ordering)
    rows = ranged.sortWithinPartitions(*ordering).withColumn("__row", F.monotonically_increasing_id())
    rows = rows.withColumn("__pid", F.shiftright("__row", ROW_BITS)).withColumn("__pos", F.col("__row").bitwiseAND((1 << ROW_BITS) - 1))
    return rows.drop("__row").checkpoint(eager=True)


def _with_offsets(rows: DataFrame, per: DataFrame, groups: list[str], cols: list[str]) -> DataFrame:
    """Joins the offset table (keys __pid and groups, null-safe; values cols) to the rows."""
    keys = {g: f"__key_{k}" for k, g in enumerate(groups)}
    table = per.select(F.col("__pid").alias("__own"), *[F.col(g).alias(k) for g, k in keys.items()], *cols)
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    same = F.col("__pid") == F.col("__own")
    for g, k in keys.items():
        same = same & F.col(g).eqNullSafe(F.col(k))
    return rows.join(table, same).drop("__own", *keys.values())


def _ordering(groups: list[str], order_cols: list) -> list[Column]:
    return [F.col(g) for g in groups] + [F.col(c) if isinstance(c, str) else c for c in order_cols]


def dense_index(df: DataFrame, order_cols: list, index_col: str = "idx", start: int = 0,
                group_cols: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = position of the row in ``order_cols`` order (within ``group_cols``).

    ``order_cols`` may hold Columns (e.g. ``F.col('n').desc()``); they must make rows
    unique inside a group for the numbering to be repeatable.
    """
    groups = list(group_cols or [])
    rows = _numbered(df, _ordering(groups, order_cols), num_partitions)
    counts = rows.groupBy("__pid", *groups).agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    if groups:
        before = Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first"))
        rows = _with_offsets(rows, offsets, groups, ["__off"])
    else:
        # one count per range partition (as zipWithIndex does): the offsets become a literal array
        rows = rows.withColumn("__off", _partition_offsets(counts, "__n"))
    return rows.withColumn(index_col, (F.col("__off") + F.col("__pos") + F.lit(start)).cast("bigint")).drop("__pid", "__pos", "__off")


def _partition_offsets(counts: DataFrame, value: str) -> Column:
    """Column: running total of ``value`` over the partitions before this row's partition.

    ``counts`` has one row per range partition, so collecting it is bounded by the
    partition count, not by the data.
    """
    per = {r[0]: r[1] or 0 for r in counts.select("__pid", value).collect()}
    total, offsets = 0, []
    for i in range(max(per, default=0) + 1):
        offsets.append(total)
        total += per.get(i, 0)
    kind = counts.schema[value].dataType
    return F.element_at(F.array(*[F.lit(o).cast(kind) for o in offsets]), (F.col("__pid") + 1).cast("int"))


def prefix_sums(df: DataFrame, order_cols: list, sum_cols: list[str], group_cols: list[str] | None = None,
                inclusive: bool = True, suffix: str = "_cum", num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``sum_cols`` in ``order_cols`` order (inside ``group_cols``).

    Same scheme as :func:`dense_index`: local running sums inside range partitions plus
    per-partition offsets.  ``inclusive=False`` gives the sum over strictly earlier rows.
    Rows should be unique in the ordering (aggregate ties first).  Unlike positions, the local
    sums need a window by partition, which is one more shuffle of equal-sized parts.
    """
    groups = list(group_cols or [])
    rows = _numbered(df, _ordering(groups, order_cols), num_partitions)
    frame = Window.partitionBy("__pid", *groups).orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = rows.select("*", *[F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(f"__loc_{c}") for c in sum_cols])
    totals = rows.groupBy("__pid", *groups).agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    if groups:
        before = Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("__pid", *groups, *[F.coalesce(F.sum(f"__tot_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sum_cols])
        out = _with_offsets(out, offsets, groups, [f"__off_{c}" for c in sum_cols])
    else:
        for c in sum_cols:
            out = out.withColumn(f"__off_{c}", _partition_offsets(totals, f"__tot_{c}"))
    for c in sum_cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"__off_{c}") + F.col(f"__loc_{c}"))
    return out.drop("__pid", "__pos", *[f"__loc_{c}" for c in sum_cols], *[f"__off_{c}" for c in sum_cols])


def scan_sums(df: DataFrame, order_cols: list, sum_cols: list[str], inclusive: bool = True, suffix: str = "_cum",
              num_partitions: int | None = None) -> DataFrame:
    """Running sums as :func:`prefix_sums` gives them, without groups and with one shuffle instead of two.

    The rows are range-partitioned and sorted; an ordered scan then adds the sums inside each partition, carried from
    one Arrow batch to the next, before the rows are stored.  Integers are summed as longs, everything else as doubles;
    nulls count as zero.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordering = _ordering([], order_cols)
    ranged = df.repartitionByRange(num_partitions, *ordering) if num_partitions else df.repartitionByRange(*ordering)
    whole = {c: isinstance(df.schema[c].dataType, IntegralType) for c in sum_cols}
    addends = [F.coalesce(F.col(c).cast("long" if whole[c] else "double"), F.lit(0)).alias(f"__loc_{c}") for c in sum_cols]
    rows = ranged.sortWithinPartitions(*ordering).select("*", F.spark_partition_id().alias("__pid"), *addends)
    n = len(sum_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list = [0] * n
        for batch in batches:
            sums = []
            for k, column in enumerate(batch.columns[-n:]):
                values = column.to_numpy(zero_copy_only=False)
                total = before[k] + np.cumsum(values)
                sums.append(pa.array(total if inclusive else total - values, column.type))
                before[k] = total[-1] if len(total) else before[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-n], *sums, *batch.columns[-n:]], names=[*batch.schema.names[:-n], *[f"__sum_{c}" for c in sum_cols], *batch.schema.names[-n:]])

    schema = rows.select(*rows.columns[:-n]).schema
    for name in [*[f"__sum_{c}" for c in sum_cols], *[f"__loc_{c}" for c in sum_cols]]:
        schema = schema.add(name, LongType() if whole[name[6:]] else DoubleType())
    out = rows.mapInArrow(run, schema).checkpoint(eager=True)
    totals = out.groupBy("__pid").agg(*[F.sum(f"__loc_{c}").alias(f"__tot_{c}") for c in sum_cols])
    for c in sum_cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"__sum_{c}") + _partition_offsets(totals, f"__tot_{c}"))
    return out.drop("__pid", *[f"__{x}_{c}" for x in ("sum", "loc") for c in sum_cols])
