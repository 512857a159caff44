"""Sinks: CSV stages, svmlight text, tidy statistics tables, nested sequences, submissions.

All writers are distributed DataFrame writes (one file per task); nothing goes
through the driver.  Row order is only imposed where it is part of the format
contract (svmlight files are sorted by patient).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite") -> None:
    """One CSV folder per ETL stage (header on by default)."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_lines(lines: DataFrame, path: str, line_col: str = "line", order_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Text file of one column; with ``order_by`` the files are globally sorted
    (range-partitioned sort, so part files concatenate in order)."""
    out = lines.orderBy(*order_by) if order_by else lines
    out.select(F.col(line_col).alias("value")).write.mode(mode).text(path)


def write_svmlight(rows: DataFrame, path: str, with_patient: bool = False, mode: str = "overwrite",
                   limit: int | None = None) -> None:
    """svmlight file from :func:`operators.features.svmlight_rows` output (patients ascending).

    ``with_patient=False`` strips the leading patient id (the training-file variant).
    ``limit`` keeps only the first patients in id order (off by default).
    """
    line = F.col("line") if with_patient else F.regexp_replace("line", r"^\S+\s", "")
    out = rows.select("patient_id", line.alias("line"))
    if limit is not None:
        out = out.orderBy("patient_id").limit(limit)
    write_lines(out, path, "line", ["patient_id"], mode)


def write_statistics(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Several statistics frames as one tidy table (statistic, key, metric, value)."""
    out = None
    for name, df in tables.items():
        keys = [c for c, t in df.dtypes if t == "string"]
        vals = [c for c, t in df.dtypes if t != "string"]
        stacked = df.select(
            F.lit(name).alias("statistic"),
            (F.concat_ws("|", *[F.col(k) for k in keys]) if keys else F.lit("")).alias("key"),
            F.explode(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value"))
                                for v in vals])).alias("m"))
        part = stacked.select("statistic", "key", "m.metric", "m.value")
        out = part if out is None else out.unionByName(part)
    out.write.mode(mode).parquet(path)


def write_sequences(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """Nested sequences (ids, labels, visit arrays) as Parquet partitioned by split."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def write_submission(predictions: DataFrame, path: str, key: str = "patient_id", pred: str = "prediction",
                     mode: str = "overwrite") -> None:
    """(id, prediction) CSV with a header; ids come from the frame, never from row positions."""
    write_csv(predictions.select(key, pred), path, header=True, mode=mode)
