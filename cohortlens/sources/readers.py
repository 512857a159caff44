"""File readers of the reference pipelines, as Spark sources (never driver-side parsing)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared schemas (never inferred).
EVENTS_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()), T.StructField("event_id", T.StringType()),
    T.StructField("event_description", T.StringType()), T.StructField("event_date", T.DateType()),
    T.StructField("value", T.DoubleType()),
])
MORTALITY_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()), T.StructField("death_date", T.DateType()),
    T.StructField("label", T.IntegerType()),
])
FEATURE_MAP_SCHEMA = T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("event_id", T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             drop_malformed: bool = False, sep: str = ",") -> DataFrame:
    """CSV with a declared schema.

    With ``drop_malformed`` a row is dropped when it has the wrong number of fields or
    when any field does not convert to its declared type — whatever columns are later
    selected.  (Spark's own DROPMALFORMED only converts the columns a query reads, so
    its result depends on the select list.)  All fields are read as text, the token
    count is checked by the parser (column pruning off for this read), and one filter
    over every column keeps the rows whose non-empty fields all convert.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if not drop_malformed:
        return reader.schema(schema).option("dateFormat", "yyyy-MM-dd").csv(path)
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = reader.schema(text_schema).option("columnPruning", False).option("mode", "DROPMALFORMED").csv(path)
    typed = [F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in schema.fields]
    ok = F.lit(True)
    for f, t in zip(schema.fields, typed):
        ok = ok & (F.col(f.name).isNull() | F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").isNotNull())
    return raw.filter(ok).select(*typed)


def read_signals(spark: SparkSession, path: str, n_features: int = 178, label_col: str = "y") -> DataFrame:
    """Wide numeric CSV (row name, X1..Xn, class from 1) → (row_name, features array<double>, label from 0).

    The schema is declared; rows with a wrong field count or a field that is no number are dropped.
    """
    names = [f"X{i}" for i in range(1, n_features + 1)]
    schema = T.StructType([T.StructField("row_name", T.StringType()), *[T.StructField(x, T.DoubleType()) for x in names],
                           T.StructField(label_col, T.IntegerType())])
    wide = read_csv(spark, path, schema, header=True, drop_malformed=True)
    return wide.select("row_name", F.array(*names).alias("features"), (F.col(label_col) - 1).alias("label"))


def table_name_from_path(path: str) -> str:
    """'…/dir/lab_results.csv' → 'lab_results' (driver-side string helper)."""
    base = re.split(r"[\\/]", path.rstrip("/\\"))[-1]
    return re.sub(r"\.[^.]*$", "", base)


def load_csv_as_view(spark: SparkSession, path: str, schema: T.StructType, view: str | None = None) -> DataFrame:
    """Read a CSV (header, DROPMALFORMED) and register it as a temp view."""
    df = read_csv(spark, path, schema, header=True, drop_malformed=True)
    df.createOrReplaceTempView(view or table_name_from_path(path))
    return df


def code_list(spark: SparkSession, path: str) -> DataFrame:
    """One code per line → distinct lower-cased, trimmed codes (column ``code``)."""
    return (spark.read.text(path).select(F.lower(F.trim("value")).alias("code"))
            .filter(F.col("code") != "").distinct())


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """One-based svmlight/libsvm file → (label, features vector)."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def read_svmlight_text(spark: SparkSession, path: str) -> DataFrame:
    """svmlight text (zero-based ids allowed) → (label, feature_id, feature_value) coordinates."""
    from ..operators.features import parse_svmlight
    lines = spark.read.text(path).withColumnRenamed("value", "line").withColumn("row_id", F.monotonically_increasing_id())
    return parse_svmlight(lines, with_patient=False)


def image_files(spark: SparkSession, root: str, pattern: str = "*.png") -> DataFrame:
    """(image_index, path) for image files under ``root`` (distributed listing, no content read)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(root).select("path"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("image_index"), "path")


def parse_zoned_date(col, pattern: str = "yyyy-MM-dd'T'HH:mm:ssX"):
    """Zoned timestamp text → the UTC calendar DATE of that instant.

    The instant is converted to UTC wall-clock time before the date is taken, so the
    result does not depend on the session time zone.
    """
    ts = F.to_timestamp(F.col(col) if isinstance(col, str) else col, pattern)
    return F.to_date(F.convert_timezone(None, F.lit("UTC"), ts))


def clean_lab_text(raw: DataFrame, with_order_key: bool = False) -> DataFrame:
    """Raw lab text rows → lab_result(patient_id, date, test_name, value).

    Empty or non-numeric results are dropped; thousands separators are removed before
    the cast; names are lower-cased.
    """
    value = F.expr("try_cast(replace(Numeric_Result, ',', '') AS DOUBLE)")
    out = raw.filter(F.trim(F.col("Numeric_Result")) != "").select(
        F.col("Member_ID").cast("bigint").alias("patient_id"),
        parse_zoned_date("Date_Resulted").alias("date"),
        F.lower(F.trim("Result_Name")).alias("test_name"),
        value.alias("value"),
        *(["order_key"] if with_order_key and "order_key" in raw.columns else []),
    )
    return out.filter(F.col("value").isNotNull() & ~F.isnan("value"))
