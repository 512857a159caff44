"""Feature construction: dictionary, aggregation, normalisation, sparse rows.

Shapes follow the event ETL: (patient_id, feature_id, feature_value) long format,
one sorted (feature_id, value) list per patient, svmlight text lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sparse import format_pairs, sparse_vector
from .indexing import dense_index


def feature_index(events: DataFrame, col: str = "event_id", start: int = 0) -> DataFrame:
    """(idx, event_id): distinct ids numbered in sort order, zero-based by default."""
    vocab = events.select(col).filter(F.col(col).isNotNull()).distinct()
    return dense_index(vocab, [col], "idx", start=start).select("idx", col)


def map_to_index(events: DataFrame, feature_map: DataFrame, col: str = "event_id") -> DataFrame:
    """Replace ``col`` by its dictionary index (inner join; unknown ids drop)."""
    return events.join(feature_map, col).withColumnRenamed("idx", "feature_id").drop(col)


def _dealt(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """The rows in so many partitions by the keys, ahead of a grouping that combines little: a task then holds the groups of one partition."""
    return df if partitions is None else df.repartition(partitions, *keys)


def aggregate_events(filtered: DataFrame, feature_map: DataFrame, rule: str = "sum_count",
                     threshold: int | None = None, partitions: int | None = None) -> DataFrame:
    """(patient_id, feature_id, feature_value) from window-filtered events.

    rule='sum_count': sum of values for feature_id <= threshold, count above it.
    rule='count': count of non-null values for every feature.
    rule='sum': sum for every feature.  Null values are dropped first.
    """
    mapped = map_to_index(filtered.filter(F.col("value").isNotNull()), feature_map)
    g = _dealt(mapped, partitions, "patient_id", "feature_id").groupBy("patient_id", "feature_id").agg(
        F.sum("value").alias("_sum"), F.count("value").alias("_cnt"))
    if rule == "sum_count":
        if threshold is None:
            raise ValueError("rule 'sum_count' needs a threshold")
        val = F.when(F.col("feature_id") <= threshold, F.col("_sum")).otherwise(F.col("_cnt").cast("double"))
    elif rule == "count":
        val = F.col("_cnt").cast("double")
    elif rule == "sum":
        val = F.col("_sum")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return g.select("patient_id", "feature_id", val.alias("feature_value"))


def count_by_event(filtered: DataFrame, partitions: int | None = None) -> DataFrame:
    """(patient_id, event_id, feature_value) = count of non-null values (event ETL count)."""
    return (
        _dealt(filtered.filter(F.col("value").isNotNull()), partitions, "patient_id", "event_id")
        .groupBy("patient_id", "event_id")
        .agg(F.count("value").alias("feature_value"))
    )


def minmax_normalize(features: DataFrame, key: str = "feature_id", value: str = "feature_value") -> DataFrame:
    """value / max(value) per feature (min taken as 0); max 0 gives null, not an error.

    The per-feature max is an aggregate joined back (not a window), so a feature that
    occurs in a third of all rows is combined map-side instead of buffered in one task.
    """
    mx = features.groupBy(key).agg(F.max(value).alias("_max"))
    return features.join(mx, key).select(
        *[c for c in features.columns if c != value],
        F.try_divide(F.col(value).cast("double"), F.col("_max").cast("double")).alias(value),
    )


def patient_feature_lists(features: DataFrame, partitions: int | None = None) -> DataFrame:
    """(patient_id, features array<struct<feature_id, feature_value>>) sorted by feature_id.

    A patient's list holds at most one entry per dictionary feature.
    """
    return _dealt(features, partitions, "patient_id").groupBy("patient_id").agg(
        F.array_sort(F.collect_list(F.struct("feature_id", "feature_value"))).alias("features"))


def svmlight_rows(features: DataFrame, labels: DataFrame, label_col: str = "is_dead",
                  with_patient: bool = True, digits: int = 6, partitions: int | None = None) -> DataFrame:
    """(patient_id, line): "label id:value id:value ..." with ids ascending.

    ``with_patient`` prefixes the patient id (the second deliverable of the ETL).
    """
    lists = patient_feature_lists(features, partitions).join(labels.select("patient_id", label_col), "patient_id")
    body = format_pairs("features", digits=digits)
    head = F.col(label_col).cast("string")
    if with_patient:
        head = F.concat_ws(" ", F.col("patient_id").cast("string"), head)
    return lists.select("patient_id", F.concat_ws(" ", head, body).alias("line"))


def parse_svmlight(lines: DataFrame, line_col: str = "line", with_patient: bool = True) -> DataFrame:
    """svmlight text → (patient_id?, label, feature_id, feature_value) coordinates.

    Zero-based ids are accepted (Spark's libsvm source requires one-based ids).
    """
    tokens = F.split(F.trim(F.col(line_col)), r"\s+")
    first = 1 if with_patient else 0
    base = lines.select(
        *([tokens.getItem(0).cast("bigint").alias("patient_id")] if with_patient else []),
        tokens.getItem(first).cast("double").alias("label"),
        F.slice(tokens, first + 2, 1 << 30).alias("_kv"),
    )
    kv = base.select(*[c for c in base.columns if c != "_kv"], F.explode("_kv").alias("_p"))
    parts = F.split("_p", ":")
    return kv.select(
        *[c for c in kv.columns if c != "_p"],
        parts.getItem(0).cast("bigint").alias("feature_id"),
        parts.getItem(1).cast("double").alias("feature_value"),
    )


# ---- typed clinical feature tuples -------------------------------------------------

def count_features(df: DataFrame, item_col: str, candidates: DataFrame | None = None) -> DataFrame:
    """(patient_id, feature_name, feature_value): number of rows per (patient, item).

    With ``candidates`` (one column ``feature_name``), rows are semi-joined to the
    candidate list before the aggregate.
    """
    src = df.select("patient_id", F.col(item_col).alias("feature_name"))
    if candidates is not None:
        src = src.join(candidates.select("feature_name").distinct(), "feature_name", "left_semi")
    return src.groupBy("patient_id", "feature_name").agg(F.count(F.lit(1)).cast("double").alias("feature_value"))


def mean_features(df: DataFrame, item_col: str = "test_name", value_col: str = "value",
                  candidates: DataFrame | None = None) -> DataFrame:
    """(patient_id, feature_name, feature_value): mean value per (patient, item)."""
    src = df.select("patient_id", F.col(item_col).alias("feature_name"), F.col(value_col).alias("v"))
    if candidates is not None:
        src = src.join(candidates.select("feature_name").distinct(), "feature_name", "left_semi")
    return src.groupBy("patient_id", "feature_name").agg(F.avg("v").alias("feature_value"))


def index_feature_tuples(tuples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number feature names in sort order; returns (indexed tuples, dictionary)."""
    vocab = feature_index(tuples, "feature_name")
    indexed = tuples.join(vocab, "feature_name").select(
        "patient_id", F.col("idx").alias("feature_id"), "feature_value")
    return indexed, vocab


def feature_vectors(tuples: DataFrame) -> DataFrame:
    """(patient_id, features: SparseVector) from (patient_id, feature_name, feature_value).

    The dictionary size is a scalar subquery; all grouping happens in SQL.
    """
    indexed, vocab = index_feature_tuples(tuples)
    lists = patient_feature_lists(indexed).withColumn("vec_size", vocab.agg(F.count(F.lit(1))).scalar())
    return lists.select("patient_id", sparse_vector("vec_size", "features").alias("features"))


def feature_vector_text(tuples: DataFrame, digits: int = 6) -> DataFrame:
    """(patient_id, vec_size, nnz, features text): the coordinate form of :func:`feature_vectors`."""
    indexed, vocab = index_feature_tuples(tuples)
    lists = patient_feature_lists(indexed).withColumn("vec_size", vocab.agg(F.count(F.lit(1))).scalar())
    return lists.select(
        "patient_id", "vec_size", F.size("features").cast("bigint").alias("nnz"),
        format_pairs("features", digits=digits).alias("features"))
