"""Multi-label metadata: label frequency, indicators, weighted sample, stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_unit
from .indexing import dense_index

# Fixed values of the reference preprocessing: minimum cases per label, excluded label,
# sample size, sampling weight offset.
MIN_CASES = 1000
EXCLUDED_LABEL = "No Finding"
SAMPLE_SIZE = 80000
WEIGHT_OFFSET = 4e-2


def label_frequency(df: DataFrame, min_cases: int = MIN_CASES, exclude: str = EXCLUDED_LABEL,
                    col: str = "finding_labels") -> DataFrame:
    """(label, n_cases) for labels with at least ``min_cases`` rows, ``exclude`` removed."""
    exploded = df.select(F.explode(F.split(F.col(col), r"\|")).alias("label"))
    return (exploded.groupBy("label").agg(F.count(F.lit(1)).alias("n_cases"))
            .filter((F.col("n_cases") >= min_cases) & (F.col("label") != exclude)))


def label_indicators(df: DataFrame, kept: DataFrame, key: str, col: str = "finding_labels") -> DataFrame:
    """Long form: (key, label, indicator 1) for every kept label that a row carries.

    The schema is fixed whatever labels the data holds; absent pairs are the zeros.
    """
    exploded = df.select(key, F.explode(F.split(F.col(col), r"\|")).alias("label")).distinct()
    return exploded.join(kept.select("label"), "label", "left_semi").select(key, "label", F.lit(1).alias("indicator"))


def wide_indicators(df: DataFrame, labels: list[str], key: str, col: str = "finding_labels") -> DataFrame:
    """One 0/1 column per given label (the caller names them, so the schema is known beforehand)."""
    held = F.split(F.col(col), r"\|")
    return df.select(key, *[F.coalesce(F.array_contains(held, x), F.lit(False)).cast("int").alias(x) for x in labels])


def weighted_sample(df: DataFrame, key: str, weight: str, n: int = SAMPLE_SIZE,
                    offset: float = WEIGHT_OFFSET, salt: str = "ws") -> DataFrame:
    """Weighted sample without replacement of ``n`` rows (Efraimidis–Spirakis).

    w = weight / Σweight + offset; row key = −ln(u)/w with u a hash of the id, and the
    n smallest keys are kept: every row gets its position from the range-partitioned dense
    index and the first n stay, so no task ever holds more than a range partition.
    """
    total = df.agg(F.sum(weight)).scalar()
    # all-zero weights (no label kept) leave only the offset: a uniform sample
    w = F.coalesce(F.try_divide(F.col(weight).cast("double"), total.cast("double")), F.lit(0.0)) + F.lit(offset)
    keyed = df.withColumn("sample_key", -F.log(hash_unit(key, salt)) / w)
    ranked = dense_index(keyed, ["sample_key", key], "_pos")
    return ranked.filter(F.col("_pos") < n).drop("_pos")


def stratified_split(df: DataFrame, key: str, stratum, fractions=(0.2, 0.2), salt: str = "strat") -> DataFrame:
    """Stratified test/valid/train split by position in a hash order inside each stratum.

    With fractions (t, v): the first floor(t·n) rows of a stratum go to 'test', up to
    floor((t+v)·n) to 'valid', the rest to 'train'.  Positions come from the
    range-partitioned dense index, so a large stratum spreads over many tasks.
    """
    s = F.col(stratum) if isinstance(stratum, str) else stratum
    base = df.withColumn("stratum", s).withColumn("_h", hash_unit(key, salt))
    pos = dense_index(base, ["_h", key], "_pos", group_cols=["stratum"])
    sizes = base.groupBy("stratum").agg(F.count(F.lit(1)).alias("_n"))
    t, v = fractions
    split = (F.when(F.col("_pos") < F.floor(F.col("_n") * t), "test")
             .when(F.col("_pos") < F.floor(F.col("_n") * (t + v)), "valid").otherwise("train"))
    return pos.join(sizes, "stratum").withColumn("split", split).drop("_h", "_pos", "_n")


def preprocess_metadata(spark, metadata_path: str, image_root: str, min_cases: int = MIN_CASES,
                        exclude: str = EXCLUDED_LABEL):
    """Metadata preparation for multi-label images, distributed end to end.

    Reads the metadata CSV with its declared schema (header on), lists image files under
    ``image_root`` (``images_*/images/*.png``; no content read), joins them on the file
    name, splits the labels, keeps labels with at least ``min_cases`` rows (``exclude``
    removed) and adds one 0/1 column per kept label (their names are collected: a bounded
    vocabulary of labels).  Returns (metadata, kept_labels).
    """
    from ..sources.readers import image_files, read_csv

    meta = read_csv(spark, metadata_path, METADATA_SCHEMA, header=True)
    files = image_files(spark, image_root).filter(F.col("path").rlike(r"/images_[^/]*/images/[^/]+$"))
    joined = meta.join(files, "image_index")
    kept = label_frequency(joined, min_cases, exclude)
    names = [r["label"] for r in kept.orderBy("label").collect()]
    return wide_indicators(joined, names, "image_index").join(joined, "image_index"), kept


def sample_and_split(df: DataFrame, key: str, weight: str, stratum, n: int = SAMPLE_SIZE, fractions=(0.2, 0.2)) -> DataFrame:
    """The weighted sample first, then its stratified split, as the preparation chains them."""
    return stratified_split(weighted_sample(df, key, weight, n).drop("sample_key"), key, stratum, fractions)


METADATA_SCHEMA = T.StructType([
    T.StructField("image_index", T.StringType()), T.StructField("finding_labels", T.StringType()),
    T.StructField("follow_up_number", T.IntegerType()), T.StructField("patient_id", T.IntegerType()),
    T.StructField("patient_age", T.IntegerType()), T.StructField("patient_gender", T.StringType()),
    T.StructField("view_position", T.StringType()), T.StructField("image_width", T.IntegerType()),
    T.StructField("image_height", T.IntegerType()), T.StructField("spacing_x", T.FloatType()),
    T.StructField("spacing_y", T.FloatType()),
])
