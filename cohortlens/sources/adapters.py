"""Adapters from the driver tables to the shapes the operators expect.

The driver tables hold no clinical data, so each adapter is a deterministic,
SQL-expressible mapping (the DuckDB oracle repeats it verbatim):

* events ("orders profile"): one row per (order line, event class):
  patient_id = o_custkey, event_date = o_orderdate as DATE and three events per line:
  ``DIAG_<p_type>`` (value l_quantity), ``DRUG_<p_brand>`` (value l_quantity) and
  ``LAB_<p_name>`` (value l_extendedprice).
* mortality: customers with a negative balance that placed orders; death_date is
  their last order date, label 1.
* diagnostic / medication / lab_result: the three classes above as typed tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from .tables import read_table

# Event-class prefixes used in event ids.
EVENT_CLASSES = ("DIAG", "DRUG", "LAB")


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_key, patient_id, event_date) of the orders."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    )


def order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """orders ⋈ lineitem ⋈ part, only the columns the profiles need; ``orders``: those of :func:`order_dates` to take, else all.

    lineitem is the fact table; orders joins on its key (shuffle join at scale) and
    part is a dimension that AQE broadcasts when its runtime size is under the
    broadcast threshold (it grows with the scale factor, so it is never forced).
    """
    o = order_dates(spark, sf_dir) if orders is None else orders
    l = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
    )
    p = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"), "p_type", "p_brand", "p_name", "p_size"
    )
    return l.join(o, "order_key").join(p, "part_key")


def order_events(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """events(patient_id, event_id, event_class, item, event_date, value, order_key, line_number, part_key).

    The three events of a line are produced by one ``inline`` generator in the same
    stage (no union of three scans).
    """
    ol = order_lines(spark, sf_dir, orders)
    ev = F.array(
        F.struct(F.lit("DIAG").alias("event_class"), F.col("p_type").alias("item"), F.col("qty").alias("value")),
        F.struct(F.lit("DRUG").alias("event_class"), F.col("p_brand").alias("item"), F.col("qty").alias("value")),
        F.struct(F.lit("LAB").alias("event_class"), F.col("p_name").alias("item"), F.col("price").alias("value")),
    )
    return ol.select(
        "patient_id", "event_date", "order_key", "line_number", "part_key", F.inline(ev)
    ).select(
        "patient_id",
        F.concat(F.col("event_class"), F.lit("_"), F.col("item")).alias("event_id"),
        "event_class", "item", "event_date", "value", "order_key", "line_number", "part_key",
    )


def mortality_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mortality(patient_id, death_date, label): negative-balance customers with orders."""
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("patient_id")
    )
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").cast("date").alias("d")
    )
    return (
        o.join(c, "patient_id", "left_semi")
        .groupBy("patient_id")
        .agg(F.max("d").alias("death_date"))
        .withColumn("label", F.lit(1))
    )


def event_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as clinical events: user → patient, type → event id."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("patient_id"),
        F.upper(F.col("event_type")).alias("event_id"),
        F.col("ts").cast("date").alias("event_date"),
        "value",
        F.col("event_id").alias("seq"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def raw_lab_text(spark: SparkSession, sf_dir: str, blank_fraction: float = 0.05) -> DataFrame:
    """Raw lab export rows, all text: Member_ID, Date_Resulted (zoned ISO), Result_Name, Numeric_Result.

    Numeric_Result carries thousands separators ("12,345.67"); a hash-chosen fraction
    of rows has an empty result, as in the raw clinical exports.
    """
    o = read_table(spark, sf_dir, "orders")
    num = F.format_number(F.col("o_totalprice"), 2)
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").cast("string").alias("Member_ID"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Date_Resulted"),
        F.col("o_orderpriority").alias("Result_Name"),
        F.when(hash_unit("o_orderkey", "blank") < blank_fraction, F.lit("")).otherwise(num).alias("Numeric_Result"),
    )


def graph_patients(spark: SparkSession, sf_dir: str, mortality: DataFrame) -> DataFrame:
    """patient(patient_id, sex, dob, dod) with missing text filled by '' (na.fill)."""
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("sex"))
    m = mortality.select("patient_id", F.date_format("death_date", "yyyy-MM-dd").alias("dod"))
    return (
        c.join(m, "patient_id", "left")
        .withColumn("dob", F.lit(None).cast("string"))
        .na.fill("", subset=["sex", "dob", "dod"])
        .select("patient_id", "sex", "dob", "dod")
    )


def order_label_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-label 'image metadata' stand-in: one row per order with
    finding_labels = sorted distinct part types joined by '|'.
    """
    l = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("part_key"))
    p = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_key"), "p_type")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("patient_id"))
    per_order = (
        l.join(p, "part_key").select("order_key", "p_type").distinct()
        .groupBy("order_key")
        .agg(F.array_join(F.array_sort(F.collect_list("p_type")), "|").alias("finding_labels"))
    )
    return per_order.join(o, "order_key")


def _item(kind: str) -> Column:
    sep, name = (".", F.col("p_name")) if kind == "diagnostic" else ("-", F.lower("p_brand"))
    return F.concat_ws(sep, name, F.col("p_size").cast("string"))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, patient_id, item, date): the diagnoses and medicines of :func:`phenotype_inputs`, both from one join of the lines."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), _item(k).alias("item")) for k in ("diagnostic", "medication")])
    return order_lines(spark, sf_dir).select("patient_id", F.col("event_date").alias("date"), F.inline(kinds)).select("kind", "patient_id", "item", "date")


def line_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, date, code, medicine): the diagnosis and the medicine of :func:`phenotype_inputs` of a line, side by side."""
    return order_lines(spark, sf_dir).select("patient_id", F.col("event_date").alias("date"), _item("diagnostic").alias("code"), _item("medication").alias("medicine"))


def phenotype_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(diagnostic, medication, lab_result) with fine-grained codes for the phenotype rules.

    diagnostic.code = "<p_name>.<p_size>" (family.subcode, like ICD-9 "250.01"),
    medication.medicine = "<lower(p_brand)>-<p_size>", lab_result = the cleaned raw
    lab export (test name = order priority, value = order total).
    """
    from .readers import clean_lab_text

    ol = order_lines(spark, sf_dir)
    diag = ol.select("patient_id", F.col("event_date").alias("date"),
                     _item("diagnostic").alias("code"),
                     "order_key", "line_number")
    med = ol.select("patient_id", F.col("event_date").alias("date"),
                    _item("medication").alias("medicine"),
                    "order_key", "line_number")
    lab = clean_lab_text(raw_lab_text(spark, sf_dir), with_order_key=True)
    return diag, med, lab


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADMISSIONS stand-in: (patient_id, hadm_id, admit_time) = orders."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admit_time"))


def diagnoses_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DIAGNOSES_ICD stand-in: (hadm_id, icd9_code) per order line.

    icd9_code = first letter of p_type ‖ p_size ‖ (p_partkey mod 10), e.g. "E115",
    "S53", "L284": E-codes and numeric-like codes of several lengths.
    """
    l = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("hadm_id"),
                                                    F.col("l_partkey").alias("part_key"))
    p = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"),
        F.concat(F.substring("p_type", 1, 1), F.col("p_size").cast("string"),
                 F.pmod(F.col("p_partkey"), F.lit(10)).cast("string")).alias("icd9_code"))
    return l.join(p, "part_key").select("hadm_id", "icd9_code")
