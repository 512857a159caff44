"""Visit sequences: code roll-up, code map, per-visit code lists, multi-hot, padding.

Flat forms are the default outputs: (patient_id, visit_idx, codes) rows instead of
one nested array per patient, so a patient with a very long history is spread over
tasks.  The visit position inside a patient comes from the range-partitioned
``dense_index`` (no single-task window over a hot patient).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import icd9_rollup
from .indexing import dense_index


def rolled_codes(diagnoses: DataFrame, transform=icd9_rollup) -> DataFrame:
    """diagnoses(hadm_id, icd9_code) → (hadm_id, code) rolled up, nulls dropped."""
    return diagnoses.filter(F.col("icd9_code").isNotNull()).select("hadm_id", transform(F.col("icd9_code")).alias("code"))


def build_codemap(diagnoses: DataFrame, transform=icd9_rollup) -> DataFrame:
    """(code, code_idx): distinct rolled-up codes numbered in sort order from 0."""
    codes = rolled_codes(diagnoses, transform).select("code").distinct()
    return dense_index(codes, ["code"], "code_idx")


def visit_codes(admissions: DataFrame, diagnoses: DataFrame, codemap: DataFrame,
                transform=icd9_rollup) -> DataFrame:
    """(patient_id, hadm_id, admit_time, codes array<bigint>) for visits with known codes.

    Codes absent from the code map are dropped (inner join); a visit without any
    known code disappears.  Codes are kept with repeats, sorted by index.
    """
    mapped = rolled_codes(diagnoses, transform).join(codemap, "code")
    per_visit = mapped.groupBy("hadm_id").agg(F.array_sort(F.collect_list("code_idx")).alias("codes"))
    return admissions.join(per_visit, "hadm_id").select("patient_id", "hadm_id", "admit_time", "codes")


def visit_positions(visits: DataFrame) -> DataFrame:
    """Add visit_idx = 0-based position of the visit in admit order (hadm_id breaks ties)."""
    return dense_index(visits, ["admit_time", "hadm_id"], "visit_idx", group_cols=["patient_id"])


def visit_sequences_flat(visits: DataFrame, labels: DataFrame) -> DataFrame:
    """(patient_id, label, visit_idx, codes) — the flat form of the nested sequences."""
    pos = visit_positions(visits)
    return pos.join(labels.select("patient_id", "label"), "patient_id", "left").select(
        "patient_id", F.coalesce(F.col("label"), F.lit(0)).alias("label"), "visit_idx", "codes")


def visit_sequences_nested(visits: DataFrame, labels: DataFrame) -> DataFrame:
    """(patient_id, label, seqs array<array<bigint>>) — one row per patient.

    The row holds the whole history of a patient, so its size is that history; use the
    flat form when single patients can be very long.
    """
    nested = visits.groupBy("patient_id").agg(
        F.array_sort(F.collect_list(F.struct("admit_time", "hadm_id", "codes"))).alias("_v"))
    return nested.join(labels.select("patient_id", "label"), "patient_id", "left").select(
        "patient_id", F.coalesce(F.col("label"), F.lit(0)).alias("label"),
        F.transform("_v", lambda v: v["codes"]).alias("seqs"))


def multihot_coordinates(flat: DataFrame) -> DataFrame:
    """(patient_id, visit_idx, code_idx): distinct non-zero cells of the visit × code matrix."""
    return flat.select("patient_id", "visit_idx", F.explode("codes").alias("code_idx")).distinct()


def padded_batch(flat: DataFrame, pad_to: int | None = None) -> DataFrame:
    """(patient_id, seq_length, padded_length, batch_pos): collate order (longest first).

    padded_length is the longest sequence (or ``pad_to``); rows are numbered by
    (seq_length desc, patient_id).
    """
    lengths = flat.groupBy("patient_id").agg(F.count(F.lit(1)).alias("seq_length"))
    longest = lengths.agg(F.max("seq_length")).scalar()
    if pad_to is not None:
        longest = F.greatest(longest, F.lit(pad_to).cast("bigint"))
    ordered = dense_index(lengths, [F.col("seq_length").desc(), F.col("patient_id")], "batch_pos")
    return ordered.select("patient_id", "seq_length", longest.alias("padded_length"), "batch_pos")


def padded_batches(flat: DataFrame, batch_size: int) -> DataFrame:
    """(batch_id, batch_row, patient_id, seq_length, padded_length, visit_idx, codes), padded rows included.

    Patients in id order form batches of ``batch_size``; a batch is sorted by length, longest
    first (ties by id), and padded with empty visits to its own longest sequence.
    """
    lengths = flat.groupBy("patient_id").agg(F.count(F.lit(1)).alias("seq_length"))
    placed = dense_index(lengths, ["patient_id"], "_pos").withColumn("batch_id", F.floor(F.col("_pos") / batch_size))
    own = Window.partitionBy("batch_id")  # at most batch_size rows
    rows = placed.select("batch_id", (F.row_number().over(own.orderBy(F.desc("seq_length"), "patient_id")) - 1).cast("bigint").alias("batch_row"),
                         "patient_id", "seq_length", F.max("seq_length").over(own).alias("padded_length"))
    grid = rows.withColumn("visit_idx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("padded_length") - 1)))
    return grid.join(flat.select("patient_id", "visit_idx", "codes"), ["patient_id", "visit_idx"], "left").withColumn(
        "codes", F.coalesce("codes", F.array().cast("array<bigint>")))


def pad_sequence(seqs, padded_length, pad_value=None):
    """Column: seqs padded with empty visits up to padded_length (nested form)."""
    s = F.col(seqs) if isinstance(seqs, str) else seqs
    n = F.col(padded_length) if isinstance(padded_length, str) else F.lit(padded_length)
    filler = F.array_repeat(F.array().cast("array<bigint>") if pad_value is None else pad_value,
                            F.greatest(n - F.size(s), F.lit(0)).cast("int"))
    return F.concat(s, filler)


def num_features(flat: DataFrame) -> DataFrame:
    """Number of distinct codes used anywhere in the sequences."""
    return flat.select(F.explode("codes").alias("c")).agg(F.count_distinct("c").alias("num_features"))
