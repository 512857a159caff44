import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from cohortlens.functions.codes import icd9_rollup
from cohortlens.operators import sequences as seq


def test_icd9_rollup(spark):
    df = spark.createDataFrame([("E9352",), ("4019",), ("V5861",), ("12",), (None,), ("E81",)], "c string")
    got = [r.r for r in df.select(icd9_rollup(F.col("c")).alias("r")).collect()]
    assert got == ["E935", "401", "V58", "12", None, "E81"]


def test_visit_sequences(spark):
    adm = spark.createDataFrame([
        (1, 10, dt.datetime(2020, 1, 2)), (1, 11, dt.datetime(2020, 1, 1)), (2, 20, dt.datetime(2020, 5, 1)),
        (2, 21, dt.datetime(2020, 6, 1))], "patient_id long, hadm_id long, admit_time timestamp")
    dx = spark.createDataFrame([(10, "4019"), (10, "25000"), (11, "4011"), (20, "E9352"), (21, None), (21, "9999")],
                               "hadm_id long, icd9_code string")
    train = dx.filter(F.col("hadm_id") != 21)   # code '999' unseen in training → dropped
    cmap = seq.build_codemap(train)
    assert rows(cmap) == [("250", 0), ("401", 1), ("E935", 2)]
    visits = seq.visit_codes(adm, dx, cmap)
    labels = spark.createDataFrame([(2, 1)], "patient_id long, label int")
    flat = seq.visit_sequences_flat(visits, labels)
    assert rows(flat.select("patient_id", "label", "visit_idx", F.array_join("codes", ",").alias("c"))) == [
        (1, 0, 0, "1"), (1, 0, 1, "0,1"), (2, 1, 0, "2")]
    nested = {r.patient_id: (r.label, r.seqs) for r in seq.visit_sequences_nested(visits, labels).collect()}
    assert nested[1] == (0, [[1], [0, 1]])
    assert rows(seq.multihot_coordinates(flat)) == [(1, 0, 1), (1, 1, 0), (1, 1, 1), (2, 0, 2)]
    assert rows(seq.padded_batch(flat)) == [(1, 2, 2, 0), (2, 1, 2, 1)]
    assert seq.num_features(flat).first().num_features == 3
    batches = rows(seq.padded_batches(flat, 2), "batch_id", "batch_row", "patient_id", "seq_length", "padded_length", "visit_idx")
    assert batches == [(0, 0, 1, 2, 2, 0), (0, 0, 1, 2, 2, 1), (0, 1, 2, 1, 2, 0), (0, 1, 2, 1, 2, 1)]
    assert {r.patient_id: r.codes for r in seq.padded_batches(flat, 2).filter("visit_idx = 1").collect()}[2] == []
    alone = rows(seq.padded_batches(flat, 1), "batch_id", "patient_id", "padded_length", "visit_idx")
    assert alone == [(0, 1, 2, 0), (0, 1, 2, 1), (1, 2, 1, 0)]
    padded = visits.groupBy("patient_id").agg(F.collect_list("codes").alias("s")).select(
        "patient_id", seq.pad_sequence("s", 3).alias("p"))
    assert all(len(r.p) == 3 for r in padded.collect())
