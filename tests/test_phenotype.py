import datetime as dt

from conftest import rows
from cohortlens.operators import phenotype as ph

D = dt.date


def _tables(spark):
    diag = spark.createDataFrame([
        ("c1", D(2010, 1, 1), "250.00"),            # case rule 1: T2 dx, no T1 dx, no T1 med
        ("c2", D(2010, 1, 1), "250.02"),            # case rule 2: T2 dx, T1 med, no T2 med
        ("c3", D(2010, 1, 1), "250.4"),             # case rule 3: both meds, T2 first
        ("o3", D(2010, 1, 1), "250.4"),             # both meds, T1 first → other
        ("o1", D(2010, 1, 1), "250.01"),            # T1 dx → not case
        ("o1", D(2010, 1, 1), "250.00"),
        ("k2", D(2010, 1, 1), "401.9"),             # control candidate with a non-diabetes dx
        ("o2", D(2010, 1, 1), "v77.1"),             # related dx (lower-case in data) → not control
    ], "patient_id string, date date, code string")
    med = spark.createDataFrame([
        ("c2", D(2010, 2, 1), "Lantus"),
        ("c3", D(2010, 1, 1), "Metformin"), ("c3", D(2010, 3, 1), "insulin nph"),
        ("o3", D(2010, 1, 1), "lantus"), ("o3", D(2010, 3, 1), "glucatrol"),
    ], "patient_id string, date date, medicine string")
    lab = spark.createDataFrame([
        ("k1", D(2010, 1, 1), "glucose", 90.0),          # control
        ("k2", D(2010, 1, 1), "fasting glucose", 100.0),  # control
        ("o2", D(2010, 1, 1), "glucose", 95.0),           # related dx → other
        ("o4", D(2010, 1, 1), "glucose", 120.0),          # abnormal (glucose > 110) → other
        ("o5", D(2010, 1, 1), "HbA1c", 6.0),              # no glucose test (and abnormal) → other
    ], "patient_id string, date date, test_name string, value double")
    return diag, med, lab


def test_phenotype_classes(spark):
    diag, med, lab = _tables(spark)
    got = dict(rows(ph.phenotype(diag, med, lab)))
    assert got == {"c1": 1, "c2": 1, "c3": 1, "o1": 3, "o2": 3, "o3": 3, "k1": 2, "k2": 2, "o4": 3, "o5": 3}


def test_first_event_order_and_abnormal(spark):
    diag, med, lab = _tables(spark)
    assert [r.patient_id for r in ph.first_event_order(med, ph.T2DM_RULES).collect()] == ["c3"]
    assert rows(ph.abnormal_lab_patients(lab, ph.T2DM_RULES)) == [("o4", 1), ("o5", 1)]
    assert len(ph.patient_universe(diag, med, lab).collect()) == 10
