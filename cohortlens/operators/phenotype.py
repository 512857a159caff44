"""Rule-based phenotyping (case / control / other) as one flag row per patient.

The reference builds many distinct/subtract/intersection RDDs; here each input table
is aggregated once by patient (map-side combine), the flag rows are joined on
patient_id and the class is a CASE expression.  Criteria are data (a ``PhenotypeRules``
object), compared lower-cased and trimmed on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CASE, CONTROL, OTHER = 1, 2, 3


@dataclass(frozen=True)
class LabRule:
    test_name: str
    op: str          # one of '>', '>=', '<', '<='
    threshold: float

    def column(self, name: Column, value: Column) -> Column:
        ops = {">": value > self.threshold, ">=": value >= self.threshold,
               "<": value < self.threshold, "<=": value <= self.threshold}
        return (name == self.test_name.strip().lower()) & ops[self.op]


@dataclass(frozen=True)
class PhenotypeRules:
    t1_dx: tuple[str, ...]
    t2_dx: tuple[str, ...]
    t1_med: tuple[str, ...]
    t2_med: tuple[str, ...]
    related_dx: tuple[str, ...]
    related_dx_prefix: str
    glucose_substring: str
    abnormal_labs: tuple[LabRule, ...] = field(default_factory=tuple)


def _norm(values) -> list[str]:
    return sorted({v.strip().lower() for v in values})


# The type-2 diabetes criteria of the reference pipeline (ICD-9 codes,
# medicine names, lab rules), as given there.
T2DM_RULES = PhenotypeRules(
    t1_dx=("250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41", "250.43",
           "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83", "250.91", "250.93"),
    t2_dx=("250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6",
           "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02"),
    t1_med=("lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente", "insulin nph",
            "insulin reg", "insulin,ultralente"),
    t2_med=("chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol", "glucotrol xl",
            "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta", "glimepiride", "amaryl",
            "repaglinide", "prandin", "nateglinide", "metformin", "rosiglitazone", "pioglitazone", "acarbose",
            "miglitol", "sitagliptin", "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide",
            "avandia", "actos", "actos", "glipizide"),
    related_dx=("790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648", "648",
                "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4"),
    related_dx_prefix="250.",
    glucose_substring="glucose",
    abnormal_labs=(
        LabRule("hba1c", ">=", 6.0), LabRule("hemoglobin a1c", ">=", 6.0),
        LabRule("fasting glucose", ">=", 110.0), LabRule("fasting blood glucose", ">=", 110.0),
        LabRule("fasting plasma glucose", ">=", 110.0), LabRule("glucose", ">", 110.0),
        LabRule("glucose, serum", ">", 110.0),
    ),
)


def patient_universe(diagnostic: DataFrame, medication: DataFrame, lab: DataFrame) -> DataFrame:
    """Distinct patient ids over the three tables (union distinct)."""
    return (
        diagnostic.select("patient_id")
        .unionByName(medication.select("patient_id"))
        .unionByName(lab.select("patient_id"))
        .distinct()
    )


def dx_flags(diagnostic: DataFrame, rules: PhenotypeRules) -> DataFrame:
    code = F.lower(F.trim(F.col("code")))
    related = code.isin(_norm(rules.related_dx)) | code.startswith(rules.related_dx_prefix.strip().lower())
    return diagnostic.groupBy("patient_id").agg(
        F.max(code.isin(_norm(rules.t1_dx))).alias("t1_dx"),
        F.max(code.isin(_norm(rules.t2_dx))).alias("t2_dx"),
        F.max(related).alias("related_dx"),
    )


def med_flags(medication: DataFrame, rules: PhenotypeRules) -> DataFrame:
    med = F.lower(F.trim(F.col("medicine")))
    is1, is2 = med.isin(_norm(rules.t1_med)), med.isin(_norm(rules.t2_med))
    return medication.groupBy("patient_id").agg(
        F.max(is1).alias("t1_med"), F.max(is2).alias("t2_med"),
        F.min(F.when(is1, F.col("date"))).alias("first_t1_med"),
        F.min(F.when(is2, F.col("date"))).alias("first_t2_med"),
    )


def abnormal_predicate(rules: PhenotypeRules) -> Column:
    name, value = F.lower(F.trim(F.col("test_name"))), F.col("value")
    pred = F.lit(False)
    for r in rules.abnormal_labs:
        pred = pred | r.column(name, value)
    return pred


def lab_flags(lab: DataFrame, rules: PhenotypeRules) -> DataFrame:
    name = F.lower(F.trim(F.col("test_name")))
    return lab.groupBy("patient_id").agg(
        F.max(name.contains(rules.glucose_substring.lower())).alias("has_glucose"),
        F.max(abnormal_predicate(rules)).alias("abnormal_lab"),
    )


def abnormal_lab_patients(lab: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """(patient_id, n_abnormal): patients with at least one abnormal lab result."""
    return lab.filter(abnormal_predicate(rules)).groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("n_abnormal"))


def first_event_order(medication: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """Patients whose first type-2 medicine comes strictly before their first type-1 medicine."""
    m = med_flags(medication, rules)
    return m.filter(F.col("first_t2_med") < F.col("first_t1_med")).select(
        "patient_id", "first_t1_med", "first_t2_med")


def phenotype_flags(diagnostic: DataFrame, medication: DataFrame, lab: DataFrame,
                    rules: PhenotypeRules) -> DataFrame:
    pts = patient_universe(diagnostic, medication, lab)
    f = (pts.join(dx_flags(diagnostic, rules), "patient_id", "left")
         .join(med_flags(medication, rules), "patient_id", "left")
         .join(lab_flags(lab, rules), "patient_id", "left"))
    b = {c: F.coalesce(F.col(c), F.lit(False)) for c in
         ("t1_dx", "t2_dx", "related_dx", "t1_med", "t2_med", "has_glucose", "abnormal_lab")}
    base = ~b["t1_dx"] & b["t2_dx"]
    case = base & (
        ~b["t1_med"]
        | (b["t1_med"] & ~b["t2_med"])
        | (b["t1_med"] & b["t2_med"] & (F.col("first_t2_med") < F.col("first_t1_med")))
    )
    control = b["has_glucose"] & ~b["abnormal_lab"] & ~b["related_dx"]
    return f.withColumn("is_case", F.coalesce(case, F.lit(False))).withColumn("is_control", control)


def phenotype(diagnostic: DataFrame, medication: DataFrame, lab: DataFrame,
              rules: PhenotypeRules = T2DM_RULES) -> DataFrame:
    """(patient_id, phenotype): 1 case, 2 control, 3 other; every patient appears once."""
    f = phenotype_flags(diagnostic, medication, lab, rules)
    label = F.when(F.col("is_case"), F.lit(CASE)).when(F.col("is_control"), F.lit(CONTROL)).otherwise(F.lit(OTHER))
    return f.select("patient_id", label.alias("phenotype"))
