from pyspark.ml.linalg import SparseVector

from conftest import rows
from cohortlens.operators import features


def _filtered(spark):
    data = [(1, "DIAG_A", 2.0), (1, "DIAG_A", 3.0), (1, "LAB_X", 7.0), (1, "LAB_X", None),
            (2, "DIAG_A", 10.0), (2, "LAB_X", 1.0), (2, "LAB_X", 1.0), (2, "LAB_X", 4.0)]
    return spark.createDataFrame(data, "patient_id long, event_id string, value double")


def test_feature_index_zero_based_sorted(spark):
    fmap = features.feature_index(_filtered(spark))
    assert rows(fmap, "idx", "event_id") == [(0, "DIAG_A"), (1, "LAB_X")]


def test_aggregate_sum_count_and_normalise(spark):
    f = _filtered(spark)
    fmap = features.feature_index(f)
    agg = features.aggregate_events(f, fmap, "sum_count", threshold=0)
    assert rows(agg) == [(1, 0, 5.0), (1, 1, 1.0), (2, 0, 10.0), (2, 1, 3.0)]
    norm = features.minmax_normalize(agg)
    got = {(r.patient_id, r.feature_id): r.feature_value for r in norm.collect()}
    assert got == {(1, 0): 0.5, (1, 1): 1 / 3, (2, 0): 1.0, (2, 1): 1.0}


def test_normalise_zero_max_is_null(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (2, 0, 0.0)], "patient_id long, feature_id long, feature_value double")
    assert [r.feature_value for r in features.minmax_normalize(df).collect()] == [None, None]


def test_svmlight_rows_format_and_parse(spark):
    feats = spark.createDataFrame([(2, 5, 1.0), (2, 0, 0.25), (1, 3, 1 / 3)],
                                  "patient_id long, feature_id long, feature_value double")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "patient_id long, is_dead int")
    lines = {r.patient_id: r.line for r in features.svmlight_rows(feats, labels).collect()}
    assert lines == {1: "1 0 3:0.333333", 2: "2 1 0:0.250000 5:1.000000"}
    parsed = rows(features.parse_svmlight(features.svmlight_rows(feats, labels)),
                  "patient_id", "label", "feature_id", "feature_value")
    assert parsed == [(1, 0.0, 3, 0.333333), (2, 1.0, 0, 0.25), (2, 1.0, 5, 1.0)]


def test_count_mean_features_with_candidates(spark):
    diag = spark.createDataFrame([("p1", "c1"), ("p1", "c1"), ("p1", "c2"), ("p2", "c3")], "patient_id string, code string")
    assert rows(features.count_features(diag, "code")) == [("p1", "c1", 2.0), ("p1", "c2", 1.0), ("p2", "c3", 1.0)]
    cand = spark.createDataFrame([("c1",), ("c3",)], "feature_name string")
    assert rows(features.count_features(diag, "code", cand)) == [("p1", "c1", 2.0), ("p2", "c3", 1.0)]
    lab = spark.createDataFrame([("p1", "t", 1.0), ("p1", "t", 3.0), ("p2", "u", 5.0)],
                                "patient_id string, test_name string, value double")
    assert rows(features.mean_features(lab)) == [("p1", "t", 2.0), ("p2", "u", 5.0)]


def test_feature_vectors(spark):
    tup = spark.createDataFrame([("p1", "b", 2.0), ("p1", "a", 1.0), ("p2", "c", 3.0)],
                                "patient_id string, feature_name string, feature_value double")
    vecs = {r.patient_id: r.features for r in features.feature_vectors(tup).collect()}
    assert vecs["p1"] == SparseVector(3, {0: 1.0, 1: 2.0})
    assert vecs["p2"] == SparseVector(3, {2: 3.0})
    text = {r.patient_id: (r.vec_size, r.nnz, r.features) for r in features.feature_vector_text(tup).collect()}
    assert text["p1"] == (3, 2, "0:1.000000 1:2.000000")


def test_sparse_vectors_are_laid_out_without_python_objects(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.sql import functions as F
    from cohortlens.functions.sparse import sparse_vector
    r = spark.createDataFrame([(1, [(0, 1.5), (4, 0.0)]), (2, []), (3, [(3, 2.0), (1, -1.0)])], "k long, p array<struct<feature_id:long, feature_value:double>>")
    made = r.withColumn("n", F.lit(5)).select("k", sparse_vector("n", "p").alias("v"))
    assert {x.k: x.v for x in made.collect()} == {1: Vectors.sparse(5, [0, 4], [1.5, 0.0]), 2: Vectors.sparse(5, [], []), 3: Vectors.sparse(5, [1, 3], [-1.0, 2.0])}
    assert "pythonUDF" in made._jdf.queryExecution().executedPlan().toString() and "ArrowEvalPython" in made._jdf.queryExecution().executedPlan().toString()
    for wrong in ([(5, 1.0)], [(1, 1.0), (1, 2.0)], [(1, None)], None):
        bad = spark.createDataFrame([(wrong,)], "p array<struct<feature_id:long, feature_value:double>>").select(sparse_vector(F.lit(5), "p").alias("v"))
        try:
            bad.collect()
        except Exception as e:
            assert "sparse vector" in str(e)
        else:
            raise AssertionError(wrong)


def test_groupings_in_given_partitions_give_the_same_rows_in_one_exchange(spark):
    from cohortlens.operators import features

    ev = spark.createDataFrame([(p, f"e{e}", float(v)) for p in range(20) for e in range(5) for v in range(p % 3)] + [(3, "e1", None), (None, "e2", 1.0)],
                               "patient_id long, event_id string, value double")
    fmap = features.feature_index(ev)
    some = lambda df: sorted(map(str, df.collect()))
    counted = features.count_by_event(ev, partitions=7)
    assert some(counted) == some(features.count_by_event(ev))
    plan = features.count_by_event(ev, partitions=7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and ", 7)" in plan      # dealt before the grouping: no task holds more than its partition's groups
    sums, plain = features.aggregate_events(ev, fmap, partitions=7, threshold=2), features.aggregate_events(ev, fmap, threshold=2)
    assert some(sums) == some(plain)
    assert some(features.patient_feature_lists(plain, partitions=7)) == some(features.patient_feature_lists(plain))


def test_partitions_follow_the_number_of_lines(spark, tmpdir_path, monkeypatch):
    from cohortlens.plans import profile

    spark.range(100).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    assert profile.partitions(spark, tmpdir_path) is None
    monkeypatch.setattr(profile, "PART_EVENTS", 10)
    assert profile.partitions(spark, tmpdir_path) == 30
