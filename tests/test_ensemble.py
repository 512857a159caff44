import math

from conftest import rows
from cohortlens.operators import ensemble


def _rows(spark):
    data = [(1, 1, [(0, 1.0), (2, 0.5)]), (2, 0, [(1, 1.0)]), (3, 1, [(0, 0.2), (1, 0.4), (2, 1.0)])]
    return spark.createDataFrame(
        data, "patient_id long, label int, features array<struct<feature_id:long, feature_value:double>>")


def _reference_pass(samples, eta, mu):
    w = {}
    for feats, y in samples:
        z = math.fsum(w.get(f, 0.0) * v for f, v in feats)
        sig = 1.0 - 1.0 / (1.0 + math.exp(z)) if z < 0 else 1.0 / (1.0 + math.exp(-z))
        for f, v in feats:
            w[f] = w.get(f, 0.0) + eta * (v * (y - sig)) - 2 * eta * mu * w.get(f, 0.0)
    return w


def test_sgd_single_shard_is_the_sequential_pass(spark):
    from pyspark.sql import functions as F
    r = _rows(spark).withColumn("model_id", F.lit(0))
    got = {(m, f): w for m, f, w in rows(ensemble.sgd_train(r, eta=0.1, mu=0.01, shards=1))}
    want = _reference_pass([([(0, 1.0), (2, 0.5)], 1), ([(1, 1.0)], 0), ([(0, 0.2), (1, 0.4), (2, 1.0)], 1)], 0.1, 0.01)
    assert set(got) == {(0, f) for f in want}
    assert all(abs(got[(0, f)] - want[f]) < 1e-15 for f in want)


def test_ensemble_score(spark):
    w = spark.createDataFrame([(0, 0, 1.0), (0, 1, -2.0), (1, 2, 0.5)], "model_id int, feature_id long, weight double")
    got = dict(rows(ensemble.ensemble_score(_rows(spark), w, n_models=2)))
    sig = lambda z: 1 / (1 + math.exp(-z))
    assert abs(got[1] - (sig(1.0) + sig(0.25)) / 2) < 1e-12
    assert abs(got[2] - (sig(-2.0) + 0.5) / 2) < 1e-12
    assert abs(got[3] - (sig(0.2 - 0.8) + sig(0.5)) / 2) < 1e-12


def test_sgd_sharded_is_average_of_shard_passes(spark):
    from pyspark.sql import functions as F
    from cohortlens.functions.hashing import hash_unit
    r = _rows(spark).withColumn("model_id", F.lit(0))
    shard_of = {x.patient_id: x.s for x in r.select("patient_id", F.floor(hash_unit("patient_id", "shard") * 2)
                                                         .cast("int").alias("s")).collect()}
    data = {1: ([(0, 1.0), (2, 0.5)], 1), 2: ([(1, 1.0)], 0), 3: ([(0, 0.2), (1, 0.4), (2, 1.0)], 1)}
    want = {}
    for s in (0, 1):
        w = _reference_pass([data[p] for p in sorted(data) if shard_of[p] == s], 0.1, 0.0)
        for f, v in w.items():
            want[f] = want.get(f, 0.0) + v / 2
    got = {f: w for _, f, w in rows(ensemble.sgd_train(r, eta=0.1, mu=0.0, shards=2))}
    assert set(got) == set(want) and all(abs(got[f] - want[f]) < 1e-15 for f in want)


def test_shards_do_not_depend_on_the_rows(spark, tmpdir_path):
    from pyspark.sql import functions as F
    r = _rows(spark).withColumn("model_id", F.lit(0))
    same = rows(ensemble.sgd_train(r))
    assert same == rows(ensemble.sgd_train(r, shards=ensemble.SHARDS))
    ensemble.store_weights(ensemble.sgd_train(r), tmpdir_path + "/weights")
    assert rows(ensemble.load_weights(spark, tmpdir_path + "/weights")) == same


def test_sgd_streams_its_shards(spark):
    from pyspark.sql import functions as F
    data = [(p, p % 2, [(f, float(f + p % 5) / 7) for f in range(p % 3, 9, 2)]) for p in range(60, 0, -1)] + [(70, 1, [])]
    r = spark.createDataFrame(data, "patient_id long, label int, features array<struct<feature_id:long, feature_value:double>>")
    r = r.withColumn("model_id", F.explode(F.array(F.lit(0), F.lit(3))))
    want = _reference_pass([(f, y) for _, y, f in sorted(data)], 0.1, 0.01)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # a shard comes in many batches
    try:
        trained = ensemble.sgd_train(r, eta=0.1, mu=0.01, shards=1)
        got = {(m, f): w for m, f, w in rows(trained)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {(m, f) for m in (0, 3) for f in want} and all(abs(got[m, f] - want[f]) < 1e-12 for m, f in got)
    plan = trained._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan  # no task holds a whole shard
