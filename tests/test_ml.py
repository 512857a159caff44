import os
import subprocess
import sys

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import ml, splits

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _vectors(spark, n=60, d=6, seed=2):
    rng = np.random.default_rng(seed)
    X = np.vstack([rng.normal(c, 0.3, (n // 3, d)) for c in (0.0, 3.0, -3.0)])
    labels = np.repeat([0, 1, 2], n // 3)
    df = spark.createDataFrame([(i, X[i].tolist(), int(labels[i])) for i in range(n)],
                               "vec_id long, embedding array<float>, label int")
    return ml.vector_rows(df), X


def test_standardize_matches_numpy(spark):
    df, X = _vectors(spark)
    out = ml.standardize(df).select("vec_id", vector_to_array("scaled").alias("s")).orderBy("vec_id").collect()
    Xf = X.astype(np.float32).astype(np.float64)
    want = (Xf - Xf.mean(0)) / Xf.std(0, ddof=1)
    assert np.allclose(np.array([r.s for r in out]), want, atol=1e-9)


def test_scale_and_project_maps_new_rows_like_training(spark):
    df, _ = _vectors(spark)
    model = ml.scale_and_project(k=2).fit(df)
    a = model.transform(df).filter("vec_id = 5").select(vector_to_array("pca").alias("p")).first().p
    new = df.filter("vec_id = 5").select("features")            # a "new" vector alone
    b = model.transform(new).select(vector_to_array("pca").alias("p")).first().p
    assert np.allclose(a, b)


def test_clustering_separates_clear_groups(spark):
    df, _ = _vectors(spark)
    p = ml.pca(ml.standardize(df), k=2)
    assert ml.cluster_purity(p, "kmeans", k=3, max_iter=20).first().purity == 1.0
    assert ml.cluster_purity(p, "gmm", k=3, max_iter=20).first().purity > 0.9


def test_classifiers_on_separable_data(spark):
    rows = spark.createDataFrame([(i, float(i % 2), [float(i % 2) * 2 - 1, 0.1 * (i % 5)]) for i in range(80)],
                                 "patient_id long, label double, x array<double>")
    df = ml.vector_rows(rows, "x")
    for kind in ("lr", "svm", "tree"):
        pred = ml.fit_predict(df, df, kind)
        assert pred.filter(F.col("prediction") != F.col("label")).count() == 0


def _noisy(spark, n=300):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(3)
    x = rng.normal(0, [1.0, 5.0], (n, 2))
    y = (x[:, 0] + 0.2 * x[:, 1] + rng.normal(0, 1, n) > 0).astype(float)
    return x, y, spark.createDataFrame([(i, float(b), Vectors.dense(a.tolist())) for i, (a, b) in enumerate(zip(x, y))], ["patient_id", "label", "features"])


def test_logistic_regression_reaches_the_penalised_optimum(spark):
    import numpy as np
    from cohortlens.operators import ml
    x, y, df = _noisy(spark)
    model = ml.classifier("lr", len(y)).fit(df)
    w = np.zeros(3)
    a = np.c_[x, np.ones(len(y))]
    for _ in range(50):                      # Newton steps on |w|^2 / 2 + sum of losses (the intercept is free)
        p = 1 / (1 + np.exp(-a @ w))
        free = np.diag([1.0, 1.0, 0.0])
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + free, a.T @ (p - y) + free @ w)
    assert np.allclose([*model.coefficients, model.intercept], w, atol=1e-3)


def test_cv_auc_is_exact(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    from cohortlens.operators import metrics, ml, splits
    _, _, df = _noisy(spark)
    folded = splits.kfold_assign(df, "patient_id", 3)
    got = {r.fold: r.auc for r in ml.kfold_cv(folded, "fold", 3).collect()}
    train, test = folded.filter("fold <> 0"), folded.filter("fold = 0")
    pred = ml.classifier("lr", train.count()).fit(train).transform(test)
    scored = pred.select(F.col("label").cast("int").alias("y_true"), vector_to_array("rawPrediction")[1].alias("score"))
    assert abs(metrics.roc_auc(scored).first()["auc"] - got[0]) < 1e-9
    repeated = ml.random_split_cv(df, splits.shuffle_split(df.select("patient_id"), "patient_id", 2, 0.2), 2).collect()
    assert sorted(r.iteration for r in repeated) == [-1, 0, 1] and all(0.5 < r.auc <= 1 for r in repeated)


def test_ridge_weight_of_the_ensemble_is_scaled_by_the_rows(spark):
    import numpy as np
    from cohortlens.operators import ml
    x, y, df = _noisy(spark)
    model = ml.ridge(df, alpha=1.0).fit(df)
    c, m = x - x.mean(axis=0), y - y.mean()
    assert np.allclose(model.coefficients, np.linalg.solve(c.T @ c + np.eye(2), c.T @ m), atol=1e-6)


def test_concurrent_folds_equal_fits_one_by_one(spark):
    _, _, df = _noisy(spark)
    folded = splits.kfold_assign(df, "patient_id", 4)
    one = {r.fold: (r.accuracy, r.auc) for r in ml.kfold_cv(folded, "fold", 4, parallelism=1).collect()}
    many = {r.fold: (r.accuracy, r.auc) for r in ml.kfold_cv(folded, "fold", 4, parallelism=4).collect()}
    assert one == many and sorted(one) == [-1, 0, 1, 2, 3]


def test_stored_models_score_alike_in_another_session(spark, tmpdir_path):
    _, _, df = _noisy(spark)
    for kind in ("lr", "svm", "tree"):
        for scale in (False, True):
            model = ml.fit_classifier(df, kind, scale)
            ml.store_model(model, f"{tmpdir_path}/{kind}")               # the second one replaces the first
            df.write.mode("overwrite").parquet(f"{tmpdir_path}/rows")
            code = ("import sys; sys.path.insert(0, %r); from pyspark.sql import SparkSession; from cohortlens.operators import ml; "
                    "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate(); "
                    "rows = ml.load_model(%r).transform(s.read.parquet(%r)).select('patient_id', 'prediction').collect(); "
                    "print('GOT', sorted((r.patient_id, r.prediction) for r in rows))") % (ROOT, f"{tmpdir_path}/{kind}", f"{tmpdir_path}/rows")
            want = sorted((r.patient_id, r.prediction) for r in model.transform(df).select("patient_id", "prediction").collect())
            if scale and kind == "tree":
                env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
                out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env).stdout
                assert f"GOT {want}" in out
            again = ml.load_model(f"{tmpdir_path}/{kind}").transform(df)
            assert sorted((r.patient_id, r.prediction) for r in again.select("patient_id", "prediction").collect()) == want
