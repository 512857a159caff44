"""Spark ML pipelines on DataFrames: vectors, scaling, PCA, clustering, classifiers,
cross-validation and a weighted voting ensemble.

Models are fitted with Spark ML (distributed treeAggregate / L-BFGS); the only
driver-side values are fitted parameters and per-fold metric scalars.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sparse import sparse_vector
from ..session import ensure_checkpoint_dir
from . import regressors
from .metrics import purity

SEED = 6250


def vector_rows(df: DataFrame, array_col: str = "embedding", out: str = "features") -> DataFrame:
    """Numeric array column → ML dense vector column (no Python per row)."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def sparse_feature_rows(features: DataFrame, labels: DataFrame, size: int | None = None,
                        label_col: str = "is_dead") -> DataFrame:
    """(patient_id, label, features SparseVector) from long (patient_id, feature_id, feature_value).

    The vector size is the dictionary size (max id + 1 unless given).
    """
    lists = features.groupBy("patient_id").agg(
        F.array_sort(F.collect_list(F.struct("feature_id", "feature_value"))).alias("_p"))
    size_col = features.agg(F.max("feature_id") + 1).scalar() if size is None else F.lit(size)
    lists = lists.withColumn("_size", size_col)
    rows = lists.join(labels.select("patient_id", F.col(label_col).cast("double").alias("label")), "patient_id")
    return rows.select("patient_id", "label", sparse_vector("_size", "_p").alias("features"))


def standardize(df: DataFrame, input_col: str = "features", output_col: str = "scaled") -> DataFrame:
    """(x − mean) / sample std per dimension (StandardScaler withMean, withStd)."""
    model = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True).fit(df)
    return model.transform(df)


def pca(df: DataFrame, k: int = 10, input_col: str = "scaled", output_col: str = "pca") -> DataFrame:
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df).transform(df)


def scale_and_project(k: int = 10, input_col: str = "features") -> Pipeline:
    """Pipeline that standardises then projects; its fitted model maps new rows the same way."""
    return Pipeline(stages=[
        StandardScaler(inputCol=input_col, outputCol="scaled", withMean=True, withStd=True),
        PCA(k=k, inputCol="scaled", outputCol="pca")])


def cluster(df: DataFrame, method: str = "kmeans", k: int = 3, max_iter: int = 20, seed: int = SEED,
            features_col: str = "pca") -> DataFrame:
    """Adds ``cluster`` (k-means or Gaussian mixture)."""
    if method == "kmeans":
        est = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col, predictionCol="cluster")
    elif method == "gmm":
        est = GaussianMixture(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col, predictionCol="cluster")
    else:
        raise ValueError(method)
    return est.fit(df).transform(df)


def cluster_purity(df: DataFrame, method: str, class_col: str = "label", **kw) -> DataFrame:
    out = cluster(df, method, **kw)
    return purity(out.select("cluster", F.col(class_col).alias("class"))).select(
        F.lit(method).alias("model"), "purity")


def classifier(kind: str, n_rows: int, features_col: str = "features", label_col: str = "label", c: float = 1.0):
    """Logistic regression, linear SVM or a depth-5 decision tree for ``n_rows`` training rows.

    The penalty is |w|^2 / 2 + C * (sum of losses) with C = 1 and features as given; Spark
    averages the losses, so that is a regularisation of 1 / (n * C) without standardising.
    """
    if kind == "lr":
        return LogisticRegression(featuresCol=features_col, labelCol=label_col, regParam=1.0 / (c * max(n_rows, 1)),
                                  standardization=False, maxIter=100)
    if kind == "svm":
        return LinearSVC(featuresCol=features_col, labelCol=label_col, regParam=1.0 / (c * max(n_rows, 1)),
                         standardization=False, maxIter=100)
    if kind == "tree":
        return DecisionTreeClassifier(featuresCol=features_col, labelCol=label_col, maxDepth=5, seed=SEED)
    raise ValueError(kind)


def fit_predict(train: DataFrame, score: DataFrame, kind: str, key: str = "patient_id") -> DataFrame:
    """Fit on ``train`` and predict ``score``: (key, label, prediction)."""
    model = classifier(kind, train.count()).fit(train)
    return model.transform(score).select(key, "label", F.col("prediction").cast("int").alias("prediction"))


def _validated(train: DataFrame, test: DataFrame, kind: str, n_train: int) -> tuple[float | None, float | None]:
    """Accuracy and exact AUC (no score bins) on ``test`` of a model fitted on ``train``; null where undefined."""
    pred = classifier(kind, n_train).fit(train).transform(test)
    accuracy, classes = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")), F.count_distinct("label")).first()
    exact = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    return accuracy, exact.evaluate(pred) if classes > 1 else None


def _rounds(parts: list[tuple[DataFrame, DataFrame, int]], kind: str, round_col: str, parallelism: int) -> DataFrame:
    """One row per round (train, test, rows of train) and their mean as round -1; some fits run at a time, as jobs of one session."""
    spark = parts[0][0].sparkSession
    with ThreadPool(processes=max(1, min(parallelism, len(parts)))) as pool:
        found = pool.map(inheritable_thread_target(spark)(lambda p: _validated(p[0], p[1], kind, p[2])), parts)
    per = spark.createDataFrame([(i, *f) for i, f in enumerate(found)], f"{round_col} int, accuracy double, auc double")
    mean = per.agg(F.lit(-1).alias(round_col), F.avg("accuracy").alias("accuracy"), F.avg("auc").alias("auc"))
    return per.unionByName(mean)


PARALLELISM = 4  # fits at a time


def kfold_cv(df: DataFrame, fold_col: str = "fold", k: int = 5, kind: str = "lr", parallelism: int = PARALLELISM) -> DataFrame:
    """Per-fold accuracy and AUC of a classifier trained on the other folds, plus the mean.

    The rows are stored once; every fit is distributed, ``parallelism`` of them run at a time, and only
    the metric scalars return to the driver.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    sizes = {r[fold_col]: r["count"] for r in df.groupBy(fold_col).count().collect()}  # one row per fold
    total = sum(n for f, n in sizes.items() if f is not None)
    return _rounds([(df.filter(F.col(fold_col) != f), df.filter(F.col(fold_col) == f), total - sizes.get(f, 0)) for f in range(k)], kind, "fold", parallelism)


def random_split_cv(df: DataFrame, splits: DataFrame, iterations: int = 5, kind: str = "lr", key: str = "patient_id",
                    parallelism: int = PARALLELISM) -> DataFrame:
    """Accuracy and AUC over repeated random splits (iteration, key, split in train/test), plus the mean; as :func:`kfold_cv`."""
    ensure_checkpoint_dir(df.sparkSession)
    both = df.join(splits.select("iteration", key, "split"), key).checkpoint(eager=True)
    sizes = {r["iteration"]: r["count"] for r in both.filter("split = 'train'").groupBy("iteration").count().collect()}  # one row per iteration
    part = lambda i, s: both.filter((F.col("iteration") == i) & (F.col("split") == s))
    return _rounds([(part(i, "train"), part(i, "test"), sizes.get(i, 0)) for i in range(iterations)], kind, "iteration", parallelism)


def store_model(model: PipelineModel, path: str) -> None:
    """Writes a fitted pipeline to a shared folder; an earlier one there is replaced."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A stored pipeline, in this or another session."""
    return PipelineModel.load(path)


def fit_classifier(train: DataFrame, kind: str, scale: bool = False) -> PipelineModel:
    """A fitted pipeline of a classifier, on standardised features if wanted; :func:`store_model` keeps it."""
    n = train.count()
    if not scale:
        return Pipeline(stages=[classifier(kind, n)]).fit(train)
    return Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled", withMean=False, withStd=True), classifier(kind, n, "scaled")]).fit(train)


# Weights of the voting ensemble: gradient boosting, extremely randomised trees, ridge, network.
VOTING_WEIGHTS = (("gbt", 3.0), ("trees", 1.0), ("ridge", 1.0), ("network", 3.0))
# Fixed values of the original ensemble: boosting rounds and trees, their depth, the boosting step.
TREES, DEPTH, STEP = 2000, 5, 0.01


def ridge(train: DataFrame, alpha: float = 1.0) -> LinearRegression:
    """Estimator of (sum of squared errors) + alpha * |w|^2 for these training rows.

    Spark halves and averages the errors and divides the parameter by the label's deviation,
    so it is alpha * deviation / n, without standardising the features.
    """
    n, deviation = train.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
    return LinearRegression(featuresCol="features", labelCol="label", regParam=alpha * (deviation or 0.0) / max(n, 1),
                            elasticNetParam=0.0, standardization=False)


def voting_members(train: DataFrame, score: DataFrame, key: str, trees: int = TREES, rounds: int = TREES, alpha: float = 1.0,
                   steps: int = 200, max_features: float = 1.0) -> DataFrame:
    """(key, p_gbt, p_trees, p_ridge, p_network): the members' predictions; boosting in squared error, depth 5, step 0.01."""
    models = (GBTRegressor(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=DEPTH, stepSize=STEP, seed=SEED, predictionCol="p_gbt"),
              ridge(train, alpha).setPredictionCol("p_ridge"))
    out = score.select(key, "features")
    for m in models:
        out = m.fit(train).transform(out)
    out = out.drop("features")
    rows, asked, d = regressors.stored_rows(train), regressors.stored_rows(score, key, None), regressors.n_features(train)
    forest = regressors.extra_trees(rows, d, trees, DEPTH, max_features, SEED)
    network = regressors.train_network(rows, d, steps=steps, seed=SEED)
    for name, model in (("p_trees", forest), ("p_network", network)):
        out = out.join(regressors.scored(asked, d, key, model, name), key)
    return out


def voting_ensemble(train: DataFrame, score: DataFrame, key: str = "patient_id", trees: int = TREES, rounds: int = TREES, alpha: float = 1.0,
                    steps: int = 200, max_features: float = 1.0) -> DataFrame:
    """(key, score): mean of the four regressors' predictions, weighted 3, 1, 1, 3; keys must be unique.

    Ridge minimises (sum of squared errors) + alpha * |w|^2 (see :func:`ridge`).
    """
    out = voting_members(train, score, key, trees, rounds, alpha, steps, max_features)
    total = sum(w for _, w in VOTING_WEIGHTS)
    return out.select(key, (sum((F.col(f"p_{name}") * w for name, w in VOTING_WEIGHTS), F.lit(0.0)) / total).alias("score"))


def mlp_predict(train: DataFrame, score: DataFrame, n_inputs: int, n_classes: int, hidden: int = 50,
                key: str = "vec_id", max_iter: int = 100) -> DataFrame:
    """Multilayer perceptron (sigmoid hidden layer, softmax output)."""
    est = MultilayerPerceptronClassifier(layers=[n_inputs, hidden, n_classes], maxIter=max_iter, seed=SEED,
                                         featuresCol="features", labelCol="label")
    return est.fit(train).transform(score).select(key, "label", F.col("prediction").cast("int").alias("prediction"))


def vector_coordinates(df: DataFrame, key: str, vec_col: str) -> DataFrame:
    """(key, dim, value) rows of a vector column."""
    return df.select(key, F.posexplode(vector_to_array(vec_col)).alias("dim", "value"))
