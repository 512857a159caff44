import numpy as np

from cohortlens.streaming.kmeans import StreamingKMeansState, assign, batch_stats, run_streaming_kmeans


def _points(n=60, seed=1):
    rng = np.random.default_rng(seed)
    centers = np.array([[0.0, 0.0], [5.0, 5.0], [-5.0, 5.0]])
    return np.vstack([c + rng.normal(0, 0.5, (n // 3, 2)) for c in centers])


def test_update_matches_mllib(spark):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors

    pts = _points()
    init = np.array([[0.5, 0.5], [4.0, 4.0], [-4.0, 4.0]])
    ours = StreamingKMeansState(init.copy(), np.full(3, 0.5), decay=1.0)
    batch = spark.createDataFrame([(p.tolist(),) for p in pts], "v array<double>")
    sums, counts = batch_stats(batch, "v", ours.centers)
    ours.update(sums, counts)
    ref = StreamingKMeansModel([Vectors.dense(c) for c in init], [0.5, 0.5, 0.5])
    ref = ref.update(spark.sparkContext.parallelize([Vectors.dense(p) for p in pts]), 1.0, "batches")
    assert np.allclose(ours.centers, np.array([np.asarray(c, dtype=float) for c in ref.centers]), atol=1e-9)
    assert np.allclose(ours.weights, np.array(ref.clusterWeights), atol=1e-9)


def test_structured_stream_runs_every_file(spark, tmpdir_path):
    import os
    pts = _points(90, seed=3)
    src = os.path.join(tmpdir_path, "src")
    for i in range(3):   # three files → several micro-batches under availableNow
        part = pts[i::3]
        spark.createDataFrame([(i * 1000 + j, p.tolist()) for j, p in enumerate(part)], "id long, v array<double>") \
            .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("id long, v array<double>").option("maxFilesPerTrigger", 1).parquet(src)
    state = StreamingKMeansState(np.array([[0.5, 0.5], [4.0, 4.0], [-4.0, 4.0]]), np.full(3, 0.5))
    run_streaming_kmeans(stream, "v", state, os.path.join(tmpdir_path, "ckpt"))
    assert sum(n for _, n in state.history) == 90 and state.batches == 3
    got = assign(spark.read.parquet(src), "v", state).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in got) == [30, 30, 30]


def test_a_killed_stream_goes_on_from_its_stored_centres(spark, tmpdir_path):
    import numpy as np
    import pytest
    from cohortlens.streaming.kmeans import StreamingKMeansState, load_model, run_streaming_kmeans

    rng = np.random.default_rng(4)
    for part in range(4):
        rows = [(part * 50 + i, [float(v) for v in rng.normal(part % 2 * 6, 1, 3)]) for i in range(50)]
        spark.createDataFrame(rows, "id long, v array<double>").coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
    schema = spark.read.parquet(f"{tmpdir_path}/in").schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in")
    fresh = lambda seed: StreamingKMeansState.random(k=2, dim=3, weight=0.5, seed=seed, decay=0.9)

    whole = run_streaming_kmeans(stream(), "v", fresh(1), f"{tmpdir_path}/whole")
    assert whole.batches == 4

    def kill(epoch):                     # the epoch's centres are stored, but Spark has not committed it
        if epoch == 1:
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        run_streaming_kmeans(stream(), "v", fresh(1), f"{tmpdir_path}/cut", on_stored=kill)
    stored = fresh(2)
    assert load_model(spark, f"{tmpdir_path}/cut/model", stored) and stored.epoch == 1 and stored.batches == 2
    resumed = run_streaming_kmeans(stream(), "v", fresh(2), f"{tmpdir_path}/cut")   # another process knows only the folder
    assert [e for e, _ in resumed.history] == [2, 3] and resumed.batches == 4       # epoch 1 was replayed and left out
    assert np.allclose(resumed.centers, whole.centers) and np.allclose(resumed.weights, whole.weights)
    assert not load_model(spark, f"{tmpdir_path}/none", fresh(3))
