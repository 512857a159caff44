from conftest import rows
from cohortlens.operators import labels as lab
from cohortlens.operators import splits


def _meta(spark):
    data = [(i, ["A|B", "A", "B|C", "No Finding", "A|C"][i % 5]) for i in range(50)]
    return spark.createDataFrame(data, "order_key long, finding_labels string")


def test_label_frequency_and_indicators(spark):
    m = _meta(spark)
    freq = lab.label_frequency(m, min_cases=15)
    assert rows(freq) == [("A", 30), ("B", 20), ("C", 20)]
    ind = lab.label_indicators(m, freq, "order_key")
    held = {(x.order_key, x.label) for x in ind.collect()}
    assert ind.columns == ["order_key", "label", "indicator"]
    assert {k for k in held if k[0] in (0, 3, 4)} == {(0, "A"), (0, "B"), (4, "A"), (4, "C")}
    r = {x.order_key: (x.A, x.B, x.C) for x in lab.wide_indicators(m, ["A", "B", "C"], "order_key").collect()}
    assert r[0] == (1, 1, 0) and r[4] == (1, 0, 1)


def test_weighted_sample_deterministic(spark):
    from pyspark.sql import functions as F
    m = _meta(spark).withColumn("w", F.lit(1.0))
    a = [r.order_key for r in lab.weighted_sample(m, "order_key", "w", n=10).collect()]
    b = [r.order_key for r in lab.weighted_sample(m, "order_key", "w", n=10).collect()]
    assert len(a) == 10 and a == b


def test_stratified_split_fractions(spark):
    data = [(i, "S1" if i < 100 else "S2") for i in range(150)]
    df = spark.createDataFrame(data, "order_key long, s string")
    out = lab.stratified_split(df, "order_key", "s")
    c = {}
    for r in out.collect():
        c[(r.stratum, r.split)] = c.get((r.stratum, r.split), 0) + 1
    assert c == {("S1", "test"): 20, ("S1", "valid"): 20, ("S1", "train"): 60,
                 ("S2", "test"): 10, ("S2", "valid"): 10, ("S2", "train"): 30}


def test_hash_splits(spark):
    df = spark.range(2000).withColumnRenamed("id", "patient_id")
    tt = splits.train_test_split(df, "patient_id")
    frac = tt.filter("split = 'test'").count() / 2000
    assert 0.15 < frac < 0.25
    folds = {r.fold for r in splits.kfold_assign(df, "patient_id", 5).collect()}
    assert folds == {0, 1, 2, 3, 4}
    ss = splits.shuffle_split(df, "patient_id", 3)
    assert ss.count() == 6000
    bag = splits.bagging_sample(df, "patient_id", 4, 0.5)
    per = {r.model_id: r["count"] for r in bag.groupBy("model_id").count().collect()}
    assert set(per) == {0, 1, 2, 3} and all(800 < v < 1200 for v in per.values())


def test_weighted_sample_takes_the_smallest_keys(spark):
    from pyspark.sql import functions as F
    m = _meta(spark).withColumn("w", F.col("order_key") % 3 + 1.0)
    some = {r.order_key: r.sample_key for r in lab.weighted_sample(m, "order_key", "w", n=7).collect()}
    every = {r.order_key: r.sample_key for r in lab.weighted_sample(m, "order_key", "w", n=10**6).collect()}
    assert len(some) == 7 and len(every) == m.count()
    assert sorted(some.values()) == sorted(every.values())[:7]


def test_sample_then_split(spark):
    from pyspark.sql import functions as F
    m = _meta(spark).withColumn("w", F.lit(1.0))
    out = lab.sample_and_split(m, "order_key", "w", F.lit("s"), n=10)
    assert sorted(r.split for r in out.collect()) == ["test"] * 2 + ["train"] * 6 + ["valid"] * 2


def test_preprocess_metadata(spark, tmpdir_path):
    import os
    d = os.path.join(tmpdir_path, "images_001", "images")
    os.makedirs(d)
    names = [f"{i:03d}.png" for i in range(6)]
    for n in names[:5]:                       # the sixth image is missing on disk
        with open(os.path.join(d, n), "wb") as f:
            f.write(b"x")
    csv = os.path.join(tmpdir_path, "meta.csv")
    labels_ = ["A|B", "A", "No Finding", "B", "A|C", "A"]
    with open(csv, "w") as f:
        f.write("Image Index,Finding Labels,Follow-up #,Patient ID,Patient Age,Patient Gender,View Position,"
                "OriginalImage[Width,Height],OriginalImagePixelSpacing[x,y]\n".replace("[Width,Height]", "W,H")
                .replace("[x,y]", "x,y"))
        for i, (n, l) in enumerate(zip(names, labels_)):
            f.write(f"{n},{l},0,{i},50,M,PA,10,10,0.1,0.1\n")
    meta, kept = lab.preprocess_metadata(spark, csv, tmpdir_path, min_cases=2)
    assert rows(kept) == [("A", 3), ("B", 2)]
    got = {r.image_index: (r.A, r.B) for r in meta.collect()}
    assert got == {"000.png": (1, 1), "001.png": (1, 0), "002.png": (0, 0), "003.png": (0, 1), "004.png": (1, 0)}
