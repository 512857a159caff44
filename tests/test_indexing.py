from pyspark.sql import functions as F
import random

import numpy as np

from cohortlens.operators.indexing import dense_index, prefix_sums


def test_dense_index_global(spark):
    vals = [f"id{random.Random(1).randint(0, 10**6) + i:08d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "k string")
    out = dense_index(df, ["k"], "idx", num_partitions=7)
    got = {r.k: r.idx for r in out.collect()}
    assert got == {v: i for i, v in enumerate(sorted(vals))}


def test_dense_index_grouped_hot_group(spark):
    rng = random.Random(7)
    # one group holds most rows (a hot key) — its numbering must still be contiguous
    data = [(0 if rng.random() < 0.7 else rng.randint(1, 20), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g long, t long")
    out = dense_index(df, ["t"], "pos", group_cols=["g"], num_partitions=9)
    got = {(r.g, r.t): r.pos for r in out.collect()}
    by_g = {}
    for g, t in data:
        by_g.setdefault(g, []).append(t)
    want = {(g, t): i for g, ts in by_g.items() for i, t in enumerate(sorted(ts))}
    assert got == want


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(0, 100, 1000)
    df = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(v)], "t long, v long")
    inc = {r.t: r.v_cum for r in prefix_sums(df, ["t"], ["v"], num_partitions=6).collect()}
    exc = {r.t: r.v_cum for r in prefix_sums(df, ["t"], ["v"], inclusive=False, num_partitions=6).collect()}
    cs = np.cumsum(v)
    assert [inc[i] for i in range(1000)] == cs.tolist()
    assert [exc[i] for i in range(1000)] == (cs - v).tolist()


def test_null_groups_are_numbered_and_one_shuffle_suffices(spark):
    from cohortlens.operators import indexing
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 9), ("a", 4), ("b", 1)], "g string, k int")
    got = sorted((r.g or "", r.k, r.i) for r in indexing.dense_index(df, ["k"], "i", group_cols=["g"], num_partitions=3).collect())
    assert got == [("", 1, 0), ("", 3, 1), ("a", 2, 0), ("a", 4, 1), ("a", 9, 2), ("b", 1, 0)]
    seen, original = [], type(df).checkpoint

    def spy(self, *a, **b):
        seen.append(self._jdf.queryExecution().executedPlan().toString())
        return original(self, *a, **b)

    type(df).checkpoint = spy
    try:
        plan = indexing.dense_index(df, ["k", "g"], "i")._jdf.queryExecution().executedPlan().toString()
    finally:
        type(df).checkpoint = original
    assert len(seen) == 1 and seen[0].count("Exchange rangepartitioning") == 1 and seen[0].count("Exchange") == 1
    assert "Exchange" not in plan and "Window" not in plan


def test_numbering_over_many_ranges(spark):
    from pyspark.sql import functions as F
    from cohortlens.operators import indexing
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    assert indexing.dense_index(df, ["k"], "i", num_partitions=6).filter("k <> i").isEmpty()


def test_scan_sums_equal_prefix_sums(spark):
    import random
    from cohortlens.operators.indexing import prefix_sums, scan_sums
    rng = random.Random(6)
    rows = [(i, rng.choice([None, rng.randrange(100)]), rng.random(), f"s{i}") for i in range(700)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, a int, b double, s string").repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        for inclusive in (True, False):
            for order in (["k"], [F.col("k").desc()]):
                args = dict(sum_cols=["a", "b"], inclusive=inclusive, num_partitions=6)
                got = {r.k: r for r in scan_sums(df, order, **args).collect()}
                want = {r.k: r for r in prefix_sums(df, order, **args).collect()}
                assert all(got[k].a_cum == want[k].a_cum and abs(got[k].b_cum - want[k].b_cum) < 1e-9 and got[k].s == f"s{k}" for k in want) and len(got) == 700
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert scan_sums(df.limit(0), ["k"], ["a"]).collect() == []
