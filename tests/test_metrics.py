import itertools
import random

from conftest import rows
from cohortlens.operators import metrics


def test_purity_hand_computed(spark):
    # cluster 0: classes 1,1,1,2 → 3; cluster 1: 2,2,3 → 2; cluster 2: 3 → 1; purity = 6/8
    data = [(0, 1), (0, 1), (0, 1), (0, 2), (1, 2), (1, 2), (1, 3), (2, 3)]
    df = spark.createDataFrame(data, "cluster int, class int")
    assert abs(metrics.purity(df).first().purity - 0.75) < 1e-12


def test_confusion_and_binary_metrics(spark):
    data = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(data, "y_true int, y_pred int")
    cm = {(r.y_true, r.y_pred): (r.n, r.fraction) for r in metrics.confusion_matrix(df).collect()}
    assert cm[(1, 1)] == (3, 0.75) and cm[(0, 0)] == (4, 4 / 6)
    m = metrics.binary_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (3, 2, 1, 4)
    assert abs(m.accuracy - 0.7) < 1e-12 and abs(m.precision - 0.6) < 1e-12 and abs(m.recall - 0.75) < 1e-12
    assert abs(m.f1 - 2 * 0.6 * 0.75 / 1.35) < 1e-12


def test_roc_auc_matches_pairwise_count(spark):
    rng = random.Random(5)
    data = [(rng.randint(0, 1), rng.randint(0, 20)) for _ in range(300)]     # many ties
    df = spark.createDataFrame(data, "y_true int, score int")
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert abs(metrics.roc_auc(df).first().auc - want) < 1e-12
    curve = rows(metrics.roc_curve(df), "threshold", "tpr", "fpr")
    assert curve[0][0] == min(s for _, s in data) and curve[0][1] == 1.0 and curve[0][2] == 1.0
    assert all(a[1] >= b[1] for a, b in zip(curve, curve[1:]))


def test_running_weighted_average(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 4.0, 3.0), (3, 10.0, 0.0), (4, 1.0, 4.0)], "t int, v double, w double")
    got = [r.running_avg for r in metrics.running_weighted_average(df, ["t"], "v", "w").orderBy("t").collect()]
    assert got == [2.0, 14 / 4, 14 / 4, 18 / 8]
