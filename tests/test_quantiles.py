"""Exact quantiles per group against a sort, over wide ranges, hot groups, nulls and empty input."""

import random

import numpy as np

from cohortlens.operators import quantiles
from cohortlens.operators.quantiles import group_quantiles, order_statistics


def test_quantiles_equal_a_sort_over_several_rounds(spark, monkeypatch):
    rng = random.Random(7)
    data = {"hot": [rng.randrange(-10**15, 10**15) for _ in range(400)] + [5] * 200, "two": [1, 4], "one": [-9],
            "wide": [-2**63, 2**63 - 1, 0], None: [3, 3, 8, 8]}
    rows = [(g, v) for g, values in data.items() for v in values] + [("hot", None), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    rounds = []
    refined = quantiles._refined
    monkeypatch.setattr(quantiles, "_refined", lambda *a: rounds.append(1) or refined(*a))
    got = {(r.g, r.fraction): r.quantile for r in group_quantiles(df, "g", "v", [0.0, 0.25, 0.5, 1.0]).collect()}
    assert len(got) == 4 * len(data) and 1 < len(rounds) <= 7
    for g, values in data.items():
        for f in (0.0, 0.25, 0.5, 1.0):
            want = np.quantile(np.array(values, np.float64), f)
            assert abs(got[g, f] - want) <= 1e-9 * max(1.0, abs(want)), (g, f)


def test_weighted_order_statistics_and_ranks_outside(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 7, 2), ("a", 7, 1), ("a", 9, 0), ("b", 2, 1)], "g string, v int, n int")
    ranks = spark.createDataFrame([("a", 0), ("a", 2), ("a", 3), ("a", 5), ("a", 6), ("a", -1), ("b", 0), ("c", 0)], "g string, rank long")
    got = {(r.g, r["rank"]): r.v for r in order_statistics(df, "g", "v", ranks, weight="n", bins=2).collect()}
    assert got == {("a", 0): 1, ("a", 2): 1, ("a", 3): 7, ("a", 5): 7, ("b", 0): 2}


def test_empty_input_gives_no_row_and_no_group_buffer(spark):
    df = spark.createDataFrame([], "g string, v long")
    assert group_quantiles(df, "g", "v", [0.5]).count() == 0


def test_statistics_hold_no_percentile_buffer(spark):
    from cohortlens.operators.stats import encounter_count_metrics
    import datetime

    day = lambda k: datetime.date(2020, 1, k)
    events = spark.createDataFrame([(p, f"e{d}", day(d)) for p, ds in {1: (1, 2), 2: (1,), 3: (1, 2, 3), 4: (4,)}.items() for d in ds],
                                   "patient_id long, event_id string, event_date date")
    dead = spark.createDataFrame([(4, day(9))], "patient_id long, event_date date")
    out = encounter_count_metrics(events, dead)
    got = {r.status: r.median_encounter_count for r in out.collect()}
    assert got == {"alive": 2.0, "dead": 1.0}
    assert "percentile" not in out._jdf.queryExecution().executedPlan().toString().lower()
