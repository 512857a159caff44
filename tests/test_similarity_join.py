import itertools
import random

import pytest

from cohortlens.operators import graph
from cohortlens.operators.similarity_join import candidates, jaccard_join, set_classes


def _sets(n=120, seed=1):
    rng = random.Random(seed)
    base = [frozenset(rng.sample(range(60), rng.randrange(1, 14))) for _ in range(25)]
    out = {}
    for i in range(n):
        s = set(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            s.symmetric_difference_update({rng.randrange(60)})
        out[i] = s | ({99} if i % 3 == 0 else set())          # one item that a third of all have
    return out


def _brute(sets, t):
    return {(a, b): len(x & y) / len(x | y) for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2)
            if x and y and len(x & y) >= t * len(x | y) - 1e-12}


def _long(spark, sets):
    rows = [(i, x) for i, s in sets.items() for x in s for _ in range(1 + (x % 5 == 0))]       # some repeated
    return spark.createDataFrame(rows + [(None, 1), (5000, None)], "patient_id long, item_id long")


@pytest.mark.parametrize("t", [0.3, 0.5, 0.75, 1.0])
def test_join_equals_brute_force(spark, t):
    sets = _sets()
    got = {(r.patient_id_1, r.patient_id_2): r.similarity for r in jaccard_join(_long(spark, sets), t).collect()}
    want = _brute(sets, t)
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-12 for p in want) and len(want) > 20


def test_classes_stand_for_their_members(spark):
    sets = _sets() | {1000 + i: {1, 2, 3, 4} for i in range(60)} | {2000: {1, 2, 3}}
    items = _long(spark, sets)
    pairs = {(r.patient_id_1, r.patient_id_2) for r in jaccard_join(items, 0.7, expand=False).collect()}
    members = {r["id"]: r["class"] for r in set_classes(items)[1].collect()}
    assert members[1059] == 1000 and (1000, 2000) in pairs and not any(1000 < a < 1060 or 1000 < b < 1060 for a, b in pairs)
    linked = {(a, b) for a, b in _brute(sets, 0.7) if members[a] == members[b] or (min(members[a], members[b]), max(members[a], members[b])) in pairs}
    assert linked == set(_brute(sets, 0.7))


def test_few_pairs_are_candidates(spark):
    sets = _sets(300, seed=2)
    distinct, _ = set_classes(_long(spark, sets))
    n = distinct.count()
    assert candidates(distinct, 0.75).count() < 0.15 * n * (n - 1) / 2


def test_clusters_from_the_join(spark):
    sets = {g * 10 + i: {g * 100 + j for j in range(8)} | {g * 100 + 50 + i % 2} for g in range(3) for i in range(6)} | {900: {7777}}
    items = _long(spark, sets)
    found = graph.power_iteration_clusters(jaccard_join(items, 0.5), k=3, max_iter=20, patients=items.select("patient_id").where("patient_id < 5000").distinct())
    got = {r["id"]: r["cluster"] for r in found.collect()}
    assert got[900] == -1 and all(len({got[g * 10 + i] for i in range(6)}) == 1 for g in range(3)) and len(got) == 19


def test_bad_threshold(spark):
    for t in (0, -1, 1.5):
        with pytest.raises(ValueError):
            jaccard_join(_long(spark, {1: {1}}), t)
