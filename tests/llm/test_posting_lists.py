"""Approximate nearest neighbours: recall and exactness of what is found, against brute force."""

from functools import reduce

import numpy as np
import pytest

from cohortlens.llm import posting_lists
from cohortlens.llm.queries import QUERIES
from cohortlens.sources.tables import read_table

SF = "/root/testdata/sf0.1"


def product(x, y):
    return reduce(lambda total, pair: total + pair[0] * pair[1], zip(x, y), 0.0)  # from the first component to the last


def brute(rows, k, every):
    """{query: [(rank, id, score)]} of rows (id, vector); each id once, by its best vector."""
    ok = [(i, [float(c) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    dim = max((len(v) for _, v in ok), default=0)
    ok = [(i, np.array(v + [0.0] * (dim - len(v)))) for i, v in ok]
    out = {}
    for q in sorted({i for i, _ in ok if i % every == 0}):
        x = min((v.tolist() for i, v in ok if i == q))
        best = {}
        for i, v in ok:
            if i != q:
                s = product(x, v.tolist())
                best[i] = max(best.get(i, -np.inf), s)
        out[q] = [(r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k])]
    return out


def result(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def recall(got, want):
    hits = [len({i for _, i, _ in got.get(q, [])} & {i for _, i, _ in w}) for q, w in want.items()]
    return sum(hits) / sum(len(w) for w in want.values())


def clustered(n, dim, groups, seed=1, scale=0.1):
    rng = np.random.default_rng(seed)
    means = rng.normal(size=(groups, dim)) * rng.uniform(0.5, 2, (groups, 1))
    return means[rng.integers(0, groups, n)] + rng.normal(scale=scale, size=(n, dim))


def test_query_recall_and_scores(spark):
    got = result(QUERIES["op13_posting_lists"](spark, SF))
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, SF, "embeddings").collect()]
    want = brute(rows, 20, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values()) and recall(got, want) >= 0.9
    vector = {i: v for i, v in rows}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {i for _, i, _ in found}
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, i, s in found:
            assert s == product(vector[q], vector[i])


@pytest.mark.parametrize("group, queries", [(8192, 4096), (100, 7)])
def test_groups_and_parts_do_not_change_what_is_found(spark, monkeypatch, group, queries):
    monkeypatch.setattr(posting_lists, "LIST", 40)
    monkeypatch.setattr(posting_lists, "GROUP", group)
    monkeypatch.setattr(posting_lists, "QUERIES", queries)
    x = clustered(1500, 8, 12)
    x[200:900] = 3 * x[200]  # nearly half of the rows are copies
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got, want = result(posting_lists.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=10, every=50)), brute(rows, 10, 50)
    assert recall(got, want) >= 0.9
    assert [i for _, i, _ in got[300]] == list(range(200, 210)) and [i for _, i, _ in got[200]] == list(range(201, 211))
    for q, found in got.items():  # of equal scores those with the smaller ids
        copies = [i for _, i, _ in found if 200 <= i < 900]
        assert copies == [i for i in range(200, 900) if i != q][:len(copies)]


def test_clustered_table_reads_few_lists():
    x = clustered(6000, 16, 40, scale=0.03)
    norm = float(np.sqrt((x**2).sum(axis=1)).max())
    index = posting_lists.Index(np.unique(x, axis=0), 6000, norm, 5)
    n = len(index.graph.centres)
    _, away = index.graph.search(posting_lists.asked(x[:200], norm), n)
    assert n == 24 and (away <= away[:, :1] * index.ratio).sum(axis=1).mean() < n / 3


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 300):
        centres, x = rng.normal(size=(n, 6)), rng.normal(size=(50, 6))
        found, away = posting_lists.CentroidGraph(centres, 6).search(x, 12)
        full = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(axis=2))
        assert np.allclose(np.take_along_axis(full, found, axis=1), away)
        assert (found[:, 0] == full.argmin(axis=1)).mean() > 0.95 and (np.diff(away, axis=1) >= 0).all()


def test_clusters_are_balanced():
    x = np.concatenate([np.zeros((500, 3)), np.random.default_rng(2).normal(size=(517, 3))])
    for n in (1, 2, 7, 40):
        parts = posting_lists.balanced_clusters(x, n)
        assert len(parts) == n and sorted(np.concatenate(parts)) == list(range(1017))
        assert max(map(len, parts)) - min(map(len, parts)) <= 7


def test_every_row_is_in_a_list():
    x = clustered(400, 5, 3)
    index = posting_lists.Index(x[:50], 400 * 100, float(np.sqrt((x**2).sum(axis=1)).max()))
    held = posting_lists.lists_of(index.graph, posting_lists.lengthened(x, index.norm))
    assert all(1 <= len(h) <= posting_lists.REPLICAS and len(set(h)) == len(h) for h in held) and max(map(len, held)) > 1


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, -2.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (None, [1.0, 1.0]), (120, []),
            (1, [3.0]), (2, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0]), (2, [5.0]), (-20, [-1.0, 0.0, 1e-200]), (3, [3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as x", "3 as score", "4 as `group`", "5 as list")
    assert result(posting_lists.nearest(frame)) == brute(rows, 20, 20) and set(brute(rows, 20, 20)) == {0, -20}
    assert posting_lists.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert posting_lists.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).collect() == []
    assert posting_lists.nearest(spark.createDataFrame([(3, [1.0]), (4, [0.0])], "vec_id long, embedding array<float>")).collect() == []
    long = [(i, [float(i % 7 + 1)] * (3000 if i == 5 else 3)) for i in range(60)]
    assert result(posting_lists.nearest(spark.createDataFrame(long, "vec_id long, embedding array<float>"), k=100)) == brute(long, 100, 20)
