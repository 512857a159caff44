"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from cohortlens.llm import periodic_runs
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every stretch of each period by comparing neighbours one by one; the least period of a stretch stays."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(6, 4 * p):
                found.setdefault((start, i - start + p), p)
            i += i == start
    return sorted((s, n, p) for (s, n), p in found.items())


def noisy_texts(rng, count):
    for _ in range(count):
        letters, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 5, 6, 7, 20, 60, 150])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(3) if n > 10 else 0):
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 4 + 1))
            for i in range(a, rng.randrange(a, n) + 1):
                words[i] = words[a + (i - a) % p]
        yield words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = list(noisy_texts(rng, rng.randrange(1, 12)))
        assert periodic_runs.find_runs([np.array(t, dtype=np.int64) for t in texts]) == [brute_runs(t) for t in texts]


def test_candidates_in_small_batches(monkeypatch):
    texts = list(noisy_texts(random.Random(5), 40))
    monkeypatch.setattr(periodic_runs, "PAIRS", 7)
    assert periodic_runs.find_runs([np.array(t, dtype=np.int64) for t in texts]) == [brute_runs(t) for t in texts]


def test_extensions_equal_plain_comparison():
    rng = random.Random(3)
    text = [rng.randrange(2) for _ in range(300)] + [0] * 40 + [0, 1] * 60
    symbols = np.array([-1, *text, -2])
    grammar = periodic_runs.Grammar(symbols)
    pairs = [(i, j) for i, j in ((rng.randrange(1, len(text) + 1), rng.randrange(1, len(text) + 1)) for _ in range(3000)) if i != j]
    for step in (1, -1):
        want = []
        for i, j in pairs:
            n = 0
            while symbols[i + step * n] == symbols[j + step * n]:
                n += 1
            want.append(n)
        i, j = np.array(pairs).T
        assert grammar.extension(i, j, step).tolist() == want


def test_grammar_spells_its_text():
    rng = random.Random(4)
    symbols = np.array([-1, *[rng.randrange(3) for _ in range(500)], -2])
    g = periodic_runs.Grammar(symbols)
    assert len(g.levels[-1]) == 3
    for k in range(len(g.kind)):  # children of equal symbols are equal, of different ones differ
        below, spelt = g.levels[k], {}
        for at, symbol in enumerate(g.levels[k + 1]):
            children = tuple(below[g.first[k][at]:g.first[k][at + 1]])
            assert spelt.setdefault(symbol, children) == children and (g.parent[k][g.first[k][at]:g.first[k][at + 1]] == at).all()
        assert len(set(spelt.values())) == len(spelt)


def brute_row(doc_id, text):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)), digest(" ".join(kept)))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len(r.text or "") < 6000:
            assert got[r.doc_id] == brute_row(r.doc_id, r.text)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_run_edge_cases(spark):
    rows = [(None, "a " * 9), (2, None), (3, ""), (4, " \n\t"), (5, "x " * 5), (5, "x " * 6), (5, "x " * 6), (6, "X x " * 8), (7, "é ü " * 7),
            (8, " ".join(str(i % 7) for i in range(300_000)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as runs", "3 as period", "4 as n_runs")
    out = periodic_runs.run_digests(frame).collect()
    want = [brute_row(*r) for r in rows[:-1]]
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in out if r.doc_id != 8), key=key) == sorted(want, key=key)
    long = next(r for r in out if r.doc_id == 8)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 300_000, 7)
    kept = {(r.doc_id, r.collapsed) for r in periodic_runs.collapse_runs(frame).collect()}
    assert kept == {(None, "a"), (2, ""), (3, ""), (4, ""), (5, "x x x x x"), (5, "x"), (6, "X x"), (7, "é ü"), (8, "0 1 2 3 4 5 6")}
    assert periodic_runs.run_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
