"""The Merkle manifest against a plain tree, and its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from cohortlens.llm import merkle
from cohortlens.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        first = at // 3 * 3
        run = level[first:first + 3]
        yield run[:at - first], run[at - first + 1:]
        at //= 3


def brute(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: h(*map(field, r))
    groups = {}
    for r in rows:
        changed = None if r[0] is None or zlib.crc32(str(r[0]).encode()) % 2 else leaf((*r[:4], None if r[4] is None else r[4].replace("\n", "")))
        groups.setdefault(r[1], []).append((r[0], leaf(r), changed))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or ""))
    trees = [levels([x[1] for x in groups[g]]) for g in names]
    top = levels([t[-1][0] for t in trees])
    for k, (g, tree) in enumerate(zip(names, trees)):
        for at, (i, own, changed) in enumerate(groups[g]):
            path = [*siblings(tree, at), *siblings(top, k)]
            fold = changed or own
            for left, right in path:
                fold = h(*left, fold, *right)
            yield i, own, tree[-1][0], top[-1][0], h(*[d for left, right in path for d in left + right]), fold, fold == top[-1][0]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def result(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def made_rows(n=400):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a"] * 5 + ["b", "é", None]), rng.choice(["en", None]), i * 3, rng.choice(["x\ny", "plain", "", None, "é\n\n"])) for i in range(n)]
    return rows + [(900, "one", None, None, None), (901, "Z", "", 0, "\n"), (901, "Z", "", 0, "\n"), (901, "Z", "", 1, "z"), (None, "a", None, None, "x\n"), (None, None, None, None, None)]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "LEVELS", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    rows = made_rows() if depth < 6 else made_rows(1500)
    frame = table(spark, rows).selectExpr("*", "1 as id", "2 as grp", "3 as pos", "4 as leaf", "5 as block")
    got = merkle.manifest(frame, with_proof=True).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == sorted(brute(rows), key=repr)
    for r in got:
        path = [(p.l, p.r) for p in r.proof]
        assert merkle.folded(r.leaf, path) == r.root and h(*[a + b for a, b in path]) == r.proof_sha256


def test_versions_share_untouched_nodes():
    for n, first in ((merkle.BLOCK, False), (100, True), (100, False), (1, True), (1, False)):
        leaves = [h(str(i)) for i in range(n)]
        top, height = merkle.block_tree(leaves, first)
        steps = merkle.way(top, height, n - 1)
        new = merkle.replaced(steps, h("other"))
        assert top.digest == merkle.block_tree(leaves, first)[0].digest  # the first version is as it was
        assert new.digest == merkle.block_tree(leaves[:-1] + [h("other")], first)[0].digest

        def nodes(node):
            return {id(node)}.union(*[nodes(c) for c in node.children])

        assert len(nodes(new) - nodes(top)) == height + 1  # a leaf and its ancestors


def test_query_equals_its_sql_and_plain_trees(spark):
    got = result(QUERIES["op11_merkle_manifest"](spark, SF))
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got == sorted(brute(rows), key=repr) and {r[-1] for r in got} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op11_merkle_manifest']})").fetchall()
    assert got == sorted(want, key=repr)


def test_sql_on_odd_rows(spark):
    con = duckdb.connect()
    con.register("documents", table(spark, made_rows()).toArrow())
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op11_merkle_manifest']})").fetchall()
    assert sorted(brute(made_rows()), key=repr) == sorted(want, key=repr)


def test_small_and_empty_tables(spark):
    assert merkle.manifest(table(spark, [])).collect() == []
    for rows in ([(5, None, None, None, None)], [(5, "s", "en", 3, "a\n" * 200_000)], [(5, "s", "en", 3, "a"), (6, "t", "en", 3, "b")]):
        assert result(merkle.manifest(table(spark, rows))) == sorted(brute(rows), key=repr)
