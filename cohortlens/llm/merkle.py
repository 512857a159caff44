"""Operator 11: Merkle manifest of a dataset, and what tampered rows do to it.

H(...) is the lowercase hex sha256 of its inputs joined.  A leaf is H of the row's fields, each ``-`` for
null, else its UTF-8 length, ``:`` and the value.  In each group the leaves ascend by id; every ``ARITY``
consecutive nodes (the last run may be shorter) become their H until one is left: the subroot.  The
subroots, by group (null first, then bytewise), become the root in the same way.

1. Leaf hashes, and those of tampered rows, are map-only; texts are not shuffled.  Positions come from
   :func:`dense_index`, so a hot group is numbered by many tasks.
2. Aligned blocks of ``BLOCK`` = 3**6 consecutive nodes are built in one task each.  Their tops, a
   ``BLOCK``-th of the nodes, are the nodes of the next round, up to one node per group, and the same way
   for the subroots.  Each round also keeps, for every node, its siblings up to its block's top.
3. Downwards, each block's path to the root is its top's siblings, then the path of the block above: one row per block.
4. Each block of leaves is then built once more as a persistent tree, with its path: for every tampered row
   a version is made by copying the nodes from that leaf to the block's top; all others are
   shared with the first version.  The version goes on along the path, so that no task but its own sees it.

No task holds more than some blocks, and blocks with their paths are joined by key; nothing is collected.

Cases: null fields are ``-``, an empty text is ``0:``; rows of a null id come first and are never
tampered with; rows that repeat an id are leaves of their own, ordered by their hashes; a group of one row
has its leaf as subroot, a table of one group its subroot as root, and no siblings give H of nothing; an
empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import dense_index
from .common import saved

ARITY, LEVELS = 3, 6
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Node:
    """A node of a persistent tree: it is never changed, so versions may share it."""

    __slots__ = ("digest", "children")

    def __init__(self, digest: str, children: tuple[Node, ...] = ()):
        self.digest, self.children = digest, children


def parent(children: tuple[Node, ...]) -> Node:
    return Node(digest(*[c.digest for c in children]), children)


def block_tree(leaves: list[str], first_block: bool) -> tuple[Node, int]:
    """The top of a block's tree and its height.

    Only a group's first block may be its only one (any later block follows a full one), so only that one
    ends as soon as one node is left; the others rise by all levels of a block.
    """
    level, height = [Node(d) for d in leaves], 0
    while height < LEVELS and (len(level) > 1 or not first_block):
        level = [parent(tuple(level[i:i + ARITY])) for i in range(0, len(level), ARITY)]
        height += 1
    return level[0], height


def way(top: Node, height: int, position: int) -> list[tuple[Node, int]]:
    """The nodes above a leaf, from the top down, each with the number of the child towards the leaf."""
    out, node = [], top
    for h in range(height - 1, -1, -1):
        out.append((node, position // ARITY**h % ARITY))
        node = node.children[out[-1][1]]
    return out


def replaced(steps: list[tuple[Node, int]], leaf: str) -> Node:
    """The top of a new version with another leaf: the nodes on the way are copied, their other children shared."""
    node = Node(leaf)
    for above, k in reversed(steps):
        node = parent(above.children[:k] + (node,) + above.children[k + 1:])
    return node


def siblings(steps: list[tuple[Node, int]]) -> list[tuple[str, str]]:
    """From the leaf up: the digests left and right of the way, joined."""
    return [("".join(c.digest for c in node.children[:k]), "".join(c.digest for c in node.children[k + 1:])) for node, k in reversed(steps)]


def folded(node: str, path: list[tuple[str, str]]) -> str:
    """What a digest becomes along a path of siblings."""
    for left, right in path:
        node = digest(left, node, right)
    return node


def encoded(columns: list[Column]) -> Column:
    """The fields, each as its length and value, joined (binary)."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts).cast("binary")


def leaves(docs: DataFrame, tampered: Column, change: Column, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
           group_col: str = "source", text_col: str = "text") -> DataFrame:
    """(grp, id, leaf, changed, pos): each row's leaf, its leaf with the changed text where tampered (else null) and position in its group."""
    others = [change if f == text_col else F.col(f) for f in fields]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),  # null first, and never a null key
        F.col(id_col).alias("id"), F.sha2(encoded([F.col(f) for f in fields]), 256).alias("leaf"),
        F.when(tampered, F.sha2(encoded(others), 256)).alias("changed"))
    return dense_index(rows, ["id", "leaf", "changed"], "pos", group_cols=["grp"])


def blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (grp, pos, node) with their block: (grp, block, pos, node)."""
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))


PATH = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
PATH_SQL = "array<struct<l:string,r:string>>"


def in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def tops(nodes: DataFrame) -> DataFrame:
    """(grp, pos, node): the top of every block, which are the nodes of the next round."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        grp, block = key[0].as_py(), key[1].as_py()
        top, _ = block_tree(in_order(table)["node"].to_pylist(), block == 0)
        return pa.table({"grp": pa.array([grp], pa.string()), "pos": pa.array([block], pa.int64()), "node": pa.array([top.digest], pa.string())})

    return blocks(nodes).select("grp", "block", "pos", "node").groupBy("grp", "block").applyInArrow(run, "grp string, pos long, node string")


def paths_in_blocks(nodes: DataFrame) -> DataFrame:
    """(grp, pos, block, path): every node's siblings up to its block's top."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        grp, block = key[0].as_py(), key[1].as_py()
        table = in_order(table)
        top, height = block_tree(table["node"].to_pylist(), block == 0)
        n = table.num_rows
        paths = [[{"l": left, "r": right} for left, right in siblings(way(top, height, at))] for at in range(n)]
        return pa.table({"grp": pa.array([grp] * n, pa.string()), "pos": table["pos"].cast(pa.int64()), "block": pa.array([block] * n, pa.int64()), "path": pa.array(paths, PATH)})

    return blocks(nodes).select("grp", "block", "pos", "node").groupBy("grp", "block").applyInArrow(run, f"grp string, pos long, block long, path {PATH_SQL}")


def paths_to_subroot(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For nodes (grp, pos, node): (grp, pos, path), their siblings up to the group's subroot; and (grp, subroot).

    Rounds are few: each has a ``BLOCK``-th of the nodes of the one before.
    """
    rounds = [nodes]
    while (rounds[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        rounds.append(saved(tops(rounds[-1])))
    none = F.array().cast(PATH_SQL)
    path = rounds[-1].select("grp", "pos", none.alias("path"))
    for nodes_below in reversed(rounds[:-1]):
        upper = path.select("grp", F.col("pos").alias("block"), F.col("path").alias("rest"))
        path = saved(paths_in_blocks(nodes_below).join(upper, ["grp", "block"]).select("grp", "pos", F.concat("path", "rest").alias("path")))
    return path, rounds[-1].select("grp", F.col("node").alias("subroot"))


def verified(rows: DataFrame, with_proof: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for the rows of :func:`leaves`;
    ``with_proof`` adds the siblings themselves, ``proof``: (l, r) per level."""
    rows = saved(blocks(rows))
    first = saved(tops(rows.select("grp", "pos", F.col("leaf").alias("node"))))  # one row per block of leaves
    path, subroots = paths_to_subroot(first)
    forest = saved(dense_index(subroots, ["grp"], "pos"))
    above, roots = paths_to_subroot(forest.select(F.lit("").alias("grp"), "pos", F.col("subroot").alias("node")))
    forest = forest.join(above.select("pos", F.col("path").alias("last")), "pos").withColumn("root", roots.select("subroot").scalar())
    joined = path.join(forest.select("grp", "subroot", "root", "last"), "grp")
    whole = joined.select(F.col("grp").alias("w_grp"), F.col("pos").alias("w_block"), "subroot", "root", F.concat("path", "last").alias("path"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        left, above = in_order(left), [(s["l"], s["r"]) for s in right["path"][0].as_py()]
        root, subroot = right["root"][0].as_py(), right["subroot"][0].as_py()
        top, height = block_tree(left["leaf"].to_pylist(), key[1].as_py() == 0)
        whole_root, upper = folded(top.digest, above), "".join(a + b for a, b in above)
        proofs, ends, listed = [], [], []
        for at, changed in enumerate(left["changed"].to_pylist()):
            steps = way(top, height, at)
            own = siblings(steps)
            proofs.append(digest(*[a + b for a, b in own], upper))
            ends.append(whole_root if changed is None else folded(replaced(steps, changed).digest, above))
            listed.append([{"l": a, "r": b} for a, b in own + above] if with_proof else None)
        n = left.num_rows
        return pa.table({"id": left["id"], "leaf": left["leaf"].cast(pa.string()), "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                         "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(ends, pa.string()), "proof": pa.array(listed, PATH)})

    out = rows.groupBy("grp", "block").cogroup(whole.groupBy("w_grp", "w_block")).applyInArrow(
        run, f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, proof {PATH_SQL}")
    out = out.withColumn("verified", F.col("folded_root") == F.col("root"))
    return out if with_proof else out.drop("proof")


def every_other(id_col: str) -> Column:
    """Condition: the checksum of the id's decimals is even; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def manifest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_proof: bool = False) -> DataFrame:
    """The documents' manifest, checked against copies of which every other one lost its line ends."""
    rows = leaves(docs, every_other(id_col), F.replace(F.col(text_col), F.lit("\n"), F.lit("")), id_col=id_col, text_col=text_col,
                  fields=tuple({"doc_id": id_col, "text": text_col}.get(f, f) for f in FIELDS))
    return verified(rows, with_proof).withColumnRenamed("id", id_col)


def oracle_sql() -> str:
    """DuckDB SQL of :func:`manifest` on documents: levels and folds by recursion, crc32 bit by bit."""
    step = "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    ones, characters = "CAST(4294967295 AS BIGINT)", "list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)"
    crc = f"xor({ones}, list_reduce({characters}, lambda a, b: list_reduce(range(8), {step}, xor(a, b)), {ones}))"

    def leaf(text: str) -> str:
        values = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(values)})"

    changed = leaf("replace(text, chr(10), '')")
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS grp, {leaf('text')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN {changed} END AS changed FROM documents),
l AS MATERIALIZED (SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY grp) AS cnt,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS pos FROM d),
t(grp, lvl, pos, cnt, h) AS (SELECT grp, 0, pos, cnt, leaf FROM l UNION ALL
    SELECT grp, lvl + 1, pos // {ARITY}, (cnt + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY pos)) FROM t
    WHERE cnt > 1 GROUP BY grp, lvl, pos // {ARITY}, cnt),
s AS MATERIALIZED (SELECT grp, lvl, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS cnt FROM t WHERE cnt = 1),
f(lvl, pos, cnt, h) AS (SELECT 0, pos, cnt, subroot FROM s UNION ALL
    SELECT lvl + 1, pos // {ARITY}, (cnt + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY pos)) FROM f
    WHERE cnt > 1 GROUP BY lvl, pos // {ARITY}, cnt),
sides AS MATERIALIZED (SELECT grp, lvl, pos, cnt,
    CASE WHEN pos % 3 = 2 THEN lag(h, 2) OVER w ELSE '' END || CASE WHEN pos % 3 >= 1 THEN lag(h) OVER w ELSE '' END AS lft,
    CASE WHEN pos % 3 <= 1 THEN coalesce(lead(h) OVER w, '') ELSE '' END || CASE WHEN pos % 3 = 0 THEN coalesce(lead(h, 2) OVER w, '') ELSE '' END AS rgt
    FROM (SELECT grp, lvl, pos, cnt, h FROM t UNION ALL SELECT '/', lvl, pos, cnt, h FROM f) WINDOW w AS (PARTITION BY grp, lvl ORDER BY pos)),
p(id, grp, lvl, pos, proof, fold) AS (SELECT id, grp, 0, pos, '', coalesce(changed, leaf) FROM l UNION ALL
    SELECT p.id, p.grp, p.lvl + 1, p.pos // {ARITY}, p.proof || x.lft || x.rgt, sha256(x.lft || p.fold || x.rgt)
    FROM p JOIN sides x ON x.grp = p.grp AND x.lvl = p.lvl AND x.pos = p.pos WHERE x.cnt > 1),
u(id, lvl, pos, proof, fold) AS (SELECT p.id, 0, s.pos, p.proof, p.fold FROM p JOIN s ON s.grp = p.grp AND s.lvl = p.lvl UNION ALL
    SELECT u.id, u.lvl + 1, u.pos // {ARITY}, u.proof || x.lft || x.rgt, sha256(x.lft || u.fold || x.rgt)
    FROM u JOIN sides x ON x.grp = '/' AND x.lvl = u.lvl AND x.pos = u.pos WHERE x.cnt > 1)
SELECT l.doc_id, l.leaf, s.subroot, f.h AS root, sha256(u.proof) AS proof_sha256, u.fold AS folded_root, u.fold = f.h AS verified
FROM u JOIN f ON f.cnt = 1 AND f.lvl = u.lvl JOIN l ON l.id = u.id JOIN s ON s.grp = l.grp
"""


ORACLE_SQL = oracle_sql()
