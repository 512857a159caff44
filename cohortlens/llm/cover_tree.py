"""Operator 6: exact top-k inner products by a dual-tree search over cover trees.

Vectors become integers floor(64 * x); a score is the integer inner product.

1. A bounded sample gives pivots; every vector goes to its nearest pivot, and each pivot's
   vectors are dealt by hash into blocks of at most about ``BLOCK`` rows, so equal vectors, however
   many, are spread.  The sample shapes the blocks only; every row is in one.
2. In a task, a cover tree is built over one block (each node covers its points within
   its radius; children are a net of half that radius, of at most ``FAN`` centres, and points beyond
   the net join the nearest of them) and one over a block of queries.
3. First each query searches one block of its own pivot: the kth score found there is a
   lower bound for its final kth score.
4. A query is dealt to a pivot's blocks unless <q, c> + |q| R, for the pivot's centre c and the greatest
   distance R of its vectors, stays below that bound.  There it starts from the bound.  The
   search descends both trees and drops a pair of nodes when no inner product between them can
   reach the worst kth score of the query node:  <q, c> + |q| R + |c| r + r R  bounds them,
   for centres q, c and radii r, R.  Ties stay, so equal scores are settled by the smaller id.
5. A block returns at most k rows per query; a query's k best of all blocks are the result.

Cases: rows whose vector is null or holds null or non-finite components, and rows without
an id, take no part; shorter vectors count as padded with zeros; a query never meets rows
with its own id; a repeated query id searches once (its smallest vector); repeated candidate
rows each count.  Scores are exact: sums that could pass 2**53 use integers of any size and
are limited to the range of a long at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SCALE = 64
K = 20
EVERY = 20  # queries: ids divisible by this
PIVOTS = 64  # at most; one for each half block of rows
BLOCK = 8192
FAN = 32  # children of a node, and no more than fill a leaf each
LEAF, QUERY_LEAF = 64, 32  # points of a data leaf; of a query leaf, whose worst kth score prunes for all of it
FIRST, CHUNK = 128, 2048  # points scored in a leaf's first call, and at most, as calls grow


class Ranges:
    """Lists of numbers, of which many are read at once."""

    def __init__(self, lists: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in lists])
        self.starts, self.values = np.cumsum(self.sizes) - self.sizes, np.concatenate(lists)

    def of(self, which: np.ndarray) -> np.ndarray:
        n = self.sizes[which]
        return self.values[np.repeat(self.starts[which] - np.cumsum(n) + n, n) + np.arange(n.sum())]


class CoverTree:
    """Nodes of a simplified cover tree: centre, covering radius, children or points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray] = []
        self.root = self.grow(np.arange(len(points)))
        self.centres, self.radii = np.array(self.centre), np.array(self.radius)
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.is_leaf = np.array([c is None for c in self.children])
        self.below = Ranges([np.array([k]) if c is None else c for k, c in enumerate(self.children)])  # a leaf stands for itself
        self.held = Ranges([m if leaf else m[:0] for m, leaf in zip(self.members, self.is_leaf)])

    def grow(self, members: np.ndarray) -> int:
        """A node over the members, split into a net of half its radius (iteratively, top down)."""
        top, todo = len(self.centre), [(members, None)]
        while todo:
            own, parent = todo.pop()
            node, centre = len(self.centre), self.points[own[0]]
            away = np.sqrt(((self.points[own] - centre) ** 2).sum(axis=1))
            self.centre.append(centre)
            self.radius.append(float(away.max()))
            self.children.append(None)
            self.members.append(own)
            if parent is not None:
                self.children[parent] = np.append(self.children[parent], node)
            if len(own) > self.leaf // 4 and away.max() > 0:
                large = len(own) > self.leaf
                parts, covered = self.net(own, float(away.max()) / 2, min(FAN, max(2, len(own) // self.leaf)) if large else 4)
                if large or covered:  # a small node is split only where a net covers it
                    self.children[node] = np.zeros(0, np.int64)
                    todo += [(part, node) for part in parts]
        return top

    def net(self, members: np.ndarray, reach: float, fan: int) -> tuple[list[np.ndarray], bool]:
        """At most ``fan`` groups of members within ``reach`` of a first one, and whether these are all;
        the rest go to the nearest of these."""
        first, parts, rest = [], [], members
        while len(rest) and len(first) < fan:
            near = ((self.points[rest] - self.points[rest[0]]) ** 2).sum(axis=1) <= reach * reach
            near[0] = True
            first.append(rest[0])
            parts.append(rest[near])
            rest = rest[~near]
        if len(rest):
            centres = self.points[first]
            own = ((centres**2).sum(axis=1) - 2 * self.points[rest] @ centres.T).argmin(axis=1)
            parts = [np.concatenate([part, rest[own == k]]) for k, part in enumerate(parts)]
        return parts, not len(rest)


class Search:
    """The k best data points of every query, from two cover trees and lower bounds of the kth scores."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, bounds: np.ndarray, k: int):
        self.queries, self.query_ids, self.data, self.ids, self.k = queries, query_ids, data, ids, k
        big = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, data.shape[1])
        self.exact = big < 2**53
        self.best = np.full((len(queries), k), -np.inf) if self.exact else np.full((len(queries), k), -(1 << 200), dtype=object)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.bounds, self.scored = bounds, 0
        self.q, self.d = CoverTree(queries, QUERY_LEAF), CoverTree(data)
        self.descend(self.q.root, np.array([self.d.root]))

    def worst(self, members: np.ndarray) -> float:
        """No point below this can be among the k best of any of the queries."""
        return float(np.maximum(self.best[members, -1].astype(float), self.bounds[members]).min())

    def limits(self, node: int, others: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products between a query node and data nodes, with room for rounding."""
        q, r = self.q.centre[node], self.q.radius[node]
        norm = float(np.sqrt((q**2).sum()))
        at = self.d.centres[others] @ q + norm * self.d.radii[others] + self.d.norms[others] * r + r * self.d.radii[others]
        return at + 1e-9 * (np.abs(at) + norm * self.d.norms[others]) + 1e-6

    def descend(self, node: int, others: np.ndarray) -> None:
        todo = [(node, others)]
        while todo:
            node, others = todo.pop()
            others = others[self.limits(node, others) >= self.worst(self.q.members[node])]
            if not len(others):
                continue
            if self.q.children[node] is not None:
                others = self.expand(others)
                todo += [(child, others) for child in self.q.children[node]]
                continue
            while not self.d.is_leaf[others].all():
                others = self.expand(others)
                others = others[self.limits(node, others) >= self.worst(self.q.members[node])]
            self.score(node, others)

    def expand(self, others: np.ndarray) -> np.ndarray:
        """The nodes' children; leaves stay."""
        return self.d.below.of(others)

    def score(self, node: int, leaves: np.ndarray) -> None:
        """Scores leaves in falling order of their bounds, as long as they can matter."""
        own, limit = self.q.members[node], self.limits(node, leaves)
        order = np.argsort(-limit, kind="stable")
        ends = np.cumsum(self.d.held.sizes[leaves[order]])
        at, chunk = 0, FIRST
        while at < len(order) and limit[order[at]] >= self.worst(own):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk, side="right")))
            self.merge(own, self.d.held.of(leaves[order[at:upto]]))
            at, chunk = upto, min(2 * chunk, CHUNK)

    def merge(self, own: np.ndarray, points: np.ndarray) -> None:
        self.scored += len(own) * len(points)
        if self.exact:
            self.merge_floats(own, points)
            return
        whole, lowest = np.vectorize(int, otypes=[object]), -(1 << 200)
        scores = whole(self.queries[own]) @ whole(self.data[points]).T
        ids = np.broadcast_to(self.ids[points], scores.shape)
        same = ids == self.query_ids[own][:, None]
        scores = np.concatenate([self.best[own], np.where(same, lowest, scores)], axis=1)
        ids = np.concatenate([self.found[own], np.where(same, np.iinfo(np.int64).max, ids)], axis=1)
        for row, s, i in zip(own, scores, ids):
            order = sorted(range(len(s)), key=lambda x: (-s[x], i[x]))[: self.k]
            self.best[row], self.found[row] = s[order], i[order]

    def merge_floats(self, own: np.ndarray, points: np.ndarray) -> None:
        """Only scores that reach a query's worst kth one are sorted, those of all queries at once."""
        scores = self.queries[own] @ self.data[points].T
        scores[self.query_ids[own][:, None] == self.ids[points][None, :]] = -np.inf
        least = np.maximum(self.best[own, -1], self.bounds[own])
        if len(points) >= self.k:
            fresh = np.flatnonzero(least == -np.inf)
            least[fresh] = np.partition(scores[fresh], len(points) - self.k, axis=1)[:, len(points) - self.k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
        if not len(row):
            return
        touched = np.unique(row)
        row = np.concatenate([row, np.repeat(touched, self.k)])
        value = np.concatenate([scores[row[:len(col)], col], self.best[own[touched]].reshape(-1)])
        ident = np.concatenate([self.ids[points[col]], self.found[own[touched]].reshape(-1)])
        order = np.lexsort((ident, -value, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        order, place = order[place < self.k], place[place < self.k]
        self.best[own[row[order]], place], self.found[own[row[order]], place] = value[order], ident[order]

    def rows(self) -> Iterator[tuple]:
        low, top = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        for q, scores, ids, bound in zip(self.query_ids, self.best, self.found, self.bounds):
            for s, i in zip(scores, ids):
                if i != top and s >= bound:
                    yield int(q), int(i), min(max(int(s), low), top)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(64 * x) of every vector, padded with zeros."""
    out = np.zeros((len(column), dim))
    for row, v in enumerate(column):
        x = np.asarray(v.values, dtype=np.float64)
        out[row, : len(x)] = np.floor(SCALE * x)
    return out


def unpack(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def sound(col: str) -> Column:
    """Condition: the vector and all its components are there and finite."""
    return F.col(col).isNotNull() & ~F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def deal(vectors: DataFrame, pivots: np.ndarray, dim: int, block: int) -> tuple[DataFrame, dict[int, tuple[int, int, float]]]:
    """(id, v, pivot, block): integer vectors as bytes, dealt to blocks; and, by pivot, its first
    block, number of blocks and greatest distance of a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column(1), dim)
            away = (pivots**2).sum(axis=1) - 2 * x @ pivots.T
            own = away.argmin(axis=1)
            far = np.sqrt(((x - pivots[own]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()),
                                              pa.array(own, pa.int32()), pa.array(far)], names=["id", "v", "pivot", "far"])

    placed = saved(vectors.mapInArrow(run, "id long, v binary, pivot int, far double"))
    sizes = placed.groupBy("pivot").agg(F.count("*"), F.max("far")).collect()  # one row per pivot
    first, cuts, blocks = 0, [], {}
    for pivot, n, far in sorted(tuple(r) for r in sizes):
        parts = -(-n // block)
        blocks[pivot] = (first, parts, far)
        cuts += [F.lit(pivot), F.struct(F.lit(first).alias("first"), F.lit(parts).alias("parts"))]
        first += parts
    placed = placed.drop("far")
    if not cuts:
        return placed.withColumn("block", F.lit(0)), blocks
    cut = F.create_map(*cuts)[F.col("pivot")]
    return placed.withColumn("block", (cut["first"] + F.pmod(F.xxhash64("id"), cut["parts"])).cast("int")), blocks


def reached(queries: DataFrame, pivots: np.ndarray, blocks: dict[int, tuple[int, int, float]], dim: int) -> DataFrame:
    """The queries (id, v, part, bound) with every block that may hold one of their k best."""
    used = sorted(blocks)
    centres, far = pivots[used], np.array([blocks[p][2] for p in used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = unpack(batch.column(1), dim)
            bound = np.array([-np.inf if b is None else float(b) for b in batch.column(3).to_pylist()])
            norm = np.sqrt((q**2).sum(axis=1))[:, None]
            most = q @ centres.T + norm * far
            row, pivot = np.nonzero(most + 1e-9 * (np.abs(most) + norm * (np.sqrt((centres**2).sum(axis=1)) + far)) + 1e-6 >= bound[:, None])
            parts = [blocks[used[p]] for p in pivot]
            pick = pa.array(np.repeat(row, [n for _, n, _ in parts]), pa.int64())
            where = [b for f, n, _ in parts for b in range(f, f + n)]
            yield pa.RecordBatch.from_arrays([*[c.take(pick) for c in batch.columns], pa.array(where, pa.int32())], names=["id", "v", "part", "bound", "block"])

    return queries.select("id", "v", "part", "bound").mapInArrow(run, "id long, v binary, part int, bound long, block int")


def search_groups(data: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the k best per query of each group (block, part)."""

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            bounds = np.array([-np.inf if b is None else float(b) for b in right["q_bound"].to_pylist()])
            rows = list(Search(unpack(right["q_v"], dim), right["q_id"].to_numpy(), unpack(left["v"], dim), left["id"].to_numpy(), bounds, k).rows())
        q, i, s = zip(*rows) if rows else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    asked = queries.select([F.col(c).alias(f"q_{c}") for c in ("id", "v", "bound", "block", "part")])  # both sides stem from one table
    return data.groupBy("block", "part").cogroup(asked.groupBy("q_block", "q_part")).applyInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding",
          pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """One row per query and rank: query_id, rank (from 1), vec_id, score."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x")).where(F.col("id").isNotNull() & sound("x"))
    dim = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 1)
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id", "x").limit(max(1, min(pivots, -(-2 * n // block)))).collect()
    held = np.unique(integers(pa.array([r["x"] for r in sample], pa.list_(pa.float64())), dim), axis=0) if sample else np.zeros((1, dim))
    data, blocks = deal(rows, held, dim, block)
    data = saved(data)
    asked = data.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("v", "block")).alias("r")).select("id", "r.v", "r.block")
    asked = saved(asked)
    parts = max(1, -(-asked.count() // block))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int"))
    everywhere = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    home = search_groups(everywhere, asked.withColumn("bound", F.lit(None).cast("long")), dim, k)
    bound = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("bound")).where(F.col("n") == k).select(F.col("query_id").alias("id"), "bound")
    bounded = saved(asked.drop("block").join(bound, "id", "left"))
    found = search_groups(everywhere, reached(bounded, held, blocks, dim), dim, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
