"""Operator 13: approximate nearest neighbours by inner product, from balanced posting lists.

1. The largest norm M turns the search into one by distance: a vector x becomes (x, sqrt(M^2 - |x|^2)) and a
   query q becomes (M q / |q|, 0); the largest inner product is then the least distance.
2. A bounded sample (``SAMPLE`` rows by hash of the id, fewer if long) is split into halves of equal size until
   there is one cluster per ``LIST`` rows of the table (at most ``MAX_LISTS``): balanced lists.  Only the centroids come from the
   sample; every row is in a list.
3. The centroids form a graph held by every task: links to near centroids and, in the order of the
   clusters, to those 1, 2, 4, ... further on.  A best-first search with a beam finds the nearest ones.
4. A vector goes to its nearest centroid's list and, at a boundary, to up to ``REPLICAS`` lists whose
   centroids are at most ``CLOSE`` times as far.
5. A query reads the lists whose centroids are at most ``ratio`` times as far as the nearest one, and always
   enough lists for k rows.  The ratio is measured on the sample: least such that ``TARGET`` of the sample
   queries' true neighbours in the sample are in a list read; so clustered tables read few lists, and a table of
   random directions reads many.
6. Neighbouring lists share a group of at most about ``GROUP`` rows, longer lists are dealt to several groups; the
   queries of a group are dealt to parts of ``QUERIES``.  A task scores one group for one part and returns the k
   best of each query; a query's k best of all its groups, each row once, are the result.

Cases: vectors that are null, zero, or hold null or non-finite components, and rows without an id, take no
part; shorter vectors count as padded with zeros; a query never meets rows with its own id; a
repeated query id searches once (its smallest vector); a repeated row id is found once per query, by its best
vector; equal scores are ranked by id; fewer than k candidates are all found; an empty table gives no rows.
Scores are sums of products in double precision, from the first component to the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, saved
from .cover_tree import sound

K = 20
EVERY = 20  # queries: ids divisible by this
SAMPLE, SAMPLE_BYTES = 4096, 32 << 20
LIST, MAX_LISTS = 256, 2048
LINKS = 12  # near centroids linked to each
BEAM = 16  # of the search for a row's lists
REPLICAS, CLOSE = 3, 1.03
TARGET, ASKED = 0.96, 256  # share of neighbours that the lists read must hold, for so many queries of the sample
GROUP, QUERIES = 8192, 4096
STEP = 1 << 21  # (row, centroid) marks held at once


def balanced_clusters(points: np.ndarray, n: int) -> list[np.ndarray]:
    """n groups of equal size (but for rounding): each split cuts along the line between two means."""
    todo, out = [(np.arange(len(points)), n)], []
    while todo:
        own, m = todo.pop()
        if m == 1:
            out.append(own)
            continue
        x = points[own] - points[own].mean(axis=0)
        line, cut = x[np.argmax((x**2).sum(axis=1))], len(own) * (m // 2) // m
        for _ in range(5):  # towards the main axis
            line = x.T @ (x @ line)
            line = line / max(float(np.sqrt(line @ line)), 1e-300)
        for _ in range(4):  # two means of equal halves
            order = np.argsort(x @ line, kind="stable")
            line = x[order[cut:]].mean(axis=0) - x[order[:cut]].mean(axis=0)
        order = np.argsort(x @ line, kind="stable")
        todo += [(own[order[cut:]], m - m // 2), (own[order[:cut]], m // 2)]
    return out


class CentroidGraph:
    """Centroids in cluster order, each linked to its nearest ones and to those 1, 2, 4, ... further on."""

    def __init__(self, centres: np.ndarray, links: int = LINKS):
        n = len(centres)
        self.centres, self.squares = centres, (centres**2).sum(axis=1)
        near = np.empty((n, min(links, n)), np.int64)
        for at in range(0, n, 512):
            away = self.squares - 2 * centres[at:at + 512] @ centres.T
            near[at:at + 512] = np.argsort(away, axis=1, kind="stable")[:, :near.shape[1]]
        steps = [1 << j for j in range(max(1, (n - 1).bit_length()))]
        further = (np.arange(n)[:, None] + np.array(steps + [-1])) % n
        self.links = np.concatenate([near, further], axis=1)

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the ``beam`` nearest ones that a best-first search finds, nearest first; -1 where fewer."""
        n, beam = len(self.centres), min(beam, len(self.centres))
        chunk = max(1, STEP // n)
        parts = [self.walk(x[at:at + chunk], beam) for at in range(0, len(x), chunk)]
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.zeros((0, beam), np.int64), np.zeros((0, beam)))

    def walk(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, m = len(self.centres), len(x)
        found, away = np.full((m, beam), -1), np.full((m, beam), np.inf)
        open_, seen = np.zeros((m, beam), bool), np.zeros((m, n), bool)
        rows = np.arange(m)
        fresh = np.tile(np.unique(np.arange(0, n, max(1, n // 8))), (m, 1))  # entries
        while len(rows):
            # each centroid once per row
            mark = np.zeros((len(rows), n), bool)
            mark[np.arange(len(rows))[:, None], fresh] = True
            mark &= ~seen[rows]
            seen[rows] |= mark
            r, c = np.nonzero(mark)
            d = self.squares[c] - 2 * np.einsum("ij,ij->i", x[rows[r]], self.centres[c])
            width = int(mark.sum(axis=1).max(initial=0))
            slot = np.arange(len(r)) - np.searchsorted(r, r)
            new_found, new_away = np.full((len(rows), width), -1), np.full((len(rows), width), np.inf)
            new_found[r, slot], new_away[r, slot] = c, d
            both, dist = np.concatenate([found[rows], new_found], axis=1), np.concatenate([away[rows], new_away], axis=1)
            flag = np.concatenate([open_[rows], new_found >= 0], axis=1)
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            found[rows], away[rows] = np.take_along_axis(both, order, axis=1), np.take_along_axis(dist, order, axis=1)
            open_[rows] = np.take_along_axis(flag, order, axis=1)
            rows = rows[open_[rows].any(axis=1)]
            best = np.argsort(~open_[rows], axis=1, kind="stable")[:, :4]  # the nearest open ones
            ready = np.take_along_axis(open_[rows], best, axis=1)
            open_[rows[:, None], best] = False
            nodes = np.where(ready, found[rows[:, None], best], found[rows, best[:, 0]][:, None])
            fresh = self.links[nodes].reshape(len(rows), self.links.shape[1] * best.shape[1])
        return found, np.sqrt(np.maximum(away + (x**2).sum(axis=1)[:, None], 0))


def lengthened(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows (x, sqrt(norm^2 - |x|^2)): all of length ``norm``."""
    return np.concatenate([x, np.sqrt(np.maximum(norm**2 - (x**2).sum(axis=1), 0))[:, None]], axis=1)


def asked(x: np.ndarray, norm: float) -> np.ndarray:
    """Queries (x, 0) scaled to length ``norm``."""
    scaled = x * (norm / np.sqrt((x**2).sum(axis=1)))[:, None]
    return np.concatenate([scaled, np.zeros((len(x), 1))], axis=1)


def lists_of(graph: CentroidGraph, points: np.ndarray) -> list[np.ndarray]:
    """The lists that hold each point: the nearest, and those nearly as near."""
    found, away = graph.search(points, BEAM)
    take = (found >= 0) & (away <= away[:, :1] * CLOSE)
    take[:, REPLICAS:] = False
    take[:, 0] = True
    return [f[t] for f, t in zip(found, take)]


class Index:
    """Centroid graph, the reading ratio and the beam that covers it; fitted on a sample."""

    def __init__(self, sample: np.ndarray, rows: int, norm: float, k: int = K):
        self.norm = norm
        self.graph, self.ratio, self.beam = CentroidGraph(np.zeros((1, sample.shape[1] + 1))), 1.0, 1
        if len(sample):
            self.fit(sample, rows, k)

    def fit(self, sample: np.ndarray, rows: int, k: int) -> None:
        n = max(1, min(MAX_LISTS, -(-rows // LIST), len(sample) // 2))
        points = lengthened(sample, self.norm)
        self.graph = CentroidGraph(np.array([points[c].mean(axis=0) for c in balanced_clusters(points, n)]))
        queries = asked(sample[:: max(1, len(sample) // ASKED)], self.norm)
        found, away = self.graph.search(queries, n)
        share = np.full((len(queries), n), np.inf)  # how much further than the nearest each centroid is
        r, c = np.nonzero(found >= 0)
        share[r, found[r, c]] = away[r, c] / np.maximum(away[r, :1].reshape(-1), 1e-300)
        near = max(1, -(-k * len(sample) // max(rows, 1)))  # as far out in the sample as k rows in the table
        scores = queries[:, :-1] @ sample.T
        scores[np.arange(len(queries)), np.arange(len(queries)) * max(1, len(sample) // ASKED)] = -np.inf
        held = lists_of(self.graph, points)
        needed = [min(share[q, held[j]]) for q in range(len(queries)) for j in np.argsort(-scores[q])[:near] if np.isfinite(scores[q, j])]
        self.ratio = float(np.quantile(needed, TARGET, method="higher")) * (1 + 1e-9) if needed else 1.0
        self.beam = min(n, BEAM + int((share <= self.ratio).sum(axis=1).max(initial=1)))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors padded with zeros."""
    out = np.zeros((len(column), dim))
    for row, v in enumerate(column):
        out[row, : len(v)] = v.values.to_numpy(zero_copy_only=False)
    return out


def packed(x: np.ndarray, single: bool) -> pa.Array:
    return pa.array([r.tobytes() for r in (x.astype(np.float32) if single else x)], pa.binary())


def unpacked(column, dim: int, single: bool) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32 if single else np.float64).reshape(-1, dim).astype(np.float64)


def scores_of(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed from the first component to the last."""
    out = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        out += queries[:, j] * vectors[:, j]
    return out


def best_pairs(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which pairs (query, id, score) are among the k best of their query, each id once; ties to the smaller id."""
    order = np.lexsort((-scores, ids, query))
    first = order[np.concatenate([[True], (query[order][1:] != query[order][:-1]) | (ids[order][1:] != ids[order][:-1])])[:len(order)]]
    order = first[np.lexsort((ids[first], -scores[first], query[first]))]
    begin = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - begin < k]


def search_lists(queries: np.ndarray, query_ids: np.ndarray, wanted: list[np.ndarray], vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int) -> tuple:
    """(query row, vector id, score) of the k best of each query in the lists that it wants."""
    order = np.argsort(lists, kind="stable")
    names, starts = np.unique(lists[order], return_index=True)
    reader = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
    asks = np.concatenate([np.asarray(w, np.int64) for w in wanted]) if len(wanted) else np.zeros(0, np.int64)
    by = np.argsort(asks, kind="stable")
    asks, reader = asks[by], reader[by]
    worst = np.full(len(queries), -np.inf)  # k rows score at least this
    spare = 1e-9 * float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])  # rounding of a product
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for name, begin, end in zip(names, starts, np.append(starts[1:], len(lists))):
        who = reader[np.searchsorted(asks, name):np.searchsorted(asks, name, side="right")]
        at = order[begin:end]
        if not len(who):
            continue
        scores = queries[who] @ vectors[at].T
        scores[query_ids[who][:, None] == ids[at][None, :]] = -np.inf
        if len(at) >= k and len(np.unique(ids[at])) == len(at):
            worst[who] = np.maximum(worst[who], np.partition(scores, len(at) - k, axis=1)[:, len(at) - k])
        r, c = np.nonzero((scores >= worst[who][:, None] - spare) & (scores > -np.inf))
        kept.append((who[r], at[c]))
    q = np.concatenate([a for a, _ in kept]) if kept else np.zeros(0, np.int64)
    v = np.concatenate([b for _, b in kept]) if kept else np.zeros(0, np.int64)
    exact = np.concatenate([scores_of(queries[q[i:i + STEP // 8]], vectors[v[i:i + STEP // 8]]) for i in range(0, len(q), STEP // 8)]) if len(q) else np.zeros(0)
    best = best_pairs(q, ids[v], exact, k)
    return q[best], ids[v[best]], exact[best]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"))
    return rows.where(F.col("id").isNotNull() & sound("x") & F.exists("x", lambda c: c != 0))


def fit_index(rows: DataFrame, n: int, dim: int, norm: float, k: int) -> Index:
    """The index of a bounded sample, with the table's own largest norm."""
    size = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    held = rows.orderBy(F.xxhash64("id"), "id", "x").limit(size).toArrow()
    sample = np.unique(matrix(held["x"].combine_chunks(), dim), axis=0)
    return Index(sample, n, norm, k)


def postings(rows: DataFrame, index: Index, dim: int, single: bool) -> DataFrame:
    """(list, id, v): every row in each of its lists, the vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim)
            held = lists_of(index.graph, lengthened(x, index.norm))
            row = np.repeat(np.arange(len(x)), [len(h) for h in held])
            where = np.concatenate(held) if held else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), batch.column(0).take(pa.array(row)), packed(x, single).take(pa.array(row))], names=["list", "id", "v"])

    return rows.mapInArrow(lean(run), "list int, id long, v binary")


def grouped(sizes: dict[int, int], n_lists: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each list: neighbours share a group, long lists have several."""
    first, parts, group, filled = np.zeros(n_lists, np.int64), np.ones(n_lists, np.int64), 0, 0
    for name in range(n_lists):
        n = sizes.get(name, 0)
        if filled and filled + n > GROUP:
            group, filled = group + 1, 0
        first[name], parts[name] = group, max(1, -(-n // GROUP))
        if parts[name] > 1:
            group, filled = group + int(parts[name]), 0
        else:
            filled += n
    return first, parts


def readings(queries: DataFrame, index: Index, sizes: dict[int, int], first: np.ndarray, parts: np.ndarray, dim: int, single: bool, k: int) -> DataFrame:
    """(group, q_id, q_v, lists): what each query reads in each group."""
    size = np.array([sizes.get(name, 0) for name in range(len(first))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim)
            found, away = index.graph.search(asked(x, index.norm), index.beam)
            row, group, lists = [], [], []
            for at, (f, d) in enumerate(zip(found, away)):
                f, d = f[f >= 0], d[f >= 0]
                before = np.cumsum(size[f]) - size[f]  # a row is in at most REPLICAS lists, so this holds k rows and the query
                take = f[(d <= d[0] * index.ratio) | (before < REPLICAS * (k + 1))]
                if size[take].sum() < REPLICAS * (k + 1):
                    take = np.arange(len(size))
                chosen: dict[int, list[int]] = {}
                for name in take[size[take] > 0].tolist():
                    for g in range(first[name], first[name] + parts[name]):
                        chosen.setdefault(g, []).append(name)
                row += [at] * len(chosen)
                group += chosen.keys()
                lists += chosen.values()
            pick = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), batch.column(0).take(pick), packed(x, single).take(pick), pa.array(lists, pa.list_(pa.int32()))],
                                             names=["q_group", "q_id", "q_v", "q_lists"])

    return queries.mapInArrow(lean(run), "q_group int, q_id long, q_v binary, q_lists array<int>")


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per query and rank: query_id, rank (from 1), vec_id, score (inner product)."""
    spark, rows = vectors.sparkSession, usable(vectors, id_col, vector_col)
    single = rows.schema["x"].dataType.elementType.simpleString() == "float"
    square = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, dim, norm = rows.agg(F.count("*"), F.max(F.size("x")), F.sqrt(F.max(square))).first()
    dim, norm = max(1, dim or 1), norm or 1.0
    index = fit_index(rows, n, dim, norm, k)
    held = saved(postings(rows, index, dim, single))
    n_lists = len(index.graph.centres)
    sizes = dict(tuple(r) for r in held.groupBy("list").count().collect())  # one row per list: at most MAX_LISTS
    first, parts = grouped(sizes, n_lists)
    places = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, parts))], "list int, first int, parts int")
    placed = held.join(F.broadcast(places), "list").select((F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("group"), "list", "id", "v")
    asking = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("x").alias("x"))
    reads = saved(readings(asking, index, sizes, first, parts, dim, single, k))
    counts = {r["q_group"]: -(-r["count"] // QUERIES) for r in reads.groupBy("q_group").count().collect()}  # one row per group
    dealt = spark.createDataFrame([(g, n) for g, n in counts.items()] or [(-1, 1)], "d_group int, d_parts int")
    reads = reads.join(F.broadcast(dealt), F.col("q_group") == F.col("d_group")).withColumn("q_part", F.pmod(F.xxhash64("q_id"), F.col("d_parts")).cast("int")).drop("d_group", "d_parts")
    blocks = placed.join(F.broadcast(dealt), F.col("group") == F.col("d_group")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("d_parts") - 1))).drop("d_group", "d_parts")

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        q, i, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if left.num_rows and right.num_rows:
            asked_ids = right["q_id"].to_numpy()
            q, i, s = search_lists(unpacked(right["q_v"], dim, single), asked_ids, right["q_lists"].to_pylist(), unpacked(left["v"], dim, single),
                                   left["id"].to_numpy(), left["list"].to_numpy(), k)
            q = asked_ids[q]
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    found = blocks.groupBy("group", "part").cogroup(reads.groupBy("q_group", "q_part")).applyInArrow(run, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
