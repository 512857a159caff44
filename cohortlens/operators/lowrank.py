"""Principal components of sparse, implicitly centred rows: randomised subspace iteration.

The input is long: one row per non-zero (row, feature, value).  A standardised row is
(x - mean) / deviation; the shift by the mean would make it dense, so it is never applied to the
data: it enters every product as one number per column of the basis.  Neither a dense vector of
all features nor a feature x feature matrix is built, so the vocabulary may be large.

The entries are shuffled once: blocks of rows, about a million entries each, become one row of arrays
(a pack) in a bucketed table of the warehouse that is dropped at the end.  A basis Q has one row per feature and
``k + oversample`` columns and is a DataFrame like the rest.  In a round a pack gets the basis rows of its own
features, forms Z = X Q and sends its part of Y = X'Z: one row per (pack, feature) travels each way, whatever
the number of rows and entries, and Z never leaves its pack.  Only the small Gram matrices of the columns reach the driver,
for the QR step (by eigenvalues, as Y may lack rank) and the Rayleigh-Ritz values.  Rounds end when the first k of those no longer change.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from ..session import ensure_checkpoint_dir


@dataclass
class SparsePca:
    """(row, ``pca`` vector) of every row, (feature, ``loadings``) of every feature, the components' variances and rounds taken."""

    projected: DataFrame
    components: DataFrame
    variances: np.ndarray
    rounds: int


def _names(n: int, prefix: str = "c") -> list[str]:
    return [f"{prefix}{j}" for j in range(n)]


def _columns(batch: pa.RecordBatch, skip: int = 0) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[skip:]])


def gram(df: DataFrame, names: list[str], matrix: np.ndarray | None = None) -> np.ndarray:
    """Inner products of the columns (or of them times a matrix): summed per task in numpy, then by
    Spark; len(names) squared numbers are collected."""
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            x = _columns(batch)
            x = x if matrix is None else x @ matrix
            total += x.T @ x
        i, j = np.divmod(np.arange(n * n), n)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.reshape(-1))], names=["i", "j", "g"])

    out = np.zeros((n, n))
    for i, j, g in df.select(names).mapInArrow(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g")).collect():
        out[i, j] = g
    return (out + out.T) / 2


def times(df: DataFrame, keys: list[str], names: list[str], matrix: np.ndarray) -> DataFrame:
    """The keys and c0, c1, ...: the columns times a small matrix."""
    out = _names(matrix.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _columns(batch, len(keys)) @ matrix
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], *[pa.array(np.ascontiguousarray(c)) for c in y.T]], names=[*keys, *out])

    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for c in keys]
    return df.select(*keys, *names).mapInArrow(run, ", ".join(kinds + [f"{c} double" for c in out]))


def _orthonormal(g: np.ndarray) -> np.ndarray:
    """M such that Y M has orthonormal columns, for G = Y'Y; directions without extent are left out."""
    values, vectors = np.linalg.eigh(g)
    keep = values > 1e-12 * max(float(values.max(initial=0)), 1e-300)
    return vectors[:, keep] / np.sqrt(values[keep])


PACK_ENTRIES = 1_000_000  # wanted in one pack
PACK_ARRAYS = {"row_n": np.int32, "row_place": np.int32, "row_x": np.float64, "col_n": np.int32, "col_place": np.int32, "col_x": np.float64}
PIECE = 1 << 15  # entries that are multiplied at a time
BROADCAST_BYTES = 32 << 20  # of a basis


def _by_length(segment: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segments from short to long, their lengths, the entries in that order) of entries with a segment each."""
    lengths = np.bincount(segment, minlength=n)
    order = np.argsort(lengths, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return order, lengths[order], np.argsort(rank[segment], kind="stable")


def _packed(table: pa.Table, block: int) -> pa.RecordBatch:
    """Entries sorted by row as one row of arrays: by row and again by feature, each from short to long."""
    r, f, x = (table.column(c).combine_chunks() for c in ("r", "f", "x"))
    starts = np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(r[1:], r[:-1]).to_numpy(zero_copy_only=False))])
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(r))))
    codes, x = f.dictionary_encode(), x.to_numpy()
    column = codes.indices.to_numpy()
    rows, row_n, by_row = _by_length(row, len(starts))
    columns, col_n, by_column = _by_length(column, len(codes.dictionary))
    row_at, column_at = np.argsort(rows), np.argsort(columns)
    arrays = (row_n, column_at[column[by_row]], x[by_row], col_n, row_at[row[by_column]], x[by_column])
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (r.take(pa.array(starts[rows])), codes.dictionary.take(pa.array(columns)))]
    blobs = [pa.array([a.astype(kind).tobytes()], pa.binary()) for a, kind in zip(arrays, PACK_ARRAYS.values())]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists, *blobs], names=["block", "r", "f", *PACK_ARRAYS])


def _pack(size: int):
    """Packs of whole rows from a partition's entries, which are sorted by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, limit, block = [], 0, size, TaskContext.get().partitionId() << 32
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < limit:
                continue
            table = pa.Table.from_batches(held)
            r = table.column("r").combine_chunks()
            ends = np.flatnonzero(pc.not_equal(r[1:], r[:-1]).to_numpy(zero_copy_only=False))
            held = [pa.RecordBatch.from_arrays([c.combine_chunks() for c in table.columns], names=table.column_names)]
            if len(ends):
                yield _packed(table.slice(0, ends[-1] + 1), block)
                block, held = block + 1, [held[0].slice(ends[-1] + 1)]
            n = len(held[0])
            limit = max(size, 2 * n) if n >= size else size
        if n:
            yield _packed(pa.Table.from_batches(held), block)
    return run


def packed_entries(t: DataFrame, table: str, size: int = PACK_ENTRIES) -> int:
    """Writes the entries (r, f, x) as ``table`` in the warehouse, a row of arrays per block of rows; the number of packs."""
    spark = t.sparkSession
    kinds = {c: t.schema[c].dataType.simpleString() for c in ("r", "f")}
    schema = ", ".join(["block long", *[f"{c} array<{k}>" for c, k in kinds.items()], *[f"{c} binary" for c in PACK_ARRAYS]])
    ensure_checkpoint_dir(spark)
    packs = t.select("r", "f", "x").repartition("r").sortWithinPartitions("r").mapInArrow(_pack(size), schema).checkpoint(eager=True)
    n = packs.count()
    if n:
        buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n)
        packs.repartition(buckets, "block").write.format("parquet").bucketBy(buckets, "block").sortBy("block").saveAsTable(table)
    return n


def _unpacked(stored: pa.Table) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(stored.column(c)[0].as_py(), kind) for c, kind in PACK_ARRAYS.items() if c in stored.column_names}


def _sums(lengths: np.ndarray, place: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sums of x * m[place] by segment, for segments in order of length: those of a length are one stacked product."""
    out = np.zeros((len(lengths), m.shape[1]))
    kinds, first = np.unique(lengths, return_index=True)
    at = 0
    for d, a, b in zip(kinds.tolist(), first.tolist(), [*first[1:].tolist(), len(lengths)]):
        step = max(1, PIECE // d)
        for s in range(a, b, step):
            e = min(s + step, b)
            end = at + (e - s) * d
            if d > PIECE:
                out[s] = sum(x[i:min(i + PIECE, end)] @ m[place[i:min(i + PIECE, end)]] for i in range(at, end, PIECE))
            else:
                out[s:e] = np.matmul(x[at:end].reshape(e - s, 1, d), m[place[at:end]].reshape(e - s, d, -1))[:, 0]
            at = end
    return out


def _sent(stored: pa.Table, sent: pa.Table, names: list[str]) -> np.ndarray:
    """The basis rows of a pack's features, in its order."""
    m = np.zeros((len(stored.column("f")[0]), len(names)))
    m[sent.column("place").to_numpy()] = np.column_stack([sent.column(c).to_numpy() for c in names])
    return m


def _rows_of(values: pa.Array, matrix: np.ndarray, key: str, names: list[str]) -> pa.Table:
    return pa.table([values, *[pa.array(np.ascontiguousarray(c)) for c in matrix.T]], names=[key, *names])


def _met(packs: DataFrame, basis: DataFrame, names: list[str], features: int, run, schema: str):
    """The packs with the scaled basis rows of their features; the packs are not shuffled."""
    rows = basis.select("f", *[(F.col(c) * F.col("scale")).alias(c) for c in names])
    rows = F.broadcast(rows) if features * len(names) * 8 <= BROADCAST_BYTES else rows
    asked = packs.select(F.col("block").alias("pack"), F.posexplode("f").alias("place", "f")).join(rows, "f").drop("f")
    return packs.groupBy("block").cogroup(asked.groupBy("pack")).applyInArrow(run, schema)


def _round(packs: DataFrame, basis: DataFrame, names: list[str], features: int, out: list[str]) -> DataFrame:
    """(f, out): X'X times the basis, both of standardised but not centred entries."""
    def run(stored: pa.Table, sent: pa.Table) -> pa.Table:
        p = _unpacked(stored)
        z = _sums(p["row_n"], p["row_place"], p["row_x"], _sent(stored, sent, names))
        return _rows_of(stored.column("f")[0].values, _sums(p["col_n"], p["col_place"], p["col_x"], z), "f", out)
    schema = ", ".join([f"f {basis.schema['f'].dataType.simpleString()}", *[f"{c} double" for c in out]])
    parts = _met(packs, basis, names, features, run, schema)
    return parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in out])


def _project(packs: DataFrame, basis: DataFrame, names: list[str], features: int) -> DataFrame:
    """(r, names): X times the basis, of standardised but not centred entries."""
    def run(stored: pa.Table, sent: pa.Table) -> pa.Table:
        p = _unpacked(stored)
        return _rows_of(stored.column("r")[0].values, _sums(p["row_n"], p["row_place"], p["row_x"], _sent(stored, sent, names)), "r", names)
    kind = packs.schema["r"].dataType.elementType.simpleString()
    return _met(packs, basis, names, features, run, ", ".join([f"r {kind}", *[f"{c} double" for c in names]]))


def feature_scales(packs: DataFrame) -> tuple[DataFrame, int]:
    """(f, scale = 1 / deviation, shift = mean / deviation) and the number of rows.

    Means and sample deviations are over all rows, absent entries being zero; a constant feature gets scale 0.
    """
    def run(stored: pa.Table) -> pa.Table:
        p = _unpacked(stored)
        n, starts = p["col_n"], np.cumsum(p["col_n"], dtype=np.int64) - p["col_n"]
        mean = np.add.reduceat(p["col_x"], starts) / n
        spread = np.add.reduceat((p["col_x"] - np.repeat(mean, n)) ** 2, starts)
        return pa.table([stored.column("f")[0].values, pa.array(n.astype(np.int64)), pa.array(mean), pa.array(spread)], names=["f", "n", "a", "s"])

    n = packs.agg(F.sum(F.size("r"))).first()[0]
    kind = packs.schema["f"].dataType.elementType.simpleString()
    parts = packs.select("block", "f", "col_n", "col_x").groupBy("block").applyInArrow(run, f"f {kind}, n long, a double, s double").checkpoint(eager=True)
    whole = parts.groupBy("f").agg(F.sum("n").alias("m"), (F.sum(F.col("n") * F.col("a")) / F.sum("n")).alias("b"))
    apart = F.col("a") - F.col("b")
    per = parts.join(whole, "f").groupBy("f", "m", "b").agg(F.sum(F.col("s") + F.col("n") * apart * apart).alias("s"))
    mean = F.col("m") * F.col("b") / n
    squares = F.col("s") + F.col("m") * (F.col("b") - mean) * (F.col("b") - mean) + (n - F.col("m")) * mean * mean
    deviation = F.sqrt(squares / max(n - 1, 1))
    scale = F.when(deviation > 1e-12 * F.abs("b"), 1.0 / deviation).otherwise(0.0)
    return per.select("f", (mean * scale).alias("shift"), scale.alias("scale")).checkpoint(eager=True), n


def sparse_pca(tuples: DataFrame, k: int = 10, row: str = "patient_id", feature: str = "feature_name", value: str = "feature_value",
               oversample: int = 10, max_rounds: int = 30, tol: float = 1e-3) -> SparsePca:
    """The first k principal components of standardised features, from long (row, feature, value).

    One value per (row, feature) is expected.  ``pca`` has min(k, rank) components; each component's largest
    loading is positive.  The start is a hash of the feature's name, so runs agree.
    All rounds run inside this call, with as many shuffle partitions as the table has buckets; the setting is put back after it.
    """
    spark = tuples.sparkSession
    t = tuples.select(F.col(row).alias("r"), F.col(feature).alias("f"), F.col(value).cast("double").alias("x")).where("r is not null and f is not null and x is not null")
    table, partitions = f"pca_entries_{uuid.uuid4().hex}", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n_packs = packed_entries(t, table)
        if not n_packs:
            empty = F.array().cast("array<double>")
            none = spark.createDataFrame([], t.schema)
            return SparsePca(none.select(F.col("r").alias(row), array_to_vector(empty).alias("pca")),
                             none.select(F.col("f").alias(feature), empty.alias("loadings")), np.zeros(0), 0)
        spark.conf.set("spark.sql.shuffle.partitions", min(int(partitions), n_packs))
        projected, turned, variances, turn = _components(spark.table(table), k, oversample, max_rounds, tol)
        return SparsePca(projected.withColumnRenamed("r", row), turned.withColumnRenamed("f", feature), variances, turn)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _components(packs: DataFrame, k: int, oversample: int, max_rounds: int, tol: float) -> tuple[DataFrame, DataFrame, np.ndarray, int]:
    """(r, pca), (f, loadings), variances and rounds; nothing of it reads the packs any more."""
    scales, n = feature_scales(packs)
    features, keys = scales.count(), ["f", "shift", "scale"]
    names = _names(k + oversample)
    start = scales.select(*keys, *[(hash_unit("f", c) - 0.5).alias(c) for c in names]).checkpoint(eager=True)
    g = gram(start, ["shift", *names])
    turned = _orthonormal(g[1:, 1:])
    basis, offset = times(start, keys, names, turned), g[0, 1:] @ turned
    before, turn = None, 0
    while True:
        names = basis.columns[3:]
        ahead, m = [f"y{j}" for j in range(len(names))], len(names)
        y = _round(packs, basis, names, features, ahead)  # still to be scaled, and lessened by the offset
        both = basis.join(y, "f").select(*keys, *names, *[(F.col(c) * F.col("scale")).alias(c) for c in ahead]).checkpoint(eager=True)
        lessen = np.eye(1 + 2 * m)  # a feature's entries sum to n * shift: the offset's part of y
        lessen[0, 1 + m:] = -n * offset
        g = gram(both, ["shift", *names, *ahead], lessen)
        cross, squared = g[1:m + 1, m + 1:], g[m + 1:, m + 1:]
        values, vectors = np.linalg.eigh((cross + cross.T) / 2)
        first = np.argsort(-values, kind="stable")[:k]
        ritz, turn = values[first], turn + 1
        turned = _orthonormal(squared)
        if turn >= max_rounds or not turned.shape[1] or before is not None and len(ritz) == len(before) and np.abs(ritz - before).max(initial=0) <= tol * max(float(ritz.max(initial=0)), 1e-300):
            break
        before, last = ritz, offset
        basis, offset = times(both, keys, ["shift", *ahead], np.vstack([-n * last @ turned, turned])), g[0, m + 1:] @ turned
    first = first[values[first] > 1e-9 * max(float(values.max(initial=0)), 1e-300)]
    turned = times(both, keys, names, vectors[:, first]).checkpoint(eager=True)
    kept = turned.columns[3:]
    ends = turned.agg(*[F.max_by(F.col(c), F.struct(F.abs(F.round(F.col(c), 9)), F.col("f"))) for c in kept]).first() if kept else ()
    signs = np.sign([e or 1.0 for e in ends])
    if kept:
        less = offset @ (vectors[:, first] * signs)
        projected = _project(packs, turned, kept, features)
        projected = projected.select("r", array_to_vector(F.array(*[F.col(c) * float(s) - F.lit(float(o)) for c, s, o in zip(kept, signs, less)])).alias("pca"))
    else:
        projected = packs.select(F.explode("r").alias("r"), array_to_vector(F.array().cast("array<double>")).alias("pca"))
    loadings = turned.select("f", F.array(*[F.col(c) * float(s) for c, s in zip(kept, signs)]).cast("array<double>").alias("loadings"))
    return projected.checkpoint(eager=True), loadings, values[first] / max(n - 1, 1), turn
