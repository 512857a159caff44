"""Operator 5: benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by a test item if it holds at least ``threshold`` (75 %) of the
item's distinct five-word shingles, wherever they stand in the document.

Plain MinHash similarity says nothing about a 40-shingle item in a 20,000-shingle document,
so the search measures containment: the item's *bottom-k MinHash sketch* (its k smallest
shingle hashes) is looked up in the document's shingle set.  The items are partitioned by
size (powers of two), and within a partition each item takes k = n - ceil(threshold * n) + 1
of its n shingles: a document that holds ceil(threshold * n) of them misses at most k - 1, so
at least one sketch hash is found and no contaminated document is lost.  Documents
too small to hold the smallest item of a partition skip the partition.
Candidates are verified by exact containment of the whole shingle sets.

The items are taken in blocks of a bounded number of shingles (a stated query set against
all rows).  One block goes to the executors as sorted arrays, and documents pass through
map-only, so no document row is shuffled, however many documents share a passage.

Cases: items and documents without words match nothing; a text of fewer than five words has
its whole sequence as its one shingle; a repeated item id is matched once per distinct text
(best match kept); repeated documents each give their rows.  Null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import as_bytes, lean, slices
from .shingles import WIDTH, shingle_sets

THRESHOLD = 75  # percent
BLOCK_SHINGLES = 2_000_000  # of benchmark items sent to the executors at once


def sketch_size(n: int, threshold: int) -> int:
    """Hashes of an n-shingle item of which a contaminated document must hold one."""
    return n - needed(n, threshold) + 1


def needed(n: int, threshold: int) -> int:
    return -(-threshold * n // 100)


class ItemIndex:
    """A block of items: full shingle sets, and per size partition the sorted sketch hashes with their items."""

    def __init__(self, sets: list[np.ndarray], threshold: int):
        self.sets, self.partitions = sets, []
        classes: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if len(s):
                classes.setdefault(len(s).bit_length(), []).append(i)
        for members in classes.values():
            sketches = [sets[i][: sketch_size(len(sets[i]), threshold)] for i in members]
            owner = np.repeat(members, [len(s) for s in sketches])
            hashes = np.concatenate(sketches)
            order = np.argsort(hashes, kind="stable")
            least = min(needed(len(sets[i]), threshold) for i in members)
            self.partitions.append((least, hashes[order], owner[order]))

    def candidates(self, doc: np.ndarray) -> set[int]:
        """Items of which the document's sorted shingle set holds a sketch hash."""
        found: set[int] = set()
        for least, hashes, owner in self.partitions:
            if len(doc) >= least:
                spot = np.searchsorted(doc, hashes)
                spot[spot == len(doc)] = 0
                found.update(owner[doc[spot] == hashes].tolist())
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_shingles: int) -> list[DataFrame]:
    """The items dealt by hash into blocks of at most about ``block_shingles`` words."""
    rows = items.select(F.col(id_col).alias("item"), as_bytes(text_col).alias("text")).where("text is not null").distinct()
    words = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # a word takes two bytes at least, with its space
    n = max(1, -(-words // (2 * block_shingles)))
    return [rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i) for i in range(n)] if n > 1 else [rows]


def shared_blocks(items: DataFrame, id_col: str, text_col: str, block_shingles: int, width: int) -> Iterator:
    """Each block as a broadcast (names, shingle sets)."""
    for block in item_blocks(items, id_col, text_col, block_shingles):
        held = block.collect()  # at most block_shingles words of benchmark text
        sets = shingle_sets([bytes(r["text"]) for r in held], width)
        yield items.sparkSession.sparkContext.broadcast(([r["item"] for r in held], sets))


def matches(texts: pa.Array, names: list, index: ItemIndex, threshold: int, width: int) -> Iterator[tuple]:
    """(row, item, n_item, n_shared) of every item that a text of the batch holds, verified on whole sets."""
    raw = texts.cast(pa.binary()).to_pylist()
    for part in slices([len(t or b"") for t in raw]):
        for row, doc in zip(range(part.start, part.stop), shingle_sets(raw[part], width)):
            best: dict = {}
            for i in index.candidates(doc):
                n, hit = len(index.sets[i]), int(np.isin(index.sets[i], doc, assume_unique=True).sum())
                if 100 * hit >= threshold * n and (names[i] not in best or hit * best[names[i]][0] > best[names[i]][1] * n):
                    best[names[i]] = (n, hit)
            for name in sorted(best, key=str):
                yield (row, name, *best[name])


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", threshold: int = THRESHOLD,
               width: int = WIDTH, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document row and item it holds: ids, n_item (shingles of the item), n_shared."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (f"id {src.schema['id'].dataType.simpleString()}, item {items.schema[item_id_col].dataType.simpleString()}, "
              "n_item long, n_shared long")
    item_type = to_arrow_type(items.schema[item_id_col].dataType)

    def searcher(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, sets = shared.value
            index = ItemIndex(sets, threshold)
            for batch in batches:
                found = list(matches(batch.column(1), names, index, threshold, width))
                rows, hit_items, n_item, n_shared = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(hit_items, item_type),
                     pa.array(n_item, pa.int64()), pa.array(n_shared, pa.int64())], names=["id", "item", "n_item", "n_shared"])

        return run

    parts = [src.mapInArrow(lean(searcher(s)), schema) for s in shared_blocks(items, item_id_col, item_text_col, block_shingles, width)]
    out = reduce(DataFrame.union, parts)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_id_col), "n_item", "n_shared")


def remove_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", threshold: int = THRESHOLD, width: int = WIDTH,
                 block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that hold no item, all columns unchanged; one map-only pass per block of items."""
    at = docs.columns.index(text_col)

    def cleaner(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, sets = shared.value
            index = ItemIndex(sets, threshold)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[m[0] for m in matches(batch.column(at), names, index, threshold, width)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for shared in shared_blocks(items, item_id_col, item_text_col, block_shingles, width):
        docs = docs.mapInArrow(lean(cleaner(shared)), docs.schema)
    return docs


ORACLE_SQL = """
WITH w AS (SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
    UNION ALL SELECT 'i', item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') FROM benchmark),
s AS (SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
i AS (SELECT id, g, count(*) OVER (PARTITION BY id) AS n FROM s WHERE kind = 'i')
SELECT d.id AS doc_id, i.id AS item_id, max(i.n) AS n_item, count(*) AS n_shared
FROM s d JOIN i ON i.g = d.g WHERE d.kind = 'd' GROUP BY d.id, i.id HAVING 100 * count(*) >= 75 * max(i.n)
"""
