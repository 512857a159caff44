"""Operator 4: MinHash near-duplicates with sequential Bayesian verification.

Documents are linked if the Jaccard similarity of their sets of distinct five-word shingles
is at least 75 % (100 * shared >= 75 * union, in integers).

1. One map-only pass makes each document's set, a 128-bit fingerprint of the whole set and
   40 band keys (5 MinHash values each).  A pair at exactly 75 % misses all bands with
   probability (1 - 0.75**5)**40 = 2e-5, and a more similar one far more rarely.
2. Documents with equal sets collapse into one class (aggregation by fingerprint), so exact
   copies, however many, cost nothing further.
3. Classes that meet in a band bucket form *families* (components of bucket -> smallest
   member edges; a bucket of m members gives m - 1 edges, never its pairs).
4. Families are dealt to tasks in blocks bounded in documents and shingles.  Small families
   share a task whole.  In a large one, every block first meets the family's first block;
   after that, only the documents outside its largest component are compared with the rest.
   Nothing is capped: every banded pair whose documents are not yet connected is compared.
5. In a task, pairs sharing a band are compared 32 MinHash values at a time.  A pair is
   dropped as soon as the posterior probability (uniform prior) that its similarity reaches
   75 % falls under ``MISS``.  Survivors are verified on their whole sets.
6. The verified links' components go back to all documents of each class, with the component's
   smallest doc_id.

Cases: documents without words or text have an empty set and stand alone; fewer than five
words are one shingle; each input row is judged by its own text, also if rows repeat a doc_id,
and gives one output row; a null doc_id takes its component's if a member has an id, else null.
Other columns are ignored.  Equal 64-bit shingle hashes count as equal shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean, saved, slices, small
from .components import connected_components
from .shingles import WIDTH, mix, shingle_sets

THRESHOLD = 75  # percent
ROWS, BANDS, BATCH = 5, 40, 40  # MinHash values per band, bands, values compared at a time
MISS = 1e-6  # posterior probability of reaching the threshold, under which a pair is dropped
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1_000_000
PAIRS = 20_000  # compared in one numpy call
SMALL_TABLE = 1_000_000  # rows of two or three numbers that may be broadcast


def signatures(sets: list[np.ndarray], values: int = ROWS * BANDS) -> np.ndarray:
    """MinHash values (uint32) of non-empty sets: the least of (a * x + b) mod 2**32 over each set."""
    seeds = mix(np.arange(1, values + 1, dtype=np.uint64))
    a, b = seeds.astype(np.uint32) | np.uint32(1), (seeds >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), values), np.uint32)
    for part in slices([len(s) for s in sets], 1 << 16):
        x = (np.concatenate(sets[part]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[part]][:-1])
        y = np.empty_like(x)
        for k in range(values):
            np.multiply(x, a[k], out=y)
            np.add(y, b[k], out=y)
            out[part, k] = np.minimum.reduceat(y, starts)
    return out


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bands = sig.shape[1] // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, k::rows][:, :bands])
    return key.view(np.int64)


def least_matches(threshold: int = THRESHOLD, miss: float = MISS, values: int = ROWS * BANDS, batch: int = BATCH) -> dict[int, int]:
    """For each number n of compared values: the fewest matches m with P(similarity >= t | m of n) >= miss.

    Under a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail at t
    is the probability that a Binomial(n + 1, t) is at most m.
    """
    t, out = threshold / 100, {}
    for n in range(batch, values + 1, batch):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                out[n] = m
                break
    return out


def surviving_pairs(sig: np.ndarray, left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, ...]:
    """Pairs that no batch of signature values rules out, and their matches."""
    kept = []
    for at in range(0, len(left), PAIRS):
        i, j = left[at:at + PAIRS], right[at:at + PAIRS]
        hits, done = np.zeros(len(i), np.int64), 0
        for n, fewest in least.items():
            hits = hits + (sig[i, done:n] == sig[j, done:n]).sum(axis=1)
            alive, done = hits >= fewest, n
            i, j, hits = i[alive], j[alive], hits[alive]
        kept.append((i, j, hits))
    return tuple(map(np.concatenate, zip(*kept))) if kept else (left, right, left)


def similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """The exact test on two sorted sets."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    spot = np.searchsorted(b, a)
    spot[spot == len(b)] = 0
    shared = int((b[spot] == a).sum())
    return 100 * shared >= threshold * (len(a) + len(b) - shared)


def family_links(nodes: list, groups: list, sets: list[np.ndarray], threshold: int = THRESHOLD) -> list[tuple]:
    """Links that join the nodes' groups: (node, smallest node joined with it).

    Banded pairs of different groups go through the sequential test, then the exact one,
    the most similar first; a pair that earlier links connect already needs no test.
    """
    sig = signatures(sets)
    keys = band_keys(sig)
    _, group = np.unique(np.array(groups), return_inverse=True)
    pairs: list[np.ndarray] = []
    for i in range(len(nodes) - 1):
        meet = (keys[i + 1:] == keys[i]).any(axis=1) & (group[i + 1:] != group[i])
        j = np.flatnonzero(meet) + i + 1
        pairs.append(np.stack([np.full(len(j), i), j]))
    both = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    i, j, hits = surviving_pairs(sig, both[0], both[1], least_matches(threshold))
    parent = list(range(len(group)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in np.argsort(-hits, kind="stable"):
        x, y = root(group[i[k]]), root(group[j[k]])
        if x != y and similar(sets[i[k]], sets[j[k]], threshold):
            parent[x] = y
    joined: dict[int, list] = {}
    for n, g in zip(nodes, group):
        joined.setdefault(root(g), []).append(n)
    return [(n, min(members)) for members in joined.values() for n in members if n != min(members)]


def text_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def same_row(left: DataFrame, id_col: str, text_col: str, right: DataFrame) -> Column:
    """Null-safe equality of (id, hash of the text) with the columns rid and rhash of another frame."""
    return left[id_col].eqNullSafe(right["rid"]) & text_hash(left[text_col]).eqNullSafe(right["rhash"])


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n_shingles, fp, bands, hash of the text) of every document row; fp and bands are null for empty sets."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            n, fps, bands = [], [], []
            for part in slices([len(t or b"") for t in texts]):
                sets = shingle_sets(texts[part], width)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(full)) if full else ())
                n += map(len, sets)
                fps += [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                bands += [next(keys) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(fps, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64())), batch.column(2)], names=["id", "n", "fp", "bands", "hash"])

    return src.mapInArrow(lean(run), f"id {src.schema['id'].dataType.simpleString()}, n long, fp binary, bands array<bigint>, hash binary")


def verified(members: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, threshold: int) -> DataFrame:
    """Links (u, v) found in the groups (a, b) of members (node, family, comp, a, b); docs has the texts of the classes' first rows."""
    plan = members.join(classes.select("node", "least.rid", "least.rhash"), "node")
    plan = F.broadcast(plan) if small(members, SMALL_TABLE) else plan
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    once = rows.where("id is null").withColumn("hash", text_hash(F.col("text"))).dropDuplicates(["hash"]).drop("hash")
    rows = rows.where("id is not null").union(once)
    texts = rows.join(plan, same_row(rows, "id", "text", plan)).drop("id", "rid", "rhash")

    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_pylist() for c in ("node", "family", "comp")}
        raw = table.column("text").cast(pa.binary()).to_pylist()
        by_family: dict = {}
        for k, f in enumerate(cols["family"]):
            by_family.setdefault(f, {})[cols["node"][k]] = k  # rows that repeat id and text count once
        links = []
        for rows in by_family.values():
            nodes = sorted(rows)
            sets = []
            for part in slices([len(raw[rows[n]] or b"") for n in nodes]):
                sets += shingle_sets([raw[rows[n]] for n in nodes[part]], width)
            links += family_links(nodes, [cols["comp"][rows[n]] for n in nodes], sets, threshold)
        del by_family, raw, cols
        give_back()
        u, v = zip(*links) if links else ((), ())
        return pa.table({"u": pa.array(u, table.schema.field("node").type), "v": pa.array(v, table.schema.field("node").type)})

    kind = members.schema["node"].dataType.simpleString()
    return saved(texts.groupBy("a", "b").applyInArrow(run, f"u {kind}, v {kind}"))


def link_families(members: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, threshold: int,
                  block_docs: int, block_shingles: int) -> DataFrame:
    """Verified links inside the families of members (node, n, family)."""
    sizes = members.groupBy("family").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles")).select(
        "family", F.ceil(F.greatest(F.col("docs") / block_docs, F.col("shingles") / block_shingles)).cast("int").alias("blocks"))
    placed = saved(members.join(sizes, "family").withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)")))
    total, shingles = placed.where("blocks = 1").agg(F.count("*"), F.sum("n")).first()
    bins = max(1, total // block_docs, (shingles or 0) // block_shingles)
    whole = placed.where("blocks = 1").select("node", "family", F.col("node").alias("comp"), F.lit(None).cast(members.schema["node"].dataType).alias("a"),
                                              F.pmod(F.xxhash64("family"), F.lit(bins)).alias("b"))
    large = placed.where("blocks > 1")
    first = large.select("node", "family", F.col("node").alias("comp"), F.col("family").alias("a"),
                         F.explode(F.expr("if(block = 0, sequence(0L, blocks - 1L), array(bigint(block)))")).alias("b"))
    links = verified(saved(whole.union(first)), classes, docs, id_col, text_col, width, threshold)
    if large.isEmpty():
        return links
    comps = connected_components(links, "u", "v")
    large = saved(large.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component"))
    by_comp = large.groupBy("family", "comp").agg(F.count("*").alias("k"))
    main = by_comp.groupBy("family").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("all"), F.max("k").alias("most"))
    rest = main.where("all > most").select("family", "main", F.ceil((F.col("all") - F.col("most")) / block_docs).cast("int").alias("rest_blocks"))
    open_ = large.join(rest, "family").withColumn("rest_block", F.expr("cast(pmod(xxhash64(comp, node), rest_blocks) as int)"))
    each = open_.select("node", "family", "comp", "blocks", "block", F.explode(F.expr("sequence(0, rest_blocks - 1)")).alias("r"))
    outside = open_.where("comp <> main").select("node", "family", "comp", "blocks", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                                                 F.col("rest_block").alias("r"))
    pairs = each.unionByName(outside).select("node", "family", "comp", F.col("family").alias("a"), (F.col("r") * F.col("blocks") + F.col("block")).cast("long").alias("b"))
    return links.union(verified(saved(pairs), classes, docs, id_col, text_col, width, threshold))


def judged(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH, threshold: int = THRESHOLD,
           block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, n, hash, least, unnamed) of every document row.

    least is its component's first row (no_id, rid, rhash) by id and hash, unnamed the least hash
    of its rows with a null id; null for empty sets.
    """
    base = saved(sketch(docs, id_col, text_col, width))
    row = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("rid"), F.col("hash").alias("rhash"))
    classes = saved(base.where("fp is not null").groupBy("fp").agg(F.min(row).alias("least"), F.min(F.when(F.col("id").isNull(), F.col("hash"))).alias("unnamed"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    classes = classes.withColumn("node", F.monotonically_increasing_id())  # of stored rows, so always the same
    entries = classes.select("node", F.explode("bands").alias("key"))
    buckets = saved(entries.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").drop("last"))
    met = entries.join(F.broadcast(buckets) if small(buckets, SMALL_TABLE) else buckets, "key").where("node <> hub")
    families = connected_components(met, "hub", "node").select("node", F.col("component").alias("family"))
    members = families.join(classes.select("node", "n"), "node")
    links = link_families(members, classes, docs, id_col, text_col, width, threshold, block_docs, block_shingles)
    comps = connected_components(links, "u", "v")
    firsts = saved(comps.join(classes.select("node", "least", "unnamed"), "node").groupBy("component").agg(
        F.min("least").alias("all_least"), F.min("unnamed").alias("all_unnamed")))
    firsts = F.broadcast(firsts) if small(firsts, SMALL_TABLE) else firsts
    by_fp = classes.select("fp", "node", "least", "unnamed").join(comps.join(firsts, "component"), "node", "left").select(
        "fp", F.coalesce("all_least", "least").alias("least"), F.coalesce("all_unnamed", "unnamed").alias("unnamed"))
    return base.join(by_fp, "fp", "left").select("id", "n", "hash", "least", "unnamed")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document row: id, n_shingles, component_id, kept (id = component_id)."""
    return judged(docs, id_col, text_col, **options).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least.rid")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The kept documents, all columns unchanged: of each component one row of the smallest id.

    Rows whose id is null can't be named as kept; one of them stays in each component, too.  Of rows that
    repeat both id and text one stays; documents without words stay, with a null id all.
    """
    rows = judged(docs, id_col, text_col, **options).select(F.col("id").alias("rid"), F.col("hash").alias("rhash"), "n", "least", "unnamed")
    first = F.when(F.col("rid").isNull(), F.col("unnamed")).when(F.col("rid") == F.col("least.rid"), F.col("least.rhash"))
    kept = (F.col("n") == 0) | F.coalesce(F.col("rhash") == first, F.lit(False))
    seen = saved(rows.groupBy("rid", "rhash").agg(F.first(kept).alias("kept"), F.count("*").alias("n_rows"), F.max("n").alias("n"))
                 .where("not kept or n_rows > 1 and (n > 0 or rid is not null)"))
    few = lambda t: F.broadcast(t) if small(t, SMALL_TABLE) else t
    gone = few(seen.where("not kept").select("rid", "rhash"))
    rest = docs.join(gone, same_row(docs, id_col, text_col, gone), "left_anti")
    repeated = seen.where("kept").select("rid", "rhash")
    if repeated.isEmpty():
        return rest
    repeated = few(repeated)
    once = rest.join(repeated, same_row(rest, id_col, text_col, repeated), "left_semi").withColumn("__hash", text_hash(F.col(text_col))).dropDuplicates([id_col, "__hash"])
    return rest.join(repeated, same_row(rest, id_col, text_col, repeated), "left_anti").union(once.select(docs.columns))


ORACLE_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w WHERE w IS NOT NULL),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 75 * (a.n + b.n - k)),
r AS (SELECT doc_id AS u, doc_id AS c FROM n UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.u WHERE r.c < e.v),
c AS (SELECT u, min(c) AS c FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.c, d.doc_id) AS component_id, coalesce(c.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.u = d.doc_id
"""
