"""Operator 10: toxicity by class-conditional Kneser-Ney models.

Expressions are words (runs of ASCII letters and digits and of all other-than-ASCII bytes,
A-Z lower-cased), modelled byte by byte with contexts of six bytes from the word's start.

* A class c (toxic, ordinary) has its own seven-byte counts from the labelled training rows:
  P_c(g) = (max(n_c(g) - D, 0) + D * T_c(ctx) * P(g')) / n_c(ctx), T_c the distinct successors.
* Both back off to one shared distribution P(g'): the Kneser-Ney continuation counts (distinct
  left neighbours) of six-byte grams over *all* documents, interpolated with the
  continuation unigram.  What neither class has seen thus counts for neither.
* An expression's log-likelihood ratio is divided by a power of its length, and a document
  has three features: its strongest expression, the sum of the ``TOP`` strongest, and the mean
  over all.  A logistic
  regression turns them into a score.  It is fitted on training rows scored by models
  that have not seen them: each half of the training rows scores the other half.

One pass over the documents makes *packs*: a small amount of text as its distinct words and the
rows' words as numbers into them.  The packs of a task form *families*, each with a bounded number of
distinct grams and their training counts.  Counts come from the families with one shuffle by gram.
The ratios stay a distributed table by gram, exact and as large as the corpus asks.  Each family's
grams are joined with it (a gram has one row per family, so no gram is hot), come back to their
family and score its rows pack by pack.

Cases: null and empty texts have features 0 and a score like any other; a document without
label, with a null label or a null id trains nothing; of several labels of an id the largest
counts; without both classes in the training rows every score is the training share of
toxic rows (0.5 without rows); repeated rows are scored (and counted) each.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean, saved, slices, small

ORDER = 7  # bytes of a gram
DISCOUNT = 0.75
LENGTH_POWER = 0.5
TOP = 5
FEATURES = ("strongest", "top", "mean")
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1  # crc32 of the id as text; this remainder never trains
SMALL_TABLE = 1_000_000
HELD_WORDS, FAMILY_GRAMS, EMITTED_ROWS = 50_000, 2_000_000, 50_000  # in a task: words counted together, grams that close a family; rows of an output batch
PACK_BYTES, ROW_BYTES = 1 << 23, 100  # text of a pack; counted for a row besides its text
TASK_BYTES = 192 << 20  # text that one task packs, if the input's partitions are smaller
MODELS = ("all", "f0", "f2")  # trained on all training rows, or on one remainder only
LETTERS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
SUMS = ["t0", "o0", "t2", "o2"]  # toxic and ordinary counts by remainder
BLOBS = ["words", "lengths", "codes", "times"]  # of a pack, compressed
COUNTED = ["grams", "sums"]  # of a family, compressed
CROSSED = tuple(f"cross_{f}" for f in FEATURES)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(LETTERS).split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the words (padded by spaces, one after) as integers, and their word's number."""
    lead = ORDER - 1
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    joined = np.frombuffer(b"".join([b" " * lead + w + b" " for w in words]), np.uint8).astype(np.int64)
    rolled = np.zeros(max(0, len(joined) - lead), np.int64)
    for k in range(ORDER):
        rolled = (rolled << 8) | joined[k:len(joined) - lead + k]
    own = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths + lead) - lengths - lead
    within = np.arange(len(own)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return rolled[within + starts[own]], own


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """The documents (id, text) with columns held_out and group: 0..3 (toxic, ordinary by remainder) or null."""
    marks = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic")).where("__id is not null and __toxic in (0, 1)")
    marks = F.broadcast(marks) if small(marks, SMALL_TABLE) else marks
    rest = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))
    out = docs.withColumn("rest", rest).join(marks, F.col(id_col) == F.col("__id"), "left")
    group = F.when(F.col("rest") != HELD_OUT, (1 - F.col("__toxic")) + F.when(F.col("rest") == 0, 0).otherwise(2))
    return out.withColumn("group", group.cast("int")).withColumn("held_out", F.coalesce(F.col("rest") == HELD_OUT, F.lit(False))).drop("rest", "__id", "__toxic")


def packed(rows: DataFrame, pack_bytes: int = PACK_BYTES, most_grams: int = FAMILY_GRAMS) -> DataFrame:
    """Rows (id, text, group) in packs of about ``pack_bytes`` of text of one task, numbered by family.

    A pack has its rows' ids and groups, its distinct words, and of each row the distinct words (as
    numbers into the pack's) and how often each stands in it.  A family ends with the task or at
    ``most_grams`` distinct grams; a row of its own has these, ascending, and their training counts.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, groups, lengths, codes, times, size = [], [], array("I"), array("I"), array("I"), 0
        numbers: dict[bytes, int] = {}
        family, members = TaskContext.get().partitionId() << 32, 0
        kinds, sums = np.zeros(0, np.int64), np.zeros((len(SUMS), 0))

        def row(of_rows: list, blobs: dict[str, bytes]) -> pa.RecordBatch:
            held = [pa.array([x], pa.list_(t)) for x, t in zip(of_rows, (id_type, pa.int32()))]
            made = [pa.array([zlib.compress(blobs[b]) if b in blobs else None], pa.binary()) for b in (*BLOBS, *COUNTED)]
            return pa.RecordBatch.from_arrays([pa.array([family]), *held, *made], names=["family", "ids", "groups", *BLOBS, *COUNTED])

        def pack() -> pa.RecordBatch:
            nonlocal size, kinds, sums, members
            n = np.frombuffer(lengths, np.uint32)
            number, count, of_row = np.frombuffer(codes, np.uint32).astype(np.int64), np.frombuffer(times, np.uint32), np.repeat(np.arange(len(n)), n)
            of_group = np.array([-1 if g is None else g for g in groups])[of_row]
            counts = np.stack([np.bincount(number[own], weights=count[own], minlength=len(numbers)) for own in (of_group == k for k in range(len(SUMS)))])
            words = list(numbers)
            for part in word_parts(words):
                kinds, sums = added(kinds, sums, *counted(words[part], counts[:, part]))
            order = np.lexsort((number, of_row))
            step = np.diff(number[order], prepend=0)
            begin = (np.cumsum(n, dtype=np.int64) - n)[n > 0]
            step[begin] = number[order][begin]  # a row's least number, then differences
            made = row([ids, groups], dict(zip(BLOBS, (b" ".join(words), *map(small_ints, (n, step, count[order]))))))
            size, members = 0, members + 1
            for held in (ids, groups, numbers):
                held.clear()
            return made

        def closed() -> pa.RecordBatch:
            nonlocal family, members, kinds, sums
            made = row([None, None], dict(zip(COUNTED, (small_ints(np.diff(kinds, prepend=0), 8), small_ints(sums.ravel(), 8)))))
            family, members, kinds, sums = family + 1, 0, np.zeros(0, np.int64), np.zeros((len(SUMS), 0))
            return made

        for batch in batches:
            id_type = batch.schema.field(0).type
            for id_, text, group in zip(batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2)):
                text, group = text.as_py(), group.as_py()
                found = Counter(words_of(text))
                ids.append(id_.as_py())
                groups.append(group)
                lengths.append(len(found))
                codes.extend([numbers.setdefault(w, len(numbers)) for w in found])
                times.extend(found.values())
                size += len(text or b"") + ROW_BYTES
                if size >= pack_bytes:
                    yield pack()
                    lengths, codes, times = array("I"), array("I"), array("I")
                    if len(kinds) >= most_grams:
                        yield closed()
        if ids:
            yield pack()
        if members:
            yield closed()

    made = rows.select("id", "text", "group").mapInArrow(lean(run), f"family long, ids array<{kind}>, groups array<int>, " + ", ".join(f"{b} binary" for b in (*BLOBS, *COUNTED)))
    return saved(made)


def in_tasks(rows: DataFrame, text_bytes: int) -> DataFrame:
    """The rows in fewer partitions, if each task would have far less than ``TASK_BYTES`` of text; cores stay busy."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-text_bytes // TASK_BYTES)))


def small_ints(values: np.ndarray, size: int = 4) -> bytes:
    """Whole numbers of 4 or 8 bytes, all lowest bytes first: the others are mostly zero and compress well."""
    return values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def ints(stored: bytes, size: int = 4) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(stored, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel().astype(np.int64)


def word_parts(words: list[bytes]) -> Iterator[slice]:
    return slices([1] * len(words), HELD_WORDS)


def counted(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of words, ascending, and the sums of the words' counts."""
    found, own = grams(words)
    kinds, at = np.unique(found, return_inverse=True)
    return kinds, np.stack([np.bincount(at, weights=c[own], minlength=len(kinds)) for c in counts])


def added(kinds: np.ndarray, sums: np.ndarray, more: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two tables of ascending grams and their counts as one."""
    at = np.searchsorted(kinds, more)
    old = np.append(kinds, -1)[at] == more
    sums[:, at[old]] += counts[:, old]
    return np.insert(kinds, at[~old], more[~old]), np.insert(sums, at[~old], counts[:, ~old], axis=1)


def family_grams(packs: DataFrame, columns: str, table: Callable[[int, np.ndarray, np.ndarray], list[np.ndarray]]) -> DataFrame:
    """Rows for every gram of every family, from its number, its grams and their counts."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for family, stored, sums in zip(*batch.columns):
                kinds = np.cumsum(ints(zlib.decompress(stored.as_py()), 8))
                made = table(family.as_py(), kinds, ints(zlib.decompress(sums.as_py()), 8).reshape(len(SUMS), -1))
                for k in range(0, len(kinds), EMITTED_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k:k + EMITTED_ROWS]) for c in made], names=names)

    return packs.where("grams is not null").select("family", *COUNTED).mapInArrow(lean(run), columns)


def gram_counts(packs: DataFrame) -> DataFrame:
    """(gram, t0, o0, t2, o2): every gram of the corpus with its training counts."""
    parts = family_grams(packs, "gram long, " + ", ".join(f"{s} long" for s in SUMS), lambda family, kinds, sums: [kinds, *sums])
    return saved(parts.groupBy("gram").agg(*[F.sum(s).alias(s) for s in SUMS]))


def ratios(counts: DataFrame) -> DataFrame:
    """(gram, all, f0, f2): log-likelihood ratios, toxic over ordinary, of every gram whose context a class has seen."""
    counts = counts.withColumn("ctx", F.shiftright("gram", 8)).withColumn("tail", F.col("gram").bitwiseAND((1 << 8 * (ORDER - 1)) - 1))
    tails = counts.groupBy("tail").agg(F.count("*").alias("left")).withColumn("ctx4", F.shiftright("tail", 8)).withColumn("byte", F.col("tail").bitwiseAND(255))
    tails = saved(tails)
    middle = tails.groupBy("ctx4").agg(F.sum("left").alias("n4"), F.count("*").alias("t4"))
    bytes_ = tails.groupBy("byte").agg(F.sum("left").alias("n"))
    total = tails.agg(F.sum("left")).first()[0] or 1
    shared = tails.join(middle, "ctx4").join(F.broadcast(bytes_), "byte").select(  # at most 256 rows
        "tail", ((F.greatest(F.col("left") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("t4") * F.col("n") / total) / F.col("n4")).alias("p"))
    seen = {"all": (F.col("t0") + F.col("t2"), F.col("o0") + F.col("o2")), "f0": (F.col("t0"), F.col("o0")), "f2": (F.col("t2"), F.col("o2"))}
    split = counts.where("t0 + o0 + t2 + o2 > 0").select("gram", "ctx", "tail", *[c.alias(f"{k}_{m}") for m, pair in seen.items() for k, c in zip("to", pair)])
    sums = [f(f"{k}_{m}").alias(f"{p}{k}_{m}") for m in MODELS for k in "to" for p, f in (("n", F.sum), ("d", lambda c: F.count(F.when(F.col(c) > 0, 1))))]
    contexts = split.groupBy("ctx").agg(*sums)
    back = lambda k, m: F.when(F.col(f"n{k}_{m}") > 0, DISCOUNT * F.col(f"d{k}_{m}") / F.col(f"n{k}_{m}")).otherwise(1.0)
    contexts = contexts.select("ctx", *[c for m in MODELS for k in "to" for c in (F.col(f"n{k}_{m}"), back(k, m).alias(f"b{k}_{m}"))])
    joined = split.join(contexts, "ctx").join(shared, "tail")
    prob = lambda k, m: F.when(F.col(f"n{k}_{m}") > 0, F.greatest(F.col(f"{k}_{m}") - DISCOUNT, F.lit(0.0)) / F.col(f"n{k}_{m}")).otherwise(0.0) + F.col(f"b{k}_{m}") * F.col("p")
    trained = joined.select("gram", *[(F.log(prob("t", m)) - F.log(prob("o", m))).alias(m) for m in MODELS])
    untrained = counts.where("t0 + o0 + t2 + o2 = 0").join(contexts, "ctx").select("gram", *[(F.log(f"bt_{m}") - F.log(f"bo_{m}")).alias(m) for m in MODELS])
    return trained.union(untrained)


def family_ratios(packs: DataFrame, by_gram: DataFrame) -> DataFrame:
    """(family, gram, all, f0, f2): the ratios of each family's grams; a gram has at most one row per family.

    f0 and f2 are null for grams that no row of the family needs them for.
    """
    def needs(family: int, kinds: np.ndarray, sums: np.ndarray) -> list[np.ndarray]:
        t0, o0, t2, o2 = sums
        return [np.full(len(kinds), family), kinds, (t2 + o2 > 0) + 2 * (t0 + o0 > 0)]

    rows = family_grams(packs, "family long, gram long, need long", needs).join(by_gram, "gram")
    return rows.select("family", "gram", "all", *[F.when(F.col("need").bitwiseAND(bit) > 0, F.col(m)).alias(m) for m, bit in (("f0", 1), ("f2", 2))])


def word_ratios(words: list[bytes], known: np.ndarray, by_gram: list[np.ndarray]) -> np.ndarray:
    """Length-normalised log-likelihood ratios of words by each table; known is sorted, other grams count 0."""
    found, own = grams(words)
    at = np.searchsorted(known, found)
    hit = np.append(known, -1)[at] == found
    length = (np.fromiter(map(len, words), np.int64, len(words)) + 1) ** LENGTH_POWER
    return np.stack([np.bincount(own, weights=np.where(hit, np.append(t, 0.0)[at], 0.0), minlength=len(words)) / length for t in by_gram])


def summary(values: np.ndarray, times: np.ndarray) -> tuple[float, float, float]:
    """The features of a text whose distinct words have these ratios, each so many times."""
    if not len(values):
        return 0.0, 0.0, 0.0
    most = np.argsort(-values, kind="stable")[:TOP] if len(values) <= TOP else np.argpartition(-values, TOP - 1)[:TOP]
    best = np.sort(np.repeat(values[most], np.minimum(times[most], TOP)))[::-1][:TOP]
    return float(best[0]), float(best.sum()), float(values @ times / times.sum())


def with_features(packs: DataFrame, by_gram: DataFrame, kind: str) -> DataFrame:
    """(id, group, features, cross features) of every row; cross: of training rows, by the model of the other half."""
    model_of = {0: "f2", 1: "f2", 2: "f0", 3: "f0"}

    def scored(pack: pa.RecordBatch, known: np.ndarray, by_gram: list[np.ndarray]) -> pa.RecordBatch:
        blob = lambda c: zlib.decompress(pack.column(c)[0].as_py())
        words, groups = blob("words").split(), pack.column("groups")[0].as_py()
        lengths, steps, times = (ints(blob(c)) for c in ("lengths", "codes", "times"))
        ends = np.cumsum(lengths)
        sums = np.cumsum(np.concatenate([np.zeros(1, np.int64), steps]))
        codes = sums[1:] - np.repeat(sums[ends - lengths], lengths)
        value = dict(zip(MODELS, np.concatenate([np.zeros((len(MODELS), 0)), *(word_ratios(words[part], known, by_gram) for part in word_parts(words))], axis=1)))
        found, crossed = [], []
        for first, end, group in zip((ends - lengths).tolist(), ends.tolist(), groups):
            own, n = codes[first:end], times[first:end]
            found.append(summary(value["all"][own], n))
            crossed.append((None,) * len(FEATURES) if group is None else summary(value[model_of[group]][own], n))
        columns = [pa.array(c, pa.float64()) for rows in (found, crossed) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays([pack.column("ids").flatten(), pa.array(groups, pa.int32()), *columns], names=["id", "group", *FEATURES, *CROSSED])

    def run(family: pa.Table, table: pa.Table) -> pa.Table:
        known = table.column("gram").to_numpy()
        order = np.argsort(known)
        known, by_gram = known[order], [table.column(m).to_numpy()[order] for m in MODELS]
        made = pa.Table.from_batches([scored(pack, known, by_gram) for pack in family.to_batches(max_chunksize=1)])
        del known, order, by_gram
        give_back()
        return made

    values = family_ratios(packs, by_gram)
    members = packs.where("ids is not null").select("family", "ids", "groups", *BLOBS)
    made = members.groupBy("family").cogroup(values.groupBy("family")).applyInArrow(
        run, f"id {kind}, group int, " + ", ".join(f"{f} double" for f in (*FEATURES, *CROSSED)))
    return saved(made)


def fitted(trained: DataFrame) -> tuple[float, list[float]]:
    """Intercept and feature weights of the logistic regression on cross-scored training rows."""
    n, toxic = trained.agg(F.count("*"), F.sum("y")).first()
    if not n or not toxic or toxic == n:
        share = (toxic / n if n else 0.5)
        return float(np.log((share + 1e-6) / (1 - share + 1e-6))), [0.0] * len(FEATURES)
    data = saved(trained.select(array_to_vector(F.array(*FEATURES)).alias("features"), F.col("y").cast("double").alias("label")))
    model = LogisticRegression(regParam=1e-4, standardization=True, maxIter=50).fit(data)
    return float(model.intercept), [float(c) for c in model.coefficients]


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, key: Column) -> tuple:
    """(features by key, logistic weights) of all documents, learned from the labelled training rows."""
    rows = training_rows(docs.select(F.col(id_col), F.col(text_col).alias("text"), key.alias("key")), labels, id_col)
    size = docs.agg(F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + ROW_BYTES)).first()[0] or 0
    packs = packed(in_tasks(rows.select(F.col("key").alias("id"), "text", "group"), size))
    features = with_features(packs, ratios(gram_counts(packs)), rows.schema["key"].dataType.simpleString())
    crossed = features.where("group is not null").select(*[F.col(c).alias(f) for f, c in zip(FEATURES, CROSSED)], (F.col("group") % 2 == 0).cast("int").alias("y"))
    return features, fitted(crossed)


def logistic(weights: tuple[float, list[float]]) -> Column:
    bias, by_feature = weights
    return 1 / (1 + F.exp(-sum((w * F.col(f) for f, w in zip(FEATURES, by_feature)), F.lit(bias))))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: id, held_out, score, predicted."""
    features, weights = train(docs, labels, id_col, text_col, F.col(id_col))
    out = features.select(F.col("id").alias(id_col), logistic(weights).alias("score"))
    held = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT
    return out.select(id_col, F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, all columns unchanged; equal texts have equal scores, so texts go by their hash."""
    key = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256))
    features, weights = train(docs, labels, id_col, text_col, key)
    gone = saved(features.where(logistic(weights) >= threshold).select(F.col("id").alias("__gone")).distinct())
    gone = F.broadcast(gone) if small(gone, SMALL_TABLE) else gone
    return docs.join(gone, key == F.col("__gone"), "left_anti").select(docs.columns)
