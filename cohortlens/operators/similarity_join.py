"""Set-similarity join: all pairs with a Jaccard similarity of at least a threshold, exactly.

The all-pairs form (``graph.jaccard_all_pairs``) compares every two patients.  With a threshold t most pairs
need not be looked at: order each set's items from the rarest to the most frequent; two sets with a
similarity of t or more share an item among their first n - ceil(t n) + 1 ones.

1. Patients with equal sets become one class; only its smallest id is compared further.
2. The prefixes, exploded, are an inverted index by rare items, joined with itself.  Within a posting list pairs
   are kept only if their sizes allow t (n_1 >= t n_2), and if the items after the shared one still
   suffice for the needed overlap.  Posting lists of frequent items are split by the adaptive skew join.
3. The distinct candidates are verified on the whole sets.

Nothing is sampled or capped.  Sets are bounded by the vocabulary; empty sets are similar to nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

EPS = 1e-9  # room for rounding in the bounds; the verification itself compares exactly


def rare_first_sets(items: DataFrame, id_col: str, item_col: str) -> DataFrame:
    """(id, s, n): every id's distinct items, the rarest first."""
    pairs = items.select(F.col(id_col).alias("id"), F.col(item_col).alias("item")).where("id is not null and item is not null").distinct()
    often = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("often"))
    sets = pairs.join(often, "item").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("s"))
    return sets.select("id", F.transform("s", lambda x: x["item"]).alias("s"), F.size("s").alias("n"))


def set_classes(items: DataFrame, id_col: str = "patient_id", item_col: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(id, s, n) of one id per distinct set, and (id, class): every id with the smallest id of the same set; both stored."""
    ensure_checkpoint_dir(items.sparkSession)
    sets = rare_first_sets(items, id_col, item_col).checkpoint(eager=True)
    least = sets.groupBy("s").agg(F.min("id").alias("class"))
    members = sets.join(least, "s").select("id", "class").checkpoint(eager=True)
    return sets.join(members.where("id = class").select("id"), "id", "left_semi"), members


def _at_least(t: float, n: Column) -> Column:
    return F.ceil(F.lit(t) * n - EPS)


def candidates(sets: DataFrame, t: float) -> DataFrame:
    """(a, b), a < b: pairs that share a prefix item and whose sizes and places of that item allow a similarity of t."""
    prefix = F.slice("s", F.lit(1), (F.col("n") - _at_least(t, F.col("n")) + 1).cast("int"))
    index = sets.select("id", "n", F.posexplode(prefix).alias("pos", "item"))
    a = index.select("item", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "pos")])
    b = index.select("item", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "pos")])
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    rest = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))   # the shared item and what may follow
    before = F.least("pos_a", "pos_b")                                            # and may precede it
    overlap = F.ceil(F.lit(t / (1 + t)) * (F.col("n_a") + F.col("n_b")) - EPS)
    allowed = (F.col("id_a") < F.col("id_b")) & (small >= F.lit(t) * large - EPS) & (rest + before >= overlap)
    return a.join(b, "item").where(allowed).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def similar_classes(sets: DataFrame, t: float) -> DataFrame:
    """(a, b, similarity) of the distinct sets with a similarity of at least t, verified on whole sets."""
    pairs = candidates(sets, t)
    whole = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("s_a"), F.col("n").alias("n_a")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("s").alias("s_b"), F.col("n").alias("n_b")), "b")
    shared = whole.withColumn("i", F.size(F.array_intersect("s_a", "s_b")))
    similarity = F.col("i") / (F.col("n_a") + F.col("n_b") - F.col("i"))
    return shared.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= t)


def jaccard_join(items: DataFrame, min_similarity: float, id_col: str = "patient_id", item_col: str = "item_id",
                 expand: bool = True) -> DataFrame:
    """(patient_id_1 < patient_id_2, similarity) of all pairs with a similarity of at least ``min_similarity`` (above 0, at most 1).

    With ``expand=False`` the pairs are between the smallest ids of equal sets only (:func:`set_classes` gives
    the members), so that thousands of equal patients make no quadratic output.
    """
    if not 0 < min_similarity <= 1:
        raise ValueError("min_similarity must be above 0 and at most 1")
    sets, members = set_classes(items, id_col, item_col)
    pairs = similar_classes(sets, min_similarity)
    names = [f"{id_col}_1", f"{id_col}_2"]
    if not expand:
        return pairs.select(F.col("a").alias(names[0]), F.col("b").alias(names[1]), "similarity")
    one = members.select(F.col("class").alias("a"), F.col("id").alias("x"))
    two = members.select(F.col("class").alias("b"), F.col("id").alias("y"))
    across = pairs.join(one, "a").join(two, "b").select("x", "y", "similarity")
    within = one.join(two, F.col("a") == F.col("b")).where("x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    return across.unionByName(within).select(F.least("x", "y").alias(names[0]), F.greatest("x", "y").alias(names[1]), "similarity")
