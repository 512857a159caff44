"""Operator 3: mixing sources to target weights (DataFrame functions only).

The sources, by code point with null last, weigh 5, 2, 1, repeating, and share the size of
the whole corpus by weight.  A target stops at three times its source's size; the
excess goes to the others by weight until none is above (water-filling: one level per
unit of weight, raised until the capped set is stable; each round is one aggregation over one
row per source).

A source is taken in complete epochs first.  The rest of its target is an
Efraimidis-Spirakis sample: every document draws the exponential key -ln(u) / q, where u is
a repeatable hash of its id and q its quality weight, and the smallest keys are taken until
their prefix sum of sizes comes nearest the rest.  The prefix sums are two-level: sums per
key range over all ranges of a source, then row by row only inside the range where the
budget ends.  The result is a threshold key per source, so no document's text is shuffled,
and a hot source spreads over its ranges.

Cases: null text has size 0; rows that share an id within a source (or have none) are taken
together or not at all; documents without a label, or with a null one, weigh ``UNLABELLED``;
several labels of one document count as their largest; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit, hash_unit_sql
from ..operators.indexing import dense_index
from .common import saved, small

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
QUALITY = {1: 2.0, 0: 0.5}  # labels.quality -> sampling weight
UNLABELLED = 1.0
RANGE_ROWS = 2_000  # documents of a source in one key range, about
SMALL_TABLE = 1_000_000
SALT = "mix:"
WORD = "[^\\x20\\x09-\\x0D]+"


def sampling_key(id_col: str, quality: Column) -> Column:
    """-ln(u) / q with u in (0, 1]; equal for equal ids and qualities."""
    u = F.lit(1.0) - hash_unit(F.coalesce(F.col(id_col).cast("string"), F.lit("")), SALT)
    return -F.log(u) / quality


def with_keys(docs: DataFrame, labels: DataFrame | None, id_col: str) -> DataFrame:
    """The documents with column ``__key``."""
    if labels is None:
        return docs.withColumn("__key", sampling_key(id_col, F.lit(UNLABELLED)))
    marks = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__quality")).where("__id is not null")
    marks = F.broadcast(marks) if small(marks, SMALL_TABLE) else marks
    weight = F.coalesce(F.create_map(*[F.lit(x) for kv in QUALITY.items() for x in kv])[F.col("__quality")], F.lit(UNLABELLED))
    joined = docs.join(marks, F.col(id_col) == F.col("__id"), "left")
    return joined.withColumn("__key", sampling_key(id_col, weight)).drop("__id", "__quality")


def source_targets(totals: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, docs, source_size) with column target."""
    ranked = dense_index(totals, [F.col("source").asc_nulls_last()], index_col="at")
    share = F.array(*[F.lit(w) for w in weights])
    ranked = saved(ranked.withColumn("w", F.get(share, F.pmod("at", F.lit(len(weights))).cast("int"))).drop("at"))
    level, capped = 0.0, -1
    while True:
        is_capped = F.col("w") * level > most * F.col("source_size")
        total, cap_size, free, n = ranked.agg(
            F.sum("source_size"), F.coalesce(F.sum(F.when(is_capped, most * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("w"))), F.lit(0)), F.count(F.when(is_capped, 1))).first()
        if n == capped or not total or not free:
            break
        level, capped = (total - cap_size) / free, n
    target = F.when(F.col("w") * level > most * F.col("source_size"), (most * F.col("source_size")).cast("double")).otherwise(F.col("w") * F.lit(level))
    return ranked.withColumn("target", target).drop("w")


def thresholds(base: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, last): epochs taken whole, and the last (key, id) of the sample."""
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    plan = saved(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
                 .withColumn("ranges", F.ceil(F.col("docs") / RANGE_ROWS)))
    few = F.broadcast(plan) if small(plan, SMALL_TABLE) else plan
    placed = base.alias("b").join(few.alias("p"), F.expr("b.source <=> p.source")).select(
        "b.*", "p.rest", F.floor((F.lit(1.0) - F.exp(-F.col("__key"))) * F.col("ranges")).alias("at"))
    sums = placed.groupBy("source", "at").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    before = saved(sums.selectExpr("source", "at", "size", "rest", "sum(size) over (partition by source order by at) - size as before"))
    # whole ranges of small enough sum are in; the range where the budget ends is the last that starts within it
    edge = before.where("before <= rest").groupBy("source").agg(F.max("at").alias("at"), F.max_by("before", "at").alias("before"))
    edge = F.broadcast(edge) if small(edge, SMALL_TABLE) else edge
    rows = placed.alias("r").join(edge.alias("e"), F.expr("r.source <=> e.source and r.at = e.at")).select("r.*", "e.before")
    units = rows.groupBy("source", "at", "__key", "id").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    summed = units.selectExpr("*", "before + sum(size) over (partition by source, at order by __key, id) - size as ahead")
    inside = summed.where("ahead + size / 2 <= rest").groupBy("source").agg(F.max(F.struct("__key", "id")).alias("last_row"))
    earlier = placed.alias("r").join(edge.alias("e"), F.expr("r.source <=> e.source and r.at < e.at"))
    earlier = earlier.groupBy("r.source").agg(F.max(F.struct("r.__key", "r.id")).alias("last_row"))
    last = inside.union(earlier).groupBy("source").agg(F.max("last_row").alias("last"))
    return saved(plan.alias("p").join(last.alias("l"), F.expr("p.source <=> l.source"), "left").select(
        "p.source", "p.source_size", "p.target", "p.epochs", "l.last"))


def mix(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document row: id, size, source_size, target (of its source), taken (words, repeats counted)."""
    base = with_keys(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                 F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), labels, "id")
    base = saved(base)
    limits = plan_mix(base)
    few = F.broadcast(limits) if small(limits, SMALL_TABLE) else limits
    out = base.alias("b").join(few.alias("p"), F.expr("b.source <=> p.source"))
    return out.select(F.col("b.id").alias(id_col), "size", "source_size", "target", (repeats("b.id") * F.col("size")).alias("taken"))


def plan_mix(base: DataFrame) -> DataFrame:
    totals = saved(base.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size")))
    return thresholds(base, source_targets(totals))


def repeats(id_col: str) -> Column:
    """How often a document is taken: all epochs, and once more if its (key, id) is within the sample."""
    own = F.struct(F.col("__key"), F.col(id_col).alias("id"))
    return F.col("epochs") + F.when(own <= F.col("last"), 1).otherwise(0)


def mixed_documents(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents taken, all columns, with column ``repeats`` (how often each is to be read)."""
    base = saved(with_keys(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(
        F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), labels, "id"))
    limits = plan_mix(base).select(F.col("source").alias("__source"), "epochs", "last")
    few = F.broadcast(limits) if small(limits, SMALL_TABLE) else limits
    keyed = with_keys(docs.drop("repeats", "epochs", "last"), labels, id_col)
    out = keyed.join(few, F.col(source_col).eqNullSafe(F.col("__source"))).withColumn("repeats", repeats(id_col).cast("long"))
    return out.where("repeats > 0").drop("__key", "__source", "epochs", "last")


def oracle_sql() -> str:
    """DuckDB SQL for the registered query: the water level in closed form, plain window prefix sums."""
    w = " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(WEIGHTS))
    q = " ".join(f"WHEN {k} THEN {x}" for k, x in QUALITY.items())
    u = hash_unit_sql("coalesce(d.doc_id::VARCHAR, '')", SALT)
    return f"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
b AS (SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    -ln(1.0::DOUBLE - {u}) / coalesce(CASE quality {q} END, {UNLABELLED})::DOUBLE AS k FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {w} END AS w FROM b GROUP BY source),
f AS (SELECT *, ({MOST_EPOCHS} * source_size)::DOUBLE / w AS ratio FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum({MOST_EPOCHS} * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM f),
v AS (SELECT level FROM l WHERE w * level <= {MOST_EPOCHS} * source_size ORDER BY ratio LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN w * v.level > {MOST_EPOCHS} * source_size THEN ({MOST_EPOCHS} * source_size)::DOUBLE ELSE w * v.level END AS target FROM l, v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
c AS (SELECT b.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(size) OVER (PARTITION BY b.source ORDER BY k, b.doc_id) AS upto, sum(size) OVER (PARTITION BY b.source, k, b.doc_id) AS unit
    FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + CASE WHEN upto - unit + unit / 2.0::DOUBLE <= rest THEN size ELSE 0 END)::BIGINT AS taken FROM c
"""
