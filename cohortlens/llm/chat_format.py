"""Operator 8: chat formatting with cumulative-snapshot collapse.

Logs often hold every state of a conversation: turns 1-2, then 1-4, then 1-6.  Each turn's
role and text are hashed, its position is mixed in, and running sums of these hashes in turn order
give a rolling hash of every prefix.  A conversation whose whole hash is a proper prefix of
another one's is removed by an anti-join on (length, hash), and of equal conversations the
smallest id stays.  Only the maximal ones are rendered.

Positions and running sums come from range-partitioned helpers, so a conversation with very
many turns spreads over tasks; prefixes are made distinct (with partial aggregation)
before the anti-join, so a common first turn is one row.  Rendered text comes in parts of at
most ``PART_TURNS`` turns, in order; usually a conversation has one part.

Cases: turns are ordered by (turn with null first, role, md5 of role and text); rows equal in all
four columns count once; null roles and texts are empty; a null conv_id is a conversation
of its own; an empty table gives no rows.  ``<|`` inside texts becomes ``<¦``, so that a text
can't open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import dense_index, prefix_sums
from .common import saved, small

PART_TURNS = 1000
SMALL_TABLE = 1_000_000


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, h, pos, h1, h2): each distinct turn's position from 0 and the rolling hash up to it."""
    # a null id can't be told from others in joins, so ids travel as a struct
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]
    placed = dense_index(turns, order, "pos", group_cols=["conv"])
    mixed = placed.select("*", *[F.xxhash64("pos", "h", F.lit(salt)).cast("decimal(38,0)").alias(f"g{salt}") for salt in (1, 2)])
    summed = prefix_sums(mixed, ["pos"], ["g1", "g2"], group_cols=["conv"])
    return summed.withColumnsRenamed({"g1_cum": "h1", "g2_cum": "h2"}).drop("g1", "g2")


def maximal(rolling: DataFrame) -> DataFrame:
    """(conv, turns): the conversations that are no proper prefix of another, once each."""
    last = rolling.groupBy("conv").agg(F.max("pos").alias("end"), F.max_by(F.struct("h1", "h2"), "pos").alias("whole"))
    last = saved(last)
    proper = rolling.join(last.select("conv", "end"), "conv").where("pos < end").select(
        F.col("pos").alias("end"), F.struct("h1", "h2").alias("whole")).distinct()
    once = last.groupBy("end", "whole").agg(F.min("conv").alias("conv"))
    return once.join(proper, ["end", "whole"], "left_anti").select("conv", (F.col("end") + 1).alias("turns"))


def format_chats(conversations: DataFrame, id_col: str = "conv_id", part_turns: int = PART_TURNS) -> DataFrame:
    """One row per part of each maximal conversation: id, part (from 0), n_turns (of the part), text."""
    rows = conversations.select(F.struct(F.col(id_col).alias("id")).alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.md5(F.concat("role", F.lit("\n"), "text")))
    rolling = saved(prefixes(rows.select("conv", "turn", "role", "h").distinct()))
    kept = saved(maximal(rolling))
    places = rolling.join(F.broadcast(kept) if small(kept, SMALL_TABLE) else kept, "conv").select("conv", "turn", "role", "h", "pos")
    texts = rows.alias("r").join(places.alias("p"), F.expr("r.conv = p.conv and r.turn <=> p.turn and r.role = p.role and r.h = p.h")).select(
        "p.conv", "p.pos", "r.role", "r.text")
    turn = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), F.replace(F.col("text"), F.lit("<|"), F.lit("<¦")), F.lit("<|im_end|>\n"))
    parts = texts.withColumn("said", turn).groupBy("conv", F.floor(F.col("pos") / part_turns).alias("part")).agg(
        F.array_sort(F.collect_set(F.struct("pos", "said"))).alias("turns"))  # repeated rows are one turn
    return parts.select(F.col("conv.id").alias(id_col), "part", F.size("turns").cast("long").alias("n_turns"),
                        F.array_join("turns.said", "").alias("text"))


ORACLE_SQL = f"""
WITH d AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(role || chr(10) || text)) - 1 AS pos FROM d),
k AS (SELECT *, md5(string_agg(md5(role || chr(10) || text), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS h FROM p),
e AS (SELECT conv_id, max(pos) AS pos, arg_max(h, pos) AS h FROM k GROUP BY conv_id),
m AS (SELECT min(conv_id) AS conv_id FROM e WHERE NOT EXISTS (SELECT 1 FROM k JOIN e l ON l.conv_id IS NOT DISTINCT FROM k.conv_id
    WHERE k.pos < l.pos AND k.pos = e.pos AND k.h = e.h) GROUP BY pos, h)
SELECT p.conv_id, (p.pos // {PART_TURNS})::BIGINT AS part, count(*) AS n_turns,
    string_agg('<|im_start|>' || role || chr(10) || replace(text, '<|', '<¦') || '<|im_end|>' || chr(10), '' ORDER BY p.pos) AS text
FROM p JOIN m ON m.conv_id IS NOT DISTINCT FROM p.conv_id GROUP BY p.conv_id, p.pos // {PART_TURNS}
"""
