"""Chat formatting: collapse cumulative snapshots of a conversation, render the rest.

A log often holds a conversation again after each turn.  Every turn gets the
hash of all turns up to it: the xor of position-labelled 64-bit hashes, two of
them, rolled along by a window inside the conversation.  A conversation whose
last hash is the hash of an earlier turn of a longer conversation is a prefix
of it and goes, by an anti-join; of conversations that are equal turn by turn
the least id stays.  Both sides of the anti-join are distinct hashes, so a
first turn or a whole conversation that a third of the log shares is one row.

A conversation is one record: its turns meet in one task, as they must to be
rendered into one text.

Defined results: rows without a conversation id belong to none and are left
out; turns are ordered by (turn with nulls first, role, text), and rows that
repeat all four columns count once; a null role is ``unknown``, a null text is
empty; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import staged

TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, pos, n_turns, role, text, h1, h2): turns numbered from 1, with their rolling hashes."""
    t = (df.where("conv_id IS NOT NULL")
         .select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct())
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = t.withColumn("pos", F.row_number().over(order)).withColumn("n_turns", F.count(F.lit(1)).over(W.partitionBy("conv_id")))
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    return (t.withColumn("h1", F.bit_xor(F.xxhash64("pos", "role", "text")).over(upto))
            .withColumn("h2", F.bit_xor(F.xxhash64(F.lit("second"), "text", "role", "pos")).over(upto)).drop("turn"))


def maximal(t: DataFrame) -> DataFrame:
    """(conv_id, copies): the conversations that no longer one begins with."""
    whole = (t.where("pos = n_turns").groupBy("h1", "h2", "n_turns")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")))
    inner = t.where("pos < n_turns").select("h1", "h2", F.col("pos").cast("long").alias("n_turns")).distinct()
    return whole.join(inner, ["h1", "h2", "n_turns"], "left_anti").select("conv_id", "copies")


def render(t: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text) of numbered turns."""
    before, between, after = TURN.replace("{text}", "{role}").split("{role}")
    segment = F.concat(F.lit(before), "role", F.lit(between), "text", F.lit(after))
    parts = F.sort_array(F.collect_list(F.struct("pos", segment.alias("s"))))
    return t.groupBy("conv_id", "n_turns").agg(F.array_join(F.transform(parts, lambda x: x["s"]), "").alias("text"))


def collapse_and_render(df: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, text): maximal conversations as chat text."""
    t = staged(turns(df), "turns")
    kept = maximal(t)
    return render(t.join(kept.select("conv_id"), "conv_id", "left_semi")).join(kept, "conv_id").select("conv_id", "n_turns", "copies", "text")


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
             count(*) OVER (PARTITION BY conv_id) AS n_turns FROM t),
p AS (SELECT *, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS upto FROM s),
whole AS (SELECT upto, min(conv_id) AS conv_id, count(*) AS copies FROM p WHERE pos = n_turns GROUP BY upto),
kept AS (SELECT conv_id, copies FROM whole
         WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n_turns AND p.upto = whole.upto))
SELECT conv_id, n_turns, copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM s JOIN kept USING (conv_id) GROUP BY conv_id, n_turns, copies
"""
