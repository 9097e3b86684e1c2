"""Multi-party perspective rotation of conversations, with DataFrame functions only.

For every participant (distinct role other than ``system``) of a conversation
the whole dialogue is rendered once with that speaker as ``assistant``, every
other speaker as a named user and system turns as system.  The loss mask is a
list of character spans: the participant's own texts with their end marker.

A rendering is cut into chunks of ``TURNS`` turn numbers, whose concatenation
in order is the whole dialogue; offsets count from its start.  Where a chunk
starts comes from text lengths summed per (conversation, role, chunk), added up in
runs of ``RUN`` chunks; texts only meet inside their chunk.  So no task or
row ever holds an unbounded conversation, however many turns it has.

Defined cases: null text renders as empty; a null role speaks as ``unknown``;
a null turn comes first; rows with equal turn are ordered by role, then text;
rows that repeat are rendered again; markers inside texts are broken up
(``<|`` becomes ``< |``), so a text cannot forge a turn; a conversation of
system turns only has no participant and no rendering; a null ``conv_id`` is one
conversation; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURNS = 64
#: Chunks whose sizes are summed in one window task.
RUN = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rotate(conversations: DataFrame, turns: int = TURNS) -> DataFrame:
    """conv_id, perspective, chunk, chunk_start, n_turns, rendered, loss_spans, loss_chars."""
    said = conversations.select(
        "conv_id", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    speakers = (said.where(F.col("role") != "system").select(F.col("conv_id").alias("s_conv"),
                                                             F.col("role").alias("perspective")).distinct())
    said = said.withColumn("chunk", F.floor(F.col("turn") / F.lit(turns)).cast("long"))
    same = F.col("conv_id").eqNullSafe(F.col("s_conv"))
    # A struct is never null, so a null conversation is a key like any other and joins on the partitioning that groups it.
    seen = said.join(speakers, same).withColumn("conv", F.struct("conv_id")).drop("s_conv", "conv_id")
    own = F.col("role") == F.col("perspective")
    head = F.concat(F.lit(OPEN), F.when(F.col("role") == "system", F.lit("system")).when(own, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), F.replace("role", F.lit("<|"), F.lit("< |")))),
                    F.lit("\n"))
    body = F.concat("text", F.lit(CLOSE))
    seen = (seen.withColumn("own", own).withColumn("head", head).withColumn("body", body)
            .withColumn("size", F.length("head") + F.length("body") + 1))
    keys = ["conv", "perspective", "chunk"]
    order = ["turn", "role", "text"]
    before = F.sum("size").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    at = seen.withColumn("at", (before - F.col("size")).cast("long"))
    chunks = at.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum("size").alias("chars"),
        F.sort_array(F.collect_list(F.struct("at", "own", "head", "body"))).alias("parts"))
    told = said.groupBy("conv_id", "chunk", "role").agg((F.sum(F.length("text") + len(CLOSE) + 1)).alias("n_chars"), F.count(F.lit(1)).alias("n"))
    told = told.join(speakers, same).withColumn("conv", F.struct("conv_id")).drop("s_conv", "conv_id")
    chunks = chunks.join(_starts(told.withColumn("n_chars", F.col("n_chars") + F.col("n") * F.length(head))), keys)
    mine = F.filter("parts", lambda p: p["own"])
    span = F.transform(mine, lambda p: F.concat_ws(
        ":", (F.col("chunk_start") + p["at"] + F.length(p["head"])).cast("string"),
        (F.col("chunk_start") + p["at"] + F.length(p["head"]) + F.length(p["body"])).cast("string")))
    return chunks.select(
        F.col("conv.conv_id").alias("conv_id"), "perspective", "chunk", "chunk_start", "n_turns",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(span, ",").alias("loss_spans"),
        F.aggregate(mine, F.lit(0).cast("long"), lambda a, p: a + F.length(p["body"])).alias("loss_chars"))


def _starts(told: DataFrame) -> DataFrame:
    """conv, perspective, chunk, chunk_start from the characters of each chunk by role."""
    sizes = told.groupBy("conv", "perspective", "chunk").agg(F.sum("n_chars").alias("n")).withColumn(
        "run", F.floor(F.col("chunk") / F.lit(RUN)).cast("long"))
    who = ["conv", "perspective"]
    runs = sizes.groupBy(*who, "run").agg(F.sum("n").alias("r")).withColumn(
        "before", F.sum("r").over(Window.partitionBy(*who).orderBy("run")) - F.col("r")).drop("r")
    inside = F.sum("n").over(Window.partitionBy(*who, "run").orderBy("chunk")) - F.col("n")
    return sizes.withColumn("inside", inside).join(runs, [*who, "run"]).select(
        *who, "chunk", (F.col("before") + F.col("inside")).alias("chunk_start"))


def query(conversations: DataFrame) -> DataFrame:
    return rotate(conversations)


ORACLE_SQL = f"""
WITH said AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
speakers AS (SELECT DISTINCT conv_id AS s_conv, role AS perspective FROM said WHERE role <> 'system'),
seen AS (
  SELECT *, role = perspective AS own, CAST(floor(turn / {TURNS}.0) AS BIGINT) AS chunk,
         '{OPEN}' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
             ELSE 'user name=' || replace(role, '<|', '< |') END || chr(10) AS head,
         text || '{CLOSE}' AS body
  FROM said JOIN speakers ON conv_id IS NOT DISTINCT FROM s_conv),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, perspective ORDER BY turn, role, text
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM seen)
SELECT conv_id, perspective, chunk, min(begins) AS chunk_start, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY begins) AS rendered,
       coalesce(string_agg((begins + length(head))::VARCHAR || ':' || (begins + length(head) + length(body))::VARCHAR,
                           ',' ORDER BY begins) FILTER (WHERE own), '') AS loss_spans,
       coalesce(sum(length(body)) FILTER (WHERE own), 0)::BIGINT AS loss_chars
FROM placed GROUP BY conv_id, perspective, chunk
"""
