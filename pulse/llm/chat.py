"""Chat formatting with multi-party perspective rotation (operator 4).

For every participant of a dialogue the whole dialogue is rendered once with that
speaker as the assistant, all others as named users and system turns as they are;
the loss spans are the character ranges of the assistant's words with their end
marks, so training touches the chosen speaker only.

A dialogue is first gathered into parts of at most ``PART_TURNS`` consecutive
turn numbers, each text shuffled once; then the parts meet the list of the
dialogue's speakers and are rendered per speaker within the row. Ordinary
dialogues are one part; a dialogue that holds a large share of all rows is many
rows on many tasks, and its text is the parts in order (spans count from the
beginning of their part).

Defined cases: turns are ordered by number, then role, then text, null numbers
last; rows that repeat a turn are turns too; a null or blank role is the speaker
``unknown``; a null text is empty; a row without conv_id is a dialogue of its own;
a dialogue of system turns only has no perspective; marks of the format inside a
text or a name lose their bars; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART_TURNS = 256
#: roles that are rendered in their own name and never take the assistant's place
NON_SPEAKERS = ("system",)
#: fixed values: the marks of the format
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_LAST = 9223372036854775807


def _plain(text: Column) -> Column:
    """Text without the marks of the format."""
    return F.regexp_replace(text, r"<\|(im_start|im_end)\|>", "<$1>")


def gathered(turns: DataFrame, non_speakers: tuple[str, ...] = NON_SPEAKERS, part_turns: int = PART_TURNS) -> DataFrame:
    """Parts of dialogues: ``conv_id, solo, part, turns`` (array of turn, role
    and text, in order) with the ``speakers`` of the dialogue."""
    role = F.btrim(F.coalesce(F.col("role").cast("string"), F.lit("")))
    rows = turns.select(
        F.col("conv_id"), F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)).alias("solo"),
        F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(_LAST)).alias("part"),
        F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(_LAST)).alias("turn"),
                 F.when(role == "", "unknown").otherwise(role).alias("role"),
                 _plain(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")).alias("t"))
    parts = rows.groupBy("conv_id", "solo", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    speakers = (rows.where(~F.col("t.role").isin(*non_speakers)).groupBy("conv_id", "solo")
                .agg(F.sort_array(F.collect_set("t.role")).alias("speakers")).toDF("conv", "own", "speakers"))
    return parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("solo") == F.col("own"))).drop("conv", "own")


def rotated(parts: DataFrame, non_speakers: tuple[str, ...] = NON_SPEAKERS) -> DataFrame:
    """One row per part and speaker: ``conv_id, perspective, part, n_turns,
    n_target_turns, text, loss_spans``.

    ``loss_spans`` is an array of ``start, stop`` character offsets in ``text``.
    """
    me = F.col("perspective")
    name = lambda role: F.regexp_replace(_plain(role), r"[\s<|>]+", "_")

    def head(t: Column) -> Column:
        return F.when(t["role"].isin(*non_speakers), F.concat(F.lit(OPEN), t["role"], F.lit("\n"))).when(
            t["role"] == me, F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), name(t["role"]), F.lit("\n")))

    rows = parts.select("conv_id", "part", F.explode("speakers").alias("perspective"), "turns")
    rows = rows.withColumn("lines", F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), (t["role"] == me).alias("target"))))
    at = F.aggregate(
        "lines", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["head"]) + F.length(x["body"]) + 1).alias("at"),
            F.when(x["target"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(x["head"])).alias("start"),
                (acc["at"] + F.length(x["head"]) + F.length(x["body"])).alias("stop"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return rows.select(
        "conv_id", "perspective", "part", F.size("lines").cast("long").alias("n_turns"),
        F.size(F.filter("lines", lambda x: x["target"])).cast("long").alias("n_target_turns"),
        F.concat(F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "\n"), F.lit("\n")).alias("text"),
        at.alias("loss_spans"))


def rotate(turns: DataFrame, non_speakers: tuple[str, ...] = NON_SPEAKERS, part_turns: int = PART_TURNS) -> DataFrame:
    """Every dialogue from the perspective of each of its participants."""
    return rotated(gathered(turns, non_speakers, part_turns), non_speakers)


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = rotate(turns)
    spans = F.array_join(F.transform("loss_spans", lambda x: F.concat_ws("-", x["start"].cast("string"), x["stop"].cast("string"))), ",")
    return out.select("conv_id", "perspective", "part", "n_turns", "n_target_turns", "text", spans.alias("loss_spans"))


SQL_OP4 = rf"""
WITH r AS (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE -1 END AS solo,
                  coalesce(turn // {PART_TURNS}, {_LAST}) AS part, coalesce(turn, {_LAST}) AS turn,
                  CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE trim(role) END AS role,
                  regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<\1>', 'g') AS body FROM conversations),
s AS (SELECT DISTINCT conv_id, solo, role AS perspective FROM r WHERE role NOT IN ('system')),
l AS (SELECT s.perspective, r.*, row_number() OVER w AS k,
             CASE WHEN r.role = 'system' THEN '{OPEN}system' WHEN r.role = s.perspective THEN '{OPEN}assistant'
                  ELSE '{OPEN}user name=' || regexp_replace(r.role, '[\s<|>]+', '_', 'g') END || chr(10) AS head,
             body || '{CLOSE}' AS line, r.role = s.perspective AS target
      FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.solo = s.solo
      WINDOW w AS (PARTITION BY r.conv_id, r.solo, r.part, s.perspective ORDER BY r.turn, r.role, r.body)),
o AS (SELECT *, coalesce(sum(length(head) + length(line) + 1) OVER (PARTITION BY conv_id, solo, part, perspective ORDER BY k
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM l)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (target) AS n_target_turns,
       string_agg(head || line, chr(10) ORDER BY k) || chr(10) AS text,
       coalesce(string_agg((pos + length(head))::VARCHAR || '-' || (pos + length(head) + length(line))::VARCHAR, ',' ORDER BY k) FILTER (target), '') AS loss_spans
FROM o GROUP BY conv_id, solo, part, perspective
"""
