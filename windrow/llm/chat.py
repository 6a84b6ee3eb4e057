"""Multi-party perspective rotation of dialogues, in DataFrame operations only.

For every participant of a conversation the whole dialogue is rendered once with that speaker as
the assistant and every other speaker as a named user; only the assistant's own words are trained
on. The result has one row per turn and perspective, never a whole conversation in one value, so a
conversation may have any number of turns. Rows order by (turn, part) within a perspective.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.joins import attach

NARRATOR = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"    # fixed values of a public chat template


def _name(role):
    """Letters, digits, ``_`` and ``-``; others become ``_``; unnamed speakers are ``unknown``."""
    tidy = F.regexp_replace(role, r"[^\p{L}\p{N}_-]", "_")
    return F.when(role.isNull() | (role == ""), F.lit("unknown")).otherwise(tidy)


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", narrator: str = NARRATOR) -> DataFrame:
    """conv_id, perspective, turn, role, name, header, body, footer, segment, mask, mask_from, mask_to.

    ``segment`` is header + body + footer; ``mask`` is true where the perspective's speaker has the
    turn, and then [mask_from, mask_to) are the code points of the segment to train on, body and
    footer; otherwise both are 0. A narrator's turns stay system turns and make no perspective.
    Markers inside a text are broken up, so that a text cannot forge a turn. A null text is empty,
    a null or empty role speaks as ``unknown``, and rows with a null conversation id are one
    conversation of that id. Repeated turns are rendered each. A conversation of narrators only
    gives no rows; an empty table gives an empty one.
    """
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        _name(F.col(role_col).cast("string")).alias("speaker"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    safe = F.replace(F.replace("text", F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    speakers = (rows.filter(F.col("speaker") != narrator)
                .groupBy("conv_id").agg(F.sort_array(F.collect_set("speaker")).alias("speakers")))
    # one row per conversation, whose list has its distinct speakers
    each = attach(rows.withColumn("body", safe).drop("text"), speakers, ["conv_id"],
                  spread=["turn", "body"], nulls_match=True).withColumn(
        "perspective", F.explode("speakers"))
    own = F.col("speaker") == F.col("perspective")
    role = (F.when(F.col("speaker") == narrator, F.lit("system"))
            .when(own, F.lit("assistant")).otherwise(F.lit("user")))
    name = F.when(role == "user", F.col("speaker"))
    header = F.concat(F.lit(OPEN), role,
                      F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    footer = F.lit(CLOSE + "\n")
    return each.select(
        "conv_id", "perspective", "turn", role.alias("role"), name.alias("name"),
        header.alias("header"), "body", footer.alias("footer"),
        F.concat(header, F.col("body"), footer).alias("segment"), own.alias("mask"),
        F.when(own, F.char_length(header)).otherwise(0).cast("bigint").alias("mask_from"),
        F.when(own, F.char_length(F.concat(header, F.col("body"), F.lit(CLOSE))))
        .otherwise(0).cast("bigint").alias("mask_to"))


ROTATE_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn,
         CASE WHEN role IS NULL OR role = '' THEN 'unknown'
              ELSE regexp_replace(role, '[^\\p{{L}}\\p{{N}}_-]', '_', 'g') END AS speaker,
         replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS body
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM rows WHERE speaker <> '{NARRATOR}'),
made AS (
  SELECT r.conv_id, perspective, turn, body, speaker = perspective AS mask,
         CASE WHEN speaker = '{NARRATOR}' THEN 'system' WHEN speaker = perspective THEN 'assistant'
              ELSE 'user' END AS role,
         speaker
  FROM rows r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
named AS (
  SELECT *, CASE WHEN role = 'user' THEN speaker END AS name,
         '{OPEN}' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END
           || chr(10) AS header
  FROM made)
SELECT conv_id, perspective, turn, role, name, header, body, '{CLOSE}' || chr(10) AS footer,
       header || body || '{CLOSE}' || chr(10) AS segment, mask,
       CASE WHEN mask THEN length(header) ELSE 0 END AS mask_from,
       CASE WHEN mask THEN length(header) + length(body) + {len(CLOSE)} ELSE 0 END AS mask_to
FROM named
"""
