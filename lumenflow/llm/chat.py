"""Multi-party chat formatting: every participant's view of a dialogue, in DataFrame functions only.

For each participant the dialogue is rendered with that speaker as the assistant and all others
as named users; the mask tells which characters the assistant is trained on. The result has one
row per view and turn, with its rendered text and its place in the view, so a conversation of any
length is spread over tasks: places are running sums over stretches of turns and then over the
stretches, and no task needs a whole conversation.

Defined cases: turns come by number, then role, then text (nulls first); repeated rows are turns of
their own; a null text is empty; a null role is a participant of its own, shown as "unknown"; an opening
mark inside a text or a name is set apart by a space, so that no text can pose as a turn; rows without
conv_id form one conversation; rows without turn come first; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers in a stretch that is summed as one.
STRETCH = 512
#: Marks around a rendered turn.
OPEN, NAME_END, CLOSE, APART = "<|", "|>\n", "\n", "< |"


def perspectives(turns: DataFrame, assistant: str = "assistant", unknown: str = "unknown") -> DataFrame:
    """conv_id, perspective, position (from 0), speaker, rendered, char_start, char_end, loss_start, loss_end.

    The characters loss_start to loss_end of the view (the speaker's own words) are trained on; both
    are null on turns of others.
    """
    safe = lambda c, other: F.replace(F.coalesce(c, F.lit(other)), F.lit(OPEN), F.lit(APART))
    said = turns.select("conv_id", "turn", F.col("role").alias("speaker"), safe(F.col("text"), "").alias("text"))
    said = said.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(2**62)).cast("long")))
    # lengths don't depend on the view but for the name shown, so sums are per view
    cast = said.groupBy("conv_id", "speaker").agg(F.count("*").alias("n")).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective"))
    views = said.join(cast, said["conv_id"].eqNullSafe(cast["c"])).drop("c")
    own = F.col("speaker").eqNullSafe(F.col("perspective"))
    head = F.concat(F.lit(OPEN), F.when(own, F.lit(assistant)).otherwise(F.concat(F.lit("user:"), safe(F.col("speaker"), unknown))), F.lit(NAME_END))
    shown = views.withColumn("own", own).withColumn("head", head).withColumn("rendered", F.concat("head", "text", F.lit(CLOSE))).withColumn("size", F.length("rendered").cast("long"))
    view = ["conv_id", "perspective"]
    in_stretch = Window.partitionBy(*view, "stretch").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("speaker"), "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = shown.withColumn("sum", F.sum("size").over(in_stretch)).withColumn("rank", F.row_number().over(in_stretch))
    totals = shown.groupBy(*view, "stretch").agg(F.sum("size").alias("stretch_size"), F.count("*").alias("stretch_turns"))
    before = Window.partitionBy(*view).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*(F.col(c).alias(f"o_{c}") for c in (*view, "stretch")), F.coalesce(F.sum("stretch_size").over(before), F.lit(0)).alias("chars"), F.coalesce(F.sum("stretch_turns").over(before), F.lit(0)).alias("turns"))
    placed = local.join(offsets, F.col("conv_id").eqNullSafe(F.col("o_conv_id")) & F.col("perspective").eqNullSafe(F.col("o_perspective")) & (F.col("stretch") == F.col("o_stretch")))
    end = F.col("chars") + F.col("sum")
    start = end - F.col("size")
    return placed.select(
        "conv_id", "perspective", (F.col("turns") + F.col("rank") - 1).cast("long").alias("position"), "speaker", "rendered",
        start.cast("long").alias("char_start"), end.cast("long").alias("char_end"),
        F.when(F.col("own"), start + F.length("head")).cast("long").alias("loss_start"), F.when(F.col("own"), end - len(CLOSE)).cast("long").alias("loss_end"),
    )


SQL = f"""
WITH s AS (SELECT conv_id, turn, role AS speaker, replace(coalesce(text, ''), '{OPEN}', '{APART}') AS text FROM conversations),
v AS (SELECT s.*, c.perspective FROM s JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM s) c ON s.conv_id IS NOT DISTINCT FROM c.conv_id),
h AS (SELECT *, '{OPEN}' || CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN 'assistant' ELSE 'user:' || replace(coalesce(speaker, 'unknown'), '{OPEN}', '{APART}') END || '|>' || chr(10) AS head FROM v),
r AS (SELECT *, head || text || chr(10) AS rendered FROM h),
p AS (SELECT *, length(rendered) AS size, sum(length(rendered)) OVER w AS e, row_number() OVER w AS k FROM r
      WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, CAST(k - 1 AS BIGINT) AS position, speaker, rendered, CAST(e - size AS BIGINT) AS char_start, CAST(e AS BIGINT) AS char_end,
  CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN CAST(e - size + length(head) AS BIGINT) END AS loss_start,
  CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN CAST(e - 1 AS BIGINT) END AS loss_end FROM p"""
