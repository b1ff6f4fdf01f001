"""Chat formatting: logged snapshots of growing conversations collapse to the longest, which are rendered.

Every turn of a conversation gets a rolling hash of the turns up to it: a running sum of hashes that hold each
turn's place, in 128 bits. A conversation whose hash equals that of a shorter stretch of another is a snapshot of
it; an anti-join takes those away, and of equal ones the smallest conv_id stays. Only what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.tables import save


def _turns(chats: DataFrame) -> DataFrame:
    """(conv_id, i, n, role, text, p1, p2): distinct turns in order with the hashes up to each."""
    rows = chats.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    own = Window.partitionBy("conv_id")
    order = own.orderBy("turn", "role", "text")
    rows = rows.repartition("conv_id").distinct().withColumn("i", F.row_number().over(order)).withColumn("n", F.count("*").over(own))
    hashes = {"p1": F.xxhash64("i", "role", "text"), "p2": F.xxhash64("text", "role", "i", F.lit(1))}
    sums = {k: F.sum(v.cast("decimal(20,0)")).over(order.rowsBetween(Window.unboundedPreceding, 0)) for k, v in hashes.items()}
    return rows.withColumns(sums).drop("turn")


def maximal(chats: DataFrame) -> DataFrame:
    """(conv_id, i, n, role, text) of the conversations that are no snapshot of another."""
    turns = _turns(chats)
    marks = save(turns.select("conv_id", "i", "n", "p1", "p2"))
    whole = marks.where("i = n").groupBy("n", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    inner = marks.where("i < n").select(F.col("i").cast("long").alias("n"), "p1", "p2").distinct()
    return turns.join(whole.join(inner, ["n", "p1", "p2"], "left_anti").select("conv_id"), "conv_id", "left_semi")


def rendered(chats: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text) of every maximal conversation.

    Turns go by turn, role and text; exactly repeated ones count once, a null turn comes first, a null role is
    "unknown", a null text empty; rows without conv_id are left out and other columns ignored. Marks within a
    turn's role and text are broken by a space, and a role's line breaks become spaces, so neither can pose as a turn. A conversation that equals the beginning of
    another, or another with a smaller conv_id, is not rendered.
    """
    role = F.translate(F.replace("role", F.lit("<|"), F.lit("< |")), "\r\n", "  ")
    turn = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.replace("text", F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>\n"))
    rows = maximal(chats).select("conv_id", "n", F.struct("i", turn.alias("shown")).alias("turn"))
    parts = F.transform(F.array_sort(F.collect_list("turn")), lambda t: t["shown"])
    return rows.groupBy("conv_id").agg(F.first("n").alias("n_turns"), F.array_join(parts, "").alias("text"))


ORACLE = """
WITH turns AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
chats AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS l FROM turns GROUP BY conv_id),
inner_parts AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM chats)),
kept AS (SELECT min(conv_id) AS conv_id, l FROM chats WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.l = chats.l) GROUP BY l)
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns,
    array_to_string(list_transform(l, lambda t: '<|im_start|>' || translate(replace(t.role, '<|', '< |'), chr(13) || chr(10), '  ') || chr(10) || replace(t.text, '<|', '< |') || '<|im_end|>' || chr(10)), '') AS text
FROM kept
"""
