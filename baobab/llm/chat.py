"""Operator 7: preference formatting of chosen and rejected conversations.

The turns that both conversations of a pair begin with are rendered once, as the
prompt; what follows is rendered per side, and only what the assistant says there
is trained on.  The result has one row per rendered turn with its place in its
part, so a conversation of any length is never one value or one task; a pair
that fits into a row is put together by :func:`assemble`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm.common import cut

#: Fixed value of this format: a turn is HEAD role HEAD_END text END.
HEAD, HEAD_END, END = "<|", "|>\n", "<|end|>\n"
#: Turns that are numbered together; offsets of larger stretches are added up first.
STRETCH = 512


def format_preferences(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``turns``: pair_id, side (`chosen` or `rejected`), turn (long), role, text.

    Per rendered turn: pair_id, part (`prompt`, `chosen` or `rejected`), turn,
    role, rendered, start (characters of the part before it), trained_start and
    trained_length (the stretch of the part that is trained on: text and end
    mark of a ``trained_role`` turn after the prompt; else length 0).

    The prompt is the longest common turn prefix: all turns before the first
    turn number whose rows differ between the sides.  If the conversations are
    equal, all is prompt.  If a side is missing, the prompt is empty.  Equal rows
    of a side are one; different rows of one turn follow each other by role and
    text.  A null turn comes first, a null role is `user`, a null text empty; rows
    with another side or a null pair_id are no part of any pair.  A text cannot
    forge a mark: `<|` in it becomes `< |`.  An empty table gives an empty result;
    other columns are not read."""
    first_turn = -(1 << 62)
    rows = turns.where(F.col("side").isin("chosen", "rejected") & F.col("pair_id").isNotNull()).select(
        "pair_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(first_turn)).alias("turn"),
        F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.col("side") == "chosen").alias("c"),
    )
    # one row per turn row that either side has
    both = cut(
        rows.groupBy("pair_id", "turn", "role", "text").agg(F.max("c").alias("c"), F.max(~F.col("c")).alias("r"))
    )
    split = cut(
        both.where(F.col("c") != F.col("r")).groupBy("pair_id").agg(F.min("turn").alias("first"))
    )
    parted = both.join(split, "pair_id", "left").withColumn(
        "part",
        F.explode(
            F.when(F.col("first").isNull() | (F.col("turn") < F.col("first")), F.array(F.lit("prompt"))).otherwise(
                F.filter(
                    F.array(F.when(F.col("c"), F.lit("chosen")), F.when(F.col("r"), F.lit("rejected"))),
                    lambda x: x.isNotNull(),
                )
            )
        ),
    )
    safe = lambda c: F.replace(F.col(c), F.lit(HEAD), F.lit("< |"))
    head = F.concat(F.lit(HEAD), safe("role"), F.lit(HEAD_END))
    tail = F.concat(safe("text"), F.lit(END))
    rendered = parted.select(
        "pair_id",
        "part",
        "turn",
        "role",
        "text",
        F.concat(head, tail).alias("rendered"),
        F.length(head).cast("long").alias("head"),
        F.length(tail).cast("long").alias("tail"),
        F.floor(F.col("turn") / STRETCH).alias("stretch"),
    )
    size = F.sum(F.col("head") + F.col("tail"))
    # offsets: of the stretch within the part, then of the row within the stretch
    order = W.partitionBy("pair_id", "part").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    before = (
        rendered.groupBy("pair_id", "part", "stretch")
        .agg(size.alias("size"))
        .select("pair_id", "part", "stretch", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("before"))
    )
    order = (
        W.partitionBy("pair_id", "part", "stretch")
        .orderBy("turn", "role", "text")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    within = rendered.withColumn("within", F.coalesce(size.over(order), F.lit(0)))
    placed = within.join(before, ["pair_id", "part", "stretch"]).withColumn("start", F.col("before") + F.col("within"))
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return placed.select(
        "pair_id",
        "part",
        F.when(F.col("turn") != first_turn, F.col("turn")).alias("turn"),
        "role",
        "rendered",
        "start",
        (F.col("start") + F.col("head")).alias("trained_start"),
        F.when(trained, F.col("tail")).otherwise(F.lit(0)).cast("long").alias("trained_length"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected, and for the last two the spans
    (start, length) that are trained on.  For pairs that fit into a row."""
    of = {}
    for part in ("prompt", "chosen", "rejected"):
        mine = F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("start", "rendered"))))
        of[part] = F.array_join(F.transform(mine, lambda x: x["rendered"]), "")
        if part != "prompt":
            spans = F.when(
                (F.col("part") == part) & (F.col("trained_length") > 0),
                F.struct(F.col("trained_start").alias("start"), F.col("trained_length").alias("length")),
            )
            of[f"{part}_spans"] = F.sort_array(F.collect_list(spans))
    return segments.groupBy("pair_id").agg(*(c.alias(name) for name, c in of.items()))


def preference_turns(conversations: DataFrame) -> DataFrame:
    """Stand-in input from the table of conversations: each one is chosen; the
    rejected one breaks off in the middle of its last answer.

    Conversations without an answer have equal sides."""
    last = (
        conversations.where("role = 'assistant'")
        .groupBy(F.col("conv_id").alias("last_id"))
        .agg(F.max("turn").alias("last_turn"))
    )
    rows = conversations.join(last, F.col("conv_id") == F.col("last_id"), "left")
    text = F.when(
        F.col("turn") == F.col("last_turn"), F.substring("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    ).otherwise(F.col("text"))
    chosen = conversations.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    rejected = rows.where(F.col("last_turn").isNull() | (F.col("turn") <= F.col("last_turn"))).select(
        F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn", "role", text.alias("text")
    )
    return chosen.unionByName(rejected)


#: DuckDB SQL for the query's rows.
SQL = r"""
WITH latest AS (SELECT conv_id, max(turn) AS last_turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
turns AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM conversations
  UNION ALL
  SELECT c.conv_id, 'rejected', c.turn, c.role,
         CASE WHEN c.turn = l.last_turn THEN substr(c.text, 1, CAST(floor(length(c.text) / 2) AS BIGINT)) ELSE c.text END
  FROM conversations c LEFT JOIN latest l ON l.conv_id = c.conv_id
  WHERE l.last_turn IS NULL OR c.turn <= l.last_turn),
both_sides AS (
  SELECT pair_id, coalesce(turn, -4611686018427387904) AS turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         bool_or(side = 'chosen') AS c, bool_or(side = 'rejected') AS r
  FROM turns WHERE pair_id IS NOT NULL GROUP BY ALL),
split AS (SELECT pair_id, min(turn) AS first FROM both_sides WHERE c <> r GROUP BY pair_id),
parted AS (
  SELECT b.*, 'prompt' AS part FROM both_sides b LEFT JOIN split s ON s.pair_id = b.pair_id
  WHERE s.first IS NULL OR b.turn < s.first
  UNION ALL SELECT b.*, 'chosen' FROM both_sides b JOIN split s ON s.pair_id = b.pair_id WHERE b.turn >= s.first AND c
  UNION ALL SELECT b.*, 'rejected' FROM both_sides b JOIN split s ON s.pair_id = b.pair_id WHERE b.turn >= s.first AND r),
made AS (
  SELECT *, '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head,
         replace(text, '<|', '< |') || '<|end|>' || chr(10) AS tail FROM parted),
placed AS (
  SELECT *, CAST(coalesce(sum(length(head) + length(tail)) OVER (
    PARTITION BY pair_id, part ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM made)
SELECT pair_id, part, CASE WHEN turn <> -4611686018427387904 THEN turn END AS turn, role, head || tail AS rendered, start,
       CAST(start + length(head) AS BIGINT) AS trained_start,
       CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(tail) ELSE 0 END AS BIGINT) AS trained_length
FROM placed
"""
