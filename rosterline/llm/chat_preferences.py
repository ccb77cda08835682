"""Preference pairs as one prompt and two masked completions.

A chosen and a rejected conversation agree up to some turn. Turns before the first difference are rendered once, as the
prompt; what follows is rendered for each side as a completion, with the character spans of its assistant turns, which
are those a model learns from. Rendering puts each turn between ``<|im_start|>role`` and ``<|im_end|>``.

Turns are compared by (pair, turn, role, text) in one aggregation, so equal texts and hot first turns are nothing
special, and the first difference of a pair is a folded minimum. Only what makes up one training record, the turns
of one pair, is gathered, to join them to its strings.

Rows: a NULL pair or turn takes no part; a NULL role or text is compared as itself and rendered as empty; repeated
rows count once; rows that share a turn number are ordered by role and text; a pair with one side only has an
empty prompt and an empty completion for the other side; equal sides give a whole prompt and two empty completions; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterline.llm.common import prepare

# Fixed values of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def segments(turns: DataFrame) -> DataFrame:
    """``turns``: pair_id, chosen (boolean), turn, role, text. One row per turn of the prompt and of each completion.

    Columns pair_id, part (``prompt``, ``chosen`` or ``rejected``), turn, role, text, learned.
    """
    used = turns.where("pair_id IS NOT NULL AND turn IS NOT NULL AND chosen IS NOT NULL")
    sides = used.groupBy("pair_id", "turn", "role", "text").agg(
        F.max("chosen").alias("in_chosen"), F.max(~F.col("chosen")).alias("in_rejected")
    )
    both = F.col("in_chosen") & F.col("in_rejected")
    differs = sides.groupBy("pair_id").agg(F.min(F.when(~both, F.col("turn"))).alias("differs"))
    known = sides.join(differs, "pair_id")
    before = F.col("differs").isNull() | (F.col("turn") < F.col("differs"))
    parts = F.when(before, F.array(F.lit("prompt"))).otherwise(
        F.array_compact(F.array(F.when(F.col("in_chosen"), "chosen"), F.when(F.col("in_rejected"), "rejected")))
    )
    found = known.select("pair_id", F.explode(parts).alias("part"), "turn", "role", "text")
    return found.withColumn("learned", F.coalesce((F.col("part") != "prompt") & (F.col("role") == LEARNED_ROLE), F.lit(False)))


def rendered() -> Column:
    return F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE))


def preferences(turns: DataFrame) -> DataFrame:
    """One row per pair: n_prompt_turns, prompt, and for each side its completion and the spans to learn from.

    Spans are ``start-end`` in characters of the completion, comma-separated; they cover an assistant's text and its end mark.
    """
    prepare(turns.sparkSession)
    in_part = Window.partitionBy("pair_id", "part").orderBy("turn", F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    lines = segments(turns).withColumn("shown", rendered()).withColumn("size", F.length("shown"))
    lines = lines.withColumn("end", F.sum("size").over(in_part)).withColumn("place", F.row_number().over(in_part))
    start = F.col("end") - F.col("size") + len(OPEN) + F.length(F.coalesce("role", F.lit(""))) + 1
    span = F.when(F.col("learned"), F.concat_ws("-", start.cast("string"), (F.col("end") - 1).cast("string")))

    def gathered(part: str, value: Column) -> Column:
        items = F.sort_array(F.collect_list(F.when(F.col("part") == part, F.struct("place", value.alias("v")))))
        return F.transform(items, lambda x: x["v"])

    pairs = lines.groupBy("pair_id").agg(
        F.count(F.when(F.col("part") == "prompt", 1)).alias("n_prompt_turns"),
        *[F.array_join(gathered(part, F.col("shown")), "").alias(part) for part in ("prompt", "chosen", "rejected")],
        *[F.array_join(F.array_compact(gathered(part, span)), ",").alias(f"{part}_spans") for part in ("chosen", "rejected")],
    )
    return pairs


def alternatives(conversations: DataFrame) -> DataFrame:
    """Preference turns derived from conversations (conv_id, turn, role, text).

    The chosen side is the conversation as it is. The rejected side has another last assistant turn: that of the
    conversation whose id differs in the last bit, or an empty one.
    """
    turns = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "role", "text").distinct()
    last = turns.where(F.col("role") == LEARNED_ROLE).groupBy("conv_id").agg(F.max("turn").alias("last"))
    ending = turns.join(last, "conv_id").where((F.col("turn") == F.col("last")) & (F.col("role") == LEARNED_ROLE))
    ending = ending.groupBy("conv_id").agg(F.min("text").alias("other"))
    swapped = ending.select((F.col("conv_id").bitwiseXOR(F.lit(1))).alias("conv_id"), "other")
    known = turns.join(last, "conv_id", "left").join(swapped, "conv_id", "left")
    replaced = F.coalesce((F.col("turn") == F.col("last")) & (F.col("role") == LEARNED_ROLE), F.lit(False))
    rejected = F.when(replaced, F.coalesce("other", F.lit(""))).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit(True).alias("chosen"), F.col("text").alias("text")), F.struct(F.lit(False).alias("chosen"), rejected.alias("text")))
    return known.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("x")).select("pair_id", "turn", "role", "x.chosen", "x.text")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences(alternatives(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


ORACLE_SQL = """WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
final AS (SELECT conv_id, max(turn) AS last FROM t WHERE role = 'assistant' GROUP BY conv_id),
ending AS (SELECT conv_id, min(text) AS other FROM t JOIN final USING (conv_id) WHERE turn = last AND role = 'assistant' GROUP BY conv_id),
k AS (SELECT t.*, coalesce(turn = last AND role = 'assistant', false) AS swapped, e.other FROM t LEFT JOIN final USING (conv_id) LEFT JOIN ending e ON e.conv_id = xor(t.conv_id, 1)),
sides AS (SELECT conv_id, turn, role, text, true AS chosen FROM k UNION ALL
  SELECT conv_id, turn, role, CASE WHEN swapped THEN coalesce(other, '') ELSE text END, false FROM k),
folded AS (SELECT conv_id, turn, role, text, bool_or(chosen) AS c, bool_or(NOT chosen) AS r FROM sides GROUP BY ALL),
d AS (SELECT conv_id, min(CASE WHEN NOT (c AND r) THEN turn END) AS differs FROM folded GROUP BY conv_id),
parts AS (
  SELECT conv_id, 'prompt' AS part, turn, role, text FROM folded JOIN d USING (conv_id) WHERE differs IS NULL OR turn < differs UNION ALL
  SELECT conv_id, 'chosen', turn, role, text FROM folded JOIN d USING (conv_id) WHERE turn >= differs AND c UNION ALL
  SELECT conv_id, 'rejected', turn, role, text FROM folded JOIN d USING (conv_id) WHERE turn >= differs AND r),
shown AS (SELECT *, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS s FROM parts),
spans AS (SELECT *, sum(length(s)) OVER (PARTITION BY conv_id, part ORDER BY turn, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING) AS e,
  row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS place FROM shown),
marked AS (SELECT *, CASE WHEN role = 'assistant' THEN CAST(e - length(s) + 13 + length(role) AS VARCHAR) || '-' || CAST(e - 1 AS VARCHAR) END AS span FROM spans)
SELECT conv_id AS pair_id, count(*) FILTER (part = 'prompt') AS n_prompt_turns,
  coalesce(string_agg(s, '' ORDER BY place) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(s, '' ORDER BY place) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(s, '' ORDER BY place) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY place) FILTER (part = 'chosen'), '') AS chosen_spans,
  coalesce(string_agg(span, ',' ORDER BY place) FILTER (part = 'rejected'), '') AS rejected_spans
FROM marked GROUP BY conv_id"""
