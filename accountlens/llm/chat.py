"""Preference formatting: one prompt and two masked completions for each pair of conversations.

A pair is a chosen and a rejected conversation. Their longest common turn prefix (same role and text, from the first turn
on) is rendered once, as the prompt. What is left of each is a completion, with the spans (character offsets in the
completion) that a loss applies to: the assistant's turns and the mark that ends them.

All is done turn by turn in DataFrame operations: the prefix is the first place where the two sides differ, offsets are
running sums. A conversation is one row only in the result.

Pairs come from two sources:

* ``alternatives``: conversations that open with the same turn. Within an opening they are ordered by the length of the
  assistant's text, longest first, then by id, and paired one after the other: the longer is the chosen one. An odd
  one out has no partner. A very common opening is numbered over many tasks, not in one.
* ``stale replies``: a conversation with two or more assistant turns, up to the last of them, against itself with that
  reply replaced by the one before: an answer to an earlier question.

Defined cases: a null text is empty, a null role is ``unknown``; rows without a conversation or a turn number stand nowhere
and are left out; equal rows count once; turns with one number are ordered by role, then text; marks in a text are
broken up so that they cannot pass for real ones. Equal sides give two empty completions. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import read_table, written

BEGIN, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
#: The part of ``END`` that is learnt with a turn.
LEARNT_END = "<|im_end|>"
PAIR = ["kind", "chosen_id", "rejected_id"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): the turns of each conversation, numbered from 1."""
    rows = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.distinct().select("conv_id", F.row_number().over(order).alias("pos"), "role", "text")


def alternatives(turns: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id) of conversations with the same first turn."""
    opening = turns.filter("pos = 1").select(
        "conv_id", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "role", "text").alias("k2"))
    length = turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.sum(F.length("text")).alias("length"))
    shared = opening.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = (opening.join(shared, ["k1", "k2"]).join(length, "conv_id", "left")
              .select("k1", "k2", F.coalesce(-F.col("length"), F.lit(0)).alias("shortness"), "conv_id"))
    # Contiguous ranges of the order; one opening may span many. The range goes with the rows, so that a retry can't move them.
    ranges = written(ranked.repartitionByRange("k1", "k2", "shortness", "conv_id")
                     .withColumn("range", F.spark_partition_id()), "chat-ranges")
    inside = F.row_number().over(Window.partitionBy("range", "k1", "k2").orderBy("shortness", "conv_id"))
    before = Window.partitionBy("k1", "k2").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.groupBy("k1", "k2", "range").agg(F.count("*").alias("n"))
               .select("k1", "k2", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    places = (ranges.withColumn("inside", inside).join(offsets, ["k1", "k2", "range"])
              .select("k1", "k2", "conv_id", (F.col("inside") + F.col("earlier") - 1).alias("place")))
    first = F.col("place") % 2 == 0
    return (places.groupBy("k1", "k2", F.floor(F.col("place") / 2).alias("pair"))
            .agg(F.max(F.when(first, F.col("conv_id"))).alias("chosen_id"),
                 F.max(F.when(~first, F.col("conv_id"))).alias("rejected_id"))
            .filter("rejected_id IS NOT NULL").select("chosen_id", "rejected_id"))


def _alternative_sides(turns: DataFrame) -> DataFrame:
    pairs = alternatives(turns)
    side = F.explode(F.array(F.struct(F.col("chosen_id").alias("conv_id"), F.lit("chosen").alias("side")),
                             F.struct(F.col("rejected_id").alias("conv_id"), F.lit("rejected").alias("side")))).alias("s")
    return pairs.select("chosen_id", "rejected_id", side).select("chosen_id", "rejected_id", "s.*").join(turns, "conv_id").select(
        F.lit("alternatives").alias("kind"), "chosen_id", "rejected_id", "side", "pos", "role", "text")


def _stale_sides(turns: DataFrame) -> DataFrame:
    replies = turns.filter("role = 'assistant'")
    earlier = F.lag("text").over(Window.partitionBy("conv_id").orderBy("pos"))
    last = replies.withColumn("earlier", earlier).groupBy("conv_id").agg(
        F.max("pos").alias("last"), F.max_by("earlier", "pos").alias("earlier")).filter("earlier IS NOT NULL")
    stale = F.when(F.col("pos") == F.col("last"), F.col("earlier")).otherwise(F.col("text"))
    side = F.explode(F.array(F.struct(F.lit("chosen").alias("side"), F.col("text")),
                             F.struct(F.lit("rejected").alias("side"), stale.alias("text")))).alias("s")
    return turns.join(last, "conv_id").filter("pos <= last").select("conv_id", "pos", "role", side).select(
        F.lit("stale reply").alias("kind"), F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"),
        "s.side", "pos", "role", "s.text")


def _broken_up(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def format_pairs(sides: DataFrame) -> DataFrame:
    """``sides``: the turns (pos, role, text) of each side of each pair. One row for each pair."""
    places = sides.groupBy(*PAIR, "pos").agg(
        ((F.count("*") == 2) & (F.min("role") == F.max("role")) & (F.min("text") == F.max("text"))).alias("same"))
    parting = places.groupBy(*PAIR).agg(
        F.coalesce(F.min(F.when(~F.col("same"), F.col("pos"))), F.max("pos") + 1).alias("parting"))
    common = F.col("pos") < F.col("parting")
    rows = (sides.join(parting, PAIR).filter(~common | (F.col("side") == "chosen"))
            .withColumn("part", F.when(common, "prompt").otherwise(F.col("side")))
            .withColumn("head", F.concat(F.lit(BEGIN), _broken_up(F.col("role")), F.lit(MIDDLE)))
            .withColumn("body", _broken_up(F.col("text")))
            .withColumn("piece", F.concat("head", "body", F.lit(END))))
    earlier = Window.partitionBy(*PAIR, "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0)) + F.length("head"))
    learnt = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    span = F.when(learnt, F.concat_ws(":", F.col("start"), F.col("start") + F.length("body") + len(LEARNT_END)))

    def text_of(part: str) -> Column:
        mine = F.collect_list(F.when(F.col("part") == part, F.struct("pos", "piece")))
        return F.array_join(F.transform(F.array_sort(mine), lambda x: x["piece"]), "").alias(part)

    def mask_of(part: str) -> Column:
        mine = F.collect_list(F.when((F.col("part") == part) & learnt, F.struct("pos", span.alias("span"))))
        return F.array_join(F.transform(F.array_sort(mine), lambda x: x["span"]), ",").alias(f"{part}_mask")

    return rows.groupBy(*PAIR).agg(
        F.sum((F.col("part") == "prompt").cast("long")).alias("n_prompt_turns"),
        text_of("prompt"), text_of("chosen"), mask_of("chosen"), text_of("rejected"), mask_of("rejected"))


def preference_pairs(conversations: DataFrame) -> DataFrame:
    turns = written(numbered(conversations), "chat-turns")
    return format_pairs(_alternative_sides(turns).unionByName(_stale_sides(turns)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_pairs(read_table(spark, sf_dir, "conversations"))


_CLEAN = "replace({}, '<|', '< |')"

STATEMENT = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos, role, text
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
openings AS (
  SELECT t.conv_id, t.role, t.text, row_number() OVER (
           PARTITION BY t.role, t.text ORDER BY coalesce(l.chars, 0) DESC, t.conv_id) - 1 AS place
  FROM turns t LEFT JOIN (SELECT conv_id, sum(length(text)) AS chars FROM turns WHERE role = 'assistant' GROUP BY 1) l
    ON l.conv_id = t.conv_id
  WHERE t.pos = 1),
alternatives AS (
  SELECT a.conv_id AS chosen_id, b.conv_id AS rejected_id FROM openings a
  JOIN openings b ON b.role = a.role AND b.text = a.text AND b.place = a.place + 1
  WHERE a.place % 2 = 0),
replies AS (
  SELECT conv_id, pos, lag(text) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier,
         row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) AS from_end
  FROM turns WHERE role = 'assistant'),
stale AS (SELECT conv_id, pos AS last, earlier FROM replies WHERE from_end = 1 AND earlier IS NOT NULL),
sides AS (
  SELECT 'alternatives' AS kind, chosen_id, rejected_id, 'chosen' AS side, pos, role, text
  FROM alternatives JOIN turns ON conv_id = chosen_id
  UNION ALL SELECT 'alternatives', chosen_id, rejected_id, 'rejected', pos, role, text
  FROM alternatives JOIN turns ON conv_id = rejected_id
  UNION ALL SELECT 'stale reply', conv_id, conv_id, 'chosen', pos, role, text FROM turns JOIN stale USING (conv_id) WHERE pos <= last
  UNION ALL SELECT 'stale reply', conv_id, conv_id, 'rejected', pos, role, CASE WHEN pos = last THEN earlier ELSE text END
  FROM turns JOIN stale USING (conv_id) WHERE pos <= last),
partings AS (
  SELECT kind, chosen_id, rejected_id, coalesce(min(pos) FILTER (NOT same), max(pos) + 1) AS parting
  FROM (SELECT kind, chosen_id, rejected_id, pos, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS same
        FROM sides GROUP BY ALL)
  GROUP BY ALL),
pieces AS (
  SELECT s.kind, s.chosen_id, s.rejected_id, CASE WHEN s.pos < p.parting THEN 'prompt' ELSE s.side END AS part, s.pos,
         s.role, '{BEGIN}' || {_CLEAN.format("s.role")} || chr(10) AS head, {_CLEAN.format("s.text")} AS body
  FROM sides s JOIN partings p ON p.kind = s.kind AND p.chosen_id = s.chosen_id AND p.rejected_id = s.rejected_id
  WHERE s.pos >= p.parting OR s.side = 'chosen'),
placed AS (
  SELECT *, head || body || '{LEARNT_END}' || chr(10) AS piece,
         length(head) + coalesce(sum(length(head) + length(body) + {len(END)}) OVER (
           PARTITION BY kind, chosen_id, rejected_id, part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pieces)
SELECT kind, chosen_id, rejected_id, count(*) FILTER (part = 'prompt') AS n_prompt_turns,
       coalesce(string_agg(piece, '' ORDER BY pos) FILTER (part = 'prompt'), '') AS prompt,
       coalesce(string_agg(piece, '' ORDER BY pos) FILTER (part = 'chosen'), '') AS chosen,
       coalesce(string_agg(start || ':' || (start + length(body) + {len(LEARNT_END)}), ',' ORDER BY pos)
         FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(piece, '' ORDER BY pos) FILTER (part = 'rejected'), '') AS rejected,
       coalesce(string_agg(start || ':' || (start + length(body) + {len(LEARNT_END)}), ',' ORDER BY pos)
         FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY kind, chosen_id, rejected_id
"""
