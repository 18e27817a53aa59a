"""Preference formatting: prompt and paired, masked completions of chosen and rejected conversations.

The longest common prefix of turns (equal role and text) is rendered once as the prompt; what follows
in each conversation is a completion. A completion's mask lists its parts in order with their length
in characters and whether they are trained on: the texts of assistant turns with their end mark.

DataFrame functions only; a conversation is one row, as its rendered text is.

Cases: null roles count as ``unknown`` and null texts as empty; an empty or null conversation of a
pair gives status ``unpaired`` and null texts; equal conversations give ``identical``, and if one is a
prefix of the other, ``empty`` (the prompt then holds all of the shorter one); rows with null conv_id
belong to no conversation; repeated rows count once; an empty table gives none; other columns don't
matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.text import saved

RANGE_ROWS = 1 << 20
BEGIN, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns, an array of (role, text) in the order of turn, role, text; null first."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    sets = turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.collect_set(turn).alias("turns"))
    return sets.select("conv_id", F.transform(F.sort_array("turns"), lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def last_of_role(turns: Column, role: str) -> Column:
    """Place (from 1) of the role's last turn; 0 if it has none."""
    back = F.array_position(F.reverse(F.transform(turns, lambda t: t["role"] == role)), F.lit(True))
    return F.when(back > 0, F.size(turns) - back + 1).otherwise(0).cast("int")


def next_reply(replies: DataFrame) -> DataFrame:
    """conv_id and ``other``, the reply of the next larger conv_id (null for the largest). ``replies``: a row
    per conversation, conv_id and reply.

    Ids are cut into as many ranges as a shuffle has tasks, or more, of at most about RANGE_ROWS
    conversations, whatever gaps they have; within a range the
    next row has it, and the last one's is the first of the next range, from a table of one row a range."""
    tasks = int(replies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(tasks, -(-replies.count() // RANGE_ROWS))
    cuts = replies.approxQuantile("conv_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    cuts = F.array(*map(F.lit, sorted(set(cuts)))).cast("array<double>")
    rows = replies.withColumn("range", F.size(F.filter(cuts, lambda c: c < F.col("conv_id").cast("double"))))
    inside = F.lead("reply").over(Window.partitionBy("range").orderBy("conv_id"))
    first = rows.groupBy("range").agg(F.min_by("reply", "conv_id").alias("first"))
    after = first.select("range", F.lead("first").over(Window.orderBy("range")).alias("after"))
    rows = rows.withColumn("inside", inside).join(after, "range")
    return rows.select("conv_id", F.coalesce("inside", "after").alias("other"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations, one each: chosen is it up to its last assistant turn (what follows that
    has no reply and is left out), rejected the same with that turn replaced by the last one of the next
    conversation that has one. Both are null for a conversation without an assistant turn, rejected for the
    last."""
    convs = saved(conversations(turns).withColumn("at", last_of_role(F.col("turns"), TRAINED_ROLE)))
    replied = convs.where("at > 0").select("conv_id", F.slice("turns", F.lit(1), F.col("at")).alias("chosen"))
    reply = F.element_at("chosen", -1)
    pairs = replied.join(next_reply(replied.select("conv_id", reply.alias("reply"))), "conv_id")
    before = F.slice("chosen", F.lit(1), F.size("chosen") - 1)
    rejected = F.when(F.col("other").isNotNull(), F.concat(before, F.array("other")))
    none = F.lit(None).cast("array<struct<role:string,text:string>>")
    return pairs.select(F.col("conv_id").alias("pair_id"), "chosen", rejected.alias("rejected")).union(
        convs.where("at = 0").select("conv_id", none, none))


def _head(t: Column) -> Column:
    return F.concat(F.lit(BEGIN), t["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(END + "\n"))), "")


def mask(turns: Column) -> Column:
    """(chars, train) of the parts of the rendered turns: head, text with end mark, line end."""
    def part(chars: Column, train: Column) -> Column:
        return F.struct(chars.cast("int").alias("chars"), train.alias("train"))
    return F.flatten(F.transform(turns, lambda t: F.array(
        part(F.length(_head(t)), F.lit(False)),
        part(F.length(t["text"]) + len(END), t["role"] == TRAINED_ROLE),
        part(F.lit(1), F.lit(False)))))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """pair_id, status, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask of each pair.

    ``pairs`` has pair_id and the arrays chosen and rejected of (role, text)."""
    def clean(name: str) -> Column:
        return F.transform(name, lambda t: F.struct(F.coalesce(t["role"], F.lit("unknown")).alias("role"),
                                                    F.coalesce(t["text"], F.lit("")).alias("text")))

    pairs = pairs.select("pair_id", clean("chosen").alias("a"), clean("rejected").alias("b"))
    here = (F.size("a") > 0) & (F.size("b") > 0)
    differs = F.array_position(F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y)), F.lit(False))
    pairs = pairs.withColumn("n", F.when(here, F.when(differs > 0, differs - 1).otherwise(F.size("a"))).cast("int"))
    status = (F.when(~here | here.isNull(), "unpaired")
              .when((F.col("n") == F.size("a")) & (F.col("n") == F.size("b")), "identical")
              .when((F.col("n") == F.size("a")) | (F.col("n") == F.size("b")), "empty").otherwise("ok"))

    def rest(name: str) -> Column:
        return F.slice(name, F.col("n") + 1, F.greatest(F.size(name) - F.col("n"), F.lit(0)))

    pairs = pairs.withColumns({"status": status, "x": rest("a"), "y": rest("b")})
    return pairs.select(
        "pair_id", "status", F.col("n").cast("long").alias("n_prefix"),
        F.when(here, render(F.slice("a", F.lit(1), F.col("n")))).alias("prompt"),
        F.when(here, render(F.col("x"))).alias("chosen"), F.when(here, render(F.col("y"))).alias("rejected"),
        F.when(here, mask(F.col("x"))).alias("chosen_mask"), F.when(here, mask(F.col("y"))).alias("rejected_mask"))


def mask_text(parts: Column) -> Column:
    """A mask as plain text, such as ``24:0,310:1,1:0``."""
    return F.array_join(F.transform(parts, lambda p: F.concat(
        p["chars"].cast("string"), F.when(p["train"], ":1").otherwise(":0"))), ",")


SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, COALESCE(role, 'unknown') AS role, COALESCE(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
l AS (SELECT conv_id, MAX(pos) AS last_pos FROM o WHERE role = 'assistant' GROUP BY conv_id),
r AS (SELECT l.conv_id, l.last_pos, o.text AS reply FROM l JOIN o ON o.conv_id = l.conv_id AND o.pos = l.last_pos),
p AS (SELECT conv_id AS pair_id, last_pos, reply AS mine, LEAD(reply) OVER (ORDER BY conv_id) AS other FROM r),
h AS (SELECT o.conv_id, COALESCE(STRING_AGG('<|im_start|>' || o.role || chr(10) || o.text || '<|im_end|>' || chr(10), '' ORDER BY o.pos)
             FILTER (WHERE o.pos < l.last_pos), '') AS head FROM o JOIN l ON o.conv_id = l.conv_id GROUP BY o.conv_id),
c AS (SELECT p.*, h.head, '<|im_start|>assistant' || chr(10) || mine || '<|im_end|>' || chr(10) AS x,
         '<|im_start|>assistant' || chr(10) || other || '<|im_end|>' || chr(10) AS y FROM p JOIN h ON h.conv_id = p.pair_id)
SELECT pair_id, CASE WHEN other IS NULL THEN 'unpaired' WHEN other = mine THEN 'identical' ELSE 'ok' END AS status,
  CAST(CASE WHEN other IS NULL THEN NULL WHEN other = mine THEN last_pos ELSE last_pos - 1 END AS BIGINT) AS n_prefix,
  CASE WHEN other IS NULL THEN NULL WHEN other = mine THEN head || x ELSE head END AS prompt,
  CASE WHEN other IS NULL THEN NULL WHEN other = mine THEN '' ELSE x END AS chosen,
  CASE WHEN other IS NULL THEN NULL WHEN other = mine THEN '' ELSE y END AS rejected,
  CASE WHEN other IS NULL THEN NULL WHEN other = mine THEN '' ELSE '22:0,' || (length(mine) + 10) || ':1,1:0' END AS chosen_mask,
  CASE WHEN other IS NULL THEN NULL WHEN other = mine THEN '' ELSE '22:0,' || (length(other) + 10) || ':1,1:0' END AS rejected_mask
FROM c
UNION ALL
SELECT DISTINCT conv_id, 'unpaired', CAST(NULL AS BIGINT), NULL, NULL, NULL, NULL, NULL FROM t
WHERE conv_id NOT IN (SELECT conv_id FROM l)
"""
