"""Preference formatting: one prompt and two masked completions per pair.

A pair is a chosen and a rejected conversation.  Their longest common prefix of turns is
rendered once as the prompt, what follows in each as a completion.  A completion comes
with a mask over its characters: 1 on what an assistant says and on the mark that ends it,
0 on headers and on what others say.

A turn is rendered as ``<|role|>``, a line end, its text, ``<|end|>`` and a line end;
``<|`` inside a text becomes ``< |`` so that no text can forge a mark.  Built-in functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conversations_of(turns: DataFrame, key: str) -> DataFrame:
    """``(key, turns)``: the ordered turns of each conversation as an array.

    Turns without key belong to no conversation and are left out; without number they
    come last.  Equal numbers are ordered by role and text, repeated rows are kept.  A
    NULL role is ``user``, a NULL text empty.
    """
    turn = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        turns.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(key, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def body(turn: Column) -> Column:
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), body(t))), "")


def mask(turns: Column) -> Column:
    """Runs ``flag:length`` over the characters of the rendered turns."""
    flag = lambda t: F.when(t["role"] == "assistant", F.lit(",1:")).otherwise(F.lit(",0:"))
    run = lambda t: F.concat(F.lit("0:"), F.length(header(t)), flag(t), F.length(body(t)))
    return F.array_join(F.transform(turns, run), ",")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """Pairs by ``key`` of two tables of turns (key, turn, role, text).

    A key that only one side has is paired with an empty conversation.  Equal
    conversations give the whole as prompt and two empty completions.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    a = conversations_of(chosen, key).withColumnRenamed("turns", "a")
    b = conversations_of(rejected, key).withColumnRenamed("turns", "b")
    both = a.join(b, key, "full").select(key, F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    n = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.slice("a", 1, n), F.slice("b", 1, n), lambda x, y: x == y)
    differs = F.array_position(same, F.lit(False)).cast("int")
    cut = both.select("*", F.when(differs == 0, n).otherwise(differs - 1).alias("prompt_turns"))
    rest = lambda side: F.slice(side, F.col("prompt_turns") + 1, F.size(side))
    return cut.select(
        key, "prompt_turns",
        render(F.slice("a", 1, F.col("prompt_turns"))).alias("prompt"),
        render(rest("a")).alias("chosen"), mask(rest("a")).alias("chosen_mask"),
        render(rest("b")).alias("rejected"), mask(rest("b")).alias("rejected_mask"),
    )


def swapped_answers(turns: DataFrame) -> DataFrame:
    """Rejected conversations for a table that has none: the last assistant turn says
    what the last assistant turn of the neighbour (conv_id with its last bit flipped)
    said; it is left out where the neighbour has none.
    """
    own = turns.select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    last = (
        own.where("role = 'assistant' AND turn IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    )
    other = last.select(
        F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("last.text").alias("other_text")
    )
    swap = last.join(other, "conv_id", "left").select("conv_id", "last", "other_text")
    hit = F.coalesce(
        (F.col("role") == "assistant") & (F.col("turn") == F.col("last.turn"))
        & (F.coalesce("text", F.lit("")) == F.col("last.text")),
        F.lit(False),
    )
    return (
        own.join(swap, "conv_id", "left")
        .where(~hit | F.col("other_text").isNotNull())
        .select("conv_id", "turn", "role", F.when(hit, F.col("other_text")).otherwise(F.col("text")).alias("text"))
    )


_RENDER = "'<|' || t.role || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)"
_MASK = """'0:' || length('<|' || t.role || '|>' || chr(10))
    || CASE WHEN t.role = 'assistant' THEN ',1:' ELSE ',0:' END
    || length(replace(t.text, '<|', '< |') || '<|end|>' || chr(10))"""


def _joined(what: str, turns: str, sep: str) -> str:
    return f"coalesce(array_to_string(list_transform({turns}, lambda t: {what}), '{sep}'), '')"


SQL = f"""
WITH last AS (
  SELECT conv_id, max(struct_pack(turn := turn, text := coalesce(text, ''))) AS l FROM conversations
  WHERE role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL GROUP BY conv_id),
swap AS (SELECT a.conv_id, a.l, b.l.text AS other FROM last a LEFT JOIN last b ON b.conv_id = xor(a.conv_id, 1)),
marked AS (
  SELECT c.conv_id, c.turn, coalesce(c.role, 'user') AS role, coalesce(c.text, '') AS text, s.other,
    coalesce(c.role = 'assistant' AND c.turn = s.l.turn AND coalesce(c.text, '') = s.l.text, false) AS hit
  FROM conversations c LEFT JOIN swap s ON s.conv_id = c.conv_id WHERE c.conv_id IS NOT NULL),
a AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS LAST, role, text) AS t
  FROM marked GROUP BY conv_id),
b AS (SELECT conv_id, list(struct_pack(role := role, text := CASE WHEN hit THEN other ELSE text END)
    ORDER BY turn NULLS LAST, role, CASE WHEN hit THEN other ELSE text END) AS t
  FROM marked WHERE NOT hit OR other IS NOT NULL GROUP BY conv_id),
j AS (SELECT conv_id, coalesce(a.t, []) AS x, coalesce(b.t, []) AS y FROM a FULL JOIN b USING (conv_id)),
p AS (SELECT *, cast(coalesce(list_min(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[i] <> y[i])) - 1,
    least(len(x), len(y))) AS integer) AS n FROM j)
SELECT conv_id, n AS prompt_turns, {_joined(_RENDER, "x[1:n]", "")} AS prompt,
  {_joined(_RENDER, "x[n + 1:]", "")} AS chosen, {_joined(_MASK, "x[n + 1:]", ",")} AS chosen_mask,
  {_joined(_RENDER, "y[n + 1:]", "")} AS rejected, {_joined(_MASK, "y[n + 1:]", ",")} AS rejected_mask
FROM p
"""
