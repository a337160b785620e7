"""Preference formatting: the common turns of a chosen and a rejected conversation once as prompt, then both completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import cut, running

#: How a turn is rendered; the text of assistant turns and what follows it are what a model learns to write.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def _sides(turns: DataFrame) -> DataFrame:
    """Turns numbered from 0 in each conversation, however they were numbered; a repeated row is a turn of its own."""
    clean = turns.select(
        "pair_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).filter(F.col("pair_id").isNotNull())
    clean = clean.withColumns({"_one": F.lit(1), "_tie": F.xxhash64("text")})
    return running(clean, ["turn", "role", "_tie"], {"position": "_one"}, ["pair_id"])


def preference_segments(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row for each turn to be written: ``(pair_id, part, position, role, rendered, start, learn_from, learn_to)``.

    Both inputs have ``pair_id``, ``turn``, ``role``, ``text``. The longest prefix of equal turns is the part ``prompt``, which
    is rendered once; what follows are the parts ``chosen`` and ``rejected``. ``start`` is where a segment begins in its part,
    in code points; ``learn_from`` and ``learn_to`` bound the part's characters to learn from, an empty range (at ``start``)
    in the prompt and in turns that are not the assistant's. Turns are ordered by ``turn`` (null first), role and a hash of the text. Null
    roles and texts are empty; rows without ``pair_id`` belong to no pair and are no turns. A pair with one side only has an
    empty prompt. Turns are joined on pair and position, and positions and starts are distributed prefix sums, so a
    conversation of any length is spread over tasks.
    """
    left, right = (_sides(x) for x in (chosen, rejected))
    other = right.select("pair_id", "position", F.col("role").alias("_role"), F.col("text").alias("_text"))
    differ = left.join(other, ["pair_id", "position"], "full").filter(
        ~(F.col("role").eqNullSafe(F.col("_role")) & F.col("text").eqNullSafe(F.col("_text")))
    )
    forks = cut(differ.groupBy("pair_id").agg(F.min("position").alias("fork")))
    part = {"chosen": left, "rejected": right}
    each = [x.join(forks, "pair_id", "left").withColumn("part", F.lit(name)) for name, x in part.items()]
    shared = F.col("fork").isNull() | (F.col("position") < F.col("fork"))
    prompt = each[0].filter(shared).withColumn("part", F.lit("prompt"))
    rows = prompt.unionByName(each[0].filter(~shared)).unionByName(each[1].filter(~shared))
    rows = rows.select("pair_id", "part", "position", "role", rendered(F.col("role"), F.col("text")).alias("rendered"))
    placed = running(rows.withColumn("_chars", F.char_length("rendered")), ["position"], {"start": "_chars"}, ["pair_id", "part"])
    learned = (F.col("part") != "prompt") & (F.col("role") == LEARNED)
    head = F.char_length("role") + len(OPEN + MIDDLE)
    return placed.select(
        "pair_id",
        "part",
        "position",
        "role",
        "rendered",
        "start",
        (F.col("start") + F.when(learned, head).otherwise(0)).alias("learn_from"),
        (F.col("start") + F.when(learned, F.col("_chars")).otherwise(0)).alias("learn_to"),
    )


def borrowed_answers(turns: DataFrame) -> DataFrame:
    """A rejected side for each conversation: its last assistant turn gets the text of its neighbour's last one.

    Neighbours are the conversations 2n and 2n + 1. Where the neighbour has no such turn, the answer is left out. Of repeated
    last turns the one with the greatest text is replaced, and lent. Conversations without an assistant's turn stay as they are.
    """
    turns = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    answers = turns.filter((F.col("role") == LEARNED) & F.col("pair_id").isNotNull())
    last = answers.groupBy("pair_id").agg(F.max("turn").alias("turn"))
    last = answers.join(last, ["pair_id", "turn"]).groupBy("pair_id", "turn").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    last = cut(last)
    lent = last.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"), F.col("text").alias("_lent"))
    replaced = last.select("pair_id", F.col("turn").alias("_last"), F.lit(LEARNED).alias("_role"))
    same = (turns["pair_id"] == replaced["pair_id"]) & (turns["turn"] == replaced["_last"]) & (turns["role"] == replaced["_role"])
    rest = turns.join(replaced, same, "left_anti")
    new = last.join(lent, "pair_id").select("pair_id", "turn", F.lit(LEARNED).alias("role"), F.col("_lent").alias("text"))
    return rest.unionByName(new)


def assembled(segments: DataFrame) -> DataFrame:
    """``(pair_id, prompt, chosen, rejected)`` as whole strings, for conversations that fit a model's context."""
    texts = segments.groupBy("pair_id", "part").agg(F.sort_array(F.collect_list(F.struct("position", "rendered"))).alias("turns"))
    whole = texts.withColumn("whole", F.array_join(F.transform("turns", lambda t: t["rendered"]), ""))
    pick = {p: F.coalesce(F.max(F.when(F.col("part") == p, F.col("whole"))), F.lit("")).alias(p) for p in ("prompt", "chosen", "rejected")}
    return whole.groupBy("pair_id").agg(*pick.values())
