"""Preference formatting of paired conversations.

A pair is a chosen and a rejected conversation. Their longest common prefix of
turns is rendered once, as the prompt; what follows is the completion of each.
A completion comes with a mask: the character spans that are trained on, which
are the assistant's words and the end marks of its turns. Role headers and
other speakers' turns inside a completion are masked out.

The common prefix is found per turn with a join and a grouped minimum. Texts
meet only when a pair's turns are put together, and a pair is one training
example, whose size does not depend on the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import staged

#: The chat template.
HEAD, AFTER_ROLE, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def one_row_per_turn(turns: DataFrame, pair: str, turn: str, role: str, text: str) -> DataFrame:
    """(pair, turn, role, text): NULL pairs and turns belong to no
    conversation and are left out; of rows that repeat a turn the one with the
    smallest role, then text, counts; NULL roles and texts are empty."""
    rows = turns.select(F.col(f"`{pair}`").alias("pair"), F.col(f"`{turn}`").alias("turn"),
                        F.struct(F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                                 F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).alias("said"))
    rows = rows.where("pair is not null and turn is not null").groupBy("pair", "turn").agg(F.min("said").alias("said"))
    return rows.select("pair", "turn", "said.role", "said.text")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(AFTER_ROLE), text, F.lit(TAIL))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "pair", turn: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """One row per pair that both frames have: pair, prompt_turns, prompt,
    chosen, chosen_mask, rejected, rejected_mask.

    Turns follow each other in the order of ``turn``, whatever its gaps. Masks
    are arrays of (start, end) in code points of the completion, in order. A
    pair without common first turn has an empty prompt; a conversation that is
    a prefix of the other has an empty completion. Repeated turns, NULLs and
    extra columns: see ``one_row_per_turn``. Empty tables give no rows.
    """
    a = one_row_per_turn(chosen, pair, turn, role, text).withColumn("side", F.lit(0))
    b = one_row_per_turn(rejected, pair, turn, role, text).withColumn("side", F.lit(1))
    said = F.struct("turn", "role", "text")
    talks = a.unionByName(b).groupBy("pair").agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == 0, said))).alias("a"),
        F.sort_array(F.collect_list(F.when(F.col("side") == 1, said))).alias("b"))
    talks = talks.where("size(a) > 0 and size(b) > 0")
    same = F.zip_with("a", "b", lambda x, y: F.coalesce(
        (x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    talks = talks.withColumn("same", F.coalesce(
        F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same).cast("long")).cast("int"))

    def prompt(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")

    def mask(turns: Column) -> Column:
        none = F.array().cast("array<struct<start:int,end:int>>")
        first = F.struct(F.lit(0).alias("at"), none.alias("spans"))

        def step(acc: Column, t: Column) -> Column:
            start = acc["at"] + F.length(t["role"]) + len(HEAD) + len(AFTER_ROLE)
            end = start + F.length(t["text"]) + len(TAIL)
            span = F.array(F.struct(start.alias("start"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(
                t["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))
        return F.aggregate(turns, first, step, lambda acc: acc["spans"])

    def rest(side: str) -> Column:
        return F.filter(F.col(side), lambda t, i: i >= F.col("same"))

    return talks.select(
        F.col("pair"), F.col("same").alias("prompt_turns"),
        prompt(F.filter(F.col("a"), lambda t, i: i < F.col("same"))).alias("prompt"),
        prompt(rest("a")).alias("chosen"), mask(rest("a")).alias("chosen_mask"),
        prompt(rest("b")).alias("rejected"), mask(rest("b")).alias("rejected_mask"))


def next_in_order(ids: DataFrame) -> DataFrame:
    """(pair, next) of the distinct values ``pair`` of ``ids``: the next greater
    one, and the smallest for the greatest. A single value gives no row."""
    # staged, so that the parts stay the same; only their ends meet in one place
    parts = staged(ids.repartitionByRange("pair").select("pair", F.spark_partition_id().alias("part")), "pair-order")
    ends = parts.groupBy("part").agg(F.min("pair").alias("first"), F.max("pair").alias("pair")).orderBy("part").collect()
    after = [r["first"] for r in ends[1:]] + [r["first"] for r in ends[:1]]
    over = parts.sparkSession.createDataFrame(
        [(r["pair"], to) for r, to in zip(ends, after, strict=True)],
        T.StructType([T.StructField(c, parts.schema["pair"].dataType) for c in ("pair", "to")]))
    within = F.lead("pair").over(Window.partitionBy("part").orderBy("pair"))
    out = parts.select("pair", within.alias("within")).join(F.broadcast(over), "pair", "left")  # one row a part
    return out.select("pair", F.coalesce("within", "to").alias("next")).where("next <> pair")


def paired_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected conversations out of plain ones, paired by conv_id.

    Chosen is a conversation up to its last assistant turn. Rejected is the
    same one with that answer exchanged for the last answer of its neighbour
    (conv_id 2k and 2k + 1 are neighbours): fluent, and off the point. If the
    neighbour is missing or has no answer, the next answered conversation in
    the order of conv_id takes its place, after the last one the first. Only a
    conversation without assistant turn, or the only one with an answer, has
    no pair. Repeated turns and NULLs as in ``one_row_per_turn``.
    """
    turns = one_row_per_turn(conversations, "conv_id", "turn", "role", "text")
    answers = staged(turns.where(F.col("role") == TRAINED_ROLE).groupBy("pair").agg(
        F.max(F.struct("turn", "text")).alias("last")), "last-answers")
    ids = answers.select("pair")
    beside = ids.select(F.col("pair").bitwiseXOR(F.lit(1).cast("long")).alias("pair"), F.col("pair").alias("beside"))
    other = ids.join(next_in_order(ids), "pair").join(beside, "pair", "left").select(
        "pair", F.coalesce("beside", "next").alias("other"))
    other = other.join(answers.select(F.col("pair").alias("other"), F.col("last.text").alias("instead")), "other").drop("other")
    ends = answers.select("pair", F.col("last.turn").alias("end")).join(other, "pair")
    chosen = turns.join(ends, "pair").where("turn <= end")
    rejected = chosen.withColumn("text", F.when(F.col("turn") == F.col("end"), F.col("instead")).otherwise(F.col("text")))
    columns = ["pair", "turn", "role", "text"]
    return chosen.select(*columns), rejected.select(*columns)
