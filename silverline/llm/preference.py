"""Preference examples: a prompt that two conversations share, and their masked completions.

Of two conversations the longest common prefix of turns (role and text) is rendered once as
the prompt; what follows in each is its completion, rendered turn by turn with a mask that
trains on what the assistant says and on the mark that ends it. All of it is Spark
expressions; turns are shuffled once, by conversation, and then only rejected conversations
move to their chosen partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1024  # conversation ids in a block of the ranking


def opening_pairs(turns: DataFrame, conv: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """``chosen`` and ``rejected``: conversations with the same first turn, paired in order of their id.

    Of every two the earlier is chosen; an odd one out is chosen alone (``rejected`` NULL), so
    every conversation is in one row. Ranks are found in blocks of ids, so an opening
    that a third of all conversations share is divided among tasks; ids that are no numbers are
    in order of a hash's ``block`` values first. Rows without an id are no
    conversation's.
    """
    first = F.min(F.struct("turn", "role", "text"))
    numeric = isinstance(turns.schema[conv].dataType, T.NumericType)
    number = F.floor(F.col("conv") / block) if numeric else F.pmod(F.xxhash64("conv"), F.lit(block))
    openings = (
        turns.where(F.col(conv).isNotNull())
        .select(F.col(conv).alias("conv"), "turn", "role", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"))
        .groupBy("conv")
        .agg(first.alias("first"))
        .select(
            "conv",
            F.sha2(F.to_json(F.struct("first.role", "first.text")), 256).alias("opening"),
            number.alias("block"),
        )
    )
    counts = openings.groupBy("opening", "block").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("opening").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("opening", "block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("opening", "block").orderBy("conv"))
    ranked = (
        openings.withColumn("rank", rank)
        .join(starts, ["opening", "block"])
        .select("conv", "opening", F.expr("(start + rank - 1) div 2").alias("pair"))
    )
    both = ranked.groupBy("opening", "pair").agg(F.min("conv").alias("chosen"), F.max("conv").alias("other"))
    return both.select("chosen", F.when(F.col("other") != F.col("chosen"), F.col("other")).alias("rejected"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def rendered(turns: Column) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Runs of characters of the rendered turns: (``length``, ``train``), two for each turn."""
    of = lambda t: F.array(
        F.struct(F.length(_head(t)).alias("length"), F.lit(False).alias("train")),
        F.struct(F.length(_body(t)).alias("length"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("train")),
    )
    return F.flatten(F.transform(turns, of))


def preference_examples(turns: DataFrame, pairs: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per row of ``pairs`` (``chosen``, ``rejected``): ``n_common``, ``prompt``, and for either
    side its completion (``chosen_text``, ``rejected_text``) and mask (``chosen_mask``, ``rejected_mask``).

    ``turns``: ``conv``, ``turn``, ``role``, ``text``. Turns are ordered by their number, then role and
    text; a row that is repeated exactly counts once; NULL roles and texts are empty. Two equal
    conversations share everything and have empty completions. Without a partner nothing is
    shared: the prompt is empty, the completion is the whole conversation, and the rejected side is NULL.
    Pairs whose chosen conversation has no turns are left out. Other columns do not matter.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talks = (
        turns.where(F.col(conv).isNotNull())
        .groupBy(F.col(conv).alias("conv"))
        .agg(F.sort_array(F.collect_set(turn)).alias("turns"))
    )
    partner = pairs.where(F.col("rejected").isNotNull()).select(
        F.col("rejected").alias("conv"), F.col("chosen").alias("of"), F.col("rejected").alias("rejected_with")
    )
    moved = talks.join(partner, "conv").select("of", "rejected_with", F.col("turns").alias("others"))
    known = pairs.select(F.col("chosen").alias("conv"), "rejected")
    side = talks.join(known, "conv").join(
        moved, (F.col("conv") == F.col("of")) & (F.col("rejected") == F.col("rejected_with")), "left"
    )
    same = F.zip_with(
        "turns",
        F.coalesce("others", F.array().cast("array<struct<turn:bigint,role:string,text:string>>")),
        lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)),
    )
    # One false more, so that equal conversations share all their turns.
    common = (F.array_position(F.concat(same, F.array(F.lit(False))), False) - 1).cast("int")
    split = side.withColumn("n_common", common)
    rest = lambda c: F.slice(F.col(c), F.col("n_common") + 1, F.greatest(F.size(c), F.lit(0)))
    other = F.col("others").isNotNull()
    return split.select(
        F.col("conv").alias("chosen"),
        "rejected",
        "n_common",
        rendered(F.slice("turns", F.lit(1), F.col("n_common"))).alias("prompt"),
        rendered(rest("turns")).alias("chosen_text"),
        F.when(other, rendered(rest("others"))).alias("rejected_text"),
        mask(rest("turns")).alias("chosen_mask"),
        F.when(other, mask(rest("others"))).alias("rejected_mask"),
    )


def mask_text(column: str) -> Column:
    """A mask as text: ``12x0,85x1``."""
    run = lambda m: F.concat(m["length"].cast("string"), F.when(m["train"], F.lit("x1")).otherwise(F.lit("x0")))
    return F.when(F.col(column).isNotNull(), F.array_join(F.transform(column, run), ","))
