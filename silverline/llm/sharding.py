"""Shards that each hold the mixture of the whole: proportional stratified interleaving.

The rows of a stratum (a source) are put in a seeded random order and ranked; row ``r``
of ``n`` stands at the fraction ``(2r - 1) / 2n``. Sorting all strata by that fraction
interleaves them in proportion, and cutting the sequence into equal runs gives shards
whose counts differ by one at most and that each match the mixture.

No task ever gets a stratum. Ranks are found in cells: a row's hash names one of ``CELLS``
cells of its stratum, cells are counted before the shuffle, and a rank is the rows of
earlier cells plus the place in the own cell. Positions are found in cells of the fraction
in the same way; how many rows precede such a cell follows from the strata's sizes alone,
so it needs no further pass. Rows are shuffled twice and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.shared import free_names, without

# Cells of a stratum, and cells of the interleaved sequence. A cell is the unit of sorting.
CELLS = 4096


def interleaved_shards(
    docs: DataFrame,
    shards: int,
    strata: Sequence[str] = ("source",),
    key: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    cells: int = CELLS,
) -> DataFrame:
    """``docs`` with ``shard`` (int, 0 to ``shards - 1``) and ``slot`` (long, gapless from 0).

    * The order within a stratum depends on ``seed``, ``key`` and ``text`` alone, not on the layout.
    * NULL in a stratum column is a stratum of its own, apart from the empty string.
    * Rows of one key are told apart by their text, and rows without a key placed by it; rows equal in both are interchangeable.
    * Repeated rows all keep a place of their own. An empty table gives no rows.
    * Existing columns ``shard`` and ``slot`` are replaced; all others stay.
    """
    docs = without(docs, "shard", "slot")
    stratum, draw, tie, cell, place, rank, of, total = free_names(
        docs, "_stratum", "_draw", "_tie", "_cell", "_place", "_rank", "_of", "_total"
    )
    drawn = docs.select(
        "*",
        F.to_json(F.struct(*[F.col(s).cast("string").alias(f"c{i}") for i, s in enumerate(strata)])).alias(stratum),
        F.xxhash64(F.col(text)).alias(tie),
    ).withColumn(draw, F.xxhash64(F.lit(seed), F.col(key), F.col(tie))).withColumn(cell, F.pmod(F.col(draw), F.lit(cells)).cast("int"))

    # One row per cell of a stratum: rows before it, rows of the stratum.
    counted = drawn.groupBy(stratum, cell).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(stratum).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cell_starts = counted.select(
        stratum,
        cell,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(place),
        F.sum("rows").over(Window.partitionBy(stratum)).alias(of),
    )
    in_cell = Window.partitionBy(stratum, cell).orderBy(draw, key, tie)
    ranked = (
        drawn.withColumn(rank, F.row_number().over(in_cell).cast("long"))
        .join(cell_starts, [stratum, cell])
        .withColumn(rank, F.col(rank) + F.col(place))
        .drop(place, cell)
    )

    # Row r of n is in cell cells * (2r - 1) div 2n. A stratum of few rows lists them, one of many
    # lists its rows per cell, so the list is never longer than the table.
    sizes = counted.groupBy(stratum).agg(F.sum("rows").alias("n"))
    until = lambda c: f"((2 * n * {c} + {cells} - 1) div (2L * {cells}))"  # noqa: E731  rows of cells before c
    listed = sizes.select(
        F.explode(
            F.when(
                F.col("n") <= cells,
                F.expr(f"transform(sequence(1L, n), r -> struct(int(((2 * r - 1) * {cells}) div (2 * n)) as c, 1L as k))"),
            ).otherwise(
                F.expr(f"transform(sequence(0, {cells - 1}), c -> struct(c as c, {until('(c + 1)')} - {until('c')} as k))")
            )
        ).alias("x")
    )
    # At most ``cells`` rows from here on.
    per_cell = listed.groupBy(F.col("x.c").alias(cell)).agg(F.sum("x.k").alias("k"))
    before = Window.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_cell.select(
        cell,
        F.coalesce(F.sum("k").over(before), F.lit(0)).alias(place),
        F.sum("k").over(Window.partitionBy()).alias(total),
    )
    placed = ranked.withColumn(
        cell, F.expr(f"((2 * `{rank}` - 1) * {cells}) div (2 * `{of}`)").cast("int")
    )
    in_sequence = Window.partitionBy(cell).orderBy((2 * F.col(rank) - 1) / F.col(of), stratum, draw, key, tie)
    # ``starts`` has one row per cell at most, whatever the input.
    placed = (
        placed.withColumn(rank, F.row_number().over(in_sequence).cast("long"))
        .join(F.broadcast(starts), cell)
        .withColumn(place, F.col(place) + F.col(rank) - 1)
    )
    return placed.select(
        *[placed[c] for c in docs.columns],
        F.expr(f"(`{place}` * {shards}) div `{total}`").cast("int").alias("shard"),
        F.expr(
            f"`{place}` - (((`{place}` * {shards}) div `{total}`) * `{total}` + {shards} - 1) div {shards}"
        ).cast("long").alias("slot"),
    )
