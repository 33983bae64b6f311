"""On-hand stock after each movement, with a floor at zero."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.model import KEY
from changeflow.operators import blocks

# --- fixed values: a key without an opening row -------------------------------------------------
OPENING_QTY = 50
OPENING_VERSION = 1


def floor_ledger(
    movements: DataFrame,
    opening: DataFrame | None = None,
    order: str = "seq",
    hot_rows: int = blocks.HOT_ROWS,
) -> DataFrame:
    """``on_hand``, ``row_version`` and ``absorbed`` (demand the floor swallowed) per movement.

    With P = opening + running sum of deltas, stock under "never below zero" is
    P - min(0, lowest P so far): two running values instead of a loop. An unseen
    key is inserted by its first movement, at 50 + delta and version 1; a key of
    ``opening`` starts from its stock and version and gains one version per movement.
    """
    moves = movements
    if opening is not None:
        start = opening.select(
            *KEY, F.col("available_qty").cast("bigint").alias("_qty"), F.col("row_version").alias("_version")
        )
        moves = movements.join(start, KEY, "left")
    else:
        moves = moves.withColumn("_qty", F.lit(None).cast("bigint")).withColumn("_version", F.lit(None).cast("bigint"))
    # Sums and lowest sums of blocks merge, so a block inherits both from one summary of those before it.
    cut, block = blocks.dealt(blocks.placed(moves, KEY, order), KEY, order, hot_rows), blocks.BLOCK
    inside = Window.partitionBy(*KEY, block).orderBy(order)
    here = cut.withColumns({"_sum": F.sum("delta").over(inside), "_moves": F.row_number().over(inside).cast("bigint")})
    here = here.withColumn("_low", F.min("_sum").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    parts = here.groupBy(*KEY, block).agg(F.sum("delta").alias("_d"), F.count(F.lit(1)).alias("_n"), F.min("_sum").alias("_l"))
    earlier = Window.partitionBy(*KEY).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    parts = parts.withColumns({"_d0": F.coalesce(F.sum("_d").over(earlier), none), "_n0": F.coalesce(F.sum("_n").over(earlier), none)})
    parts = parts.withColumn("_l0", F.min(F.col("_d0") + F.col("_l")).over(earlier)).select(*KEY, block, "_d0", "_n0", "_l0")
    start_qty = F.coalesce("_qty", F.lit(OPENING_QTY))
    # As in ``blocks.running``: the rows stay where they lie.
    before = here.join(parts, [*KEY, block], "left").withColumns(
        {
            "_balance": start_qty + F.col("_d0") + F.col("_sum"),
            "_lowest_before": start_qty + F.least(F.col("_l0"), F.col("_d0") + F.col("_low")),
            "_moves": F.col("_n0") + F.col("_moves"),
        }
    )
    zero = F.lit(0).cast("bigint")
    shortfall = -F.least(zero, F.col("_balance"), F.coalesce("_lowest_before", zero))
    earlier = -F.least(zero, F.coalesce("_lowest_before", zero))
    return before.select(
        *movements.columns,
        (F.col("_balance") + shortfall).alias("on_hand"),
        F.coalesce(F.col("_version") + F.col("_moves"), F.lit(OPENING_VERSION) + F.col("_moves") - 1).alias(
            "row_version"
        ),
        (shortfall - earlier).alias("absorbed"),
    )


def negative_delta_clamps(ledger: DataFrame) -> DataFrame:
    """Movements where the floor absorbed demand: the oversell signal."""
    return ledger.filter(F.col("absorbed") > 0)
