"""Running values over ordered groups when one group may hold a large part of all rows.

A window over a key puts all rows of that key into one task. So keys are cut into
blocks of their order column. Each block is summarised where its rows are, a
window over the few block summaries of a key gives what every block inherits from
the blocks before it, and the window over the rows runs inside one block.

``running`` does so for all keys in one plan: rows are dealt by (key, block) once,
summaries by key, and what they inherit goes back. No job runs while the plan is
built. The kernel of the outcomes, which has several windows over the same
shuffle, keeps ordinary keys whole instead and cuts hot ones only (``hot_keys``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key from which it is hot, and positions of a block.
HOT_ROWS = 2_000_000

BLOCK = "_block"
_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """Keys with more rows than the limit, and the limit. ``None`` when there are none.

    There are at most as many as all rows over the limit: some 20 MB of keys for 3 * 10^11 rows.
    """
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows).select(*keys)
    return (None if hot.isEmpty() else hot), hot_rows


def with_blocks(df: DataFrame, order: str, rows_per_block: int) -> DataFrame:
    """Cut the order column into ranges. Positions are unique per key and partition, so a
    block holds at most ``rows_per_block`` rows of one log partition."""
    return df.withColumn(BLOCK, F.floor(F.col(order) / F.lit(rows_per_block)).cast("bigint"))


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys). ``hot`` is the short list of ``hot_keys``."""
    listed = F.broadcast(hot)
    return df.join(listed, list(keys), "left_anti"), df.join(listed, list(keys), "left_semi")


def inherited(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, Column]], block: str = BLOCK
) -> DataFrame:
    """Per (keys, block): each aggregate over all earlier blocks of the same keys (null if none)."""
    partial = df.groupBy(*keys, block).agg(*[_AGGREGATES[how](col).alias(name) for name, (how, col) in values.items()])
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return partial.select(
        *keys, block, *[_AGGREGATES[how](F.col(name)).over(earlier).alias(name) for name, (how, _) in values.items()]
    )


def _combine(how: str, carried: Column, local: Column) -> Column:
    # Null on both sides stays null, as in a window over the whole group.
    if how == "sum":
        return F.coalesce(carried + local, carried, local)
    return (F.greatest if how == "max" else F.least)(carried, local)


def placed(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows that have a key and a position; others belong to no block."""
    for name in (*keys, order):
        df = df.filter(F.col(name).isNotNull())
    return df


def dealt(df: DataFrame, keys: Sequence[str], order: str, positions: int = HOT_ROWS) -> DataFrame:
    """``df`` with its blocks, dealt by key and block; what is grouped by both needs no further shuffle."""
    return with_blocks(df, order, positions).repartition(*keys, BLOCK)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Mapping[str, tuple[str, Column]],
    hot_rows: int = HOT_ROWS,
    current: bool = True,
) -> DataFrame:
    """Running sum/max/min per key, up to the current row (or the row before it)."""
    cut = dealt(placed(df, keys, order), keys, order, hot_rows)
    carry = inherited(cut, keys, values).select(*keys, BLOCK, *[F.col(n).alias(f"_carry_{n}") for n in values])
    inside = Window.partitionBy(*keys, BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    here = cut.select("*", *[_AGGREGATES[how](col).over(inside).alias(f"_local_{n}") for n, (how, col) in values.items()])
    # Each row's block has its summary. An outer join can send the summaries to every task, but never the rows.
    return here.join(carry, [*keys, BLOCK], "left").select(
        *df.columns,
        *[_combine(how, F.col(f"_carry_{n}"), F.col(f"_local_{n}")).alias(n) for n, (how, _) in values.items()],
    )
