"""Global ranks and medians at any number of rows.

``rank() over (order by x)`` sends every row to one task. Here distinct values are counted first, so ties of any size
shrink to one row. The counts are dealt out by ranges of the value, and the totals of the ranges give each its offset.
Values keep the type of their column.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.sources.staging import Counted, stage, stage_counted

# A value held by more than one row in so many is looked up by broadcast; there are fewer than so many of them.
HOT_SHARE = 100_000


def value_positions(df: DataFrame, value: str, range_values: int | None = None) -> DataFrame:
    """One row per distinct value, best first: how many rows precede it, and how many hold it.

    NULL comes last. Columns: ``value``, ``n``, ``before``. The values are dealt to as many ranges as the session
    shuffles to, or of about ``range_values`` each; the sizes of the ranges, one number each, tell what lies before.
    """
    counts = df.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    by_value = F.col("value").desc_nulls_last()
    ranges = () if range_values is None else (max(1, -(-counts.count() // range_values)),)
    # stored with their range, which is decided once
    ranged = stage(counts.repartitionByRange(*ranges, by_value).withColumn("range", F.spark_partition_id()), "value-ranges")
    sizes = dict(ranged.groupBy("range").agg(F.sum("n")).collect())
    before = [0]
    for k in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(k, 0))
    inside = Window.partitionBy("range").orderBy(by_value).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.get(F.lit(np.array(before, dtype=np.int64)), F.col("range"))
    return ranged.select("value", "n", (earlier + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))


def with_rank(df: DataFrame, value: str, rank: str, total: str) -> DataFrame:
    """Rank by descending value, and the number of rows; ties share a rank, gaps follow, NULL ranks last."""
    stored = stage_counted(df, "ranked")
    return _ranked_by_ranges(stored, value, rank).withColumn(total, F.lit(stored.rows).cast("bigint"))


def _ranked_by_ranges(stored: Counted, value: str, rank: str) -> DataFrame:
    """Look the rank of each value up.

    Values held by more than one row in HOT_SHARE can be broadcast. Their rows need no second lookup; they are spread
    over all tasks instead of meeting at one key.
    """
    df = stored.frame
    positions = value_positions(df, value).select(
        F.col("value").alias("__v"), "n", (F.col("before") + 1).cast("bigint").alias("__rank")
    )
    positions = stage(positions, "value-ranks")
    is_hot = F.col("n") * HOT_SHARE > stored.rows
    hot = positions.filter(is_hot).select(F.col("__v").alias("__hot_v"), F.col("__rank").alias("__hot_rank"))
    cold = positions.filter(~is_hot).select("__v", "__rank", F.lit(0).cast("bigint").alias("__spread"))
    own = F.col(value)
    spread = F.when(F.col("__hot_rank").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*df.columns), F.lit(HOT_SHARE)))
    rows = df.join(F.broadcast(hot), own.eqNullSafe(F.col("__hot_v")), "left").withColumn("__row_spread", spread)
    found = rows.join(cold, own.eqNullSafe(F.col("__v")) & (F.col("__row_spread") == F.col("__spread")), "left")
    return found.select(*df.columns, F.coalesce("__hot_rank", "__rank").alias(rank))


def row_count(df: DataFrame) -> Column:
    """The number of rows, as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).scalar()


def rank_label(rank: Column, total: Column, n: int) -> Column:
    """'Top n' and 'Bottom n' by rank; ties at the border follow the rank."""
    return F.when(rank <= n, F.lit(f"Top {n}")).when(rank > total - n, F.lit(f"Bottom {n}"))


def median(df: DataFrame, value: str) -> DataFrame:
    """Exact median of the non-NULL values, one row; halves are taken before they are added."""
    known = df.filter(F.col(value).isNotNull())
    positions = value_positions(known, value)
    count = row_count(known)
    lower, upper = F.floor((count - 1) / 2), F.floor(count / 2)

    def holder(position: Column) -> Column:
        held = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
        return F.max(F.when(held, F.col("value"))).cast("double")

    return positions.agg((holder(lower) / 2 + holder(upper) / 2).alias("median"))
