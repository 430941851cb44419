"""Row-order operators that split long groups.

A window partitioned by a sheet puts the whole sheet into one task. Here the
positions of a group are cut into blocks of bounded length: one small row per
block carries what the following blocks need, and the rows themselves are only
ever sorted inside (group, block).

Positions are whole numbers, unique within a group; group keys are not NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.sources.staging import stage

BLOCK_ROWS = 1_000_000

_BLOCK = "__block"
_CARRIED = "__carried"
_OWN = "__own"


def _with_block(df: DataFrame, position: str, block_rows: int) -> DataFrame:
    return df.withColumn(_BLOCK, F.expr(f"`{position}` div {block_rows}"))


def _earlier(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    out: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The last non-NULL value at or before each row, in position order.

    Each block tells its last value, one row per block; the rows are read twice
    and shuffled once, by (group, block).
    """
    marked = _with_block(df.withColumn(_OWN, value), position, block_rows)
    group = [*keys, _BLOCK]
    last = F.max_by(_OWN, F.when(F.col(_OWN).isNotNull(), F.col(position)))
    carried = (
        marked.groupBy(*group)
        .agg(last.alias("last"))
        .select(*group, F.last("last", ignorenulls=True).over(_earlier(keys)).alias(_CARRIED))
    )
    inside = Window.partitionBy(*group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.join(carried, group, "left")
        .withColumn(out, F.coalesce(F.last(_OWN, ignorenulls=True).over(inside), F.col(_CARRIED)))
        .select(*df.columns, out)
    )


def number_in_group(
    df: DataFrame, keys: Sequence[str], position: str, out: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """1, 2, 3, ... within each group, in position order."""
    marked = _with_block(df, position, block_rows)
    group = [*keys, _BLOCK]
    offsets = (
        marked.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*group, F.coalesce(F.sum("n").over(_earlier(keys)), F.lit(0)).alias(_CARRIED))
    )
    inside = Window.partitionBy(*group).orderBy(position)
    return (
        marked.join(offsets, group, "left")
        .withColumn(out, F.row_number().over(inside) + F.col(_CARRIED))
        .select(*df.columns, out)
    )


# monotonically_increasing_id counts the rows of a partition in these bits, and numbers partitions above them
_ROW_BITS = 33


def number_distinct(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """The distinct combinations of some columns and the place of each in their order, from 0, stored; NULL comes first.

    They are dealt out by ranges and stored in order with their place in their range. What lies before a range is told
    by the sizes of the ranges, one number for each partition that the session shuffles to.
    """
    ranged = df.select(*columns).distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    ranged = stage(ranged.withColumn(_CARRIED, F.monotonically_increasing_id()), "distinct-ranges")
    part, own = F.shiftright(_CARRIED, _ROW_BITS), F.col(_CARRIED) % (1 << _ROW_BITS)
    sizes = dict(ranged.groupBy(part.cast("int").alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0]
    for k in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(k, 0))
    return ranged.select(*columns, (F.get(F.lit(np.array(before, dtype=np.int64)), part.cast("int")) + own).alias(out))


def cut_block(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    stop: Column,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows of each group before its first stop row.

    The first stop is found per block and spread over the blocks of the group,
    so no key of the final join holds more than one block of rows.
    """
    marked = _with_block(df, position, block_rows)
    group = [*keys, _BLOCK]
    stops = (
        marked.groupBy(*group)
        .agg(F.min(F.when(stop, F.col(position))).alias("own"))
        .select(*group, F.min("own").over(Window.partitionBy(*keys)).alias(_CARRIED))
        .filter(F.col(_CARRIED).isNotNull())
    )
    return (
        marked.join(stops, group, "left")
        .filter(F.col(_CARRIED).isNull() | (F.col(position) < F.col(_CARRIED)))
        .select(*df.columns)
    )
