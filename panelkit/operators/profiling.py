"""Short descriptions of a table: sizes, gaps, periods, distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def profile_categories(df: DataFrame, keys: Sequence[str], value: str, period: str) -> DataFrame:
    """Rows, missing values and first and last period of each combination."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(value).isNull()).alias("n_missing"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
    )


def profile_missing(df: DataFrame, keys: Sequence[str], value: str, period: str) -> DataFrame:
    """The combinations with missing values, and the periods these span."""
    return (
        df.filter(F.col(value).isNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_missing"), F.min(period).alias("first_period"), F.max(period).alias("last_period"))
    )


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations in order."""
    return df.select(*columns).distinct().orderBy(*columns)


WORD = 64


def period_sets(df: DataFrame, keys: Sequence[str], place: Column, also: Sequence[Column] = ()) -> DataFrame:
    """The periods of each key as a bitmap in words: one row per key and 64 places that hold any.

    ``place`` is a whole number, such as a year or the number of a period; rows without one belong to no word but are
    aggregated by ``also``. A word is a bigint whose bits are or-ed before the shuffle, so a key has as many short rows
    as its periods take, and sets are merged, counted and compared word by word.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(WORD)).cast("int"))
    return df.groupBy(*keys, F.floor(place / WORD).cast("bigint").alias("word")).agg(F.bit_or(bit).alias("bits"), *also)


def set_size(words: Column | None = None) -> Column:
    """The number of periods in the words of a group."""
    return F.coalesce(F.sum(F.bit_count(F.col("bits") if words is None else words)), F.lit(0)).cast("bigint")


def periods_in(sets: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """One row per key and period of a set."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.getbit("bits", k) == 1)
    return sets.filter("word is not null").select(*keys, F.explode(bits).alias("__bit"), "word").select(
        *keys, (F.col("word") * WORD + F.col("__bit")).alias(out)
    )


def period_runs(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """The runs of consecutive periods of each key: first, last and how many; a key of any number of periods needs no list."""
    held = periods_in(period_sets(df, keys, F.col(period)), keys, period)
    run = F.col(period) - F.row_number().over(Window.partitionBy(*keys).orderBy(period))
    return held.withColumn("__run", run).groupBy(*keys, "__run").agg(
        F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count(F.lit(1)).alias("n_periods")
    ).drop("__run")


def distinct_periods(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """The sorted distinct periods of each key as a list, put together from its runs; for a report on few keys."""
    runs = F.array_sort(F.collect_list(F.struct("first_period", "last_period")))
    listed = F.flatten(F.transform(runs, lambda run: F.sequence(run["first_period"], run["last_period"])))
    return period_runs(df, keys, period).groupBy(*keys).agg(listed.alias("periods"))


def n_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values each column has, NULL aside, as one row."""
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])
