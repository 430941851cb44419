"""Sums and means of doubles that are exact before their last rounding.

A double is a whole number times a power of two. Powers are cut into bins of 60 bits; a value falls into two
neighbouring bins at most, as two whole numbers, and whole numbers add up exactly in any order. Rows are added by key
and bin before the shuffle, so a key is a few dozen short rows however many it has. At the end the bins of a key are
brought to one number, whose first 60 to 120 bits and the mark of a rest below them decide the rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bin, the exponent of the smallest double, and the bins that hold all doubles; two more take carries.
WIDTH, LOWEST, BINS = 60, -1074, 35
UNITS = [2.0 ** (WIDTH * k + LOWEST) for k in range(BINS)] + [float("inf")] * 2
WHOLE = "decimal(38,0)"


def _units(k: Column) -> Column:
    return F.get(F.array(*map(F.lit, UNITS)), k)


def _parts(value: Column) -> Column:
    """The whole numbers of a finite value with their bins: (bin, part, n), n being 1 for one of them."""
    size, sign = F.abs(value), F.signum(value)
    # the logarithm may be off by one at the border of a bin, which only makes a part a bit longer
    k = F.when(size > 0, F.least(F.greatest(F.floor((F.log2(size) - LOWEST) / WIDTH), F.lit(0)), F.lit(BINS - 1))).otherwise(0).cast("int")
    scaled = size / _units(k)
    high = F.floor(scaled)
    low = (scaled - high) * 2.0**WIDTH

    def part(at: Column, whole: Column, n: int) -> Column:
        return F.struct(at.alias("bin"), (sign * whole).cast("decimal(28,0)").alias("part"), F.lit(n).alias("n"))

    return F.array(part(k, high, 1), part(k - 1, low, 0))


def exact_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, n (values, NULL aside) and total: the sum as one rounding of its exact value."""
    x = F.col(value).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = df.select(*keys, x.alias("__x"), F.explode(_parts(F.when(finite, x).otherwise(0.0))).alias("__p"))
    rows = rows.filter("__p.n = 1 or __p.part <> 0").withColumn("__once", F.when(F.col("__p.n") == 1, F.col("__x")))
    once = F.col("__once")
    counts = {"n": once.isNotNull(), "nan": F.isnan(once), "above": once == float("inf"), "below": once == -float("inf")}
    by_bin = rows.groupBy(*keys, F.col("__p.bin").alias("bin")).agg(
        F.sum("__p.part").alias("s"), *[F.count_if(c).alias(name) for name, c in counts.items()]
    )
    bins = F.map_from_entries(F.collect_list(F.struct("bin", "s"))).alias("bins")
    whole = by_bin.groupBy(*keys).agg(bins, *[F.sum(name).alias(name) for name in counts])
    total = (
        F.when((F.col("nan") > 0) | ((F.col("above") > 0) & (F.col("below") > 0)), float("nan"))
        .when(F.col("above") > 0, float("inf"))
        .when(F.col("below") > 0, -float("inf"))
        .otherwise(F.col("total"))
    )
    return _rounded(whole).select(*keys, "n", F.when(F.col("n") > 0, total).alias("total"))


def exact_mean(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    """keys, n and the exact sum, once rounded, over n; NULL where there is no value."""
    return exact_sums(df, keys, value).select(*keys, "n", F.try_divide("total", F.col("n")).alias(out))


def _digits(sign: Column) -> Column:
    """The bins as digits from 0 to 2**60 - 1, lowest first, and what is carried beyond the last."""
    base = F.lit(2**WIDTH).cast(WHOLE)
    start = F.struct(F.array().cast(f"array<{WHOLE}>").alias("digits"), F.lit(0).cast(WHOLE).alias("carry"))

    def step(done: Column, k: Column) -> Column:
        here = (sign * F.coalesce(F.try_element_at("bins", k), F.lit(0).cast(WHOLE)) + done["carry"]).cast(WHOLE)
        digit = F.pmod(here, base).cast(WHOLE)
        carry = F.call_function("div", (here - digit).cast(WHOLE), base).cast(WHOLE)
        return F.struct(F.concat(done["digits"], F.array(digit)).alias("digits"), carry.alias("carry"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BINS + 1)), start, step)


def _rounded(whole: DataFrame) -> DataFrame:
    """Add total, the double nearest to the number that the bins make."""
    whole = whole.withColumn("sign", F.when(_digits(F.lit(1).cast(WHOLE))["carry"] < 0, -1).otherwise(1).cast(WHOLE))
    whole = whole.withColumn("digits", _digits(F.col("sign"))["digits"])
    whole = whole.withColumn("top", F.array_max(F.transform("digits", lambda d, k: F.when(d > 0, k))))
    first, second = F.get("digits", F.col("top")), F.get("digits", F.col("top") - 1)
    rest = F.exists(F.slice("digits", 1, F.greatest(F.col("top") - 1, F.lit(0))), lambda d: d > 0)
    # a mark below the last bit turns the rounding where a rest lies behind it
    front = (2 * (first * F.lit(2**WIDTH).cast(WHOLE) + second) + rest.cast("int")).cast(WHOLE)
    long = front.cast("double") * 0.5 * _units(F.col("top") - 1)
    short = first.cast("double") * F.lit(UNITS[0])
    size = F.when(F.col("top").isNull(), 0.0).when(F.col("top") == 0, short).otherwise(long)
    return whole.withColumn("total", size * F.col("sign").cast("double"))
