"""Rounding, growth and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero by scaling, as warehouses do.

    ``F.round`` works on the decimal text of a double (1.005 becomes 1.01); the
    scaled form gives the same bits in every IEEE engine.
    """
    scale = 10.0**digits
    size = F.abs(value)
    # adding zero turns a negative zero into a plain one
    rounded = F.signum(value) * F.floor(size * scale + 0.5) / scale + 0.0
    # such large doubles have no digits left to round
    return F.when(size < 2.0**52 / scale, rounded).otherwise(value)


def round_exact(value: Column, digits: int) -> Column:
    """Round on the exact binary value of a double; true ties go to even.

    Splitting the double in two halves (Veltkamp) makes both partial products
    exact, so the rounding error of ``value * scale`` is known and decides which
    side of a tie the value lies on: 2.25 gives 2.2, 2.45 gives 2.5.
    """
    scale = 10.0**digits
    widened = value * 134217729.0
    high = widened - (widened - value)
    low = value - high
    product = value * scale
    error = (high * scale - product) + low * scale
    below = F.floor(product).cast("double")
    is_even = below % 2 == 0
    on_tie = product - below == 0.5
    rounded = (
        F.when(on_tie & (error < 0), below)
        .when(on_tie & (error > 0), below + 1)
        .when(on_tie & is_even, below)
        .otherwise(F.floor(product + 0.5).cast("double"))
    )
    return F.when(F.abs(value) >= 2.0**52 / scale, value).otherwise(rounded / scale)


def ratio_to(value: Column, base: Column, digits: int = 2) -> Column:
    """100 x value / base; NULL when either is missing or the base is zero."""
    return round_half_away(F.try_divide(100 * value, base), digits)


def pct_change(value: Column, base: Column, digits: int = 2) -> Column:
    """Change from base to value in percent."""
    return round_half_away(100 * (F.try_divide(value, base) - 1), digits)


def cagr(last: Column, first: Column, years: int, digits: int = 2) -> Column:
    """Compound growth per year, in percent."""
    growth = F.pow(F.try_divide(last, first), F.lit(1.0 / years))
    return round_half_away(100 * (growth - 1), digits)


def difference(left: Column, right: Column, digits: int) -> Column:
    """left - right for operands that were rounded before."""
    return round_half_away(left - right, digits)


def fixed_point(value: Column, scale: int) -> Column:
    """The value as a whole number of 10^-scale units."""
    return F.floor(value * 10.0**scale + 0.5)


def mean_from_units(units: Column, count: Column, scale: int) -> Column:
    """Mean from a sum of fixed-point units; NULL for an empty count."""
    return F.try_divide(units.cast("double") / 10.0**scale, count)


def mean(value: Column, scale: int | None = None) -> Column:
    """Average that ignores NULL and does not depend on the order of rows.

    The sum is exact in decimals of 18 places. A value that is too large for them raises, and so does one of which they
    lose more than a part in 10^12; ``exact.exact_mean`` takes all values. With ``scale`` values are first rounded to so
    many places.
    """
    if scale is None:
        places = value.cast("decimal(38,18)")
        lost = F.bool_or(F.abs(places.cast("double") - value) > 1e-12 * F.abs(value))
        problem = F.raise_error(F.lit("a value is too small for 18 decimal places")).cast("double")
        return F.when(lost, problem).otherwise(F.try_divide(F.sum(places).cast("double"), F.count(value)))
    return mean_from_units(F.sum(fixed_point(value, scale)), F.count(value), scale)
