"""Bringing panels to a common grain and comparing them.

Default column names follow the panel models: ``value``/``value_flag`` by
``year`` and ``quarter`` for the level source, ``index_*`` for the index source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import numeric, text
from panelkit.operators.ordered import number_distinct

MEMBER, GROUP, NATIONAL = "member", "group", "national"


# Missing periods of a run that are listed together.
RUN_PERIODS = 4096


def missing_runs(members: DataFrame, places: DataFrame, keys: Sequence[str], place: str, n_places: Column) -> DataFrame:
    """(keys, first, last) of the runs of places that a member lacks between 0 and n_places - 1.

    A run lies between one place that a member has and the next; the ends of the calendar bound the first and the last.
    """
    marks = members.select(*keys, F.lit(-1).cast("bigint").alias("__at")).unionAll(places.select(*keys, F.col(place).cast("bigint")))
    following = F.coalesce(F.lead("__at").over(Window.partitionBy(*keys).orderBy("__at")), n_places)
    runs = marks.select(*keys, (F.col("__at") + 1).alias("first"), (following - 1).cast("bigint").alias("last"))
    return runs.filter("first <= last")


def calendar_of(observed: DataFrame, periods: Sequence[str]) -> DataFrame:
    """The distinct periods with their number, stored; a NULL is no period."""
    return number_distinct(observed.dropna(subset=list(periods)), periods, "__place")


def dense_grid(
    members: DataFrame, observed: DataFrame, keys: Sequence[str], periods: Sequence[str], calendar: DataFrame | None = None
) -> DataFrame:
    """Every member in every period that occurs anywhere, with the observed columns or NULL; a NULL is no period.

    The distinct periods are numbered by ranges. What a member has stays; what it lacks is found as runs between the
    numbers that it has, and only these are spelt out, so no list of all periods exists anywhere. Panels with the same
    periods can share their ``calendar``.
    """
    known = observed.dropna(subset=list(periods))
    calendar = calendar or calendar_of(known, periods)
    n_places = calendar.agg(F.count(F.lit(1))).scalar()
    own = known.join(members.select(*keys), list(keys), "left_semi").join(calendar, list(periods))
    runs = missing_runs(members, own, keys, "__place", n_places)
    # a long run is cut into pieces, so that no list is long
    pieces = runs.select(*keys, "last", F.explode(F.sequence("first", "last", F.lit(RUN_PERIODS).cast("bigint"))).alias("first"))
    upto = F.least(F.col("first") + RUN_PERIODS - 1, F.col("last"))
    lacking = pieces.select(*keys, F.explode(F.sequence("first", upto)).alias("__place")).join(calendar, "__place")
    slots = own.drop("__place").unionByName(lacking.drop("__place"), allowMissingColumns=True)
    others = [c for c in members.columns if c not in keys]
    return members.join(slots, list(keys)).select(
        *keys, *periods, *others, *[c for c in observed.columns if c not in (*keys, *periods)]
    )


def flagged_mean(units: Column, count: Column, scale: int, min_obs: int, digits: int = 1) -> tuple[Column, Column]:
    """The mean of the observations behind a cell, and why it is withheld."""
    seen = F.coalesce(count, F.lit(0))
    flag = F.when(seen == 0, text.NO_DATA).when(seen < min_obs, text.NOT_REPRESENTATIVE)
    value = F.when(seen >= max(min_obs, 1), numeric.round_half_away(numeric.mean_from_units(units, count, scale), digits))
    return value, flag


def member_level(members: DataFrame) -> DataFrame:
    return members.select(F.lit(MEMBER).alias("geo_level"), "group_header", "member_label", "year", "value", "value_flag")


def published_level(aggregates: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string").alias("member_label")
    return aggregates.select("geo_level", "group_header", none, "year", "value", "value_flag")


def stack_levels(members: DataFrame, aggregates: DataFrame) -> DataFrame:
    """Member and published rows in one table, told apart by geo_level."""
    return member_level(members).unionByName(published_level(aggregates))


def annualise(
    df: DataFrame,
    keys: Sequence[str] = ("geo_level", "group_header", "member_label", "year"),
    periods: int = 4,
    scale: int | None = None,
    digits: int = 1,
) -> DataFrame:
    """Mean of the periods that have a value, and how complete the year is."""
    value = F.col("value")
    return df.groupBy(*keys).agg(
        numeric.round_half_away(numeric.mean(value, scale), digits).alias("value_annual_mean"),
        F.count(value).alias("periods_available"),
        (F.count(value) == periods).alias("is_complete_year"),
        F.count_if(F.col("value_flag") == text.NOT_REPRESENTATIVE).alias("periods_not_representative"),
    )


def group_lookup(mapping: DataFrame) -> DataFrame:
    """The published header of every group that has one of its own."""
    return mapping.filter(~F.col("is_autonomous")).select("group_header", "group_code", "group_name").distinct()


def published_series(annual: DataFrame, mapping: DataFrame, national_code: str, national_name: str) -> DataFrame:
    """The headline value of every group and year.

    Groups take their published row, autonomous members their own row, and the
    total becomes the national code; a header shared by autonomous members is
    left out. The three cases are three kinds of entry in one small lookup, so
    the annual table is read once.
    """
    groups = group_lookup(mapping).select(
        F.lit(GROUP).alias("geo_level"),
        F.col("group_header").alias("series_key"),
        "group_code",
        "group_name",
        F.lit("published_group").alias("value_source"),
    )
    cities = mapping.filter("is_autonomous").select(
        F.lit(MEMBER).alias("geo_level"),
        F.col("member_label").alias("series_key"),
        "group_code",
        "group_name",
        F.lit("member_row").alias("value_source"),
    )
    level, header, member = F.col("geo_level"), F.col("group_header"), F.col("member_label")
    is_national = level == NATIONAL
    matched = annual.withColumn("series_key", F.when(level == MEMBER, member).otherwise(header)).join(
        groups.unionByName(cities), ["geo_level", "series_key"], "left"
    )
    return matched.filter(is_national | F.col("value_source").isNotNull()).select(
        F.when(is_national, F.lit(national_code)).otherwise(F.col("group_code")).alias("group_code"),
        F.when(is_national, F.lit(national_name)).otherwise(F.col("group_name")).alias("group_name"),
        "year",
        F.col("value_annual_mean").alias("value"),
        F.when(is_national, F.lit("published_total")).otherwise(F.col("value_source")).alias("value_source"),
        "periods_available",
        "is_complete_year",
    )


def simple_mean_rollup(annual: DataFrame, mapping: DataFrame, scale: int | None = None, digits: int = 1) -> DataFrame:
    """Unweighted mean of the members of a group, as a cross-check of the published value."""
    members = annual.filter(F.col("geo_level") == MEMBER).select("member_label", "year", "value_annual_mean")
    codes = mapping.select("member_label", "group_code", "is_single_member_group", "is_autonomous")
    value = F.col("value_annual_mean")
    return (
        members.join(codes, "member_label")
        .groupBy("group_code", "year")
        .agg(
            numeric.round_half_away(numeric.mean(value, scale), digits).alias("member_simple_mean"),
            F.count(F.lit(1)).alias("n_members"),
            F.count(value).alias("n_members_with_data"),
            F.bool_and("is_single_member_group").alias("is_single_member_group"),
            F.bool_and("is_autonomous").alias("is_autonomous"),
        )
    )


def group_annual(series: DataFrame, rollup: DataFrame, national_code: str) -> DataFrame:
    """Headline series with the rollup beside it; flags default to false."""
    return series.join(rollup, ["group_code", "year"], "left").select(
        "group_code",
        "group_name",
        "year",
        "value",
        "value_source",
        "periods_available",
        "is_complete_year",
        "member_simple_mean",
        "n_members",
        "n_members_with_data",
        F.coalesce("is_single_member_group", F.lit(False)).alias("is_single_member_group"),
        F.coalesce("is_autonomous", F.lit(False)).alias("is_autonomous"),
        (F.col("group_code") == national_code).alias("is_national"),
    )


def weighted_vs_simple(groups: DataFrame) -> DataFrame:
    """How far the unweighted mean lies from the published value, in percent."""
    return groups.filter(F.col("member_simple_mean").isNotNull()).select(
        "group_code",
        "year",
        "value",
        "member_simple_mean",
        numeric.pct_change(F.col("member_simple_mean"), F.col("value"), 1).alias("simple_gap_pct"),
    )


def pivot_measures(
    long: DataFrame, keys: Sequence[str], value: str, cells: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Long to wide in one aggregation; a cell that does not occur is NULL.

    ``cells`` names each output column and the category values that select it.
    """

    def chosen(where: Mapping[str, str]) -> Column:
        condition = F.lit(True)
        for column, wanted in where.items():
            condition = condition & (F.col(column) == wanted)
        return F.max(F.when(condition, F.col(value)))

    return long.groupBy(*keys).agg(*[chosen(where).alias(name) for name, where in cells.items()])


# The four measures of the index source.
INDEX_CELLS = {
    "index_general": {"index_type": "general", "metric_type": "index"},
    "index_new": {"index_type": "new", "metric_type": "index"},
    "index_second_hand": {"index_type": "second_hand", "metric_type": "index"},
    "index_annual_variation_pct": {"index_type": "general", "metric_type": "annual_variation_pct"},
}


def index_pivot(long: DataFrame) -> DataFrame:
    return pivot_measures(long, ["group_code", "year"], "value", INDEX_CELLS)


def align_panels(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("group_code", "year")) -> DataFrame:
    """Every entity and period of either panel, keys merged."""
    return left.join(right, list(keys), "full")


def gated_yoy(
    value: Column, complete: Column, entity: Sequence[str] = ("group_code",), period: str = "year", digits: int = 2
) -> Column:
    """Change from the previous row, only when both rows are complete."""
    order = Window.partitionBy(*entity).orderBy(period)
    both = complete & F.lag(complete).over(order)
    return F.when(both, numeric.pct_change(value, F.lag(value).over(order), digits))


def rebase(
    value: Column,
    base_period: int,
    entity: Sequence[str] = ("group_code",),
    period: str = "year",
    gate: Column | None = None,
    gate_base: bool = False,
    digits: int = 2,
) -> Column:
    """The series as 100 in the base period.

    A gate blanks rows where it is false; the base value itself is only gated
    on request.
    """
    is_base = F.col(period) == base_period
    if gate is not None and gate_base:
        is_base = is_base & gate
    base = F.max(F.when(is_base, value)).over(Window.partitionBy(*entity))
    rebased = numeric.ratio_to(value, base, digits)
    return rebased if gate is None else F.when(gate, rebased)


def seasonal_yoy(
    df: DataFrame,
    keys: Sequence[str] = ("member_label",),
    year: str = "year",
    season: str | None = "quarter",
    value: str = "value",
) -> DataFrame:
    """The value of the same season one calendar year before, and the change.

    Needs the grain (keys, year, season) to be unique; a yearly panel has no
    season. Reading the previous row of an entity, season by season,
    and keeping it only when it is last year's replaces a self join: one pass
    over the panel and one shuffle by entity, which later joins by entity need
    as well, or none where the panel is stored by entity.
    """
    order = Window.partitionBy(*keys).orderBy(*([season] if season else []), year)
    is_prior = F.lag(year).over(order) == F.col(year) - 1
    if season:
        is_prior = is_prior & (F.lag(season).over(order) == F.col(season))
    prior = F.when(is_prior, F.lag(value).over(order))
    return df.withColumn("value_prior_year", prior).withColumn(
        "yoy_pct", numeric.pct_change(F.col(value), F.col("value_prior_year"), 2)
    )


def rebase_to_annual(quarters: DataFrame, annual: DataFrame, base_year: int) -> DataFrame:
    """Each quarter over the member's mean of the base year."""
    base = annual.filter((F.col("geo_level") == MEMBER) & (F.col("year") == base_year)).select(
        "member_label", F.col("value_annual_mean").alias("base_value")
    )
    return (
        quarters.join(base, "member_label", "left")
        .withColumn("index_rebased", numeric.ratio_to(F.col("value"), F.col("base_value"), 2))
        .drop("base_value")
    )


def trend_by_group(
    index_wide: DataFrame,
    groups: DataFrame,
    mapping: DataFrame,
    base_year: int,
    national_code: str,
    strict_complete: bool = False,
) -> DataFrame:
    """Index and value side by side per group and year, comparable as growth only."""
    levels = groups.select(
        "group_code",
        "year",
        "group_name",
        "is_single_member_group",
        "is_autonomous",
        "value",
        "value_source",
        "periods_available",
        "is_complete_year",
        "member_simple_mean",
        "n_members",
    )
    complete = F.col("is_complete_year")
    entity = Window.partitionBy("group_code")
    # the attributes of a group do not change over time; the rebasing already
    # brings its years together, which saves a join of the attributes
    attributes = ("group_name", "is_single_member_group", "is_autonomous")
    grown = align_panels(index_wide, levels).select(
        *[c for c in [*index_wide.columns, *levels.columns[2:]] if c not in attributes],
        *[F.max(name).over(entity).alias(name) for name in attributes],
        gated_yoy(F.col("value"), complete).alias("value_yoy_pct"),
        rebase(F.col("index_general"), base_year).alias("index_rebased"),
        rebase(F.col("value"), base_year, gate=complete, gate_base=strict_complete).alias("value_rebased"),
    )
    iso = mapping.select("group_code", "group_iso_code").distinct()
    return (
        grown.join(iso, "group_code", "left")
        .select(
            "group_code",
            "group_name",
            "group_iso_code",
            "year",
            (F.col("group_code") == national_code).alias("is_national"),
            "is_single_member_group",
            "is_autonomous",
            "n_members",
            "index_general",
            "index_new",
            "index_second_hand",
            "index_annual_variation_pct",
            "value",
            "value_source",
            "periods_available",
            "is_complete_year",
            "member_simple_mean",
            "value_yoy_pct",
            F.lit(base_year).cast("bigint").alias("rebase_year"),
            "index_rebased",
            "value_rebased",
            numeric.difference(F.col("value_rebased"), F.col("index_rebased"), 2).alias("rebased_gap_pts"),
        )
    )
