"""The panel models, from four input tables to three marts and their checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import PanelConfig
from panelkit.functions import text
from panelkit.operators import checks, growth, panel
from panelkit.sources.staging import stage

MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("member_code", T.StringType()),
        T.StructField("member_iso_code", T.StringType()),
        T.StructField("member_name", T.StringType()),
        T.StructField("member_label", T.StringType()),
        T.StructField("group_header", T.StringType()),
        T.StructField("group_code", T.StringType()),
        T.StructField("group_iso_code", T.StringType()),
        T.StructField("group_name", T.StringType()),
        T.StructField("is_single_member_group", T.BooleanType()),
        T.StructField("is_autonomous", T.BooleanType()),
    ]
)

MEMBER_SCHEMA = T.StructType(
    [
        T.StructField("group_header", T.StringType(), False),
        T.StructField("member_label", T.StringType(), False),
        T.StructField("year", T.LongType(), False),
        T.StructField("quarter", T.LongType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("is_single_member_group", T.BooleanType(), False),
        T.StructField("value_flag", T.StringType(), True),
        T.StructField("source_sheet", T.StringType(), False),
    ]
)

PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("geo_level", T.StringType(), False),
        T.StructField("group_header", T.StringType(), False),
        T.StructField("year", T.LongType(), False),
        T.StructField("quarter", T.LongType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("value_flag", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class PanelInputs:
    """Staged source tables and the mapping between them."""

    index_long: DataFrame
    members: DataFrame
    published: DataFrame
    mapping: DataFrame


MARTS = ("mart_trend_group", "mart_growth_summary", "mart_trend_member")


@dataclass(frozen=True)
class Models:
    inputs: PanelInputs
    annual: DataFrame
    groups: DataFrame
    trend: DataFrame
    summary: DataFrame
    member_trend: DataFrame


def stage_members(raw: DataFrame) -> DataFrame:
    """Types and the quarter start date; nothing else changes."""
    year, quarter = F.col("year").cast("bigint"), F.col("quarter").cast("bigint")
    return raw.select(
        "group_header",
        "member_label",
        year.alias("year"),
        quarter.alias("quarter"),
        text.quarter_start(year, quarter).alias("quarter_start_date"),
        F.col("value").cast("double").alias("value"),
        "value_flag",
        "is_single_member_group",
        "source_sheet",
    )


def stage_published(raw: DataFrame) -> DataFrame:
    year, quarter = F.col("year").cast("bigint"), F.col("quarter").cast("bigint")
    return raw.select(
        "geo_level",
        "group_header",
        year.alias("year"),
        quarter.alias("quarter"),
        text.quarter_start(year, quarter).alias("quarter_start_date"),
        F.col("value").cast("double").alias("value"),
        "value_flag",
    )


def annual_model(inputs: PanelInputs, cfg: PanelConfig) -> DataFrame:
    """Levels are averaged apart, as no mean spans two of them: members stored by member need no shuffle."""
    levels = (panel.member_level(inputs.members), panel.published_level(inputs.published))
    own = [panel.annualise(level, periods=cfg.periods_per_year, scale=cfg.value_scale) for level in levels]
    return own[0].unionByName(own[1])


def group_model(annual: DataFrame, mapping: DataFrame, cfg: PanelConfig) -> DataFrame:
    series = panel.published_series(annual, mapping, cfg.national_code, cfg.national_name)
    rollup = panel.simple_mean_rollup(annual, mapping, cfg.value_scale)
    return panel.group_annual(series, rollup, cfg.national_code)


def trend_model(inputs: PanelInputs, groups: DataFrame, cfg: PanelConfig) -> DataFrame:
    wide = panel.index_pivot(inputs.index_long)
    return panel.trend_by_group(wide, groups, inputs.mapping, cfg.base_year, cfg.national_code)


def build_models(
    inputs: PanelInputs,
    cfg: PanelConfig,
    store: Callable[[DataFrame, str], DataFrame] = stage,
    store_last: Callable[[DataFrame, str], DataFrame] = lambda df, _: df,
) -> Models:
    """All models in dependency order.

    What several later models or checks read is stored once: the marts by
    ``store``, the last of them, which no model reads, by ``store_last``.
    """
    annual = stage(annual_model(inputs, cfg), "annual")
    groups = stage(group_model(annual, inputs.mapping, cfg), "groups")
    trend = store(trend_model(inputs, groups, cfg), "mart_trend_group")
    summary = store(growth.growth_summary(annual, groups, inputs.index_long, inputs.mapping, cfg), "mart_growth_summary")
    detail = growth.trend_by_member(inputs.members, annual, summary, inputs.mapping, cfg)
    member_trend = store_last(detail, "mart_trend_member")
    return Models(inputs, annual, groups, trend, summary, member_trend)


def _present(table: str, columns: str) -> dict:
    return {f"{table}.{c} not null": checks.is_null(c) for c in columns.split()}


def _domain(table: str, column: str, values: list) -> dict:
    return {f"{table}.{column} accepted": checks.not_accepted(column, values)}


MEMBER_NAMES = ("member_code", "member_iso_code", "member_name", "member_label")


def input_suite(inputs: PanelInputs) -> checks.Suite:
    """The checks of the source tables and the mapping, before any model is built."""
    mapping, members, published, index = inputs.mapping, inputs.members, inputs.published, inputs.index_long
    suite = (
        checks.Suite()
        .rows(
            index,
            _present("index", "group_code index_type metric_type year")
            | _domain("index", "index_type", ["general", "new", "second_hand"])
            | _domain("index", "metric_type", ["index", "annual_variation_pct"]),
        )
        .rows(
            members,
            _present("members", "group_header member_label year quarter")
            | _domain("members", "quarter", [1, 2, 3, 4])
            | _domain("members", "value_flag", [text.NO_DATA, text.NOT_REPRESENTATIVE]),
        )
        .rows(
            published,
            _present("published", "group_header year quarter")
            | _domain("published", "geo_level", [panel.NATIONAL, panel.GROUP]),
        )
        .rows(mapping, _present("mapping", f"{' '.join(MEMBER_NAMES)} group_header group_code group_iso_code group_name"))
    )
    unique_names = {f"mapping.{name} unique": name for name in MEMBER_NAMES}
    return (
        suite.keys(index, {"index grain": ["group_code", "index_type", "metric_type", "year"]})
        .keys(members, {"members grain": ["member_label", "year", "quarter"]})
        .keys(published, {"published grain": ["group_header", "year", "quarter"]})
        .keys(mapping, unique_names | {"mapping grain": ["group_header", "member_label"]})
        .add("members in mapping", checks.relationships(members, "member_label", mapping))
        .add("mapping covered", checks.reverse_coverage(mapping, members, "member_label", ["year", "quarter"]))
        .add("hierarchy agrees", checks.hierarchy_agrees(members, mapping))
        .add("code sets equal", checks.set_equality(index.filter(~F.col("is_national")), mapping, "group_code"))
    )


def model_suite(models: Models, cfg: PanelConfig, first_year: int, n_entities: int) -> checks.Suite:
    """The checks of the models and marts."""
    annual, groups, trend = models.annual, models.groups, models.trend
    summary, detail, mapping = models.summary, models.member_trend, models.inputs.mapping
    alone = F.col("is_single_member_group") | F.col("is_autonomous")
    suite = (
        checks.Suite()
        .rows(annual, _present("annual", "geo_level group_header year"))
        .rows(
            groups,
            _present("groups", "group_code year")
            | {"groups single member equal": alone & checks.differs("value", "member_simple_mean")},
        )
        .rows(
            trend,
            _present("trend", "group_code group_name year")
            | {"trend base is 100": checks.off_base(["index_rebased", "value_rebased"], "year", cfg.base_year)},
        )
        .rows(
            detail,
            _present("member_trend", "member_code member_name group_code year quarter")
            | _domain("member_trend", "rank_group", [f"Top {cfg.top_n}", f"Bottom {cfg.top_n}"]),
        )
        .rows(summary, _present("summary", "member_code member_iso_code member_name growth_pct"))
    )
    coverage = checks.panel_coverage(trend, "year", first_year, cfg.last_full_year, n_entities, ["index_general", "value"])
    return (
        suite.keys(summary, {f"summary.{name} unique": name for name in ("member_code", "member_iso_code")})
        .keys(annual, {"annual grain": ["geo_level", "group_header", "member_label", "year"]})
        .keys(groups, {"groups grain": ["group_code", "year"]})
        .keys(trend, {"trend grain": ["group_code", "year"]})
        .keys(detail, {"member_trend grain": ["member_code", "year", "quarter"]})
        .add("member_trend in mapping", checks.relationships(detail, "member_code", mapping))
        .add("trend coverage", coverage)
    )


def quality_suite(models: Models, cfg: PanelConfig, first_year: int, n_entities: int) -> checks.Suite:
    """All 64 checks: not null, unique, domains, links and invariants."""
    return input_suite(models.inputs).join(model_suite(models, cfg, first_year, n_entities))
