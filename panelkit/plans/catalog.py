"""One query per operator, run on the trade tables.

Each takes a session and the folder of the Parquet tables and returns a frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import numeric, text
from panelkit.operators import checks, exact, grid, growth, ordered, panel, profiling
from panelkit.plans import build, index_file, marts, trade
from panelkit.plans.trade import CONFIG
from panelkit.sources import tables
from panelkit.sources.delimited import read_delimited
from panelkit.sources.snapshot import Snapshot
from panelkit.sources.staging import shared_dir, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Trade:
    """The tables of one folder and the frames derived from them, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, min_obs: int = trade.MIN_OBS):
        self.spark, self.sf_dir, self.min_obs = spark, sf_dir, min_obs

    def table(self, name: str) -> DataFrame:
        return trade.table(self.spark, self.sf_dir, name)

    @cached_property
    def mapping(self) -> DataFrame:
        return trade.mapping(self.spark, self.sf_dir)

    @cached_property
    def order_totals(self) -> DataFrame:
        return trade.order_totals(self.spark, self.sf_dir)

    @cached_property
    def line_totals(self) -> DataFrame:
        return trade.line_totals(self.spark, self.sf_dir)

    @cached_property
    def members(self) -> DataFrame:
        return marts.stage_members(trade.member_quarter(self.mapping, self.order_totals, self.min_obs))

    @cached_property
    def published(self) -> DataFrame:
        return marts.stage_published(trade.published_quarter(self.mapping, self.order_totals, self.min_obs))

    @cached_property
    def index_long(self) -> DataFrame:
        return index_file.stage_index(trade.index_raw(self.mapping, self.line_totals))

    @cached_property
    def inputs(self) -> marts.PanelInputs:
        """Both sides as stored tables, for the models that bring them together."""
        return trade.panel_inputs(self.spark, self.sf_dir, self.min_obs)

    @cached_property
    def stored_annual(self) -> DataFrame:
        return stage(marts.annual_model(self.inputs, CONFIG), "annual")

    @cached_property
    def annual(self) -> DataFrame:
        return panel.annualise(panel.stack_levels(self.members, self.published), scale=CONFIG.value_scale)

    @cached_property
    def groups(self) -> DataFrame:
        return marts.group_model(stage(self.annual, "annual"), stage(self.mapping, "mapping"), CONFIG)

    @cached_property
    def stored_groups(self) -> DataFrame:
        return stage(marts.group_model(self.stored_annual, self.inputs.mapping, CONFIG), "groups")

    @cached_property
    def trend(self) -> DataFrame:
        groups = marts.group_model(self.stored_annual, self.inputs.mapping, CONFIG)
        return marts.trend_model(self.inputs, groups, CONFIG)

    @cached_property
    def anchors(self) -> DataFrame:
        return growth.anchor_values(self.stored_annual, self.stored_groups, self.inputs.index_long, CONFIG)

    @cached_property
    def stored_trend(self) -> DataFrame:
        return stage(self.trend, "trend")

    @cached_property
    def summary(self) -> DataFrame:
        return growth.growth_summary(self.stored_annual, self.stored_groups, self.inputs.index_long, self.inputs.mapping, CONFIG)

    @cached_property
    def models(self) -> marts.Models:
        return marts.build_models(self.inputs, CONFIG)

    @cached_property
    def cells(self) -> DataFrame:
        members = trade.member_quarter(self.mapping, self.order_totals, self.min_obs)
        published = trade.published_quarter(self.mapping, self.order_totals, self.min_obs)
        values = stage(trade.sheet_values(self.mapping, members, published), "sheet-values")
        return stage(trade.sheet_cells(values), "cells")

    @cached_property
    def parsed(self) -> grid.GridResult:
        return grid.parse_grid(self.cells, trade.HEADERS, trade.SELF_NAMES, layout=trade.LAYOUT)


def query(build: Callable[[Trade], DataFrame]) -> Callable[[Trade], DataFrame]:
    """Register a query under the name of its function."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Trade(spark, sf_dir))
    return build


# -- staging --------------------------------------------------------------------


@query
def seed_mapping(t: Trade) -> DataFrame:
    return t.mapping


@query
def stage_index_long(t: Trade) -> DataFrame:
    return t.index_long


@query
def member_quarter(t: Trade) -> DataFrame:
    return t.members


@query
def published_quarter(t: Trade) -> DataFrame:
    return t.published


# -- panels ---------------------------------------------------------------------


@query
def stack_levels(t: Trade) -> DataFrame:
    return panel.stack_levels(t.members, t.published)


@query
def annualise(t: Trade) -> DataFrame:
    return t.annual


@query
def group_lookup(t: Trade) -> DataFrame:
    return panel.group_lookup(t.mapping)


@query
def published_series(t: Trade) -> DataFrame:
    return panel.published_series(t.annual, t.mapping, CONFIG.national_code, CONFIG.national_name)


@query
def simple_mean_rollup(t: Trade) -> DataFrame:
    return panel.simple_mean_rollup(t.annual, t.mapping, CONFIG.value_scale)


@query
def group_annual(t: Trade) -> DataFrame:
    return t.groups


@query
def weighted_vs_simple(t: Trade) -> DataFrame:
    return panel.weighted_vs_simple(t.groups)


@query
def index_pivot(t: Trade) -> DataFrame:
    return panel.index_pivot(t.index_long)


@query
def align_panels(t: Trade) -> DataFrame:
    levels = t.groups.select("group_code", "year", "value", "is_complete_year")
    return panel.align_panels(panel.index_pivot(t.index_long), levels)


@query
def gated_yoy(t: Trade) -> DataFrame:
    yoy = panel.gated_yoy(F.col("value"), F.col("is_complete_year"))
    return t.groups.select("group_code", "year", "value", "is_complete_year", yoy.alias("value_yoy_pct"))


@query
def rebase_series(t: Trade) -> DataFrame:
    value, complete, base = F.col("value"), F.col("is_complete_year"), CONFIG.base_year
    return t.groups.select(
        "group_code",
        "year",
        panel.rebase(value, base).alias("value_rebased"),
        panel.rebase(value, base, gate=complete).alias("value_rebased_complete"),
    )


@query
def mart_trend_group(t: Trade) -> DataFrame:
    return t.trend


@query
def seasonal_yoy(t: Trade) -> DataFrame:
    return panel.seasonal_yoy(t.members.select("member_label", "year", "quarter", "value"))


@query
def rebase_to_annual(t: Trade) -> DataFrame:
    quarters = t.members.select("member_label", "year", "quarter", "value")
    return panel.rebase_to_annual(quarters, t.annual, CONFIG.base_year)


@query
def mart_trend_member(t: Trade) -> DataFrame:
    return t.models.member_trend


@query
def exact_mean(t: Trade) -> DataFrame:
    """The mean by type of event of values that lie fifty orders of magnitude apart, and partly cancel out."""
    value, kind = F.col("value"), F.col("event_id") % 4
    spread = F.when(kind == 0, value * 1e25).when(kind == 1, value * -1e25).when(kind == 2, value * 1e-25).otherwise(value)
    return exact.exact_mean(t.table("events").select("event_type", spread.alias("spread")), ["event_type"], "spread")


# -- growth ---------------------------------------------------------------------


@query
def growth_windows(t: Trade) -> DataFrame:
    return growth.growth_windows(growth.member_anchors(t.anchors, t.inputs.mapping), CONFIG)


@query
def benchmark_growth(t: Trade) -> DataFrame:
    members = growth.member_anchors(t.anchors, t.inputs.mapping).select("member_code", "group_code")
    return growth.benchmark_growth(members, growth.group_anchors(t.anchors), CONFIG.national_code)


@query
def mart_growth_summary(t: Trade) -> DataFrame:
    return t.summary


def customer_growth(t: Trade) -> DataFrame:
    """Growth of the order value of each customer between the first and the last year."""
    year = F.year("o_orderdate")
    units = numeric.fixed_point(F.col("o_totalprice"), trade.MONEY_SCALE)
    # plain ranges of dates, which reach the scan
    in_year = [
        (F.col("o_orderdate") >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
        for y in (CONFIG.base_year, CONFIG.last_full_year)
    ]
    by_customer = (
        t.table("orders")
        .filter(in_year[0] | in_year[1])
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            *[
                F.sum(F.when(year == wanted, units)).cast("double").alias(name)
                for name, wanted in [("first", CONFIG.base_year), ("last", CONFIG.last_full_year)]
            ]
        )
    )
    return (
        t.table("customer")
        .select("c_custkey")
        .join(by_customer, "c_custkey", "left")
        .select("c_custkey", numeric.pct_change(F.col("last"), F.col("first"), 1).alias("growth_pct"))
    )


@query
def rank_groups(t: Trade) -> DataFrame:
    return growth.rank_groups(customer_growth(t), top_n=CONFIG.top_n)


@query
def finding_spread(t: Trade) -> DataFrame:
    return growth.spread(stage(t.summary, "summary"), CONFIG.top_n)


@query
def finding_group_gap(t: Trade) -> DataFrame:
    return growth.group_gap(t.summary)


@query
def finding_source_lag(t: Trade) -> DataFrame:
    return growth.source_lag(t.stored_trend, CONFIG)


# -- hierarchy by row order -----------------------------------------------------


def turns(t: Trade) -> DataFrame:
    return t.table("conversations")


IS_HEADER = "role = 'user'"


def header_turns(t: Trade) -> DataFrame:
    """Each turn with the number of the last header turn at or before it."""
    rows = turns(t).select("conv_id", "turn", "role")
    return grid.fill_header(rows, ["conv_id"], "turn", F.expr(IS_HEADER), F.col("turn"), "header_turn")


@query
def fill_header(t: Trade) -> DataFrame:
    filled = grid.fill_header(turns(t), ["conv_id"], "turn", F.expr(IS_HEADER), F.col("text"), "header")
    orphan = (F.col("role") != "user") & F.col("header").isNull()
    return filled.select("conv_id", "turn", "role", "header", orphan.alias("is_orphan"))


@query
def self_children(t: Trade) -> DataFrame:
    rows = stage(header_turns(t), "tree").filter(F.col("header_turn").isNotNull())
    alone = grid.childless_headers(rows.filter(IS_HEADER), rows.filter(f"not {IS_HEADER}"), ["conv_id", "header_turn"])
    return alone.select("conv_id", "header_turn", F.lit("self").alias("member"))


@query
def number_members(t: Trade) -> DataFrame:
    children = stage(header_turns(t), "tree").filter(f"not ({IS_HEADER}) and header_turn is not null")
    return ordered.number_in_group(children, ["conv_id", "header_turn"], "turn", "position")


@query
def block_cut(t: Trade) -> DataFrame:
    stop = (text.normalise_label(F.col("text")) == "") | F.col("text").startswith("Th")
    return ordered.cut_block(turns(t).select("conv_id", "turn", "role", "text"), ["conv_id"], "turn", stop).drop("text")


@query
def tree_consistency(t: Trade) -> DataFrame:
    tree = stage(header_turns(t), "tree").select(
        F.col("conv_id").alias("sheet"),
        F.coalesce("header_turn", F.lit(-1)).alias("header"),
        F.col("turn").alias("position"),
        F.col("role").alias("member"),
    )
    return grid.tree_consistency(tree)


@query
def tree_vs_reference(t: Trade) -> DataFrame:
    places = t.table("nation").join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    held = t.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    found = held.select(F.col("r_name").alias("header"), F.col("n_name").alias("member"))
    wanted = t.mapping.select(F.col("group_header").alias("header"), F.col("member_label").alias("member"))
    return grid.tree_difference(found, wanted)


@query
def fill_period(t: Trade) -> DataFrame:
    return grid.period_map(t.cells, trade.LAYOUT)


@query
def unpivot_wide(t: Trade) -> DataFrame:
    cells = {f"Q{q}": {"quarter_text": str(q)} for q in range(1, 5)}
    labelled = t.members.withColumn("quarter_text", F.col("quarter").cast("string"))
    wide = panel.pivot_measures(labelled, ["member_label", "year"], "value", cells)
    with_total = wide.withColumn("annual_change", F.col("Q4") - F.col("Q1"))
    return grid.unpivot_periods(with_total, ["member_label", "year"], {f"Q{q}": q for q in range(1, 5)})


@query
def hierarchical_grid(t: Trade) -> DataFrame:
    return t.parsed.members


@query
def grid_published(t: Trade) -> DataFrame:
    return t.parsed.published


@query
def grid_tree(t: Trade) -> DataFrame:
    return t.parsed.tree.select("sheet", "header", "position", "member")


@query
def grid_errors(t: Trade) -> DataFrame:
    """The same sheets with three faults: an unknown text, a missing year and an unknown header."""
    value_cell = (F.col("col") == trade.LAYOUT.label_col + 1) & (F.col("row") == trade.LAYOUT.first_data_row)
    year_cell = (F.col("row") == trade.LAYOUT.year_row) & (F.col("sheet") == "S1")
    solo = (F.col("col") == trade.LAYOUT.label_col) & F.col("txt").contains(trade.SINGLE_HEADER)
    faulty = (
        t.cells.withColumn("num", F.when(~value_cell, F.col("num")))
        .withColumn("txt", F.when(value_cell, "??").when(year_cell, "none").when(solo, "AFRICA").otherwise(F.col("txt")))
    )
    faulty = stage(faulty, "faulty-cells")
    return grid.parse_grid(faulty, trade.HEADERS, trade.SELF_NAMES, layout=trade.LAYOUT).errors


# -- text and cells -------------------------------------------------------------


@query
def normalise_labels(t: Trade) -> DataFrame:
    return t.table("documents").select("doc_id", text.normalise_label(F.col("text")).alias("label"))


@query
def alias_labels(t: Trade) -> DataFrame:
    spelt = F.concat(F.lit("  ("), F.col("p_brand"), F.lit("  ) "))
    labels = t.table("part").select("p_partkey", text.normalise_label(spelt).alias("label"))
    # variants that occur, each with its canonical spelling
    known = t.spark.createDataFrame([("(Brand#1)", "(Brand#01)"), ("(Brand#2)", "(Brand#02)")], "variant string, canonical string")
    return grid.apply_aliases(labels, "label", known)


def labelled_customers(t: Trade) -> DataFrame:
    code = text.padded(F.col("c_nationkey"))
    with_code = F.concat(F.lit(" \t"), code, F.lit("  "), F.col("c_name"), F.lit("  "))
    return t.table("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(with_code).alias("label")
    )


@query
def split_code_prefix(t: Trade) -> DataFrame:
    label = F.col("label")
    return labelled_customers(t).select(
        "c_custkey", text.code_prefix(label).alias("code"), text.code_name(label).alias("name")
    )


def written_prices(t: Trade) -> DataFrame:
    """Prices written with a decimal comma; some are blank, some are no numbers."""
    status = F.col("o_orderstatus")
    whole = F.floor(numeric.fixed_point(F.col("o_totalprice"), 2) / 100).cast("string")
    cents = text.padded(numeric.fixed_point(F.col("o_totalprice"), 2) % 100)
    written = F.concat(F.lit(" "), whole, F.lit(","), cents)
    return t.table("orders").select(
        "o_orderkey",
        F.when(status == "P", "").otherwise(written).alias("clean"),
        F.when(status == "P", "1.234,5").otherwise(written).alias("mixed"),
    )


@query
def parse_locale_number(t: Trade) -> DataFrame:
    return written_prices(t).select(
        "o_orderkey",
        text.locale_number(F.col("clean"), strict=True).alias("strict_value"),
        text.locale_number(F.col("mixed"), strict=False).alias("lenient_value"),
    )


@query
def decode_sentinels(t: Trade) -> DataFrame:
    kind = F.col("event_type")
    txt = F.when(kind == "error", "N.R").when(kind == "view", " n.r ").when(kind == "signup", " ").when(kind == "purchase", "x")
    cells = t.table("events").select("event_id", F.when(txt.isNull(), F.col("value") + 0.05).alias("num"), txt.alias("txt"))
    return cells.select(
        "event_id",
        numeric.round_exact(F.col("num"), 1).alias("value"),
        text.sentinel_flag(F.col("num"), F.col("txt"), trade.LAYOUT.not_representative).alias("value_flag"),
    )


# -- profiles -------------------------------------------------------------------


def labelled_documents(t: Trade) -> DataFrame:
    return t.table("documents").select("doc_id", "lang", "source").join(
        t.table("labels").select("doc_id", "quality"), "doc_id", "left"
    )


@query
def profile_categories(t: Trade) -> DataFrame:
    return profiling.profile_categories(labelled_documents(t), ["lang", "source"], "quality", "doc_id")


@query
def profile_missing(t: Trade) -> DataFrame:
    return profiling.profile_missing(t.members, ["value_flag", "member_label"], "value", "quarter_start_date")


@query
def profile_periods(t: Trade) -> DataFrame:
    years = profiling.distinct_periods(t.members, ["source_sheet"], "year")
    return years.select("source_sheet", F.array_join(F.transform("periods", lambda y: y.cast("string")), ",").alias("years"))


@query
def profile_period_runs(t: Trade) -> DataFrame:
    """The runs of years in which each customer ordered."""
    return profiling.period_runs(active_years(t), ["c_custkey"], "year")


@query
def profile_unique(t: Trade) -> DataFrame:
    return profiling.n_unique(t.table("documents"), ["lang", "source"])


@query
def profile_geographies(t: Trade) -> DataFrame:
    return profiling.distinct_sorted(t.index_long, ["group_code", "group_name"])


# -- data quality ---------------------------------------------------------------


@query
def dq_not_null(t: Trade) -> DataFrame:
    return checks.not_null(labelled_documents(t), "quality")


@query
def dq_unique(t: Trade) -> DataFrame:
    return checks.unique(t.table("orders"), "o_custkey")


@query
def dq_unique_combination(t: Trade) -> DataFrame:
    return checks.unique_combination(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_unique_keys(t: Trade) -> DataFrame:
    """Four keys of the same table in one pass; only the first is one."""
    keys = {
        "line": ["l_orderkey", "l_linenumber"],
        "order": "l_orderkey",
        "part and supplier": ["l_suppkey", "l_partkey"],
        "order and part": ["l_orderkey", "l_partkey"],
    }
    return checks.Suite().keys(t.table("lineitem"), keys).run().select("check", "failing_rows")


@query
def dq_accepted_values(t: Trade) -> DataFrame:
    return checks.accepted_values(t.table("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query
def dq_relationships(t: Trade) -> DataFrame:
    """Documents without a label; labels cover a part of them."""
    return checks.relationships(t.table("documents"), "doc_id", t.table("labels"))


def active_years(t: Trade) -> DataFrame:
    return t.table("orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).distinct()


@query
def dq_reverse_coverage(t: Trade) -> DataFrame:
    return checks.reverse_coverage(t.table("customer"), active_years(t), "c_custkey", ["year"])


@query
def dq_set_equality(t: Trade) -> DataFrame:
    return checks.set_equality(t.table("documents"), t.table("labels"), "doc_id")


@query
def dq_domain(t: Trade) -> DataFrame:
    return checks.accepted_domain(t.table("orders"), "o_orderstatus", ["F", "O", "X"])


@query
def dq_hierarchy_agrees(t: Trade) -> DataFrame:
    by_region = t.mapping.withColumn(
        "group_header", F.when(F.col("is_autonomous"), F.col("group_name")).otherwise(F.col("group_header"))
    )
    return checks.hierarchy_agrees(t.members, by_region)


@query
def dq_single_member_equal(t: Trade) -> DataFrame:
    return checks.single_member_equal(t.groups.withColumn("is_single_member_group", F.lit(True)))


@query
def dq_base_is_100(t: Trade) -> DataFrame:
    failing = checks.base_is_100(t.trend, ["index_rebased", "value_rebased"], "year", CONFIG.recent_base_year)
    return failing.select("group_code", "index_rebased", "value_rebased")


@query
def dq_panel_coverage(t: Trade) -> DataFrame:
    return checks.panel_coverage(t.trend, "year", 1995, CONFIG.last_full_year, 9, ["index_general", "value"])


@query
def dq_anchor(t: Trade) -> DataFrame:
    anchors = t.spark.createDataFrame(
        [("00", 2000, 100.0), ("00", 1999, 1.0), ("07", 2000, None), ("99", 2000, 5.0)],
        "group_code string, year bigint, expected_value double",
    )
    return checks.anchor_values(panel.index_pivot(t.index_long), anchors, ["group_code", "year"], "index_general")


@query
def dq_complete_grid(t: Trade) -> DataFrame:
    return checks.complete_grid(active_years(t), "c_custkey", ["year"])


@query
def dq_sheet_count(t: Trade) -> DataFrame:
    return checks.sheet_count(turns(t).select(F.col("conv_id").alias("sheet")), 8)


@query
def dq_suite(t: Trade) -> DataFrame:
    suite = marts.quality_suite(t.models, CONFIG, CONFIG.base_year, 9)
    return suite.run().select("check", "failing_rows")


@query
def dq_suite_faulty(t: Trade) -> DataFrame:
    """The input checks on faulty inputs, with what each names as a sample."""
    inputs = t.inputs
    label = F.when((F.col("member_label") == "NATION_3") & (F.col("year") == 1997), None).otherwise(F.col("member_label"))
    flag = F.when(F.col("quarter") == 4, "odd").otherwise(F.col("value_flag"))
    members = inputs.members.withColumn("member_label", label).withColumn("value_flag", flag)
    members = stage(members.unionAll(members.filter("year = 1996 and quarter = 1")), "faulty-members")
    places = inputs.mapping.filter("member_label <> 'NATION_5'")
    places = places.withColumn("member_code", F.when(F.col("member_label") == "NATION_6", "07").otherwise(F.col("member_code")))
    index = inputs.index_long.withColumn("index_type", F.when(F.col("index_type") != "new", F.col("index_type")))
    faulty = replace(inputs, members=members, mapping=stage(places, "faulty-mapping"), index_long=index)
    found = stage(marts.input_suite(faulty).run(), "faulty-suite")
    return found.select("check", "failing_rows", F.col("sample").isNotNull().alias("has_sample"))


# -- sources and sinks ----------------------------------------------------------


RAW = "panelkit_raw"


def _replaced(t: Trade, name: str) -> str:
    spark = t.spark
    # a folder of its own: the shared one outlives the catalog of a session
    tables.create_namespace(spark, RAW, "Raw panel tables", f"{shared_dir(spark)}/{RAW}-{uuid.uuid4().hex}")
    spark.sql(f"DROP TABLE IF EXISTS {RAW}.{name}")
    return f"{RAW}.{name}"


@query
def load_and_reconcile(t: Trade) -> DataFrame:
    """Load the member panel as a table, twice, and read it back by name."""
    raw = stage(trade.member_quarter(t.mapping, t.order_totals), "members").withColumn("not_declared", F.lit(0))
    name = _replaced(t, "member_quarter")
    tables.load_table(raw, name, marts.MEMBER_SCHEMA)
    tables.load_table(raw, name, marts.MEMBER_SCHEMA)
    return tables.source(t.spark, RAW, "member_quarter")


@query
def reconcile_content(t: Trade) -> DataFrame:
    """A load that gives two members each other's values in one quarter: as many rows, but not the same."""
    sent = stage(trade.member_quarter(t.mapping, t.order_totals), "members").select(*marts.MEMBER_SCHEMA.names)
    label, quarter = F.col("member_label"), (F.col("year") == 1997) & (F.col("quarter") == 1)
    swapped = F.when(quarter & (label == "NATION_3"), "NATION_4").when(quarter & (label == "NATION_4"), "NATION_3").otherwise(label)
    return tables.content_check(sent, stage(sent.withColumn("member_label", swapped), "swapped"))


@query
def publish_snapshot(t: Trade) -> DataFrame:
    """Two versions of two tables are published, a third stops half-way; readers have the second."""
    own = f"snapshot_{uuid.uuid4().hex}"
    tables.create_namespace(t.spark, own, location=f"{shared_dir(t.spark)}/{own}")
    members, published = stage(t.members, "members"), stage(t.published, "published")
    for first_year in (1992, 1996):
        snapshot = Snapshot(t.spark, own)
        snapshot.store(members.filter(F.col("year") >= first_year), "member_quarter")
        snapshot.store(published.filter(F.col("year") >= first_year), "published_quarter")
        snapshot.publish()
    Snapshot(t.spark, own).store(members.limit(0), "member_quarter")
    held = t.spark.table(f"{own}.member_quarter").select("group_header", "year", "quarter", F.col("value").alias("member_value"))
    totals = held.groupBy("group_header", "year", "quarter").agg(F.count("member_value").alias("n_values"))
    return t.spark.table(f"{own}.published_quarter").join(totals, ["group_header", "year", "quarter"], "left").select(
        "group_header", "year", "quarter", "value", "n_values"
    )


@query
def read_quoted_file(t: Trade) -> DataFrame:
    """Documents written as delimited text, with line breaks inside quoted fields, and read back by splits."""
    path = f"{shared_dir(t.spark)}/quoted-file-{uuid.uuid4().hex}"
    texts = t.table("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", "text")
    texts.write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path, sep="\t", header=True)
    return read_delimited(t.spark, path, texts.columns)


def written_index(t: Trade) -> str:
    """The index table as a delimited file with byte-order mark and decimal comma."""
    raw = trade.index_raw(t.mapping, t.line_totals)
    code = F.when(F.col("group_code") == CONFIG.national_code, F.col("group_name")).otherwise(
        F.concat_ws(" ", "group_code", "group_name")
    )
    value = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    columns = [code, F.col("index_type"), F.col("metric_type"), F.col("year").cast("string"), value]
    # the mark stands before the first name of the header line of every file
    names = ["\ufeff" + index_file.INDEX_HEADER[0], *index_file.INDEX_HEADER[1:]]
    path = f"{shared_dir(t.spark)}/index-file-{uuid.uuid4().hex}"
    raw.select(*[c.alias(n) for c, n in zip(columns, names)]).write.csv(path, sep="\t", header=True)
    return path


def written_seed(t: Trade) -> str:
    path = f"{shared_dir(t.spark)}/seed-file-{uuid.uuid4().hex}"
    t.mapping.select(*marts.MAPPING_SCHEMA.names).write.csv(path, header=True)
    return path


@query
def load_seed_mapping(t: Trade) -> DataFrame:
    return tables.load_seed(t.spark, written_seed(t), marts.MAPPING_SCHEMA)


@query
def grid_sparse(t: Trade) -> DataFrame:
    """The sheets without their blank cells."""
    filled = stage(t.cells.filter("num is not null or txt <> ''"), "sparse-cells")
    return grid.parse_grid(filled, trade.HEADERS, trade.SELF_NAMES, layout=trade.LAYOUT).members


@query
def index_suite(t: Trade) -> DataFrame:
    """The checks of the index file on a faulty one: a geography less, an unknown type, a missing metric, rows twice."""
    parsed = index_file.parse_index(index_file.read_index(t.spark, written_index(t))).filter("group_code <> '07'")
    kind = F.when(F.col("index_type") == "New dwelling", "Flat").otherwise(F.col("index_type"))
    metric = F.when(F.col("year") != 1997, F.col("metric_type"))
    faulty = stage(parsed.withColumn("index_type", kind).withColumn("metric_type", metric), "faulty-index")
    twice = faulty.unionAll(faulty.filter("year = 1999"))
    n_geographies = 9
    return index_file.index_checks(twice, n_geographies).run().select("check", "failing_rows")


SHEETS = build.GridSource(trade.HEADERS, trade.SELF_NAMES, layout=trade.LAYOUT)


@query
def grid_suite(t: Trade) -> DataFrame:
    """The checks of sheets with an unknown text in each, held against a reference that lacks a member."""
    value_cell = (F.col("col") == trade.LAYOUT.label_col + 1) & (F.col("row") == trade.LAYOUT.first_data_row)
    faulty = t.cells.withColumn("num", F.when(~value_cell, F.col("num"))).withColumn("txt", F.when(value_cell, "??").otherwise(F.col("txt")))
    faulty = stage(faulty, "faulty-cells")
    result = grid.parse_grid(faulty, trade.HEADERS, trade.SELF_NAMES, layout=trade.LAYOUT)
    reference = t.mapping.filter("member_label <> 'NATION_3'").selectExpr("group_header as header", "member_label as member")
    return build.grid_suite(faulty, result, SHEETS, reference).run().select("check", "failing_rows")


@query
def pipeline_marts(t: Trade) -> DataFrame:
    """From written files to checked raw tables to checked marts; the growth summary is read back by name."""
    own = uuid.uuid4().hex
    layers = build.Layers(f"raw_{own}", f"marts_{own}")
    for name in (layers.raw, layers.marts):
        tables.create_namespace(t.spark, name, location=f"{shared_dir(t.spark)}/{name}")
    mapping = stage(tables.load_seed(t.spark, written_seed(t), marts.MAPPING_SCHEMA), "seed")
    reference = mapping.selectExpr("group_header as header", "member_label as member")
    source = replace(SHEETS, n_sheets=t.cells.select("sheet").distinct().count())
    build.load_raw(t.spark, written_index(t), t.cells, source, 9, reference, layers)
    inputs = build.raw_inputs(t.spark, mapping, CONFIG, layers)
    build.build_marts(inputs, CONFIG, CONFIG.base_year, 9, layers)
    return tables.source(t.spark, layers.marts, "mart_growth_summary")


@query
def read_index_file(t: Trade) -> DataFrame:
    return index_file.parse_index(index_file.read_index(t.spark, written_index(t)))
