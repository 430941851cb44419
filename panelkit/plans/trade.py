"""The panel inputs derived from a trade data set.

Nations are members and regions are groups. One nation forms a group of its
own, two are autonomous members published under a shared header. Order values
per quarter play the level source, line prices per year the index source.

The fact tables are read once each and reduced before they are joined; all
later steps work on the reduced tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.config import GridLayout, PanelConfig
from panelkit.functions import numeric, text
from panelkit.operators import panel
from panelkit.plans.index_file import stage_index
from panelkit.plans.marts import PanelInputs, stage_members, stage_published
from panelkit.sources.staging import stage, stage_buckets, together

CONFIG = PanelConfig(base_year=1996, recent_base_year=1998, last_full_year=2000, index_first_year=1996)
MIN_OBS = 10

# Members outside the regular groups, by nation key.
SINGLE_MEMBER = {22: "06"}
AUTONOMOUS = {23: "07", 24: "08"}
SINGLE_HEADER, SHARED_HEADER, TOTAL_HEADER = "SOLO", "SHARED", "TOTAL"

INDEX_BASE_YEAR = 2000
MONEY_SCALE = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _special(key: Column, codes: dict[int, str], otherwise: Column) -> Column:
    for value, code in codes.items():
        otherwise = F.when(key == value, F.lit(code)).otherwise(otherwise)
    return otherwise


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per member: its codes, names, header and flags."""
    joined = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("n_nationkey")
    code = text.padded(key)
    group = _special(key, SINGLE_MEMBER | AUTONOMOUS, text.padded(F.col("n_regionkey") + 1))
    single, autonomous = key.isin(*SINGLE_MEMBER), key.isin(*AUTONOMOUS)
    return joined.select(
        code.alias("member_code"),
        F.concat(F.lit("M-"), code).alias("member_iso_code"),
        F.replace("n_name", F.lit("_"), F.lit(" ")).alias("member_name"),
        F.col("n_name").alias("member_label"),
        F.when(single, SINGLE_HEADER).when(autonomous, SHARED_HEADER).otherwise(F.col("r_name")).alias("group_header"),
        group.alias("group_code"),
        F.concat(F.lit("G-"), group).alias("group_iso_code"),
        F.when(single | autonomous, F.col("n_name")).otherwise(F.col("r_name")).alias("group_name"),
        single.alias("is_single_member_group"),
        autonomous.alias("is_autonomous"),
    )


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value and count per nation and quarter, stored.

    Orders are summed per customer and quarter first: a customer with very many
    orders is folded into a few rows inside each task, so the join that follows
    has at most one row per customer and quarter.
    """
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy(
            "o_custkey",
            F.year("o_orderdate").cast("bigint").alias("year"),
            F.quarter("o_orderdate").cast("bigint").alias("quarter"),
        )
        .agg(
            F.sum(numeric.fixed_point(F.col("o_totalprice"), MONEY_SCALE)).alias("units"),
            F.count("o_totalprice").alias("n"),
        )
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    totals = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "year", "quarter")
        .agg(F.sum(F.col("units").cast("decimal(38,0)")).alias("units"), F.sum("n").alias("n"))
        .withColumn("member_code", text.padded(F.col("c_nationkey")))
        .drop("c_nationkey")
    )
    return stage(totals, "order-totals")


def _sheet(year: Column) -> Column:
    """Sheets hold four years each."""
    return F.concat(F.lit("S"), F.floor((year - 1995) / 4).cast("string"))


def member_quarter(map_df: DataFrame, totals: DataFrame, min_obs: int = MIN_OBS, calendar: DataFrame | None = None) -> DataFrame:
    """The raw member panel: every member in every quarter that occurs."""
    members = map_df.select("member_code", "member_label", "group_header", "is_single_member_group")
    grid = panel.dense_grid(members, totals, ["member_code"], ["year", "quarter"], calendar)
    value, flag = panel.flagged_mean(F.col("units"), F.col("n"), MONEY_SCALE, min_obs)
    return grid.select(
        "group_header",
        "member_label",
        "year",
        "quarter",
        value.alias("value"),
        "is_single_member_group",
        flag.alias("value_flag"),
        _sheet(F.col("year")).alias("source_sheet"),
    )


def published_quarter(map_df: DataFrame, totals: DataFrame, min_obs: int = MIN_OBS, calendar: DataFrame | None = None) -> DataFrame:
    """The raw published panel: pooled means by header and over everything."""
    by_member = totals.join(map_df.select("member_code", "group_header"), "member_code")
    pooled = (
        by_member.select(
            F.explode(
                F.array(
                    F.struct(F.lit(panel.GROUP).alias("geo_level"), "group_header"),
                    F.struct(F.lit(panel.NATIONAL).alias("geo_level"), F.lit(TOTAL_HEADER).alias("group_header")),
                )
            ).alias("level"),
            "year",
            "quarter",
            "units",
            "n",
        )
        .groupBy("level.geo_level", "level.group_header", "year", "quarter")
        .agg(F.sum("units").alias("units"), F.sum("n").alias("n"))
    )
    headers = map_df.select(F.lit(panel.GROUP).alias("geo_level"), "group_header").distinct()
    total = map_df.select(F.lit(panel.NATIONAL).alias("geo_level"), F.lit(TOTAL_HEADER).alias("group_header")).distinct()
    grid = panel.dense_grid(
        headers.unionByName(total), pooled, ["geo_level", "group_header"], ["year", "quarter"], calendar
    )
    value, flag = panel.flagged_mean(F.col("units"), F.col("n"), MONEY_SCALE, min_obs)
    return grid.select("geo_level", "group_header", "year", "quarter", value.alias("value"), flag.alias("value_flag"))


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line prices and counts per nation of the supplier, ship year and return flag.

    Read by a single branch, hence not stored.
    """
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") >= F.lit(f"{CONFIG.index_first_year:04d}-01-01").cast("timestamp_ntz"))
        .groupBy("l_suppkey", F.year("l_shipdate").cast("bigint").alias("year"), "l_returnflag")
        .agg(
            F.sum(numeric.fixed_point(F.col("l_extendedprice"), MONEY_SCALE)).alias("units"),
            F.count("l_extendedprice").alias("n"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "year", "l_returnflag")
        .agg(F.sum(F.col("units").cast("decimal(38,0)")).alias("units"), F.sum("n").alias("n"))
        .withColumn("member_code", text.padded(F.col("s_nationkey")))
        .drop("s_nationkey")
    )


def index_raw(map_df: DataFrame, totals: DataFrame) -> DataFrame:
    """The raw index table in long form, labelled as the source labels it.

    A yearly mean price per group and type of line, as an index with 100 in its
    own base year, and its change on the year before. The two autonomous codes
    publish the general index only.
    """
    flag, units, n = F.col("l_returnflag"), F.col("units"), F.col("n")
    levels = F.array(
        F.struct("group_code", "group_name"),
        F.struct(F.lit(CONFIG.national_code).alias("group_code"), F.lit(CONFIG.national_name).alias("group_name")),
    )

    def mean(only: str | None = None) -> Column:
        chosen = F.lit(True) if only is None else flag == only
        return numeric.mean_from_units(F.sum(F.when(chosen, units)), F.sum(F.when(chosen, n)), MONEY_SCALE)

    published_split = ~F.col("group_code").isin(*AUTONOMOUS.values())
    means = (
        totals.join(map_df.select("member_code", "group_code", "group_name"), "member_code")
        .select(F.explode(levels).alias("g"), "year", "l_returnflag", "units", "n")
        .groupBy("g.group_code", "g.group_name", "year")
        .agg(mean().alias("General"), mean("N").alias("New dwelling"), mean("R").alias("Second-hand dwelling"))
        .withColumn("New dwelling", F.when(published_split, F.col("New dwelling")))
        .withColumn("Second-hand dwelling", F.when(published_split, F.col("Second-hand dwelling")))
    )
    long = means.unpivot(
        ["group_code", "group_name", "year"], ["General", "New dwelling", "Second-hand dwelling"], "index_type", "mean"
    )
    series = ["group_code", "index_type"]
    # the change is taken from the mean of the calendar year before
    prior = panel.seasonal_yoy(long, series, "year", None, "mean")
    wide = prior.select(
        "group_code",
        "group_name",
        "index_type",
        "year",
        panel.rebase(F.col("mean"), INDEX_BASE_YEAR, series, digits=3).alias("Annual average index"),
        numeric.pct_change(F.col("mean"), F.col("value_prior_year"), 1).alias("Annual variation"),
    )
    return wide.unpivot(
        ["group_code", "group_name", "index_type", "year"],
        ["Annual average index", "Annual variation"],
        "metric_type",
        "value",
    ).select("group_code", "group_name", "index_type", "metric_type", "year", "value")


def panel_inputs(spark: SparkSession, sf_dir: str, min_obs: int = MIN_OBS) -> PanelInputs:
    """The four inputs of the panel models as stored tables; one pass over each fact table.

    The index side and the level side have nothing in common but the mapping,
    so they run at the same time.
    """
    map_df = stage(mapping(spark, sf_dir), "mapping")

    def level_tables() -> tuple[DataFrame, DataFrame]:
        orders = order_totals(spark, sf_dir)
        calendar = panel.calendar_of(orders, ["year", "quarter"])
        return tuple(
            together(
                lambda: stage_buckets(member_quarter(map_df, orders, min_obs, calendar), "members", ["member_label"]),
                lambda: stage(published_quarter(map_df, orders, min_obs, calendar), "published"),
            )
        )

    (members, published), index = together(
        level_tables, lambda: stage(index_raw(map_df, line_totals(spark, sf_dir)), "index")
    )
    return PanelInputs(
        index_long=stage_index(index, CONFIG.national_code),
        members=stage_members(members),
        published=stage_published(published),
        mapping=map_df,
    )


# -- the same panel written as hierarchical sheets ------------------------------

LAYOUT = GridLayout(national_label=TOTAL_HEADER)
HEADERS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", SINGLE_HEADER, SHARED_HEADER]
SELF_NAMES = {SINGLE_HEADER: "NATION_22"}


def sheet_values(map_df: DataFrame, members: DataFrame, published: DataFrame) -> DataFrame:
    """The value cells of sheets of four years each: total, headers and members.

    The labels, one for each header and member, are numbered without gaps: the
    total, then the headers of the layout in its order and any others by name,
    each above its members. A header with a single member has no member row.
    """
    known = F.array_position(F.array(*[F.lit(h) for h in HEADERS]), F.col("group_header"))
    order = F.when(F.col("group_header") == TOTAL_HEADER, 0).when(known > 0, known).otherwise(len(HEADERS) + 1)
    labels = map_df.filter(~F.col("is_single_member_group")).select("group_header", "member_label", "member_code")
    headers = published.select("group_header").distinct().select("group_header", F.lit(None).cast("string").alias("member_label"), F.lit(None).cast("string").alias("member_code"))
    place = F.row_number().over(Window.orderBy(order, "group_header", F.col("member_code").asc_nulls_first()))
    rows = headers.unionAll(labels).select("group_header", "member_label", (LAYOUT.first_data_row - 1 + place).cast("bigint").alias("row"))
    rows = stage(rows, "sheet-rows")
    year, quarter = F.col("year"), F.col("quarter")
    col = LAYOUT.label_col + 1 + ((year - 1995) % 4) * 4 + quarter - 1
    children = (
        members.filter(~F.col("is_single_member_group"))
        .join(rows, "member_label")
        .select("row", F.col("member_label").alias("label"), "year", "quarter", "value", "value_flag")
    )
    heads = published.join(rows.filter("member_label is null").drop("member_label"), "group_header").select(
        "row",
        F.col("group_header").alias("label"),
        "year",
        "quarter",
        "value",
        "value_flag",
    )
    flag = F.col("value_flag")
    coded = F.when(flag == text.NOT_REPRESENTATIVE, F.when(quarter == 1, "N.R").otherwise(" n.r")).when(flag.isNotNull(), "")
    return children.unionByName(heads).select(
        _sheet(year).alias("sheet"), "row", "label", col.cast("bigint").alias("col"), "year", "quarter",
        F.col("value").alias("num"), coded.alias("txt"),
    )


def sheet_cells(values: DataFrame) -> DataFrame:
    """The value cells with labels and headings, a footnote and a stray row below it."""
    end = values.groupBy("sheet").agg(F.max("row").alias("last"))

    def cell(df: DataFrame, row: Column, column: Column, txt: Column) -> DataFrame:
        return df.select(
            "sheet", row.cast("bigint").alias("row"), column.cast("bigint").alias("col"),
            F.lit(None).cast("double").alias("num"), txt.cast("string").alias("txt"),
        )

    labels = values.select("sheet", "row", "label").distinct()
    heading = values.select("sheet", "col", "year", "quarter").distinct()
    sheets = values.select("sheet").distinct()
    last_row, last_col = F.col("last") + 2, F.lit(LAYOUT.label_col + 17)
    at = F.lit(LAYOUT.label_col)
    parts = [
        values.select("sheet", "row", "col", "num", "txt"),
        # labels carry the blanks that real sheets have
        cell(labels, F.col("row"), at, F.concat(F.lit("  "), F.replace("label", F.lit(" "), F.lit("  ")), F.lit(" "))),
        cell(
            heading.filter("quarter = 1"),
            F.lit(LAYOUT.year_row), F.col("col"), F.concat(F.lit("Año  "), F.col("year").cast("string")),
        ),
        cell(heading, F.lit(LAYOUT.quarter_row), F.col("col"), F.concat(F.col("quarter").cast("string"), F.lit("º "))),
        cell(sheets, F.lit(LAYOUT.quarter_row), last_col, F.lit("Trimestral")),
        cell(end, last_row - 1, at, F.lit("")),
        cell(end, last_row, at, F.lit("n.r: el dato no es representativo")),
        cell(end, last_row + 1, at, F.lit("below the block")),
    ]
    cells = parts[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    return cells
