"""Hierarchical sheets to panels.

A sheet is a long table of cells: ``sheet, row, col, num, txt``, blank cells
included. Its rows hold a total, group headers and the members below each
header; its columns hold quarters under a year that is only written once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import GridLayout
from panelkit.functions import numeric, text
from panelkit.operators.ordered import BLOCK_ROWS, carry_forward, cut_block, number_in_group
from panelkit.operators.panel import GROUP, MEMBER, NATIONAL
from panelkit.sources.staging import stage, together

HEADER, CHILD = "header", "child"
# Rows of a sheet that are dealt together when their cells are looked up.
LOOKUP_ROWS = 1024


def apply_aliases(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Replace known spellings; aliases is (variant, canonical).

    Other spellings pass through, for the tree checks to find. A variant that is
    listed twice raises, since it would repeat rows.
    """
    twice = F.raise_error(F.concat(F.lit("alias listed twice: "), F.col("variant"))).cast("string")
    aliases = aliases.groupBy("variant").agg(F.max("canonical").alias("canonical"), F.count(F.lit(1)).alias("__n"))
    aliases = aliases.select("variant", F.when(F.col("__n") > 1, twice).otherwise(F.col("canonical")).alias("canonical"))
    joined = df.join(aliases, F.col(column) == F.col("variant"), "left")
    return joined.withColumn(column, F.coalesce("canonical", column)).drop("variant", "canonical")


def alias_expression(value: Column, aliases: Mapping[str, str]) -> Column:
    """The same for a handful of spellings written in the program."""
    for variant, canonical in aliases.items():
        value = F.when(value == variant, F.lit(canonical)).otherwise(value)
    return value


def period_map(cells: DataFrame, layout: GridLayout) -> DataFrame:
    """(sheet, col, year, quarter) of every quarterly column.

    The year carries right until the next one; columns without a quarter label
    are no periods. A NULL year is an error for the caller to raise.
    """
    headings = cells.filter((F.col("col") > layout.label_col) & F.col("row").isin(layout.year_row, layout.quarter_row))

    def heading(row: int) -> Column:
        return F.max(F.when(F.col("row") == row, F.col("txt")))

    columns = headings.groupBy("sheet", "col").agg(
        heading(layout.year_row).alias("year_text"), heading(layout.quarter_row).alias("quarter_text")
    )
    carried = carry_forward(
        columns, ["sheet"], "col", text.year_label(F.col("year_text"), layout.year_pattern), "year", layout.block_rows
    )
    return carried.select(
        "sheet", "col", "year", text.quarter_label(F.col("quarter_text"), layout.quarter_pattern).alias("quarter")
    ).filter(F.col("quarter").isNotNull())


def fill_header(
    rows: DataFrame,
    keys: Sequence[str],
    position: str,
    is_header: Column,
    label: Column,
    out: str = "header",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The last header at or above each row; NULL before the first one."""
    return carry_forward(rows, keys, position, F.when(is_header, label), out, block_rows)


def childless_headers(headers: DataFrame, children: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Headers that no row stands under."""
    return headers.join(children.select(*keys).distinct(), list(keys), "left_anti")


def classify_rows(
    cells: DataFrame, headers: Sequence[str], aliases: Mapping[str, str], layout: GridLayout
) -> DataFrame:
    """(sheet, row, label, kind, header) of the data block of every sheet."""
    label = alias_expression(text.normalise_label(F.coalesce("txt", F.col("num").cast("string"), F.lit(""))), aliases)
    labels = cells.filter((F.col("col") == layout.label_col) & (F.col("row") >= layout.first_data_row)).select(
        "sheet", "row", label.alias("label")
    )
    labels = number_in_group(labels, ["sheet"], "row", "__nth", layout.block_rows)
    # an absent label ends the block as a blank one does
    gap = F.col("row") - layout.first_data_row + 1 != F.col("__nth")
    at_end = (F.col("label") == "") | F.col("label").startswith(layout.footnote_prefix) | gap
    block = cut_block(labels, ["sheet"], "row", at_end, layout.block_rows).drop("__nth")
    kind = (
        F.when(F.col("label") == layout.national_label, NATIONAL)
        .when(F.col("label").isin(*headers), HEADER)
        .otherwise(CHILD)
    )
    kinds = block.withColumn("kind", kind)
    return fill_header(
        kinds, ["sheet"], "row", F.col("kind") == HEADER, F.col("label"), "header", layout.block_rows
    )


def hierarchy(rows: DataFrame, self_names: Mapping[str, str], layout: GridLayout) -> DataFrame:
    """(sheet, header, position, member) with childless headers as their own member."""
    children = rows.filter((F.col("kind") == CHILD) & F.col("header").isNotNull())
    alone = childless_headers(
        rows.filter(F.col("kind") == HEADER), children.select("sheet", "header"), ["sheet", "header"]
    )
    members = children.select("sheet", "row", "header", F.col("label").alias("member")).unionByName(
        alone.select("sheet", "row", "header", _self_name(F.col("label"), self_names).alias("member"))
    )
    return number_in_group(members, ["sheet", "header"], "row", "position", layout.block_rows)


def _self_name(label: Column, self_names: Mapping[str, str]) -> Column:
    return text.decode(label, self_names) if self_names else F.lit(None).cast("string")


@dataclass(frozen=True)
class GridResult:
    """What a set of sheets holds, and what is wrong with it."""

    members: DataFrame
    published: DataFrame
    tree: DataFrame
    errors: DataFrame


def parse_grid(
    cells: DataFrame,
    headers: Sequence[str],
    self_names: Mapping[str, str],
    aliases: Mapping[str, str] | None = None,
    layout: GridLayout = GridLayout(),
) -> GridResult:
    """Sheets to the member panel and the published panel.

    Label rows and period columns are settled first, on their own small tables.
    The cells then meet both, block of rows by block of rows, and are decoded in
    a single pass; the decoded cells are stored, because both panels and the
    error list read them.
    """
    # labels and headings are few; stored, they are read as often as their order asks for
    is_label = (F.col("col") == layout.label_col) & (F.col("row") >= layout.first_data_row)
    outline = stage(cells.filter(is_label | F.col("row").isin(layout.year_row, layout.quarter_row)), "grid-outline")
    rows, periods = together(
        lambda: stage(classify_rows(outline, headers, aliases or {}, layout), "grid-rows"),
        lambda: stage(period_map(outline, layout), "grid-periods"),
    )
    tree = stage(hierarchy(rows, self_names, layout), "grid-tree")

    published_rows = rows.filter(F.col("kind") != CHILD).select(
        "sheet", "row", F.when(F.col("kind") == NATIONAL, NATIONAL).otherwise(GROUP).alias("level"), F.col("label").alias("header"),
        F.lit(None).cast("string").alias("member"),
    )
    member_rows = tree.select("sheet", "row", F.lit(MEMBER).alias("level"), "header", "member")
    targets = published_rows.unionByName(member_rows)

    data = cells.filter((F.col("col") > layout.label_col) & (F.col("row") >= layout.first_data_row))
    values = cell_values(targets, periods, data).select(
        "sheet",
        "row",
        "col",
        "level",
        "header",
        "member",
        "year",
        "quarter",
        numeric.round_exact(F.col("num"), 1).alias("value"),
        text.sentinel_flag(F.col("num"), F.col("txt"), layout.not_representative).alias("value_flag"),
    )
    values = stage(values, "grid-values")
    members = values.filter(F.col("level") == MEMBER).select(
        F.col("header").alias("group_header"),
        F.col("member").alias("member_label"),
        "year",
        "quarter",
        "value",
        F.col("header").isin(*self_names).alias("is_single_member_group"),
        "value_flag",
        F.col("sheet").alias("source_sheet"),
    )
    published = values.filter(F.col("level") != MEMBER).select(
        F.col("level").alias("geo_level"), F.col("header").alias("group_header"), "year", "quarter", "value", "value_flag"
    )
    return GridResult(members, published, tree, _grid_errors(rows, periods, tree, values))


def cell_values(targets: DataFrame, periods: DataFrame, data: DataFrame, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Every target row in every period of its sheet, with its cell or NULL: an absent cell is one without data.

    Rows are dealt by sheet and block of rows, cells and targets together, so they are shuffled once and a sheet of any
    length spreads evenly. The periods of a sheet, as many as it has columns, are one list that every block gets a copy
    of; a row looks its cells up in a map of its own. The same cell given twice raises.
    """
    target = F.struct(*[c for c in targets.columns if c not in ("sheet", "row")])
    cell = F.struct("col", F.struct("num", "txt").alias("held"))
    block = F.floor(F.col("row") / lookup_rows).cast("bigint").alias("block")
    none = F.lit(None)
    both = targets.select("sheet", block, "row", target.alias("target"), none.alias("cell")).unionAll(
        data.select("sheet", block, "row", none.alias("target"), cell.alias("cell"))
    )
    rows = (
        both.repartition("sheet", "block")
        .groupBy("sheet", "block", "row")
        .agg(F.collect_list("target").alias("targets"), F.map_from_entries(F.collect_list("cell")).alias("cells"))
        .filter(F.size("targets") > 0)
    )
    calendar = periods.groupBy("sheet").agg(F.collect_list(F.struct("col", "year", "quarter")).alias("periods"))
    calendars = targets.select("sheet", block).distinct().join(calendar, "sheet")
    slots = rows.join(calendars, ["sheet", "block"]).select("sheet", "row", "cells", "periods", F.explode("targets").alias("t"))
    slots = slots.select("sheet", "row", "t.*", "cells", F.explode("periods").alias("p"))
    found = slots.select("*", F.try_element_at("cells", F.col("p.col")).alias("held"))
    return found.select(
        "sheet", "row", *[c for c in targets.columns if c not in ("sheet", "row")], "p.col", "p.year", "p.quarter", "held.num", "held.txt"
    )


def _grid_errors(rows: DataFrame, periods: DataFrame, tree: DataFrame, values: DataFrame) -> DataFrame:
    """Everything that must stop a load: (sheet, error, row, col, detail)."""

    def found(df: DataFrame, error: str, detail: str, row: str | None = "row", col: str | None = None) -> DataFrame:
        def at(name: str | None) -> Column:
            return (F.col(name) if name else F.lit(None)).cast("bigint")

        return df.select(
            "sheet", F.lit(error).alias("error"), at(row).alias("row"), at(col).alias("col"),
            F.col(detail).cast("string").alias("detail"),
        )

    repeated = (
        rows.filter(F.col("kind") == HEADER)
        .groupBy("sheet", "label")
        .agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("row"))
        .filter("n > 1")
    )
    return (
        found(rows.filter((F.col("kind") == CHILD) & F.col("header").isNull()), "member before any header", "label")
        .unionByName(found(repeated, "repeated header", "label"))
        .unionByName(found(tree.filter(F.col("member").isNull()), "unknown header without members", "header"))
        .unionByName(found(periods.filter(F.col("year").isNull()), "quarter without year", "quarter", None, "col"))
        .unionByName(found(values.filter(F.col("value_flag") == "unexpected"), "unexpected cell", "header", "row", "col"))
    )


def first_sheet(tree: DataFrame, sheet: str = "sheet") -> Column:
    return tree.agg(F.min(sheet).alias("first")).scalar()


def tree_consistency(tree: DataFrame, keys: Sequence[str] = ("header", "position", "member"), sheet: str = "sheet") -> DataFrame:
    """Per sheet: does it hold exactly the rows of the first sheet's tree?

    Each row looks for its twin in the first tree; a sheet agrees when all its
    rows match and none is missing. No list of a whole sheet is ever built.
    """
    other = [F.col(k).alias(f"__{k}") for k in keys]
    expected = tree.filter(F.col(sheet) == first_sheet(tree, sheet)).select(*other, F.lit(1).alias("__hit"))
    size = expected.agg(F.count(F.lit(1)).alias("n")).scalar()
    # a NULL equals a NULL
    twin = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    counted = (
        tree.join(expected, twin, "left")
        .groupBy(sheet)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("__hit").alias("n_matching"))
    )
    return counted.withColumn("n_expected", size).withColumn(
        "same_tree", (F.col("n_rows") == F.col("n_expected")) & (F.col("n_matching") == F.col("n_expected"))
    )


def tree_difference(found: DataFrame, reference: DataFrame, keys: Sequence[str] = ("header", "member")) -> DataFrame:
    """Pairs that only one of two trees holds."""
    left = found.select(*keys).distinct().withColumn("in_found", F.lit(True))
    right = reference.select(*keys).distinct().withColumn("in_reference", F.lit(True))
    both = left.join(right, list(keys), "full")
    return both.filter(F.col("in_found").isNull() | F.col("in_reference").isNull()).select(
        *keys,
        F.coalesce("in_found", F.lit(False)).alias("in_found"),
        F.coalesce("in_reference", F.lit(False)).alias("in_reference"),
    )


def unpivot_periods(wide: DataFrame, ids: Sequence[str], periods: Mapping[str, int], out: str = "quarter") -> DataFrame:
    """Period columns to rows, blanks kept; columns outside ``periods`` are dropped."""
    long = wide.select(*ids, *periods).unpivot(list(ids), list(periods), "__column", "value")
    number = F.lit(None).cast("bigint")
    for column, period in periods.items():
        number = F.when(F.col("__column") == column, F.lit(period).cast("bigint")).otherwise(number)
    return long.select(*ids, number.alias(out), "value")
