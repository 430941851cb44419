"""Data-quality checks.

Each check returns the rows that fail it; an empty result is a pass.
:class:`Suite` runs many of them, taking every check that looks at one row at a
time from a single pass over its table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.ordered import number_distinct
from panelkit.operators.profiling import period_sets, set_size
from panelkit.sources.staging import stage

TOLERANCE = 0.001


# -- one row at a time: conditions that hold for a failing row ------------------


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    """Outside the domain; NULL passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def off_base(columns: Sequence[str], period: str, base: int, tolerance: float = TOLERANCE) -> Column:
    """Not 100 in the base period; a NULL fails too."""
    wrong = [F.col(c).isNull() | (F.abs(F.col(c) - 100) > tolerance) for c in columns]
    return (F.col(period) == base) & reduce(lambda a, b: a | b, wrong)


def differs(left: str, right: str, tolerance: float = TOLERANCE, missing: float = -1.0) -> Column:
    """Further apart than the tolerance; two NULLs are equal."""
    return F.abs(F.coalesce(F.col(left), F.lit(missing)) - F.coalesce(F.col(right), F.lit(missing))) > tolerance


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_null(column))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The values outside the domain and how often they occur."""
    return df.filter(not_accepted(column, values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def base_is_100(df: DataFrame, columns: Sequence[str], period: str, base: int) -> DataFrame:
    return df.filter(off_base(columns, period, base))


def single_member_equal(groups: DataFrame) -> DataFrame:
    """A group with one member must carry that member's value."""
    alone = F.col("is_single_member_group") | F.col("is_autonomous")
    return groups.filter(alone & differs("value", "member_simple_mean")).select(
        "group_code", "year", "value", "member_simple_mean"
    )


# -- across rows ----------------------------------------------------------------


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULL counts as a value.

    Rows are counted before the shuffle, so a key that fills a third of the
    table travels as one row per task.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Child values without a parent, and how many rows hold each; NULL passes.

    Child keys are counted before the join, so a hot key takes part once.
    """
    keys = parent.select(F.col(parent_column or column).alias(column))
    held = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return held.join(keys, column, "left_anti")


def held_periods(data: DataFrame, keys: Sequence[str], periods: Sequence[str]) -> DataFrame:
    """The periods of each key as sets, stored, with n_rows and whether one of them is NULL (has_null).

    A single whole number is its own place; other periods are numbered in their order, NULL in them being a value.
    """
    name = periods[0]
    if len(periods) == 1 and data.schema[name].dataType.typeName() in ("byte", "short", "integer", "long"):
        placed, place = data, F.col(name).cast("bigint")
    else:
        twin = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in periods])
        numbers = number_distinct(data, periods, "__place").select(*[F.col(p).alias(f"__{p}") for p in periods], "__place")
        placed, place = data.select(*keys, *periods).join(numbers, twin), F.col("__place")
    also = [F.count(F.lit(1)).alias("n_rows"), F.max(place.isNull().cast("int")).alias("has_null")]
    return stage(period_sets(placed, keys, place, also), "periods-held")


def reverse_coverage(parent: DataFrame, data: DataFrame, key: str, periods: Sequence[str]) -> DataFrame:
    """Parents without data for every period that occurs anywhere.

    Each period counts once, however many rows it has; a NULL in it is a value like any other. The keys and the whole
    are counted from the same stored sets of periods; a parent without any keeps a zero.
    """
    known = held_periods(data, [key], periods)
    n_null = F.max("has_null")
    held = known.groupBy(key).agg((set_size() + n_null).alias("n_periods"))
    by_word = known.groupBy("word").agg(F.bit_or("bits").alias("bits"), n_null.alias("has_null"))
    expected = by_word.agg((set_size() + F.coalesce(n_null, F.lit(0))).alias("n")).scalar()
    return (
        parent.select(key)
        .join(held, key, "left")
        .select(key, F.coalesce("n_periods", F.lit(0).cast("bigint")).alias("n_periods"))
        .filter(F.col("n_periods") != expected)
    )


def set_equality(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Codes that only one side holds."""
    ours = left.select(column).distinct().withColumn("in_left", F.lit(True))
    theirs = right.select(column).distinct().withColumn("in_right", F.lit(True))
    both = ours.join(theirs, column, "full")
    return both.filter(F.col("in_left").isNull() | F.col("in_right").isNull()).select(
        column, F.coalesce("in_left", F.lit(False)).alias("in_left"), F.coalesce("in_right", F.lit(False)).alias("in_right")
    )


def accepted_domain(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Observed against expected values, both ways; a NULL is a value that nobody expects."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], f"{column} string")
    return set_equality(df, wanted, column)


def hierarchy_agrees(data: DataFrame, mapping: DataFrame) -> DataFrame:
    """Members whose header or single-member flag differs from the mapping."""
    found = data.select("member_label", "group_header", "is_single_member_group").distinct()
    wanted = mapping.select(
        "member_label",
        F.col("group_header").alias("mapped_header"),
        F.col("is_single_member_group").alias("mapped_flag"),
    )
    return found.join(wanted, "member_label").filter(
        (F.col("group_header") != F.col("mapped_header")) | (F.col("is_single_member_group") != F.col("mapped_flag"))
    )


def panel_coverage(
    df: DataFrame, period: str, first: int, last: int, n_entities: int, measures: Sequence[str]
) -> DataFrame:
    """Periods in which some entity, or one of its measures, is missing."""
    counts = [F.count(F.lit(1)).alias("n_entities"), *[F.count(m).alias(f"n_{m}") for m in measures]]
    wrong = [F.col(c) != n_entities for c in ["n_entities", *[f"n_{m}" for m in measures]]]
    return (
        df.filter(F.col(period).between(first, last))
        .groupBy(period)
        .agg(*counts)
        .filter(reduce(lambda a, b: a | b, wrong))
    )


def anchor_values(df: DataFrame, expected: DataFrame, keys: Sequence[str], value: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Anchors that are absent or hold another value; expected is (keys, expected_value)."""
    found = expected.join(df.select(*keys, value), list(keys), "left")
    off = F.abs(F.col(value) - F.col("expected_value")) > tolerance
    one_missing = F.col(value).isNull() != F.col("expected_value").isNull()
    return found.filter(F.coalesce(off, F.lit(False)) | one_missing)


def complete_grid(df: DataFrame, member: str, periods: Sequence[str]) -> DataFrame:
    """One row when the table is not members x periods, else none; NULL is neither a member nor a period."""
    held = held_periods(df.dropna(subset=list(periods)), [], periods)
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(member).alias("n_members"))
    counts = counts.withColumn("n_periods", held.agg(set_size().alias("n")).scalar())
    return counts.filter(F.col("n_rows") != F.col("n_members") * F.col("n_periods"))


def sheet_count(cells: DataFrame, n: int) -> DataFrame:
    """One row when the workbook does not hold n sheets, else none."""
    return cells.agg(F.countDistinct("sheet").alias("n_sheets")).filter(F.col("n_sheets") != n)


# -- suites ---------------------------------------------------------------------


class QualityError(ValueError):
    """Some checks failed."""


@dataclass
class Suite:
    """Named checks on several tables, with one result row each.

    Results: ``check``, ``failing_rows`` and ``sample``, one failing row as JSON.
    """

    row_checks: list[tuple[DataFrame, dict[str, Column]]] = field(default_factory=list)
    key_checks: list[tuple[DataFrame, dict[str, str | Sequence[str]]]] = field(default_factory=list)
    frame_checks: list[tuple[str, DataFrame]] = field(default_factory=list)

    def rows(self, df: DataFrame, checks: dict[str, Column]) -> Suite:
        """Checks that look at one row at a time; all share one pass over df."""
        self.row_checks.append((df, checks))
        return self

    def keys(self, df: DataFrame, checks: dict[str, str | Sequence[str]]) -> Suite:
        """Uniqueness of a column (its NULLs ignored) or of a combination of columns; all share one pass over df."""
        self.key_checks.append((df, checks))
        return self

    def add(self, name: str, failing: DataFrame) -> Suite:
        """A check that compares rows; failing holds its offenders."""
        self.frame_checks.append((name, failing))
        return self

    def join(self, other: Suite) -> Suite:
        """The checks of both."""
        return Suite(
            self.row_checks + other.row_checks, self.key_checks + other.key_checks, self.frame_checks + other.frame_checks
        )

    def run(self) -> DataFrame:
        parts = [_fused(df, checks) for df, checks in self.row_checks]
        parts += [_fused_keys(df, checks) for df, checks in self.key_checks]
        parts += [_counted(name, failing) for name, failing in self.frame_checks]
        return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    """Union by halves: every union analyses its inputs again, so a long chain is slow to plan."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _union(parts[:half]).union(_union(parts[half:]))


def _results(df: DataFrame, failing: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One aggregation for many checks, each given by the condition of a failing row and the text that shows it."""
    aggregates, results = [], []
    for i, (name, (condition, text)) in enumerate(failing.items()):
        aggregates += [F.count_if(condition).alias(f"n{i}"), F.min(F.when(condition, text)).alias(f"s{i}")]
        quoted = name.replace("\\", "\\\\").replace("'", "\\'")
        results.append(f"struct('{quoted}' as check, n{i} as failing_rows, s{i} as sample)")
    return df.agg(*aggregates).selectExpr(f"inline(array({', '.join(results)}))")


def _fused(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    whole_row = F.to_json(F.struct(*df.columns))
    return _results(df, {name: (condition, whole_row) for name, condition in checks.items()})


def _fused_keys(df: DataFrame, checks: dict[str, str | Sequence[str]]) -> DataFrame:
    """Every key is one grouping set: rows are expanded once, counted before the shuffle, and shuffled once."""
    keys = {name: [key] if isinstance(key, str) else list(key) for name, key in checks.items()}
    columns = list(dict.fromkeys(c for key in keys.values() for c in key))
    sets = list(dict.fromkeys(tuple(sorted(key, key=columns.index)) for key in keys.values()))
    grouped = df.select(*columns).groupingSets([[F.col(c) for c in key] for key in sets], *columns)
    repeated = grouped.agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    failing = {}
    for name, key in keys.items():
        # the bits of the columns that a set leaves out, the first column highest
        number = sum(1 << (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in key)
        condition = F.col("__set") == number
        if isinstance(checks[name], str):
            condition = condition & F.col(checks[name]).isNotNull()
        failing[name] = (condition, F.to_json(F.struct(*key, "n_rows")))
    return _results(repeated, failing)


def _counted(name: str, failing: DataFrame) -> DataFrame:
    sample = F.min(F.to_json(F.struct(*failing.columns))).alias("sample")
    return failing.agg(F.count(F.lit(1)).alias("failing_rows"), sample).select(
        F.lit(name).alias("check"), "failing_rows", "sample"
    )


def require(results: DataFrame) -> DataFrame:
    """Raise when a check of a suite failed; the results are one row per check."""
    failed = results.filter("failing_rows > 0").select("check", "failing_rows", "sample").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']}: {r['failing_rows']} rows, e.g. {r['sample']}" for r in failed))
    return results
