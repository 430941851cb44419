"""Delimited text whose fields are all read as strings.

A quoted field may hold line breaks, so where a row ends depends on every quote before it. A file is still read in
parallel. Each line says what it makes of being entered outside or inside a quoted field: it leaves that as it is, turns
it round, or ends in a fixed state. The splits of a file compose this for all their lines, a prefix over one small row
per split tells how each is entered, and then every split cuts its own rows. Only the lines of rows that span several
lines meet again to be put together, wherever their splits lie.

    lines with their split  ->  one row per split: how it is left, entered outside or inside
                            ->  how each split is entered
    lines by split          ->  how each line is entered, and the row that it belongs to
    rows of several lines   ->  joined by the place of their first line
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.sources.staging import stage

QUOTE, MARK = '"', "\ufeff"
CSV = {"escape": QUOTE, "mode": "FAILFAST", "multiLine": "true"}
SPLIT = ["file", "block"]


class HeaderError(ValueError):
    """The header row is not the expected one."""


class QuoteError(ValueError):
    """A quoted field is still open at the end of its file."""


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = "\t",
    missing: Sequence[str] = (),
) -> DataFrame:
    """Read text files with a header row; a byte-order mark is ignored, blank lines are skipped.

    With ``columns`` the header of every file must be exactly that list, else that of the first file. ``missing`` lists
    texts to read as NULL. A row with another number of fields stops the read, and so does a quoted field that is never
    closed. A quote opens a field only as its first character; anywhere else in an unquoted field it is plain text.
    """
    names = list(columns) if columns is not None else header_names(spark, path, sep)
    fields = F.from_csv("text", ", ".join(f"c{k} string" for k in range(len(names))), {"sep": sep, **CSV})
    found = text_rows(spark, path, sep).withColumn("fields", fields)
    held = [F.col(f"fields.c{k}") for k in range(len(names))]
    as_expected = F.array(*held) == F.array(*map(F.lit, names))
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), F.col("file"), F.lit(": "), F.col("text"))).cast("boolean")
    data = found.filter(F.when(~F.col("is_header"), True).when(as_expected, False).otherwise(wrong))
    if missing:
        held = [F.when(~c.isin(*missing), c) for c in held]
    return data.select(*[c.alias(name) for c, name in zip(held, names, strict=True)])


def header_names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """The header of the first file."""
    return spark.read.options(sep=sep, header=True, **CSV).csv(path).columns


def assert_header(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The exact ordered column list, or an error before anything runs."""
    if df.columns != list(expected):
        raise HeaderError(f"unexpected columns: {df.columns}")
    return df


def left_inside(value: Column, sep: str, entered_inside: bool) -> Column:
    """Whether a line is left inside a quoted field.

    What lies between two separators: outside a quoted field it opens one when its first character is a quote and
    their number is odd; inside, an odd number closes the field.
    """

    def step(inside: Column, part: Column) -> Column:
        odd = F.length(F.replace(part, F.lit(QUOTE), F.lit(""))) % 2 != F.length(part) % 2
        return F.when(inside, ~odd).otherwise(part.startswith(QUOTE) & odd)

    parts = F.split(value, f"\\Q{sep}\\E", -1)
    return F.when(F.contains(value, F.lit(QUOTE)), F.aggregate(parts, F.lit(entered_inside), step)).otherwise(entered_inside)


def text_lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Every line with its split (file, block), its order in it (line), and what it does to the quotes.

    ``turns`` is 1 for a line that turns inside and outside round, ``ends`` the state it is left in however it is
    entered, NULL if that depends.
    """
    read = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    left = read.withColumns({"outside": left_inside(F.col("value"), sep, False), "inside": left_inside(F.col("value"), sep, True)})
    fixed = F.col("outside") == F.col("inside")
    return left.select(
        *read.columns, (~fixed & F.col("outside")).cast("int").alias("turns"), F.when(fixed, F.col("outside").cast("int")).alias("ends")
    )


class Passage:
    """How ordered rows of ``turns`` and ``ends`` are entered and left, for any state that the first is entered in."""

    def __init__(self, df: DataFrame, order: str, keys: Sequence[str]):
        ordered = Window.partitionBy(*keys).orderBy(order)
        until, before = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, -1)
        # the last row of a fixed end: its end, and the turns up to it
        fixed = F.when(F.col("ends").isNotNull(), F.struct(F.col("ends").alias("end"), F.col("__turned").alias("at")))
        df = df.withColumn("__turned", F.sum("turns").over(until))
        for name, frame in (("__entered", before), ("__left", until)):
            turned = F.coalesce(F.max("__turned").over(frame), F.lit(0))
            df = df.withColumn(name, F.struct(F.last(fixed, ignorenulls=True).over(frame).alias("fixed"), turned.alias("turned")))
        self.df = df

    @staticmethod
    def _state(name: str, first: Column) -> Column:
        at, end, turned = F.col(f"{name}.fixed.at"), F.col(f"{name}.fixed.end"), F.col(f"{name}.turned")
        return F.when(at.isNull(), first + turned).otherwise(end + turned - at) % 2

    def entered(self, first: Column) -> Column:
        """0 outside, 1 inside a quoted field."""
        return self._state("__entered", first)

    def left(self, first: Column) -> Column:
        return self._state("__left", first)


def text_splits(lines: DataFrame) -> DataFrame:
    """One row per split: how it is entered and left, the first line of the row that it is entered in, and of the header of its file."""
    passage, either = Passage(lines, "line", SPLIT), (F.lit(0), F.lit(1))
    begins = [F.max(F.when(passage.entered(k) == 0, F.col("line"))) for k in either]
    left = [F.max_by(passage.left(k), "line") for k in either]
    shown = F.min(F.when(~is_blank(F.col("value")), F.col("line")))
    splits = passage.df.groupBy(*SPLIT).agg(F.array(*left).alias("l"), F.array(*begins).alias("b"), shown.alias("shown"))
    fixed = F.col("l")[0] == F.col("l")[1]
    splits = splits.select("*", (~fixed & (F.col("l")[0] == 1)).cast("int").alias("turns"), F.when(fixed, F.col("l")[0]).alias("ends"))

    passage, file = Passage(splits, "block", ["file"]), Window.partitionBy("file")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = passage.entered(F.lit(0))
    splits = passage.df.withColumns({"entered_split": entered, "left_split": passage.left(F.lit(0)), "begins": F.get("b", entered.cast("int"))})
    first = F.min(F.when(F.col("shown").isNotNull(), F.col("block"))).over(file)
    return splits.select(
        *SPLIT,
        "entered_split",
        "left_split",
        F.last("begins", ignorenulls=True).over(earlier).alias("carried"),
        F.when(F.col("block") == first, F.col("shown")).alias("header"),
        (F.col("block") == F.max("block").over(file)).alias("is_last"),
    )


def is_blank(line: Column) -> Column:
    return line.isin("", "\r")


def text_rows(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """The text of every row with its file, and whether it is the header of it."""
    lines = text_lines(spark, path, sep)
    splits = stage(text_splits(lines), "text-splits")
    still_open = splits.filter("is_last and left_split = 1").first()
    if still_open:
        raise QuoteError(f"a quoted field is not closed in {still_open['file']}")
    passage = Passage(lines.join(splits, SPLIT), "line", SPLIT)
    first = F.col("entered_split")
    until = Window.partitionBy(*SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    known = passage.df.select(
        *SPLIT,
        "line",
        "value",
        F.coalesce(F.max(F.when(passage.entered(first) == 0, F.col("line"))).over(until), F.col("carried")).alias("begins"),
        F.coalesce(F.col("line") == F.col("header"), F.lit(False)).alias("is_header"),
        ((passage.entered(first) == 0) & (passage.left(first) == 0)).alias("is_whole"),
    )
    whole = known.filter(F.col("is_whole") & ~is_blank(F.col("value")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda part: part["value"])
    several = known.filter(~F.col("is_whole")).groupBy("file", "begins")
    several = several.agg(F.array_join(parts, "\n").alias("value"), F.bool_or("is_header").alias("is_header"))
    found = [df.select("file", "value", "is_header") for df in (whole, several)]
    # the mark, and what is left of a line end of two characters
    value = F.regexp_replace(F.col("value"), "\\r$", "")
    value = F.when(F.col("is_header"), F.regexp_replace(value, f"^{MARK}", "")).otherwise(value)
    return found[0].unionAll(found[1]).select("file", value.alias("text"), "is_header")
