"""From the delimited index file to the staged long index table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import text
from panelkit.operators import checks
from panelkit.sources.delimited import read_delimited

# Fixed values of the source file: its header, its labels and their codes.
INDEX_HEADER = ("Autonomous Communities and Cities", "Index type", "Indices and rates", "Periodo", "Total")
INDEX_TYPES = {"General": "general", "New dwelling": "new", "Second-hand dwelling": "second_hand"}
METRIC_TYPES = {"Annual average index": "index", "Annual variation": "annual_variation_pct"}

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("group_code", T.StringType(), False),
        T.StructField("group_name", T.StringType(), False),
        T.StructField("index_type", T.StringType(), False),
        T.StructField("metric_type", T.StringType(), False),
        T.StructField("year", T.LongType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, INDEX_HEADER, sep="\t", missing=text.MISSING_TOKENS)


def parse_index(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Typed long index table; labels stay as published."""
    geography, kind, metric, period, total = [F.col(f"`{name}`") for name in INDEX_HEADER]
    year = text.strip(period)
    return raw.select(
        text.code_prefix(geography).alias("group_code"),
        text.code_name(geography).alias("group_name"),
        text.strip(kind).alias("index_type"),
        text.strip(metric).alias("metric_type"),
        (year.cast("int") if strict else year.try_cast("int")).cast("bigint").alias("year"),
        text.locale_number(total, strict, text.MISSING_TOKENS).alias("value"),
    )


def index_checks(parsed: DataFrame, n_geographies: int) -> checks.Suite:
    """What must hold before the file is used."""
    count = parsed.agg(F.countDistinct("group_code", "group_name").alias("n")).filter(F.col("n") != n_geographies)
    return (
        checks.Suite()
        .add("number of geographies", count)
        .add("index types", checks.accepted_domain(parsed, "index_type", list(INDEX_TYPES)))
        .add("metric types", checks.accepted_domain(parsed, "metric_type", list(METRIC_TYPES)))
        .add("grain", checks.unique_combination(parsed, ["group_code", "index_type", "metric_type", "year"]))
    )


def stage_index(raw: DataFrame, national_code: str = "00") -> DataFrame:
    """Labels to codes; an unknown label becomes NULL."""
    return raw.select(
        "group_code",
        "group_name",
        (F.col("group_code") == national_code).alias("is_national"),
        text.decode(F.col("index_type"), INDEX_TYPES).alias("index_type"),
        text.decode(F.col("metric_type"), METRIC_TYPES).alias("metric_type"),
        F.col("year").cast("bigint").alias("year"),
        F.col("value").cast("double").alias("value"),
    )
