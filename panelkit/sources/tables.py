"""Parquet staging files, declared schemas, full-replace loads and seeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources.delimited import read_delimited
from panelkit.sources.snapshot import Snapshot


class SchemaError(ValueError):
    """The data does not fit the declared schema."""


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order; a missing one raises."""
    return spark.read.parquet(path).select(*schema.names)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema and cast; a NULL in a required column fails the job.

    Spark does not enforce nullability on its own, hence the assertion inside
    the projection: it costs no extra pass.
    """
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {missing}")
    columns = []
    for field in schema.fields:
        column = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            column = F.coalesce(column, F.raise_error(F.lit(f"NULL in required column {field.name}")).cast(field.dataType))
        columns.append(column.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def create_namespace(spark: SparkSession, name: str, description: str = "", location: str | None = None) -> None:
    """Create a database unless it exists."""
    place = f" LOCATION '{location}'" if location else ""
    comment = description.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{comment}'{place}")


def digest(columns: Sequence[str]) -> list[Column]:
    """What tells one collection of rows from another whatever their order: how many, and the sum and xor of their hashes.

    A NULL adds nothing to a hash, so where they stand is hashed as well.
    """
    row = F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])
    return [F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(28,0)")).alias("sum"), F.bit_xor(row).alias("xor")]


def load_table(df: DataFrame, table: str, schema: T.StructType) -> int:
    """Replace a table by the frame and check that every row arrived as it was sent.

    The rows sent are counted and their digest is taken while they are written, so the frame is computed once. Returns
    the row count.
    """
    sent = Observation()
    conform(df, schema).observe(sent, *digest(schema.names)).write.mode("overwrite").saveAsTable(table)
    reconcile_row_count(df.sparkSession, table, sent.get["n"])
    reconcile_content(df.sparkSession.table(table), table, sent.get)
    return sent.get["n"]


def store_table(snapshot: Snapshot, df: DataFrame, name: str, schema: T.StructType) -> int:
    """The same for a table of a snapshot, which is replaced when the snapshot is published."""
    sent = Observation()
    stored = snapshot.store(conform(df, schema).observe(sent, *digest(schema.names)), name)
    reconcile_content(stored, name, sent.get)
    return sent.get["n"]


def reconcile_row_count(spark: SparkSession, table: str, expected: int) -> int:
    loaded = spark.table(table).count()
    if loaded != expected:
        raise SchemaError(f"{table}: {loaded} rows loaded, {expected} sent")
    return loaded


def reconcile_content(loaded: DataFrame, table: str, sent: Mapping[str, object]) -> None:
    """Raise when the rows are not those sent, be they as many."""
    found = loaded.agg(*digest(loaded.columns)).first().asDict()
    if found["n"] != sent["n"]:
        raise SchemaError(f"{table}: {found['n']} rows loaded, {sent['n']} sent")
    if found != {name: sent[name] for name in found}:
        raise SchemaError(f"{table}: {found['n']} rows loaded and sent, but not the same")


def content_check(sent: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row when two tables do not hold the same rows, else none: the rows of each, and whether only values differ."""
    other = loaded.select(*sent.columns).agg(F.struct(*digest(sent.columns)).alias("d")).scalar()
    both = sent.agg(F.struct(*digest(sent.columns)).alias("sent")).withColumn("loaded", other)
    differ = both.filter(~F.col("sent").eqNullSafe(F.col("loaded")))
    same_count = F.col("sent.n") == F.col("loaded.n")
    return differ.select(F.col("sent.n").alias("n_sent"), F.col("loaded.n").alias("n_loaded"), same_count.alias("same_count"))


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A static dimension from CSV with its declared types (codes stay text).

    A value of another type, a row of another length, and a NULL in a required
    column stop the job.
    """
    texts = read_delimited(spark, path, schema.names, sep=",")
    return conform(texts, schema)


def source(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    """A table by its logical name."""
    return spark.table(f"{namespace}.{table}")


def materialise_view(df: DataFrame, name: str) -> DataFrame:
    """Recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialise_table(df: DataFrame, name: str) -> DataFrame:
    """Rebuilt as a stored table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
