"""Several tables that change together.

Every version of a table is kept beside the others, as a partition of its own. Which version counts is told by one
pointer, a table to which a publication adds one row, and so one file, after all tables are written. Readers go by
views that follow the pointer: they see all tables of one publication or all of the one before, also when a run ends
half-way. One publisher at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "published_versions"


class Snapshot:
    """One version of the tables of a namespace, in the making until it is published."""

    def __init__(self, spark: SparkSession, namespace: str):
        self.spark, self.namespace, self.version = spark, namespace, uuid.uuid4().hex
        self.written: dict[str, list[str]] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of this version and read it back; readers do not see it yet."""
        table = f"{self.namespace}.{name}_versions"
        df.withColumn("version", F.lit(self.version)).write.mode("append").partitionBy("version").saveAsTable(table)
        self.written[name] = df.columns
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        """The table as this version holds it."""
        stored = self.spark.table(f"{self.namespace}.{name}_versions")
        return stored.filter(F.col("version") == self.version).drop("version")

    def publish(self) -> dict[str, DataFrame]:
        """Turn the readers of all tables to this version, by one row."""
        pointer = f"{self.namespace}.{POINTER}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {pointer} (place BIGINT, version STRING) USING parquet")
        for name, columns in self.written.items():
            listed = ", ".join(f"`{c}`" for c in columns)
            current = f"(SELECT max_by(version, place) FROM {pointer})"
            self.spark.sql(
                f"CREATE VIEW IF NOT EXISTS {self.namespace}.{name} AS "
                f"SELECT {listed} FROM {self.namespace}.{name}_versions WHERE version = {current}"
            )
        self._point_to(self.version)
        return {name: self.spark.table(f"{self.namespace}.{name}") for name in self.written}

    def _point_to(self, version: str) -> None:
        pointer = f"{self.namespace}.{POINTER}"
        place = self.spark.table(pointer).agg(F.coalesce(F.max("place"), F.lit(0)) + 1).first()[0]
        self.spark.sql(f"INSERT INTO {pointer} VALUES ({place}, '{version}')")

    def go_back(self) -> str:
        """Publish the version before the current one again; returns it."""
        rows = self.spark.table(f"{self.namespace}.{POINTER}").orderBy(F.desc("place")).limit(2).collect()
        if len(rows) < 2:
            raise ValueError(f"{self.namespace} has no version before the current one")
        self._point_to(rows[1]["version"])
        return rows[1]["version"]
