"""Session for tests, the bench and small local runs.

On a cluster the submitter sets memory, cores and ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "panelkit", memory: str = "8g") -> SparkSession:
    partitions = cores if isinstance(cores, int) else os.cpu_count() or 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # call sites are looked up for every column expression otherwise
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )
