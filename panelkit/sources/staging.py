"""Small intermediate tables written to the shared folder of the cluster.

A reduced fact table is used by several branches of a model. Writing it once
means one pass over the facts, gives Catalyst true file sizes to plan joins
with, and survives the loss of executors.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Counted:
    """A stored frame and the number of its rows."""

    frame: DataFrame
    rows: int


def stage_counted(df: DataFrame, name: str) -> Counted:
    """Stage a frame and count its rows while they are written."""
    seen = Observation()
    # rows of any schema are counted, so what is stored has the columns of the frame alone
    stored = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return Counted(stored, seen.get["n"])


def stage_buckets(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Write a frame dealt by its keys and read it back so that Spark knows: what works by these keys needs no shuffle.

    The catalog knows the table only until its frame is read back; the files stay like those of other staged frames.
    """
    spark = df.sparkSession
    own = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(n, *keys).write.option("path", f"{shared_dir(spark)}/staged/{own}")
    writer.bucketBy(n, *keys).saveAsTable(own)
    stored = spark.table(own)
    spark.sql(f"DROP TABLE {own}")
    return stored


def together(*jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent jobs at the same time, so that one fills the gaps of another.

    The threads keep the job group and the scheduler pool of the caller.
    """
    results: list = [None] * len(jobs)
    errors: list[BaseException] = []

    def run(k: int) -> None:
        try:
            results[k] = jobs[k]()
        except BaseException as error:  # noqa: BLE001  raised again below
            errors.append(error)

    threads = [InheritableThread(target=run, args=(k,), session=SparkSession.getActiveSession()) for k in range(len(jobs))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]
    return results
