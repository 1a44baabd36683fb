"""Keep heavy per-row work on all cores."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """Distribute by keys over the configured number of shuffle partitions.

    Adaptive execution merges small shuffle partitions by their bytes. Geometry is small
    in bytes and heavy in work, so here the number of partitions is stated. Windows and
    joins on the same keys reuse the distribution.
    """
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(n, *keys)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only a local session without that setting gets a temporary folder; executors elsewhere could not read it."""
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or (found.get() if found.isDefined() else None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(frame: DataFrame) -> DataFrame:
    """Write a frame as Parquet to the shared folder and go on from there: iterations need a short lineage.

    A table read again carries none of the constraints and partitionings that a checkpointed plan keeps, which would
    double with every self-join of a loop and let planning take minutes.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
