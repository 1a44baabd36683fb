"""What the text operators share: reading, cutting lineage, and naming rows."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_HASH = "row_hash"
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and go on from there.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset (tests on one machine)
    a temporary one is made.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark))
    return frame.checkpoint()


def _own_folder(spark: SparkSession) -> str:
    """A temporary folder for a local session without a shared one; executors elsewhere could not read it."""
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="checkpoint-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for intermediates, in ``spark.checkpoint.dir`` or on the context."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        context = spark.sparkContext._jsc.sc()
        if context.getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(_own_folder(spark))
        known = context.getCheckpointDir().get()
    return known.rstrip("/")


def written(frame: DataFrame, name: str) -> str:
    """Write a frame as Parquet to a folder of its own among the shared intermediates; the folder."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return path


def discard(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate folder, wherever it is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Hand at most so many rows at once to Python, for frames whose rows are large and that are run inside the block."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def row_hash(frame: DataFrame) -> Column:
    """A hash of all columns: together with the key it tells rows of a repeated key apart.

    Each column counts with whether it is null, since a null alone would leave no trace of its place.
    """
    parts = []
    for f in frame.schema:
        c = F.col(f"`{f.name}`")
        parts += [c.isNull(), F.to_json(F.struct(c)) if _holds_map(f.dataType) else c]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def spare(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not use yet."""
    while name.lower() in {c.lower() for c in frame.columns}:
        name += "_"
    return name


def keep_rows(docs: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose (key, row hash) stands in ``chosen``; of rows alike in every column one.

    ``chosen`` has ``key`` and ``row_hash``, null keys included.
    """
    mark = spare(docs, "mark_of_row")
    pick = materialise(chosen.select(F.col(key).alias("k_"), F.col(ROW_HASH).alias("h_")).distinct())
    marked = docs.withColumn(mark, row_hash(docs))
    out = marked.join(pick, marked[key].eqNullSafe(pick["k_"]) & (marked[mark] == pick["h_"]), "left_semi")
    again = docs.select(F.col(key), row_hash(docs).alias("h_")).groupBy(key, "h_").count().where("count > 1")
    return (out if again.isEmpty() else out.dropDuplicates([key, mark])).drop(mark)


def held_out(key: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text falls into a fold; a null key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))
