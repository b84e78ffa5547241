"""What the operators share: reading tables, storing intermediate results, cutting Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tianguis.session import use_checkpoint_folder

#: Characters that one step inside a task handles at a time, unless a single text is longer.
STEP_CHARS = 1 << 20
#: Bytes and rows of one Arrow batch sent to a Python worker; a longer single row travels alone.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker receives at once, so that long texts do not add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back: the lineage ends, every executor can
    read it, and a lost executor costs nothing but its running tasks."""
    spark = df.sparkSession
    path = f"{use_checkpoint_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for a frame that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def steps(lengths: np.ndarray | list[int], most: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Cut rows 0..n into runs whose lengths sum to at most ``most``; a longer row is a run of its own."""
    start, total = 0, 0
    for i, length in enumerate(lengths):
        if i > start and total + length > most:
            yield start, i
            start, total = i, 0
        total += length
    if len(lengths) > start:
        yield start, len(lengths)


def texts_of(column) -> list[str]:
    """The texts of an Arrow column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]
