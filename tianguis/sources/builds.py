"""Replacing stored tables in one step.

A build is a folder of its own, ``folder/builds/<name>``. Readers follow the file ``folder/CURRENT``, which names one
build and is replaced by a rename. A build that fails half way is never named, so the tables before it stay readable
as they were; the files of earlier builds stay for readers that have already planned over them, until they are
discarded.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_build(folder: str) -> str:
    """Where a new build goes; nothing reads it yet."""
    return f"{folder.rstrip('/')}/builds/{uuid.uuid4().hex}"


def publish(spark: SparkSession, folder: str, build: str) -> None:
    """From now on readers of ``folder`` see this build."""
    jvm, folder = spark.sparkContext._jvm, folder.rstrip("/")
    draft, files = _file_system(spark, f"{folder}/.{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    stream.write(build.rsplit("/", 1)[-1].encode())
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(draft), files.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")), options)


def current(spark: SparkSession, folder: str) -> str:
    """The folder of the build that readers see; ``folder`` itself where no build was ever published."""
    folder = folder.rstrip("/")
    pointer, files = _file_system(spark, f"{folder}/{POINTER}")
    if not files.exists(pointer):
        return folder
    stream = files.open(pointer)
    name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return f"{folder}/builds/{name}"


def discard_old(spark: SparkSession, folder: str) -> int:
    """Delete all builds but the current one, once nothing reads them any more, and say how many."""
    kept = current(spark, folder).rsplit("/", 1)[-1]
    parent, files = _file_system(spark, f"{folder.rstrip('/')}/builds")
    old = [s.getPath() for s in files.listStatus(parent) if s.getPath().getName() != kept] if files.exists(parent) else []
    for path in old:
        files.delete(path, True)
    return len(old)
