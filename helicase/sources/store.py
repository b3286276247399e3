"""Folders and single files on any file system that Spark opens."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: By application and base folder: the folder below which this process writes.
_roots: dict[tuple[str, str], str] = {}


def located(spark: SparkSession, path: str):
    """Hadoop's path and the file system that holds it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, store = located(spark, path)
    return store.exists(found)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder, as a qualified URI, below spark.checkpoint.dir, which every executor sees; it goes when the driver ends.

    Only where the setting is missing (tests in local mode) is a temporary folder made and set.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="helicase-")
        spark.conf.set("spark.checkpoint.dir", base)
    key = spark.sparkContext.applicationId, base
    if key not in _roots:
        root, store = located(spark, f"{base.rstrip('/')}/{key[0]}-{uuid.uuid4().hex}")
        store.mkdirs(root)
        store.deleteOnExit(root)
        _roots[key] = store.makeQualified(root).toString()
    return f"{_roots[key]}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    found, store = located(spark, path)
    store.delete(found, True)


def materialised(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes df as Parquet below the shared folder (to that path, if given) and reads it again: lineage ends there."""
    path = path or shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put_file(spark: SparkSession, target: str, write: Callable[[str], None]) -> str:
    """Makes a file by write(local path) and moves it to its place under a name of its own first, so no half file is seen."""
    folder = tempfile.mkdtemp(prefix="helicase-put-")
    try:
        local = os.path.join(folder, "file")
        write(local)
        found, store = located(spark, target)
        part, _ = located(spark, f"{target}.{uuid.uuid4().hex}.part")
        store.mkdirs(found.getParent())
        store.copyFromLocalFile(True, True, spark._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), part)
        store.delete(found, False)
        if not store.rename(part, found):
            raise OSError(f"cannot write {target}")
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return target


def put_text(spark: SparkSession, target: str, text: str) -> str:
    def write(local: str) -> None:
        with open(local, "w", encoding="utf-8") as f:
            f.write(text)

    return put_file(spark, target, write)


def text_of(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    return spark.read.text(path, wholetext=True).first().value
