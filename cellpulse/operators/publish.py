"""Versioned tables: a write is staged beside the live one and goes live by one rename.

``<path>/v-<id>`` holds a version's Parquet, ``<path>/CURRENT`` its name.  A reader sees the version CURRENT names; a
failed write leaves CURRENT and the version behind it as they were.  Folders are reached through Spark's file systems only.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sink-{uuid.uuid4().hex}"
    fs, hpath = _fs(spark, path)
    fs.deleteOnExit(hpath)
    return f"{path}/{name}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back: cuts lineage like a checkpoint, but compressed,
    and readers fetch only the columns they use."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def current_version(spark: SparkSession, path: str) -> str | None:
    fs, marker = _fs(spark, f"{path}/CURRENT")
    if not fs.exists(marker):
        return None
    return spark.read.text(f"{path}/CURRENT").first()[0]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/{version}")


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as the new version of the table at ``path`` and return it as read back; older versions stay readable
    for queries that hold them until :func:`drop_old`."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{version}")
    fs, staged = _fs(spark, f"{path}/NEXT-{version}")
    out = fs.create(staged, True)
    out.write(bytearray(version.encode()))
    out.close()
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT")
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = rename
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(staged, marker, options)
    return read_current(spark, path)


def drop_old(spark: SparkSession, path: str) -> int:
    """Remove versions that CURRENT does not name; returns how many."""
    fs, root = _fs(spark, path)
    keep, gone = current_version(spark, path), 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("v-") and name != keep:
            gone += bool(fs.delete(status.getPath(), True))
    return gone


def export_csv(frames: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each frame as CSV with a header under ``folder``; name -> path."""
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{folder}/{name}"
        df.write.mode("overwrite").option("header", True).csv(paths[name])
    return paths
