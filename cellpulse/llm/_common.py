"""Shared helpers: table access, stored intermediates, size-checked broadcasts.

Intermediates are written as Parquet in the shared folder that the session
names in ``spark.checkpoint.dir`` (an own scratch folder only where it is
unset, as in tests), so a lost executor never loses them.  Each folder is
registered for removal when the driver JVM exits.
"""
from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space of the contracts: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: A side of at most this many bytes (counted rows times row width) may be broadcast.
BROADCAST_BYTES = 48 << 20
#: Arrow batches on their way to and from Python end at about this size, whatever the length of a text: a task holds a
#: batch in the JVM, in Python's Arrow memory and as Python strings.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application; they need no checkout of their own."""
    context = spark.sparkContext
    if any(f.startswith("cellpulse-") for f in context._python_includes):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    base = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cellpulse-ship-")), f"cellpulse-{uuid.uuid4().hex}")
    context.addPyFile(shutil.make_archive(base, "zip", root, "cellpulse"))


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_BYTES``; a smaller limit already set stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))
    if limit <= 0 or limit > BATCH_BYTES:
        spark.conf.set(setting, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path).getParent()
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the counted size of a stored ``df`` is below ``limit``;
    beyond it the join shuffles both sides and adaptive execution splits skewed keys."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (extra columns may clash with ours)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name
