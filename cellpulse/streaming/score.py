"""Streaming scoring with idempotent batch writes.

Each micro-batch is scored and written to a folder named after its number; a batch that is
run again after a failure overwrites its own folder, so a result is never doubled.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str) -> None:
    """Score everything available with ``score`` (a fitted ``PipelineModel.transform`` or any frame function) and stop."""
    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out_path}/batch={number}")
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def scored(spark, out_path: str) -> DataFrame:
    """All scored rows."""
    return spark.read.option("basePath", out_path).parquet(f"{out_path}/batch=*").drop("batch")
