"""Structured Streaming twins of the batch telemetry operators.

``stream_parse_log`` applies the same parse expression to ``readStream.text``;
``stream_cycle_agg`` rolls parsed samples up per cell and hour with a
watermark so late rows older than the watermark are dropped and state is
bounded.  With ``trigger(availableNow=True)`` each equals its batch twin on
the same files.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.rawlog import parse_raw_log


def stream_parse_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_raw_log(spark.readStream.format("text").load(path))


def stream_cycle_agg(parsed: DataFrame, watermark: str = "2 hours") -> DataFrame:
    ok = parsed.where(F.col("malformed") == 0).withColumn(
        "event_time", F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return (ok.withWatermark("event_time", watermark)
              .groupBy("cell_id", F.window("event_time", "1 hour"))
              .agg(F.count(F.lit(1)).alias("samples"), F.avg("voltage").alias("mean_voltage"),
                   F.max("temperature").alias("max_temperature")))


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, output_mode: str = "append") -> None:
    """Process everything available and stop (file sink, restartable from the checkpoint)."""
    q = (df.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
           .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
