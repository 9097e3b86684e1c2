"""Reading the driver's parquet tables.

Every reader selects only the columns the pipeline uses, so the parquet scan's
``ReadSchema`` is pruned and later filters reach the scan as ``PushedFilters``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier", ("s_suppkey", "s_nationkey"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(
        spark, sf_dir, "lineitem",
        ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_discount", "l_tax", "l_shipdate"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", ("event_id", "ts", "user_id", "event_type", "value"))
