"""Assembles the registered queries for the driver contract."""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import q_evaluate, q_investigate, q_models, q_pipeline, q_public, q_quality, q_reports, q_sinks  # noqa: F401  (register queries)
from .double_columns import DOUBLE_COLUMNS
from .pipeline import pipeline
from .registry import QUERIES, finish, wrap_sql


def _runner(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return finish(fn(pipeline(spark, sf_dir)))
    return run


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(fn) for name, (fn, _) in QUERIES.items()}


def oracle_queries() -> dict[str, str]:
    return {name: wrap_sql(sql, DOUBLE_COLUMNS.get(name, []))
            for name, (_, sql) in QUERIES.items() if sql is not None}
