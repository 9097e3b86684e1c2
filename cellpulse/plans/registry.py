"""Registry of named queries: Spark implementation + independent oracle SQL.

``QUERIES[name] = (spark_fn, oracle_select)``.  ``spark_fn(p)`` receives the
lazy :class:`Pipeline` and returns a DataFrame; ``oracle_select`` is a DuckDB
SELECT over the pipeline CTEs of :mod:`oracle_base` (or ``None`` when the
operator has no exact SQL form).  Double columns are rounded to 6 digits on
both sides at the very end (never in between).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.scalar import round_half_up

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column once, at the end."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round_half_up(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def wrap_sql(select_sql: str, doubles: list[str], digits: int = 6) -> str:
    from .oracle_base import with_ctes
    inner = with_ctes(select_sql)
    if not doubles:
        return inner
    scale = f"1e{digits}"
    repl = ", ".join(f'round("{c}" * {scale}) / {scale} AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) AS q"
