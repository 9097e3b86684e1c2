"""Aggregates over all earlier rows of a key, without one task a key.

A running value (count, sum, max, min, last) over a key's history needs an order, but
not one task: rows are dealt by (key, block) where ``block`` never falls along the
order; each block adds up its own earlier rows in a window, and what all earlier
blocks give is a window over one row a block, joined back on the partitioning
the blocks already have.  The as-of join, the many-match range join, interval overlap,
gap and order checks are all built on it, and none of them makes row pairs.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KINDS = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}


def _both(kind: str, a: Column, b: Column) -> Column:
    """``a`` of the earlier blocks and ``b`` of the block itself."""
    if kind in ("count", "sum"):
        return F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    if kind == "last":
        return F.coalesce(b, a)
    return F.greatest(a, b) if kind == "max" else F.least(a, b)


def running_before(df: DataFrame, keys: list[str], block: Column, order: list[str],
                   aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with, per entry ``out: (kind, column)`` of ``aggs``, the aggregate of ``column`` over all rows of the
    same ``keys`` that come before in ``order`` (ascending; ``last`` takes the last non-null).  Counts are 0, others null,
    where nothing comes before.  Rows that tie in ``order`` come in no stated order.  Null keys are keys."""
    x = df.withColumn("_blk", block)
    place = F.struct(*order)

    def total(kind: str, c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), place)) if kind == "last" else _KINDS[kind](c)

    def earlier(kind: str, c: str, window) -> Column:
        return F.last(c, ignorenulls=True).over(window) if kind == "last" else _KINDS[kind](c).over(window)

    sums = x.groupBy(*keys, "_blk").agg(*[total(k, c).alias(f"_t_{out}") for out, (k, c) in aggs.items()])
    over_blocks = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    combine = {"count": "sum"}
    carried = sums.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_blk").alias("_k_blk"), *[
        earlier(combine.get(k, k), f"_t_{out}", over_blocks).alias(f"_c_{out}") for out, (k, _) in aggs.items()])
    inside = Window.partitionBy(*keys, "_blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    x = x.select("*", *[earlier(k, c, inside).alias(f"_w_{out}") for out, (k, c) in aggs.items()])
    same = F.lit(True)
    for k in keys + ["_blk"]:
        same = same & F.col(k).eqNullSafe(F.col("_k_blk" if k == "_blk" else f"_k_{k}"))
    x = x.join(carried, same)
    for out, (kind, _) in aggs.items():
        both = _both(kind, F.col(f"_c_{out}"), F.col(f"_w_{out}"))
        x = x.withColumn(out, F.coalesce(both, F.lit(0)) if kind == "count" else both)
    return x.select(*df.columns, *aggs)


def history_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, block: "callable",
                 aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """``left`` with ``aggs`` over all rows of ``right`` of equal ``by`` whose time is not after the row's own.

    ``last`` gives the as-of join; counts and maxima give what a many-match range join would aggregate to.
    ``block(time)`` maps a time to its block.  Columns of ``left`` keep their names; ``right`` columns must not clash with them."""
    columns = sorted({c for _, c in aggs.values()})
    l = left.select(*[F.col(c).alias(f"_l_{c}") for c in left.columns], *[F.col(c).alias(f"_by_{c}") for c in by],
                    F.col(left_time).alias("_time"), F.lit(1).alias("_side"))
    r = right.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col(right_time).alias("_time"), F.lit(0).alias("_side"),
                     *[F.col(c).alias(f"_r_{c}") for c in columns]).where(F.col("_time").isNotNull())
    both = l.unionByName(r, allowMissingColumns=True)
    ran = running_before(both, [f"_by_{c}" for c in by], block(F.col("_time")), ["_time", "_side"],
                         {out: (k, f"_r_{c}") for out, (k, c) in aggs.items()})
    return ran.where("_side = 1").select(*[F.col(f"_l_{c}").alias(c) for c in left.columns], *aggs)


def month(time: Column) -> Column:
    """A block of time for series of some rows a day."""
    return F.date_trunc("month", time)


def overlaps(df: DataFrame, keys: list[str], start: str, end: str, id_col: str, block: Column) -> DataFrame:
    """``df`` with ``overlaps``: an interval of the key that starts earlier (or equally, with a smaller id) ends after its start."""
    ran = running_before(df, keys, block, [start, id_col], {"_ends": ("max", end)})
    return ran.withColumn("overlaps", F.coalesce(F.col("_ends") > F.col(start), F.lit(False))).drop("_ends")
