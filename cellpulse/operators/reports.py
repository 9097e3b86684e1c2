"""Report and ad-hoc query operators over the marts."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import _digits


def cume_dist_column(df: DataFrame, value: str, out: str) -> DataFrame:
    """Share of rows with a value <= the row's value (``cume_dist``), without a
    single-partition window: distinct values are counted (partial aggregation),
    grouped into order-preserving digit blocks, and the running count is a
    block offset plus a running sum inside the block."""
    v = F.col(value).cast("double")
    vc = df.where(v.isNotNull()).groupBy(v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    s, e, m = _digits(F.col("_v"), 12)
    vc = vc.withColumn("_bs", s).withColumn("_be", e).withColumn("_bm", m)
    blocks = vc.groupBy("_bs", "_be", "_bm").agg(F.sum("_c").alias("_bc"))
    before = Window.orderBy("_bs", "_be", "_bm").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_boff", F.coalesce(F.sum("_bc").over(before), F.lit(0)))
    inside = Window.partitionBy("_bs", "_be", "_bm").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    total = df.where(v.isNotNull()).select(F.count(F.lit(1))).scalar()
    cum = (vc.join(blocks, ["_bs", "_be", "_bm"])
             .select("_v", ((F.col("_boff") + F.sum("_c").over(inside)) / total).alias(out)))
    return df.join(cum, v == F.col("_v"), "left").drop("_v")


def fleet_percentile(health: DataFrame, values: list[str], outs: list[str]) -> DataFrame:
    out = health.select("cell_id", *values)
    for v, o in zip(values, outs):
        out = cume_dist_column(out, v, o)
    return out.select("cell_id", *outs)


def weighted_rate(rate: str, weight: str = "num_cells"):
    """sum(rate x weight) / sum(weight).  The products are summed as exact
    decimals, so the result does not depend on the summation order."""
    num = F.sum(F.col(rate).cast("decimal(38,12)") * F.col(weight)).cast("double")
    return num / F.sum(F.col(weight)).cast("double")


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """Top-k rows by ``order`` (a total order: callers end it with a key column)."""
    return df.orderBy(*order).limit(k)


def per_group_tail(df: DataFrame, group: list[str], order_col: str, k: int) -> DataFrame:
    """Last ``k`` rows of each group by ``order_col``.  The rank filter is pushed
    below the shuffle (partial per-group limit) by Spark's window group limit."""
    w = Window.partitionBy(*group).orderBy(F.col(order_col).desc())
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def correlation(x, y):
    """Sample correlation guarded against zero variance (null instead of an error)."""
    return F.try_divide(F.covar_samp(x, y), F.nullif(F.stddev_samp(x) * F.stddev_samp(y), F.lit(0.0)))
