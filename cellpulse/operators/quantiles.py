"""Exact quantiles without collecting a group into one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a large group.  This helper finds
the order statistics by radix selection on the double's (sign, exponent,
mantissa) digits: each round counts rows per digit block with a partial
aggregation, locates the block holding each target rank, and keeps only the
rows of those blocks for the next round.  After the last round a block holds a
single distinct value.  Nothing but (group, value) is stored, and only when the
caller's rows are not: the digits are made again each round.  Results equal linear-interpolation quantiles
(NumPy ``linear``, SQL ``quantile_cont`` / ``percentile_cont``).
"""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .publish import store

#: Up to so many blocks are broadcast to pick the rows of a round by their values; more are joined by shuffle, on their digits.
BROADCAST_BLOCKS = 100_000

MANTISSA_ROUNDS = (12, 32, 52)


def _digits(v: Column, bits: int) -> tuple[Column, Column, Column]:
    a = F.abs(v)
    e0 = F.floor(F.log2(a))
    r = a / F.pow(F.lit(2.0), e0)
    e = F.when(r >= 2.0, e0 + 1).when(r < 1.0, e0 - 1).otherwise(e0)
    frac = a / F.pow(F.lit(2.0), e) - F.lit(1.0)
    m = F.floor(frac * F.lit(float(2 ** bits)))
    s = F.signum(v).cast("long")
    zero = v == 0
    return (s,
            F.when(zero, F.lit(0)).otherwise(s * e).cast("long"),
            F.when(zero, F.lit(0)).otherwise(s * m).cast("long"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], groups: list[str] | None = None,
                    prob_col: str = "prob", out_col: str = "quantile", stored: bool = False) -> DataFrame:
    """One row per (groups..., prob) with the exact linear-interpolated quantile.

    Nulls and NaN are ignored.  Groups without values produce no row.  ``stored``: ``df`` reads a stored table, each
    round reads it again; else its groups and values are stored once.
    """
    g = list(groups or [])
    ungrouped = not g
    if ungrouped:
        df, g = df.withColumn("_all", F.lit(0)), ["_all"]
    base = (df.select(*g, F.col(value).cast("double").alias("_v"))
              .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    if not stored:
        base = store(base, "quantiles")
    n = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    p = F.explode(F.array(*[F.struct(F.lit(i).alias("_pi"), F.lit(float(q)).alias(prob_col))
                            for i, q in enumerate(probs)]))
    t = n.select(*g, "_n", p.alias("_p")).select(*g, "_n", "_p._pi", f"_p.{prob_col}")
    h = (F.col("_n") - 1).cast("double") * F.col(prob_col)
    t = t.withColumn("_h", h).withColumn("_klo", F.floor("_h")).withColumn("_khi", F.ceil("_h"))
    # one target per (group, prob, side); a target carries its current block and rows below it
    targets = (t.select(*g, "_pi", prob_col, "_h", "_klo",
                        F.explode(F.array(F.lit(0), F.lit(1))).alias("_side"), "_khi")
                .withColumn("_rank", F.when(F.col("_side") == 0, F.col("_klo")).otherwise(F.col("_khi")))
                .withColumn("_below", F.lit(0).cast("long")))
    digit_cols = [[f"_s{rnd}", f"_e{rnd}", f"_m{rnd}"] for rnd in range(len(MANTISSA_ROUNDS))]

    def with_digits(rows: DataFrame, rounds: int) -> DataFrame:
        # Values are not null here.  Columns that cannot be null get no null test, which would make the digits of all rows.
        return rows.withColumns({name: F.coalesce(expr, F.lit(0)) for cur, bits in list(zip(digit_cols, MANTISSA_ROUNDS))[:rounds]
                                 for name, expr in zip(cur, _digits(F.col("_v"), bits))})

    targets = cut_lineage(targets)
    prev_cols: list[str] = []
    rows = with_digits(base, 1)
    for rnd, cur in enumerate(digit_cols):
        counts = rows.groupBy(*g, *prev_cols, *cur).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_vmin"), F.max("_v").alias("_vmax"))
        w = (Window.partitionBy(*g, *prev_cols).orderBy(*cur)
             .rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        hit = (targets.join(counts, [*g, *prev_cols])
               .where((F.col("_below") + F.col("_off") <= F.col("_rank"))
                      & (F.col("_rank") < F.col("_below") + F.col("_off") + F.col("_c"))))
        targets = (hit.withColumn("_below", F.col("_below") + F.col("_off"))
                      .drop("_off", "_c"))
        prev_cols = prev_cols + cur
        if rnd < len(digit_cols) - 1:
            targets = cut_lineage(targets)  # at most two rows a group and probability
            blocks = targets.select(*g, *prev_cols, "_vmin", "_vmax").distinct()
            targets = targets.drop("_vmin", "_vmax")
            if targets.count() <= BROADCAST_BLOCKS:
                # A block's rows are those between its least and largest value: digits are made of these only.
                ranges = F.broadcast(blocks.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], "_vmin", "_vmax"))
                on = [F.col(c) == F.col(f"_g{i}") for i, c in enumerate(g)]
                inside = base.join(ranges, reduce(and_, on) & F.col("_v").between(F.col("_vmin"), F.col("_vmax")), "left_semi")
                rows = with_digits(inside, rnd + 2)
            else:
                rows = with_digits(base, rnd + 2).join(blocks.drop("_vmin", "_vmax"), [*g, *prev_cols], "left_semi")
    lo = F.max(F.when(F.col("_side") == 0, F.col("_vmin")))
    hi = F.max(F.when(F.col("_side") == 1, F.col("_vmin")))
    res = targets.groupBy(*g, "_pi", prob_col, "_h", "_klo").agg(lo.alias("_lo"), hi.alias("_hi"))
    q = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_h") - F.col("_klo"))
    res = res.select(*g, prob_col, q.alias(out_col))
    return res.drop("_all") if ungrouped else res


def exact_quantile_columns(df: DataFrame, value: str, probs: dict[str, float],
                           groups: list[str] | None = None, stored: bool = False) -> DataFrame:
    """Wide form: one row per group, one column per named probability."""
    g = list(groups or [])
    names = list(probs)
    long = exact_quantiles(df, value, [probs[k] for k in names], g, stored=stored)
    aggs = [F.max(F.when(F.col("prob") == F.lit(float(probs[k])), F.col("quantile"))).alias(k) for k in names]
    if g:
        return long.groupBy(*g).agg(*aggs)
    return long.agg(*aggs)
