"""Pass/fail investigation: nearest peers, bootstrap effects, permutation importance, exact class shares, average precision."""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .carry import history_join, month, running_before
from .series import ordered_positions

#: Rows of a block of the permutation; each block is permuted in itself.
PERMUTE_ROWS = 50_000


def nearest_peer(failed: DataFrame, passed: DataFrame, by: list[str], time: str, id_col: str) -> DataFrame:
    """``failed`` with ``peer_id`` and ``peer_gap_seconds`` of the passed row nearest in time among equal ``by``:
    the earlier one of equal gaps, the smallest id of one time; null where the group has none."""
    peers = passed.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("_p_time")).agg(F.min(id_col).alias("_p_id"))
    back = peers.withColumn("_before", F.struct("_p_time", "_p_id"))
    x = history_join(failed, back, by, time, "_p_time", month, {"_b": ("last", "_before")})
    # forwards in time is backwards in negated time
    mirrored = x.withColumn("_neg", -F.unix_micros(F.col(time).cast("timestamp_ltz")))
    ahead = back.withColumn("_n_time", -F.unix_micros(F.col("_p_time").cast("timestamp_ltz"))).withColumnRenamed("_before", "_after")
    x = history_join(mirrored, ahead, by, "_neg", "_n_time", lambda t: F.floor(t / (30 * 86_400_000_000)), {"_a": ("last", "_after")})

    def gap(side: str) -> Column:
        return F.abs(F.unix_micros(F.col(time).cast("timestamp_ltz")) - F.unix_micros(F.col(f"{side}._p_time").cast("timestamp_ltz")))
    use_after = F.col("_b").isNull() | (F.col("_a").isNotNull() & (gap("_a") < gap("_b")))
    return (x.withColumn("peer_id", F.when(use_after, F.col("_a._p_id")).otherwise(F.col("_b._p_id")))
            .withColumn("peer_gap_seconds", F.floor(F.when(use_after, gap("_a")).otherwise(gap("_b")) / 1_000_000))
            .drop("_b", "_a", "_neg"))


def poisson_cuts(most: int = 12) -> list[int]:
    """32-bit cuts of the Poisson(1) distribution: a uniform 32-bit number has as many events as cuts it reaches."""
    total, cuts = 0.0, []
    for k in range(most):
        total += math.exp(-1.0) / math.factorial(k)
        cuts.append(math.floor(total * 2**32))
    return cuts


def hash32(*parts: Column) -> Column:
    """A 32-bit number that depends on the values only, the same on every engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary")), 1, 8), 16, 10).cast("long")


def bootstrap_effect(df: DataFrame, id_col: str, label: str, features: list[str], replicates: int = 100, seed: int = 7,
                     level: float = 0.95) -> DataFrame:
    """feature, effect (mean with label 1 less mean with 0), lo, hi: a Poisson bootstrap in one aggregation.

    Each row takes part in each replicate as often as a Poisson(1) number of its id and the replicate says; replicates in which
    a label has no row are left out of the interval.  Null features take no part."""
    u = hash32(F.lit(seed), F.col("rep"), F.col(id_col))
    weight = sum((F.when(u >= c, 1).otherwise(0) for c in poisson_cuts()), F.lit(0))
    long = df.select(id_col, label, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])).alias("v")).select(
        id_col, label, "v.feature", "v.x").where(F.col("x").isNotNull())
    reps = long.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates)))).withColumn(
        "w", F.when(F.col("rep") == 0, 1).otherwise(weight))  # replicate 0 is the table itself
    y = F.col(label) == 1

    def mean(side: Column) -> Column:
        return F.try_divide(F.sum(F.when(side, F.col("w") * F.col("x"))), F.sum(F.when(side, F.col("w"))).cast("double"))
    effects = reps.groupBy("feature", "rep").agg((mean(y) - mean(~y)).alias("d"))
    tail = (1.0 - level) / 2
    resampled = F.when(F.col("rep") > 0, F.col("d"))
    # at most `replicates` values a feature
    return effects.groupBy("feature").agg(F.max(F.when(F.col("rep") == 0, F.col("d"))).alias("effect"),
                                          F.percentile(resampled, tail).alias("lo"), F.percentile(resampled, 1 - tail).alias("hi"))


def permuted(df: DataFrame, id_col: str, features: list[str], repeats: int, seed: int) -> DataFrame:
    """``df`` once per (feature, repeat) with that feature's values permuted: each row takes the value of the next row in hash
    order, the last of a block that of the first.  Blocks are hash ranges of about ``PERMUTE_ROWS`` rows."""
    blocks = max(1, -(-df.count() // PERMUTE_ROWS))
    runs = F.explode(F.array(*[F.lit(f) for f in features])).alias("feature")
    x = df.select("*", runs).withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    key = F.concat_ws(":", F.lit(str(seed)), "rep", "feature", F.col(id_col).cast("string"))
    x = x.withColumn("_h", F.md5(key.cast("binary"))).withColumn(
        "_blk", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * blocks / 2**32))
    value = F.coalesce(*[F.when(F.col("feature") == f, F.col(f).cast("double")) for f in features])
    ring = Window.partitionBy("feature", "rep", "_blk").orderBy("_h", id_col)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.withColumn("_v", value).withColumn("_next", F.lead(F.struct("_v")).over(ring)).withColumn(
        "_first", F.first(F.struct("_v")).over(whole))
    taken = F.coalesce(F.col("_next"), F.col("_first"))["_v"]
    for f in features:
        x = x.withColumn(f, F.when(F.col("feature") == f, taken).otherwise(F.col(f).cast("double")))
    return x.drop("_h", "_blk", "_v", "_next", "_first")


def permutation_importance(df: DataFrame, id_col: str, target: str, features: list[str], score: Callable[[], Column],
                           repeats: int = 10, seed: int = 0) -> DataFrame:
    """feature, importance, spread: mean and population deviation over repeats of the rise in squared error.

    ``score()`` is the model's prediction as a column over the features' names; it is applied once to all permuted copies."""
    error = F.pow(score() - F.col(target).cast("double"), 2)
    base = df.agg(F.avg(error)).first()[0]
    runs = permuted(df.select(id_col, target, *features), id_col, features, repeats, seed).groupBy("feature", "rep").agg(
        (F.avg(error) - F.lit(base)).alias("rise"))
    return runs.groupBy("feature").agg(F.avg("rise").alias("importance"), F.stddev_pop("rise").alias("spread"))


def stratified_split(df: DataFrame, id_col: str, label: str, fraction: float, seed: int = 0, out: str = "is_test") -> DataFrame:
    """``df`` with ``out``: exactly ``floor(fraction n + 0.5)`` rows of each class, the first in hash order.

    Rows are counted by (class, hash prefix), so only the prefix that holds the cut needs an order; the result does not
    depend on partitioning."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    x = df.withColumn("_class", F.coalesce(F.col(label).cast("string"), F.lit(""))).withColumn("_h", h)
    x = ordered_positions(x, ["_class"], F.substring("_h", 1, 3), [F.col("_h"), F.col(id_col)], "_pos", "_n")
    return x.withColumn(out, F.col("_pos") <= F.floor(F.col("_n") * fraction + 0.5)).drop("_class", "_h", "_pos", "_n")


def average_precision(scored: DataFrame, groups: list[str], y: str, p: str) -> DataFrame:
    """``groups``, rows, positives, average_precision (null without positives): running precision at each distinct score,
    falling, weighted by the recall gained there; the runs go over score blocks."""
    steps = scored.groupBy(*groups, F.col(p).alias("_p")).agg(F.sum(y).alias("_tp"), F.count(F.lit(1)).alias("_n"))
    steps = steps.withColumn("_down", -F.col("_p"))
    ran = running_before(steps, groups, F.floor(F.col("_down") * 256), ["_down"], {"_tps": ("sum", "_tp"), "_ns": ("sum", "_n")})
    tps, ns = (F.coalesce(c, F.lit(0)) + d for c, d in ((F.col("_tps"), F.col("_tp")), (F.col("_ns"), F.col("_n"))))
    return ran.groupBy(*groups).agg(
        F.sum("_n").alias("rows"), F.sum("_tp").alias("positives"),
        F.try_divide(F.sum(F.col("_tp") * (tps / ns.cast("double"))), F.sum("_tp").cast("double")).alias("average_precision"))
