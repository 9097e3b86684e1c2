"""Discrete-time survival: durations, person-period expansion, survival
products and the concordance index."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..session import cut_lineage
from .evaluate import below_sums
from .quantiles import exact_quantile_columns


def survival_frame(stats: DataFrame) -> DataFrame:
    """Per cell: first cycle with SOH < 0.80 (event) else the last cycle (censored)."""
    return stats.select(
        "cell_id",
        F.coalesce(F.col("eol_cycle"), F.col("last_cycle")).cast("int").alias("duration_cycles"),
        F.col("eol_cycle").isNotNull().cast("int").alias("event_observed"))


def expand_intervals(frame: DataFrame, width: int = config.HAZARD_INTERVAL) -> DataFrame:
    """Person-period rows at interval ends 50, 100, ...: censored cells stop at the
    last full interval, event cells emit hazard 1 at the interval holding the
    event and stop."""
    d, ev = F.col("duration_cycles"), F.col("event_observed")
    last = F.greatest(F.lit(width), (F.ceil(d / width) * width).cast("int"))
    ends = F.sequence(F.lit(width), last, F.lit(width))
    x = frame.withColumn("interval_end", F.explode(ends))
    keep = (ev == 1) | (F.col("interval_end") <= d)
    return (x.where(keep)
             .withColumn("log_interval_end", F.log1p(F.col("interval_end").cast("double")))
             .withColumn("hazard_event", ((ev == 1) & (d <= F.col("interval_end"))).cast("int")))


def survival_distribution(hazards: DataFrame, horizon: int) -> DataFrame:
    """Per cell survival quantities from per-interval hazards (cell_id, interval_end, hazard).

    S_k = prod_{j<=k} (1 - h_j) via exp(sum(log(1 - h))) over a per-cell running
    window (a cell has horizon / 50 rows); expected event cycle adds horizon x S
    at the end; median = first interval with S <= 0.5, else horizon."""
    w = Window.partitionBy("cell_id").orderBy("interval_end").rowsBetween(Window.unboundedPreceding, 0)
    h = F.col("hazard")
    x = (hazards
         .withColumn("_logs", F.sum(F.log(F.greatest(F.lit(1.0) - h, F.lit(1e-300)))).over(w))
         .withColumn("_surv", F.when(h >= 1.0, F.lit(0.0)).otherwise(F.exp("_logs")))
         .withColumn("_min_zero", F.max((h >= 1.0).cast("int")).over(w)))
    x = x.withColumn("survival", F.when(F.col("_min_zero") == 1, F.lit(0.0)).otherwise(F.col("_surv")))
    x = x.withColumn("_prev", F.coalesce(F.lag("survival").over(
        Window.partitionBy("cell_id").orderBy("interval_end")), F.lit(1.0)))
    x = x.withColumn("_event_p", F.col("_prev") * h)
    agg = x.groupBy("cell_id").agg(
        F.sum(F.col("interval_end") * F.col("_event_p")).alias("_exp"),
        F.min_by("survival", F.col("interval_end").cast("long") * -1).alias("_s_end"),
        F.min(F.when(F.col("survival") <= 0.5, F.col("interval_end"))).alias("_median"),
        F.max_by(F.lit(1.0) - F.col("survival"),
                 F.when(F.col("interval_end") <= config.RISK_HORIZON_CYCLES, F.col("interval_end")))
        .alias("_risk500"))
    return agg.select(
        "cell_id",
        F.coalesce(F.col("_median"), F.lit(horizon)).cast("int").alias("predicted_median_eol_cycle"),
        (F.col("_exp") + F.when(F.col("_s_end") > 0, F.lit(float(horizon)) * F.col("_s_end"))
         .otherwise(F.lit(0.0))).alias("predicted_expected_eol_cycle"),
        (F.lit(1.0) - F.col("_s_end")).alias("event_probability_by_horizon"),
        F.coalesce(F.col("_risk500"), F.lit(0.0)).alias("event_probability_by_500_cycles"))


def stated_hazards(cells: DataFrame, horizon: int) -> DataFrame:
    """cell_id, interval_end, hazard of the stated logistic hazard for every interval up to ``horizon``."""
    width = config.HAZARD_INTERVAL
    ends = F.explode(F.sequence(F.lit(width), F.lit(horizon), F.lit(width)))
    score = F.lit(config.STATED_HAZARD["intercept"]) + F.lit(config.STATED_HAZARD["log_interval_end"]) * F.log1p(
        F.col("interval_end").cast("double"))
    for name in config.SURVIVAL_NUMERIC:
        score = score + F.lit(config.STATED_HAZARD[name]) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return cells.withColumn("interval_end", ends).select(
        "cell_id", "interval_end", (F.lit(1.0) / (F.lit(1.0) + F.exp(-score))).alias("hazard"))


def survival_rows(cells: DataFrame, hazards: DataFrame, horizon: int) -> DataFrame:
    """Survival quantities beside what was observed: duration, event and the cycles left after the duration."""
    seen = cells.select("cell_id", "duration_cycles", "event_observed")
    left = F.col("predicted_expected_eol_cycle") - F.col("duration_cycles")
    return survival_distribution(hazards, horizon).join(seen, "cell_id").withColumn(
        "predicted_remaining_cycles_from_observed", F.greatest(left, F.lit(0.0)))


def event_errors(predictions: DataFrame, train: DataFrame) -> DataFrame:
    """One row: mean absolute error of the predicted event cycle, and of the median train event, on event cells.

    ``predictions``: duration_cycles, event_observed, predicted_expected_eol_cycle; ``train``: duration_cycles,
    event_observed.  Without train events the baseline is the median duration of all train cells."""
    median = exact_quantile_columns(
        train.select("event_observed", F.col("duration_cycles").cast("double").alias("d")).withColumn(
            "d_event", F.when(F.col("event_observed") == 1, F.col("d"))).where("d_event is not null"), "d_event", {"m": 0.5})
    every = exact_quantile_columns(train.select(F.col("duration_cycles").cast("double").alias("d")), "d", {"m": 0.5})
    guess = F.coalesce(median.select("m").scalar(), every.select("m").scalar())
    d = F.col("duration_cycles").cast("double")
    return predictions.where("event_observed = 1").agg(
        F.avg(F.abs(d - F.col("predicted_expected_eol_cycle"))).alias("model_event_mae"),
        F.avg(F.abs(d - guess)).alias("baseline_event_mae"), F.count(F.lit(1)).alias("event_cells"))


def concordance_index(df: DataFrame, duration: str = "observed_duration_cycles",
                      event: str = "event_observed", risk: str = "event_probability_by_500_cycles") -> DataFrame:
    """Harrell's C over permissible pairs (the earlier duration must be an event;
    equal durations skipped), ties in risk count one half.

    No pair is ever made.  Rows are reduced to distinct (duration, event, risk) with counts,
    durations and risks to ranks.  Of two different ranks the smaller one lies in the left and
    the larger one in the right half of exactly one node of the binary tree over the ranks, so
    every row meets its later rows in one node a level: it is copied once per level of the duration
    tree (once more per level of the risk tree for the order of the risks), and each node needs
    sums only.  Work and shuffle grow as n log^2 n, the sums of a hot node combine map-side."""
    g = df.groupBy(F.col(duration).alias("d"), F.col(event).cast("int").alias("e"), F.col(risk).alias("r")).agg(
        F.count(F.lit(1)).alias("n"))
    g = cut_lineage(g)
    x = _ranked(_ranked(g, "d").where("d_rank is not null"), "r")  # a row without risk is neither concordant nor tied
    later = _levels(x, "d_rank", "d")
    # The earlier row is an event in the left half, the later one any row in the right half.
    early = F.when((F.col("d_side") == 0) & (F.col("e") == 1), F.col("n")).otherwise(F.lit(0))
    late = F.when(F.col("d_side") == 1, F.col("n")).otherwise(F.lit(0))
    weighed = later.withColumn("early", early).withColumn("late", late).where("early > 0 or late > 0")
    pairs = _products(weighed, ["d_level", "d_node"], "early", "late")
    ties = _products(weighed.where("r_rank is not null"), ["d_level", "d_node", "r_rank"], "early", "late")
    # Concordant: the earlier row has the larger risk.
    above = _levels(weighed.where("r_rank is not null"), "r_rank", "r")
    above = (above.withColumn("early", F.when(F.col("r_side") == 1, F.col("early")).otherwise(F.lit(0)))
             .withColumn("late", F.when(F.col("r_side") == 0, F.col("late")).otherwise(F.lit(0))))
    concordant = _products(above, ["d_level", "d_node", "r_level", "r_node"], "early", "late")
    total, equal, right = (t.select("w").scalar() for t in (pairs, ties, concordant))
    res = df.sparkSession.range(1).select(total.alias("permissible"), equal.alias("ties"), right.alias("concordant"))
    return res.select(
        F.coalesce(F.col("permissible"), F.lit(0)).cast("long").alias("permissible_pairs"),
        F.when(F.col("permissible") > 0,
               (F.coalesce("concordant", F.lit(0)).cast("double") + F.lit(0.5) * F.coalesce("ties", F.lit(0)).cast("double"))
               / F.col("permissible").cast("double"))
        .alias("concordance_index"))


def _ranked(df: DataFrame, col: str) -> DataFrame:
    """``<col>_rank`` from 0: the distinct values of ``col`` in ascending order."""
    values = df.select(F.col(col).cast("double").alias("_v")).distinct().withColumn("_w", F.lit(1))
    ranks = cut_lineage(below_sums(values, "_v", ["_w"]).select("_v", F.col("below__w").cast("long").alias(f"{col}_rank")))
    return df.join(ranks, F.col(col).cast("double") == F.col("_v"), "left").drop("_v")


def _levels(df: DataFrame, rank: str, name: str) -> DataFrame:
    """One copy of a row per level of the binary tree over ``rank``: level, node and half of the node."""
    top = F.length(F.bin(df.select(F.max(rank)).scalar()))
    x = df.withColumn(f"{name}_level", F.explode(F.sequence(F.lit(0), F.coalesce(top, F.lit(1)) - 1)))
    half = F.expr(f"shiftright({rank}, {name}_level)")
    return x.withColumn(f"{name}_node", F.expr(f"shiftright({rank}, {name}_level + 1)")).withColumn(f"{name}_side", half % 2)


def _products(df: DataFrame, node: list[str], a: str, b: str) -> DataFrame:
    """One row: the sum over nodes of the sum of ``a`` times the sum of ``b``."""
    sums = df.groupBy(*node).agg(F.sum(a).alias("_a"), F.sum(b).alias("_b"))
    return sums.agg(F.sum(F.col("_a").cast("decimal(19,0)") * F.col("_b").cast("decimal(19,0)")).alias("w"))
