"""Deterministic heuristic scorers, tiers and risk drivers.

The heuristic scores are the release-backtest baselines applied to the whole
fleet.  They make every mart oracle-exact before any fitted model exists; a
fitted Spark ML model (``models.py``) can replace them column for column.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.scalar import clip, risk_tier, round_half_even
from .quantiles import exact_quantile_columns


def _one_row_scalar(df: DataFrame) -> Column:
    """The single row of ``df`` as one struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns).alias("s")).scalar()


def soh_baseline(train: DataFrame, test: DataFrame, fade_col: str = "capacity_fade_rate",
                 cycle_col: str = "cycle_count", out: str = "predicted_soh", stored: bool = False) -> DataFrame:
    """1 - median positive train fade x cycle, clipped to [0, 1.05]; 0.0004 without positive fade.  ``stored``: ``train``
    reads a stored table."""
    fade = train.select(F.greatest(F.col(fade_col), F.lit(0.0)).alias("f")).where(F.col("f") > 0)
    med = _one_row_scalar(exact_quantile_columns(fade, "f", {"median": 0.5}, stored=stored))
    fleet = F.coalesce(med["median"], F.lit(config.DEFAULT_FLEET_FADE))
    pred = clip(F.lit(1.0) - fleet * F.col(cycle_col), *config.SOH_CLIP)
    return test.withColumn(out, pred)


def rul_baseline(test: DataFrame, soh_col: str = "soh_current", fade_col: str = "capacity_fade_rate",
                 cycle_col: str = "cycle_count", out: str = "predicted_remaining_cycles", stored: bool = False) -> DataFrame:
    """(SOH - 0.8) / max(fade, 1e-6), clipped to [0, max(2 x p95 cycle, 500)].  ``stored``: ``test`` reads a stored table."""
    p95 = _one_row_scalar(exact_quantile_columns(test, cycle_col, {"p95": 0.95}, stored=stored))
    cap = F.greatest(p95["p95"] * F.lit(2.0), F.lit(config.MIN_RUL_CAP))
    fade = F.greatest(F.col(fade_col), F.lit(1e-6))
    pred = F.least(F.greatest((F.col(soh_col) - F.lit(config.SOH_EOL_THRESHOLD)) / fade, F.lit(0.0)), cap)
    return test.withColumn(out, pred)


def failure_baseline(train: DataFrame, test: DataFrame, soh_col: str = "final_soh",
                     station_col: str = "station_anomaly_rate", label_col: str = "escalation_required",
                     out: str = "failure_probability") -> DataFrame:
    """(1 - SOH)+ + 0.5 station+, scaled between the test p5 and p95 and clipped to [0, 1];
    a flat score gives the train escalation rate."""
    score = (F.greatest(F.lit(1.0) - F.col(soh_col), F.lit(0.0))
             + F.lit(0.5) * F.greatest(F.col(station_col), F.lit(0.0)))
    scored = test.withColumn("_score", score)
    qs = _one_row_scalar(exact_quantile_columns(scored, "_score", {"p5": 0.05, "p95": 0.95}))
    rate = train.select(F.avg(F.col(label_col).cast("double"))).scalar()
    lo, hi = qs["p5"], qs["p95"]
    prob = F.when(hi <= lo, rate).otherwise(clip((F.col("_score") - lo) / (hi - lo), 0.0, 1.0))
    return scored.withColumn(out, prob).drop("_score")


def importance_table(spark, weights: list[tuple[str, float]]) -> DataFrame:
    return spark.createDataFrame([(f, float(w), i) for i, (f, w) in enumerate(weights)],
                                 "feature string, importance double, position int")


# Importances implied by the failure baseline: 1 x (1 - final_soh) + 0.5 x station rate.
BASELINE_IMPORTANCE = [("final_soh", 1.0), ("station_anomaly_rate", 0.5)] + [
    (f, 0.0) for f in config.FAILURE_FEATURES if f not in ("final_soh", "station_anomaly_rate")]


def top_risk_driver(cells: DataFrame, importance: list[tuple[str, float]] = BASELINE_IMPORTANCE,
                    out: str = "top_risk_driver") -> DataFrame:
    """Feature with the largest importance-weighted adverse z-score, as a label.

    z uses the fleet mean and population sigma + 1e-9 (one scalar subquery);
    ties go to the feature listed first in ``importance``.
    """
    meta = {f: (label, adverse) for f, label, adverse in config.DRIVER_META}
    feats = [(f, w) for f, w in importance if f in cells.columns]
    stats = cells.agg(*[F.avg(F.col(f).cast("double")).alias(f"m_{i}") for i, (f, _) in enumerate(feats)],
                      *[F.stddev_pop(F.col(f).cast("double")).alias(f"s_{i}") for i, (f, _) in enumerate(feats)])
    st = _one_row_scalar(stats)
    entries = []
    for i, (f, w) in enumerate(feats):
        label, adverse = meta.get(f, (f, True))
        z = (F.col(f).cast("double") - st[f"m_{i}"]) / (st[f"s_{i}"] + F.lit(1e-9))
        signed = z if adverse else -z
        contrib = F.greatest(signed, F.lit(0.0)) * F.lit(max(float(w), 0.0))
        entries.append(F.struct(contrib.alias("c"), F.lit(-i).alias("p"), F.lit(label).alias("label")))
    return cells.withColumn(out, F.array_max(F.array(*entries))["label"])


def baseline_predictions(cell_features: DataFrame, stats: DataFrame, early: DataFrame,
                         prediction_date: str = "2024-12-31") -> DataFrame:
    """fact_model_predictions from the heuristic scorers (one row per scored cell)."""
    latest = stats.select("cell_id", F.col("final_soh").alias("soh_current"), "capacity_fade_rate",
                          F.col("last_cycle").alias("cycle_count"))
    latest = rul_baseline(soh_baseline(latest, latest))
    fail = failure_baseline(cell_features, cell_features).select("cell_id", "failure_probability")
    ew = failure_baseline(early, early, soh_col="soh_at_cycle_50",
                          out="early_warning_probability").select("cell_id", "early_warning_probability")
    drivers = top_risk_driver(cell_features).select("cell_id", "top_risk_driver")
    p = (cell_features.select("cell_id").join(latest, "cell_id").join(fail, "cell_id")
         .join(ew, "cell_id", "left").join(drivers, "cell_id"))
    return p.select(
        "cell_id",
        F.to_date(F.lit(prediction_date)).alias("prediction_date"),
        round_half_even(clip(F.col("predicted_soh"), *config.SOH_CLIP), 4).alias("predicted_soh"),
        round_half_even(F.greatest(F.col("predicted_remaining_cycles"), F.lit(0.0)), 1).alias("predicted_remaining_cycles"),
        round_half_even(F.col("failure_probability"), 4).alias("failure_probability"),
        risk_tier(F.col("failure_probability")).alias("risk_tier"),
        round_half_even(F.col("early_warning_probability"), 4).alias("early_warning_probability"),
        risk_tier(F.col("early_warning_probability")).alias("early_warning_risk_tier"),
        "top_risk_driver",
    )
