"""Evaluation: splits, metrics, thresholds, calibration, drift.

Everything is an aggregation over a scored table; fleet-wide order
statistics use digit blocks (see :mod:`quantiles`) instead of a
single-partition window.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.scalar import psi_status
from .quantiles import _digits, exact_quantiles
from .series import ordered_positions


# ---- splits -----------------------------------------------------------------
def ordered_split(df: DataFrame, date_col: str, id_col: str, fraction: float, min_each_side: bool = True,
                  out: str = "is_train") -> DataFrame:
    """Sort by (date, id); the first int(fraction * n) rows (at least 1, and at most
    n - 1 when ``min_each_side``) are the train / reference side.  Positions come
    from per-date counts, so no global sort runs in one task."""
    n = df.select(F.count(F.lit(1))).scalar()
    cut = F.floor(n.cast("double") * F.lit(fraction))
    if min_each_side:
        cut = F.greatest(F.lit(1), F.least(n - 1, cut))
    else:
        cut = F.greatest(F.lit(1), cut)
        cut = F.when(cut >= n, F.greatest(F.lit(1), n - 1)).otherwise(cut)
    x = df.withColumn("_one", F.lit(0))
    x = ordered_positions(x, ["_one"], F.col(date_col), [F.col(date_col), F.col(id_col)], pos_col="_pos")
    return x.withColumn(out, F.col("_pos") <= cut).drop("_one")


def release_cutoff(split: DataFrame, date_col: str) -> DataFrame:
    """Cutoff date = date of the last train row."""
    return split.where(F.col("is_train")).agg(F.max_by(date_col, "_pos").alias("cutoff_date"))


# ---- metrics ----------------------------------------------------------------
def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    e = F.col(yhat) - F.col(y)
    sst = F.var_pop(y) * F.count(y)
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                  (F.lit(1.0) - F.sum(e * e) / F.nullif(sst, F.lit(0.0))).alias("r2"))


def below_sums(df: DataFrame, value: str, weight_cols: list[str]) -> DataFrame:
    """Per distinct ``value``: the sums of ``weight_cols`` over rows with a strictly
    smaller value (digit-block offsets + running sums inside a block)."""
    s, e, m = _digits(F.col(value), 12)
    g = df.withColumn("_bs", s).withColumn("_be", e).withColumn("_bm", m)
    blocks = g.groupBy("_bs", "_be", "_bm").agg(*[F.sum(c).alias(f"_b{c}") for c in weight_cols])
    before = Window.orderBy("_bs", "_be", "_bm").rowsBetween(Window.unboundedPreceding, -1)
    for c in weight_cols:
        blocks = blocks.withColumn(f"_o{c}", F.coalesce(F.sum(f"_b{c}").over(before), F.lit(0)))
    inside = Window.partitionBy("_bs", "_be", "_bm").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = g.join(blocks, ["_bs", "_be", "_bm"])
    for c in weight_cols:
        out = out.withColumn(f"below_{c}", F.col(f"_o{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.drop("_bs", "_be", "_bm", *[f"_b{c}" for c in weight_cols], *[f"_o{c}" for c in weight_cols])


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """Exact ROC-AUC with mid-rank ties: per distinct score, positives x (negatives
    strictly below + half the negatives at that score), over P x N."""
    g = df.groupBy(F.col(p).cast("double").alias("_p")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"), F.sum((1 - F.col(y)).cast("long")).alias("neg"))
    b = below_sums(g, "_p", ["neg"])
    return b.agg(
        (F.sum(F.col("pos") * (F.col("below_neg") + F.lit(0.5) * F.col("neg")))
         / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("roc_auc"))


def classification_metrics(df: DataFrame, y: str, p: str, cut: float = 0.5) -> DataFrame:
    pred = (F.col(p) >= cut).cast("int")
    yy = F.col(y).cast("int")
    c = df.agg(F.count(F.when((pred == 1) & (yy == 1), 1)).alias("tp"),
               F.count(F.when((pred == 1) & (yy == 0), 1)).alias("fp"),
               F.count(F.when((pred == 0) & (yy == 0), 1)).alias("tn"),
               F.count(F.when((pred == 0) & (yy == 1), 1)).alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    c = c.select("*", prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    auc = roc_auc(df, y, p).select("roc_auc").scalar()
    return c.select("precision", "recall", f1.alias("f1"), auc.alias("roc_auc"), "tp", "fp", "tn", "fn")


def threshold_values() -> list[tuple[int, float]]:
    """The 13 thresholds start + i * ((start + step) - start), as a float range yields them."""
    step = (config.THRESHOLD_START + config.THRESHOLD_STEP) - config.THRESHOLD_START
    return [(i, config.THRESHOLD_START + i * step) for i in range(config.THRESHOLD_COUNT)]


def thresholds(spark) -> DataFrame:
    return spark.createDataFrame(threshold_values(), "i int, threshold double")


def threshold_table(df: DataFrame, y: str, p: str, fn_cost: float = config.FN_COST,
                    fp_cost: float = config.FP_COST) -> DataFrame:
    """TP/FP/TN/FN, precision, recall, review load and cost per threshold.  Each score
    falls into the step of the thresholds it reaches; at most 14 steps a label remain, which
    the 13-row threshold table (a size-proven broadcast) cumulates."""
    t = thresholds(df.sparkSession)
    reached = sum((F.col("_p") >= F.lit(v)).cast("int") for _, v in threshold_values())
    g = (df.select(F.col(p).cast("double").alias("_p"), F.col(y).cast("int").alias("_y")).where("_p is not null")
         .groupBy(reached.alias("_step"), "_y").agg(F.count(F.lit(1)).alias("_n")))
    j = F.broadcast(t).join(g, how="left")  # 13 thresholds beside the steps
    hit = F.col("_step") > F.col("i")
    agg = j.groupBy("i", "threshold").agg(
        F.sum(F.when(hit & (F.col("_y") == 1), F.col("_n")).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when(hit & (F.col("_y") == 0), F.col("_n")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~hit & (F.col("_y") == 0), F.col("_n")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(~hit & (F.col("_y") == 1), F.col("_n")).otherwise(0)).cast("long").alias("fn"))
    return agg.select(
        (F.round(F.col("threshold") * 100) / 100).alias("threshold"), "tp", "fp", "tn", "fn",
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))).alias("precision"),
        (F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))).alias("recall"),
        (F.col("tp") + F.col("fp")).alias("review_load"),
        (F.lit(fp_cost) * F.col("fp") + F.lit(fn_cost) * F.col("fn")).alias("cost"))


def release_gate(earlier: DataFrame, later: DataFrame, y: str, p: str, baseline: str) -> DataFrame:
    """One row: does the score ``p`` beat ``baseline`` on the later cells (F1 at 0.5), does its recall fall by at
    most ``MAX_RECALL_DROP`` from the earlier to the later cells, does its cheapest threshold send at most
    ``MAX_REVIEW_SHARE`` of the later cells to review.  The release passes only if all three hold."""
    own = classification_metrics(later, y, p).select("f1", F.col("recall").alias("later_recall"))
    simple = classification_metrics(later, y, baseline).select("f1").scalar()
    before = classification_metrics(earlier, y, p).select("recall").scalar()
    cheapest = threshold_table(later, y, p).select(
        F.min_by("review_load", F.struct("cost", "threshold"))).scalar()
    cells = later.select(F.count(F.lit(1))).scalar()
    x = own.select((F.col("f1") > simple).alias("beats_baseline"),
                   (F.col("later_recall") >= before - F.lit(config.MAX_RECALL_DROP)).alias("recall_holds"),
                   (cheapest <= F.lit(config.MAX_REVIEW_SHARE) * cells).alias("load_interpretable"),
                   F.col("f1").alias("score_f1"), simple.alias("baseline_f1"), before.alias("earlier_recall"), "later_recall",
                   cheapest.alias("review_load"))
    return x.withColumn("release", F.col("beats_baseline") & F.col("recall_holds") & F.col("load_interpretable"))


# --- fixed values: calibration bin labels (five equal-width bins, first includes 0) ---
CALIBRATION_LABELS = ("(-0.001, 0.2]", "(0.2, 0.4]", "(0.4, 0.6]", "(0.6, 0.8]", "(0.8, 1.0]")


def calibration_table(df: DataFrame, y: str, p: str) -> DataFrame:
    """Five right-closed bins (the first also holds 0); empty bins are kept with zeros."""
    k = config.CALIBRATION_BINS
    bins = df.sparkSession.createDataFrame(
        [(i, CALIBRATION_LABELS[i], i * (1.0 / k) if i else 0.0, (i + 1) * (1.0 / k)) for i in range(k)],
        "i int, bin string, lo double, hi double")
    pc = F.col(p).cast("double")
    binned = df.select(pc.alias("_p"), F.col(y).cast("double").alias("_y"))
    idx = F.greatest(F.lit(0), F.least(F.lit(k - 1), F.ceil(F.col("_p") * k).cast("int") - 1))
    b = binned.withColumn("i", idx)
    # exact edge test against the bin bounds (guards float edges like 0.6000000000000001)
    b = b.join(F.broadcast(bins), "i").withColumn(
        "i", F.when((F.col("_p") > F.col("hi")) & (F.col("i") < k - 1), F.col("i") + 1)
        .when((F.col("_p") <= F.col("lo")) & (F.col("i") > 0), F.col("i") - 1).otherwise(F.col("i")))
    agg = b.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.avg("_p").alias("mp"), F.avg("_y").alias("ob"))
    return (F.broadcast(bins).join(agg, "i", "left")
            .select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                    F.coalesce("mp", F.lit(0.0)).alias("mean_predicted_probability"),
                    F.coalesce("ob", F.lit(0.0)).alias("observed_escalation_rate")))


# ---- drift ------------------------------------------------------------------
PSI_PROBS = [0.0] + [i * 0.1 for i in range(1, config.PSI_BINS)] + [1.0]


def psi_by_feature(long: DataFrame) -> DataFrame:
    """PSI per feature from a long table (feature, cohort in {reference, current}, value).

    Edges: distinct exact quantiles of the reference at 0, 0.1, ..., 1; fewer
    than 3 edges -> 0.  Bin = number of inner edges <= value (open outer
    bins).  Shares are floored at 1e-6."""
    v = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    ref = v.where(F.col("cohort") == "reference")
    q = exact_quantiles(ref, "value", PSI_PROBS, ["feature"])
    edges = q.groupBy("feature").agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("e"))
    # A feature's edge list has at most 11 values.
    edges = edges.select("feature", F.size("e").alias("n_edges"),
                         F.slice("e", 2, F.greatest(F.size("e") - 2, F.lit(0))).alias("inner"))
    x = v.join(edges, "feature")
    x = x.withColumn("bin", F.size(F.filter("inner", lambda e: e <= F.col("value"))))
    counts = x.groupBy("feature", "n_edges", "bin").agg(
        F.count(F.when(F.col("cohort") == "reference", 1)).alias("rc"),
        F.count(F.when(F.col("cohort") == "current", 1)).alias("cc"))
    totals = v.groupBy("feature").agg(F.count(F.when(F.col("cohort") == "reference", 1)).alias("rn"),
                                      F.count(F.when(F.col("cohort") == "current", 1)).alias("cn"))
    bins = edges.select("feature", "n_edges",
                        F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_edges") - 2, F.lit(0)))).alias("bin"))
    full = bins.join(counts, ["feature", "n_edges", "bin"], "left").join(totals, "feature")
    rp = F.greatest(F.try_divide(F.coalesce(F.col("rc"), F.lit(0)), F.col("rn")), F.lit(config.PSI_FLOOR))
    cp = F.greatest(F.try_divide(F.coalesce(F.col("cc"), F.lit(0)), F.col("cn")), F.lit(config.PSI_FLOOR))
    # Without rows on one side the index is unknown, not the floor.
    term = F.when((F.col("rn") > 0) & (F.col("cn") > 0), (cp - rp) * F.log(cp / rp))
    psi = full.groupBy("feature", "n_edges").agg(F.sum(term).alias("_psi"))
    return psi.select("feature", F.when((F.col("n_edges") < 3) & F.col("_psi").isNotNull(), F.lit(0.0)).otherwise(F.col("_psi")).alias("psi"))


def drift_table(frame: DataFrame, features: list[str]) -> DataFrame:
    """frame: (is_reference boolean, features...).  All features in one job via unpivot."""
    long = frame.select(F.when(F.col("is_train"), "reference").otherwise("current").alias("cohort"),
                        *[F.col(f).cast("double").alias(f) for f in features]
                        ).unpivot("cohort", features, "feature", "value")
    means = long.groupBy("feature").agg(
        F.avg(F.when(F.col("cohort") == "reference", F.col("value"))).alias("reference_mean"),
        F.avg(F.when(F.col("cohort") == "current", F.col("value"))).alias("current_mean"))
    out = means.join(psi_by_feature(long), "feature", "left")
    return out.select("feature", "reference_mean", "current_mean",
                      (F.col("current_mean") - F.col("reference_mean")).alias("delta"), "psi",
                      psi_status(F.col("psi")).alias("status"))


def nan_to_null(x):
    return F.when(~F.isnan(x), x)


__all__ = ["ordered_split", "regression_metrics", "classification_metrics", "roc_auc", "threshold_table",
           "calibration_table", "psi_by_feature", "drift_table", "math"]
