"""Spark ML training and scoring (fitted models: row / invariant checks only)."""
from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline as MLPipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from .. import config
from ..functions.scalar import risk_tier
from ..operators import evaluate as ev
from ..operators import publish, scoring, survival
from ..operators.reports import top_k
from ..session import cut_lineage, together
from .q_evaluate import REG_SQL, SPLIT_SQL, _CLS_SQL, _metrics_sql, _reg_rows, _scored_holdout, _split
from .registry import register


def _grouped_split(df, key: str = "cell_id", fraction: float = config.TEST_FRACTION):
    """Cells go wholly to one side: a cell is held out when its seeded hash falls
    in the lowest ``fraction`` of the hash range (no sort, no collect)."""
    h = F.pmod(F.xxhash64(F.col(key), F.lit(config.SEED)), F.lit(10000))
    return df.withColumn("is_test", h < int(fraction * 10000))


def _assembler(features):
    return VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep")


def _weighted(df, label: str):
    """Balanced class weights n / (2 n_class), from one aggregation."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.select(F.count(F.lit(1))).scalar()
    return df.join(counts, label).withColumn("w", n / (2.0 * F.col("_nc")))


def fit_failure_classifier(train, features=config.FAILURE_FEATURES, label="escalation_required",
                           trees: int = config.FAILURE_FOREST_TREES, depth: int = config.FOREST_DEPTH):
    """Logistic regression vs random forest (balanced weights): the best F1 at 0.5 on a validation
    fold of whole cells wins and is fitted again on all of ``train``."""
    t = _grouped_split(train.withColumn("label", F.col(label).cast("double")))
    fold, valid = (t.where(F.col("is_test") == side) for side in (False, True))

    def stages(last) -> list:
        return [_assembler(features), StandardScaler(inputCol="features_raw", outputCol="features", withMean=True), last]

    def candidates(n: int) -> dict:
        # C = 1 of a summed loss is 1 / n of Spark's averaged one.
        return {
            "LogisticRegression": LogisticRegression(weightCol="w", regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                                                     maxIter=config.LOGISTIC_ROUNDS),
            "RandomForest": RandomForestClassifier(weightCol="w", numTrees=trees, maxDepth=depth, seed=config.SEED,
                                                   minInstancesPerNode=config.FAILURE_FOREST_LEAF),
        }

    def checked(name, last):
        model = MLPipeline(stages=stages(last)).fit(_weighted(fold, "label"))
        scored = model.transform(valid).withColumn("p", vector_to_array("probability")[1])
        return name, ev.classification_metrics(scored, "label", "p").select("f1").first()[0] or 0.0  # one metrics row

    tried = together(t.sparkSession, [partial(checked, *c) for c in candidates(fold.count()).items()])
    best = max(tried, key=lambda nf: nf[1])  # of equal ones the first
    last = candidates(t.count())[best[0]]
    return best[0], MLPipeline(stages=stages(last)).fit(_weighted(t.drop("is_test"), "label")), best[1]


@register("train_failure")
def train_failure(p):
    """Holdout metrics of the selected failure classifier on the release split."""
    s = _split(p).select("cell_id", "is_train")
    cf = p.cell_features.join(s, "cell_id")
    name, model, _ = fit_failure_classifier(cf.where("is_train"))
    test = model.transform(cf.where("not is_train").withColumn("label", F.col("escalation_required").cast("double")))
    test = test.withColumn("p", vector_to_array("probability")[1])
    return ev.classification_metrics(test, "label", "p").select(F.lit(name).alias("model"), "*")


def _regressors(target: str, rounds: int, trees: int, depth: int, step: float) -> dict[str, list]:
    """The candidate regressors of ``target``, each as the stages after the assembler."""
    return {
        "LinearRegression": [StandardScaler(inputCol="features_raw", outputCol="features"), LinearRegression(labelCol=target)],
        "GradientBoosting": [GBTRegressor(featuresCol="features_raw", labelCol=target, maxIter=rounds, seed=config.SEED,
                                          maxDepth=config.SOH_BOOST_DEPTH, stepSize=step)],
        "RandomForest": [RandomForestRegressor(featuresCol="features_raw", labelCol=target, numTrees=trees, maxDepth=depth,
                                               minInstancesPerNode=config.SOH_FOREST_LEAF, featureSubsetStrategy="all",
                                               seed=config.SEED)],
    }


def best_regressor(train, features, target: str, rounds: int = config.SOH_BOOST_ROUNDS, trees: int = config.SOH_FOREST_TREES,
                   depth: int = config.FOREST_DEPTH, step: float = config.SOH_BOOST_STEP):
    """Name and model of the regressor of least error on a validation fold of whole cells, fitted again on all of ``train``.

    ``train`` should be a stored table: every fit reads it.  Rows without the target take no part."""
    t = _grouped_split(train.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("double")))
    fold, valid = (t.where(F.col("is_test") == side) for side in (False, True))
    cands = _regressors(target, rounds, trees, depth, step)

    def checked(name, last):
        scored = MLPipeline(stages=[_assembler(features), *last]).fit(fold).transform(valid)
        rmse = ev.regression_metrics(scored, target, "prediction").first()["rmse"]  # one metrics row
        return (float("inf") if rmse is None else rmse, name)

    name = min(together(t.sparkSession, [partial(checked, *c) for c in cands.items()]))[1]
    return name, MLPipeline(stages=[_assembler(features), *cands[name]]).fit(t)


def fit_regressors(table, features, target: str, rounds: int = config.SOH_BOOST_ROUNDS, trees: int = config.SOH_FOREST_TREES,
                   depth: int = config.FOREST_DEPTH, step: float = config.SOH_BOOST_STEP):
    """Holdout metrics of linear, boosted and forest regressors of ``target``, with each one's error on a validation fold.

    Cells go wholly to the holdout, the validation fold or the training rows; the table is stored once, the fits read it
    from there.  Rows without the target take no part."""
    stored = publish.store(table.where(F.col(target).isNotNull()).select(
        "cell_id", F.col(target).cast("double").alias(target), *[c for c in features if c != target]), "training")
    place = F.pmod(F.xxhash64(F.col("cell_id"), F.lit(config.SEED)), F.lit(10000)) / 10000
    test, valid = config.TEST_FRACTION, config.TEST_FRACTION + (1 - config.TEST_FRACTION) * config.TEST_FRACTION
    folds = {"test": stored.where(place < test), "valid": stored.where((place >= test) & (place < valid)),
             "train": stored.where(place >= valid)}
    cands = _regressors(target, rounds, trees, depth, step)
    models = together(stored.sparkSession, [partial(MLPipeline(stages=[_assembler(features), *last]).fit, folds["train"])
                                            for last in cands.values()])
    rows = None
    for name, m in zip(cands, models):
        met = ev.regression_metrics(m.transform(folds["test"]), target, "prediction").select(F.lit(name).alias("model"), "*")
        checked = ev.regression_metrics(m.transform(folds["valid"]), target, "prediction").select(F.col("rmse").alias("valid_rmse"))
        met = met.crossJoin(checked)  # one row beside one row
        rows = met if rows is None else rows.unionByName(met)
    return rows


def fit_soh(cycle_features, rounds: int = config.SOH_BOOST_ROUNDS, trees: int = config.SOH_FOREST_TREES,
            depth: int = config.FOREST_DEPTH, *, step: float = config.SOH_BOOST_STEP):
    return fit_regressors(cycle_features, config.SOH_FEATURES, "soh_current", rounds, trees, depth, step)


def lowest_rmse(rows):
    """The row of lowest error on the validation fold (an undefined one last, ties by name)."""
    return rows.orderBy(F.asc_nulls_last(F.nanvl("valid_rmse", F.lit(None))), "model").limit(1)


@register("train_soh")
def train_soh(p):
    """Linear / boosted / forest SOH regressors on cycle features (grouped by cell): the one of least validation error, on the holdout."""
    return lowest_rmse(fit_soh(p.cycle_features, **config.QUERY_SIZES))


@register("train_rul")
def train_rul(p):
    """Remaining-cycle regressors on cycle features, chosen and measured like :func:`train_soh`."""
    return lowest_rmse(fit_regressors(p.cycle_features, config.RUL_FEATURES, "remaining_cycles", **config.QUERY_SIZES))


@register("train_early_warning")
def train_early_warning(p):
    """Holdout metrics of the early-warning classifier; cells without a whole early window take no part."""
    s = _split(p).select("cell_id", "is_train")
    full = p.early_warning_features.join(s, "cell_id").dropna(subset=list(config.EARLY_WARNING_FEATURES))
    name, model, _ = fit_failure_classifier(full.where("is_train"), config.EARLY_WARNING_FEATURES)
    test = model.transform(full.where("not is_train").withColumn("label", F.col("escalation_required").cast("double")))
    return ev.classification_metrics(test.withColumn("p", vector_to_array("probability")[1]), "label", "p").select(
        F.lit(name).alias("model"), "*")


@register("score_cells_model")
def score_cells_model(p):
    """Failure probability and tier from the fitted classifier for every cell."""
    s = _split(p).select("cell_id", "is_train")
    cf = p.cell_features.join(s, "cell_id")
    _, model, _ = fit_failure_classifier(cf.where("is_train"))
    out = model.transform(cf).withColumn("failure_probability", vector_to_array("probability")[1])
    return out.select("cell_id", F.bround("failure_probability", 4).alias("failure_probability"),
                      risk_tier(F.col("failure_probability")).alias("risk_tier"))


def fit_hazard(train):
    """Balanced logistic hazard of an interval, on the person-period rows of the train cells."""
    x = _weighted(survival.expand_intervals(train), "hazard_event")
    numeric = [*config.SURVIVAL_NUMERIC, "log_interval_end"]
    return MLPipeline(stages=[
        _assembler(numeric),
        StandardScaler(inputCol="features_raw", outputCol="scaled", withMean=True),
        StringIndexer(inputCol="usage_profile", outputCol="profile_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="profile_index", outputCol="profile"),  # the unknown profile is all zeros
        VectorAssembler(inputCols=["scaled", "profile"], outputCol="features"),
        LogisticRegression(labelCol="hazard_event", weightCol="w", regParam=1.0 / max(x.count(), 1),
                           standardization=False, maxIter=config.LOGISTIC_ROUNDS),
    ]).fit(x)


def survival_predictions(model, cells, longest: int):
    """Survival quantities of each cell from the hazards of all intervals up to the longest duration."""
    width = config.HAZARD_INTERVAL
    horizon = -(-longest // width) * width
    rows = (cells.withColumn("interval_end", F.explode(F.sequence(F.lit(width), F.lit(horizon), F.lit(width))))
            .withColumn("log_interval_end", F.log1p(F.col("interval_end").cast("double"))))
    hazards = model.transform(rows).select("cell_id", "interval_end",
                                           vector_to_array("probability")[1].alias("hazard"))
    return survival.survival_distribution(hazards, horizon)


@register("survival_top_10_model")
def survival_top_10_model(p):
    """Ten holdout cells of highest event probability by 500 cycles under the fitted hazard model."""
    cells = (p.cell_features.join(survival.survival_frame(p.stats), "cell_id")
             .join(_split(p).select("cell_id", "is_train"), "cell_id"))
    longest = cells.agg(F.max("duration_cycles")).first()[0] or config.HAZARD_INTERVAL
    scored = survival_predictions(fit_hazard(cells.where("is_train")), cells.where("not is_train"), longest)
    return top_k(scored.select("cell_id", F.col("event_probability_by_500_cycles").alias("event_risk")),
                 [F.desc("event_risk"), F.asc("cell_id")], 10)


# ---- the four models of a release: fitted on its earlier cells, measured on the later ones, applied to all ----------
def _release_models(p, targets) -> dict:
    """Name and model of each of ``targets``, fitted once per pipeline on the earlier cells of the release split, at
    ``config.QUERY_SIZES``.  The regressors follow one another, as their cached rows fill the executors; the classifiers,
    which read a row a cell, are fitted beside them."""
    fitted = p.__dict__.setdefault("_fitted", {})
    wanted = [t for t in targets if t not in fitted]
    if not wanted:
        return fitted
    earlier = _split(p).where("is_train").select("cell_id")
    cycles, size = p.release_cycles.where("is_train"), {k: config.QUERY_SIZES[k] for k in ("trees", "depth")}
    chains: list[dict] = [{}, {}]
    for target, features, y in (("SOH", config.SOH_FEATURES, "soh_current"), ("RUL", config.RUL_FEATURES, "remaining_cycles")):
        if target in wanted:
            chains[0][target] = partial(best_regressor, cycles, features, y, **config.QUERY_SIZES)
    if "Failure risk" in wanted:
        cells = cut_lineage(p.cell_features.join(earlier, "cell_id"))
        chains[1]["Failure risk"] = partial(fit_failure_classifier, cells, **size)
    if "Early warning" in wanted:
        early = cut_lineage(p.early_warning_features.join(earlier, "cell_id").dropna(subset=list(config.EARLY_WARNING_FEATURES)))
        chains[1]["Early warning"] = partial(fit_failure_classifier, early, config.EARLY_WARNING_FEATURES, **size)
    for done in together(p.spark, [partial(lambda chain: {t: fit()[:2] for t, fit in chain.items()}, c) for c in chains]):
        fitted.update(done)
    return fitted


def long_metrics(metrics, target: str, approach: str):
    """One row of metrics as rows target, approach, metric, value; counts of the confusion matrix left out."""
    names = [c for c in metrics.columns if c not in ("tp", "fp", "tn", "fn")]
    return metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names]))
                          .alias("m")).select(F.lit(target).alias("target"), F.lit(approach).alias("approach"), "m.*")


@register("backtest_baseline_rows", "SELECT * FROM (WITH " + SPLIT_SQL.strip() + "," + REG_SQL.strip() + "\n" + " UNION ALL ".join(
    f"SELECT '{target}' AS target, '{name}' AS approach, unnest({[*cols]}) AS metric, unnest([{', '.join(cols)}]) AS value FROM ({sql})"
    for target, name, cols, sql in (
        ("SOH", "fleet_median_fade_baseline", ("mae", "rmse", "r2"), _metrics_sql("soh_current", "soh_hat")),
        ("RUL", "current_fade_to_eol_baseline", ("mae", "rmse", "r2"), _metrics_sql("remaining_cycles", "rul_hat")),
        ("Failure risk", "soh_station_rule_baseline", ("precision", "recall", "f1", "roc_auc"), _CLS_SQL))) + ")")
def backtest_baseline_rows(p):
    """The three baselines on the later cells, one row a metric."""
    reg = _reg_rows(p)
    return (long_metrics(ev.regression_metrics(reg, "soh_current", "soh_hat"), "SOH", "fleet_median_fade_baseline")
            .unionByName(long_metrics(ev.regression_metrics(reg, "remaining_cycles", "rul_hat"), "RUL", "current_fade_to_eol_baseline"))
            .unionByName(long_metrics(ev.classification_metrics(_scored_holdout(p), "y", "p"), "Failure risk", "soh_station_rule_baseline")))


@register("backtest_metrics")
def backtest_metrics(p):
    """Models fitted on the earlier cells beside the baselines, measured on the later cells: target, approach, metric, value."""
    models = _release_models(p, ("SOH", "RUL", "Failure risk"))
    later = _split(p).where("not is_train").select("cell_id")
    out = backtest_baseline_rows(p)
    cycles = p.release_cycles.where("not is_train")
    for target, y in (("SOH", "soh_current"), ("RUL", "remaining_cycles")):
        name, model = models[target]
        rows = model.transform(cycles.where(F.col(y).isNotNull()))
        out = out.unionByName(long_metrics(ev.regression_metrics(rows, y, "prediction"), target, name))
    name, model = models["Failure risk"]
    rows = model.transform(p.cell_features.join(later, "cell_id")).select(
        F.col("escalation_required").alias("y"), vector_to_array("probability")[1].alias("p"))
    return out.unionByName(long_metrics(ev.classification_metrics(rows, "y", "p"), "Failure risk", name))


def _importance(model, features) -> list[tuple[str, float]]:
    """Features by falling importance: a forest's own, else the share of a standardised coefficient's size."""
    last = model.stages[-1]
    sizes = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    total = sizes.sum() or 1.0
    return sorted(((f, float(v / total)) for f, v in zip(features, sizes)), key=lambda fv: (-fv[1], fv[0]))


@register("score_cells_four_models")
def score_cells_four_models(p):
    """One row per cell scored by all four fitted models: health and remaining cycles at its latest cycle, failure and
    early-warning probability with tiers, driver by the failure model's importances.  A cell without a whole early
    window has no early-warning score."""
    models = _release_models(p, ("SOH", "RUL", "Failure risk", "Early warning"))
    wanted = sorted({*config.SOH_FEATURES, *config.RUL_FEATURES})
    latest = p.release_cycles.groupBy("cell_id").agg(F.max_by(F.struct(*wanted), "cycle_index").alias("s")).select("cell_id", "s.*")
    soh = models["SOH"][1].transform(latest).select("cell_id", F.col("prediction").alias("soh"))
    rul = models["RUL"][1].transform(latest).select("cell_id", F.col("prediction").alias("rul"))
    fail = models["Failure risk"][1].transform(p.cell_features).select("cell_id", vector_to_array("probability")[1].alias("fp"))
    whole = p.early_warning_features.dropna(subset=list(config.EARLY_WARNING_FEATURES))
    early = models["Early warning"][1].transform(whole).select("cell_id", vector_to_array("probability")[1].alias("ep"))
    drivers = scoring.top_risk_driver(p.cell_features, _importance(models["Failure risk"][1], config.FAILURE_FEATURES))
    all_scores = (fail.join(soh, "cell_id").join(rul, "cell_id").join(drivers.select("cell_id", "top_risk_driver"), "cell_id")
                  .join(early, "cell_id", "left"))
    return all_scores.select(
        "cell_id", F.bround(F.greatest(F.least(F.col("soh"), F.lit(config.SOH_CLIP[1])), F.lit(config.SOH_CLIP[0])), 4).alias("predicted_soh"),
        F.bround(F.greatest(F.col("rul"), F.lit(0.0)), 1).alias("predicted_remaining_cycles"),
        F.bround("fp", 4).alias("failure_probability"), risk_tier(F.col("fp")).alias("risk_tier"),
        F.bround("ep", 4).alias("early_warning_probability"),
        F.when(F.col("ep").isNotNull(), risk_tier(F.col("ep"))).alias("early_warning_risk_tier"), "top_risk_driver")
