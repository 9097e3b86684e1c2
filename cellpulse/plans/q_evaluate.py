"""Release backtest, metrics, drift and survival queries.

The holdout is the release split (cells ordered by manufacturing date, first
70% train).  The scores are the deterministic baselines, so every metric has
an exact oracle; fitted models plug into the same metric operators.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import evaluate as ev
from ..operators import scoring, survival
from ..operators.reports import top_k
from ..session import cut_lineage
from .registry import register

# ---- shared oracle CTE text ---------------------------------------------------
SPLIT_SQL = """
ordered AS (SELECT cell_id, manufacturing_date, row_number() OVER (ORDER BY manufacturing_date, cell_id) AS pos,
            count(*) OVER () AS n FROM factory),
split AS (SELECT cell_id, manufacturing_date, pos, pos <= greatest(1, least(n - 1, floor(n * 0.7::DOUBLE))) AS is_train FROM ordered),
train_cf AS (SELECT c.* FROM cell_features c JOIN split s USING (cell_id) WHERE s.is_train),
test_cf AS (SELECT c.* FROM cell_features c JOIN split s USING (cell_id) WHERE NOT s.is_train),
tsc AS (SELECT cell_id, escalation_required AS y,
        greatest(1.0::DOUBLE - final_soh, 0.0::DOUBLE) + 0.5::DOUBLE * greatest(station_anomaly_rate, 0.0::DOUBLE) AS sc FROM test_cf),
tq AS (SELECT quantile_cont(sc, 0.05) AS lo, quantile_cont(sc, 0.95) AS hi FROM tsc),
scored AS (SELECT cell_id, y, CASE WHEN hi <= lo THEN (SELECT avg(CAST(escalation_required AS DOUBLE)) FROM train_cf)
           ELSE least(greatest((sc - lo) / (hi - lo), 0.0::DOUBLE), 1.0::DOUBLE) END AS p FROM tsc, tq)
"""


def _with_split(select: str) -> str:
    return "SELECT * FROM (WITH " + SPLIT_SQL.strip() + "\n" + select + ")"


def _split(p):
    return ev.ordered_split(p.factory.select("cell_id", "manufacturing_date"), "manufacturing_date", "cell_id",
                            config.RELEASE_TRAIN_FRACTION)


def _scored_holdout(p):
    s = _split(p).select("cell_id", "is_train")
    cf = p.cell_features.join(s, "cell_id")
    train, test = cf.where("is_train"), cf.where("not is_train")
    return scoring.failure_baseline(train, test).select(
        "cell_id", F.col("escalation_required").alias("y"), F.col("failure_probability").alias("p"))


@register("release_split", _with_split("SELECT cell_id, is_train FROM split"))
def release_split(p):
    return _split(p).select("cell_id", "is_train")


@register("release_cutoff", _with_split(
    "SELECT max(manufacturing_date) FILTER (WHERE is_train) AS cutoff_date, count(*) FILTER (WHERE is_train) AS train_cells, "
    "count(*) FILTER (WHERE NOT is_train) AS holdout_cells FROM split"))
def release_cutoff(p):
    s = _split(p)
    return s.agg(F.max_by(F.when(F.col("is_train"), F.col("manufacturing_date")),
                          F.when(F.col("is_train"), F.col("_pos"))).alias("cutoff_date"),
                 F.count(F.when(F.col("is_train"), 1)).alias("train_cells"),
                 F.count(F.when(~F.col("is_train"), 1)).alias("holdout_cells"))


@register("failure_baseline", _with_split("SELECT cell_id, p AS failure_probability FROM scored"))
def failure_baseline(p):
    return _scored_holdout(p).select("cell_id", F.col("p").alias("failure_probability"))


_CLS_SQL = """
SELECT
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN tp > 0 THEN 2.0 * tp / (2.0 * tp + fp + fn) ELSE 0.0 END AS f1,
  (SELECT sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0) FROM (
     SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
     FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p))) AS roc_auc,
  tp, fp, tn, fn
FROM (SELECT count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.5 AND y = 0) AS fp,
             count(*) FILTER (WHERE p < 0.5 AND y = 0) AS tn, count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn FROM scored)"""


@register("classification_metrics", _with_split(_CLS_SQL))
def classification_metrics(p):
    return ev.classification_metrics(_scored_holdout(p), "y", "p")


@register("roc_auc", _with_split("""
SELECT sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p))"""))
def roc_auc(p):
    return ev.roc_auc(_scored_holdout(p), "y", "p")


_THR = " UNION ALL ".join(
    f"SELECT {i} AS i, {repr(config.THRESHOLD_START + i * ((config.THRESHOLD_START + config.THRESHOLD_STEP) - config.THRESHOLD_START))}::DOUBLE AS t"
    for i in range(config.THRESHOLD_COUNT))


@register("threshold_table", _with_split(f"""
SELECT round(t * 100) / 100 AS threshold, tp, fp, tn, fn, tp / greatest(tp + fp, 1) AS precision,
  tp / greatest(tp + fn, 1) AS recall, tp + fp AS review_load, 1.0 * fp + 5.0 * fn AS cost
FROM (SELECT th.t, count(*) FILTER (WHERE s.p >= th.t AND s.y = 1) AS tp, count(*) FILTER (WHERE s.p >= th.t AND s.y = 0) AS fp,
        count(*) FILTER (WHERE s.p < th.t AND s.y = 0) AS tn, count(*) FILTER (WHERE s.p < th.t AND s.y = 1) AS fn
      FROM ({_THR}) th, scored s GROUP BY th.t)"""))
def threshold_table(p):
    return ev.threshold_table(_scored_holdout(p), "y", "p")


@register("best_threshold", _with_split(f"""
SELECT round(t * 100) / 100 AS threshold, 1.0 * fp + 5.0 * fn AS cost
FROM (SELECT th.t, count(*) FILTER (WHERE s.p >= th.t AND s.y = 0) AS fp, count(*) FILTER (WHERE s.p < th.t AND s.y = 1) AS fn
      FROM ({_THR}) th, scored s GROUP BY th.t) ORDER BY cost, t LIMIT 1"""))
def best_threshold(p):
    t = ev.threshold_table(_scored_holdout(p), "y", "p")
    return top_k(t, [F.asc("cost"), F.asc("threshold")], 1).select("threshold", "cost")


@register("calibration_table", _with_split("""
SELECT b.bin, count(s.p) AS n, coalesce(avg(s.p), 0.0) AS mean_predicted_probability,
  coalesce(avg(CAST(s.y AS DOUBLE)), 0.0) AS observed_escalation_rate
FROM (VALUES (0, '(-0.001, 0.2]', 0.0::DOUBLE, 0.2::DOUBLE), (1, '(0.2, 0.4]', 0.2::DOUBLE, 0.4::DOUBLE),
  (2, '(0.4, 0.6]', 0.4::DOUBLE, 0.6000000000000001::DOUBLE), (3, '(0.6, 0.8]', 0.6000000000000001::DOUBLE, 0.8::DOUBLE),
  (4, '(0.8, 1.0]', 0.8::DOUBLE, 1.0::DOUBLE)) AS b(i, bin, lo, hi) LEFT JOIN scored s ON (s.p > b.lo OR (b.i = 0 AND s.p >= 0)) AND s.p <= b.hi GROUP BY b.bin"""))
def calibration_table(p):
    return ev.calibration_table(_scored_holdout(p), "y", "p")


# ---- regression baselines on the holdout cycle rows --------------------------
REG_SQL = """
train_rows AS (SELECT cf.* FROM cycle_features cf JOIN split s USING (cell_id) WHERE s.is_train),
test_rows AS (SELECT cf.* FROM cycle_features cf JOIN split s USING (cell_id) WHERE NOT s.is_train),
fleet_fade AS (SELECT coalesce(quantile_cont(f, 0.5), 0.0004::DOUBLE) AS m FROM (
  SELECT greatest(capacity_fade_rate, 0.0::DOUBLE) AS f FROM train_rows) WHERE f > 0),
rcap AS (SELECT greatest(quantile_cont(cycle_count, 0.95) * 2.0::DOUBLE, 500.0::DOUBLE) AS cap FROM test_rows),
reg AS (SELECT t.soh_current, t.remaining_cycles,
  least(greatest(1.0::DOUBLE - m * t.cycle_count, 0.0::DOUBLE), 1.05::DOUBLE) AS soh_hat,
  least(greatest((t.soh_current - 0.8::DOUBLE) / greatest(t.capacity_fade_rate, 1e-6::DOUBLE), 0.0::DOUBLE), cap) AS rul_hat
  FROM test_rows t, fleet_fade, rcap)
"""


def _reg_rows(p):
    train, test = p.release_health.where("is_train"), p.release_health.where("not is_train")
    out = scoring.soh_baseline(train, test, out="soh_hat", stored=True)
    return scoring.rul_baseline(out, out="rul_hat", stored=True)


def _metrics_sql(y: str, yhat: str) -> str:
    return (f"SELECT avg(abs({yhat} - {y})) AS mae, sqrt(avg(({yhat} - {y}) * ({yhat} - {y}))) AS rmse, "
            f"1.0 - sum(({yhat} - {y}) * ({yhat} - {y})) / nullif(sum(({y} - (SELECT avg({y}) FROM reg)) * "
            f"({y} - (SELECT avg({y}) FROM reg))), 0) AS r2 FROM reg")


@register("soh_baseline_metrics", "SELECT * FROM (WITH " + SPLIT_SQL.strip() + "," + REG_SQL.strip() + "\n"
          + _metrics_sql("soh_current", "soh_hat") + ")")
def soh_baseline_metrics(p):
    return ev.regression_metrics(_reg_rows(p), "soh_current", "soh_hat")


@register("rul_baseline_metrics", "SELECT * FROM (WITH " + SPLIT_SQL.strip() + "," + REG_SQL.strip() + "\n"
          + _metrics_sql("remaining_cycles", "rul_hat") + ")")
def rul_baseline_metrics(p):
    return ev.regression_metrics(_reg_rows(p), "remaining_cycles", "rul_hat")


# ---- drift --------------------------------------------------------------------
def _monitor_frame(p):
    f = (p.cell_features.join(p.factory.select("cell_id", "manufacturing_date"), "cell_id", "left")
         .join(p.predictions.select("cell_id", "failure_probability", "risk_tier", "top_risk_driver"), "cell_id", "left"))
    return ev.ordered_split(f, "manufacturing_date", "cell_id", config.RELEASE_TRAIN_FRACTION, min_each_side=False)


_PSI_P = "[" + ", ".join(repr(x) + "::DOUBLE" for x in ev.PSI_PROBS) + "]"
MON_SQL = """
mon AS (SELECT c.*, f.manufacturing_date, p.failure_probability, p.risk_tier, p.top_risk_driver
        FROM cell_features c LEFT JOIN factory f USING (cell_id) LEFT JOIN predictions p USING (cell_id)),
mo AS (SELECT *, row_number() OVER (ORDER BY manufacturing_date, cell_id) AS pos, count(*) OVER () AS n FROM mon),
mcut AS (SELECT *, CASE WHEN greatest(1, floor(n * 0.7::DOUBLE)) >= n THEN greatest(1, n - 1)
                    ELSE greatest(1, floor(n * 0.7::DOUBLE)) END AS cut FROM mo),
long AS (SELECT CASE WHEN pos <= cut THEN 'reference' ELSE 'current' END AS cohort, feature, value FROM (
  SELECT pos, cut, """ + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in config.DRIFT_FEATURES) + """ FROM mcut)
  UNPIVOT (value FOR feature IN (""" + ", ".join(config.DRIFT_FEATURES) + """))),
lv AS (SELECT * FROM long WHERE value IS NOT NULL AND NOT isnan(value)),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, """ + _PSI_P + """))) AS e
          FROM lv WHERE cohort = 'reference' GROUP BY feature),
ed AS (SELECT feature, len(e) AS n_edges, CASE WHEN len(e) > 2 THEN e[2:len(e) - 1] ELSE [] END AS inner_e FROM edges),
binned AS (SELECT l.feature, l.cohort, len(list_filter(d.inner_e, lambda x: x <= l.value)) AS bin FROM lv l JOIN ed d USING (feature)),
tot AS (SELECT feature, count(*) FILTER (WHERE cohort = 'reference') AS rn, count(*) FILTER (WHERE cohort = 'current') AS cn FROM lv GROUP BY feature),
allbins AS (SELECT feature, n_edges, unnest(range(0, greatest(n_edges - 1, 1))) AS bin FROM ed),
bc AS (SELECT a.feature, a.n_edges, a.bin,
          count(b.feature) FILTER (WHERE b.cohort = 'reference') AS rc, count(b.feature) FILTER (WHERE b.cohort = 'current') AS cc
       FROM allbins a LEFT JOIN binned b ON a.feature = b.feature AND a.bin = b.bin GROUP BY a.feature, a.n_edges, a.bin),
psi AS (SELECT bc.feature, CASE WHEN max(n_edges) < 3 THEN 0.0 ELSE sum(
          (greatest(cc / cn, 1e-6) - greatest(rc / rn, 1e-6)) * ln(greatest(cc / cn, 1e-6) / greatest(rc / rn, 1e-6))) END AS psi
        FROM bc JOIN tot USING (feature) GROUP BY bc.feature),
means AS (SELECT feature, avg(value) FILTER (WHERE cohort = 'reference') AS reference_mean,
                 avg(value) FILTER (WHERE cohort = 'current') AS current_mean FROM long GROUP BY feature),
drift AS (SELECT m.feature, m.reference_mean, m.current_mean, m.current_mean - m.reference_mean AS delta, p.psi,
  CASE WHEN p.psi IS NULL OR isnan(p.psi) THEN 'unknown' WHEN p.psi >= 0.25 THEN 'alert' WHEN p.psi >= 0.1 THEN 'watch' ELSE 'ok' END AS status
  FROM means m LEFT JOIN psi p USING (feature))
"""


def _with_mon(select: str) -> str:
    return "SELECT * FROM (WITH " + MON_SQL.strip() + "\n" + select + ")"


@register("drift_table", _with_mon("SELECT * FROM drift"))
def drift_table(p):
    return ev.drift_table(_monitor_frame(p), list(config.DRIFT_FEATURES))


@register("psi", _with_mon("SELECT feature, psi FROM drift"))
def psi(p):
    return ev.drift_table(_monitor_frame(p), list(config.DRIFT_FEATURES)).select("feature", "psi")


@register("psi_status", _with_mon("SELECT feature, status FROM drift"))
def psi_status_q(p):
    return ev.drift_table(_monitor_frame(p), list(config.DRIFT_FEATURES)).select("feature", "status")


@register("drift_worst_5", _with_mon(
    "SELECT feature, psi, status, (SELECT count(*) FROM drift WHERE status IN ('watch', 'alert')) AS flagged_features "
    "FROM drift ORDER BY psi DESC NULLS LAST, feature LIMIT 5"))
def drift_worst_5(p):
    d = ev.drift_table(_monitor_frame(p), list(config.DRIFT_FEATURES))
    flagged = d.select(F.count(F.when(F.col("status").isin("watch", "alert"), 1))).scalar()
    return top_k(d, [F.col("psi").desc_nulls_last(), F.asc("feature")], 5).select(
        "feature", "psi", "status", flagged.alias("flagged_features"))


@register("cohort_split", _with_mon("SELECT cell_id, pos <= cut AS is_reference FROM mcut"))
def cohort_split(p):
    return _monitor_frame(p).select("cell_id", F.col("is_train").alias("is_reference"))


@register("risk_mix", _with_mon("SELECT risk_tier, count(*) AS current_cells FROM mcut WHERE pos > cut GROUP BY risk_tier"))
def risk_mix(p):
    m = _monitor_frame(p)
    return m.where(~F.col("is_train")).groupBy("risk_tier").agg(F.count(F.lit(1)).alias("current_cells"))


@register("driver_mix_top8", _with_mon(
    "SELECT top_risk_driver, count(*) AS current_cells FROM mcut WHERE pos > cut GROUP BY top_risk_driver "
    "ORDER BY current_cells DESC, top_risk_driver LIMIT 8"))
def driver_mix_top8(p):
    m = _monitor_frame(p)
    g = m.where(~F.col("is_train")).groupBy("top_risk_driver").agg(F.count(F.lit(1)).alias("current_cells"))
    return top_k(g, [F.desc("current_cells"), F.asc("top_risk_driver")], 8)


# ---- survival -------------------------------------------------------------------
SURV_SQL = """
sframe AS (SELECT c.*, CAST(coalesce(s.eol_cycle, s.last_cycle) AS INTEGER) AS duration_cycles,
           CAST(s.eol_cycle IS NOT NULL AS INTEGER) AS event_observed
           FROM cell_features c JOIN stats s USING (cell_id)),
pp AS (SELECT f.cell_id, f.usage_profile, f.duration_cycles, f.event_observed, e AS interval_end
       FROM sframe f, unnest(range(50, greatest(50, CAST(ceil(duration_cycles / 50.0) * 50 AS INTEGER)) + 1, 50)) AS t(e)
       WHERE f.event_observed = 1 OR e <= f.duration_cycles),
ppx AS (SELECT *, ln(1 + interval_end) AS log_interval_end,
        CAST(event_observed = 1 AND duration_cycles <= interval_end AS INTEGER) AS hazard_event FROM pp
        WHERE event_observed = 0 OR interval_end < duration_cycles + 50)
"""


@register("expand_intervals", "SELECT * FROM (WITH " + SURV_SQL.strip() + "\n"
          "SELECT cell_id, interval_end, log_interval_end, hazard_event FROM ppx)")
def expand_intervals(p):
    frame = survival.survival_frame(p.stats)
    return survival.expand_intervals(frame).select("cell_id", "interval_end", "log_interval_end", "hazard_event")


@register("concordance_index", _with_split("""
SELECT count(*) AS permissible_pairs,
  (count(*) FILTER (WHERE a.p > b.p) + 0.5 * count(*) FILTER (WHERE a.p = b.p)) / nullif(count(*), 0) AS concordance_index
FROM (SELECT s.cell_id, s.p, CAST(coalesce(st.eol_cycle, st.last_cycle) AS INTEGER) AS d, CAST(st.eol_cycle IS NOT NULL AS INTEGER) AS e
      FROM scored s JOIN stats st USING (cell_id)) a
JOIN (SELECT s.cell_id, s.p, CAST(coalesce(st.eol_cycle, st.last_cycle) AS INTEGER) AS d
      FROM scored s JOIN stats st USING (cell_id)) b ON a.e = 1 AND a.d < b.d"""))
def concordance_index(p):
    sc = _scored_holdout(p).join(survival.survival_frame(p.stats), "cell_id")
    return survival.concordance_index(sc, "duration_cycles", "event_observed", "p")


_HAZARD = " + ".join([repr(config.STATED_HAZARD["intercept"]) + "::DOUBLE",
                      repr(config.STATED_HAZARD["log_interval_end"]) + "::DOUBLE * ln(1 + e)",
                      *[f"{config.STATED_HAZARD[c]!r}::DOUBLE * coalesce({c}, 0)" for c in config.SURVIVAL_NUMERIC]])
DIST_SQL = SURV_SQL.strip().split("pp AS (")[0].rstrip().rstrip(",") + f""",
hmax AS (SELECT CAST(ceil(max(duration_cycles) / 50.0) * 50 AS INTEGER) AS hz FROM sframe),
steps AS (SELECT f.cell_id, f.duration_cycles, f.event_observed, hz, e AS interval_end, 1 / (1 + exp(-({_HAZARD}))) AS h
  FROM sframe f JOIN split s USING (cell_id), hmax, unnest(range(50, hz + 1, 50)) AS t(e) WHERE NOT s.is_train),
alive AS (SELECT *, product(1 - h) OVER (PARTITION BY cell_id ORDER BY interval_end ROWS UNBOUNDED PRECEDING) AS s FROM steps),
dist AS (SELECT cell_id, any_value(duration_cycles) AS duration_cycles, any_value(event_observed) AS event_observed,
  CAST(coalesce(min(interval_end) FILTER (WHERE s <= 0.5), any_value(hz)) AS INTEGER) AS predicted_median_eol_cycle,
  sum(interval_end * s / (1 - h) * h) + any_value(hz) * min(s) AS predicted_expected_eol_cycle,
  1 - min(s) AS event_probability_by_horizon, coalesce(1 - min(s) FILTER (WHERE interval_end <= 500), 0) AS event_probability_by_500_cycles
  FROM alive GROUP BY cell_id)
"""


def _with_dist(select: str) -> str:
    return "SELECT * FROM (WITH " + SPLIT_SQL.strip() + ",\n" + DIST_SQL + select + ")"


def _survival_cells(p):
    return (p.cell_features.join(survival.survival_frame(p.stats), "cell_id")
            .join(_split(p).select("cell_id", "is_train"), "cell_id"))


def _survival_rows(p, cells):
    """Survival rows of the holdout cells under the stated hazard, up to the longest duration of all cells."""
    width = config.HAZARD_INTERVAL
    longest = cells.agg(F.max("duration_cycles")).first()[0] or width
    horizon = -(-longest // width) * width
    held = cells.where("not is_train")
    return survival.survival_rows(held, survival.stated_hazards(held, horizon), horizon)


@register("survival_distribution", _with_dist(
    "SELECT *, greatest(predicted_expected_eol_cycle - duration_cycles, 0) AS predicted_remaining_cycles_from_observed FROM dist"))
def survival_distribution(p):
    return _survival_rows(p, _survival_cells(p))


_MEDIAN_EVENT = ("(SELECT coalesce(quantile_cont(duration_cycles, 0.5) FILTER (WHERE event_observed = 1), "
                 "quantile_cont(duration_cycles, 0.5)) FROM sframe JOIN split USING (cell_id) WHERE is_train)")


@register("event_mae", _with_dist(
    "SELECT avg(abs(duration_cycles - predicted_expected_eol_cycle)) AS model_event_mae, "
    f"avg(abs(duration_cycles - {_MEDIAN_EVENT})) AS baseline_event_mae, count(*) AS event_cells FROM dist WHERE event_observed = 1"))
def event_mae(p):
    cells = _survival_cells(p)
    return survival.event_errors(_survival_rows(p, cells), cells.where("is_train"))


@register("event_mae_baseline", _with_dist(
    f"SELECT avg(abs(duration_cycles - {_MEDIAN_EVENT})) AS baseline_event_mae, count(*) AS event_cells "
    "FROM sframe JOIN split USING (cell_id) WHERE event_observed = 1 AND NOT is_train"))
def event_mae_baseline(p):
    cells = _survival_cells(p)
    held = cells.where("not is_train").withColumn("predicted_expected_eol_cycle", F.lit(None).cast("double"))
    return survival.event_errors(held, cells.where("is_train")).drop("model_event_mae")


@register("survival_top_10", _with_dist(
    "SELECT cell_id, event_probability_by_500_cycles AS event_risk FROM dist ORDER BY event_risk DESC, cell_id LIMIT 10"))
def survival_top_10(p):
    rows = _survival_rows(p, _survival_cells(p))
    return top_k(rows.select("cell_id", F.col("event_probability_by_500_cycles").alias("event_risk")),
                 [F.desc("event_risk"), F.asc("cell_id")], 10)


@register("failure_baseline_top_10", _with_split(
    "SELECT cell_id, p AS event_risk FROM scored ORDER BY p DESC, cell_id LIMIT 10"))
def failure_baseline_top_10(p):
    s = _scored_holdout(p).select("cell_id", F.col("p").alias("event_risk"))
    return top_k(s, [F.desc("event_risk"), F.asc("cell_id")], 10)


@register("backtest_baseline_metrics", _with_split(_CLS_SQL.replace("SELECT\n", "SELECT 'failure' AS target,\n", 1)))
def backtest_baseline_metrics(p):
    m = ev.classification_metrics(_scored_holdout(p), "y", "p")
    return m.select(F.lit("failure").alias("target"), "*")


@register("release_decision", _with_split(f"""
, graded AS (SELECT c.cell_id, s.is_train, c.escalation_required AS y, p.failure_probability AS q, b.p AS base
  FROM cell_features c JOIN split s USING (cell_id) JOIN predictions p USING (cell_id) LEFT JOIN scored b USING (cell_id)),
later AS (SELECT * FROM graded WHERE NOT is_train),
f AS (SELECT 2.0::DOUBLE * count(*) FILTER (WHERE q >= 0.5 AND y = 1) / greatest(count(*) FILTER (WHERE q >= 0.5) + count(*) FILTER (WHERE y = 1), 1) AS score_f1,
  2.0::DOUBLE * count(*) FILTER (WHERE base >= 0.5 AND y = 1) / greatest(count(*) FILTER (WHERE base >= 0.5) + count(*) FILTER (WHERE y = 1), 1) AS baseline_f1,
  1.0::DOUBLE * count(*) FILTER (WHERE q >= 0.5 AND y = 1) / greatest(count(*) FILTER (WHERE y = 1), 1) AS later_recall,
  count(*) AS cells FROM later),
e AS (SELECT 1.0::DOUBLE * count(*) FILTER (WHERE q >= 0.5 AND y = 1) / greatest(count(*) FILTER (WHERE y = 1), 1) AS earlier_recall
  FROM graded WHERE is_train),
l AS (SELECT n AS review_load FROM (SELECT t, count(*) FILTER (WHERE q >= t) AS n, count(*) FILTER (WHERE q >= t AND y = 0)
    + 5 * count(*) FILTER (WHERE q < t AND y = 1) AS cost FROM ({_THR}) th, later GROUP BY t) ORDER BY cost, t LIMIT 1)
SELECT score_f1 > baseline_f1 AS beats_baseline, later_recall >= earlier_recall - {config.MAX_RECALL_DROP}::DOUBLE AS recall_holds,
  review_load <= {config.MAX_REVIEW_SHARE} * cells AS load_interpretable, score_f1, baseline_f1, earlier_recall, later_recall, review_load,
  score_f1 > baseline_f1 AND later_recall >= earlier_recall - {config.MAX_RECALL_DROP}::DOUBLE AND review_load <= {config.MAX_REVIEW_SHARE} * cells AS release
FROM f, e, l"""))
def release_decision(p):
    """The gate for the published scores of the cells against the rule baseline of the holdout."""
    graded = (p.cell_features.select("cell_id", F.col("escalation_required").alias("y"))
              .join(_split(p).select("cell_id", "is_train"), "cell_id")
              .join(p.predictions.select("cell_id", F.col("failure_probability").alias("q")), "cell_id"))
    graded = cut_lineage(graded)  # both tables are read several times
    later = graded.where("not is_train").join(_scored_holdout(p).select("cell_id", F.col("p").alias("base")), "cell_id", "left")
    return ev.release_gate(graded.where("is_train"), cut_lineage(later), "y", "q", "base")


@register("holdout_by_group", _with_split("""
SELECT f.lot_id, count(*) AS cells, avg(CAST(s.y AS DOUBLE)) AS event_rate, avg(s.p) AS mean_probability,
  avg(abs(s.p - s.y)) AS mean_abs_error
FROM scored s JOIN factory f USING (cell_id) GROUP BY f.lot_id"""))
def holdout_by_group(p):
    s = _scored_holdout(p).join(p.factory.select("cell_id", "lot_id"), "cell_id")
    return s.groupBy("lot_id").agg(F.count(F.lit(1)).alias("cells"),
                                   F.avg(F.col("y").cast("double")).alias("event_rate"),
                                   F.avg("p").alias("mean_probability"),
                                   F.avg(F.abs(F.col("p") - F.col("y"))).alias("mean_abs_error"))
