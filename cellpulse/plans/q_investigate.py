"""Registered queries: pass/fail investigation, calibration context, contract checks."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import contracts, investigate, scoring
from ..operators.carry import history_join, month
from ..operators.quantiles import exact_quantiles
from ..session import cut_lineage
from ..sources import production
from .q_evaluate import _scored_holdout, _split, _with_split
from .q_public import _pub
from .registry import register


def _over(select: str) -> str:
    """A SELECT over the production tables' CTEs, for the oracle."""
    return f"SELECT * FROM (WITH {production.SQL.strip()}\n{select.strip()})"


# ---- calibration context: range join and as-of join ------------------------------------------------------------------
@register("station_calibration_context", _over("""
SELECT o.station_id, count(*) AS tested_cells, CAST(sum(o.failed) AS BIGINT) AS failed_cells,
  max(c.valid_from) AS last_calibration_at, max(c.open_issue) AS open_calibration_issue_flag
FROM outcomes o LEFT JOIN cal c ON o.station_id = c.station_id AND c.valid_from <= o.test_start GROUP BY o.station_id"""))
def station_calibration_context(p):
    """All earlier calibrations match each test, so counts are multiplied by them; no pair is made."""
    o = production.test_outcomes(p.spark, p.sf_dir)
    ran = history_join(o, production.calibration_logs(p.spark, p.sf_dir), ["station_id"], "test_start", "valid_from", month, {
        "n": ("count", "calibration_event_id"), "at": ("max", "valid_from"), "flag": ("max", "open_issue")})
    rows = F.greatest(F.col("n"), F.lit(1))
    return ran.groupBy("station_id").agg(F.sum(rows).alias("tested_cells"), F.sum(rows * F.col("failed")).alias("failed_cells"),
                                         F.max("at").alias("last_calibration_at"), F.max("flag").alias("open_calibration_issue_flag"))


@register("station_calibration_asof", _over("""
SELECT o.station_id, count(*) AS tested_cells, CAST(sum(o.failed) AS BIGINT) AS failed_cells,
  count(c.station_id) AS calibrated_cells, CAST(coalesce(sum(c.open_issue), 0) AS BIGINT) AS tests_with_open_issue,
  CAST(sum(date_diff('minute', c.valid_from, o.test_start)) AS BIGINT) AS minutes_since_calibration
FROM outcomes o ASOF LEFT JOIN (SELECT station_id, valid_from, max(open_issue) AS open_issue FROM cal
  WHERE station_id IS NOT NULL GROUP BY ALL) c ON o.station_id = c.station_id AND o.test_start >= c.valid_from
GROUP BY o.station_id"""))
def station_calibration_asof(p):
    """Each test with the one calibration that was in force."""
    o = production.test_outcomes(p.spark, p.sf_dir)
    cal = production.calibration_logs(p.spark, p.sf_dir).groupBy("station_id", "valid_from").agg(F.max("open_issue").alias("open"))
    cal = cal.withColumn("force", F.struct("valid_from", "open"))
    x = history_join(o, cal, ["station_id"], "test_start", "valid_from", month, {"c": ("last", "force")})
    minutes = F.floor((F.unix_micros(F.col("test_start").cast("timestamp_ltz")) - F.unix_micros(
        F.col("c.valid_from").cast("timestamp_ltz"))) / 60_000_000)
    return x.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("tested_cells"), F.sum(F.col("failed").cast("long")).alias("failed_cells"),
        F.count("c").alias("calibrated_cells"), F.coalesce(F.sum(F.col("c.open").cast("long")), F.lit(0)).alias("tests_with_open_issue"),
        F.sum(minutes).alias("minutes_since_calibration"))


@register("nearest_passed_peer", _over("""
SELECT test_id, lot_id, station_id, peer_id, peer_gap_seconds FROM (
  SELECT f.rid, f.test_id, f.lot_id, f.station_id, q.test_id AS peer_id,
    CAST(abs(epoch_us(q.test_start) - epoch_us(f.test_start)) // 1000000 AS BIGINT) AS peer_gap_seconds,
    row_number() OVER (PARTITION BY f.rid ORDER BY abs(epoch_us(q.test_start) - epoch_us(f.test_start)), q.test_start, q.test_id) AS nth
  FROM (SELECT row_number() OVER () AS rid, * FROM outcomes WHERE failed = 1) f
  LEFT JOIN (SELECT * FROM outcomes WHERE failed = 0) q ON f.lot_id = q.lot_id AND f.station_id = q.station_id)
WHERE nth = 1"""))
def nearest_passed_peer(p):
    o = production.test_outcomes(p.spark, p.sf_dir)
    near = investigate.nearest_peer(o.where("failed = 1"), o.where("failed = 0"), ["lot_id", "station_id"], "test_start", "test_id")
    return near.select("test_id", "lot_id", "station_id", "peer_id", "peer_gap_seconds")


@register("passfail_concentration", _over("""
SELECT lot_id, station_id, protocol_id, count(*) AS tested_cells, CAST(sum(failed) AS BIGINT) AS failed_cells,
  CAST(sum(failed) AS DOUBLE) / count(*) AS fail_rate
FROM outcomes GROUP BY lot_id, station_id, protocol_id HAVING count(*) >= 5"""))
def passfail_concentration(p):
    o = production.test_outcomes(p.spark, p.sf_dir)
    n = F.count(F.lit(1))
    return o.groupBy("lot_id", "station_id", "protocol_id").agg(
        n.alias("tested_cells"), F.sum(F.col("failed").cast("long")).alias("failed_cells"),
        (F.sum("failed").cast("double") / n).alias("fail_rate")).where("tested_cells >= 5")


_EFFECTS = ["final_soh", "resistance_growth_rate", "peak_temperature_max", "fast_charge_ratio"]
_LONG_SQL = " UNION ALL ".join(f"SELECT cell_id, escalation_required AS y, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM cell_features"
                               for f in _EFFECTS)


@register("passfail_feature_means", f"""
SELECT y AS escalation_required, feature, count(x) AS cells, avg(x) AS mean FROM ({_LONG_SQL}) GROUP BY y, feature""")
def passfail_feature_means(p):
    long = p.cell_features.select("escalation_required", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in _EFFECTS])).alias("v"))
    return long.groupBy("escalation_required", F.col("v.feature").alias("feature")).agg(
        F.count("v.x").alias("cells"), F.avg("v.x").alias("mean"))


_CUTS = " + ".join(f"CAST(u >= {c} AS INTEGER)" for c in investigate.poisson_cuts())


@register("bootstrap_effect", f"""
SELECT feature, max(d) FILTER (WHERE rep = 0) AS effect, quantile_cont(d, 0.025) FILTER (WHERE rep > 0) AS lo,
  quantile_cont(d, 0.975) FILTER (WHERE rep > 0) AS hi
FROM (SELECT feature, rep, sum(w * x) FILTER (WHERE y = 1) / nullif(sum(w) FILTER (WHERE y = 1), 0)
             - sum(w * x) FILTER (WHERE y <> 1) / nullif(sum(w) FILTER (WHERE y <> 1), 0) AS d
      FROM (SELECT *, CASE WHEN rep = 0 THEN 1 ELSE {_CUTS} END AS w
            FROM (SELECT *, CAST('0x' || substr(md5('7:' || rep || ':' || cell_id), 1, 8) AS BIGINT) AS u
                  FROM ({_LONG_SQL}), (SELECT unnest(range(101)) AS rep)) WHERE x IS NOT NULL)
      GROUP BY feature, rep) GROUP BY feature""")
def bootstrap_effect(p):
    return investigate.bootstrap_effect(p.cell_features, "cell_id", "escalation_required", _EFFECTS)


_IMPORTANCE = ["capacity_fade_rate", "resistance_growth_rate", "peak_temperature_max", "fast_charge_ratio"]
# a linear score of state of health, stated so that the oracle can apply it too
_SCORE = "0.98 - 300.0 * capacity_fade_rate - 2.0 * resistance_growth_rate - 0.002 * peak_temperature_max - 0.05 * fast_charge_ratio"
_SCORE_SQL = "0.98::DOUBLE - 300.0::DOUBLE * {} - 2.0::DOUBLE * {} - 0.002::DOUBLE * {} - 0.05::DOUBLE * {}"
_RUNS_SQL = " UNION ALL ".join(
    "SELECT rep, '{f}' AS feature, pow({s} - final_soh, 2) AS e FROM (SELECT *, coalesce(lead({f}) OVER w, first_value({f}) OVER w) AS moved "
    "FROM cell_features, (SELECT unnest(range(1, 11)) AS rep) WINDOW w AS (PARTITION BY rep ORDER BY md5('0:' || rep || ':{f}:' || cell_id), cell_id))"
    .format(f=f, s=_SCORE_SQL.format(*["moved" if g == f else g for g in _IMPORTANCE])) for f in _IMPORTANCE)


@register("permutation_importance", f"""
SELECT feature, avg(rise) AS importance, stddev_pop(rise) AS spread FROM (
  SELECT feature, rep, avg(e) - (SELECT avg(pow({_SCORE_SQL.format(*_IMPORTANCE)} - final_soh, 2)) FROM cell_features) AS rise
  FROM ({_RUNS_SQL}) GROUP BY feature, rep) GROUP BY feature""")
def permutation_importance(p):
    return investigate.permutation_importance(p.cell_features, "cell_id", "final_soh", _IMPORTANCE, lambda: F.expr(
        _SCORE.replace("0.98 ", "0.98D ").replace("300.0 ", "300.0D ").replace("2.0 ", "2.0D ").replace("0.002 ", "0.002D ")
        .replace("0.05 ", "0.05D ")))


@register("importance_top_n", f"""
SELECT feature, importance FROM (
  SELECT feature, avg(rise) AS importance FROM (
    SELECT feature, rep, avg(e) - (SELECT avg(pow({_SCORE_SQL.format(*_IMPORTANCE)} - final_soh, 2)) FROM cell_features) AS rise
    FROM ({_RUNS_SQL}) GROUP BY feature, rep) GROUP BY feature) ORDER BY importance DESC, feature LIMIT 3""")
def importance_top_n(p):
    return permutation_importance(p).select("feature", "importance").orderBy(F.desc("importance"), "feature").limit(3)


@register("stratified_split", """
SELECT cell_id, escalation_required, row_number() OVER (PARTITION BY escalation_required ORDER BY md5('0:' || cell_id), cell_id)
  <= floor(count(*) OVER (PARTITION BY escalation_required) * 0.25::DOUBLE + 0.5::DOUBLE) AS is_test FROM cell_features""")
def stratified_split(p):
    return investigate.stratified_split(p.cell_features.select("cell_id", "escalation_required"), "cell_id", "escalation_required", 0.25)


@register("holdout_precision_by_group", _with_split("""
, g AS (SELECT unnest(['lot', 'station', 'equipment', 'month']) AS grouping_name,
               unnest([f.lot_id, f.station_id, f.equipment_id, strftime(f.manufacturing_date, '%Y-%m')]) AS group_value, s.y, s.p
        FROM scored s JOIN factory f USING (cell_id)),
t AS (SELECT grouping_name, group_value, p, sum(y) AS tp, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT *, sum(tp) OVER w AS tps, sum(n) OVER w AS ns FROM t WINDOW w AS (PARTITION BY grouping_name, group_value ORDER BY p DESC))
SELECT grouping_name, group_value, CAST(sum(n) AS BIGINT) AS cells, CAST(sum(tp) AS BIGINT) AS positives,
  sum(tp * (tps / ns)) / nullif(CAST(sum(tp) AS DOUBLE), 0) AS average_precision
FROM r GROUP BY grouping_name, group_value"""))
def holdout_precision_by_group(p):
    s = _scored_holdout(p).join(p.factory.select("cell_id", "lot_id", "station_id", "equipment_id", "manufacturing_date"), "cell_id")
    named = {"lot": F.col("lot_id"), "station": F.col("station_id"), "equipment": F.col("equipment_id"),
             "month": F.date_format("manufacturing_date", "yyyy-MM")}
    long = s.select("y", "p", F.explode(F.array(*[F.struct(F.lit(k).alias("grouping_name"), v.alias("group_value"))
                                                  for k, v in named.items()])).alias("g")).select("g.*", "y", "p")
    ap = investigate.average_precision(cut_lineage(long), ["grouping_name", "group_value"], "y", "p")
    return ap.withColumnRenamed("rows", "cells")


# ---- contracts -----------------------------------------------------------------------------------------------------
_OVERLAP = """coalesce(max({end}) OVER (PARTITION BY {by} ORDER BY {start}, {id} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > {start},
  false) AS hit"""


@register("contract_station_calibration_logs", _over(f"""
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE station_id IS NULL) AS null_station,
  count(*) FILTER (WHERE equipment_id IS NULL) AS null_equipment,
  count(*) FILTER (WHERE abs(measurement_drift_pct) > 5.0::DOUBLE) AS drift_out_of_bounds,
  count(*) FILTER (WHERE valid_to <= valid_from) AS window_not_forward, count(*) FILTER (WHERE hit) AS overlapping
FROM (SELECT *, {_OVERLAP.format(end="valid_to", by="station_id, equipment_id", start="valid_from", id="calibration_event_id")} FROM cal)"""))
def contract_station_calibration_logs(p):
    return contracts.check_calibrations(production.calibration_logs(p.spark, p.sf_dir))


@register("contract_usage_telemetry", _over(f"""
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE window_end <= window_start) AS window_not_forward,
  count(*) FILTER (WHERE fast_charge_ratio < 0 OR fast_charge_ratio > 1) AS ratio_out_of_bounds,
  count(*) FILTER (WHERE high_temp_exposure_hours < 0) AS negative_hours, count(*) FILTER (WHERE usage_profile IS NULL) AS null_profile,
  count(*) FILTER (WHERE hit) AS overlapping
FROM (SELECT *, {_OVERLAP.format(end="window_end", by="cell_id", start="window_start", id="usage_window_id")} FROM windows)"""))
def contract_usage_telemetry(p):
    return contracts.check_usage(production.usage_windows(p.spark, p.sf_dir))


@register("contract_cycle_measurements", """
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE discharge_capacity_ah IS NULL) AS null_capacity,
  count(*) FILTER (WHERE discharge_capacity_ah <= 0) AS capacity_not_positive,
  count(*) FILTER (WHERE internal_resistance_mohm <= 0) AS resistance_not_positive,
  count(*) FILTER (WHERE voltage_min < 2.0::DOUBLE OR voltage_max > 4.2::DOUBLE) AS voltage_out_of_range,
  count(*) FILTER (WHERE cycle_index < before) AS out_of_order,
  (SELECT count(*) - count(DISTINCT (cell_id, cycle_index)) FROM landing) AS duplicate_rows,
  (SELECT count(*) FROM (SELECT cycle_index - lag(cycle_index) OVER (PARTITION BY cell_id ORDER BY cycle_index) AS step
     FROM (SELECT DISTINCT cell_id, cycle_index FROM landing WHERE discharge_capacity_ah IS NOT NULL)) WHERE step > 1) AS cycle_gaps
FROM (SELECT *, max(cycle_index) OVER (PARTITION BY cell_id ORDER BY ingest_seq, cycle_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM landing)""")
def contract_cycle_measurements(p):
    return contracts.check_cycles(p.landing_cycles, block_rows=128)


@register("contract_impedance_measurements", _over("""
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE frequency_hz <= 0) AS frequency_not_positive,
  count(*) FILTER (WHERE re_ohm < 0 OR rct_ohm < 0) AS negative_component,
  (SELECT count(*) - count(DISTINCT impedance_measurement_id) FROM impedance) AS duplicate_rows,
  count(*) FILTER (WHERE cell_id NOT IN (SELECT cell_id FROM factory)) AS unknown_cell_rows,
  (SELECT count(*) FROM (SELECT cell_id FROM impedance GROUP BY cell_id
     HAVING count(DISTINCT frequency_hz) FILTER (WHERE frequency_hz > 0) < 6)) AS cells_without_coverage
FROM impedance"""))
def contract_impedance_measurements(p):
    return contracts.check_impedance(production.impedance_tests(p.spark, p.sf_dir), p.factory)


@register("contract_failure_events", """
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE cell_id IS NULL) AS null_cell,
  count(*) FILTER (WHERE failure_severity IS NULL OR failure_severity NOT IN ('medium', 'high', 'critical')) AS unknown_severity,
  count(*) FILTER (WHERE event_type IS NULL OR event_type = '') AS no_event_type,
  count(*) FILTER (WHERE escalation_required = 1 AND event_type = 'nominal_fade') AS escalated_without_event
FROM failure_events""")
def contract_failure_events(p):
    return contracts.check_failures(p.failure_events, ["medium", "high", "critical"])


@register("contract_model_predictions", """
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE failure_probability IS NULL OR failure_probability < 0 OR failure_probability > 1) AS probability_out_of_range,
  count(*) FILTER (WHERE predicted_soh < 0 OR predicted_soh > 1.2::DOUBLE) AS soh_out_of_range,
  count(*) FILTER (WHERE risk_tier IS NULL OR risk_tier NOT IN ('Medium', 'High', 'Critical')) AS unknown_tier,
  count(*) - count(DISTINCT cell_id) AS duplicate_rows
FROM predictions""")
def contract_model_predictions(p):
    return contracts.check_predictions(p.predictions, ["Medium", "High", "Critical"])


@register("contract_factory_cell_tests", """
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE cell_id IS NULL OR lot_id IS NULL OR station_id IS NULL) AS null_key,
  count(*) FILTER (WHERE charge_current <= 0 OR discharge_current <= 0) AS current_not_positive,
  count(*) FILTER (WHERE test_temperature NOT BETWEEN 15.0::DOUBLE AND 26.5::DOUBLE) AS temperature_out_of_range,
  count(*) FILTER (WHERE test_date < manufacturing_date) AS tested_before_made, count(*) - count(DISTINCT cell_id) AS duplicate_rows
FROM factory""")
def contract_factory_cell_tests(p):
    return contracts.check_factory(p.factory)


@register("contract_conformance", _over("""
SELECT 'usage_telemetry' AS table_name, column_name, present, nulls, uncastable FROM (
  SELECT unnest(['usage_window_id', 'cell_id', 'device_id_hash', 'window_start_ts', 'window_end_ts', 'fast_charge_ratio',
                 'high_temp_exposure_hours', 'usage_profile']) AS column_name,
    unnest([true, true, false, true, true, true, true, true]) AS present,
    unnest([count(*) FILTER (WHERE usage_window_id IS NULL), count(*) FILTER (WHERE cell_id IS NULL), NULL, 0, 0,
            count(*) FILTER (WHERE fast_charge_ratio IS NULL), 0, count(*) FILTER (WHERE usage_profile IS NULL)]) AS nulls,
    unnest([0, 0, NULL, 0, 0, count(*) FILTER (WHERE fast_charge_ratio > 1), 0, 0]) AS uncastable
  FROM windows)"""))
def contract_conformance(p):
    """The telemetry windows as they arrive as text: ratios beyond 1 come as a percentage with its sign."""
    w = production.usage_windows(p.spark, p.sf_dir)
    ratio = F.when(F.col("fast_charge_ratio") > 1, F.concat((F.col("fast_charge_ratio") * 100).cast("string"), F.lit("%"))).otherwise(
        F.col("fast_charge_ratio").cast("string"))
    text = w.select(F.col("usage_window_id").cast("string").alias("usage_window_id"), "cell_id",
                    F.col("window_start").cast("string").alias("window_start_ts"), F.col("window_end").cast("string").alias("window_end_ts"),
                    ratio.alias("fast_charge_ratio"), F.col("high_temp_exposure_hours").cast("string").alias("high_temp_exposure_hours"),
                    "usage_profile")
    return contracts.conformance(text, "usage_telemetry", contracts.CONTRACT["usage_telemetry"])


@register("contract_quality_holds", _over("""
, told AS (SELECT *, CASE hold_scope WHEN 'lot' THEN lot_id WHEN 'station' THEN station_id ELSE cell_id END AS held FROM holds),
steps AS (SELECT coalesce(lag(hold_status) OVER (PARTITION BY hold_scope, held ORDER BY hold_opened_ts, quality_hold_id), 'start')
    || '>' || hold_status AS step FROM told WHERE held IS NOT NULL)
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE hold_status NOT IN ('open', 'review', 'closed')) AS unknown_status,
  count(*) FILTER (WHERE hold_status = 'closed' AND hold_closed_ts IS NULL) AS closed_without_time,
  count(*) FILTER (WHERE hold_status = 'closed' AND release_criteria IS NULL) AS closed_without_criteria,
  count(*) FILTER (WHERE hold_closed_ts < hold_opened_ts) AS closed_before_opened,
  count(*) FILTER (WHERE held IS NULL OR (lot_id IS NOT NULL)::INT + (station_id IS NOT NULL)::INT + (cell_id IS NOT NULL)::INT > 1) AS scope_mismatch,
  count(*) - count(DISTINCT quality_hold_id) AS duplicate_rows,
  (SELECT count(*) FROM steps WHERE step NOT IN ('start>open', 'open>review', 'open>closed', 'review>open', 'review>closed', 'closed>open'))
    AS illegal_steps
FROM told"""))
def contract_quality_holds(p):
    return contracts.check_holds(production.quality_holds(p.spark, p.sf_dir))


@register("contract_engineering_dispositions", _over("""
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE coalesce(cell_id, CAST(quality_hold_id AS VARCHAR), CAST(failure_event_id AS VARCHAR)) IS NULL)
    AS without_reference,
  count(*) FILTER (WHERE closed_ts IS NOT NULL AND final_outcome IS NULL) AS closed_without_outcome,
  count(*) FILTER (WHERE closed_ts > ingested_at) AS closed_in_future, count(*) - count(DISTINCT disposition_id) AS duplicate_rows,
  count(*) FILTER (WHERE quality_hold_id NOT IN (SELECT quality_hold_id FROM holds)) AS unknown_hold_rows,
  count(*) FILTER (WHERE cell_id NOT IN (SELECT cell_id FROM factory)) AS unknown_cell_rows
FROM dispositions"""))
def contract_engineering_dispositions(p):
    return contracts.check_dispositions(production.dispositions(p.spark, p.sf_dir), production.quality_holds(p.spark, p.sf_dir), p.factory)


@register("contract_escalation_actions", _over("""
SELECT count(*) AS checked_rows, count(*) FILTER (WHERE owner_role IS NULL OR action_status IS NULL) AS opened_without_owner_or_status,
  count(*) FILTER (WHERE action_status = 'closed' AND review_decision IS NULL) AS closed_without_decision,
  count(*) FILTER (WHERE closed_ts < opened_ts) AS closed_before_opened,
  count(*) FILTER (WHERE (false_positive_flag OR false_negative_flag) AND (reviewed_ts IS NULL OR review_decision IS NULL)) AS flag_without_evidence,
  count(*) FILTER (WHERE false_positive_flag AND false_negative_flag) AS both_flags,
  count(*) - count(DISTINCT escalation_action_id) AS duplicate_rows,
  count(*) FILTER (WHERE cell_id NOT IN (SELECT cell_id FROM factory)) AS unknown_cell_rows
FROM actions"""))
def contract_escalation_actions(p):
    return contracts.check_actions(production.escalation_actions(p.spark, p.sf_dir), p.factory)


def _profile_sql(table: str, rows: str) -> str:
    """The profile of a table whose columns all arrive with their declared types."""
    names = list(contracts.CONTRACT[table])
    return (f"SELECT '{table}' AS table_name, unnest({names}) AS column_name, true AS present, unnest(["
            + ", ".join(f"count(*) - count({c})" for c in names) + f"]) AS nulls, 0 AS uncastable FROM {rows}")


@register("contract_profile", _over(" UNION ALL ".join(_profile_sql(t, rows) for t, rows in (
    ("quality_holds", "holds"), ("engineering_dispositions", "dispositions"), ("escalation_actions", "actions"),
    ("failure_events", "failure_events"), ("model_predictions", "predictions")))))
def contract_profile(p):
    """Conformance of holds, dispositions, actions, failure events and predictions to their declared columns."""
    frames = {"quality_holds": production.quality_holds(p.spark, p.sf_dir), "engineering_dispositions": production.dispositions(p.spark, p.sf_dir),
              "escalation_actions": production.escalation_actions(p.spark, p.sf_dir), "failure_events": p.failure_events,
              "model_predictions": p.predictions}
    out = None
    for name, df in frames.items():
        rows = contracts.conformance(df, name, contracts.CONTRACT[name])
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- further report queries -------------------------------------------------------------------------------------------
@register("passfail_medians_iqr", f"""
SELECT y AS escalation_required, feature, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr
FROM ({_LONG_SQL}) WHERE x IS NOT NULL GROUP BY y, feature""")
def passfail_medians_iqr(p):
    long = p.cell_features.select("escalation_required", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in _EFFECTS])).alias("v")).select(
        "escalation_required", "v.feature", "v.x")
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], ["escalation_required", "feature"])

    def at(prob: float):
        return F.max(F.when(F.col("prob") == prob, F.col("quantile")))
    return q.groupBy("escalation_required", "feature").agg(at(0.5).alias("median"), (at(0.75) - at(0.25)).alias("iqr"))


@register("battery_rollup_b", _pub("""
SELECT battery_id, count(*) AS snapshots, min(cycle_index) AS first_cycle_index, max(cycle_index) AS last_cycle_index,
  arg_min(capacity_ah, cycle_index) AS initial_capacity_ah, arg_max(capacity_ah, cycle_index) AS final_capacity_ah,
  CASE WHEN arg_min(capacity_ah, cycle_index) <> 0 THEN
    (arg_min(capacity_ah, cycle_index) - arg_max(capacity_ah, cycle_index)) / arg_min(capacity_ah, cycle_index) END AS capacity_loss_pct,
  min(cycle_index) FILTER (WHERE soh < 0.8) AS first_cycle_below_80pct_soh, max(max_discharge_temp_c) AS max_discharge_temp_c
FROM (SELECT * REPLACE (CASE WHEN battery_id LIKE '%7' AND cycle_index = 0 THEN 0.0::DOUBLE ELSE capacity_ah END AS capacity_ah)
      FROM pubcyc) WHERE cycle_index % 5 = 0 GROUP BY battery_id"""))
def battery_rollup_b(p):
    """Every fifth cycle as a snapshot; the batteries whose number ends in 7 lack their first capacity (read as 0), so their loss is null."""
    from .q_public import _public_cycles
    c = _public_cycles(p).where("cycle_index % 5 = 0").withColumn("capacity_ah", F.when(
        F.col("battery_id").endswith("7") & (F.col("cycle_index") == 0), F.lit(0.0)).otherwise(F.col("capacity_ah")))
    return snapshot_rollup(c)


@register("alert_vs_outcome", """
SELECT p.risk_tier, count(*) AS cells, count(*) FILTER (WHERE f.escalation_required = 1) AS confirmed,
  count(*) FILTER (WHERE p.risk_tier IN ('High', 'Critical') AND f.escalation_required = 0) AS false_alerts,
  count(*) FILTER (WHERE p.risk_tier NOT IN ('High', 'Critical') AND f.escalation_required = 1) AS missed
FROM predictions p JOIN failure_events f USING (cell_id) GROUP BY p.risk_tier""")
def alert_vs_outcome(p):
    x = p.predictions.select("cell_id", "risk_tier").join(p.failure_events.select("cell_id", "escalation_required"), "cell_id")
    alert, event = F.col("risk_tier").isin("High", "Critical"), F.col("escalation_required") == 1
    return x.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("cells"), F.count(F.when(event, 1)).alias("confirmed"),
                                      F.count(F.when(alert & ~event, 1)).alias("false_alerts"),
                                      F.count(F.when(~alert & event, 1)).alias("missed"))


@register("drift_by_cohort", _with_split("""
, g AS (SELECT unnest(['lot', 'station']) AS grouping_name, unnest([f.lot_id, f.station_id]) AS group_value, s.is_train, q.p, c.final_soh
        FROM split s JOIN factory f USING (cell_id) JOIN fprob q USING (cell_id) JOIN cell_features c USING (cell_id))
SELECT grouping_name, group_value, count(*) FILTER (WHERE is_train) AS reference_cells, count(*) FILTER (WHERE NOT is_train) AS current_cells,
  avg(p) FILTER (WHERE NOT is_train) - avg(p) FILTER (WHERE is_train) AS probability_shift,
  avg(final_soh) FILTER (WHERE NOT is_train) - avg(final_soh) FILTER (WHERE is_train) AS soh_shift,
  avg(CAST(p >= 0.55::DOUBLE AS DOUBLE)) FILTER (WHERE NOT is_train) - avg(CAST(p >= 0.55::DOUBLE AS DOUBLE)) FILTER (WHERE is_train) AS alert_rate_shift
FROM g GROUP BY grouping_name, group_value"""))
def drift_by_cohort(p):
    """Shift of probability, health and alert rate from the reference to the current cells, by lot and by station."""
    scored = _fleet_probability(p).join(_split(p).select("cell_id", "is_train"), "cell_id").join(
        p.factory.select("cell_id", "lot_id", "station_id"), "cell_id").join(p.cell_features.select("cell_id", "final_soh"), "cell_id")
    long = scored.select("is_train", "p", "final_soh", F.explode(F.array(
        F.struct(F.lit("lot").alias("grouping_name"), F.col("lot_id").alias("group_value")),
        F.struct(F.lit("station").alias("grouping_name"), F.col("station_id").alias("group_value")))).alias("g"))
    here, alert = F.col("is_train"), (F.col("p") >= 0.55).cast("double")

    def shift(x):
        return F.avg(F.when(~here, x)) - F.avg(F.when(here, x))
    return long.groupBy("g.grouping_name", "g.group_value").agg(
        F.count(F.when(here, 1)).alias("reference_cells"), F.count(F.when(~here, 1)).alias("current_cells"),
        shift(F.col("p")).alias("probability_shift"), shift(F.col("final_soh")).alias("soh_shift"), shift(alert).alias("alert_rate_shift"))


def _fleet_probability(p):
    """cell_id, p: the unrounded failure probability of every cell."""
    return scoring.failure_baseline(p.cell_features, p.cell_features).select("cell_id", F.col("failure_probability").alias("p"))


def snapshot_rollup(c):
    """One row per battery from its capacity snapshots; the loss is null where the first capacity is 0."""
    first, last = F.min_by("capacity_ah", "cycle_index"), F.max_by("capacity_ah", "cycle_index")
    return c.groupBy("battery_id").agg(
        F.count(F.lit(1)).alias("snapshots"), F.min("cycle_index").alias("first_cycle_index"), F.max("cycle_index").alias("last_cycle_index"),
        first.alias("initial_capacity_ah"), last.alias("final_capacity_ah"), F.try_divide(first - last, first).alias("capacity_loss_pct"),
        F.min(F.when(F.col("soh") < config.SOH_EOL_THRESHOLD, F.col("cycle_index"))).alias("first_cycle_below_80pct_soh"),
        F.max("max_discharge_temp_c").alias("max_discharge_temp_c"))
