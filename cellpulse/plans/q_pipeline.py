"""Queries over sources, cleaning, features, labels, warehouse and marts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, events, features, marts
from .registry import register

CELL_FEATURE_COLS = ("cell_id, final_soh, capacity_fade_rate, resistance_growth_rate, peak_temperature_max, "
                     "mean_temperature_max, cycle_count, fast_charge_ratio, avg_depth_of_discharge, "
                     "high_temp_exposure_hours, low_temp_exposure_hours, usage_profile, lot_id, station_id, "
                     "batch_id, batch_failure_rate, station_anomaly_rate, escalation_required, failure_severity")


# ---- 2.1 scans --------------------------------------------------------
@register("scan_factory", "SELECT * FROM factory")
def scan_factory(p):
    return p.factory


@register("scan_usage", "SELECT * FROM usage")
def scan_usage(p):
    return p.usage


@register("scan_landing_cycles", "SELECT * FROM landing")
def scan_landing_cycles(p):
    return p.landing_cycles


@register("scan_failure_events", "SELECT cell_id, event_date, event_type, capacity_drop_event, impedance_spike_event, "
                                 "thermal_anomaly_event, early_degradation_flag, escalation_required, failure_severity "
                                 "FROM failure_events")
def scan_failure_events(p):
    return p.failure_events


# ---- 2.2 cleaning -------------------------------------------------------
@register("clean_cycles", "SELECT * FROM cycles")
def clean_cycles(p):
    return p.cycles


@register("clean_cycles_removed",
          "SELECT count(*) AS rows_before, (SELECT count(*) FROM cycles) AS rows_kept, "
          "count(*) - (SELECT count(*) FROM cycles) AS rows_removed FROM landing")
def clean_cycles_removed(p):
    return cleaning.clean_cycles_removed(p.landing_cycles)


# ---- 2.6 series windows ---------------------------------------------------
@register("initial_capacity",
          "SELECT cell_id, ic AS initial_capacity_ah, ir AS initial_resistance_mohm FROM init")
def initial_capacity(p):
    return p.initial.select("cell_id", "initial_capacity_ah", "initial_resistance_mohm")


@register("soh_current", "SELECT cell_id, cycle_index, soh AS soh_current FROM series")
def soh_current(p):
    return p.series.select("cell_id", "cycle_index", "soh_current")


@register("fade_and_growth",
          "SELECT cell_id, cycle_index, fade AS capacity_fade_rate, growth AS resistance_growth_rate FROM series")
def fade_and_growth(p):
    return p.series.select("cell_id", "cycle_index", "capacity_fade_rate", "resistance_growth_rate")


@register("rolling_10",
          "SELECT cell_id, cycle_index, roll_cap AS rolling_capacity_mean_10, roll_tmax AS rolling_temperature_max_10, "
          "roll_res AS rolling_resistance_mean_10 FROM series")
def rolling_10(p):
    return p.series.select("cell_id", "cycle_index", "rolling_capacity_mean_10", "rolling_temperature_max_10",
                           "rolling_resistance_mean_10")


@register("soh_delta_20", "SELECT cell_id, cycle_index, delta20 AS soh_delta_last_20_cycles FROM series")
def soh_delta_20(p):
    return p.series.select("cell_id", "cycle_index", "soh_delta_last_20_cycles")


@register("remaining_cycles", "SELECT cell_id, cycle_index, remaining_cycles FROM cycle_features")
def remaining_cycles(p):
    return p.cycle_features.select("cell_id", "cycle_index", "remaining_cycles")


@register("cycle_features", "SELECT * FROM cycle_features")
def cycle_features(p):
    return p.cycle_features


@register("latest_snapshot",
          "SELECT cf.* FROM cycle_features cf JOIN (SELECT cell_id, max(cycle_index) AS m FROM cycle_features "
          "GROUP BY cell_id) x ON x.cell_id = cf.cell_id AND x.m = cf.cycle_index")
def latest_snapshot(p):
    cf = p.cycle_features
    last = p.stats.select("cell_id", F.col("last_cycle").alias("cycle_index"))
    return cf.join(last, ["cell_id", "cycle_index"], "left_semi")


@register("recent_cycle_window", """
SELECT cell_id, arg_min(soh_current, cycle_index) AS start_soh, arg_max(soh_current, cycle_index) AS end_soh,
  arg_max(soh_current, cycle_index) - arg_min(soh_current, cycle_index) AS soh_change,
  max(rolling_temperature_max_10) AS max_rolling_temperature, count(*) AS n_cycles
FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY cycle_index DESC) AS rk FROM cycle_features)
WHERE rk <= 20 GROUP BY cell_id""")
def recent_cycle_window(p):
    # last 20 rows of each cell: positions > n - 20 (positions come from the blocked numbering); only these get features
    recent = p.series.where(F.col("pos") > F.col("n_rows") - 20)
    last = features.cycle_features(recent, p.stats, p.cell_context)
    return last.groupBy("cell_id").agg(
        F.min_by("soh_current", "cycle_index").alias("start_soh"),
        F.max_by("soh_current", "cycle_index").alias("end_soh"),
        (F.max_by("soh_current", "cycle_index") - F.min_by("soh_current", "cycle_index")).alias("soh_change"),
        F.max("rolling_temperature_max_10").alias("max_rolling_temperature"),
        F.count(F.lit(1)).alias("n_cycles"))


@register("fleet_percentile", """
SELECT cell_id,
  cume_dist() OVER (ORDER BY last_soh) AS last_soh_pct,
  cume_dist() OVER (ORDER BY capacity_fade_rate) AS fade_pct,
  cume_dist() OVER (ORDER BY resistance_growth_rate) AS growth_pct,
  cume_dist() OVER (ORDER BY failure_probability) AS failure_probability_pct
FROM health""")
def fleet_percentile(p):
    from ..operators.reports import fleet_percentile as fp
    return fp(p.health, ["last_soh", "capacity_fade_rate", "resistance_growth_rate", "failure_probability"],
              ["last_soh_pct", "fade_pct", "growth_pct", "failure_probability_pct"])


# ---- 2.5 aggregations / features ------------------------------------------
@register("leave_one_out_rate", "SELECT cell_id, batch_failure_rate, station_anomaly_rate FROM rates")
def leave_one_out_rate(p):
    return p.rates


@register("batch_failure_rate", "SELECT cell_id, batch_failure_rate FROM rates")
def batch_failure_rate(p):
    return p.rates.select("cell_id", "batch_failure_rate")


@register("station_anomaly_rate", "SELECT cell_id, station_anomaly_rate FROM rates")
def station_anomaly_rate(p):
    return p.rates.select("cell_id", "station_anomaly_rate")


@register("cell_features", f"SELECT {CELL_FEATURE_COLS} FROM cell_features")
def cell_features(p):
    return p.cell_features


@register("early_warning_features", "SELECT * FROM early_features")
def early_warning_features(p):
    return p.early_warning_features


@register("dim_lot", "SELECT lot_id, count(DISTINCT cell_id) AS num_cells, count(DISTINCT batch_id) AS num_batches "
                     "FROM factory GROUP BY lot_id")
def dim_lot(p):
    return p.dim_lot


@register("dim_station", "SELECT station_id, count(DISTINCT cell_id) AS num_cells FROM factory GROUP BY station_id")
def dim_station(p):
    return p.dim_station


@register("dim_test_condition", "SELECT * FROM dim_test_condition")
def dim_test_condition(p):
    return p.dim_test_condition


@register("dim_cell", "SELECT * FROM dim_cell")
def dim_cell(p):
    return p.dim_cell


@register("fact_cycle_measurements", "SELECT * FROM cycles")
def fact_cycle_measurements(p):
    return p.fact_cycle_measurements


@register("survival_frame", """
SELECT cell_id, CAST(coalesce(eol_cycle, last_cycle) AS INTEGER) AS duration_cycles,
  CAST(eol_cycle IS NOT NULL AS INTEGER) AS event_observed FROM stats""")
def survival_frame(p):
    from ..operators.survival import survival_frame as sf
    return sf(p.stats).select("cell_id", "duration_cycles", "event_observed")


@register("class_balance", "SELECT escalation_required, count(*) AS n FROM cell_features GROUP BY escalation_required")
def class_balance(p):
    return p.cell_features.groupBy("escalation_required").agg(F.count(F.lit(1)).alias("n"))


# ---- 2.7 labels ---------------------------------------------------------
@register("derive_failure_events", """
SELECT cell_id, early_cycle, eol_position, capacity_drop_event, thermal_anomaly_event, early_degradation_flag
FROM failure_events""")
def derive_failure_events(p):
    fe = events.derive_failure_events(p.stats, p.impedance, p.factory, with_score=True)
    return fe.select("cell_id", "early_cycle", "eol_position", "capacity_drop_event", "thermal_anomaly_event",
                     "early_degradation_flag")


@register("severity_score", "SELECT cell_id, severity_score, failure_severity FROM failure_events")
def severity_score(p):
    fe = events.derive_failure_events(p.stats, p.impedance, p.factory, with_score=True)
    return fe.select("cell_id", "severity_score", "failure_severity")


@register("escalation_required", "SELECT cell_id, escalation_required FROM failure_events")
def escalation_required(p):
    return p.failure_events.select("cell_id", "escalation_required")


@register("event_type", "SELECT cell_id, event_type FROM failure_events")
def event_type(p):
    return p.failure_events.select("cell_id", "event_type")


@register("event_date", "SELECT cell_id, event_date FROM failure_events")
def event_date(p):
    return p.failure_events.select("cell_id", "event_date")


# ---- 2.9 marts ----------------------------------------------------------
@register("mart_cell_health_summary", "SELECT * FROM health")
def mart_cell_health_summary(p):
    return p.health


@register("mart_factory_quality", "SELECT * FROM factory_quality")
def mart_factory_quality(p):
    return p.factory_quality


@register("mart_escalation_queue", "SELECT * FROM queue")
def mart_escalation_queue(p):
    return p.queue


@register("score_cells", "SELECT * FROM predictions")
def score_cells(p):
    return p.predictions


@register("lot_station_final_soh", """
SELECT f.lot_id, f.station_id, count(*) AS num_cells, avg(s.final_soh) AS avg_final_soh
FROM factory f JOIN stats s USING (cell_id) GROUP BY f.lot_id, f.station_id""")
def lot_station_final_soh(p):
    """The minimum slice: clean -> initial capacity -> SOH -> last per cell -> lot x station mean."""
    return (p.factory.select("cell_id", "lot_id", "station_id")
            .join(p.stats.select("cell_id", "final_soh"), "cell_id")
            .groupBy("lot_id", "station_id")
            .agg(F.count(F.lit(1)).alias("num_cells"), F.avg("final_soh").alias("avg_final_soh")))
