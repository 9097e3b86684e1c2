"""Independent SQL (DuckDB dialect) for the pipeline tables.

Written directly against the raw driver tables with plain window functions,
so a mistake in the Spark operators cannot be shared by the oracle.  Every
literal is cast to DOUBLE (an unmarked decimal literal would be DECIMAL).
"""
from __future__ import annotations

# ---- sources: supplier -> cell, line items -> cycles --------------------
SOURCES = r"""
sc AS (
  SELECT s_suppkey, s_nationkey,
    'CELL-' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 5, '0') AS cell_id,
    'LOT-' || lpad(CAST(s_nationkey % 12 + 1 AS VARCHAR), 3, '0') AS lot_id,
    'ST-' || lpad(CAST(s_suppkey % 8 + 1 AS VARCHAR), 2, '0') AS station_id,
    'LOT-' || lpad(CAST(s_nationkey % 12 + 1 AS VARCHAR), 3, '0') || '-B' || CAST(s_suppkey % 5 + 1 AS VARCHAR) AS batch_id,
    'EQ-' || lpad(CAST(s_suppkey % 6 + 1 AS VARCHAR), 2, '0') AS equipment_id,
    CASE WHEN (s_suppkey * 7) % 10 < 5 THEN 'normal' WHEN (s_suppkey * 7) % 10 < 7 THEN 'heavy'
         WHEN (s_suppkey * 7) % 10 < 9 THEN 'thermal_stress' ELSE 'fast_charge_heavy' END AS usage_profile,
    CASE WHEN (s_suppkey * 7) % 10 < 5 THEN 1.0::DOUBLE WHEN (s_suppkey * 7) % 10 < 7 THEN 1.55::DOUBLE
         WHEN (s_suppkey * 7) % 10 < 9 THEN 1.95::DOUBLE ELSE 1.7::DOUBLE END AS fm,
    CASE WHEN s_nationkey % 12 IN (2, 5, 9) THEN 1.6::DOUBLE ELSE 1.0::DOUBLE END AS lm,
    250 + (s_suppkey * 37) % 301 AS life,
    DATE '2024-01-01' + CAST((s_suppkey * 13) % 180 AS INTEGER) AS manufacturing_date
  FROM supplier
),
factory AS (
  SELECT cell_id, batch_id, lot_id, station_id,
    23.0::DOUBLE + (s_suppkey % 5) AS test_temperature,
    1.0::DOUBLE + 0.5::DOUBLE * (s_suppkey % 3) AS charge_current,
    1.0::DOUBLE + CAST((s_suppkey % 9) - (s_suppkey % 3) AS DOUBLE) / 3.0::DOUBLE AS discharge_current,
    manufacturing_date,
    manufacturing_date + CAST(7 + s_suppkey % 5 AS INTEGER) AS test_date,
    equipment_id
  FROM sc
),
usage AS (
  SELECT cell_id,
    0.5::DOUBLE + CAST(s_suppkey % 40 AS DOUBLE) / 100.0::DOUBLE AS avg_depth_of_discharge,
    CASE usage_profile WHEN 'normal' THEN 0.1::DOUBLE WHEN 'heavy' THEN 0.25::DOUBLE
         WHEN 'thermal_stress' THEN 0.15::DOUBLE ELSE 0.6::DOUBLE END
      + CAST(s_suppkey % 10 AS DOUBLE) / 100.0::DOUBLE AS fast_charge_ratio,
    1.0::DOUBLE + (s_suppkey % 4) * 0.5::DOUBLE AS avg_daily_cycles,
    CAST((s_suppkey * 17) % 130 AS DOUBLE) + CASE WHEN usage_profile = 'thermal_stress' THEN 40.0::DOUBLE ELSE 0.0::DOUBLE END AS high_temp_exposure_hours,
    CAST((s_suppkey * 11) % 60 AS DOUBLE) AS low_temp_exposure_hours,
    usage_profile
  FROM sc
),
imp AS (
  SELECT cell_id, CASE WHEN usage_profile = 'fast_charge_heavy' AND s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS impedance_spike_event
  FROM sc
),
li AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS ci
  FROM lineitem l
),
lx AS (
  SELECT li.*, sc.cell_id, sc.fm, sc.lm, f.test_date, f.discharge_current,
    3.5::DOUBLE * (1.0::DOUBLE - 0.0003::DOUBLE * (sc.fm * sc.lm) * ci + 0.07::DOUBLE * (l_discount - 0.05::DOUBLE)) AS cap,
    25.0::DOUBLE * (1.0::DOUBLE + 0.0011::DOUBLE * (sc.fm * sc.lm) * ci) + 10.0::DOUBLE * (l_tax - 0.04::DOUBLE) AS res,
    24.0::DOUBLE + 0.012::DOUBLE * ci + (l_quantity - 25.0::DOUBLE) / 12.0::DOUBLE + 6.0::DOUBLE + (sc.fm - 1.0::DOUBLE) * 10.0::DOUBLE AS tmax,
    3.7::DOUBLE - 0.0002::DOUBLE * sc.fm * ci + 0.1::DOUBLE * (l_discount - 0.05::DOUBLE) AS vmean
  FROM li JOIN sc ON li.l_suppkey = sc.s_suppkey JOIN factory f ON f.cell_id = sc.cell_id
),
landing0 AS (
  SELECT cell_id, CAST(ci AS INTEGER) AS cycle_index,
    vmean AS voltage_mean,
    vmean - 0.6::DOUBLE - 0.0001::DOUBLE * ci AS voltage_min,
    vmean + 0.45::DOUBLE AS voltage_max,
    0.0::DOUBLE - discharge_current AS current_mean,
    tmax - 6.0::DOUBLE AS temperature_mean,
    tmax AS temperature_max,
    CASE WHEN (l_orderkey + l_linenumber) % 199 = 0 THEN NULL ELSE cap END AS discharge_capacity_ah,
    cap * 1.01::DOUBLE AS charge_capacity_ah,
    CASE WHEN (l_partkey + l_linenumber) % 211 = 0 THEN 0.0::DOUBLE - res ELSE res END AS internal_resistance_mohm,
    cap * vmean AS energy_wh,
    CAST(test_date AS TIMESTAMP) + to_hours(CAST(ci * 2 AS BIGINT)) AS "timestamp",
    (l_orderkey * 8 + l_linenumber) * 2 AS ingest_seq,
    l_orderkey % 101 = 0 AS resent
  FROM lx
),
landing AS (
  SELECT * EXCLUDE (resent) FROM landing0
  UNION ALL BY NAME
  SELECT * EXCLUDE (resent) REPLACE (discharge_capacity_ah * 0.98::DOUBLE AS discharge_capacity_ah,
                                     ingest_seq + 1 AS ingest_seq)
  FROM landing0 WHERE resent
),
"""

# ---- cleaning and the per-cell series ---------------------------------
SERIES = r"""
valid AS (
  SELECT * FROM landing
  WHERE discharge_capacity_ah IS NOT NULL AND internal_resistance_mohm IS NOT NULL
    AND discharge_capacity_ah > 0 AND internal_resistance_mohm > 0
),
cycles AS (
  SELECT * EXCLUDE (rn, ingest_seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY cell_id, cycle_index ORDER BY ingest_seq) AS rn FROM valid)
  WHERE rn = 1
),
posd AS (
  SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY cycle_index) AS pos,
         count(*) OVER (PARTITION BY cell_id) AS n_rows
  FROM cycles
),
init AS (
  SELECT cell_id,
    avg(discharge_capacity_ah) FILTER (WHERE pos <= 5) AS ic,
    avg(internal_resistance_mohm) FILTER (WHERE pos <= 5) AS ir
  FROM posd GROUP BY cell_id
),
s0 AS (
  SELECT p.*, i.ic, i.ir, p.discharge_capacity_ah / i.ic AS soh
  FROM posd p JOIN init i USING (cell_id)
),
series AS (
  SELECT *,
    (1.0::DOUBLE - soh) / greatest(cycle_index, 1) AS fade,
    (internal_resistance_mohm / ir - 1.0::DOUBLE) / greatest(cycle_index, 1) AS growth,
    avg(discharge_capacity_ah) OVER w10 AS roll_cap,
    max(temperature_max) OVER w10 AS roll_tmax,
    avg(internal_resistance_mohm) OVER w10 AS roll_res,
    coalesce(soh - lag(soh, 20) OVER w, 0.0::DOUBLE) AS delta20,
    soh - lag(soh, 1) OVER w AS step
  FROM s0
  WINDOW w AS (PARTITION BY cell_id ORDER BY pos),
         w10 AS (PARTITION BY cell_id ORDER BY pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
),
stats AS (
  SELECT cell_id,
    max(n_rows) AS n_rows, max(ic) AS ic, max(ir) AS ir,
    min(cycle_index) FILTER (WHERE soh < 0.8::DOUBLE) AS eol_cycle,
    min(pos) FILTER (WHERE soh < 0.8::DOUBLE) AS eol_pos,
    min(pos) FILTER (WHERE soh < 0.9::DOUBLE) AS early_pos,
    max(cycle_index) AS last_cycle,
    arg_max(soh, pos) AS final_soh,
    arg_max(fade, pos) AS capacity_fade_rate,
    arg_max(growth, pos) AS resistance_growth_rate,
    regr_slope(soh, CAST(cycle_index AS DOUBLE)) FILTER (WHERE pos >= greatest(1, floor(n_rows * 0.75::DOUBLE))) AS tail_slope,
    count(*) FILTER (WHERE pos >= greatest(1, floor(n_rows * 0.75::DOUBLE))) AS tail_rows,
    max(temperature_max) AS peak_temperature_max,
    avg(temperature_max) AS mean_temperature_max,
    min(step) AS min_step,
    max(cycle_index) FILTER (WHERE pos <= 50) AS early_cycle_count,
    arg_max(soh, pos) FILTER (WHERE pos <= 20) AS soh_at_cycle_20,
    arg_max(soh, pos) FILTER (WHERE pos <= 50) AS soh_at_cycle_50,
    arg_max(internal_resistance_mohm, pos) FILTER (WHERE pos <= 50) AS early_last_res,
    avg(internal_resistance_mohm) FILTER (WHERE pos <= 50) AS resistance_mean_50,
    avg(temperature_mean) FILTER (WHERE pos <= 50) AS temperature_mean_50,
    max(temperature_max) FILTER (WHERE pos <= 50) AS temperature_max_50,
    min(voltage_min) FILTER (WHERE pos <= 50) AS voltage_min_50
  FROM series GROUP BY cell_id
),
eolp AS (
  SELECT *,
    coalesce(CAST(eol_cycle AS DOUBLE),
             last_cycle + (0.8::DOUBLE - final_soh) /
               least(CASE WHEN tail_rows > 2 THEN coalesce(tail_slope, -1e-6::DOUBLE) ELSE -1e-6::DOUBLE END, -1e-6::DOUBLE)
            ) AS eol_projection
  FROM stats
),
"""

# ---- labels, leave-one-out rates, feature tables -----------------------
FEATURES = r"""
ev0 AS (
  SELECT s.*, i.impedance_spike_event AS imp_flag, f.test_date,
    coalesce(s.early_pos, s.n_rows) AS early_cycle,
    (coalesce(s.early_pos, s.n_rows) < 227.5::DOUBLE AND s.final_soh < 0.9::DOUBLE) AS is_early,
    coalesce(s.min_step < -0.02::DOUBLE, false) AS is_drop,
    i.impedance_spike_event = 1 AS is_imp,
    s.peak_temperature_max > 48.0::DOUBLE AS is_thermal
  FROM stats s JOIN imp i USING (cell_id) JOIN factory f USING (cell_id)
),
ev1 AS (
  SELECT *,
    (1.0::DOUBLE - final_soh) * 3.0::DOUBLE + 1.2::DOUBLE * CAST(is_early AS DOUBLE)
      + 0.9::DOUBLE * CAST(is_drop AS DOUBLE) + 1.1::DOUBLE * CAST(is_imp AS DOUBLE)
      + 0.8::DOUBLE * CAST(is_thermal AS DOUBLE) AS severity_score
  FROM ev0
),
ev2 AS (
  SELECT *, CASE WHEN severity_score >= 2.4 THEN 'critical' WHEN severity_score >= 1.6 THEN 'high'
                 WHEN severity_score >= 0.9 THEN 'medium' ELSE 'low' END AS sev
  FROM ev1
),
failure_events AS (
  SELECT cell_id,
    CAST(CAST(test_date AS TIMESTAMP) + to_hours(CAST(2 * coalesce(eol_pos, early_cycle) AS BIGINT)) AS DATE) AS event_date,
    CASE WHEN is_imp THEN 'impedance_growth' WHEN is_thermal THEN 'thermal_event'
         WHEN is_early THEN 'early_degradation' WHEN is_drop THEN 'capacity_drop' ELSE 'nominal_fade' END AS event_type,
    CAST(is_drop AS INTEGER) AS capacity_drop_event,
    CAST(is_imp AS INTEGER) AS impedance_spike_event,
    CAST(is_thermal AS INTEGER) AS thermal_anomaly_event,
    CAST(is_early AS INTEGER) AS early_degradation_flag,
    CAST(sev IN ('high', 'critical') AND (is_early OR is_imp OR eol_pos IS NOT NULL) AS INTEGER) AS escalation_required,
    sev AS failure_severity,
    severity_score, eol_pos AS eol_position, CAST(early_cycle AS INTEGER) AS early_cycle
  FROM ev2
),
merged AS (
  SELECT fe.cell_id, f.batch_id, f.station_id,
    CAST(fe.escalation_required AS DOUBLE) AS esc, CAST(fe.thermal_anomaly_event AS DOUBLE) AS thermal
  FROM failure_events fe JOIN factory f USING (cell_id)
),
fleet AS (SELECT sum(esc) AS se, sum(thermal) AS st, count(*) AS n FROM merged),
bgrp AS (SELECT batch_id, sum(esc) AS gs, count(*) AS gc FROM merged GROUP BY batch_id),
sgrp AS (SELECT station_id, sum(thermal) AS gs, count(*) AS gc FROM merged GROUP BY station_id),
rates AS (
  SELECT m.cell_id,
    CASE WHEN b.gc > 1 THEN (b.gs - m.esc) / (b.gc - 1) WHEN fl.n > 1 THEN (fl.se - m.esc) / (fl.n - 1) ELSE 0.0::DOUBLE END AS batch_failure_rate,
    CASE WHEN s.gc > 1 THEN (s.gs - m.thermal) / (s.gc - 1) WHEN fl.n > 1 THEN (fl.st - m.thermal) / (fl.n - 1) ELSE 0.0::DOUBLE END AS station_anomaly_rate
  FROM merged m JOIN bgrp b USING (batch_id) JOIN sgrp s USING (station_id), fleet fl
),
cell_features AS (
  SELECT s.cell_id, s.final_soh, s.capacity_fade_rate, s.resistance_growth_rate,
    s.peak_temperature_max, s.mean_temperature_max, s.last_cycle AS cycle_count,
    u.fast_charge_ratio, u.avg_depth_of_discharge, u.high_temp_exposure_hours, u.low_temp_exposure_hours,
    u.usage_profile, f.lot_id, f.station_id, f.batch_id,
    coalesce(r.batch_failure_rate, 0.0::DOUBLE) AS batch_failure_rate,
    coalesce(r.station_anomaly_rate, 0.0::DOUBLE) AS station_anomaly_rate,
    CAST(fe.escalation_required AS INTEGER) AS escalation_required, fe.failure_severity
  FROM stats s LEFT JOIN usage u USING (cell_id) LEFT JOIN factory f USING (cell_id)
  LEFT JOIN rates r USING (cell_id) LEFT JOIN failure_events fe USING (cell_id)
),
early_features AS (
  SELECT s.cell_id, CAST(s.early_cycle_count AS INTEGER) AS early_cycle_count,
    s.soh_at_cycle_20, s.soh_at_cycle_50,
    (1.0::DOUBLE - s.soh_at_cycle_50) / greatest(s.early_cycle_count, 1) AS capacity_fade_rate_50,
    (s.early_last_res / s.ir - 1.0::DOUBLE) / greatest(s.early_cycle_count, 1) AS resistance_growth_rate_50,
    s.resistance_mean_50, s.temperature_mean_50, s.temperature_max_50, s.voltage_min_50,
    f.test_temperature, f.charge_current, f.discharge_current, f.lot_id, f.station_id, f.batch_id,
    coalesce(r.station_anomaly_rate, 0.0::DOUBLE) AS station_anomaly_rate,
    CAST(fe.escalation_required AS INTEGER) AS escalation_required, fe.failure_severity
  FROM stats s LEFT JOIN factory f USING (cell_id) LEFT JOIN rates r USING (cell_id)
  LEFT JOIN failure_events fe USING (cell_id)
),
cycle_features AS (
  SELECT x.cell_id, x.cycle_index, x.cycle_index AS cycle_count, x.soh AS soh_current,
    x.fade AS capacity_fade_rate, x.growth AS resistance_growth_rate,
    x.roll_cap AS rolling_capacity_mean_10, x.roll_tmax AS rolling_temperature_max_10,
    x.roll_res AS rolling_resistance_mean_10, x.delta20 AS soh_delta_last_20_cycles,
    u.fast_charge_ratio, u.avg_depth_of_discharge, u.high_temp_exposure_hours,
    coalesce(r.batch_failure_rate, 0.0::DOUBLE) AS batch_failure_rate,
    coalesce(r.station_anomaly_rate, 0.0::DOUBLE) AS station_anomaly_rate,
    f.lot_id, f.station_id,
    greatest(e.eol_projection - x.cycle_index, 0.0::DOUBLE) AS remaining_cycles
  FROM series x JOIN eolp e USING (cell_id) JOIN usage u USING (cell_id) JOIN factory f USING (cell_id)
  LEFT JOIN rates r USING (cell_id)
),
"""

# ---- warehouse, heuristic scores, marts ---------------------------------
MARTS = r"""
dim_test_condition AS (
  SELECT CAST(row_number() OVER (ORDER BY charge_current, discharge_current) AS INTEGER) AS test_condition_id,
    25.0::DOUBLE AS test_temperature, charge_current, discharge_current
  FROM (SELECT DISTINCT charge_current, discharge_current FROM factory)
),
dim_cell AS (
  SELECT f.cell_id, f.lot_id, f.batch_id, f.station_id, f.equipment_id, c.test_condition_id,
    u.usage_profile, f.manufacturing_date, f.test_date
  FROM factory f LEFT JOIN dim_test_condition c USING (charge_current, discharge_current)
  LEFT JOIN usage u USING (cell_id)
),
latest AS (
  SELECT cell_id, final_soh AS soh_current, capacity_fade_rate, last_cycle AS cycle_count FROM stats
),
soh_med AS (SELECT quantile_cont(greatest(capacity_fade_rate, 0.0::DOUBLE), 0.5) AS med FROM latest WHERE greatest(capacity_fade_rate, 0.0::DOUBLE) > 0),
rul_cap AS (SELECT greatest(quantile_cont(cycle_count, 0.95) * 2.0::DOUBLE, 500.0::DOUBLE) AS cap FROM latest),
latest_pred AS (
  SELECT l.cell_id,
    least(greatest(1.0::DOUBLE - coalesce(m.med, 0.0004::DOUBLE) * l.cycle_count, 0.0::DOUBLE), 1.05::DOUBLE) AS p_soh,
    least(greatest((l.soh_current - 0.8::DOUBLE) / greatest(l.capacity_fade_rate, 1e-6::DOUBLE), 0.0::DOUBLE), c.cap) AS p_rul
  FROM latest l, soh_med m, rul_cap c
),
fscore AS (
  SELECT cell_id, greatest(1.0::DOUBLE - final_soh, 0.0::DOUBLE) + 0.5::DOUBLE * greatest(station_anomaly_rate, 0.0::DOUBLE) AS sc,
         escalation_required FROM cell_features
),
fq AS (SELECT quantile_cont(sc, 0.05) AS lo, quantile_cont(sc, 0.95) AS hi, avg(CAST(escalation_required AS DOUBLE)) AS rate FROM fscore),
fprob AS (
  SELECT cell_id, CASE WHEN hi <= lo THEN rate ELSE least(greatest((sc - lo) / (hi - lo), 0.0::DOUBLE), 1.0::DOUBLE) END AS p
  FROM fscore, fq
),
escore AS (
  SELECT cell_id, greatest(1.0::DOUBLE - soh_at_cycle_50, 0.0::DOUBLE) + 0.5::DOUBLE * greatest(station_anomaly_rate, 0.0::DOUBLE) AS sc,
         escalation_required FROM early_features
),
eq AS (SELECT quantile_cont(sc, 0.05) AS lo, quantile_cont(sc, 0.95) AS hi, avg(CAST(escalation_required AS DOUBLE)) AS rate FROM escore),
eprob AS (
  SELECT cell_id, CASE WHEN hi <= lo THEN rate ELSE least(greatest((sc - lo) / (hi - lo), 0.0::DOUBLE), 1.0::DOUBLE) END AS p
  FROM escore, eq
),
zstats AS (
  SELECT avg(final_soh) AS m1, stddev_pop(final_soh) AS s1, avg(station_anomaly_rate) AS m2, stddev_pop(station_anomaly_rate) AS s2
  FROM cell_features
),
drivers AS (
  SELECT cell_id,
    CASE WHEN greatest(-((final_soh - m1) / (s1 + 1e-9::DOUBLE)), 0.0::DOUBLE) * 1.0::DOUBLE
              >= greatest((station_anomaly_rate - m2) / (s2 + 1e-9::DOUBLE), 0.0::DOUBLE) * 0.5::DOUBLE
         THEN 'Low state of health' ELSE 'Test-station anomaly signal' END AS top_risk_driver
  FROM cell_features, zstats
),
predictions AS (
  SELECT c.cell_id, DATE '2024-12-31' AS prediction_date,
    round_even((least(greatest(lp.p_soh, 0.0::DOUBLE), 1.05::DOUBLE)) * 1e4, 0) / 1e4 AS predicted_soh,
    round_even((greatest(lp.p_rul, 0.0::DOUBLE)) * 1e1, 0) / 1e1 AS predicted_remaining_cycles,
    round_even((fp.p) * 1e4, 0) / 1e4 AS failure_probability,
    CASE WHEN fp.p >= 0.8 THEN 'Critical' WHEN fp.p >= 0.55 THEN 'High' WHEN fp.p >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_tier,
    round_even((ep.p) * 1e4, 0) / 1e4 AS early_warning_probability,
    CASE WHEN ep.p >= 0.8 THEN 'Critical' WHEN ep.p >= 0.55 THEN 'High' WHEN ep.p >= 0.3 THEN 'Medium' ELSE 'Low' END AS early_warning_risk_tier,
    d.top_risk_driver
  FROM cell_features c JOIN latest_pred lp USING (cell_id) JOIN fprob fp USING (cell_id)
  LEFT JOIN eprob ep USING (cell_id) JOIN drivers d USING (cell_id)
),
health AS (
  SELECT c.cell_id, c.lot_id, c.batch_id, c.station_id, c.usage_profile, f.cycle_count,
    round(f.final_soh * 1e4) / 1e4 AS last_soh,
    round(f.capacity_fade_rate * 1e6) / 1e6 AS capacity_fade_rate,
    round(f.resistance_growth_rate * 1e6) / 1e6 AS resistance_growth_rate,
    round(f.peak_temperature_max * 1e2) / 1e2 AS peak_temperature_max,
    p.predicted_soh, p.predicted_remaining_cycles, p.failure_probability, p.risk_tier,
    p.early_warning_probability, p.early_warning_risk_tier, p.top_risk_driver,
    fe.escalation_required, fe.failure_severity
  FROM dim_cell c JOIN cell_features f USING (cell_id)
  LEFT JOIN predictions p USING (cell_id) LEFT JOIN failure_events fe USING (cell_id)
),
factory_quality AS (
  SELECT c.lot_id, c.station_id, count(*) AS num_cells,
    round(avg(f.final_soh) * 1e4) / 1e4 AS avg_final_soh,
    round(avg(f.capacity_fade_rate) * 1e6) / 1e6 AS avg_capacity_fade_rate,
    round(avg(f.resistance_growth_rate) * 1e6) / 1e6 AS avg_resistance_growth_rate,
    round(avg(fe.escalation_required) * 1e4) / 1e4 AS escalation_rate,
    round(avg(fe.early_degradation_flag) * 1e4) / 1e4 AS early_degradation_rate,
    round(avg(fe.thermal_anomaly_event) * 1e4) / 1e4 AS thermal_anomaly_rate,
    round(avg(fe.impedance_spike_event) * 1e4) / 1e4 AS impedance_spike_rate
  FROM dim_cell c JOIN cell_features f USING (cell_id) JOIN failure_events fe USING (cell_id)
  GROUP BY c.lot_id, c.station_id
),
queue AS (
  SELECT cell_id, lot_id, station_id, usage_profile, failure_probability, early_warning_probability,
    early_warning_risk_tier, predicted_soh, predicted_remaining_cycles, last_soh, capacity_fade_rate,
    resistance_growth_rate, peak_temperature_max, risk_tier, top_risk_driver, failure_severity
  FROM health WHERE risk_tier IN ('High', 'Critical') OR escalation_required = 1
),
"""

ALL_CTES = SOURCES + SERIES + FEATURES + MARTS


def with_ctes(select_sql: str) -> str:
    """Prefix a final SELECT with every pipeline CTE (unused ones are never run)."""
    body = ALL_CTES.strip().rstrip(",")
    if select_sql.lstrip().upper().startswith("WITH"):
        select_sql = f"SELECT * FROM ({select_sql}) AS inner_q"
    return f"WITH {body}\n{select_sql}"
