"""Report, extract, ad-hoc and dashboard queries over the marts."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config
from ..functions.scalar import exposure_band, likely_root_cause, round_half_up as r
from ..operators import publish
from ..operators.marts import queue_order
from ..operators.quantiles import exact_quantile_columns
from ..operators.reports import correlation, per_group_tail, top_k, weighted_rate
from .registry import register


def R(x: str, d: int) -> str:
    """Oracle-side twin of ``round_half_up``."""
    return f"round(({x}) * 1e{d}) / 1e{d}"


# ---- ad-hoc questions -------------------------------------------------------
@register("adhoc_lot_risk", f"""
SELECT * FROM (
  SELECT lot_id, CAST(sum(num_cells) AS BIGINT) AS cells,
    {R('CAST(sum(CAST(escalation_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE)', 4)} AS escalation_rate,
    {R('CAST(sum(CAST(early_degradation_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE)', 4)} AS early_degradation_rate,
    {R('CAST(sum(CAST(avg_final_soh AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE)', 4)} AS avg_final_soh
  FROM factory_quality GROUP BY lot_id)
ORDER BY escalation_rate DESC, early_degradation_rate DESC, lot_id LIMIT 10""")
def adhoc_lot_risk(p):
    g = p.factory_quality.groupBy("lot_id").agg(
        F.sum("num_cells").cast("long").alias("cells"),
        r(weighted_rate("escalation_rate"), 4).alias("escalation_rate"),
        r(weighted_rate("early_degradation_rate"), 4).alias("early_degradation_rate"),
        r(weighted_rate("avg_final_soh"), 4).alias("avg_final_soh"))
    return top_k(g, [F.desc("escalation_rate"), F.desc("early_degradation_rate"), F.asc("lot_id")], 10)


@register("adhoc_station_anomaly", f"""
SELECT * FROM (
  SELECT station_id, CAST(sum(num_cells) AS BIGINT) AS cells,
    {R('CAST(sum(CAST(thermal_anomaly_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE)', 4)} AS thermal_anomaly_rate,
    {R('CAST(sum(CAST(impedance_spike_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE)', 4)} AS impedance_spike_rate,
    {R('CAST(sum(CAST(escalation_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE)', 4)} AS escalation_rate
  FROM factory_quality GROUP BY station_id)
WHERE escalation_rate > (SELECT avg(escalation_required) FROM failure_events)""")
def adhoc_station_anomaly(p):
    g = p.factory_quality.groupBy("station_id").agg(
        F.sum("num_cells").cast("long").alias("cells"),
        r(weighted_rate("thermal_anomaly_rate"), 4).alias("thermal_anomaly_rate"),
        r(weighted_rate("impedance_spike_rate"), 4).alias("impedance_spike_rate"),
        r(weighted_rate("escalation_rate"), 4).alias("escalation_rate"))
    fleet = p.failure_events.select(F.avg("escalation_required")).scalar()
    return g.where(F.col("escalation_rate") > fleet)


@register("adhoc_urgent_cells", f"""
SELECT cell_id, lot_id, station_id, risk_tier, {R('failure_probability', 3)} AS failure_probability,
  predicted_soh, predicted_remaining_cycles, top_risk_driver
FROM queue ORDER BY failure_probability DESC NULLS LAST, predicted_remaining_cycles ASC NULLS FIRST, cell_id LIMIT 20""")
def adhoc_urgent_cells(p):
    q = top_k(p.queue, queue_order(), 20)
    return q.select("cell_id", "lot_id", "station_id", "risk_tier",
                    r(F.col("failure_probability"), 3).alias("failure_probability"),
                    "predicted_soh", "predicted_remaining_cycles", "top_risk_driver")


def _mean_of(x: str) -> str:
    return f"(SELECT sum({x}) / nullif(count({x}), 0) FROM health WHERE usage_profile IS NOT DISTINCT FROM profile.name)"


@register("adhoc_usage_drivers", f"""
SELECT profile.name AS usage_profile, profile.cells, {R(_mean_of('capacity_fade_rate'), 6)} AS avg_capacity_fade_rate,
  {R(_mean_of('resistance_growth_rate'), 6)} AS avg_resistance_growth_rate, {R(_mean_of('last_soh'), 4)} AS avg_last_soh,
  {R(_mean_of('failure_probability'), 4)} AS avg_failure_probability
FROM (SELECT usage_profile AS name, count(*) AS cells FROM health GROUP BY ALL) profile""")
def adhoc_usage_drivers(p):
    return p.health.groupBy("usage_profile").agg(
        F.count(F.lit(1)).alias("cells"),
        r(F.avg("capacity_fade_rate"), 6).alias("avg_capacity_fade_rate"),
        r(F.avg("resistance_growth_rate"), 6).alias("avg_resistance_growth_rate"),
        r(F.avg("last_soh"), 4).alias("avg_last_soh"),
        r(F.avg("failure_probability"), 4).alias("avg_failure_probability"))


# Bands of 40 hours, the fourth and unknown hours open upwards.
_BAND = "coalesce(greatest(0, least(3, CAST(floor(f.high_temp_exposure_hours / 40) AS INTEGER))), 3)"
_BAND_SQL = f"(40 * {_BAND}) || if({_BAND} = 3, 'h+', '-' || (40 * {_BAND} + 40) || 'h')"


@register("exposure_band", f"SELECT f.cell_id, {_BAND_SQL} AS high_temp_exposure_band FROM cell_features f")
def exposure_band_q(p):
    return p.cell_features.select("cell_id", exposure_band(F.col("high_temp_exposure_hours"))
                                  .alias("high_temp_exposure_band"))


@register("adhoc_thermal_band", f"""
SELECT high_temp_exposure_band, CAST(sum(n) AS BIGINT) AS cells, {R('sum(fade) / nullif(sum(fades), 0)', 6)} AS avg_capacity_fade_rate,
  {R('sum(soh) / nullif(sum(sohs), 0)', 4)} AS avg_final_soh, {R('sum(hot) / sum(n)', 4)} AS thermal_anomaly_rate
FROM (
  SELECT {_BAND_SQL} AS high_temp_exposure_band, count(e.cell_id) AS n, count(e.cell_id) FILTER (WHERE e.thermal_anomaly_event = 1) AS hot,
    f.capacity_fade_rate * n AS fade, if(f.capacity_fade_rate IS NULL, 0, n) AS fades, f.final_soh * n AS soh, if(f.final_soh IS NULL, 0, n) AS sohs
  FROM cell_features f, failure_events e WHERE e.cell_id = f.cell_id
  GROUP BY f.cell_id, f.high_temp_exposure_hours, f.capacity_fade_rate, f.final_soh)
GROUP BY ALL""")
def adhoc_thermal_band(p):
    j = p.cell_features.select("cell_id", "high_temp_exposure_hours", "capacity_fade_rate", "final_soh").join(
        p.failure_events.select("cell_id", "thermal_anomaly_event"), "cell_id")
    return (j.withColumn("high_temp_exposure_band", exposure_band(F.col("high_temp_exposure_hours")))
            .groupBy("high_temp_exposure_band").agg(
                F.count(F.lit(1)).alias("cells"),
                r(F.avg("capacity_fade_rate"), 6).alias("avg_capacity_fade_rate"),
                r(F.avg("final_soh"), 4).alias("avg_final_soh"),
                r(F.avg("thermal_anomaly_event"), 4).alias("thermal_anomaly_rate")))


@register("adhoc_fleet_snapshot", f"""
SELECT tier.name AS risk_tier, tier.cells, {R('tier.soh / nullif(tier.sohs, 0)', 4)} AS avg_predicted_soh,
  {R('tier.left_over / nullif(tier.lefts, 0)', 1)} AS avg_remaining_cycles
FROM (
  SELECT risk_tier AS name, count(*) AS cells, sum(predicted_soh) AS soh, count(predicted_soh) AS sohs,
    sum(predicted_remaining_cycles) AS left_over, count(predicted_remaining_cycles) AS lefts
  FROM health WHERE risk_tier IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'Unscored', count(*), sum(predicted_soh), count(predicted_soh), sum(predicted_remaining_cycles), count(predicted_remaining_cycles)
  FROM health WHERE risk_tier IS NULL) tier
WHERE tier.cells > 0""")
def adhoc_fleet_snapshot(p):
    return (p.health.withColumn("risk_tier", F.coalesce("risk_tier", F.lit("Unscored")))
            .groupBy("risk_tier").agg(F.count(F.lit(1)).alias("cells"),
                                      r(F.avg("predicted_soh"), 4).alias("avg_predicted_soh"),
                                      r(F.avg("predicted_remaining_cycles"), 1).alias("avg_remaining_cycles")))


@register("coalesce_tier", "SELECT cell_id, coalesce(risk_tier, 'Unscored') AS risk_tier FROM health")
def coalesce_tier(p):
    return p.health.select("cell_id", F.coalesce("risk_tier", F.lit("Unscored")).alias("risk_tier"))


@register("in_predicate", "SELECT cell_id, (risk_tier IN ('High', 'Critical') OR escalation_required = 1) AS in_queue FROM health")
def in_predicate(p):
    from ..functions.scalar import in_queue
    return p.health.select("cell_id", in_queue(F.col("risk_tier"), F.col("escalation_required")).alias("in_queue"))


@register("risk_tier", """
SELECT cell_id, CASE WHEN p >= 0.8 THEN 'Critical' WHEN p >= 0.55 THEN 'High' WHEN p >= 0.3 THEN 'Medium' ELSE 'Low' END AS tier
FROM fprob""")
def risk_tier_q(p):
    """Tiers of the unrounded probability."""
    from ..functions.scalar import risk_tier
    from ..operators.scoring import failure_baseline
    scored = failure_baseline(p.cell_features, p.cell_features)
    return scored.select("cell_id", risk_tier(F.col("failure_probability")).alias("tier"))


# ---- exports and extracts -------------------------------------------------
@register("export_lots_highest_risk", f"""
SELECT lot_id, {R('avg(escalation_rate)', 4)} AS escalation_rate FROM factory_quality GROUP BY lot_id
ORDER BY escalation_rate DESC, lot_id LIMIT 10""")
def export_lots_highest_risk(p):
    g = p.factory_quality.groupBy("lot_id").agg(r(F.avg("escalation_rate"), 4).alias("escalation_rate"))
    return top_k(g, [F.desc("escalation_rate"), F.asc("lot_id")], 10)


@register("export_stations_abnormal", f"""
SELECT station_id, {R('avg(thermal_anomaly_rate)', 4)} AS thermal_anomaly_rate FROM factory_quality GROUP BY station_id""")
def export_stations_abnormal(p):
    return p.factory_quality.groupBy("station_id").agg(r(F.avg("thermal_anomaly_rate"), 4).alias("thermal_anomaly_rate"))


@register("export_urgent_escalations", """
SELECT cell_id, lot_id, station_id, failure_probability, risk_tier, top_risk_driver FROM queue
ORDER BY failure_probability DESC NULLS LAST, cell_id LIMIT 20""")
def export_urgent_escalations(p):
    return top_k(p.queue, [F.col("failure_probability").desc_nulls_last(), F.asc("cell_id")], 20).select(
        "cell_id", "lot_id", "station_id", "failure_probability", "risk_tier", "top_risk_driver")


EXEC_COLS = ["cell_id", "lot_id", "station_id", "usage_profile", "cycle_count", "last_soh", "predicted_soh",
             "predicted_remaining_cycles", "failure_probability", "risk_tier", "top_risk_driver"]


@register("extract_executive_health", f"SELECT {', '.join(EXEC_COLS)} FROM health")
def extract_executive_health(p):
    return p.health.select(*EXEC_COLS)


@register("extract_lot_quality", "SELECT * FROM factory_quality")
def extract_lot_quality(p):
    return p.factory_quality


@register("extract_root_cause", f"""
SELECT usage_profile, top_risk_driver, count(*) AS cells, {R('avg(capacity_fade_rate)', 6)} AS avg_capacity_fade_rate,
  {R('avg(resistance_growth_rate)', 6)} AS avg_resistance_growth_rate, {R('avg(failure_probability)', 4)} AS avg_failure_probability
FROM health GROUP BY usage_profile, top_risk_driver""")
def extract_root_cause(p):
    return p.health.groupBy("usage_profile", "top_risk_driver").agg(
        F.count(F.lit(1)).alias("cells"),
        r(F.avg("capacity_fade_rate"), 6).alias("avg_capacity_fade_rate"),
        r(F.avg("resistance_growth_rate"), 6).alias("avg_resistance_growth_rate"),
        r(F.avg("failure_probability"), 4).alias("avg_failure_probability"))


@register("extract_escalation_queue", "SELECT * FROM queue")
def extract_escalation_queue(p):
    return p.queue


@register("lot_escalation_mean", "SELECT lot_id, avg(escalation_rate) AS escalation_rate FROM factory_quality GROUP BY lot_id")
def lot_escalation_mean(p):
    return p.factory_quality.groupBy("lot_id").agg(F.avg("escalation_rate").alias("escalation_rate"))


JMP_COLS = ["cell_id", "lot_id", "batch_id", "station_id", "usage_profile", "cycle_count", "last_soh", "predicted_soh",
            "predicted_remaining_cycles", "failure_probability", "risk_tier", "top_risk_driver", "capacity_fade_rate",
            "resistance_growth_rate", "peak_temperature_max", "escalation_required", "failure_severity"]


@register("jmp_cell_table", f"SELECT {', '.join(JMP_COLS)} FROM health")
def jmp_cell_table(p):
    return p.health.select(*JMP_COLS)


def _follow_up_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{k}' AS driver, '{v}' AS action" for k, v in config.FOLLOW_UP)
    return f"({rows})"


@register("escalation_report", f"""
SELECT q.cell_id, q.lot_id, q.station_id, q.failure_probability, q.early_warning_probability, q.predicted_soh,
  q.predicted_remaining_cycles,
  CASE WHEN q.failure_severity = 'critical' AND coalesce(q.last_soh, 1.0) < 0.8
       THEN coalesce(q.top_risk_driver, 'Unknown') || '{config.ROOT_CAUSE_EOL_SUFFIX}'
       ELSE coalesce(q.top_risk_driver, 'Unknown') END AS likely_root_cause,
  coalesce(fu.action, '{config.DEFAULT_FOLLOW_UP}') AS recommended_follow_up
FROM queue q LEFT JOIN {_follow_up_sql()} fu ON fu.driver = q.top_risk_driver""")
def escalation_report(p):
    spark = p.spark
    # An 11-row fixed lookup: broadcasting it is size-proven.
    fu = F.broadcast(spark.createDataFrame(list(config.FOLLOW_UP), "top_risk_driver string, action string"))
    q = p.queue.join(fu, "top_risk_driver", "left")
    return q.select(
        "cell_id", "lot_id", "station_id", "failure_probability", "early_warning_probability", "predicted_soh",
        "predicted_remaining_cycles",
        likely_root_cause(F.col("top_risk_driver"), F.col("failure_severity"), F.col("last_soh")).alias("likely_root_cause"),
        F.coalesce(F.col("action"), F.lit(config.DEFAULT_FOLLOW_UP)).alias("recommended_follow_up"))


@register("recommended_follow_up", f"""
SELECT h.cell_id, coalesce(fu.action, '{config.DEFAULT_FOLLOW_UP}') AS recommended_follow_up
FROM health h LEFT JOIN {_follow_up_sql()} fu ON fu.driver = h.top_risk_driver""")
def recommended_follow_up(p):
    fu = F.broadcast(p.spark.createDataFrame(list(config.FOLLOW_UP), "top_risk_driver string, action string"))
    return p.health.join(fu, "top_risk_driver", "left").select(
        "cell_id", F.coalesce(F.col("action"), F.lit(config.DEFAULT_FOLLOW_UP)).alias("recommended_follow_up"))


@register("likely_root_cause", f"""
SELECT cell_id, CASE WHEN failure_severity = 'critical' AND coalesce(last_soh, 1.0) < 0.8
       THEN coalesce(top_risk_driver, 'Unknown') || '{config.ROOT_CAUSE_EOL_SUFFIX}'
       ELSE coalesce(top_risk_driver, 'Unknown') END AS likely_root_cause FROM health""")
def likely_root_cause_q(p):
    return p.health.select("cell_id", likely_root_cause(F.col("top_risk_driver"), F.col("failure_severity"),
                                                        F.col("last_soh")).alias("likely_root_cause"))


@register("queue_by_tier", """
WITH tiers(risk_tier, ord) AS (VALUES ('Critical', 1), ('High', 2), ('Medium', 3), ('Low', 4))
SELECT t.risk_tier, CAST(count(q.cell_id) AS BIGINT) AS cells FROM tiers t LEFT JOIN queue q ON q.risk_tier = t.risk_tier
GROUP BY t.risk_tier
UNION ALL SELECT 'Total', count(*) FROM queue
UNION ALL SELECT 'Rule-based (Medium/Low)', count(*) FROM queue WHERE risk_tier IS NULL OR risk_tier NOT IN ('Critical', 'High')""")
def queue_by_tier(p):
    tiers = F.broadcast(p.spark.createDataFrame([("Critical",), ("High",), ("Medium",), ("Low",)], "risk_tier string"))
    q = p.queue
    counts = tiers.join(q.select("risk_tier", "cell_id"), "risk_tier", "left").groupBy("risk_tier").agg(
        F.count("cell_id").alias("cells"))
    total = q.agg(F.lit("Total").alias("risk_tier"), F.count(F.lit(1)).alias("cells"))
    rule = q.where(~F.coalesce(F.col("risk_tier").isin("Critical", "High"), F.lit(False))).agg(
        F.lit("Rule-based (Medium/Low)").alias("risk_tier"), F.count(F.lit(1)).alias("cells"))
    return counts.unionByName(total).unionByName(rule)


@register("queue_top_lots", "SELECT lot_id, count(*) AS cells FROM queue GROUP BY lot_id ORDER BY cells DESC, lot_id LIMIT 5")
def queue_top_lots(p):
    g = p.queue.groupBy("lot_id").agg(F.count(F.lit(1)).alias("cells"))
    return top_k(g, [F.desc("cells"), F.asc("lot_id")], 5)


@register("case_study_cell", """
WITH t AS (SELECT * FROM queue ORDER BY failure_probability DESC NULLS LAST, predicted_remaining_cycles ASC NULLS FIRST, cell_id LIMIT 1)
SELECT t.cell_id, t.lot_id, t.station_id, t.top_risk_driver, t.failure_probability,
  (SELECT avg(escalation_rate) FROM factory_quality fq WHERE fq.lot_id = t.lot_id) AS lot_mean_escalation,
  (SELECT avg(escalation_rate) FROM factory_quality fq WHERE fq.station_id = t.station_id) AS station_mean_escalation,
  (SELECT avg(escalation_rate) FROM factory_quality fq WHERE fq.lot_id = t.lot_id AND fq.station_id = t.station_id) AS lot_station_escalation
FROM t""")
def case_study_cell(p):
    t = top_k(p.queue, queue_order(), 1).select("cell_id", "lot_id", "station_id", "top_risk_driver",
                                                "failure_probability")
    fq = p.factory_quality
    # The target is one row; its lot / station slices of the mart are joined by key.
    lot = fq.groupBy("lot_id").agg(F.avg("escalation_rate").alias("lot_mean_escalation"))
    st = fq.groupBy("station_id").agg(F.avg("escalation_rate").alias("station_mean_escalation"))
    ls = fq.select("lot_id", "station_id", F.col("escalation_rate").alias("lot_station_escalation"))
    return (t.join(lot, "lot_id", "left").join(st, "station_id", "left")
            .join(ls, ["lot_id", "station_id"], "left")
            .select("cell_id", "lot_id", "station_id", "top_risk_driver", "failure_probability",
                    "lot_mean_escalation", "station_mean_escalation", "lot_station_escalation"))


# ---- investigation queries ------------------------------------------------
@register("peer_batch_average", """
SELECT cell_id, batch_id,
  CAST(sum(CAST(last_soh AS DECIMAL(38,12))) OVER b AS DOUBLE) / count(last_soh) OVER b AS batch_avg_soh,
  CAST(sum(CAST(capacity_fade_rate AS DECIMAL(38,12))) OVER b AS DOUBLE) / count(capacity_fade_rate) OVER b AS batch_avg_fade,
  CAST(sum(CAST(resistance_growth_rate AS DECIMAL(38,12))) OVER b AS DOUBLE) / count(resistance_growth_rate) OVER b AS batch_avg_res,
  CAST(sum(CAST(failure_probability AS DECIMAL(38,12))) OVER b AS DOUBLE) / count(failure_probability) OVER b AS batch_avg_fp
FROM health WINDOW b AS (PARTITION BY batch_id)""")
def peer_batch_average(p):
    h = p.health
    # The inputs are already rounded, so sum them as exact decimals (order-independent).
    def mean(c):
        return F.sum(F.col(c).cast("decimal(38,12)")).cast("double") / F.count(c)
    g = h.groupBy("batch_id").agg(mean("last_soh").alias("batch_avg_soh"),
                                  mean("capacity_fade_rate").alias("batch_avg_fade"),
                                  mean("resistance_growth_rate").alias("batch_avg_res"),
                                  mean("failure_probability").alias("batch_avg_fp"))
    return h.select("cell_id", "batch_id").join(g, "batch_id")


def _beyond(x: str, m: str, s: str):
    return F.col(x) - F.col(m) > F.col(s) * F.lit(1.000000001) + F.lit(1e-12) * F.abs(F.col(m))


@register("peer_signature", """
WITH b AS (
  SELECT batch_id, avg(capacity_fade_rate) AS mf, stddev_pop(capacity_fade_rate) AS sf,
    avg(resistance_growth_rate) AS mr, stddev_pop(resistance_growth_rate) AS sr,
    avg(peak_temperature_max) AS mt, stddev_pop(peak_temperature_max) AS st,
    avg(CAST(capacity_fade_rate > 0 AS DOUBLE)) AS dummy
  FROM health GROUP BY batch_id),
x AS (
  SELECT h.cell_id, h.batch_id, fe.impedance_spike_event, fe.thermal_anomaly_event,
    h.capacity_fade_rate - b.mf > b.sf * 1.000000001 + 1e-12 * abs(b.mf) AS fade_out,
    h.resistance_growth_rate - b.mr > b.sr * 1.000000001 + 1e-12 * abs(b.mr) AS res_out,
    h.peak_temperature_max - b.mt > b.st * 1.000000001 + 1e-12 * abs(b.mt) AS temp_out
  FROM health h JOIN b USING (batch_id) JOIN failure_events fe USING (cell_id)),
bo AS (SELECT batch_id, avg(CAST(fade_out OR res_out OR temp_out AS DOUBLE)) AS out_share FROM x GROUP BY batch_id)
SELECT cell_id, CASE
  WHEN res_out AND impedance_spike_event = 1 THEN 'impedance fault'
  WHEN fade_out AND NOT res_out THEN 'lithium inventory loss'
  WHEN temp_out AND thermal_anomaly_event = 1 THEN 'thermal management'
  WHEN (fade_out OR res_out OR temp_out) AND bo.out_share >= 0.5 THEN 'systemic'
  WHEN fade_out OR res_out OR temp_out THEN 'isolated defect'
  ELSE 'within peer range' END AS peer_signature
FROM x JOIN bo USING (batch_id)""")
def peer_signature(p):
    """Deviation from batch peers: an outlier is beyond 1 population sigma above the
    batch mean.  Rules in order: high growth + impedance event -> impedance fault;
    steep fade with normal resistance -> lithium inventory loss; high peak
    temperature + thermal event -> thermal management; an outlier in a batch where
    at least half the cells are outliers -> systemic; any other outlier ->
    isolated defect; else within range.  "Beyond" is strict with a relative
    tolerance, so a two-cell batch (max = mean + sigma exactly) is not an outlier."""
    h = p.health
    b = h.groupBy("batch_id").agg(
        F.avg("capacity_fade_rate").alias("mf"), F.stddev_pop("capacity_fade_rate").alias("sf"),
        F.avg("resistance_growth_rate").alias("mr"), F.stddev_pop("resistance_growth_rate").alias("sr"),
        F.avg("peak_temperature_max").alias("mt"), F.stddev_pop("peak_temperature_max").alias("st"))
    x = (h.join(b, "batch_id").join(p.failure_events.select("cell_id", "impedance_spike_event",
                                                            "thermal_anomaly_event"), "cell_id")
         .select("cell_id", "batch_id", "impedance_spike_event", "thermal_anomaly_event",
                 _beyond("capacity_fade_rate", "mf", "sf").alias("fade_out"),
                 _beyond("resistance_growth_rate", "mr", "sr").alias("res_out"),
                 _beyond("peak_temperature_max", "mt", "st").alias("temp_out")))
    any_out = F.col("fade_out") | F.col("res_out") | F.col("temp_out")
    bo = x.groupBy("batch_id").agg(F.avg(any_out.cast("double")).alias("out_share"))
    sig = (F.when(F.col("res_out") & (F.col("impedance_spike_event") == 1), "impedance fault")
           .when(F.col("fade_out") & ~F.col("res_out"), "lithium inventory loss")
           .when(F.col("temp_out") & (F.col("thermal_anomaly_event") == 1), "thermal management")
           .when(any_out & (F.col("out_share") >= 0.5), "systemic")
           .when(any_out, "isolated defect").otherwise("within peer range"))
    return x.join(bo, "batch_id").select("cell_id", sig.alias("peer_signature"))


@register("cell_trajectory_50", """
SELECT cell_id, cycle_index, discharge_capacity_ah, internal_resistance_mohm, temperature_max FROM (
  SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY cycle_index DESC) AS rk FROM cycles) WHERE rk <= 50""")
def cell_trajectory_50(p):
    c = p.cycles.select("cell_id", "cycle_index", "discharge_capacity_ah", "internal_resistance_mohm", "temperature_max")
    return per_group_tail(c, ["cell_id"], "cycle_index", 50)


@register("cell_event_lookup", """
SELECT c.cell_id, c.lot_id, c.station_id, fe.event_date, fe.event_type, fe.failure_severity, fe.escalation_required
FROM dim_cell c JOIN failure_events fe USING (cell_id)""")
def cell_event_lookup(p):
    return p.dim_cell.select("cell_id", "lot_id", "station_id").join(
        p.failure_events.select("cell_id", "event_date", "event_type", "failure_severity", "escalation_required"),
        "cell_id")


# ---- dashboards and notebooks ------------------------------------------------
@register("dashboard_kpis", f"""
SELECT count(*) AS cells, {R("avg(CAST(risk_tier IN ('High', 'Critical') AS DOUBLE)) * 100.0", 2)} AS pct_high_critical,
  {R('avg(predicted_soh)', 4)} AS mean_predicted_soh, count(*) FILTER (WHERE predicted_soh < 0.8) AS cells_below_80
FROM health""")
def dashboard_kpis(p):
    h = p.health
    return h.agg(F.count(F.lit(1)).alias("cells"),
                 r(F.avg(F.col("risk_tier").isin("High", "Critical").cast("double")) * F.lit(100.0), 2)
                 .alias("pct_high_critical"),
                 r(F.avg("predicted_soh"), 4).alias("mean_predicted_soh"),
                 F.count(F.when(F.col("predicted_soh") < 0.8, F.lit(1))).alias("cells_below_80"))


TIERS = ["Critical", "High", "Medium", "Low"]


@register("risk_by_usage", "SELECT usage_profile, " + ", ".join(
    f"count(*) FILTER (WHERE risk_tier = '{t}') AS \"{t}\"" for t in TIERS) + " FROM health GROUP BY usage_profile")
def risk_by_usage(p):
    g = p.health.groupBy("usage_profile").pivot("risk_tier", TIERS).agg(F.count(F.lit(1)))
    return g.select("usage_profile", *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in TIERS])


@register("lot_station_heatmap",
          "SELECT lot_id, station_id, max(avg_final_soh) AS avg_final_soh FROM factory_quality GROUP BY ALL")
def lot_station_heatmap(p):
    """One row per (lot, station): the stations come from the data, so a new one is never dropped."""
    return p.factory_quality.groupBy("lot_id", "station_id").agg(F.max("avg_final_soh").alias("avg_final_soh"))


@register("anomaly_mix_by_lot", f"""
SELECT lot_id, kind, rate FROM (
  SELECT lot_id, CAST(sum(CAST(escalation_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE) AS escalation,
    CAST(sum(CAST(thermal_anomaly_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE) AS thermal_anomaly,
    CAST(sum(CAST(impedance_spike_rate AS DECIMAL(38,12)) * num_cells) AS DOUBLE) / CAST(sum(num_cells) AS DOUBLE) AS impedance_spike
  FROM factory_quality GROUP BY lot_id)
UNPIVOT (rate FOR kind IN (escalation, thermal_anomaly, impedance_spike))""")
def anomaly_mix_by_lot(p):
    g = p.factory_quality.groupBy("lot_id").agg(
        weighted_rate("escalation_rate").alias("escalation"),
        weighted_rate("thermal_anomaly_rate").alias("thermal_anomaly"),
        weighted_rate("impedance_spike_rate").alias("impedance_spike"))
    return g.unpivot("lot_id", ["escalation", "thermal_anomaly", "impedance_spike"], "kind", "rate")


PROFILE_FEATURES = ["cycle_count", "soh_current", "capacity_fade_rate", "resistance_growth_rate",
                    "rolling_capacity_mean_10", "rolling_temperature_max_10", "rolling_resistance_mean_10",
                    "soh_delta_last_20_cycles", "fast_charge_ratio", "avg_depth_of_discharge",
                    "high_temp_exposure_hours", "batch_failure_rate", "station_anomaly_rate", "remaining_cycles"]


def _long_features(cycle_features):
    cf = cycle_features.select(*[F.col(c).cast("double").alias(c) for c in PROFILE_FEATURES])
    return cf.unpivot([], PROFILE_FEATURES, "feature", "value")


_LONG_SQL = ("(SELECT feature, value FROM (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PROFILE_FEATURES)
             + " FROM cycle_features) UNPIVOT (value FOR feature IN (" + ", ".join(PROFILE_FEATURES) + ")))")


@register("feature_profile", f"""
SELECT feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max
FROM {_LONG_SQL} GROUP BY feature""")
def feature_profile(p):
    wide = publish.store(p.cycle_features.select(*PROFILE_FEATURES), "profile")  # read by the sums and each quantile round
    long = _long_features(wide)
    basic = long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                        F.max("value").alias("max"))
    q = exact_quantile_columns(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["feature"], stored=True)
    return basic.join(q, "feature")


@register("feature_soh_correlation", f"""
SELECT feature, covar_samp(value, soh) / nullif(stddev_samp(value) * stddev_samp(soh), 0) AS r FROM (
  SELECT feature, value, soh FROM (SELECT soh_current AS soh, """ + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in PROFILE_FEATURES if c != "soh_current") + """ FROM cycle_features)
  UNPIVOT (value FOR feature IN (""" + ", ".join(c for c in PROFILE_FEATURES if c != "soh_current") + """)))
GROUP BY feature""")
def feature_soh_correlation(p):
    feats = [c for c in PROFILE_FEATURES if c != "soh_current"]
    cf = p.cycle_features.select(F.col("soh_current").alias("soh"), *[F.col(c).cast("double").alias(c) for c in feats])
    long = cf.unpivot(["soh"], feats, "feature", "value")
    return long.groupBy("feature").agg(correlation(F.col("value"), F.col("soh")).alias("r"))


@register("soh_box_by_usage", """
SELECT u.usage_profile, min(f.final_soh) AS min, quantile_cont(f.final_soh, 0.25) AS q1,
  quantile_cont(f.final_soh, 0.5) AS median, quantile_cont(f.final_soh, 0.75) AS q3, max(f.final_soh) AS max
FROM cell_features f JOIN usage u USING (cell_id) GROUP BY u.usage_profile""")
def soh_box_by_usage(p):
    j = p.cell_features.select("cell_id", "final_soh").join(p.usage.select("cell_id", "usage_profile"), "cell_id")
    q = exact_quantile_columns(j, "final_soh", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["usage_profile"])
    mm = j.groupBy("usage_profile").agg(F.min("final_soh").alias("min"), F.max("final_soh").alias("max"))
    return mm.join(q, "usage_profile").select("usage_profile", "min", "q1", "median", "q3", "max")


@register("severity_counts", "SELECT failure_severity, count(*) AS cells FROM failure_events GROUP BY failure_severity")
def severity_counts(p):
    return p.failure_events.groupBy("failure_severity").agg(F.count(F.lit(1)).alias("cells"))


@register("event_rates", """
SELECT avg(capacity_drop_event) AS capacity_drop_rate, avg(impedance_spike_event) AS impedance_spike_rate,
  avg(thermal_anomaly_event) AS thermal_anomaly_rate, avg(early_degradation_flag) AS early_degradation_rate
FROM failure_events""")
def event_rates(p):
    fe = p.failure_events
    return fe.agg(F.avg("capacity_drop_event").alias("capacity_drop_rate"),
                  F.avg("impedance_spike_event").alias("impedance_spike_rate"),
                  F.avg("thermal_anomaly_event").alias("thermal_anomaly_rate"),
                  F.avg("early_degradation_flag").alias("early_degradation_rate"))


@register("driver_mix_flagged", """
SELECT top_risk_driver, count(*) AS n FROM predictions WHERE risk_tier IN ('High', 'Critical') GROUP BY top_risk_driver""")
def driver_mix_flagged(p):
    return (p.predictions.where(F.col("risk_tier").isin("High", "Critical"))
            .groupBy("top_risk_driver").agg(F.count(F.lit(1)).alias("n")))


@register("multi_key_sort", """
SELECT cell_id, failure_probability, predicted_remaining_cycles, row_number() OVER (
  ORDER BY failure_probability DESC NULLS LAST, predicted_remaining_cycles ASC NULLS FIRST, cell_id) AS queue_rank FROM queue""")
def multi_key_sort(p):
    """Queue rank in report order.  The global order is a range-partitioned sort;
    the rank comes from per-partition counts (no single-partition window)."""
    from ..operators.series import ordered_positions
    q = p.queue.select("cell_id", "failure_probability", "predicted_remaining_cycles")
    # order key: probability desc, remaining asc, cell asc; blocks = 1000 probability buckets
    blk = (F.lit(1000) - F.floor(F.coalesce(F.col("failure_probability"), F.lit(-1.0)) * 1000)).cast("int")
    q = q.withColumn("_one", F.lit(0))
    out = ordered_positions(q, ["_one"], blk, [F.col("failure_probability").desc_nulls_last(),
                                               F.col("predicted_remaining_cycles").asc_nulls_first(),
                                               F.col("cell_id")], pos_col="queue_rank")
    return out.select("cell_id", "failure_probability", "predicted_remaining_cycles",
                      F.col("queue_rank").cast("long").alias("queue_rank"))
