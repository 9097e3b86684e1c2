"""Public aging-data operators on raw signal samples.

Signals come from the ``events`` table: ``user_id`` is the battery, each hour
of events is one cycle (hours 0, 1, 2 mod 3 are charge, discharge and
impedance cycles), and each event is a sample with ``temp = 20 + value / 5``
and ``volt = 4.2 - value / 100`` at ``t`` seconds into the hour.  A discharge
cycle's capacity is ``2 (1 - 0.0006 hour) + 0.002 (mean volt - 4)``.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config
from ..functions.scalar import validation_note
from ..operators.reports import correlation
from ..operators.series import ordered_positions
from ..sources import tables
from .registry import register

# ---- oracle text -----------------------------------------------------------------
PUB_SQL = """
smp AS (
  SELECT 'B' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS battery_id,
    CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS INTEGER) AS cycle_pos,
    CAST(minute(ts) * 60 + second(ts) AS DOUBLE) AS t,
    20.0::DOUBLE + value / 5.0::DOUBLE AS temp, 4.2::DOUBLE - value / 100.0::DOUBLE AS volt
  FROM events),
sig AS (
  SELECT battery_id, cycle_pos,
    CASE cycle_pos % 3 WHEN 0 THEN 'charge' WHEN 1 THEN 'discharge' ELSE 'impedance' END AS type,
    count(*) AS n_samples, max(temp) AS max_temp_c, avg(temp) AS mean_temp_c, min(volt) AS min_voltage_v,
    max(volt) AS max_voltage_v,
    CASE WHEN count(*) >= 3 THEN regr_slope(temp, t) END AS temp_slope,
    CASE WHEN count(*) >= 3 THEN regr_slope(volt, t) END AS voltage_slope,
    avg(volt) AS mean_voltage_v
  FROM smp GROUP BY battery_id, cycle_pos),
typed AS (
  SELECT *, last(CASE WHEN type = 'charge' THEN max_temp_c END IGNORE NULLS) OVER (
      PARTITION BY battery_id ORDER BY cycle_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_charge_temp
  FROM sig),
dis AS (
  SELECT battery_id, cycle_pos,
    CAST(row_number() OVER (PARTITION BY battery_id ORDER BY cycle_pos) - 1 AS INTEGER) AS cycle_index,
    2.0::DOUBLE * (1.0::DOUBLE - 0.0006::DOUBLE * cycle_pos) + 0.002::DOUBLE * (mean_voltage_v - 4.0::DOUBLE) AS capacity_ah,
    max_temp_c AS max_discharge_temp_c, last_charge_temp AS max_charge_temp_c,
    temp_slope AS discharge_temp_slope, voltage_slope
  FROM typed WHERE type = 'discharge'),
dsoh AS (
  SELECT d.*, d.capacity_ah / arg_min(capacity_ah, cycle_index) OVER (PARTITION BY battery_id) AS soh
  FROM dis d),
pubcyc AS (
  SELECT 'events' AS source_dataset, 'event_samples' AS source_adapter, battery_id, cycle_index, capacity_ah, soh,
    CAST(greatest(coalesce(min(cycle_index) FILTER (WHERE soh < 0.8) OVER (PARTITION BY battery_id),
                           max(cycle_index) OVER (PARTITION BY battery_id)) - cycle_index, 0) AS INTEGER) AS remaining_cycles,
    max_discharge_temp_c, max_charge_temp_c, discharge_temp_slope, voltage_slope
  FROM dsoh),
rollup AS (
  SELECT battery_id, CAST(max(cycle_index) + 1 AS INTEGER) AS cycles,
    arg_min(capacity_ah, cycle_index) AS initial_capacity_ah, arg_max(capacity_ah, cycle_index) AS final_capacity_ah,
    (arg_min(capacity_ah, cycle_index) - arg_max(capacity_ah, cycle_index)) / arg_min(capacity_ah, cycle_index) AS capacity_loss_pct,
    min(cycle_index) FILTER (WHERE soh < 0.8) AS first_cycle_below_80pct_soh,
    CASE WHEN count(*) > 2 THEN covar_samp(CAST(cycle_index AS DOUBLE), capacity_ah)
         / nullif(stddev_samp(CAST(cycle_index AS DOUBLE)) * stddev_samp(capacity_ah), 0) END AS capacity_cycle_corr,
    avg(max_discharge_temp_c) AS mean_discharge_temp_c, max(max_discharge_temp_c) AS max_discharge_temp_c,
    max(max_charge_temp_c) AS max_charge_temp_c
  FROM pubcyc GROUP BY battery_id)
"""


def _pub(select: str) -> str:
    return "SELECT * FROM (WITH " + PUB_SQL.strip() + "\n" + select + ")"


_NOTE_SQL = """CASE WHEN cycles < 10 THEN 'Very short discharge sequence; useful for parser coverage only.'
  WHEN capacity_loss_pct < -0.05 THEN 'Capacity increases versus first discharge; review protocol/first-cycle normalization before fade modeling.'
  WHEN capacity_cycle_corr > 0.25 THEN 'Positive capacity trend; not a simple capacity-fade validation case.'
  WHEN capacity_loss_pct < 0 THEN 'Slight capacity gain versus first discharge; use cautiously.'
  WHEN capacity_loss_pct >= 0.05 AND capacity_cycle_corr < -0.5 THEN 'Clear capacity-fade validation case.'
  ELSE 'Parsed real cycle data; limited fade signal in this window.' END"""


# ---- Spark side ------------------------------------------------------------------
def _samples(p):
    e = tables.events(p.spark, p.sf_dir)
    ts = F.col("ts")
    return e.select(
        F.concat(F.lit("B"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("battery_id"),
        (F.datediff(F.to_date(ts), F.to_date(F.lit("2024-01-01"))) * 24 + F.hour(ts)).cast("int").alias("cycle_pos"),
        (F.minute(ts) * 60 + F.second(ts)).cast("double").alias("t"),
        (F.lit(20.0) + F.col("value") / F.lit(5.0)).alias("temp"),
        (F.lit(4.2) - F.col("value") / F.lit(100.0)).alias("volt"))


def _signal_summary(p):
    s = _samples(p)
    n = F.count(F.lit(1))
    g = s.groupBy("battery_id", "cycle_pos").agg(
        n.alias("n_samples"), F.max("temp").alias("max_temp_c"), F.avg("temp").alias("mean_temp_c"),
        F.min("volt").alias("min_voltage_v"), F.max("volt").alias("max_voltage_v"),
        F.when(n >= 3, F.regr_slope("temp", "t")).alias("temp_slope"),
        F.when(n >= 3, F.regr_slope("volt", "t")).alias("voltage_slope"),
        F.avg("volt").alias("mean_voltage_v"))
    kind = (F.when(F.col("cycle_pos") % 3 == 0, "charge").when(F.col("cycle_pos") % 3 == 1, "discharge")
            .otherwise("impedance"))
    return g.withColumn("type", kind)


def _public_cycles(p):
    sig = _signal_summary(p)
    # Carry the latest charge peak onto later cycles (one row per cycle, not per sample).
    w = Window.partitionBy("battery_id").orderBy("cycle_pos").rowsBetween(Window.unboundedPreceding, 0)
    typed = sig.withColumn("last_charge_temp",
                           F.last(F.when(F.col("type") == "charge", F.col("max_temp_c")), ignorenulls=True).over(w))
    dis = typed.where(F.col("type") == "discharge")
    dis = ordered_positions(dis, ["battery_id"], F.floor(F.col("cycle_pos") / 256), [F.col("cycle_pos")], "pos")
    dis = dis.select(
        "battery_id", (F.col("pos") - 1).cast("int").alias("cycle_index"),
        (F.lit(2.0) * (F.lit(1.0) - F.lit(0.0006) * F.col("cycle_pos"))
         + F.lit(0.002) * (F.col("mean_voltage_v") - F.lit(4.0))).alias("capacity_ah"),
        F.col("max_temp_c").alias("max_discharge_temp_c"), F.col("last_charge_temp").alias("max_charge_temp_c"),
        F.col("temp_slope").alias("discharge_temp_slope"), "voltage_slope")
    first = dis.groupBy("battery_id").agg(F.min_by("capacity_ah", "cycle_index").alias("_first"))
    d = dis.join(first, "battery_id").withColumn("soh", F.col("capacity_ah") / F.col("_first"))
    ends = d.groupBy("battery_id").agg(
        F.min(F.when(F.col("soh") < config.SOH_EOL_THRESHOLD, F.col("cycle_index"))).alias("_eol"),
        F.max("cycle_index").alias("_last"))
    d = d.join(ends, "battery_id")
    rem = F.greatest(F.coalesce(F.col("_eol"), F.col("_last")) - F.col("cycle_index"), F.lit(0)).cast("int")
    return d.select(F.lit("events").alias("source_dataset"), F.lit("event_samples").alias("source_adapter"),
                    "battery_id", "cycle_index", "capacity_ah", "soh", rem.alias("remaining_cycles"),
                    "max_discharge_temp_c", "max_charge_temp_c", "discharge_temp_slope", "voltage_slope")


def _rollup(p):
    c = _public_cycles(p)
    ci = F.col("cycle_index").cast("double")
    init = F.min_by("capacity_ah", "cycle_index")
    fin = F.max_by("capacity_ah", "cycle_index")
    r = c.groupBy("battery_id").agg(
        (F.max("cycle_index") + 1).cast("int").alias("cycles"),
        init.alias("initial_capacity_ah"), fin.alias("final_capacity_ah"),
        ((init - fin) / init).alias("capacity_loss_pct"),
        F.min(F.when(F.col("soh") < config.SOH_EOL_THRESHOLD, F.col("cycle_index"))).alias("first_cycle_below_80pct_soh"),
        F.when(F.count(F.lit(1)) > 2, correlation(ci, F.col("capacity_ah"))).alias("capacity_cycle_corr"),
        F.avg("max_discharge_temp_c").alias("mean_discharge_temp_c"),
        F.max("max_discharge_temp_c").alias("max_discharge_temp_c"),
        F.max("max_charge_temp_c").alias("max_charge_temp_c"))
    return r


@register("signal_summary", _pub("SELECT * EXCLUDE (mean_voltage_v) FROM sig"))
def signal_summary(p):
    return _signal_summary(p).drop("mean_voltage_v")


@register("last_charge_temp", _pub("SELECT battery_id, cycle_pos, last_charge_temp FROM typed"))
def last_charge_temp(p):
    sig = _signal_summary(p)
    w = Window.partitionBy("battery_id").orderBy("cycle_pos").rowsBetween(Window.unboundedPreceding, 0)
    return sig.select("battery_id", "cycle_pos", F.last(F.when(F.col("type") == "charge", F.col("max_temp_c")),
                                                          ignorenulls=True).over(w).alias("last_charge_temp"))


@register("discharge_index", _pub("SELECT battery_id, cycle_pos, cycle_index FROM dis"))
def discharge_index(p):
    d = _signal_summary(p).where(F.col("type") == "discharge")
    d = ordered_positions(d, ["battery_id"], F.floor(F.col("cycle_pos") / 256), [F.col("cycle_pos")], "pos")
    return d.select("battery_id", "cycle_pos", (F.col("pos") - 1).cast("int").alias("cycle_index"))


@register("normalise_public_cycles", _pub("SELECT * FROM pubcyc"))
def normalise_public_cycles(p):
    return _public_cycles(p)


@register("soh_vs_first", _pub("SELECT battery_id, cycle_index, soh FROM pubcyc"))
def soh_vs_first(p):
    return _public_cycles(p).select("battery_id", "cycle_index", "soh")


@register("discharge_remaining", _pub("SELECT battery_id, cycle_index, remaining_cycles FROM pubcyc"))
def discharge_remaining(p):
    return _public_cycles(p).select("battery_id", "cycle_index", "remaining_cycles")


@register("battery_rollup", _pub(f"SELECT *, {_NOTE_SQL} AS validation_note FROM rollup"))
def battery_rollup(p):
    r = _rollup(p)
    return r.withColumn("validation_note", validation_note(F.col("cycles"), F.col("capacity_loss_pct"),
                                                           F.col("capacity_cycle_corr")))


@register("validation_note", _pub(f"SELECT battery_id, {_NOTE_SQL} AS validation_note FROM rollup"))
def validation_note_q(p):
    r = _rollup(p)
    return r.select("battery_id", validation_note(F.col("cycles"), F.col("capacity_loss_pct"),
                                                  F.col("capacity_cycle_corr")).alias("validation_note"))


@register("temperature_summary", _pub("""
SELECT 'mean' AS metric, avg(max_discharge_temp_c) AS max_discharge_temp_c, avg(max_charge_temp_c) AS max_charge_temp_c FROM pubcyc
UNION ALL SELECT 'min', min(max_discharge_temp_c), min(max_charge_temp_c) FROM pubcyc
UNION ALL SELECT 'max', max(max_discharge_temp_c), max(max_charge_temp_c) FROM pubcyc"""))
def temperature_summary(p):
    c = _public_cycles(p)
    a = c.agg(F.avg("max_discharge_temp_c").alias("mean_d"), F.avg("max_charge_temp_c").alias("mean_c"),
              F.min("max_discharge_temp_c").alias("min_d"), F.min("max_charge_temp_c").alias("min_c"),
              F.max("max_discharge_temp_c").alias("max_d"), F.max("max_charge_temp_c").alias("max_c"))
    return a.select(F.explode(F.array(
        F.struct(F.lit("mean").alias("metric"), F.col("mean_d").alias("max_discharge_temp_c"), F.col("mean_c").alias("max_charge_temp_c")),
        F.struct(F.lit("min").alias("metric"), F.col("min_d").alias("max_discharge_temp_c"),
                 F.col("min_c").alias("max_charge_temp_c")),
        F.struct(F.lit("max").alias("metric"), F.col("max_d").alias("max_discharge_temp_c"),
                 F.col("max_c").alias("max_charge_temp_c")))).alias("s")).select("s.*")


@register("coverage_snapshot", _pub(f"""
SELECT (SELECT count(DISTINCT battery_id) FROM pubcyc) AS batteries, (SELECT count(*) FROM pubcyc) AS cycle_rows,
  (SELECT count(*) FROM rollup WHERE {_NOTE_SQL} = 'Clear capacity-fade validation case.') AS clear_fade_batteries"""))
def coverage_snapshot(p):
    c = _public_cycles(p)
    r = battery_rollup(p)
    clear = r.select(F.count(F.when(F.col("validation_note") == "Clear capacity-fade validation case.", 1))).scalar()
    return c.agg(F.count_distinct("battery_id").alias("batteries"), F.count(F.lit(1)).alias("cycle_rows"),
                 clear.alias("clear_fade_batteries"))
