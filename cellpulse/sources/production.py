"""Production-shaped tables from the driver's tables: test outcomes, calibration logs, telemetry windows, impedance tests.

Each is a fixed projection of one table's own columns (FIXTURES.md), its defects come from those columns too.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables


def _code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _minutes(base: str, minutes: Column) -> Column:
    return F.col(base).cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))


def test_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: a cell test with station, lot, protocol, start and pass/fail."""
    li = tables.read_table(spark, sf_dir, "lineitem", ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                       "l_returnflag", "l_shipdate"))
    fail = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30)
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("test_id"), _code("ST-", F.col("l_suppkey") % 8 + 1).alias("station_id"),
        _code("LOT-", F.col("l_partkey") % 12 + 1).alias("lot_id"), _code("P", F.col("l_linenumber") % 3).alias("protocol_id"),
        _minutes("l_shipdate", F.col("l_orderkey") * 37 % 1440).alias("test_start"), fail.cast("int").alias("failed"),
        F.col("l_quantity").alias("load_a"))


def calibration_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: a calibration with its validity window; some lack a station or end before they start."""
    o = tables.read_table(spark, sf_dir, "orders", ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"))
    k = F.col("o_orderkey")
    start = _minutes("o_orderdate", k * 11 % 1440)
    hours = F.when(k % 251 == 0, -1).otherwise(F.col("o_custkey") % 5 + 1)
    return o.select(
        k.alias("calibration_event_id"), F.when(k % 97 != 0, _code("ST-", F.col("o_custkey") % 8 + 1)).alias("station_id"),
        _code("EQ-", F.col("o_custkey") % 60).alias("equipment_id"),
        (F.col("o_totalprice") / 50000.0 - 4.0).alias("measurement_drift_pct"), start.alias("valid_from"),
        (start + F.make_dt_interval(hours=hours.cast("int"))).alias("valid_to"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("open_issue"))


def usage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: a telemetry window of a device."""
    e = tables.events(spark, sf_dir)
    return e.select(
        F.col("event_id").alias("usage_window_id"), _code("CELL-", F.col("user_id")).alias("cell_id"),
        F.col("ts").cast("timestamp_ntz").alias("window_start"),
        (F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.floor("value") - 2).cast("int"))).alias("window_end"),
        (F.col("value") / 60.0).alias("fast_charge_ratio"), (F.col("value") - 1.0).alias("high_temp_exposure_hours"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("usage_profile"))


def impedance_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: an impedance test at one of seven frequencies, 0 Hz being a defect; every 50th supplier is no cell."""
    li = tables.read_table(spark, sf_dir, "lineitem", ("l_orderkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_quantity"))
    k = F.col("l_suppkey")
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("impedance_measurement_id"),
        F.when(k % 50 == 49, _code("UNKNOWN-", k)).otherwise(F.concat(F.lit("CELL-"), F.lpad((k + 1).cast("string"), 5, "0"))).alias("cell_id"),
        ((F.col("l_linenumber") - 1) * 10.0).alias("frequency_hz"), (F.col("l_discount") - 0.005).alias("re_ohm"),
        (F.col("l_tax") + 0.01).alias("rct_ohm"))


def quality_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: a hold action on a lot, a station or a cell; some lack their scope's id, criteria or closing time."""
    o = tables.read_table(spark, sf_dir, "orders", ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    opened, closed = _minutes("o_orderdate", k * 11 % 1440), F.col("o_orderstatus") == "F"
    status = F.when(closed, "closed").when(F.col("o_orderstatus") == "O", "open").otherwise("review")
    return o.select(
        k.alias("quality_hold_id"), F.element_at(F.array(*map(F.lit, ("lot", "station", "cell"))), (k % 3 + 1).cast("int")).alias("hold_scope"),
        F.when((k % 3 == 0) & (k % 83 != 0), _code("LOT-", c % 12 + 1)).alias("lot_id"),
        F.when((k % 3 == 1) | (k % 101 == 0), _code("ST-", c % 8 + 1)).alias("station_id"),
        F.when(k % 3 == 2, F.concat(F.lit("CELL-"), F.lpad((c % 100 + 1).cast("string"), 5, "0"))).alias("cell_id"),
        status.alias("hold_status"), F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("release_criteria"),
        opened.alias("hold_opened_ts"),
        F.when(closed & (c % 41 != 0), opened + F.make_dt_interval(hours=(c % 30 - 1).cast("int"))).alias("hold_closed_ts"))


def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: a disposition of a hold, a cell or a failure event; every 50th part names a hold that is none."""
    li = tables.read_table(spark, sf_dir, "lineitem", ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                                                       "l_linestatus", "l_shipdate"))
    n, s, part = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    return li.select(
        (F.col("l_orderkey") * 100 + n).alias("disposition_id"),
        F.when(n % 3 == 1, F.when(s % 50 == 49, _code("UNKNOWN-", s)).otherwise(
            F.concat(F.lit("CELL-"), F.lpad((s + 1).cast("string"), 5, "0")))).alias("cell_id"),
        F.when(n % 3 == 0, F.when(part % 50 == 0, -1 - part).otherwise(F.col("l_orderkey"))).alias("quality_hold_id"),
        F.when((n % 3 == 2) & (part % 17 != 0), s).alias("failure_event_id"),
        F.when(F.col("l_returnflag") == "R", "scrap").when(F.col("l_returnflag") == "A", "release").alias("final_outcome"),
        F.when(F.col("l_linestatus") == "F", ship + F.make_dt_interval(days=(part % 12).cast("int"))).alias("closed_ts"),
        (ship + F.make_dt_interval(days=F.lit(10))).alias("ingested_at"))


def escalation_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: an escalation action; some lack an owner, a status, a decision or the time of their review."""
    e = tables.events(spark, sf_dir)
    i, v, kind = F.col("event_id"), F.col("value"), F.col("event_type")
    seen, opened = kind.isin("click", "purchase"), F.col("ts").cast("timestamp_ntz")
    return e.select(
        i.alias("escalation_action_id"), F.concat(F.lit("CELL-"), F.lpad((F.col("user_id") + 1).cast("string"), 5, "0")).alias("cell_id"),
        F.when(kind == "purchase", "closed").when(kind == "click", "reviewed").when(kind != "error", "open").alias("action_status"),
        F.when(seen & (v >= 10.0), F.when(i % 3 == 0, "dismiss").otherwise("confirm")).alias("review_decision"),
        (v > 60.0).alias("false_positive_flag"), ((v > 50.0) & (v < 62.0)).alias("false_negative_flag"),
        F.when(v >= 2.0, F.when(i % 2 == 0, "quality").otherwise("reliability")).alias("owner_role"), opened.alias("opened_ts"),
        F.when(seen & (i % 7 != 0), opened + F.make_dt_interval(hours=F.lit(1))).alias("reviewed_ts"),
        F.when(kind == "purchase", opened + F.make_dt_interval(mins=(F.floor("value") - 2).cast("int"))).alias("closed_ts"))


# The same tables in the oracle's SQL.
SQL = r"""
holds AS (
  SELECT o_orderkey AS quality_hold_id, ['lot', 'station', 'cell'][o_orderkey % 3 + 1] AS hold_scope,
    CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 83 <> 0 THEN 'LOT-' || (o_custkey % 12 + 1) END AS lot_id,
    CASE WHEN o_orderkey % 3 = 1 OR o_orderkey % 101 = 0 THEN 'ST-' || (o_custkey % 8 + 1) END AS station_id,
    CASE WHEN o_orderkey % 3 = 2 THEN 'CELL-' || lpad(CAST(o_custkey % 100 + 1 AS VARCHAR), 5, '0') END AS cell_id,
    CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'review' END AS hold_status,
    nullif(o_orderpriority, '4-NOT SPECIFIED') AS release_criteria,
    o_orderdate + to_minutes(CAST(o_orderkey * 11 % 1440 AS BIGINT)) AS hold_opened_ts,
    CASE WHEN o_orderstatus = 'F' AND o_custkey % 41 <> 0 THEN
      o_orderdate + to_minutes(CAST(o_orderkey * 11 % 1440 + 60 * (o_custkey % 30 - 1) AS BIGINT)) END AS hold_closed_ts
  FROM orders),
dispositions AS (
  SELECT l_orderkey * 100 + l_linenumber AS disposition_id,
    CASE WHEN l_linenumber % 3 <> 1 THEN NULL WHEN l_suppkey % 50 = 49 THEN 'UNKNOWN-' || l_suppkey
      ELSE 'CELL-' || lpad(CAST(l_suppkey + 1 AS VARCHAR), 5, '0') END AS cell_id,
    CASE WHEN l_linenumber % 3 <> 0 THEN NULL WHEN l_partkey % 50 = 0 THEN -1 - l_partkey ELSE l_orderkey END AS quality_hold_id,
    CASE WHEN l_linenumber % 3 = 2 AND l_partkey % 17 <> 0 THEN l_suppkey END AS failure_event_id,
    CASE l_returnflag WHEN 'R' THEN 'scrap' WHEN 'A' THEN 'release' END AS final_outcome,
    CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_days(CAST(l_partkey % 12 AS INTEGER)) END AS closed_ts,
    l_shipdate + INTERVAL 10 day AS ingested_at
  FROM lineitem),
actions AS (
  SELECT event_id AS escalation_action_id, 'CELL-' || lpad(CAST(user_id + 1 AS VARCHAR), 5, '0') AS cell_id,
    CASE event_type WHEN 'purchase' THEN 'closed' WHEN 'click' THEN 'reviewed' WHEN 'error' THEN NULL ELSE 'open' END AS action_status,
    CASE WHEN event_type IN ('click', 'purchase') AND value >= 10 THEN if(event_id % 3 = 0, 'dismiss', 'confirm') END AS review_decision,
    value > 60 AS false_positive_flag, value > 50 AND value < 62 AS false_negative_flag,
    CASE WHEN value >= 2 THEN if(event_id % 2 = 0, 'quality', 'reliability') END AS owner_role, ts AS opened_ts,
    CASE WHEN event_type IN ('click', 'purchase') AND event_id % 7 <> 0 THEN ts + INTERVAL 1 hour END AS reviewed_ts,
    CASE WHEN event_type = 'purchase' THEN ts + to_minutes(CAST(floor(value) - 2 AS BIGINT)) END AS closed_ts
  FROM events),
outcomes AS (
  SELECT l_orderkey * 100 + l_linenumber AS test_id, 'ST-' || (l_suppkey % 8 + 1) AS station_id, 'LOT-' || (l_partkey % 12 + 1) AS lot_id,
    'P' || (l_linenumber % 3) AS protocol_id, l_shipdate + to_minutes(CAST(l_orderkey * 37 % 1440 AS BIGINT)) AS test_start,
    CAST(l_returnflag = 'R' AND l_quantity > 30 AS INTEGER) AS failed, l_quantity AS load_a
  FROM lineitem),
cal AS (
  SELECT *, valid_from + to_hours(h) AS valid_to FROM (
    SELECT o_orderkey AS calibration_event_id, CASE WHEN o_orderkey % 97 <> 0 THEN 'ST-' || (o_custkey % 8 + 1) END AS station_id,
      'EQ-' || (o_custkey % 60) AS equipment_id, o_totalprice / 50000.0::DOUBLE - 4.0::DOUBLE AS measurement_drift_pct,
      o_orderdate + to_minutes(CAST(o_orderkey * 11 % 1440 AS BIGINT)) AS valid_from,
      CAST(CASE WHEN o_orderkey % 251 = 0 THEN -1 ELSE o_custkey % 5 + 1 END AS BIGINT) AS h,
      CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS open_issue
    FROM orders)),
windows AS (
  SELECT event_id AS usage_window_id, 'CELL-' || user_id AS cell_id, ts AS window_start,
    ts + to_minutes(CAST(floor(value) - 2 AS BIGINT)) AS window_end, value / 60.0::DOUBLE AS fast_charge_ratio,
    value - 1.0::DOUBLE AS high_temp_exposure_hours, CASE WHEN event_type <> 'error' THEN event_type END AS usage_profile
  FROM events),
impedance AS (
  SELECT l_orderkey * 100 + l_linenumber AS impedance_measurement_id,
    CASE WHEN l_suppkey % 50 = 49 THEN 'UNKNOWN-' || l_suppkey ELSE 'CELL-' || lpad(CAST(l_suppkey + 1 AS VARCHAR), 5, '0') END AS cell_id,
    (l_linenumber - 1) * 10.0::DOUBLE AS frequency_hz, l_discount - 0.005::DOUBLE AS re_ohm, l_tax + 0.01::DOUBLE AS rct_ohm
  FROM lineitem)
"""
