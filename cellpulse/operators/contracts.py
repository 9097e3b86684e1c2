"""Data contracts of the production tables: declared columns, conformance profile, and each table's own checks.

A check returns one row of counts.  Checks along a history (gaps, order, overlaps) run on
blocks with carried values, so a key of any size spreads over tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .carry import overlaps, running_before

# The contract's tables and columns, with the type each column must cast to.
CONTRACT: dict[str, dict[str, str]] = {
    "factory_cell_tests": {
        "cell_id": "string", "lot_id": "string", "batch_id": "string", "station_id": "string", "equipment_id": "string",
        "test_temperature_c": "double", "charge_current_a": "double", "discharge_current_a": "double"},
    "cycle_measurements": {
        "cell_id": "string", "cycle_index": "int", "voltage_mean_v": "double", "voltage_min_v": "double", "voltage_max_v": "double",
        "current_mean_a": "double", "temperature_mean_c": "double", "temperature_max_c": "double",
        "discharge_capacity_ah": "double", "charge_capacity_ah": "double", "energy_wh": "double",
        "internal_resistance_mohm": "double"},
    "usage_telemetry": {
        "usage_window_id": "bigint", "cell_id": "string", "device_id_hash": "string", "window_start_ts": "timestamp_ntz",
        "window_end_ts": "timestamp_ntz", "fast_charge_ratio": "double", "high_temp_exposure_hours": "double",
        "usage_profile": "string"},
    "station_calibration_logs": {
        "calibration_event_id": "bigint", "station_id": "string", "equipment_id": "string", "fixture_id": "string",
        "measurement_drift_pct": "double", "valid_from_ts": "timestamp_ntz", "valid_to_ts": "timestamp_ntz"},
    "impedance_measurements": {
        "impedance_measurement_id": "bigint", "cell_id": "string", "frequency_hz": "double", "re_ohm": "double", "rct_ohm": "double"},
    "failure_events": {
        "cell_id": "string", "event_type": "string", "capacity_drop_event": "int", "impedance_spike_event": "int",
        "thermal_anomaly_event": "int", "early_degradation_flag": "int", "escalation_required": "int", "failure_severity": "string"},
    "quality_holds": {
        "quality_hold_id": "bigint", "hold_scope": "string", "lot_id": "string", "station_id": "string", "cell_id": "string",
        "hold_status": "string", "release_criteria": "string", "hold_opened_ts": "timestamp_ntz", "hold_closed_ts": "timestamp_ntz"},
    "engineering_dispositions": {
        "disposition_id": "bigint", "cell_id": "string", "quality_hold_id": "bigint", "failure_event_id": "bigint",
        "final_outcome": "string", "closed_ts": "timestamp_ntz", "ingested_at": "timestamp_ntz"},
    "model_predictions": {
        "cell_id": "string", "predicted_soh": "double", "predicted_remaining_cycles": "double", "failure_probability": "double",
        "risk_tier": "string", "top_risk_driver": "string"},
    "escalation_actions": {
        "escalation_action_id": "bigint", "cell_id": "string", "action_status": "string", "review_decision": "string",
        "false_positive_flag": "boolean", "false_negative_flag": "boolean", "owner_role": "string", "opened_ts": "timestamp_ntz",
        "reviewed_ts": "timestamp_ntz", "closed_ts": "timestamp_ntz"},
}

# Legal steps of a hold's status; a history begins with open.
HOLD_STEPS = (("open", "review"), ("open", "closed"), ("review", "open"), ("review", "closed"), ("closed", "open"))


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def conformance(df: DataFrame, table: str, contract: dict[str, str]) -> DataFrame:
    """table_name, column_name, present, nulls, uncastable: one pass over ``df``; missing columns have null counts."""
    here = [c for c in contract if c in df.columns]
    sums = df.agg(*[_count(F.col(c).isNull()).alias(f"n_{c}") for c in here], *[
        _count(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(contract[c]).isNull()).alias(f"u_{c}") for c in here])
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(c in here).alias("present"),
                     (F.col(f"n_{c}") if c in here else F.lit(None).cast("long")).alias("nulls"),
                     (F.col(f"u_{c}") if c in here else F.lit(None).cast("long")).alias("uncastable")) for c in contract]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _repeats(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows beyond the first of each key."""
    return df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"))


def _beside(*one_row: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    frames = [f.withColumn("_one", F.lit(1)) for f in one_row]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, "_one")
    return out.drop("_one")


def check_calibrations(logs: DataFrame, drift_limit: float = 5.0) -> DataFrame:
    marked = overlaps(logs, ["station_id", "equipment_id"], "valid_from", "valid_to", "calibration_event_id",
                      F.date_trunc("month", F.col("valid_from")))
    return marked.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count(F.col("station_id").isNull()).alias("null_station"),
        _count(F.col("equipment_id").isNull()).alias("null_equipment"),
        _count(F.abs("measurement_drift_pct") > drift_limit).alias("drift_out_of_bounds"),
        _count(F.col("valid_to") <= F.col("valid_from")).alias("window_not_forward"),
        _count(F.col("overlaps")).alias("overlapping"))


def check_usage(windows: DataFrame) -> DataFrame:
    marked = overlaps(windows, ["cell_id"], "window_start", "window_end", "usage_window_id",
                      F.date_trunc("day", F.col("window_start")))
    ratio = F.col("fast_charge_ratio")
    return marked.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count(F.col("window_end") <= F.col("window_start")).alias("window_not_forward"),
        _count((ratio < 0) | (ratio > 1)).alias("ratio_out_of_bounds"),
        _count(F.col("high_temp_exposure_hours") < 0).alias("negative_hours"),
        _count(F.col("usage_profile").isNull()).alias("null_profile"), _count(F.col("overlaps")).alias("overlapping"))


def check_cycles(cycles: DataFrame, block_rows: int = 4096) -> DataFrame:
    """Grain, signs and ranges; arrivals out of cycle order; gaps between the cycles that have a capacity."""
    arrived = running_before(cycles, ["cell_id"], F.floor(F.col("ingest_seq") / (16 * block_rows)), ["ingest_seq", "cycle_index"],
                             {"_max": ("max", "cycle_index")})
    cap, res = F.col("discharge_capacity_ah"), F.col("internal_resistance_mohm")
    plain = arrived.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count(cap.isNull()).alias("null_capacity"), _count(cap <= 0).alias("capacity_not_positive"),
        _count(res <= 0).alias("resistance_not_positive"), _count((F.col("voltage_min") < 2.0) | (F.col("voltage_max") > 4.2)).alias("voltage_out_of_range"),
        _count(F.col("cycle_index") < F.col("_max")).alias("out_of_order"))
    held = cycles.where(cap.isNotNull()).select("cell_id", "cycle_index").distinct()
    gaps = running_before(held, ["cell_id"], F.floor(F.col("cycle_index") / block_rows), ["cycle_index"], {"_prev": ("max", "cycle_index")})
    return _beside(plain, _repeats(cycles, ["cell_id", "cycle_index"]), gaps.agg(
        _count(F.col("cycle_index") - F.col("_prev") > 1).alias("cycle_gaps")))


def check_impedance(tests: DataFrame, cells: DataFrame, frequencies: int = 6) -> DataFrame:
    plain = tests.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count(F.col("frequency_hz") <= 0).alias("frequency_not_positive"),
        _count((F.col("re_ohm") < 0) | (F.col("rct_ohm") < 0)).alias("negative_component"))
    per_cell = tests.groupBy("cell_id", "frequency_hz").agg(F.count(F.lit(1)).alias("n")).groupBy("cell_id").agg(
        F.sum("n").alias("n"), _count(F.col("frequency_hz") > 0).alias("covered"))
    known = cells.select("cell_id").distinct().withColumn("_known", F.lit(1))
    linked = per_cell.join(known, "cell_id", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("unknown_cell_rows"),
        _count(F.col("covered") < frequencies).alias("cells_without_coverage"))
    return _beside(plain, _repeats(tests, ["impedance_measurement_id"]), linked)


def check_failures(events: DataFrame, severities: list[str]) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count(F.col("cell_id").isNull()).alias("null_cell"),
        _count(~F.col("failure_severity").isin(*severities) | F.col("failure_severity").isNull()).alias("unknown_severity"),
        _count(F.col("event_type").isNull() | (F.col("event_type") == "")).alias("no_event_type"),
        _count((F.col("escalation_required") == 1) & (F.col("event_type") == "nominal_fade")).alias("escalated_without_event"))


def check_predictions(predictions: DataFrame, tiers: list[str]) -> DataFrame:
    p = F.col("failure_probability")
    plain = predictions.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count((p < 0) | (p > 1) | p.isNull()).alias("probability_out_of_range"),
        _count((F.col("predicted_soh") < 0) | (F.col("predicted_soh") > 1.2)).alias("soh_out_of_range"),
        _count(~F.col("risk_tier").isin(*tiers) | F.col("risk_tier").isNull()).alias("unknown_tier"))
    return _beside(plain, _repeats(predictions, ["cell_id"]))


def check_factory(cells: DataFrame) -> DataFrame:
    plain = cells.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        _count(F.col("cell_id").isNull() | F.col("lot_id").isNull() | F.col("station_id").isNull()).alias("null_key"),
        _count((F.col("charge_current") <= 0) | (F.col("discharge_current") <= 0)).alias("current_not_positive"),
        _count(~F.col("test_temperature").between(15.0, 26.5)).alias("temperature_out_of_range"),
        _count(F.col("test_date") < F.col("manufacturing_date")).alias("tested_before_made"))
    return _beside(plain, _repeats(cells, ["cell_id"]))


def _unknown(df: DataFrame, key: str, known: DataFrame, known_key: str, out: str) -> DataFrame:
    """One row: rows of ``df`` whose non-null ``key`` ``known`` does not have; rows are counted per key before the join."""
    used = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    there = known.select(F.col(known_key).alias(key)).distinct()
    return used.join(there, key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias(out))


def hold_steps(holds: DataFrame) -> DataFrame:
    """Each action with ``before``, the status of the action before it on the same lot, station or cell, and ``illegal``.

    Actions follow one another by opening time, then id; one without its scope's id belongs to no history."""
    scoped = F.when(F.col("hold_scope") == "lot", F.col("lot_id")).when(F.col("hold_scope") == "station", F.col("station_id")).when(
        F.col("hold_scope") == "cell", F.col("cell_id"))
    told = holds.withColumn("_of", scoped).where(F.col("_of").isNotNull()).withColumn("_status", F.coalesce("hold_status", F.lit("")))
    ran = running_before(told, ["hold_scope", "_of"], F.date_trunc("month", F.col("hold_opened_ts")),
                         ["hold_opened_ts", "quality_hold_id"], {"before": ("last", "_status")})
    legal = (F.col("before").isNull() & (F.col("_status") == "open"))
    for a, b in HOLD_STEPS:
        legal = legal | ((F.col("before") == a) & (F.col("_status") == b))
    return ran.withColumn("illegal", ~F.coalesce(legal, F.lit(False))).drop("_of", "_status")


def check_holds(holds: DataFrame) -> DataFrame:
    status, scope = F.col("hold_status"), F.col("hold_scope")
    ids = {"lot": "lot_id", "station": "station_id", "cell": "cell_id"}
    fits = F.lit(False)
    for s, own in ids.items():
        one = (scope == s) & F.col(own).isNotNull()
        for other in ids.values():
            one = one & F.col(other).isNull() if other != own else one
        fits = fits | one
    plain = holds.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        _count(status.isNull() | ~status.isin("open", "review", "closed")).alias("unknown_status"),
        _count((status == "closed") & F.col("hold_closed_ts").isNull()).alias("closed_without_time"),
        _count((status == "closed") & F.col("release_criteria").isNull()).alias("closed_without_criteria"),
        _count(F.col("hold_closed_ts") < F.col("hold_opened_ts")).alias("closed_before_opened"),
        _count(~F.coalesce(fits, F.lit(False))).alias("scope_mismatch"))
    return _beside(plain, _repeats(holds, ["quality_hold_id"]), hold_steps(holds).agg(_count(F.col("illegal")).alias("illegal_steps")))


def check_dispositions(dispositions: DataFrame, holds: DataFrame, cells: DataFrame) -> DataFrame:
    refs = [F.col(c).isNull() for c in ("cell_id", "quality_hold_id", "failure_event_id")]
    plain = dispositions.agg(
        F.count(F.lit(1)).alias("checked_rows"), _count(refs[0] & refs[1] & refs[2]).alias("without_reference"),
        _count(F.col("closed_ts").isNotNull() & F.col("final_outcome").isNull()).alias("closed_without_outcome"),
        _count(F.col("closed_ts") > F.col("ingested_at")).alias("closed_in_future"))
    return _beside(plain, _repeats(dispositions, ["disposition_id"]),
                   _unknown(dispositions, "quality_hold_id", holds, "quality_hold_id", "unknown_hold_rows"),
                   _unknown(dispositions, "cell_id", cells, "cell_id", "unknown_cell_rows"))


def check_actions(actions: DataFrame, cells: DataFrame) -> DataFrame:
    status = F.col("action_status")
    fp, fn = F.coalesce("false_positive_flag", F.lit(False)), F.coalesce("false_negative_flag", F.lit(False))
    evidence = F.col("reviewed_ts").isNotNull() & F.col("review_decision").isNotNull()
    plain = actions.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        _count(F.col("opened_ts").isNotNull() & (F.col("owner_role").isNull() | status.isNull())).alias("opened_without_owner_or_status"),
        _count((status == "closed") & F.col("review_decision").isNull()).alias("closed_without_decision"),
        _count(F.col("closed_ts") < F.col("opened_ts")).alias("closed_before_opened"),
        _count((fp | fn) & ~evidence).alias("flag_without_evidence"), _count(fp & fn).alias("both_flags"))
    return _beside(plain, _repeats(actions, ["escalation_action_id"]), _unknown(actions, "cell_id", cells, "cell_id", "unknown_cell_rows"))
