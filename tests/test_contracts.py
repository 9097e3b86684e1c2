"""Checks of holds, dispositions and escalation actions, the telemetry text files, and the models of a release."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cellpulse.operators import contracts
from cellpulse.plans import q_models
from cellpulse.sources import rawlog

T0 = dt.datetime(2024, 1, 31, 12)
HOLD = ("quality_hold_id long, hold_scope string, lot_id string, station_id string, cell_id string, hold_status string, "
        "release_criteria string, hold_opened_ts timestamp_ntz, hold_closed_ts timestamp_ntz")


def test_hold_steps_follow_each_history_over_block_borders(spark):
    r = random.Random(3)
    rows = []
    for i in range(400):
        scope = r.choice(["lot", "lot", "station", "cell"])
        own = {"lot": r.choice(["A", "A", "B", None]), "station": r.choice(["S", "T"]), "cell": f"C{r.randrange(5)}"}[scope]
        ids = {k: own if k == scope else None for k in ("lot", "station", "cell")}
        rows.append((i, scope, ids["lot"], ids["station"], ids["cell"], r.choice(["open", "review", "closed", None]), None,
                     T0 + dt.timedelta(days=r.randrange(200)), None))
    got = {x["quality_hold_id"]: x["illegal"] for x in contracts.hold_steps(spark.createDataFrame(rows, HOLD)).collect()}
    last, want = {}, {}
    for i, scope, lot, station, cell, status, _, _, _ in sorted(rows, key=lambda x: (x[7], x[0])):
        own = {"lot": lot, "station": station, "cell": cell}[scope]
        if own is None:
            continue
        before = last.get((scope, own))
        want[i] = not (status == "open" if before is None else (before, status) in contracts.HOLD_STEPS)
        last[scope, own] = status or ""
    assert got == want and any(got.values()) and not all(got.values())


def test_each_fault_of_a_hold_counts_once(spark):
    t1 = T0 + dt.timedelta(hours=1)
    rows = [(1, "lot", "A", None, None, "open", None, T0, None), (2, "lot", "A", None, None, "closed", "c", t1, None),
            (3, "station", None, "S", None, "open", None, t1, T0), (3, "cell", None, None, "C", "open", None, T0, None),
            (5, "lot", None, "S", None, "open", None, T0, None), (6, "cell", None, "S", "D", "lost", None, T0, None),
            (7, None, None, None, None, None, None, None, None), (8, "lot", "B", None, None, "closed", None, T0, t1)]
    got = contracts.check_holds(spark.createDataFrame(rows, HOLD)).first().asDict()
    assert got == {"checked_rows": 8, "unknown_status": 2, "closed_without_time": 1, "closed_without_criteria": 1,
                   "closed_before_opened": 1, "scope_mismatch": 3, "duplicate_rows": 1, "illegal_steps": 2}
    none = contracts.check_holds(spark.createDataFrame([], HOLD)).first().asDict()
    assert set(none.values()) == {0}


def test_dispositions_and_actions_count_dangling_references(spark):
    cells = spark.createDataFrame([("C1",), ("C1",), (None,)], "cell_id string")
    holds = spark.createDataFrame([(1,), (2,)], "quality_hold_id long")
    d = spark.createDataFrame(
        [(1, "C1", None, None, "scrap", T0, T0), (1, None, 9, None, None, T0, T0), (2, None, 9, 4, None, None, T0),
         (3, None, None, None, "x", T0 + dt.timedelta(days=1), T0), (4, "C2", 1, None, None, None, None)],
        "disposition_id long, cell_id string, quality_hold_id long, failure_event_id long, final_outcome string, "
        "closed_ts timestamp_ntz, ingested_at timestamp_ntz")
    assert contracts.check_dispositions(d, holds, cells).first().asDict() == {
        "checked_rows": 5, "without_reference": 1, "closed_without_outcome": 1, "closed_in_future": 1, "duplicate_rows": 1,
        "unknown_hold_rows": 2, "unknown_cell_rows": 1}
    ddl = ("escalation_action_id long, cell_id string, action_status string, review_decision string, false_positive_flag boolean, "
           "false_negative_flag boolean, owner_role string, opened_ts timestamp_ntz, reviewed_ts timestamp_ntz, closed_ts timestamp_ntz")
    a = spark.createDataFrame(
        [(1, "C1", "open", None, None, None, None, T0, None, None), (2, "C1", "closed", None, True, False, "q", T0, T0, T0),
         (3, "C9", None, "confirm", True, True, "q", T0, T0, T0 - dt.timedelta(days=1)), (3, None, "open", None, False, None, "q", T0, None, None)], ddl)
    assert contracts.check_actions(a, cells).first().asDict() == {
        "checked_rows": 4, "opened_without_owner_or_status": 2, "closed_without_decision": 1, "closed_before_opened": 1,
        "flag_without_evidence": 1, "both_flags": 1, "duplicate_rows": 1, "unknown_cell_rows": 1}


def test_telemetry_text_is_written_once_and_shows_every_reason(spark):
    from cellpulse.plans.pipeline import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    path = p.raw_log_path
    assert p.raw_log_path == path and spark.read.text(path).where(F.col("value").startswith("#")).count() == 2
    parsed = rawlog.parse_raw_log(rawlog.scan_raw_log(spark, path))
    assert parsed.count() == p.landing_cycles.count()
    reasons = {x["reason"]: x["rows"] for x in rawlog.raw_log_reasons(parsed).collect()}
    counts = {"bad_voltage": F.col("discharge_capacity_ah").isNull(), "bad_temperature": F.col("ingest_seq") % 2 == 1,
              "bad_current": F.col("internal_resistance_mohm") < 0, "missing_timestamp": F.col("voltage_min") < 2.82,
              "missing_station": F.col("temperature_max") > 47.5, "missing_cell": F.col("temperature_max") < 29.0}
    landed = p.landing_cycles.agg(*[F.count(F.when(c, 1)).alias(k) for k, c in counts.items()]).first().asDict()
    assert reasons == {k: n for k, n in landed.items() if n} and len(reasons) >= 5


def test_best_regressor_takes_the_line_for_a_line(spark):
    r = random.Random(2)
    rows = [(f"C{i % 40}", a := r.random(), b := r.random(), 3 * a - b if i else None) for i in range(400)]
    df = spark.createDataFrame(rows, "cell_id string, a double, b double, y double")
    name, model = q_models.best_regressor(df, ["a", "b"], "y", rounds=2, trees=2, depth=3, step=0.2)
    assert name == "LinearRegression"
    got = model.transform(df.where("y is not null")).select(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert got == pytest.approx(0, abs=1e-6)
    shares = dict(q_models._importance(model, ["a", "b"]))
    assert sum(shares.values()) == pytest.approx(1) and shares["a"] > shares["b"]


def test_long_metrics_leaves_the_confusion_matrix_out(spark):
    df = spark.createDataFrame([(0.5, None, 3, 1, 2, 0)], "f1 double, roc_auc double, tp long, fp long, tn long, fn long")
    assert [tuple(x) for x in q_models.long_metrics(df, "T", "m").collect()] == [("T", "m", "f1", 0.5), ("T", "m", "roc_auc", None)]
