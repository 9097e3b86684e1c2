"""No input row is cut, feature lists do not leak, the submitted checkpoint folder wins."""
import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cellpulse import config
from cellpulse.operators import evaluate, features
from cellpulse.plans import q_models
from cellpulse.plans.pipeline import Pipeline
from cellpulse.session import ensure_checkpoint_dir
from cellpulse.sources import bridge, tables

SF = "/root/testdata/sf0.001"


def test_every_line_item_lands(spark):
    landed = bridge.landing_cycles(spark, SF)
    assert landed.where(F.col("ingest_seq") % 2 == 0).count() == tables.lineitem(spark, SF).count()


@pytest.mark.parametrize("features_of, barred", [
    (config.FAILURE_FEATURES, {"batch_failure_rate", "failure_probability", "escalation_required"}),
    (config.SOH_FEATURES, {"soh_current", "capacity_fade_rate", "rolling_capacity_mean_10"}),
    (config.RUL_FEATURES, {"remaining_cycles"}),
    (config.EARLY_WARNING_FEATURES, {"final_soh", "capacity_fade_rate", "cycle_count", "batch_failure_rate"})])
def test_no_feature_leaks_the_target(features_of, barred):
    assert not barred & set(features_of) and len(set(features_of)) == len(features_of)


def test_given_checkpoint_folder_survives(tmp_path):
    named, taken = str(tmp_path), []
    context = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=taken.append, master="spark://host:1")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named), sparkContext=context)
    assert ensure_checkpoint_dir(session) == named and taken == [named]


def test_rows_without_a_group_keep_their_rate(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, None, 1)], "id int, g string, y int")
    got = dict(tuple(r) for r in features.leave_one_out_rate(df, "g", "y", "id").collect())
    assert got == {1: 0.0, 2: 1.0, 3: 0.5}


def test_empty_current_cohort_is_unknown(spark):
    df = spark.createDataFrame([(True, float(i)) for i in range(20)], "is_train boolean, x double")
    assert [r["status"] for r in evaluate.drift_table(df, ["x"]).collect()] == ["unknown"]


def test_models_have_the_published_size():
    sizes = {f: f.__defaults__ for f in (q_models.fit_soh, q_models.fit_failure_classifier)}
    assert sizes[q_models.fit_soh] == (300, 300, 30)
    assert sizes[q_models.fit_failure_classifier][-2:] == (400, 30)
    assert (config.SOH_BOOST_STEP, config.SOH_FOREST_LEAF, config.FAILURE_FOREST_LEAF) == (0.05, 3, 2)


def test_soh_model_of_lowest_rmse_is_returned(spark, monkeypatch):
    made = q_models.fit_soh(Pipeline(spark, SF).cycle_features, rounds=2, trees=2, depth=3)
    rows = made.collect()
    assert [r["model"] for r in rows] == ["LinearRegression", "GradientBoosting", "RandomForest"]
    monkeypatch.setattr(q_models, "fit_soh", lambda *_, **sizes: spark.createDataFrame(rows, made.schema))
    got = q_models.train_soh(SimpleNamespace(cycle_features=None)).collect()
    assert [r["model"] for r in got] == [min(rows, key=lambda r: (r["valid_rmse"] is None, r["valid_rmse"], r["model"]))["model"]]


def test_survival_risk_is_the_product_of_the_hazards_to_500_cycles(spark):
    rows = [(f"c{i}", 400 + 20 * i, int(i % 3 == 0), 0.1 * (i % 7), 0.5, 3.0 * i, 2.0, 0.1, "ab"[i % 2]) for i in range(24)]
    cells = spark.createDataFrame(rows, "cell_id string, duration_cycles int, event_observed int, fast_charge_ratio double, "
                                  "avg_depth_of_discharge double, high_temp_exposure_hours double, "
                                  "low_temp_exposure_hours double, station_anomaly_rate double, usage_profile string")
    model = q_models.fit_hazard(cells)
    got = {r["cell_id"]: r for r in q_models.survival_predictions(model, cells, 610).collect()}
    ends = spark.createDataFrame([(e, math.log1p(e)) for e in range(50, 651, 50)], "interval_end int, log_interval_end double")
    left, by_500 = {}, {}
    for r in model.transform(cells.crossJoin(ends)).orderBy("interval_end").collect():
        left[r["cell_id"]] = left.get(r["cell_id"], 1.0) * (1.0 - float(r["probability"][1]))
        if r["interval_end"] <= 500:
            by_500[r["cell_id"]] = 1.0 - left[r["cell_id"]]
    assert len({round(v, 9) for v in by_500.values()}) > 10
    assert {c: r["event_probability_by_500_cycles"] for c, r in got.items()} == pytest.approx(by_500)
    assert {c: r["event_probability_by_horizon"] for c, r in got.items()} == pytest.approx({c: 1 - v for c, v in left.items()})


def test_survival_top_10_ranks_the_holdout_by_risk(spark):
    got = q_models.survival_top_10_model(Pipeline(spark, SF)).collect()
    risks = [r["event_risk"] for r in got]
    assert 0 < len(got) <= 10 and risks == sorted(risks, reverse=True) and all(0 <= r <= 1 for r in risks)
