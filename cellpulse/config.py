"""Fixed values that the results depend on.

These are the thresholds, window sizes and tier cut points of the cell
reliability pipeline.  They are plain numbers, kept together so that every
operator and every oracle query reads the same values.
"""

# --- fixed values (must equal the published pipeline for equal results) ---
SOH_EOL_THRESHOLD = 0.80          # state of health at end of life
EARLY_DEGRADATION_SOH = 0.90      # "early" degradation level
ROLLING_WINDOW = 10               # trailing rows for rolling means / max
SOH_DELTA_WINDOW = 20             # rows back for the SOH delta
INITIAL_ROWS = 5                  # rows averaged for initial capacity / resistance
EARLY_WINDOW_ROWS = 50            # rows in the early-warning window
EARLY_SOH_ROW = 20                # row position of the early SOH snapshot
TAIL_FRACTION = 0.75              # projection uses rows from position floor(0.75 n)
FLAT_SLOPE = -1e-6                # slope used when the tail is too short / flat
RISK_TIERS = (("Critical", 0.80), ("High", 0.55), ("Medium", 0.30))  # else Low
TEST_FRACTION = 0.25
RELEASE_TRAIN_FRACTION = 0.70
SEED = 42
MAX_LIFE_CYCLES = 650
EARLY_LIFE_FRACTION = 0.35        # early flag: first SOH<0.90 before 0.35 * 650 rows
CAPACITY_DROP_STEP = -0.02        # a step below this is a capacity drop
THERMAL_PEAK_C = 48.0             # peak temperature above this is a thermal anomaly
SEVERITY_WEIGHTS = {              # severity score = 3*(1-final_soh) + weights
    "soh_loss": 3.0,
    "early_degradation": 1.2,
    "capacity_drop": 0.9,
    "impedance_spike": 1.1,
    "thermal_anomaly": 0.8,
}
SEVERITY_CUTS = (("critical", 2.4), ("high", 1.6), ("medium", 0.9))  # else low
HAZARD_INTERVAL = 50              # cycles per person-period
RISK_HORIZON_CYCLES = 500
PSI_BINS = 10
PSI_WATCH = 0.10
PSI_ALERT = 0.25
PSI_FLOOR = 1e-6
FN_COST = 5.0
FP_COST = 1.0
THRESHOLD_START = 0.20
THRESHOLD_STEP = 0.05
THRESHOLD_COUNT = 13
CALIBRATION_BINS = 5
SOH_QC_RANGE = (0.40, 1.05)
SOH_CLIP = (0.0, 1.05)
DEFAULT_FLEET_FADE = 0.0004
MIN_RUL_CAP = 500.0
TEST_CONDITION_TEMPERATURE = 25.0
NOMINAL_CAPACITY_AH = 3.50
NOMINAL_RESISTANCE_MOHM = 25.0
NOMINAL_VOLTAGE_V = 3.70

# Monitored drift features, in report order.
DRIFT_FEATURES = (
    "final_soh",
    "capacity_fade_rate",
    "resistance_growth_rate",
    "peak_temperature_max",
    "fast_charge_ratio",
    "high_temp_exposure_hours",
    "failure_probability",
)

# Feature lists of the four models.
SOH_FEATURES = (
    "cycle_count", "resistance_growth_rate", "rolling_resistance_mean_10",
    "rolling_temperature_max_10", "fast_charge_ratio", "avg_depth_of_discharge",
    "high_temp_exposure_hours", "batch_failure_rate", "station_anomaly_rate",
)
RUL_FEATURES = (
    "soh_current", "capacity_fade_rate", "resistance_growth_rate", "soh_delta_last_20_cycles",
    "cycle_count", "rolling_resistance_mean_10", "rolling_temperature_max_10",
    "fast_charge_ratio", "high_temp_exposure_hours", "batch_failure_rate", "station_anomaly_rate",
)
# Without batch_failure_rate, which embeds the target.
FAILURE_FEATURES = (
    "final_soh", "capacity_fade_rate", "resistance_growth_rate", "peak_temperature_max",
    "mean_temperature_max", "cycle_count", "fast_charge_ratio", "avg_depth_of_discharge",
    "high_temp_exposure_hours", "low_temp_exposure_hours", "station_anomaly_rate",
)
EARLY_WARNING_FEATURES = (
    "early_cycle_count", "soh_at_cycle_20", "soh_at_cycle_50", "capacity_fade_rate_50",
    "resistance_growth_rate_50", "resistance_mean_50", "temperature_mean_50",
    "temperature_max_50", "voltage_min_50", "test_temperature", "charge_current",
    "discharge_current", "station_anomaly_rate",
)
SURVIVAL_NUMERIC = (
    "fast_charge_ratio", "avg_depth_of_discharge", "high_temp_exposure_hours",
    "low_temp_exposure_hours", "station_anomaly_rate",
)

# A stated logistic hazard of an interval: the survival queries that SQL repeats use it in place of a fitted one.
STATED_HAZARD = {"intercept": -9.0, "log_interval_end": 0.9, "fast_charge_ratio": 1.5, "avg_depth_of_discharge": 0.5,
                 "high_temp_exposure_hours": 0.002, "low_temp_exposure_hours": 0.001, "station_anomaly_rate": 2.0}

# The release gate: largest loss of recall on the later cells, largest share of them under review.
MAX_RECALL_DROP = 0.1
MAX_REVIEW_SHARE = 0.5

# Sizes of the fitted models.
SOH_BOOST_ROUNDS = 300
SOH_BOOST_STEP = 0.05
SOH_BOOST_DEPTH = 6               # default depth of level-wise boosting (XGBoost)
SOH_FOREST_TREES = 300
SOH_FOREST_LEAF = 3
FAILURE_FOREST_TREES = 400
FAILURE_FOREST_LEAF = 2
FOREST_DEPTH = 30                 # no limit in the published pipeline; Spark grows no deeper
# What the registered regressor queries fit: each boosting round and tree level is a pass over all rows, so
# fewer, larger steps and shallower trees.
QUERY_SIZES = {"rounds": 30, "trees": 40, "depth": 10, "step": 0.2}
LOGISTIC_ROUNDS = 1000

# Human label and adverse direction (True: high value is adverse) per driver feature.
DRIVER_META = (
    ("final_soh", "Low state of health", False),
    ("soh_current", "Low state of health", False),
    ("capacity_fade_rate", "Accelerated capacity fade", True),
    ("resistance_growth_rate", "Internal resistance growth", True),
    ("peak_temperature_max", "Peak thermal exposure", True),
    ("mean_temperature_max", "Sustained thermal exposure", True),
    ("high_temp_exposure_hours", "High-temperature field exposure", True),
    ("fast_charge_ratio", "Heavy fast-charge usage", True),
    ("avg_depth_of_discharge", "Deep discharge cycling", True),
    ("low_temp_exposure_hours", "Low-temperature exposure", True),
    ("station_anomaly_rate", "Test-station anomaly signal", True),
    ("cycle_count", "High cumulative cycle count", True),
)

# Contract columns of an escalation row.
ESCALATION_COLUMNS = (
    "cell_id", "lot_id", "station_id", "failure_probability", "early_warning_probability",
    "predicted_soh", "predicted_remaining_cycles", "likely_root_cause", "recommended_follow_up",
)

# --- engine sizing (not semantics) ---
# Rows per block when numbering a per-key ordered series.  A key with more rows
# than this is spread over several tasks instead of one.
SERIES_BLOCK_ROWS = 4096

# --- fixed values: engineering follow-up per driver label, and the default ---
FOLLOW_UP = (
    ("Accelerated capacity fade", "Pull cell for teardown; check anode lithium plating and electrolyte loss."),
    ("Internal resistance growth", "Run EIS impedance sweep; inspect tab welds and contact resistance."),
    ("Peak thermal exposure", "Audit thermal management / cooling path; verify ambient test conditions."),
    ("Sustained thermal exposure", "Review duty cycle thermal load; validate temperature sensor calibration."),
    ("High-temperature field exposure", "Flag usage profile to reliability; recommend thermal derating."),
    ("Heavy fast-charge usage", "Review fast-charge current limits; check for lithium plating signatures."),
    ("Deep discharge cycling", "Recommend depth-of-discharge limit; review BMS cutoff thresholds."),
    ("Low state of health", "Prioritise for replacement; confirm capacity with reference performance test."),
    ("Test-station anomaly signal", "Re-test on a reference station; audit station calibration drift."),
    ("Low-temperature exposure", "Review low-temp charging policy; check for plating under cold charge."),
    ("High cumulative cycle count", "Expected wear-out; confirm against cycle-life spec and schedule rotation."),
)
DEFAULT_FOLLOW_UP = "Manual engineering review of cycling history and factory record."
ROOT_CAUSE_EOL_SUFFIX = " (cell already below 80% SOH)"
