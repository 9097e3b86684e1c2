"""Per-cycle and per-cell features of the cell histories.

All row-position semantics ("first five rows", "row 20", "first 50 rows",
"tail from row floor(0.75 n)") are positions inside a cell's cleaned history,
which can differ from cycle numbers when cycles are missing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from .cleaning import CAP, RES
from .series import CYCLE_BLOCK, HALO, cross_block_context, with_carried_halo

#: Columns that a block's halo rows must hold: what the trailing frames read.
HALO_COLUMNS = ("cycle_index", CAP, RES, "temperature_max")


def positioned_cycles(clean_blocked: DataFrame, long_cells: DataFrame | None = None) -> DataFrame:
    """Cleaned cycles with ``pos`` (1..n by cycle_index), ``n_rows`` and the mean capacity / resistance of the first
    five rows of each cell.

    A cell whose cycles lie in one block is numbered inside that block, so its rows need only the shuffle the cleaning
    made.  ``long_cells`` names the cells of several blocks: what their blocks need of one another (offset, totals,
    first rows, halo) comes from a per-block table joined on the same partitioning.  ``None``: there are none.
    """
    rows = clean_blocked.where(F.col("cell_id").isNotNull() & F.col(CYCLE_BLOCK).isNotNull())
    block = Window.partitionBy("cell_id", CYCLE_BLOCK)
    rows = rows.withColumn("_rn", F.row_number().over(block.orderBy("cycle_index")))
    first = F.col("_rn") <= config.INITIAL_ROWS
    own = {"_before": F.lit(0), "n_rows": F.count(F.lit(1)).over(block),
           "initial_capacity_ah": F.avg(F.when(first, F.col(CAP))).over(block),
           "initial_resistance_mohm": F.avg(F.when(first, F.col(RES))).over(block)}
    rows = rows.withColumns(own)
    if long_cells is not None:
        context = cross_block_context(clean_blocked.join(long_cells, "cell_id", "left_semi"), "cell_id", "cycle_index",
                                      {"initial_capacity_ah": CAP, "initial_resistance_mohm": RES}, config.INITIAL_ROWS,
                                      HALO_COLUMNS, config.SOH_DELTA_WINDOW)
        context = context.withColumnsRenamed({c: f"_x{c}" for c in own})
        rows = rows.join(context, ["cell_id", CYCLE_BLOCK], "left")
        rows = rows.withColumns({c: F.coalesce(F.col(f"_x{c}"), F.col(c)) for c in own}).drop(*[f"_x{c}" for c in own])
    return rows.withColumn("pos", (F.col("_before") + F.col("_rn")).cast("int")).drop("_before")


def initial_stats(cyc: DataFrame) -> DataFrame:
    """Per cell: row count and the mean capacity / resistance of the first five rows."""
    return cyc.where(F.col("pos") == 1).select("cell_id", "n_rows", "initial_capacity_ah", "initial_resistance_mohm")


def cycle_series(cyc: DataFrame) -> DataFrame:
    """Row-level series features: SOH, fade / growth rates, 10-row rolling
    statistics, 20-row SOH delta and the one-row SOH step.

    Frames reach back at most ``SOH_DELTA_WINDOW`` rows, so each cycle block
    of a long cell carries that many halo rows from the blocks before it.
    """
    j = with_carried_halo(cyc, HALO_COLUMNS)
    ci = F.greatest(F.col("cycle_index"), F.lit(1))
    soh = F.col(CAP) / F.col("initial_capacity_ah")
    w = Window.partitionBy("cell_id", CYCLE_BLOCK).orderBy("cycle_index")
    roll = w.rowsBetween(-(config.ROLLING_WINDOW - 1), 0)
    j = j.withColumn("soh_current", soh)
    out = j.select(
        "cell_id", "cycle_index", "pos", "n_rows", CYCLE_BLOCK, HALO,
        CAP, RES, "temperature_max", "temperature_mean", "voltage_min",
        "initial_capacity_ah", "initial_resistance_mohm",
        F.col("cycle_index").alias("cycle_count"),
        "soh_current",
        ((F.lit(1.0) - F.col("soh_current")) / ci).alias("capacity_fade_rate"),
        ((F.col(RES) / F.col("initial_resistance_mohm") - F.lit(1.0)) / ci).alias("resistance_growth_rate"),
        F.avg(CAP).over(roll).alias("rolling_capacity_mean_10"),
        F.max("temperature_max").over(roll).alias("rolling_temperature_max_10"),
        F.avg(RES).over(roll).alias("rolling_resistance_mean_10"),
        F.coalesce(F.col("soh_current") - F.lag("soh_current", config.SOH_DELTA_WINDOW).over(w),
                   F.lit(0.0)).alias("soh_delta_last_20_cycles"),
        (F.col("soh_current") - F.lag("soh_current", 1).over(w)).alias("soh_step"),
    )
    return out.where(~F.col(HALO)).drop(HALO)


def cell_series_stats(series: DataFrame) -> DataFrame:
    """Per-cell aggregates of the series, in one partially-aggregated pass:
    crossing positions, last values, tail slope, temperature summary, the
    largest SOH drop and the first-50-row early-window statistics."""
    pos, ci, soh = F.col("pos"), F.col("cycle_index"), F.col("soh_current")
    lo = F.greatest(F.lit(1), F.floor(F.col("n_rows") * F.lit(config.TAIL_FRACTION)))
    tail = pos >= lo
    early = pos <= config.EARLY_WINDOW_ROWS
    early20 = pos <= config.EARLY_SOH_ROW
    return series.groupBy("cell_id").agg(
        F.max("n_rows").alias("n_rows"),
        F.max("initial_capacity_ah").alias("initial_capacity_ah"),
        F.max("initial_resistance_mohm").alias("initial_resistance_mohm"),
        F.min(F.when(soh < config.SOH_EOL_THRESHOLD, ci)).alias("eol_cycle"),
        F.min(F.when(soh < config.SOH_EOL_THRESHOLD, pos)).alias("eol_pos"),
        F.min(F.when(soh < config.EARLY_DEGRADATION_SOH, pos)).alias("early_pos"),
        F.max(ci).alias("last_cycle"),
        F.min(CYCLE_BLOCK).alias("first_block"),
        F.max(CYCLE_BLOCK).alias("last_block"),
        F.max_by(soh, pos).alias("final_soh"),
        F.max_by("capacity_fade_rate", pos).alias("capacity_fade_rate"),
        F.max_by("resistance_growth_rate", pos).alias("resistance_growth_rate"),
        F.regr_slope(F.when(tail, soh), F.when(tail, ci.cast("double"))).alias("tail_slope"),
        F.count(F.when(tail, F.lit(1))).alias("tail_rows"),
        F.max("temperature_max").alias("peak_temperature_max"),
        F.avg("temperature_max").alias("mean_temperature_max"),
        F.min("soh_step").alias("min_soh_step"),
        # early window (first 50 rows)
        F.max(F.when(early, ci)).alias("early_cycle_count"),
        F.max_by(F.when(early20, soh), F.when(early20, pos)).alias("soh_at_cycle_20"),
        F.max_by(F.when(early, soh), F.when(early, pos)).alias("soh_at_cycle_50"),
        F.max_by(F.when(early, F.col(RES)), F.when(early, pos)).alias("_early_last_res"),
        F.avg(F.when(early, F.col(RES))).alias("resistance_mean_50"),
        F.avg(F.when(early, F.col("temperature_mean"))).alias("temperature_mean_50"),
        F.max(F.when(early, F.col("temperature_max"))).alias("temperature_max_50"),
        F.min(F.when(early, F.col("voltage_min"))).alias("voltage_min_50"),
    )


def projected_eol(stats: DataFrame) -> DataFrame:
    """Add ``eol_projection``: the crossing cycle when SOH fell below 0.80, else the
    linear projection of the tail (slope -1e-6 when the tail has <= 2 rows,
    and never flatter than -1e-6)."""
    slope = F.least(
        F.when(F.col("tail_rows") > 2, F.coalesce(F.col("tail_slope"), F.lit(config.FLAT_SLOPE)))
         .otherwise(F.lit(config.FLAT_SLOPE)),
        F.lit(config.FLAT_SLOPE))
    projected = F.col("last_cycle") + (F.lit(config.SOH_EOL_THRESHOLD) - F.col("final_soh")) / slope
    return stats.withColumn("eol_projection", F.coalesce(F.col("eol_cycle").cast("double"), projected))


def leave_one_out_rate(df: DataFrame, group: str, value: str, id_col: str = "cell_id",
                       out: str = "rate") -> DataFrame:
    """Per-row mean of ``value`` over the row's group without the row itself.

    A singleton group falls back to the fleet leave-one-out rate; a fleet of
    one row gives 0.0.  Group sums are partial aggregates; fleet totals are a
    scalar subquery (one value, computed once).
    """
    v = F.col(value).cast("double")
    groups = df.groupBy(group).agg(F.sum(v).alias("_gs"), F.count(v).alias("_gc"))
    fleet = df.agg(F.sum(v).alias("_ts"), F.count(v).alias("_tc"))
    ts, tc = fleet.select("_ts").scalar(), fleet.select("_tc").scalar()
    own = F.col(value).cast("double")
    rate = (F.when(F.col("_gc") > 1, (F.col("_gs") - own) / (F.col("_gc") - 1))
            .when(tc > 1, (ts - own) / (tc - 1))
            .otherwise(F.lit(0.0)))
    groups = groups.withColumnRenamed(group, "_g")
    return df.join(groups, df[group].eqNullSafe(groups["_g"]), "left").select(id_col, rate.alias(out))


def cycle_features(series: DataFrame, stats: DataFrame, context: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """All per-cycle features plus the remaining-cycles target.

    ``context`` is one row per cell with usage, rates and factory keys; it is
    joined together with the per-cell projection on (cell, cycle block),
    the partitioning the series already has.  ``extra`` names further columns of ``context`` to keep.
    """
    blocks = F.explode(F.sequence("first_block", "last_block")).alias(CYCLE_BLOCK)
    per_cell = projected_eol(stats).select("cell_id", "eol_projection", blocks).join(context, "cell_id")
    j = series.join(per_cell, ["cell_id", CYCLE_BLOCK])
    remaining = F.greatest(F.col("eol_projection") - F.col("cycle_index"), F.lit(0.0))
    return j.select(
        "cell_id", "cycle_index", "cycle_count", "soh_current", "capacity_fade_rate",
        "resistance_growth_rate", "rolling_capacity_mean_10", "rolling_temperature_max_10",
        "rolling_resistance_mean_10", "soh_delta_last_20_cycles", "fast_charge_ratio",
        "avg_depth_of_discharge", "high_temp_exposure_hours", "batch_failure_rate",
        "station_anomaly_rate", "lot_id", "station_id",
        remaining.cast("double").alias("remaining_cycles"), *extra,
    )


def cell_features(stats: DataFrame, usage: DataFrame, factory: DataFrame, rates: DataFrame,
                  failures: DataFrame) -> DataFrame:
    u = usage.select("cell_id", "fast_charge_ratio", "avg_depth_of_discharge",
                     "high_temp_exposure_hours", "low_temp_exposure_hours", "usage_profile")
    f = factory.select("cell_id", "lot_id", "station_id", "batch_id")
    fe = failures.select("cell_id", "escalation_required", "failure_severity")
    return (stats.select("cell_id", "final_soh", "capacity_fade_rate", "resistance_growth_rate",
                         "peak_temperature_max", "mean_temperature_max",
                         F.col("last_cycle").alias("cycle_count"))
            .join(u, "cell_id", "left").join(f, "cell_id", "left").join(rates, "cell_id", "left")
            .join(fe, "cell_id", "left")
            .select("cell_id", "final_soh", "capacity_fade_rate", "resistance_growth_rate",
                    "peak_temperature_max", "mean_temperature_max", "cycle_count",
                    "fast_charge_ratio", "avg_depth_of_discharge", "high_temp_exposure_hours",
                    "low_temp_exposure_hours", "usage_profile", "lot_id", "station_id", "batch_id",
                    F.coalesce("batch_failure_rate", F.lit(0.0)).alias("batch_failure_rate"),
                    F.coalesce("station_anomaly_rate", F.lit(0.0)).alias("station_anomaly_rate"),
                    F.col("escalation_required").cast("int").alias("escalation_required"),
                    "failure_severity"))


def early_warning_features(stats: DataFrame, factory: DataFrame, rates: DataFrame,
                           failures: DataFrame) -> DataFrame:
    last_ci = F.greatest(F.col("early_cycle_count"), F.lit(1))
    f = factory.select("cell_id", "test_temperature", "charge_current", "discharge_current",
                       "lot_id", "station_id", "batch_id")
    fe = failures.select("cell_id", "escalation_required", "failure_severity")
    return (stats.join(f, "cell_id", "left").join(rates, "cell_id", "left").join(fe, "cell_id", "left")
            .select(
                "cell_id",
                F.col("early_cycle_count").cast("int").alias("early_cycle_count"),
                "soh_at_cycle_20", "soh_at_cycle_50",
                ((F.lit(1.0) - F.col("soh_at_cycle_50")) / last_ci).alias("capacity_fade_rate_50"),
                ((F.col("_early_last_res") / F.col("initial_resistance_mohm") - F.lit(1.0)) / last_ci)
                .alias("resistance_growth_rate_50"),
                "resistance_mean_50", "temperature_mean_50", "temperature_max_50", "voltage_min_50",
                "test_temperature", "charge_current", "discharge_current",
                "lot_id", "station_id", "batch_id",
                F.coalesce("station_anomaly_rate", F.lit(0.0)).alias("station_anomaly_rate"),
                F.col("escalation_required").cast("int").alias("escalation_required"),
                "failure_severity"))
