"""The cell reliability pipeline as one lazy DataFrame graph.

``Pipeline(spark, sf_dir)`` exposes every intermediate table as a lazily
built DataFrame.  Nothing runs until an action; Catalyst sees the whole plan,
prunes columns down to the parquet scans and reuses shared exchanges.
"""
from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import cleaning, evaluate, events, features, marts, publish, scoring, series, warehouse
from ..session import cut_lineage
from ..sources import bridge, rawlog


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # ---- sources -------------------------------------------------------
    @cached_property
    def factory(self) -> DataFrame:
        return bridge.factory(self.spark, self.sf_dir)

    @cached_property
    def usage(self) -> DataFrame:
        return bridge.usage(self.spark, self.sf_dir)

    @cached_property
    def impedance(self) -> DataFrame:
        return bridge.impedance_flags(self.spark, self.sf_dir)

    @cached_property
    def landing_cycles(self) -> DataFrame:
        # The landed cycle table is a stored table in production; the fixture
        # projection is stored once the same way.
        return publish.store(bridge.landing_cycles(self.spark, self.sf_dir), "landing_cycles")

    @cached_property
    def raw_log_path(self) -> str:
        """Telemetry text files of the landed rows, written once by a Spark job to the shared folder, gzipped."""
        path = publish.shared_folder(self.spark, "telemetry")
        rawlog.render_raw_log(self.landing_cycles, self.factory).write.text(path, compression="gzip")
        return path

    # ---- cleaning + series --------------------------------------------
    @cached_property
    def clean_blocked(self) -> DataFrame:
        return cleaning.clean_cycles_blocked(self.landing_cycles)

    @cached_property
    def cycles(self) -> DataFrame:
        return self.clean_blocked.drop("_cblk", "ingest_seq")

    @cached_property
    def positioned(self) -> DataFrame:
        landed = self.landing_cycles.select("cell_id", cleaning.cycle_block().alias(series.CYCLE_BLOCK))
        several = cut_lineage(series.keys_of_several_blocks(landed, "cell_id"))
        return features.positioned_cycles(self.clean_blocked, None if several.isEmpty() else several)

    @cached_property
    def initial(self) -> DataFrame:
        return features.initial_stats(self.positioned)

    @cached_property
    def series(self) -> DataFrame:
        return features.cycle_series(self.positioned)

    @cached_property
    def stats(self) -> DataFrame:
        # One row per cell, read by every per-cell branch (labels, rates, features,
        # scores, marts): a reliable checkpoint cuts the cycle-level lineage here.
        return cut_lineage(features.cell_series_stats(self.series))

    # ---- labels, rates, features --------------------------------------
    @cached_property
    def failure_events(self) -> DataFrame:
        return cut_lineage(events.derive_failure_events(self.stats, self.impedance, self.factory))

    @cached_property
    def rates(self) -> DataFrame:
        merged = self.failure_events.join(self.factory.select("cell_id", "batch_id", "station_id"), "cell_id")
        batch = features.leave_one_out_rate(merged, "batch_id", "escalation_required", out="batch_failure_rate")
        station = features.leave_one_out_rate(merged, "station_id", "thermal_anomaly_event",
                                              out="station_anomaly_rate")
        return cut_lineage(batch.join(station, "cell_id"))

    @cached_property
    def cell_context(self) -> DataFrame:
        u = self.usage.select("cell_id", "fast_charge_ratio", "avg_depth_of_discharge", "high_temp_exposure_hours")
        f = self.factory.select("cell_id", "lot_id", "station_id")
        r = self.rates
        return (u.join(f, "cell_id").join(r, "cell_id", "left")
                .withColumn("batch_failure_rate", F.coalesce("batch_failure_rate", F.lit(0.0)))
                .withColumn("station_anomaly_rate", F.coalesce("station_anomaly_rate", F.lit(0.0))))

    @cached_property
    def cycle_features(self) -> DataFrame:
        return features.cycle_features(self.series, self.stats, self.cell_context)

    @cached_property
    def cell_features(self) -> DataFrame:
        return cut_lineage(features.cell_features(self.stats, self.usage, self.factory, self.rates,
                                                  self.failure_events))

    @cached_property
    def early_warning_features(self) -> DataFrame:
        return cut_lineage(features.early_warning_features(self.stats, self.factory, self.rates,
                                                           self.failure_events))

    def _release_rows(self, columns: list[str], name: str) -> DataFrame:
        """Columns of the cycle features with ``is_train``, the side of their cell in the release split, stored.  The side rides
        on the per-cell context: joined to the cycles by cell alone it would shuffle them once more."""
        split = evaluate.ordered_split(self.factory.select("cell_id", "manufacturing_date"), "manufacturing_date", "cell_id",
                                       config.RELEASE_TRAIN_FRACTION).select("cell_id", "is_train")
        rows = features.cycle_features(self.series, self.stats, self.cell_context.join(split, "cell_id"), ("is_train",))
        return publish.store(rows.select(*columns, "is_train"), name)

    @cached_property
    def release_cycles(self) -> DataFrame:
        """The cycle rows of the fits; stored, as every fit and metric reads them."""
        used = sorted({*config.SOH_FEATURES, *config.RUL_FEATURES, "remaining_cycles", "cycle_index"})
        return self._release_rows(["cell_id", *used], "release_cycles")

    @cached_property
    def release_health(self) -> DataFrame:
        """What the cycle baselines read, of the table of the fits if that is there."""
        columns = ["cycle_count", "soh_current", "capacity_fade_rate", "remaining_cycles"]
        if "release_cycles" in self.__dict__:
            return self.release_cycles.select(*columns, "is_train")
        return self._release_rows(columns, "release_health")

    # ---- warehouse ----------------------------------------------------
    @cached_property
    def dim_test_condition(self) -> DataFrame:
        return warehouse.dim_test_condition(self.factory)

    @cached_property
    def dim_cell(self) -> DataFrame:
        return warehouse.dim_cell(self.factory, self.usage, self.dim_test_condition)

    @cached_property
    def dim_lot(self) -> DataFrame:
        return warehouse.dim_lot(self.factory)

    @cached_property
    def dim_station(self) -> DataFrame:
        return warehouse.dim_station(self.factory)

    @cached_property
    def fact_cycle_measurements(self) -> DataFrame:
        return warehouse.fact_cycle_measurements(self.cycles)

    @cached_property
    def predictions(self) -> DataFrame:
        return cut_lineage(scoring.baseline_predictions(self.cell_features, self.stats,
                                                        self.early_warning_features))

    # ---- marts --------------------------------------------------------
    @cached_property
    def health(self) -> DataFrame:
        return marts.mart_cell_health_summary(self.dim_cell, self.cell_features, self.predictions,
                                              self.failure_events)

    @cached_property
    def factory_quality(self) -> DataFrame:
        return marts.mart_factory_quality(self.dim_cell, self.cell_features, self.failure_events)

    @cached_property
    def queue(self) -> DataFrame:
        return marts.mart_escalation_queue(self.health)


_CACHE: dict[tuple[int, str], Pipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    key = (id(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = Pipeline(spark, sf_dir)
    return _CACHE[key]


class WarehouseTables(Mapping):
    """Name -> DataFrame; a table is built when it is first asked for."""

    def __init__(self, makers: dict):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def warehouse_tables(p: Pipeline, landing: bool = False) -> Mapping:
    """The star schema as a name -> DataFrame map.  With ``landing`` the cycle
    fact is the raw landed rows (what the quality gate must catch); else its rows keep their cycle block."""
    return WarehouseTables({
        "dim_cell": lambda: p.dim_cell,
        "fact_cycle_measurements": lambda: p.landing_cycles if landing else p.clean_blocked.select(
            *p.fact_cycle_measurements.columns, series.CYCLE_BLOCK),
        "fact_usage_profile": lambda: p.usage,
        "fact_failure_events": lambda: p.failure_events,
        "fact_model_predictions": lambda: p.predictions,
        "stg_cell_features": lambda: p.cell_features,
    })
