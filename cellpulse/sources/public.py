"""Public aging data: per-battery CSV files, and sources in order of precedence."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Measured columns of a processed file -> name in the tables.
CAPACITY_COLUMNS = {"capacity": "capacity_ah", "remaining_cycles": "remaining_cycles", "max_temp_D": "max_discharge_temp_c",
                    "max_temp_C": "max_charge_temp_c", "slope_temp_D": "discharge_temp_slope",
                    "slope_voltage_measured_D": "voltage_slope"}
REQUIRED = ("capacity", "remaining_cycles")


def scan_capacity_csv(spark: SparkSession, path: str) -> DataFrame:
    """battery_id (the file's name without ``_processed`` and extension), cycle_index (the first column, whatever its name) and
    the measured columns; what does not parse is null, absent optional columns are null, absent required ones raise."""
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    name = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_name"), r"\.csv(\.gz)?$", ""), "_processed", "")
    return raw.select(
        name.alias("battery_id"), F.col(f"`{raw.columns[0]}`").try_cast("double").try_cast("int").alias("cycle_index"),
        *[(F.col(c).try_cast("double") if c in raw.columns else F.lit(None).cast("double")).alias(out)
          for c, out in CAPACITY_COLUMNS.items()])


def first_present(sources: list[tuple[str, Callable[[], DataFrame | None]]]) -> tuple[str, DataFrame]:
    """The name and frame of the first source that has a row; later sources are neither opened nor planned."""
    for name, load in sources:
        df = load()
        if df is not None and not df.isEmpty():
            return name, df
    raise FileNotFoundError("no source holds any row")


def source_precedence(sources: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """All rows of each ``key`` from the first source (in order) that has it, with ``source_name``.

    Which source serves a key is one small aggregate over the keys; a null key is a key."""
    tagged = [df.withColumn("source_name", F.lit(name)).withColumn("_rank", F.lit(i)) for i, (name, df) in enumerate(sources)]
    every = tagged[0]
    for df in tagged[1:]:
        every = every.unionByName(df, allowMissingColumns=True)
    best = every.groupBy(F.col(key).alias("_key")).agg(F.min("_rank").alias("_best"))
    served = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_rank") == F.col("_best"))
    return every.join(best, served).drop("_rank", "_key", "_best")
