"""A training corpus from ``documents``: each stage reads what its predecessor kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which :func:`run` writes as Parquet and reads again as
the next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last returns the packed pieces, one row per piece.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellpulse.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from cellpulse.llm._common import stored, table

#: Words per shingle of the near-duplicate stage.
SHINGLE = 5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches the threshold."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dedup.deduplicate(docs, width=SHINGLE)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources meet their target weights."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mixed documents' tokens into sequences."""
    return packing.query(docs)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

#: The toxicity stage applies a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
