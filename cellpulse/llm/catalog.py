"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat_rotation, conversation_repair, exact_dedup, lexical_search, line_dedup, mixing, near_dedup,
               packing, permutation_index, sharding, token_counts, toxicity, warc_fixity)
from ._common import table


def _over(name: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(table(spark, sf_dir, name))
    return run


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": _over("documents", packing.query),
    "op2_feistel_sharding": _over("documents", sharding.query),
    "op3_permutation_index": _over("embeddings", permutation_index.query),
    "op4_exact_dedup": _over("documents", exact_dedup.query),
    "op5_toxicity": _toxicity,
    "op6_warc_fixity": _over("pages", warc_fixity.query),
    "op7_chat_rotation": _over("conversations", chat_rotation.query),
    "op8_near_dedup": _over("documents", near_dedup.query),
    "op9_line_dedup": _over("documents", line_dedup.query),
    "op10_mixing": _over("documents", mixing.query),
    "op11_conversation_repair": _over("conversations", conversation_repair.query),
    "op12_lexical_search": _lexical,
    "op13_token_counts": _over("documents", token_counts.query),
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_warc_fixity": warc_fixity.ORACLE_SQL,
    "op7_chat_rotation": chat_rotation.ORACLE_SQL,
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op12_lexical_search": lexical_search.ORACLE_SQL,
}
