"""Spark queries vs the independent DuckDB oracle on the smallest fixture."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from cellpulse.plans.catalog import oracle_queries, spark_queries

SF = "/root/testdata/sf0.001"
SAMPLE = ["mart_factory_quality", "cycle_features", "cell_features", "early_warning_features",
          "derive_failure_events", "quality_report_landing", "parse_raw_log", "adhoc_lot_risk",
          "threshold_table", "calibration_table", "drift_table", "expand_intervals", "score_cells"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(("NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i]) for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("supplier", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_every_query_has_a_callable_and_sql_keys_are_known():
    q, o = spark_queries(), oracle_queries()
    assert set(o) <= set(q)
    assert len(q) >= 100


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = spark_queries()[name](spark, SF)
    r = con.execute(oracle_queries()[name])
    ocols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(df.collect(), df.columns) == _norm(r.fetchall(), ocols)
