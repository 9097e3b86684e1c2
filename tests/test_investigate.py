"""Carried aggregates, as-of and range joins, investigation and contract operators against brute force and DuckDB."""
import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cellpulse.operators import carry, contracts, investigate
from cellpulse.plans.catalog import oracle_queries, spark_queries

SF = "/root/testdata/sf0.001"
NAMES = ["station_calibration_asof", "nearest_passed_peer", "passfail_concentration", "bootstrap_effect", "permutation_importance",
         "stratified_split", "holdout_precision_by_group", "contract_station_calibration_logs", "contract_usage_telemetry",
         "contract_cycle_measurements", "contract_impedance_measurements", "contract_conformance"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("supplier", "lineitem", "events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = spark_queries()[name](spark, SF)
    r = con.execute(oracle_queries()[name])
    cols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(df.collect(), df.columns) == _norm(r.fetchall(), cols)


def test_injected_faults_are_counted(spark):
    for name in ("contract_station_calibration_logs", "contract_usage_telemetry", "contract_cycle_measurements",
                 "contract_impedance_measurements"):
        row = spark_queries()[name](spark, "/root/testdata/sf0.01").first().asDict()
        assert sum(v > 0 for v in row.values()) >= 4, row


def test_running_before_over_blocks_and_null_keys(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "a", "a", "b", None]), i, r.choice([None, 1, 5, 9])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    aggs = {"n": ("count", "v"), "s": ("sum", "v"), "m": ("max", "v"), "lo": ("min", "v"), "l": ("last", "v")}
    for width in (7, 1000):
        for k, t, v, n, s, m, lo, last in carry.running_before(df, ["k"], F.floor(F.col("t") / width), ["t"], aggs).collect():
            past = [x for kk, tt, x in rows if kk == k and tt < t and x is not None]
            assert (n, s, m, lo, last) == (len(past), sum(past) if past else None, max(past, default=None), min(past, default=None),
                                           past[-1] if past else None)


def test_history_join_has_no_pair_join(spark):
    day = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([("a", day + dt.timedelta(days=d), d) for d in (0, 40, 95)] + [("z", day, 7), ("a", None, 8)],
                                 "k string, t timestamp_ntz, id int")
    right = spark.createDataFrame([("a", day + dt.timedelta(days=d), d) for d in (0, 1, 39, 95, 96)], "k string, u timestamp_ntz, w int")
    out = carry.history_join(left, right, ["k"], "t", "u", carry.month, {"n": ("count", "w"), "w": ("last", "w")})
    assert {r["id"]: (r["n"], r["w"]) for r in out.collect()} == {0: (1, 0), 40: (3, 39), 95: (4, 95), 7: (0, None), 8: (0, None)}
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()


def test_nearest_peer_ties_and_hot_group(spark):
    t0, r = dt.datetime(2024, 3, 1), random.Random(5)
    make = lambda n, base: [("L", "S", t0 + dt.timedelta(minutes=r.randrange(200_000)), base + i) for i in range(n)]
    failed, passed = make(60, 0) + [("L", "none", t0, 999)], make(500, 1000)
    failed.append(("L", "S", passed[0][2], 998))
    passed += [("L", "S", passed[0][2], 5), ("L", "S", t0 - dt.timedelta(minutes=10), 7), ("L", "S", t0 - dt.timedelta(minutes=30), 8)]
    failed.append(("L", "S", t0 - dt.timedelta(minutes=20), 997))
    ddl = "lot string, station string, t timestamp_ntz, id long"
    got = investigate.nearest_peer(spark.createDataFrame(failed, ddl), spark.createDataFrame(passed, ddl), ["lot", "station"], "t", "id")
    for lot, station, t, i, peer, gap in got.collect():
        best = min(((abs(p[2] - t), p[2], p[3]) for p in passed if p[1] == station), default=None)
        assert (peer, gap) == ((best[2], best[0].total_seconds()) if best else (None, None))


def test_permutation_keeps_sums_and_matches_brute_force(spark, monkeypatch):
    r = random.Random(1)
    df = spark.createDataFrame([(i, a := r.random(), r.random(), 2 * a + r.random()) for i in range(200)],
                               "id long, a double, b double, y double")
    for rows in (investigate.PERMUTE_ROWS, 32):
        monkeypatch.setattr(investigate, "PERMUTE_ROWS", rows)
        out = investigate.permuted(df, "id", ["a", "b"], 3, 4).toPandas()
        base = df.toPandas().set_index("id")
        for (feature, _), g in out.groupby(["feature", "rep"]):
            assert sorted(g[feature]) == sorted(base[feature]) and list(g[feature]) != list(base.loc[g["id"], feature])
            other = {"a": "b", "b": "a"}[feature]
            assert list(g[other]) == list(base.loc[g["id"], other])
        want = (((2 * out["a"] - out["y"]) ** 2).groupby([out["feature"], out["rep"]]).mean() - ((2 * base["a"] - base["y"]) ** 2).mean())
        got = {x["feature"]: x["importance"] for x in investigate.permutation_importance(
            df, "id", "y", ["a", "b"], lambda: F.lit(2.0) * F.col("a"), 3, 4).collect()}
        assert got == pytest.approx(want.groupby("feature").mean().to_dict()) and abs(got["b"]) < 1e-12 < got["a"]


def test_bootstrap_covers_a_planted_difference_and_repeats(spark):
    r = random.Random(8)
    rows = [(i, i % 4 == 0, r.gauss(1.0 if i % 4 == 0 else 0.0, 1)) for i in range(1200)]
    df = spark.createDataFrame([(i, int(y), x) for i, y, x in rows], "id long, y int, x double")
    one = investigate.bootstrap_effect(df, "id", "y", ["x"], 200).first()
    again = investigate.bootstrap_effect(df.repartition(7), "id", "y", ["x"], 200).first()
    assert one["lo"] < 1.0 < one["hi"] and one["lo"] < one["effect"] < one["hi"] and one["hi"] - one["lo"] < 0.4
    assert tuple(one)[1:] == pytest.approx(tuple(again)[1:])


def test_stratified_split_is_exact_and_stable(spark):
    df = spark.createDataFrame([(i, [0, 1, None][min(i % 7, 2)]) for i in range(700)], "id long, y int")
    a, b = (investigate.stratified_split(x, "id", "y", 0.25, 3) for x in (df, df.repartition(5)))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    assert {r["y"]: r["n"] for r in a.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()} == {0: 25, 1: 25, None: 125}


def test_average_precision_by_group(spark):
    r = random.Random(6)
    rows = [(r.choice("abc"), r.randrange(2), r.randrange(20) / 20) for _ in range(300)] + [("none", 0, 0.5)]
    got = investigate.average_precision(spark.createDataFrame(rows, "g string, y int, p double"), ["g"], "y", "p").collect()
    for g, n, pos, ap in got:
        mine = [(p, y) for gg, y, p in rows if gg == g]
        total, want = sum(y for _, y in mine), 0.0
        for p in {p for p, _ in mine}:
            above = [y for q, y in mine if q >= p]
            want += sum(y for q, y in mine if q == p) * sum(above) / len(above)
        assert (n, pos) == (len(mine), total) and (ap is None if not total else ap == pytest.approx(want / total))


def test_conformance_counts_missing_null_and_uncastable(spark):
    df = spark.createDataFrame([("1", None), ("x", "2024-01-01"), (None, "later")], "a string, b string")
    got = {r["column_name"]: tuple(r)[2:] for r in contracts.conformance(df, "t", {"a": "int", "b": "date", "c": "int"}).collect()}
    assert got == {"a": (True, 1, 1), "b": (True, 1, 1), "c": (False, None, None)}
