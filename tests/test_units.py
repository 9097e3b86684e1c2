"""Hand-computed cases and boundary tests for single operators."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellpulse.functions.scalar import psi_status, risk_tier, round_half_up, validation_note
from cellpulse.operators import evaluate as ev
from cellpulse.operators.features import leave_one_out_rate
from cellpulse.operators.quantiles import exact_quantiles
from cellpulse.operators.series import block_window, expand_to_blocks, ordered_positions, with_halo
from cellpulse.operators.survival import concordance_index, expand_intervals
from cellpulse.sources import rawlog


def test_leave_one_out(spark):
    df = spark.createDataFrame([("A", "L1", 1), ("B", "L1", 0), ("C", "L1", 0), ("D", "L2", 1)],
                               "cell_id string, batch string, v int")
    got = {r.cell_id: r.rate for r in leave_one_out_rate(df, "batch", "v").collect()}
    assert got == pytest.approx({"A": 0.0, "B": 0.5, "C": 0.5, "D": 1 / 3})


@pytest.mark.parametrize("p,tier", [(0.95, "Critical"), (0.80, "Critical"), (0.60, "High"), (0.55, "High"),
                                    (0.40, "Medium"), (0.30, "Medium"), (0.10, "Low"), (0.0, "Low")])
def test_risk_tiers(spark, p, tier):
    assert spark.range(1).select(risk_tier(F.lit(p))).first()[0] == tier


@pytest.mark.parametrize("psi,status", [(0.05, "ok"), (0.12, "watch"), (0.30, "alert"), (float("nan"), "unknown")])
def test_psi_status(spark, psi, status):
    assert spark.range(1).select(psi_status(F.lit(psi))).first()[0] == status


def test_psi_identical_is_zero(spark):
    rows = [("f", "reference", float(i)) for i in range(50)] + [("f", "current", float(i)) for i in range(50)]
    long = spark.createDataFrame(rows, "feature string, cohort string, value double")
    assert ev.psi_by_feature(long).first().psi == pytest.approx(0.0)


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(0, 1, 300), rng.normal(0.4, 1.2, 200)
    rows = [("f", "reference", float(v)) for v in ref] + [("f", "current", float(v)) for v in cur]
    got = ev.psi_by_feature(spark.createDataFrame(rows, "feature string, cohort string, value double")).first().psi
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    rp = np.clip(np.histogram(ref, edges)[0] / len(ref), 1e-6, None)
    cp = np.clip(np.histogram(cur, edges)[0] / len(cur), 1e-6, None)
    assert got == pytest.approx(float(np.sum((cp - rp) * np.log(cp / rp))), rel=1e-12)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(0, 3, 300), np.round(rng.normal(0, 1, 200), 1), [0.0] * 10, [-1e-3, 5e5]])
    grp = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    for r in exact_quantiles(df, "v", probs, ["g"]).collect():
        assert r.quantile == pytest.approx(np.quantile(vals[grp == r.g], r.prob), rel=1e-12, abs=1e-15)


def test_blocked_positions_and_halo_match_plain_window(spark):
    """Tiny blocks force many blocks per key; results must equal a plain per-key window."""
    from pyspark.sql import Window
    rows = [(k, i * 3 + (k % 2), float((i * 7919) % 101)) for k in range(3) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    pos = ordered_positions(df, ["k"], F.floor(F.col("t") / 10), [F.col("t")], count_col="n")
    halo = with_halo(pos, "pos", 4, block_rows=8)
    ctx = expand_to_blocks(pos.groupBy("k").agg(F.max("n").alias("n")), "n", 8).drop("n")
    j = halo.join(ctx, ["k", "_pblk"])
    w = block_window(["k"], "pos")
    got = (j.select("k", "t", "pos", F.avg("v").over(w.rowsBetween(-3, 0)).alias("r"),
                    F.lag("v", 4).over(w).alias("l"), "_halo").where(~F.col("_halo")).drop("_halo"))
    pw = Window.partitionBy("k").orderBy("t")
    exp = df.select("k", "t", F.row_number().over(pw).alias("pos"), F.avg("v").over(pw.rowsBetween(-3, 0)).alias("r"),
                    F.lag("v", 4).over(pw).alias("l"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_round_half_up_is_engine_independent(spark):
    assert spark.range(1).select(round_half_up(F.lit(0.125), 2)).first()[0] == 0.13
    assert spark.range(1).select(round_half_up(F.lit(-2.5), 0)).first()[0] == -3.0


def test_validation_note_order(spark):
    df = spark.createDataFrame([(5, 0.5, -0.9), (50, -0.1, -0.9), (50, 0.01, 0.5), (50, -0.01, 0.0),
                                (50, 0.2, -0.9), (50, 0.01, -0.1), (50, float("nan"), float("nan"))],
                               "c int, l double, r double")
    notes = [r[0] for r in df.select(validation_note(F.col("c"), F.col("l"), F.col("r"))).collect()]
    assert notes[0].startswith("Very short") and notes[1].startswith("Capacity increases")
    assert notes[2].startswith("Positive capacity") and notes[3].startswith("Slight capacity gain")
    assert notes[4].startswith("Clear capacity-fade") and notes[5].startswith("Parsed real")
    assert notes[6].startswith("Parsed real")


def test_raw_log_parse(spark):
    lines = spark.createDataFrame([
        ("# header",), ("",), ("2024-01-01T00:00:00Z | STATION=ST-01 | CELL=C1 | V=3.700 | I=-1.000 | T=25.00",),
        ("2024-01-01T02:00:00Z | STATION=ST-01 | CELL=C1 | V=NaN_3.700 | I=-1.000 ",)], "value string")
    rows = rawlog.parse_raw_log(lines).orderBy("malformed").collect()
    assert len(rows) == 2
    assert rows[0].reason == "ok" and rows[0].voltage == 3.7 and rows[0].temperature == 25.0
    assert rows[1].reason == "bad_voltage;bad_temperature" and rows[1].voltage is None


def test_expand_intervals(spark):
    df = spark.createDataFrame([("a", 120, 1), ("b", 120, 0), ("c", 40, 0), ("d", 30, 1)],
                               "cell_id string, duration_cycles int, event_observed int")
    got = {(r.cell_id, r.interval_end): r.hazard_event for r in expand_intervals(df).collect()}
    assert got == {("a", 50): 0, ("a", 100): 0, ("a", 150): 1, ("b", 50): 0, ("b", 100): 0, ("d", 50): 1}


def test_concordance_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 120
    d, e, r = rng.integers(1, 30, n), rng.integers(0, 2, n), np.round(rng.random(n), 1)
    perm = conc = ties = 0
    for i in range(n):
        for j in range(n):
            if d[i] < d[j] and e[i] == 1:
                perm += 1
                conc += r[i] > r[j]
                ties += r[i] == r[j]
    df = spark.createDataFrame([(int(a), int(b), float(c)) for a, b, c in zip(d, e, r)], "d int, e int, r double")
    got = concordance_index(df, "d", "e", "r").first()
    assert got.permissible_pairs == perm
    assert got.concordance_index == pytest.approx((conc + 0.5 * ties) / perm)


def test_roc_auc_with_ties(spark):
    y = [1, 0, 1, 0, 1, 1, 0, 0, 1, 0]
    p = [0.9, 0.9, 0.8, 0.3, 0.3, 0.5, 0.1, 0.3, 0.7, 0.2]
    pos = [(a, b) for a, b in zip(p, y) if b == 1]
    neg = [a for a, b in zip(p, y) if b == 0]
    exp = sum((pp > q) + 0.5 * (pp == q) for pp, _ in pos for q in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    assert ev.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(exp)
    assert not math.isnan(exp)


def test_stream_parse_equals_batch(spark, tmp_path):
    from cellpulse.plans.pipeline import Pipeline
    from cellpulse.streaming.telemetry import run_available_now, stream_parse_log
    p = Pipeline(spark, "/root/testdata/sf0.001")
    lines = rawlog.render_raw_log(p.landing_cycles, p.factory)
    src = str(tmp_path / "logs")
    lines.coalesce(2).write.mode("overwrite").text(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_available_now(stream_parse_log(spark, src), out, ckpt)
    streamed = spark.read.parquet(out)
    batch = rawlog.parse_raw_log(spark.read.text(src))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_cycle_series_of_long_cells_matches_plain_windows(spark):
    """Small cycle blocks: A spans many blocks (some with one or two rows), B one; against windows over the whole cell."""
    from pyspark.sql import Window

    from cellpulse.operators import cleaning, features, series
    rng = np.random.default_rng(5)
    cycles = [("A", int(c)) for c in (*range(1, 40, 7), *range(50, 120), 131, 132, *range(150, 160))] + [("B", c) for c in range(1, 12)]
    rows = [(cell, c, float(3 + rng.random()), float(20 + rng.random()), float(30 + 20 * rng.random()), 30.0, 3.0, i)
            for i, (cell, c) in enumerate(cycles)]
    df = spark.createDataFrame(rows, "cell_id string, cycle_index int, discharge_capacity_ah double, internal_resistance_mohm double, "
                                     "temperature_max double, temperature_mean double, voltage_min double, ingest_seq long")
    clean = cleaning.clean_cycles_blocked(df, block_rows=8)
    long_cells = series.keys_of_several_blocks(clean, "cell_id")
    assert {r.cell_id for r in long_cells.collect()} == {"A", "B"}
    pos = features.positioned_cycles(clean, long_cells)
    cols = ["cell_id", "cycle_index", "pos", "n_rows", "initial_capacity_ah", "initial_resistance_mohm", "rolling_capacity_mean_10",
            "rolling_temperature_max_10", "soh_delta_last_20_cycles", "soh_step"]
    got = sorted(features.cycle_series(pos).select(cols).collect())
    w = Window.partitionBy("cell_id").orderBy("cycle_index")
    every, roll, head = Window.partitionBy("cell_id"), w.rowsBetween(-9, 0), F.col("pos") <= 5
    cap = F.col("discharge_capacity_ah")
    exp = (df.withColumn("pos", F.row_number().over(w)).withColumn("n_rows", F.count("*").over(every))
           .withColumn("initial_capacity_ah", F.avg(F.when(head, cap)).over(every))
           .withColumn("initial_resistance_mohm", F.avg(F.when(head, F.col("internal_resistance_mohm"))).over(every))
           .withColumn("soh", cap / F.col("initial_capacity_ah"))
           .withColumn("rolling_capacity_mean_10", F.avg(cap).over(roll))
           .withColumn("rolling_temperature_max_10", F.max("temperature_max").over(roll))
           .withColumn("soh_delta_last_20_cycles", F.coalesce(F.col("soh") - F.lag("soh", 20).over(w), F.lit(0.0)))
           .withColumn("soh_step", F.col("soh") - F.lag("soh", 1).over(w)))
    exp = sorted(exp.select(cols).collect())
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        assert a[:4] == b[:4]
        assert a[4:9] == pytest.approx(b[4:9], rel=1e-12, abs=1e-12)
        assert (a[9] is None) == (b[9] is None) and (a[9] is None or a[9] == pytest.approx(b[9], abs=1e-12))
    # One block a cell: the same without a word from other blocks.
    whole = features.positioned_cycles(cleaning.clean_cycles_blocked(df))
    again = sorted(features.cycle_series(whole).select(cols).collect())
    assert [r[:4] for r in again] == [r[:4] for r in exp] and [r[8] for r in again] == pytest.approx([r[8] for r in exp])


def test_series_needs_one_shuffle_of_the_landed_rows(spark, tmp_path):
    """Cells of one block each: cleaning, numbering, series and features move the landed rows once (before: five times)."""
    from cellpulse.plans.pipeline import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    plan = p.series._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_quality_checks_build_only_their_tables(spark):
    from cellpulse.plans.pipeline import Pipeline, warehouse_tables
    from cellpulse.operators import quality
    p = Pipeline(spark, "/root/testdata/sf0.001")
    quality.duplicate_cell_cycle(warehouse_tables(p, landing=True))
    assert "landing_cycles" in p.__dict__ and not {"stats", "predictions", "cell_features", "failure_events"} & set(p.__dict__)


def test_quantiles_store_group_and_value_only(spark, monkeypatch):
    """The copy holds no digits, and rows that are stored already are not copied; shuffled blocks give the same."""
    from cellpulse.operators import quantiles
    seen, real = [], quantiles.store

    def spy(df, name):
        seen.append(df.columns)
        return real(df, name)

    monkeypatch.setattr(quantiles, "store", spy)
    df = spark.createDataFrame([(g, float((i * 7919) % 1009) / 7) for g in "ab" for i in range(200)] + [("a", None)], "g string, v double")
    got = sorted(exact_quantiles(df, "v", [0.1, 0.5], ["g"]).collect())
    assert seen == [["g", "_v"]]
    assert sorted(exact_quantiles(df, "v", [0.1, 0.5], ["g"], stored=True).collect()) == got and len(seen) == 1
    monkeypatch.setattr(quantiles, "BROADCAST_BLOCKS", 0)
    assert sorted(exact_quantiles(df, "v", [0.1, 0.5], ["g"], stored=True).collect()) == got


def test_telemetry_files_are_gzipped_and_joined_narrow(spark):
    """Lines equal the ones rendered in one piece; the join moves what a line shows, not the measured row."""
    from cellpulse.plans.pipeline import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    names = [r[0] for r in spark.read.text(p.raw_log_path).select(F.input_file_name()).distinct().collect()]
    assert names and all(n.endswith(".gz") for n in names)
    body = rawlog.render_raw_log(p.landing_cycles, p.factory)
    assert spark.read.text(p.raw_log_path).count() == body.count()
    joined = body._jdf.queryExecution().optimizedPlan().toString()
    assert "discharge_capacity_ah" not in joined.split("Join")[0]


def test_duplicate_cycles_need_no_shuffle_of_cleaned_rows(spark, tmp_path):
    """Grains that occur twice or more, null keys included, as grouping counts them; cleaned rows are not dealt again."""
    from cellpulse.operators import cleaning, quality
    rows = [("a", 1), ("a", 1), ("a", 1), ("a", 2), ("a", 5000), ("a", 5000), ("b", 1), ("b", None), ("b", None), (None, 3),
            (None, 3), (None, 4), (None, None), (None, None), (None, None), ("c", 7)]
    df = spark.createDataFrame(rows, "cell_id string, cycle_index int").repartition(5)
    want = df.groupBy("cell_id", "cycle_index").count().where("count > 1").count()
    assert want == 5
    assert quality.duplicate_cell_cycle({"fact_cycle_measurements": df}).first()["offending"] == want
    landed = spark.createDataFrame([(c, i, 3.0, 25.0, n) for n, (c, i) in enumerate(rows)],
                                   "cell_id string, cycle_index int, discharge_capacity_ah double, "
                                   "internal_resistance_mohm double, ingest_seq long")
    landed.write.parquet(f"{tmp_path}/landed")  # rows of a file, so that no plan folds them away
    clean = cleaning.clean_cycles_blocked(spark.read.parquet(f"{tmp_path}/landed"))
    counted = quality.duplicate_cell_cycle({"fact_cycle_measurements": clean})
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    # Cleaning keeps rows without a cycle number, as these compare equal to none.
    assert counted.first()["offending"] == clean.groupBy("cell_id", "cycle_index").count().where("count > 1").count()
