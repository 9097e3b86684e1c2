"""Release gate, event errors, thresholds and concordance against hand-made and brute-force results."""
import numpy as np
import pytest

from cellpulse import config
from cellpulse.operators import evaluate as ev
from cellpulse.operators.survival import concordance_index, event_errors
from cellpulse.plans import q_evaluate, q_models
from cellpulse.plans.pipeline import Pipeline

SCORES = "y int, p double, base double"


def test_release_gate_needs_all_three(spark):
    good = [(1, 0.9, 0.9), (1, 0.8, 0.1), (0, 0.1, 0.1), (0, 0.2, 0.7), (0, 0.1, 0.1)]
    earlier, later = (spark.createDataFrame(good, SCORES) for _ in range(2))
    row = ev.release_gate(earlier, later, "y", "p", "base").first()
    assert row.beats_baseline and row.recall_holds and row.load_interpretable and row.release
    assert (row.score_f1, row.baseline_f1, row.review_load) == (1.0, 0.5, 2)
    missed = spark.createDataFrame([(y, 0.3 if k == 1 else p, b) for k, (y, p, b) in enumerate(good)], SCORES)
    row = ev.release_gate(earlier, missed, "y", "p", "base").first()
    assert row.beats_baseline and not row.recall_holds and not row.release
    heavy = spark.createDataFrame([(1, 0.9, 0.1)] * 4 + [(0, 0.1, 0.1)], SCORES)
    row = ev.release_gate(earlier, heavy, "y", "p", "base").first()
    assert row.beats_baseline and row.recall_holds and not row.load_interpretable and not row.release


def test_event_errors_without_train_events(spark):
    cols = "duration_cycles int, event_observed int, predicted_expected_eol_cycle double"
    seen = spark.createDataFrame([(100, 1, 130.0), (200, 1, 190.0), (300, 0, 5.0)], cols)
    some = spark.createDataFrame([(100, 1, None), (140, 1, None), (900, 0, None)], cols)
    none = spark.createDataFrame([(100, 0, None), (300, 0, None)], cols)
    assert tuple(event_errors(seen, some).first()) == (20.0, 50.0, 2)  # median event 120
    assert tuple(event_errors(seen, none).first()) == (20.0, 50.0, 2)  # median duration 200
    assert tuple(event_errors(seen.where("event_observed = 0"), some).first()) == (None, None, 0)


def test_thresholds_at_their_edges(spark):
    values = [v for _, v in ev.threshold_values()]
    rows = [(k % 2, p) for k, p in enumerate([*values, *[v - 1e-9 for v in values], 0.0, 1.0])] + [(1, None)]
    got = {r.threshold: (r.tp, r.fp, r.tn, r.fn) for r in ev.threshold_table(spark.createDataFrame(rows, "y int, p double"), "y", "p").collect()}
    known = [(y, p) for y, p in rows if p is not None]
    for v in values:
        want = tuple(sum(1 for y, p in known if (p >= v) == hit and y == label) for hit, label in ((True, 1), (True, 0), (False, 0), (False, 1)))
        assert got[round(v, 2)] == want
    assert len(got) == config.THRESHOLD_COUNT


@pytest.mark.parametrize("n", [0, 1, 60])
def test_concordance_with_missing_risks(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(rng.integers(1, 9)), int(rng.integers(0, 2)), None if rng.random() < 0.1 else float(rng.integers(-2, 3))) for _ in range(n)]
    got = concordance_index(spark.createDataFrame(rows, "d int, e int, r double"), "d", "e", "r").first()
    pairs = [(a[2], b[2]) for a in rows for b in rows if a[1] == 1 and a[0] < b[0]]
    assert got.permissible_pairs == len(pairs)
    if pairs:
        points = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x, y in pairs if x is not None and y is not None)
        assert got.concordance_index == pytest.approx(points / len(pairs))
    else:
        assert got.concordance_index is None


def test_baselines_read_a_narrow_stored_table(spark):
    """The side of a cell rides on its context; the rows are those of the cycle features joined with the split."""
    p = Pipeline(spark, "/root/testdata/sf0.001")
    q_models.backtest_baseline_rows(p).collect()
    assert "release_cycles" not in p.__dict__
    columns = ["cycle_count", "soh_current", "capacity_fade_rate", "remaining_cycles", "is_train"]
    assert p.release_health.columns == columns
    want = p.cycle_features.join(q_evaluate.release_split(p), "cell_id")
    for got, names in ((p.release_health, columns), (p.release_cycles, p.release_cycles.columns)):
        assert got.count() > 0 and sorted(got.collect(), key=repr) == sorted(want.select(*names).collect(), key=repr)
    assert Pipeline.release_health.func(p).columns == columns  # now of the wider table
