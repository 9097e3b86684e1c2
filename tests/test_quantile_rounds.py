"""Rounds of the exact quantiles: rows are picked by the value ranges of the blocks."""
import numpy as np
import pytest

from cellpulse.operators import quantiles


def _values():
    rng = np.random.default_rng(5)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2), 2.0, 4096.0, -4096.0, 1e300, -1e300]
    return np.concatenate([odd * 3, rng.normal(0, 1e-3, 200), np.repeat(rng.normal(5, 1, 5), 40), 1 + rng.random(200) * 1e-13])


@pytest.mark.parametrize("blocks", [quantiles.BROADCAST_BLOCKS, 0])
def test_both_ways_match_numpy(spark, monkeypatch, blocks):
    monkeypatch.setattr(quantiles, "BROADCAST_BLOCKS", blocks)
    vals, probs = _values(), [0.0, 0.05, 0.3, 0.5, 0.77, 0.95, 1.0]
    rows = [(("a", "b", None)[k % 3], k % 2, float(v)) for k, v in enumerate(vals)] + [("a", 0, None), ("a", 0, float("nan"))]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    for groups in ([], ["g"], ["g", "h"]):
        got = quantiles.exact_quantiles(df, "v", probs, groups).collect()
        keyed = {tuple(r[c] for c in groups) for r in got}
        assert len(got) == len(keyed) * len(probs) and len(keyed) == {0: 1, 1: 2, 2: 4}[len(groups)]
        for r in got:
            own = [x[2] for x in rows if x[2] is not None and x[2] == x[2] and all(r[c] == x["gh".index(c)] for c in groups)]
            assert r.quantile == pytest.approx(np.quantile(own, r.prob), rel=1e-12, abs=0)


def test_digits_are_made_of_the_rows_of_the_blocks_only(spark, monkeypatch):
    plans, real = [], quantiles.cut_lineage
    monkeypatch.setattr(quantiles, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    df = spark.createDataFrame([("a", float(v)) for v in _values()], "g string, v double")
    quantiles.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect()
    later = [p for p in plans if "LeftSemi" in p]
    assert later and all("LOG2" in p.upper() and "LOG2" not in p.split("LeftSemi", 1)[1].upper() for p in later)
