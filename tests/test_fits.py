"""Fits run beside one another, and only those that a query reads."""
import threading

import pytest
from pyspark.sql import functions as F

from cellpulse.operators import evaluate as ev
from cellpulse.plans import q_models
from cellpulse.plans.pipeline import Pipeline


def _meeting(monkeypatch, name, parties):
    """``ev.<name>`` returns only once ``parties`` threads have called it."""
    barrier, real = threading.Barrier(parties, timeout=120), getattr(ev, name)

    def wait(*args, **kwargs):
        barrier.wait()
        return real(*args, **kwargs)
    monkeypatch.setattr(ev, name, wait)


def _rows(spark):
    return spark.range(300).select(F.concat(F.lit("C"), (F.col("id") % 30).cast("string")).alias("cell_id"),
                                   (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                   (F.col("id") % 17 > 8).cast("int").alias("hit")).withColumn("y", F.col("a") * 2 + F.col("b"))


def test_regressors_are_tried_beside_one_another(spark, monkeypatch):
    _meeting(monkeypatch, "regression_metrics", 3)
    name, model = q_models.best_regressor(_rows(spark), ["a", "b"], "y", rounds=2, trees=2, depth=3, step=0.2)
    assert name == "LinearRegression"
    assert all(r.prediction == pytest.approx(r.y) for r in model.transform(_rows(spark)).collect())


def test_classifiers_are_tried_beside_one_another(spark, monkeypatch):
    _meeting(monkeypatch, "classification_metrics", 2)
    name, model, f1 = q_models.fit_failure_classifier(_rows(spark), ("a", "b"), "hit", trees=3, depth=3)
    assert f1 == 1.0 and name == "LogisticRegression"  # of equal ones the first
    assert model.transform(_rows(spark).withColumn("label", F.col("hit").cast("double"))).where("prediction <> label").isEmpty()


def test_a_query_fits_the_models_it_reads(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(q_models, "best_regressor", lambda t, f, y, **_: asked.append(y) or (y, None))
    monkeypatch.setattr(q_models, "fit_failure_classifier", lambda t, f=None, **_: asked.append(f and "early") or ("x", None, 1.0))
    p = Pipeline(spark, "/root/testdata/sf0.001")
    assert set(q_models._release_models(p, ("SOH", "RUL", "Failure risk"))) == {"SOH", "RUL", "Failure risk"}
    assert sorted(map(str, asked)) == ["None", "remaining_cycles", "soh_current"]
    assert len(q_models._release_models(p, ("SOH", "Early warning"))) == 4 and len(asked) == 4


def test_together_keeps_order_and_properties(spark):
    from cellpulse.session import together
    sc = spark.sparkContext
    sc.setLocalProperty("cellpulse.test", "carried")
    try:
        got = together(spark, [lambda k=k: (k, sc.getLocalProperty("cellpulse.test")) for k in range(3)])
    finally:
        sc.setLocalProperty("cellpulse.test", None)
    assert got == [(k, "carried") for k in range(3)]
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1, lambda: 1 // 0])
