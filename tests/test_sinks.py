"""Versioned tables, CSV sources and sinks, source precedence, streaming twins."""
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from cellpulse.operators import cleaning, publish
from cellpulse.plans.catalog import spark_queries
from cellpulse.sources import public
from cellpulse.streaming.score import scored, stream_score
from cellpulse.streaming.telemetry import run_available_now, stream_cycle_agg

SF = "/root/testdata/sf0.001"


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert publish.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        publish.read_current(spark, path)
    one = spark.range(5).withColumn("lot", F.col("id") % 2)
    assert publish.publish(one, path, ["lot"]).count() == 5
    bad = spark.range(10).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception):
        publish.publish(bad, path)
    assert publish.read_current(spark, path).count() == 5
    held = publish.read_current(spark, path)
    assert publish.publish(one.limit(2), path).count() == 2 and held.count() == 5
    assert publish.drop_old(spark, path) >= 1 and publish.read_current(spark, path).count() == 2


def test_capacity_csv(spark, tmp_path):
    (tmp_path / "B0005_processed.csv").write_text(",capacity,remaining_cycles,max_temp_D\n1,1.85,10,30\n2,bad,9,\nx,1.8,8,31\n")
    (tmp_path / "B0006_processed.csv").write_text(",capacity,remaining_cycles,max_temp_D\n1,2.0,5,29\n")
    rows = public.scan_capacity_csv(spark, str(tmp_path)).orderBy("battery_id", F.desc("remaining_cycles")).collect()
    assert [(r["battery_id"], r["cycle_index"], r["capacity_ah"], r["max_discharge_temp_c"], r["voltage_slope"]) for r in rows] == [
        ("B0005", 1, 1.85, 30.0, None), ("B0005", 2, None, None, None), ("B0005", None, 1.8, 31.0, None), ("B0006", 1, 2.0, 29.0, None)]
    other = tmp_path / "other"
    other.mkdir()
    (other / "B1.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        public.scan_capacity_csv(spark, str(other))


def test_sources_in_order(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([("x", 3), ("y", 4), ("y", 5), (None, 6)], "k string, v int")
    got = {tuple(r) for r in public.source_precedence([("a", a), ("b", b)], "k").collect()}
    assert got == {("x", 1, "a"), (None, 2, "a"), ("y", 4, "b"), ("y", 5, "b")}

    def unread():
        raise AssertionError("a later source was opened")
    assert public.first_present([("none", lambda: None), ("empty", lambda: a.limit(0)), ("a", lambda: a), ("b", unread)])[0] == "a"
    with pytest.raises(FileNotFoundError):
        public.first_present([("empty", lambda: a.limit(0))])


def test_source_precedence_serves_from_all(spark):
    got = {r["source_name"]: r["batteries"] for r in spark_queries()["source_precedence"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) >= 2 and sum(got.values()) > 0


def test_stream_score_equals_batch_and_reruns_do_not_double(spark, tmp_path):
    rows = spark.range(200).select("id", (F.col("id") % 17).cast("double").alias("x"), (F.col("id") * 0.5).alias("y"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y")]).fit(rows)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows.repartition(6).write.parquet(src)

    def score(df):
        return model.transform(df).select("id", "prediction")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2)
    stream_score(stream.parquet(src), score, out, str(tmp_path / "ck"))
    stream_score(stream.parquet(src), score, out, str(tmp_path / "ck"))  # nothing new
    stream_score(stream.parquet(src), score, out, str(tmp_path / "lost"))  # offsets lost: the same batches again
    want = {r["id"]: r["prediction"] for r in score(rows).collect()}
    got = scored(spark, out).collect()
    assert len(got) == 200 and {r["id"]: r["prediction"] for r in got} == pytest.approx(want)


def test_stream_cycle_agg_equals_batch(spark, tmp_path):
    rows = spark.range(600).select(
        F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("cell_id"),
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        (F.col("id") % 7).cast("double").alias("voltage"), (F.col("id") % 11).cast("double").alias("temperature"),
        (F.col("id") % 50 == 0).cast("int").alias("malformed"))
    rows.write.parquet(str(tmp_path / "src"))
    run_available_now(stream_cycle_agg(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "src"))), str(tmp_path / "out"),
                      str(tmp_path / "ck"))
    batch = stream_cycle_agg(rows)
    end = rows.agg(F.max(F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))).first()[0]
    closed = {tuple(r) for r in batch.where(F.col("window.end") <= F.lit(end) - F.expr("INTERVAL 2 HOURS")).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == closed and len(closed) > 10


def test_load_and_replace_read_back(spark):
    q = spark_queries()
    assert q["load_facts"](spark, SF).agg(F.sum("rows")).first()[0] > 1000
    assert q["replace_predictions"](spark, SF).agg(F.sum("cells")).first()[0] == 10
    assert {r["extract"] for r in q["export_extracts"](spark, SF).where("rows > 0").collect()} == {"executive_health", "lot_quality", "root_cause"}


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="b"):
        cleaning.required_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])
