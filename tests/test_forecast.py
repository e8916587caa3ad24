import json
import math
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import SCHEMA, at, make_readings
from fieldwatch.functions.columns import HORIZONS
from fieldwatch.operators.forecast import (
    ForecastModel,
    _margin,
    all_cells,
    fit_forecaster,
    forecast_alerts,
    forecast_score,
    train_forecaster,
    untrained_model,
    with_cell,
)
from fieldwatch.operators.history import (
    TARGETS,
    forecast_features,
    forecast_training_set,
    label_balance,
    training_coverage,
    training_window,
)
from fieldwatch.sources.thresholds import load_thresholds
from fieldwatch.streaming import jobs
from fieldwatch.streaming.jobs import forecast_messages, load_or_train, run
from fieldwatch.streaming.sinks import TOPICS
from test_sinks import job, send

LIMITS = load_thresholds()
FIT = {"rounds": 3, "bins": 64}


def grid(spark, days=30):
    """A daily cycle on a 15-minute grid: 5 sites, 2 pollutants."""
    steps = spark.range(days * 96).selectExpr(
        "id", "timestamp_seconds(1704067200 + id * 900) AS event_time"
    )
    sites = spark.range(1, 6).selectExpr("id AS i")
    kinds = spark.range(2).selectExpr("if(id = 0, 'PM2.5', 'PM10') AS pollutant_type")
    rows = steps.join(sites).join(kinds)
    phase = 2 * math.pi * (F.hour("event_time") + F.minute("event_time") / 60) / 24
    noise = (F.floor(F.unix_timestamp("event_time") / 900) * 7 + F.col("i") * 3) % 21 - 10
    return rows.select(
        F.concat(F.lit("SITE_0"), F.col("i").cast("string")).alias("site_id"),
        "pollutant_type",
        "event_time",
        F.col("id").alias("event_id"),
        F.round(250 + 220 * F.sin(phase) + noise, 3).alias("concentration"),
    )


@pytest.fixture(scope="module")
def history(spark):
    return grid(spark).cache()


@pytest.fixture(scope="module")
def model(history):
    return fit_forecaster(forecast_training_set(history, LIMITS), **FIT)


def test_grid_is_the_described_one(history):
    value = F.col("concentration")
    counts = history.agg(
        F.count_if(value < 350), F.count_if((value >= 350) & (value < 430)), F.count_if(value >= 430)
    ).head()
    assert tuple(counts) == (18600, 4500, 5700)


def test_coverage(spark, history):
    row = training_coverage(history).head()
    assert row["ready"] and round(row["span_days"], 3) == 29.99
    assert not training_coverage(make_readings(spark, [(0, 1), (4.9 * 86400, 1)])).head()["ready"]
    assert training_coverage(make_readings(spark, [(0, 1), (5 * 86400, 1)])).head()["ready"]
    empty = training_coverage(spark.createDataFrame([], SCHEMA)).head()
    assert empty["span_days"] is None and empty["ready"] is False


def test_window_keeps_the_last_days(spark):
    rows = make_readings(spark, [(0, 1), (86400, 2), (86400 - 1, 3), (16 * 86400, 4)])
    assert sorted(r["concentration"] for r in training_window(rows).collect()) == [2, 4]
    newest = 1704067200_000000 + 16 * 86400_000000
    known = training_window(rows, newest=newest)
    assert sorted(r["concentration"] for r in known.collect()) == [2, 4]


def test_features(spark):
    row = forecast_features(make_readings(spark, [(13 * 3600 + 59, 250)])).head()
    assert (row["concentration_norm"], row["hour"], row["day_of_week"]) == (0.25, 13, 0)
    sunday = forecast_features(make_readings(spark, [(6 * 86400, 250)])).head()
    assert sunday["day_of_week"] == 6


def test_beats_the_majority_class(history, model):
    scored = forecast_score(history, model).filter(F.col("site_id") == "SITE_03")
    names = {0: "green_yellow", 1: "orange", 2: "red"}
    training = forecast_training_set(history, LIMITS).filter(F.col("site_id") == "SITE_03")
    for name, target in TARGETS.items():
        actual = training.select(
            "pollutant_type",
            "event_time",
            F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col(target)].alias("actual"),
        ).filter("actual IS NOT NULL")
        joined = scored.filter(F.col("timescale") == name).join(actual, ["pollutant_type", "event_time"])
        row = joined.agg(
            F.avg((F.col("predicted_category") == F.col("actual")).cast("double")).alias("hit"),
            *(F.avg((F.col("actual") == n).cast("double")).alias(n) for n in names.values()),
        ).head()
        assert row["hit"] > max(row[n] for n in names.values()) + 0.1


def test_table_equals_the_trees(spark, model):
    """The scoring table says what the fitted trees say for every cell."""
    from pyspark.ml.feature import VectorAssembler

    assemble = VectorAssembler(inputCols=["bin", "hour", "day_of_week"], outputCol="features")
    cells = assemble.transform(all_cells(spark, model.edges)).select("bin", "hour", "day_of_week", "features")
    rows = cells.collect()[::97]
    table = {(r["bin"], r["hour"], r["day_of_week"]): r for r in model.table.collect()}
    assert len(table) == (len(model.edges) + 1) * 24 * 7
    for name, boosters in model.boosters.items():
        for row in rows:
            margins = {c: b.predictRaw(row["features"])[1] for c, b in boosters.items()}
            best = max(margins, key=lambda c: (margins[c], -c))
            assert table[(row["bin"], row["hour"], row["day_of_week"])][name] == best
    assert _margin("1hr", 2) == "margin_1hr_2"


def test_bins_follow_the_edges(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (0.25,), (9.0,)], "concentration_norm double")
    found = [r["bin"] for r in with_cell(rows, [0.2, 0.3]).collect()]
    assert found == [0, 1, 1, 2]


def test_save_and_load(spark, history, model, tmp_path):
    model.save(str(tmp_path / "model"))
    loaded = ForecastModel.load(spark, str(tmp_path / "model"))
    part = history.filter(F.col("site_id") == "SITE_01")
    first, second = forecast_score(part, model), forecast_score(part, loaded)
    assert first.exceptAll(second).count() == 0 and first.count() == second.count()


def test_single_class_history_predicts_that_class(spark):
    rows = make_readings(spark, [(i * 900, 500) for i in range(50)])
    fitted = fit_forecaster(forecast_training_set(rows, LIMITS), **FIT)
    assert fitted.boosters == {}
    found = {r["predicted_category"] for r in forecast_score(rows, fitted).collect()}
    assert found == {"red"}


def test_no_history_predicts_green_yellow(spark):
    rows = make_readings(spark, [(0, 500), (1, math.nan)])
    empty = spark.createDataFrame([], SCHEMA)
    for fitted in (
        untrained_model(spark),
        train_forecaster(empty, LIMITS),
        train_forecaster(rows, LIMITS),
        fit_forecaster(forecast_training_set(empty, LIMITS), **FIT),
    ):
        found = forecast_score(rows, fitted).collect()
        assert len(found) == 6
        assert {r["predicted_category"] for r in found} == {"green_yellow"}
        assert {r["timescale"] for r in found} == set(HORIZONS)


def test_bins_are_bounded(history):
    with pytest.raises(ValueError):
        fit_forecaster(history, bins=5000)


def test_label_balance(spark):
    rows = make_readings(spark, [(i, x) for i, x in enumerate([0, 400, 500, 0, 0])])
    found = {r["timescale"]: r for r in label_balance(forecast_training_set(rows, LIMITS)).collect()}
    one = found["15min"]
    assert (one["class_0"], one["class_1"], one["class_2"], one["classes"]) == (2, 1, 1, 3)
    assert found["3hr"]["classes"] == 0


def test_alerts_come_once_and_name_the_limit(spark):
    found = forecast_alerts(make_readings(spark, [(0, 349), (1, 400), (2, 700)]), LIMITS).collect()
    assert sorted((r["metric_value"], r["alert_category"]) for r in found) == [
        (350.0, "orange"),
        (430.0, "red"),
    ]


def test_messages_equal_scores_and_alerts(history, model):
    part = history.filter((F.col("site_id") == "SITE_02") & (F.col("event_time") < "2024-01-03"))
    messages = forecast_messages(part, LIMITS, model, TOPICS).cache()
    sent = messages.filter(F.col("topic") == TOPICS["forecast"]).select(
        F.get_json_object("value", "$.event_time").cast("timestamp").alias("event_time"),
        F.get_json_object("value", "$.pollutant_type").alias("pollutant_type"),
        F.get_json_object("value", "$.timescale").alias("timescale"),
        F.get_json_object("value", "$.predicted_category").alias("predicted_category"),
    )
    scored = forecast_score(part, model).select(*sent.columns)
    assert sent.count() == scored.count() == part.count() * 3
    assert sent.exceptAll(scored).count() == 0
    alerts = {r["alert_category"]: r["count"] for r in forecast_alerts(part, LIMITS).groupBy("alert_category").count().collect()}
    topics = {r["topic"]: r["count"] for r in messages.groupBy("topic").count().collect()}
    assert topics[TOPICS["orange"]] == alerts["orange"] and topics[TOPICS["red"]] == alerts["red"]


def test_forecast_job_trains_saves_and_scores_a_stream(spark, tmp_path, model):
    """The job scores with a saved model; a source too short to train on stands in."""
    rows = [("SITE_01", "PM10", at(i * 900), i, 300.0 + i % 200) for i in range(80)]
    send(spark, tmp_path, "a", rows)
    conf = job(tmp_path, detector="XGBoostForecasting", model_path=f"{tmp_path}/model")
    assert load_or_train(spark, conf, LIMITS).boosters == {}
    model.save(conf.model_path)
    run("anomaly", conf, spark)
    out = spark.read.parquet(f"{tmp_path}/out")
    topics = {r["topic"]: r["count"] for r in out.groupBy("topic").count().collect()}
    assert topics == {"alerts_forecasts": 240, "alerts_internal": 30}


def test_a_running_job_goes_over_to_a_newly_saved_model(spark, tmp_path, monkeypatch):
    """The stand-in says green_yellow until a model that says red is saved."""
    monkeypatch.setattr(jobs, "WAIT_SECONDS", 1)
    red = make_readings(spark, [(i * 900, 500) for i in range(50)])
    always_red = fit_forecaster(forecast_training_set(red, LIMITS), **FIT)
    conf = job(tmp_path, detector="XGBoostForecasting", model_path=f"{tmp_path}/model", available_now=False)

    def said(expected):
        for _ in range(240):
            if (tmp_path / "out" / "_spark_metadata").exists():
                out = spark.read.schema("key string, value string, topic string").parquet(f"{tmp_path}/out")
                values = out.filter("topic = 'alerts_forecasts'")
                found = [json.loads(r["value"]) for r in values.collect()]
                if len(found) == len(expected):
                    return sorted((r["event_time"], r["predicted_category"]) for r in found) == sorted(expected)
            time.sleep(0.5)
        return False

    def forecasts(seconds, category):
        return [(f"2024-01-01T00:00:0{seconds}.000000Z", category)] * 3

    send(spark, tmp_path, "a", [("SITE_01", "PM10", at(0), 0, 10.0)])
    thread = threading.Thread(target=run, args=("anomaly", conf, spark))
    thread.start()
    try:
        assert said(forecasts(0, "green_yellow"))
        first = {query.runId for query in spark.streams.active}
        always_red.save(conf.model_path)
        for _ in range(240):
            now = {query.runId for query in spark.streams.active}
            if now and not now & first:
                break
            time.sleep(0.5)
        send(spark, tmp_path, "b", [("SITE_01", "PM10", at(1), 1, 10.0)])
        assert said(forecasts(0, "green_yellow") + forecasts(1, "red"))
    finally:
        for query in spark.streams.active:
            query.stop()
        thread.join(60)
    assert not thread.is_alive()


def test_training_time_does_not_need_targets_in_memory(history):
    """Training shrinks to cells: at most one row per cell, whatever the history."""
    from fieldwatch.operators.forecast import bin_edges, class_counts

    training = forecast_training_set(history, LIMITS)
    edges = bin_edges(training, 16)
    assert len(edges) <= 15
    assert class_counts(training, edges).count() <= 16 * 24 * 7
