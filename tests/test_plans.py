"""Plans: what has to reach the scan, and how often rows are shuffled."""

import re

import pytest

from conftest import SCHEMA, make_readings
from fieldwatch.operators.forecast import forecast_alerts, forecast_score, untrained_model
from fieldwatch.operators.history import forecast_features, training_window
from fieldwatch.operators.rollup import hourly_avg, hourly_retained
from fieldwatch.operators.thresholding import (
    classify_readings,
    internal_alerts,
    severe_alerts,
    threshold_alerts,
)
from fieldwatch.sources.readings import parse_readings
from fieldwatch.sources.thresholds import Thresholds, load_thresholds
from fieldwatch.streaming.sinks import envelope, latest_rows, route_alerts

LIMITS = load_thresholds()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    make_readings(spark, [(i, i) for i in range(500)]).write.mode("overwrite").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


NARROW = {
    "classify": lambda df: classify_readings(df, LIMITS),
    "internal": lambda df: internal_alerts(df, LIMITS),
    "severe": lambda df: severe_alerts(df, LIMITS),
    "all": lambda df: threshold_alerts(df, LIMITS),
    "routed": lambda df: envelope(route_alerts(threshold_alerts(df, LIMITS))),
    "features": forecast_features,
    "forecast_alerts": lambda df: forecast_alerts(df, LIMITS),
    "score": lambda df: forecast_score(df, untrained_model(df.sparkSession)),
}


@pytest.mark.parametrize("name", sorted(NARROW))
def test_narrow_operators_neither_shuffle_nor_call_python(stored, name):
    text = plan(NARROW[name](stored))
    assert shuffles(text) == 0
    assert not re.search(r"Python|Pandas|MapInArrow", text)


def test_limits_reach_the_scan(stored):
    text = plan(severe_alerts(stored, LIMITS))
    assert "GreaterThanOrEqual(concentration,430.0)" in text
    assert "GreaterThanOrEqual(concentration,350.0)" in plan(internal_alerts(stored, LIMITS))


def test_scan_reads_needed_columns_only(stored):
    text = plan(hourly_avg(stored))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "event_id" not in read


def test_rollup_aggregates_before_its_one_shuffle(stored):
    text = plan(hourly_avg(stored))
    assert shuffles(text) == 1
    assert "partial_avg" in text


def test_retention_limits_rows_before_the_shuffle(stored):
    text = plan(hourly_retained(hourly_avg(stored)))
    assert text.count("WindowGroupLimit") == 2


def test_upsert_read_aggregates_before_its_one_shuffle(stored):
    versions = stored.selectExpr("site_id", "concentration AS avg_value", "event_id AS batch_id")
    text = plan(latest_rows(versions, ["site_id"]))
    assert shuffles(text) == 1 and "partial_max_by" in text


def test_messages_are_parsed_once(stored):
    valid, dead = parse_readings(stored.selectExpr("site_id AS value"))
    for frame in (valid, dead):
        assert plan(frame).count("from_json") == 1


def test_window_needs_no_join(stored):
    text = plan(training_window(stored))
    assert "Join" not in text and "Subquery" in text
    assert "GreaterThanOrEqual(event_time" in plan(training_window(stored, newest=10**15))


def test_long_limit_tables_join_without_a_forced_broadcast(stored):
    row = {"orange_min": 1.0, "orange_max": 2.0, "red_min": 3.0}
    many = Thresholds({f"P{i}": row for i in range(10_001)})
    few = Thresholds({f"P{i}": row for i in range(10)})
    hinted = "strategy=broadcast"
    logical = lambda df: df._jdf.queryExecution().logical().toString()
    assert hinted in logical(severe_alerts(stored, few))
    assert hinted not in logical(severe_alerts(stored, many))
