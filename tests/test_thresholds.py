import math

import pytest

from conftest import alert_rows, at, make_readings
from fieldwatch.operators.dwell import fuzzy_alerts
from fieldwatch.operators.ema import ema_alerts
from fieldwatch.operators.registry import DETECTORS, detect
from fieldwatch.operators.thresholding import (
    classify_readings,
    internal_alerts,
    open_orange_alerts,
    severe_alerts,
    threshold_alerts,
)
from fieldwatch.sources.thresholds import Thresholds, load_thresholds, parse_thresholds

EDGES = [349.999, 350, 429.999, 430, 1000, 5000]


def gap_thresholds():
    return Thresholds({"PM10": {"orange_min": 350.0, "orange_max": 400.0, "red_min": 430.0}})


def test_shipped_limits():
    limits = load_thresholds().limits
    assert set(limits) == {"PM2.5", "PM10"}
    assert limits["PM10"]["orange_min"] == 350 and limits["PM2.5"]["red_max"] == 1000


def test_yaml_with_comments_and_missing_bands(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "limits.yaml"
    path.write_text("O3:\n  orange: {min: 1, max: 2}\n  red: {min: 2, max: 3}\n# NO2: 5\nSO2:\n")
    found = load_thresholds(path).limits
    assert set(found) == {"O3"}
    assert found["O3"]["red_min"] == 2 and "green_min" not in found["O3"]


@pytest.mark.parametrize(
    "row",
    [
        {"orange": {"min": 5, "max": 4}, "red": {"min": 6}},
        {"orange": {"min": 5, "max": 7}, "red": {"min": 6}},
        {"orange": {"min": 5, "max": 6}},
    ],
)
def test_bad_limits_are_refused(row):
    with pytest.raises(ValueError):
        parse_thresholds({"X": row})


def test_edges_of_the_bands(spark):
    df = make_readings(spark, list(enumerate(EDGES)))
    orange = [row[3] for row in alert_rows(internal_alerts(df, load_thresholds()))]
    red = [row[3] for row in alert_rows(severe_alerts(df, load_thresholds()))]
    assert orange == [350, 429.999]
    assert red == [430, 1000, 5000]
    both = alert_rows(threshold_alerts(df, load_thresholds()))
    assert [row[6] for row in both] == ["orange", "orange", "red", "red", "red"]
    assert all(row[4] == row[3] and row[5] == "hard_threshold" for row in both)


def test_gap_between_orange_and_red(spark):
    df = make_readings(spark, list(enumerate([399, 400, 429, 430])))
    limits = gap_thresholds()
    assert [r[3] for r in alert_rows(threshold_alerts(df, limits))] == [399, 430]
    assert [r[3] for r in alert_rows(ema_alerts(df, limits, alpha=1.0))] == [399, 430]
    assert [r[3] for r in alert_rows(open_orange_alerts(df, limits))] == [399, 400, 429, 430]
    fuzzy = alert_rows(fuzzy_alerts(df, limits, max_time=60, delta=10))
    assert [r[3] for r in fuzzy if r[5] == "hard_threshold"] == [399, 400, 429, 430]


@pytest.mark.parametrize("name", sorted(DETECTORS))
def test_unknown_pollutant_and_unusable_values_are_silent(spark, name):
    rows = [
        ("SITE_01", "O3", at(0), 0, 900.0),
        ("SITE_01", "PM10", at(1), 1, None),
        ("SITE_01", "PM10", at(2), 2, math.nan),
        (None, "O3", at(3), 3, 900.0),
    ]
    schema = "site_id string, pollutant_type string, event_time timestamp, event_id bigint, concentration double"
    df = spark.createDataFrame(rows, schema)
    assert detect(name, df, load_thresholds()).count() == 0


def test_no_limits_no_alerts(spark):
    df = make_readings(spark, [(0, 900)])
    assert threshold_alerts(df, Thresholds({})).count() == 0
    assert ema_alerts(df, Thresholds({})).count() == 0


def test_severity_ignores_orange_max(spark):
    df = make_readings(spark, list(enumerate([10, 350, 415, 430])))
    found = classify_readings(df, gap_thresholds()).orderBy("event_time").collect()
    assert [r["severity"] for r in found] == [0, 1, 1, 2]
    assert [r["alert_category"] for r in found] == ["clean", "orange", "orange", "red"]
    other = make_readings(spark, [(0, 900)], pollutant="O3")
    assert classify_readings(other, gap_thresholds()).head()["severity"] == 0


def test_unknown_detector_is_refused(spark):
    with pytest.raises(ValueError):
        detect("NoSuchDetector", make_readings(spark, [(0, 1)]), load_thresholds())
