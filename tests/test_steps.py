"""Micro-batches as tables: states handed on, late readings, repeats, one pass."""

import json

import pytest

from conftest import SCHEMA, alert_rows, at, make_readings
from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.cusum import CusumRule, cusum_alerts, cusum_step
from fieldwatch.operators.dwell import UNSET, fuzzy_alerts, fuzzy_step
from fieldwatch.operators.ema import ema_alerts, ema_step
from fieldwatch.plans.tables import wire_messages
from fieldwatch.sources.thresholds import load_thresholds
from fieldwatch.streaming.sinks import SinkConf
from fieldwatch.streaming.steps import OnePass, SeriesStates, alerts_of_batch, late_and_in_time, step_alerts
from test_streaming import chunks, walk

LIMITS = load_thresholds()
RULE = CusumRule(allowance=0.95)
# Each detector over a whole table, and as a step.
STEPS = {
    "EMAThresholding": (lambda df, **m: ema_alerts(df, LIMITS, **m), ema_step, {}),
    "CUSUMThresholding": (lambda df, **m: cusum_alerts(df, LIMITS, RULE, **m), cusum_step, {"rule": RULE}),
    "FuzzyThresholding": (
        lambda df, **m: fuzzy_alerts(df, LIMITS, max_time=600, delta=60, **m), fuzzy_step, {"max_time": 600, "delta": 60},
    ),
}


@pytest.mark.parametrize(
    ("name", "blocks", "gap"),
    [("EMAThresholding", 4, None), ("CUSUMThresholding", 4, 100), ("FuzzyThresholding", 4, None), ("FuzzyThresholding", 3, 100)],
)
def test_steps_equal_the_whole_table(spark, name, blocks, gap):
    """Cut at many places; with a gap of 100 s a series of steps of 120 s always restarts."""
    whole, step, settings = STEPS[name]
    rows = walk(20, 90) + [(s, p, at(40_000 + i * 30), 1000 + i, x) for i, (s, p, _, _, x) in enumerate(walk(21, 90))]
    begun, found = None, []
    for part in chunks(rows, 3):
        table = spark.createDataFrame(part, SCHEMA)
        alerts, ended = step(table, LIMITS, max_gap=gap, blocks=blocks, begun=begun, **settings)
        found += alert_rows(alerts)
        states = {tuple(row[name] for name in SERIES): row for row in ended.collect()}
        assert set(states) == {row[:2] for row in part}
        if begun is not None:
            ended = ended.unionByName(begun.join(ended, SERIES, "left_anti"))
        begun = spark.createDataFrame(ended.collect(), ended.schema)
    expected = alert_rows(whole(spark.createDataFrame(rows, SCHEMA), max_gap=gap))
    assert sorted(found) == expected and expected


def test_running_timers_are_handed_on_with_a_short_gap(spark):
    """A timer older than the gap between readings still runs: 300 s at 345."""
    first = make_readings(spark, [(i * 50, 345) for i in range(4)])
    second = make_readings(spark, [(200, 345), (250, 345), (300, 345)])
    alerts, ended = fuzzy_step(first, LIMITS, 600, 10, max_gap=60)
    assert alert_rows(alerts) == []
    alerts, ended = fuzzy_step(second, LIMITS, 600, 10, max_gap=60, begun=ended)
    assert [(row[2], row[4]) for row in alert_rows(alerts)] == [(300, 300.0)]
    assert [row["timer"] for row in ended.collect()] == [UNSET]


@pytest.mark.parametrize("name", sorted(STEPS))
def test_stream_of_one_long_series_spreads_over_blocks(spark, tmp_path, name):
    whole, _, settings = STEPS[name]
    rows = [("SITE_01", "PM10", when, number, x) for _, _, when, number, x in walk(22, 400)]
    rows += [("SITE_02", "PM10", at(30), 5000, 500.0)]
    write = step_alerts(f"{tmp_path}/out", name, LIMITS, f"{tmp_path}/states", blocks=6, **settings)
    parts = chunks(sorted(rows, key=lambda r: r[2]), 3)
    for number, part in enumerate(parts):
        batch = spark.createDataFrame(part, SCHEMA)
        write(batch, number)
        if number == 1:
            write(batch, number)  # sent again after a crash
    found = spark.read.parquet(f"{tmp_path}/out/alerts").drop("batch")
    assert alert_rows(found) == alert_rows(whole(spark.createDataFrame(rows, SCHEMA)))
    assert spark.read.parquet(f"{tmp_path}/out/late").count() == 0
    # The state before the last batch is there for a repeat, older ones are gone.
    assert sorted(p.name for p in (tmp_path / "states").glob("batch=*")) == ["batch=1", "batch=2"]


def test_late_readings_are_set_apart(spark):
    begun = spark.createDataFrame(
        [("SITE_01", "PM10", 1.0, int(at(100).timestamp() * 1e6))], "site_id string, pollutant_type string, ema double, last_at long"
    )
    rows = make_readings(spark, [(99, 1), (100, 2), (101, 3)]).unionByName(make_readings(spark, [(1, 4)], site="SITE_02"))
    late, in_time = late_and_in_time(rows, begun)
    assert [row["concentration"] for row in late.collect()] == [1.0]
    assert sorted(row["concentration"] for row in in_time.collect()) == [2.0, 3.0, 4.0]
    late, in_time = late_and_in_time(rows, None)
    assert late.count() == 0 and in_time.count() == 4


def test_states_of_absent_series_stay(spark, tmp_path):
    states = SeriesStates(f"{tmp_path}/states")
    schema = "site_id string, pollutant_type string, ema double, last_at long"
    kept = lambda alerts, late: (alerts.count(), late.count())
    alerts_of_batch(make_readings(spark, [(0, 10)]), 0, "EMAThresholding", LIMITS, states, kept)
    alerts_of_batch(make_readings(spark, [(60, 20)], site="SITE_02"), 1, "EMAThresholding", LIMITS, states, kept)
    begun = states.before(spark, 2)
    assert begun.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert {row["site_id"]: row["ema"] for row in begun.collect()} == {"SITE_01": 10.0, "SITE_02": 20.0}
    assert states.before(spark, 0) is None


def test_every_message_is_accounted_for_once(spark, tmp_path):
    """Alerts, unusable and late messages of one read, also when a batch is sent again."""
    good = [[(0, 440.0), (60, 100.0)], [(30, 440.0), (120, 440.0)]]
    bad = [["no json", None], ['{"site_id": "S"}']]
    job = OnePass("EMAThresholding", LIMITS, SinkConf("parquet", path=f"{tmp_path}/rows"), f"{tmp_path}/states", "dead", settings={"alpha": 1.0})
    for number, (rows, broken) in enumerate(zip(good, bad, strict=True)):
        messages = wire_messages(make_readings(spark, rows)).unionByName(
            spark.createDataFrame([(value,) for value in broken], "value string")
        )
        for _ in range(2):
            job(messages, number)
    sent = [row.asDict() for row in spark.read.parquet(f"{tmp_path}/rows").collect()]
    alerts = [json.loads(row["value"]) for row in sent if row["topic"] == "alerts_severe"]
    assert sorted(row["event_time"] for row in alerts) == ["2024-01-01T00:00:00.000000Z", "2024-01-01T00:02:00.000000Z"]
    reasons = sorted(json.loads(row["value"])["reason"] for row in sent if row["topic"] == "dead")
    assert reasons == ["late_reading", "malformed_json", "malformed_json", "missing_pollutant_type"]
    assert len(sent) == 6


def test_detectors_without_memory_need_no_states(spark, tmp_path):
    job = OnePass("Thresholding", LIMITS, SinkConf("parquet", path=f"{tmp_path}/rows"), f"{tmp_path}/states", "dead")
    job(wire_messages(make_readings(spark, [(0, 440.0), (60, 360.0)])), 0)
    assert sorted(row["topic"] for row in spark.read.parquet(f"{tmp_path}/rows").collect()) == ["alerts_internal", "alerts_severe"]
    assert not (tmp_path / "states").exists()
