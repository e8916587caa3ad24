import json

import pytest
from pyspark.sql import functions as F

from fieldwatch.sources.readings import (
    SourceConf,
    parse_readings,
    read_readings_batch,
)

GOOD = {
    "sensor_id": "a",
    "site_id": "SITE_01",
    "timestamp": "2026-01-01T12:00:00+00:00",
    "pollutant_type": "PM2.5",
    "concentration": 420.5,
    "unit": "µg/m³",
}


def message(**changes):
    merged = {**GOOD, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not None}, ensure_ascii=False)


def raw(spark, *texts):
    return spark.createDataFrame([(t.encode() if t else None,) for t in texts], "value binary")


def micros(df):
    return [row[0] for row in df.select(F.unix_micros("event_time")).collect()]


def test_good_message(spark):
    valid, dead = parse_readings(raw(spark, message()))
    row = valid.head()
    assert (row["site_id"], row["concentration"], row["unit"]) == ("SITE_01", 420.5, "µg/m³")
    assert dead.count() == 0


@pytest.mark.parametrize(
    ("stamp", "expected"),
    [
        ("2026-01-01T12:00:00Z", 1767268800_000000),
        ("2026-01-01T12:00:00+05:30", 1767249000_000000),
        ("2026-01-01T12:00:00.123456+00:00", 1767268800_123456),
    ],
)
def test_timestamp_forms(spark, stamp, expected):
    valid, _ = parse_readings(raw(spark, message(timestamp=stamp)))
    assert micros(valid) == [expected]


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("not json", "malformed_json"),
        (message()[:-1], "malformed_json"),
        (message(concentration="high"), "malformed_json"),
        (None, "malformed_json"),
        (message(site_id=None), "missing_site_id"),
        (message(pollutant_type=None), "missing_pollutant_type"),
        (message(timestamp=None), "missing_timestamp"),
        (message(timestamp="garbage"), "bad_timestamp"),
        (message(concentration=None), "missing_concentration"),
        (message(concentration="NaN"), "missing_concentration"),
        (message(concentration="Infinity"), "missing_concentration"),
        (message(concentration="-Infinity"), "missing_concentration"),
    ],
)
def test_dead_letters(spark, text, reason):
    valid, dead = parse_readings(raw(spark, text, message()))
    assert valid.count() == 1
    letters = dead.collect()
    assert [(r["value"], r["reason"]) for r in letters] == [(text, reason)]


def test_file_scan_equals_messages(spark, tmp_path):
    (tmp_path / "a.txt").write_text(message() + "\n" + message(site_id="SITE_02") + "\n")
    source = read_readings_batch(spark, SourceConf("text", path=str(tmp_path)))
    valid, _ = parse_readings(source)
    assert sorted(r["site_id"] for r in valid.collect()) == ["SITE_01", "SITE_02"]


def test_kafka_options():
    conf = SourceConf("kafka", bootstrap_servers="b:1", topic="t", max_per_trigger=9)
    batch = conf.reader_options(streaming=False)
    assert batch == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    assert conf.reader_options(streaming=True)["maxOffsetsPerTrigger"] == "9"


def test_micro_batches_are_bounded_by_default():
    assert "maxOffsetsPerTrigger" in SourceConf("kafka").reader_options(streaming=True)
    assert "maxBytesPerTrigger" in SourceConf("text", path="p").reader_options(streaming=True)
