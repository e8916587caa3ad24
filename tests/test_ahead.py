"""Targets by time against a search through each series, for many ways to cut blocks."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SCHEMA, START, at
from fieldwatch.operators import ahead
from fieldwatch.operators.ahead import first_at_or_after
from fieldwatch.operators.history import TARGETS, forecast_training_set, lead_targets
from fieldwatch.operators.thresholding import classify_readings
from fieldwatch.sources.thresholds import load_thresholds

LIMITS = load_thresholds()
WAITS = {"soon": 900, "later": 3600, "late": 10_800}


def severity(x):
    return 2 if x >= 430 else 1 if x >= 350 else 0


def expected(rows):
    by_series = {}
    for row in rows:
        by_series.setdefault(row[:2], []).append(row)
    found = []
    for part in by_series.values():
        part = sorted(part, key=lambda r: (r[2], r[3], r[4]))
        for row in part:
            ahead_of = [
                next((severity(o[4]) for o in part if (o[2] - row[2]).total_seconds() >= wait), None)
                for wait in WAITS.values()
            ]
            found.append((row[0], row[1], row[3], severity(row[4]), *ahead_of))
    return sorted(found, key=repr)


def found(spark, rows, blocks, **more):
    table = classify_readings(spark.createDataFrame(rows, SCHEMA), LIMITS)
    result = first_at_or_after(table, WAITS, blocks, **more)
    columns = ["site_id", "pollutant_type", "event_id", "severity", *WAITS]
    return sorted((tuple(row) for row in result.select(*columns).collect()), key=repr)


def made(seed, lengths, steps):
    """Series of the given lengths; distances of readings are drawn from ``steps`` (seconds)."""
    rng = random.Random(seed)
    rows = []
    for series, length in enumerate(lengths):
        seconds = 0
        for _ in range(length):
            seconds += rng.choice(steps)
            value = rng.choice([100.0, 355.0, 440.0])
            rows.append((f"SITE_{series // 2}", "PM10" if series % 2 else "PM2.5", at(seconds), len(rows), value))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [1, 5, 40])
@pytest.mark.parametrize(
    "steps",
    [[0, 60, 900], [1, 5, 20], [900], [0, 300, 40_000], [0, 0, 1, 86_400]],
    ids=["plain", "dense", "exact", "gaps", "bursts"],
)
def test_equals_a_search_in_each_series(spark, blocks, steps):
    rows = made(blocks, [150, 1, 30, 2], steps)
    assert found(spark, rows, blocks) == expected(rows)


def test_a_block_that_is_asked_often_answers_in_several_tasks(spark):
    """A dense hour, whose readings all ask one block of the sparse hours after it."""
    dense = [("S", "PM10", at(i * 10), i, 100.0) for i in range(300)]
    sparse = [("S", "PM10", at(3000 + i * 1500), 1000 + i, 355.0 + 80 * (i % 2)) for i in range(40)]
    for requests in (1 << 20, 25, 3):
        assert found(spark, dense + sparse, 6, requests=requests) == expected(dense + sparse)


def test_number_of_blocks_does_not_change_the_training_set(spark):
    rows = made(7, [120, 80], [60, 700, 7200])
    readings = spark.createDataFrame(rows, SCHEMA)
    sets = [
        sorted(map(tuple, forecast_training_set(readings, LIMITS, blocks=blocks, mode="time").collect()), key=repr)
        for blocks in (1, 3, 17)
    ]
    assert sets[0] == sets[1] == sets[2]
    assert len(sets[0]) == len(rows)


def test_modes_agree_where_readings_come_every_quarter_of_an_hour(spark):
    rows = made(8, [90, 40], [900])
    classified = classify_readings(spark.createDataFrame(rows, SCHEMA), LIMITS)
    columns = ["site_id", "pollutant_type", "event_id", *TARGETS.values()]
    by_rows, by_time = (
        sorted(map(tuple, lead_targets(classified, 4, mode=mode).select(*columns).collect()), key=repr)
        for mode in ("rows", "time")
    )
    assert by_rows == by_time


def test_unusable_rows_and_empty_tables(spark):
    rows = [("S", "PM10", at(0), 1, 440.0), ("S", "PM10", None, 2, 1.0), (None, "PM10", at(900), 3, 1.0)]
    rows += [("S", "PM10", at(900), 4, float("nan")), ("S", "PM10", at(901), 5, 355.0)]
    assert found(spark, rows, 2) == expected([rows[0], rows[4]])
    empty = classify_readings(spark.createDataFrame([], SCHEMA), LIMITS)
    result = first_at_or_after(empty, WAITS)
    assert result.collect() == [] and list(WAITS) == result.columns[-3:]


def test_waits_and_modes_are_checked(spark):
    table = classify_readings(spark.createDataFrame([("S", "PM10", START, 1, 1.0)], SCHEMA), LIMITS)
    with pytest.raises(ValueError, match="longer than zero"):
        first_at_or_after(table, {"now": 0})
    with pytest.raises(ValueError, match="unknown mode"):
        lead_targets(table, mode="days")


def test_halo_holds_only_rows_within_the_longest_wait(spark, monkeypatch):
    """What a block sends of its own rows does not grow with the block."""
    kept = []
    real = ahead.materialise
    monkeypatch.setattr(ahead, "materialise", lambda df: kept.append(real(df)) or kept[-1])
    rows = [("S", "PM10", at(i * 600), i, 100.0) for i in range(2000)]
    assert found(spark, rows, 4) == expected(rows)
    halos = kept[0].filter("halo").groupBy("block").agg(F.count("*").alias("rows")).collect()
    assert len(halos) == 3 and all(row["rows"] <= 10_800 // 600 + 1 for row in halos)
