"""Sums by hour and day that micro-batches add to."""

import random

from conftest import SCHEMA, at
from fieldwatch.functions.schemas import DAILY_KEY, HOURLY_KEY
from fieldwatch.operators.rollup import daily_rollup, daily_weighted, hourly_avg
from fieldwatch.streaming import snapshots
from fieldwatch.streaming.snapshots import TableFolder
from fieldwatch.streaming.sums import add_sums, read_means


def made(seed, count):
    rng = random.Random(seed)
    return [(f"S{rng.randrange(2)}", "PM10", at(rng.randrange(3 * 86_400)), i, float(rng.randrange(500))) for i in range(count)]


def days_of(df):
    return sorted((r["site_id"], str(r["log_date"]), round(r["daily_avg"], 9), r["readings"]) for r in df.collect())


def test_batches_in_any_order_add_up_to_all_readings(spark, tmp_path, monkeypatch):
    """Also when days are folded in between, and batches are sent again."""
    monkeypatch.setattr(snapshots, "MOST_PARTS", 3)
    rows = made(1, 240)
    hourly, daily = f"{tmp_path}/hourly", f"{tmp_path}/daily"
    write = add_sums(hourly, daily, "job")
    for batch in range(6):
        part = spark.createDataFrame(rows[batch * 40 : batch * 40 + 40], SCHEMA)
        write(part, batch)
        if batch in (2, 5):
            write(part, batch)
            add_sums(hourly, daily, "job")(part, batch)  # after a restart
    table = spark.createDataFrame(rows, SCHEMA)
    assert days_of(read_means(spark, daily, DAILY_KEY, "daily_avg")) == days_of(daily_weighted(table))
    hours = {(r["site_id"], r["start_time"]): round(r["avg_value"], 9) for r in hourly_avg(table).collect()}
    found = read_means(spark, hourly, HOURLY_KEY, "avg_value").collect()
    assert {(r["site_id"], r["start_time"]): round(r["avg_value"], 9) for r in found} == hours
    assert len(TableFolder(spark, daily).snapshot().parts) <= 3 * 3
    one = read_means(spark, daily, DAILY_KEY, "daily_avg", ["2024-01-02"])
    assert days_of(one) == [row for row in days_of(daily_weighted(table)) if row[1] == "2024-01-02"]


def test_hours_weigh_by_their_readings(spark):
    rows = [("S", "PM10", at(0), 0, 0.0), ("S", "PM10", at(1), 1, 0.0), ("S", "PM10", at(3600), 2, 90.0)]
    rows += [("S", "PM10", at(2), 3, float("nan")), ("S", "PM10", at(2), 4, None)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert days_of(daily_weighted(table)) == [("S", "2024-01-01", 30.0, 3)]
    assert [r["daily_avg"] for r in daily_rollup(hourly_avg(table.filter("event_id < 3"))).collect()] == [45.0]
    assert daily_weighted(table.limit(0)).collect() == []
