"""Streams against the same rows as a table."""

import random
from collections import Counter

import pytest

from conftest import SCHEMA, alert_rows, at, make_readings
from fieldwatch.operators.cusum import CusumRule, cusum_alerts
from fieldwatch.operators.dwell import UNSET, fuzzy_alerts, fuzzy_state
from fieldwatch.operators.ema import ema_alerts, ema_series
from fieldwatch.operators.rollup import hourly_avg, hourly_retained
from fieldwatch.operators.thresholding import threshold_alerts
from fieldwatch.sources.thresholds import load_thresholds
from fieldwatch.streaming.detectors import series_state
from fieldwatch.streaming.retention import newest_hours, retained_hours
from fieldwatch.streaming.sinks import upsert_files

LIMITS = load_thresholds()


def write_parts(spark, folder, parts):
    """Each part becomes one file; names follow the order of arrival."""
    for number, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{number:03d}")


def stream_of(spark, folder):
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", "true").parquet(f"{folder}/in")


def drain(spark, alerts, folder):
    """Work off the input; more input and another call go on from the checkpoint."""
    query = (
        alerts.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{folder}/out")


def walk(seed, size, step=60):
    rng = random.Random(seed)
    rows, x = [], 340.0
    for i in range(size):
        x = min(500.0, max(0.0, x + rng.choice([-4, -1, 0, 1, 1, 4])))
        rows.append((f"SITE_{i % 2 + 1:02d}", "PM10", at(i * step), i, x if i % 9 else 425.0))
    return rows


def chunks(rows, count):
    size = -(-len(rows) // count)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


DETECTORS = {
    "cusum": lambda df, **more: cusum_alerts(df, LIMITS, CusumRule(allowance=0.95), **more),
    "ema": lambda df, **more: ema_alerts(df, LIMITS, **more),
    "fuzzy": lambda df, **more: fuzzy_alerts(df, LIMITS, max_time=600, delta=60, **more),
}


@pytest.mark.parametrize("name", sorted(DETECTORS))
@pytest.mark.parametrize("count", [1, 4])
def test_stream_equals_batch(spark, tmp_path, name, count):
    rows = walk(1, 240)
    write_parts(spark, tmp_path, chunks(rows, count))
    found = drain(spark, DETECTORS[name](stream_of(spark, tmp_path)), tmp_path)
    expected = DETECTORS[name](spark.createDataFrame(rows, SCHEMA))
    assert alert_rows(expected)
    assert alert_rows(found) == alert_rows(expected)


@pytest.mark.parametrize("name", sorted(DETECTORS))
def test_gap_restarts_series_on_both(spark, tmp_path, name):
    rows = walk(2, 120)
    later = [(s, p, at(86400 + i * 60), 1000 + i, x) for i, (s, p, _, _, x) in enumerate(walk(3, 60))]
    write_parts(spark, tmp_path, [rows, later])
    found = drain(spark, DETECTORS[name](stream_of(spark, tmp_path), max_gap=3600), tmp_path)
    table = spark.createDataFrame(rows + later, SCHEMA)
    with_gap = alert_rows(DETECTORS[name](table, max_gap=3600))
    assert alert_rows(found) == with_gap
    if name == "ema":
        assert with_gap != alert_rows(DETECTORS[name](table))


def test_restart_goes_on_from_state(spark, tmp_path):
    rows = walk(4, 200)
    first, second = chunks(rows, 2)
    write_parts(spark, tmp_path, [first])
    drain(spark, DETECTORS["ema"](stream_of(spark, tmp_path)), tmp_path)
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/100")
    found = drain(spark, DETECTORS["ema"](stream_of(spark, tmp_path)), tmp_path)
    expected = DETECTORS["ema"](spark.createDataFrame(rows, SCHEMA))
    assert alert_rows(found) == alert_rows(expected)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    """Spark drops by the watermark of the batch before, so one batch lies between."""
    parts = [
        [("SITE_01", "PM10", at(0), 0, 400.0)],
        [("SITE_01", "PM10", at(25200), 1, 400.0)],
        [("SITE_01", "PM10", at(25201), 2, 400.0)],
        [("SITE_01", "PM10", at(3600), 3, 400.0), ("SITE_01", "PM10", at(28800), 4, 400.0)],
    ]
    write_parts(spark, tmp_path, parts)
    found = drain(spark, DETECTORS["ema"](stream_of(spark, tmp_path)), tmp_path)
    assert [row[2] for row in alert_rows(found)] == [0, 25200, 25201, 28800]


@pytest.mark.parametrize("name", sorted(DETECTORS))
def test_strict_order_sorts_across_batches(spark, tmp_path, name):
    """Rows late by up to 20 minutes still fold in order within a 1 hour watermark."""
    rows = walk(5, 240)
    rng = random.Random(6)
    arrival = sorted(rows, key=lambda r: r[2].timestamp() + rng.uniform(0, 1200))
    last = rows[-1][2].timestamp() - at(0).timestamp()
    closing = [("SITE_09", "PM10", at(last + 2 * 86400), 9999, 0.0)]
    write_parts(spark, tmp_path, [*chunks(arrival, 5), closing])
    stream = stream_of(spark, tmp_path)
    found = drain(spark, DETECTORS[name](stream, strict_order=True, watermark="1 hour"), tmp_path)
    expected = DETECTORS[name](spark.createDataFrame(rows, SCHEMA))
    assert alert_rows(found) == alert_rows(expected)


def test_stateless_stream_equals_batch(spark, tmp_path):
    rows = walk(7, 100)
    write_parts(spark, tmp_path, chunks(rows, 3))
    found = drain(spark, threshold_alerts(stream_of(spark, tmp_path), LIMITS), tmp_path)
    expected = threshold_alerts(spark.createDataFrame(rows, SCHEMA), LIMITS)
    assert alert_rows(found) == alert_rows(expected)


def test_hourly_stream_updates_and_drops_late_hours(spark, tmp_path):
    parts = [
        [("SITE_01", "PM10", at(0), 0, 10.0)],
        [("SITE_01", "PM10", at(60), 1, 20.0), ("SITE_01", "PM10", at(5 * 3600), 2, 50.0)],
        [("SITE_01", "PM10", at(5 * 3600), 3, 70.0)],
        [("SITE_01", "PM10", at(120), 4, 1000.0), ("SITE_01", "PM10", at(5 * 3600), 5, 90.0)],
    ]
    write_parts(spark, tmp_path, parts)
    emitted = []

    def keep(batch, batch_id):
        emitted.extend((batch_id, r["start_time"].hour, r["avg_value"]) for r in batch.collect())

    query = (
        hourly_avg(stream_of(spark, tmp_path))
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    values = [(hour, value) for _, hour, value in emitted]
    assert Counter(values) == Counter([(0, 10.0), (0, 15.0), (5, 50.0), (5, 60.0), (5, 70.0)])


def test_input_order_does_not_change_a_batch(spark):
    rows = walk(8, 150)
    mixed = rows[:]
    random.Random(9).shuffle(mixed)
    for detector in DETECTORS.values():
        straight = alert_rows(detector(spark.createDataFrame(rows, SCHEMA)))
        assert alert_rows(detector(spark.createDataFrame(mixed, SCHEMA))) == straight


def micro(rows):
    return [(seconds, name) for _, _, seconds, _, _, name, _ in rows]


def test_rule_table_of_the_fuzzy_detector(spark):
    """One series through every case: limit(x) is 600 s at 340 and 0 at 350."""
    rows = [
        (0, 345),  # orange band: timer starts, 300 s allowed
        (299, 345),  # not yet
        (300, 345),  # fires exactly at the limit
        (301, 345),  # a new timer starts here
        (500, 360),  # fixed orange, timers dropped
        (501, 425),  # red band: fixed orange, red timer starts
        (801, 425),  # fixed orange and red dwell
        (802, 425),  # a new red timer
        (1200, 345),  # down to the orange band: red timer dropped
        (1201, 425),  # up again: fresh red timer
        (1202, 430),  # fixed red
        (1203, 100),  # clean
    ]
    found = alert_rows(fuzzy_alerts(make_readings(spark, rows), LIMITS, max_time=600, delta=10))
    fixed, orange, red = "hard_threshold", "fuzzy_zone_orange_duration", "fuzzy_zone_red_duration"
    assert sorted(micro(found)) == sorted(
        [
            (300, orange),
            (500, fixed),
            (501, fixed),
            (801, fixed),
            (801, red),
            (802, fixed),
            (1201, fixed),
            (1202, fixed),
        ]
    )
    elapsed = {row[5]: row[4] for row in found if row[5] != fixed}
    assert elapsed == {orange: 300.0, red: 300.0}


@pytest.mark.parametrize(("max_time", "delta"), [(86401, 10), (600, 0), (600, 81)])
def test_fuzzy_settings_are_checked(spark, max_time, delta):
    with pytest.raises(ValueError):
        fuzzy_alerts(make_readings(spark, [(0, 1)]), LIMITS, max_time=max_time, delta=delta)


@pytest.mark.parametrize(("name", "gap"), [("ema", None), ("cusum", 3600), ("fuzzy", None)])
def test_stream_goes_on_from_a_table(spark, tmp_path, name, gap):
    """Cut anywhere, also inside a band: history and stream give the alerts of the whole."""
    rows = walk(10, 240)
    later = [(s, p, at(86_400 + i * 60), 1000 + i, x) for i, (s, p, _, _, x) in enumerate(walk(11, 60))]
    rows += later
    whole = alert_rows(DETECTORS[name](spark.createDataFrame(rows, SCHEMA), max_gap=gap))
    for number, cut in enumerate((61, 240) if gap else (150,)):
        folder = tmp_path / str(number)
        history = spark.createDataFrame(rows[:cut], SCHEMA)
        write_parts(spark, folder, chunks(rows[cut:], 2))
        stream = DETECTORS[name](stream_of(spark, folder), max_gap=gap, history=history)
        begun = DETECTORS[name](history, max_gap=gap)
        assert alert_rows(begun.unionByName(drain(spark, stream, folder))) == whole
    assert whole


def test_series_without_history_and_history_without_news(spark, tmp_path):
    history = spark.createDataFrame([("SITE_01", "PM10", at(0), 0, 420.0), ("SITE_02", "PM10", at(0), 1, 420.0)], SCHEMA)
    write_parts(spark, tmp_path, [[("SITE_01", "PM10", at(60), 2, 0.0), ("SITE_03", "PM10", at(60), 3, 360.0)]])
    stream = ema_alerts(stream_of(spark, tmp_path), LIMITS, alpha=0.1, history=history)
    assert [(row[0], row[4]) for row in alert_rows(drain(spark, stream, tmp_path))] == [("SITE_01", 378.0), ("SITE_03", 360.0)]
    state = {row["site_id"]: row["ema"] for row in series_state(spark, f"{tmp_path}/checkpoint").collect()}
    assert {site: round(x, 6) for site, x in state.items()} == {"SITE_01": 378.0, "SITE_02": 420.0, "SITE_03": 360.0}


@pytest.mark.parametrize("blocks", [1, 4, 23])
def test_timers_at_the_end_of_a_table(spark, blocks):
    """Allowed are 300 s at 345 under the orange limit of 350."""
    values = {
        "clean": [(0, 345), (60, 100)], "waits": [(0, 100), (60, 345), (120, 345)],
        "fired": [(0, 345), (300, 345)], "again": [(0, 345), (300, 345), (360, 345)], "red": [(0, 345), (60, 425)],
    }
    tables = [make_readings(spark, rows, site=site) for site, rows in values.items()]
    history = tables[0]
    for table in tables[1:]:
        history = history.unionByName(table)
    found = {
        row["site_id"]: (row["band"], None if row["timer"] == UNSET else row["timer"] // 1_000_000 - int(at(0).timestamp()))
        for row in fuzzy_state(history, LIMITS, 600, 10, blocks=blocks).collect()
    }
    assert found == {"clean": (0, None), "waits": (1, 60), "fired": (1, None), "again": (1, 360), "red": (2, 60)}


def test_state_of_a_query_reads_as_a_table(spark, tmp_path):
    rows = walk(12, 200)
    for number, part in enumerate(chunks(rows, 2)):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
        drain(spark, ema_alerts(stream_of(spark, tmp_path), LIMITS), tmp_path)
        seen = rows[: (number + 1) * 100]
        series = ema_series(spark.createDataFrame(seen, SCHEMA)).collect()
        last = {}
        for row in sorted(series, key=lambda r: r["event_time"]):
            last[row["site_id"]] = round(row["ema"], 9)
        state = series_state(spark, f"{tmp_path}/checkpoint").collect()
        assert {row["site_id"]: round(row["ema"], 9) for row in state} == last


def test_newest_hours_follow_late_and_repeated_hours(spark, tmp_path):
    """Change logs fold to the newest hours at every step, whatever order rows come in."""
    rng = random.Random(13)
    parts, seen, number = [], [], 0
    for start in (0, 12, 5, 40, 20):
        part = []
        for _ in range(30):
            number += 1
            part.append((f"SITE_{rng.randrange(2)}", "PM10", at((start + rng.randrange(9)) * 3600 + rng.randrange(3600)), number, float(rng.randrange(100))))
        parts.append(part)
    deleted = 0
    for step, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/in/{step}")
        seen += part
        query = (
            newest_hours(stream_of(spark, tmp_path), 8)
            .writeStream.outputMode("update")
            .foreachBatch(upsert_files(f"{tmp_path}/log"))
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        expected = hourly_retained(hourly_avg(spark.createDataFrame(seen, SCHEMA)), 8)

        def plain(df):
            return sorted((r["site_id"], r["start_time"], round(r["avg_value"], 6)) for r in df.collect())

        assert plain(retained_hours(spark, f"{tmp_path}/log")) == plain(expected)
        deleted = spark.read.parquet(f"{tmp_path}/log").filter("change = 'delete'").count()
    assert deleted > 8
