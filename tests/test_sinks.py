import json

import pytest
from pyspark.sql import functions as F

from conftest import SCHEMA, alert_rows, at, make_readings
from fieldwatch.functions.schemas import DAILY_KEY, HOURLY, HOURLY_KEY
from fieldwatch.operators.rollup import daily_rollup, hourly_avg, hourly_retained, latest_readings
from fieldwatch.operators.thresholding import threshold_alerts
from fieldwatch.plans.tables import wire_messages
from fieldwatch.sources.readings import SourceConf
from fieldwatch.sources.thresholds import load_thresholds
from fieldwatch.streaming import jobs, snapshots
from fieldwatch.operators.registry import detect
from fieldwatch.streaming.jobs import JobConf, changed_days, conf_from_env, run, serving_hours, start
from fieldwatch.streaming.retention import retained_hours
from fieldwatch.streaming.sinks import (
    SinkConf,
    clear_statement,
    envelope,
    jdbc_target,
    merge_statement,
    message_writer,
    newest_of,
    read_current,
    read_versions,
    route_alerts,
    upsert_files,
)
from fieldwatch.streaming.snapshots import TableFolder, compact, write_version

LIMITS = load_thresholds()


def hours(spark, *rows):
    return spark.createDataFrame([("S", "PM10", at(h * 3600), float(v)) for h, v in rows], HOURLY)


def table(df):
    return sorted((r["start_time"], r["avg_value"]) for r in df.collect())


def test_upsert_replay_and_compaction(spark, tmp_path):
    path = f"{tmp_path}/hourly"
    write = upsert_files(path)
    write(hours(spark, (0, 1), (1, 2)), 0)
    write(hours(spark, (1, 3), (2, 4)), 1)
    once = table(read_current(spark, HOURLY_KEY, path))
    assert [value for _, value in once] == [1, 3, 4]
    write(hours(spark, (1, 3), (2, 4)), 1)
    assert table(read_current(spark, HOURLY_KEY, path)) == once
    assert read_versions(spark, path).count() == 4
    write(hours(spark, (0, 9)), 10)
    write(hours(spark, (0, 8)), 2)
    newest = table(read_current(spark, HOURLY_KEY, path))
    assert [value for _, value in newest] == [9, 3, 4]
    compact(spark, path, newest_of(HOURLY_KEY))
    assert read_versions(spark, path).count() == 3
    assert table(read_current(spark, HOURLY_KEY, path)) == newest
    # Rows keep their versions: what comes between them still ranks between them.
    write(hours(spark, (0, 7), (2, 7)), 5)
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [9, 3, 7]


def live_files(df):
    return {name.split("/unit=")[1].split("/")[1] for name in df.inputFiles()}


def test_a_day_opens_its_own_live_files_only(spark, tmp_path):
    path = f"{tmp_path}/hourly"
    write = upsert_files(path)
    for version in range(3):
        write(hours(spark, *((h, version) for h in range(0, 96))), version)
    write(hours(spark, (30, 100)), 3)
    day = read_versions(spark, path, ["2024-01-02"])
    assert live_files(day) == {"day=2024-01-02"}
    units = {part.unit for part in TableFolder(spark, path).snapshot().parts if part.day == "2024-01-02"}
    assert len(units) == 4
    compact(spark, path, newest_of(HOURLY_KEY), ["2024-01-02"])
    folded = read_versions(spark, path, ["2024-01-02"])
    assert len({name.split("/unit=")[1].split("/")[0] for name in folded.inputFiles()}) == 1
    assert folded.count() == 24
    values = {r["start_time"].hour: r["avg_value"] for r in read_current(spark, HOURLY_KEY, path, ["2024-01-02"]).collect()}
    assert values == {hour: 100.0 if hour == 6 else 2.0 for hour in range(24)}


def test_crowded_days_are_folded_while_readers_go_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_PARTS", 4)
    path = f"{tmp_path}/hourly"
    write = upsert_files(path)
    write(hours(spark, (0, 0), (1, 0)), 0)
    begun = read_current(spark, HOURLY_KEY, path)
    for version in range(1, 12):
        write(hours(spark, (version % 2, version)), version)
        assert len(TableFolder(spark, path).snapshot().parts) <= 4
    assert table(begun) == [(r, 0.0) for r, _ in table(read_current(spark, HOURLY_KEY, path))]
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [10, 11]
    folder = TableFolder(spark, path)
    before = len(list((tmp_path / "hourly").glob("unit=*")))
    assert len(folder.remove_unused(kept=1)) >= 10 and before > 11
    assert len(list((tmp_path / "hourly").glob("unit=*"))) == len({part.unit for part in folder.snapshot().parts})
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [10, 11]
    assert folder.manifests() == [folder.snapshot().number]


def test_of_two_writers_one_goes_on_from_the_other(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/hourly"
    upsert_files(path)(hours(spark, (0, 1)), 0)
    folder = TableFolder(spark, path)
    stale = folder.snapshot()
    upsert_files(path)(hours(spark, (1, 2)), 0)
    assert not folder.commit(stale, stale.schema, stale.parts)
    assert folder.snapshot().number == 2
    assert not [f for f in (tmp_path / "hourly" / "_manifests").iterdir() if f.name.startswith("_")]
    # A write that is overtaken between its look and its commit.
    real, raced = TableFolder.write_unit, []

    def overtaken(self, rows, name):
        if not raced:
            raced.append(name)
            write_version(hours(spark, (3, 4)), path, "start_time", None, newest_of(HOURLY_KEY))
        return real(self, rows, name)

    monkeypatch.setattr(TableFolder, "write_unit", overtaken)
    write_version(hours(spark, (2, 3)), path, "start_time", 7, newest_of(HOURLY_KEY))
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [1, 2, 3, 4]


def test_a_crashed_write_is_not_seen_and_is_removed_when_old(spark, tmp_path):
    path = f"{tmp_path}/hourly"
    upsert_files(path)(hours(spark, (0, 1)), 0)
    folder = TableFolder(spark, path)
    rows = hours(spark, (0, 99)).withColumns({"day": F.to_date("start_time"), "batch_id": F.lit(1).cast("bigint")})
    folder.write_unit(rows, "v1-crashed")
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [1]
    assert folder.remove_unused() == []
    assert folder.remove_unused(leftover_age=-60) == ["v1-crashed"]
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [1]


def test_named_writers_count_a_batch_once(spark, tmp_path):
    path = f"{tmp_path}/sums"
    for batch, value in ((0, 1), (1, 2), (1, 2), (0, 1), (2, 3)):
        write_version(hours(spark, (batch, value)), path, "start_time", None, newest_of(HOURLY_KEY), ("job", batch))
    write_version(hours(spark, (5, 9)), path, "start_time", None, newest_of(HOURLY_KEY), ("other", 0))
    assert [value for _, value in table(read_versions(spark, path))] == [1, 2, 3, 9]
    assert TableFolder(spark, path).snapshot().batches == {"job": 2, "other": 0}


def test_a_new_checkpoint_does_not_lose_against_older_versions(spark, tmp_path):
    path = f"{tmp_path}/hourly"
    first = upsert_files(path)
    for number, value in enumerate([1, 2]):
        first(hours(spark, (0, value), (30, value)), number)
    again = upsert_files(path)
    again(hours(spark, (0, 3)), 0)
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [3, 2]
    assert upsert_files(path)(hours(spark), 0) is None
    assert [value for _, value in table(read_current(spark, HOURLY_KEY, path))] == [3, 2]


def test_only_touched_days_are_read(spark, tmp_path):
    path = f"{tmp_path}/hourly"
    write = upsert_files(path)
    write(hours(spark, *((h, h) for h in range(0, 24 * 6))), 0)
    write(hours(spark, (24 * 2, 1000), (24 * 4, 1000)), 1)
    found = changed_days(spark, path, after=0)
    assert [str(r["log_date"]) for r in found.sort("log_date").collect()] == ["2024-01-03", "2024-01-05"]
    assert live_files(found) == {"day=2024-01-03", "day=2024-01-05"}


def test_retention_keeps_the_newest(spark):
    df = hours(spark, *((h, h) for h in range(40)))
    kept = table(hourly_retained(df))
    assert [value for _, value in kept] == list(range(15, 40))


def test_daily_is_the_mean_of_hours(spark):
    readings = make_readings(spark, [(0, 0), (1, 0), (2, 0), (3600, 100), (86400, 7)])
    days = {str(r["log_date"]): r["daily_avg"] for r in daily_rollup(hourly_avg(readings)).collect()}
    assert days == {"2024-01-01": 50.0, "2024-01-02": 7.0}


def test_latest_of_one_site(spark):
    df = make_readings(spark, [(i, i) for i in range(120)]).unionByName(
        make_readings(spark, [(500, 1)], site="SITE_02")
    )
    found = latest_readings(df, "SITE_01", keep=50, tie="event_id").collect()
    assert sorted(r["concentration"] for r in found) == [float(i) for i in range(70, 120)]


def test_envelope_and_routes(spark):
    alerts = threshold_alerts(make_readings(spark, [(0.123456, 400), (1, 500), (2, 1)]), LIMITS)
    rows = {r["topic"]: r for r in envelope(route_alerts(alerts)).collect()}
    assert set(rows) == {"alerts_internal", "alerts_severe"}
    assert rows["alerts_internal"]["key"] == "SITE_01"
    assert json.loads(rows["alerts_internal"]["value"]) == {
        "site_id": "SITE_01",
        "pollutant_type": "PM10",
        "event_time": "2024-01-01T00:00:00.123456Z",
        "concentration": 400.0,
        "metric_value": 400.0,
        "metric_name": "hard_threshold",
        "alert_category": "orange",
    }
    named = {"orange": "a", "red": "b"}
    assert {r["topic"] for r in route_alerts(alerts, named).collect()} == {"a", "b"}


def test_statements_and_address():
    merge = merge_statement("t", "t_staging", ["a", "b", "v"], ["a", "b"], 7)
    assert merge == (
        "INSERT INTO t (a, b, v) SELECT a, b, v FROM t_staging WHERE batch_id = 7 "
        "ON CONFLICT (a, b) DO UPDATE SET v = EXCLUDED.v"
    )
    assert clear_statement("t_staging", 7) == "DELETE FROM t_staging WHERE batch_id = 7"
    target = jdbc_target("postgresql+psycopg2://me:p%40ss@host:5432/db")
    assert target.url == "jdbc:postgresql://host:5432/db"
    assert target.properties()["password"] == "p@ss"


def test_settings_from_environment():
    conf = conf_from_env({"ALGORITHM": "EMAThresholding", "SEVERE_ALERTS_TOPIC": "s"})
    assert conf.detector == "EMAThresholding"
    assert conf.source.topic == "site-sensor-raw"
    assert conf.sink.bootstrap_servers == "kafka:29092"
    assert conf.topics == {"orange": "alerts_internal", "red": "s", "forecast": "alerts_forecasts"}


def job(tmp_path, **changes):
    return JobConf(
        **{
            "source": SourceConf("text", path=f"{tmp_path}/in", max_per_trigger=1),
            "sink": SinkConf("parquet", path=f"{tmp_path}/out"),
            "checkpoint": f"{tmp_path}/checkpoint",
            "hourly_path": f"{tmp_path}/hourly",
            "available_now": True,
            **changes,
        }
    )


def send(spark, tmp_path, name, rows, extra=()):
    """One more file of messages."""
    df = spark.createDataFrame(rows, SCHEMA)
    texts = [r["value"] for r in wire_messages(df).collect()] + list(extra)
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.txt").write_text("\n".join(texts) + "\n")


def rows_of(first, count):
    return [("SITE_01", "PM10", at(i * 900), i, 300.0 + i % 200) for i in range(first, first + count)]


def test_one_pass_job_and_serving_hours_go_on_after_a_restart(spark, tmp_path):
    """The same alerts as of separate queries, from one read; late and broken messages beside them."""
    conf = job(tmp_path, detector="EMAThresholding", one_pass=True, dead_letter_topic="dead", serving_path=f"{tmp_path}/serving")
    send(spark, tmp_path, "a", rows_of(0, 150), ["broken"])
    run("all", conf, spark)
    send(spark, tmp_path, "b", [*rows_of(150, 150), ("SITE_01", "PM10", at(0), 999, 500.0)])
    run("all", conf, spark)
    sent = [row.asDict() for row in spark.read.parquet(f"{tmp_path}/out").collect()]
    alerts = [json.loads(row["value"]) for row in sent if row["topic"] != "dead"]
    table_of = spark.createDataFrame(rows_of(0, 300), SCHEMA)
    expected = alert_rows(detect("EMAThresholding", table_of, LIMITS))
    assert sorted(round(row["metric_value"], 6) for row in alerts) == sorted(row[4] for row in expected)
    reasons = sorted(json.loads(row["value"])["reason"] for row in sent if row["topic"] == "dead")
    assert reasons == ["late_reading", "malformed_json"]
    everything = spark.createDataFrame([*rows_of(0, 300), ("SITE_01", "PM10", at(0), 999, 500.0)], SCHEMA)
    assert table(retained_hours(spark, conf.serving_path)) == table(hourly_retained(hourly_avg(everything)))


@pytest.mark.parametrize("detector", ["Thresholding", "EMAThresholding", "FuzzyThresholding"])
def test_job_with_restart(spark, tmp_path, detector):
    """Two runs of the whole job give each alert once and the right hours."""
    conf = job(tmp_path, detector=detector, dead_letter_topic="dead")
    send(spark, tmp_path, "a", rows_of(0, 150), ["broken"])
    run("all", conf, spark)
    send(spark, tmp_path, "b", rows_of(150, 150))
    run("all", conf, spark)
    run("all", conf, spark)

    out = spark.read.parquet(f"{tmp_path}/out")
    topics = {r["topic"]: r["count"] for r in out.groupBy("topic").count().collect()}
    # The tie break of a parsed reading is its sensor_id; here times never tie.
    table_of = spark.createDataFrame(rows_of(0, 300), SCHEMA)
    expected = alert_rows(detect(detector, table_of, LIMITS))
    dead = spark.read.parquet(f"{tmp_path}/out_dead_letters").collect()
    assert [(r["topic"], json.loads(r["value"])["reason"]) for r in dead] == [
        ("dead", "malformed_json")
    ]
    assert topics == {
        topic: sum(1 for r in expected if r[6] == category)
        for topic, category in (("alerts_internal", "orange"), ("alerts_severe", "red"))
        if any(r[6] == category for r in expected)
    }
    current = read_current(spark, HOURLY_KEY, conf.hourly_path)
    assert table(current) == table(hourly_avg(table_of))
    assert serving_hours(spark, conf.hourly_path).count() == 25



def days(df):
    return sorted((str(r["log_date"]), r["daily_avg"]) for r in df.collect())


def test_daily_refresh_takes_up_where_it_ended(spark, tmp_path):
    conf = job(tmp_path, daily_path=f"{tmp_path}/daily")
    write = upsert_files(conf.hourly_path)
    write(hours(spark, (0, 1), (1, 3), (24, 10)), 0)
    run("daily", conf, spark)
    write(hours(spark, (25, 20), (48, 5)), 1)
    write(hours(spark, (1, 5), (25, 30)), 2)
    run("daily", conf, spark)
    run("daily", conf, spark)
    daily = read_current(spark, DAILY_KEY, conf.daily_path)
    assert days(daily) == [("2024-01-01", 3.0), ("2024-01-02", 20.0), ("2024-01-03", 5.0)]
    assert daily.filter(F.col("last_updated_at").isNull()).count() == 0
    assert sorted(r[0] for r in read_versions(spark, conf.daily_path).select("batch_id").distinct().collect()) == [0, 2]


def test_only_days_from_the_first_touched_one_are_computed(spark, tmp_path):
    path = f"{tmp_path}/hourly"
    write = upsert_files(path)
    write(hours(spark, (0, 1), (24, 10)), 0)
    write(hours(spark, (25, 20)), 1)
    assert days(changed_days(spark, path, after=0)) == [("2024-01-02", 15.0)]
    assert len(days(changed_days(spark, path))) == 2
    assert days(changed_days(spark, path, after=1)) == []


def test_daily_from_a_database_alone(spark, tmp_path, monkeypatch):
    """No database here: what is read from and written to it is handed over."""
    rows = hours(spark, (0, 1), (1, 3), (24, 10))
    written = []
    monkeypatch.setattr(jobs, "read_table", lambda s, target, table, time: rows if (table, time) == (jobs.HOURLY_TABLE, "start_time") else None)
    monkeypatch.setattr(
        jobs, "upsert_jdbc", lambda target, table, keys: lambda batch, number: written.append((table, keys, days(batch)))
    )
    conf = job(tmp_path, hourly_path=None, postgres_uri="postgresql://u:p@h:1/db")
    run("daily", conf, spark)
    assert written == [(jobs.DAILY_TABLE, DAILY_KEY, [("2024-01-01", 2.0), ("2024-01-02", 10.0)])]
    both = job(tmp_path, hourly_path=None, daily_path=f"{tmp_path}/daily", postgres_uri=conf.postgres_uri)
    run("daily", both, spark)
    run("daily", both, spark)
    assert days(read_current(spark, DAILY_KEY, both.daily_path)) == written[0][2]
    with pytest.raises(ValueError):
        run("daily", job(tmp_path, hourly_path=None), spark)


def test_metrics_job_counts_unusable_messages(spark, tmp_path):
    send(spark, tmp_path, "a", rows_of(0, 5), ["broken", "{}"])
    query = start(spark, "metrics", job(tmp_path))["metrics"]
    query.awaitTermination()
    seen = [p.observedMetrics["messages"] for p in query.recentProgress if "messages" in p.observedMetrics]
    assert (sum(r["messages"] for r in seen), sum(r["unusable"] for r in seen)) == (7, 2)


def test_unknown_mode_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        run("nothing", job(tmp_path), spark)


def test_metrics_needs_a_table(spark, tmp_path):
    send(spark, tmp_path, "a", rows_of(0, 1))
    with pytest.raises(ValueError):
        run("metrics", job(tmp_path, hourly_path=None), spark)


def test_kafka_sink_needs_its_connector(spark, tmp_path):
    """No connector jar is installed here, so the writer can only be built."""
    send(spark, tmp_path, "a", rows_of(0, 1))
    stream = spark.readStream.text(f"{tmp_path}/in").selectExpr("value AS key", "value", "'t' AS topic")
    writer = message_writer(stream, SinkConf("kafka", bootstrap_servers="b:1"), f"{tmp_path}/c")
    with pytest.raises(Exception, match="(?i)kafka"):
        writer.start()
