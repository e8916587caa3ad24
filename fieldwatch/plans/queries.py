"""Runnable queries: one for each operator, over the whole given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import DAILY_KEY, HOURLY_KEY, SERIES
from fieldwatch.operators.cusum import cusum_alerts, cusum_series
from fieldwatch.operators.dwell import fuzzy_alerts
from fieldwatch.operators.ema import ema_alerts, ema_series
from fieldwatch.operators.forecast import (
    class_counts,
    fit_forecaster,
    forecast_alerts,
    forecast_score,
    majority_model,
)
from fieldwatch.operators.history import (
    TARGETS,
    forecast_features,
    forecast_training_set,
    label_balance,
    training_coverage,
    training_window,
)
from fieldwatch.operators.rollup import (
    daily_rollup,
    daily_weighted,
    hourly_avg,
    hourly_retained,
    latest_readings,
)
from fieldwatch.operators.thresholding import (
    classify_readings,
    internal_alerts,
    severe_alerts,
    threshold_alerts,
)
from fieldwatch.plans.tables import (
    Arrivals,
    damaged_messages,
    readings,
    scratch,
    stream_session,
    time_parts,
    typed_readings,
    wire_messages,
)
from fieldwatch.sources.readings import SourceConf, parse_readings, read_readings_batch
from fieldwatch.sources.thresholds import load_thresholds
from fieldwatch.streaming.detectors import series_state
from fieldwatch.streaming.jobs import JobConf, refresh_daily
from fieldwatch.streaming.retention import newest_hours, retained_hours
from fieldwatch.streaming.sinks import (
    SinkConf,
    envelope,
    message_writer,
    read_current,
    route_alerts,
    upsert_files,
)
from fieldwatch.streaming.steps import OnePass, step_alerts
from fieldwatch.streaming.sums import add_sums, read_means
from fieldwatch.streaming.training import TrainingHistory

# Columns of a parsed reading.
READING = ["sensor_id", "site_id", "pollutant_type", "event_time", "concentration", "unit"]


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Means and averages at some places, where sum order no longer shows."""
    return df.withColumns({name: F.round(name, places) for name in columns})


def _daily_means(days: DataFrame) -> DataFrame:
    """Means of a few dozen readings with two decimals, which end before the ninth place."""
    return _rounded(days, "daily_avg", places=9).withColumn("log_date", F.col("log_date").cast("string"))


# -- sources and parsing ------------------------------------------------------


def scan_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "messages")
    wire_messages(readings(spark, sf_dir)).write.text(path)
    raw = read_readings_batch(spark, SourceConf("text", path=path))
    return parse_readings(raw)[0].select(*READING)


def parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_readings(damaged_messages(typed_readings(spark, sf_dir)))[0].select(*READING)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = parse_readings(damaged_messages(typed_readings(spark, sf_dir)))[1]
    return dead.groupBy("reason").agg(F.count("*").alias("messages"))


def thresholds_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = readings(spark, sf_dir).groupBy("pollutant_type").agg(F.count("*").alias("readings"))
    limits = ["green_min", "green_max", "yellow_min", "yellow_max"]
    limits += ["orange_min", "orange_max", "red_min", "red_max"]
    return load_thresholds().join(counts, limits, "left")


# -- fixed limits -------------------------------------------------------------


def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_readings(readings(spark, sf_dir), load_thresholds())


def alerts_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return internal_alerts(readings(spark, sf_dir), load_thresholds())


def alerts_severe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severe_alerts(readings(spark, sf_dir), load_thresholds())


def alerts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_alerts(readings(spark, sf_dir), load_thresholds())


def alerts_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_alerts(alerts_all(spark, sf_dir))


def alert_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(alerts_routed(spark, sf_dir))


# -- rollups ------------------------------------------------------------------


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hourly_avg(readings(spark, sf_dir)), "avg_value")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily_rollup(hourly_avg(readings(spark, sf_dir)))
    return _rounded(days, "daily_avg").withColumn("log_date", F.col("log_date").cast("string"))


def daily_by_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_means(daily_weighted(readings(spark, sf_dir)))


def retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hourly_retained(hourly_avg(readings(spark, sf_dir))), "avg_value")


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_readings(readings(spark, sf_dir), "SITE_01", tie="event_id")


def _hours_by_arrival(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hourly means without purchases, which come late, and those that they change."""
    rows = typed_readings(spark, sf_dir)
    early = rows.filter(F.col("event_type") != "purchase")
    hour = F.date_trunc("hour", "event_time")
    keys = ["site_id", "pollutant_type", "hour"]
    touched = (
        rows.withColumn("hour", hour)
        .filter(F.col("event_type") == "purchase")
        .select(*keys)
        .distinct()
    )
    late = rows.withColumn("hour", hour).join(touched, keys, "left_semi")
    return hourly_avg(early), hourly_avg(late)


def hourly_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch, sent twice, updates the hours that late readings fall in."""
    early, late = _hours_by_arrival(spark, sf_dir)
    path = scratch(spark, "hourly")
    write = upsert_files(path)
    write(early, 0)
    write(late, 1)
    write(late, 1)
    return _rounded(read_current(spark, HOURLY_KEY, path), "avg_value")


def daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job runs before and after late readings; their stream has a new checkpoint."""
    folder = scratch(spark, "daily")
    conf = JobConf(
        SourceConf("text"), SinkConf("parquet"), hourly_path=f"{folder}/hourly", daily_path=f"{folder}/daily"
    )
    for hours in _hours_by_arrival(spark, sf_dir):
        upsert_files(conf.hourly_path)(hours, 0)
        refresh_daily(spark, conf)
    days = _rounded(read_current(spark, DAILY_KEY, conf.daily_path), "daily_avg")
    return days.select(*SERIES, F.col("log_date").cast("string").alias("log_date"), "daily_avg")


# -- detectors with memory ----------------------------------------------------


def ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ema_series(readings(spark, sf_dir)), "ema")


def ema_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ema_alerts(readings(spark, sf_dir), load_thresholds()), "metric_value")


def fuzzy_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_alerts(readings(spark, sf_dir), load_thresholds())


def fuzzy_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_alerts(readings(spark, sf_dir), load_thresholds(), max_time=3600, delta=60)


def cusum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cusum_series(readings(spark, sf_dir), load_thresholds())


def cusum_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cusum_alerts(readings(spark, sf_dir), load_thresholds())


# -- forecasting --------------------------------------------------------------


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(training_coverage(readings(spark, sf_dir)), "span_days")


def window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_window(readings(spark, sf_dir))


def model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_features(readings(spark, sf_dir))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_training_set(readings(spark, sf_dir), load_thresholds())


def _comparable(training: DataFrame) -> DataFrame:
    """Targets as doubles: a missing one is then the same in every engine."""
    return training.withColumns({name: F.col(name).cast("double") for name in TARGETS.values()})


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(training_set(spark, sf_dir))


def training_rows_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets 15 minutes, 1 hour and 3 hours ahead, whatever the distance of readings."""
    return _comparable(forecast_training_set(readings(spark, sf_dir), load_thresholds(), mode="time"))


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_balance(training_set(spark, sf_dir))


def _limit_edges() -> list[float]:
    limits = load_thresholds().limits["PM10"]
    return [limits["orange_min"] / 1000.0, limits["red_min"] / 1000.0]


def forecast_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the trees are fitted on, with the limits of one pollutant as bin edges."""
    counts = class_counts(training_set(spark, sf_dir), _limit_edges())
    return counts.withColumns({name: F.col(name).cast("long") for name in counts.columns[3:]})


def cells_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cells from counts that were added up as readings came."""
    history = TrainingHistory(spark, scratch(spark, "history"), load_thresholds())
    for batch, part in enumerate(time_parts(readings(spark, sf_dir))):
        history.add(part, batch)
    counts = history.cells(_limit_edges())
    return counts.withColumns({name: F.col(name).cast("long") for name in counts.columns[3:]})


def model_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_forecaster(training_set(spark, sf_dir)).table


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_forecaster(training_set(spark, sf_dir))
    return forecast_score(readings(spark, sf_dir), model)


def majority_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of every reading by the most frequent class of its cell."""
    model = majority_model(training_set(spark, sf_dir), _limit_edges())
    return forecast_score(readings(spark, sf_dir), model)


def alerts_beside_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_alerts(readings(spark, sf_dir), load_thresholds())


# -- the same operators on a stream -------------------------------------------
#
# Messages arrive in ranges of time and go through the source and the parser. A new
# query goes on from the checkpoint for each range, so all of these queries restart.


def _alerts_from_stream(spark: SparkSession, rows: DataFrame, detector) -> DataFrame:
    """All alerts of a detector over rows that arrive; the detector is started anew for each part."""
    folder = scratch(spark, "alerts")

    def writer(stream: DataFrame):
        return detector(stream).writeStream.format("parquet").option("path", f"{folder}/rows")

    Arrivals.of(*time_parts(rows)).work_off(writer, f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows")


def _hours_from_stream(spark: SparkSession, arrivals: Arrivals, hours) -> str:
    """Hours that a stream upserts, as files below the returned folder."""
    folder = scratch(spark, "hourly")

    def writer(stream: DataFrame):
        return hours(stream).writeStream.outputMode("update").foreachBatch(upsert_files(f"{folder}/rows"))

    arrivals.work_off(writer, f"{folder}/checkpoint")
    return f"{folder}/rows"


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = Arrivals.of(*time_parts(readings(stream_session(spark), sf_dir)))
    path = _hours_from_stream(spark, arrivals, hourly_avg)
    return _rounded(read_current(spark, HOURLY_KEY, path), "avg_value")


def stream_hourly_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases arrive after all else; where their hour is behind the watermark they are dropped."""
    rows = typed_readings(stream_session(spark), sf_dir)
    in_time = time_parts(rows.filter(F.col("event_type") != "purchase"), 2)
    late = rows.filter(F.col("event_type") == "purchase")
    path = _hours_from_stream(spark, Arrivals.of(*in_time, late), hourly_avg)
    return _rounded(read_current(spark, HOURLY_KEY, path), "avg_value")


def stream_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest hours of each series from the stream's change log."""
    arrivals = Arrivals.of(*time_parts(readings(stream_session(spark), sf_dir)))
    path = _hours_from_stream(spark, arrivals, newest_hours)
    return _rounded(retained_hours(spark, path), "avg_value")


def stream_daily_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means of all readings, kept up to date by the hours of each micro-batch alone."""
    rows = typed_readings(spark, sf_dir)
    late = F.col("event_type") == "purchase"
    folder = scratch(spark, "sums")
    write = add_sums(f"{folder}/hourly", f"{folder}/daily", "job")
    Arrivals.of(*time_parts(rows.filter(~late), 2), rows.filter(late)).work_off(
        lambda stream: stream.writeStream.foreachBatch(write), f"{folder}/checkpoint"
    )
    return _daily_means(read_means(spark, f"{folder}/daily", DAILY_KEY, "daily_avg"))


def stream_ema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(stream_session(spark), sf_dir)
    alerts = _alerts_from_stream(spark, rows, lambda stream: ema_alerts(stream, load_thresholds()))
    return _rounded(alerts, "metric_value")


def stream_cusum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(stream_session(spark), sf_dir)
    return _alerts_from_stream(spark, rows, lambda stream: cusum_alerts(stream, load_thresholds()))


def _fuzzy(rows: DataFrame, **more) -> DataFrame:
    return fuzzy_alerts(rows, load_thresholds(), max_time=3600, delta=60, **more)


def stream_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts_from_stream(spark, readings(stream_session(spark), sf_dir), _fuzzy)


def _from_history_on(spark: SparkSession, sf_dir: str, detector) -> DataFrame:
    """The first half of the time as a table, the rest as a stream that goes on from it."""
    rows = readings(stream_session(spark), sf_dir)
    history, *rest = time_parts(rows, 2)
    if not rest:
        return detector(rows)
    alerts = _alerts_from_stream(spark, rest[0], lambda stream: detector(stream, history=history))
    return detector(history).unionByName(alerts)


def ema_from_history_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = _from_history_on(
        spark, sf_dir, lambda rows, **more: ema_alerts(rows, load_thresholds(), **more)
    )
    return _rounded(alerts, "metric_value")


def fuzzy_from_history_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_history_on(spark, sf_dir, _fuzzy)


def _alerts_in_blocks(spark: SparkSession, sf_dir: str, detector: str, **settings) -> DataFrame:
    """A detector over micro-batches that are cut into blocks."""
    folder = scratch(spark, "blocks")
    kept = step_alerts(f"{folder}/out", detector, load_thresholds(), f"{folder}/states", **settings)
    Arrivals.of(*time_parts(readings(spark, sf_dir))).work_off(
        lambda stream: stream.writeStream.foreachBatch(kept), f"{folder}/checkpoint"
    )
    return spark.read.parquet(f"{folder}/out/alerts").drop("batch")


def ema_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_alerts_in_blocks(spark, sf_dir, "EMAThresholding"), "metric_value")


def cusum_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts_in_blocks(spark, sf_dir, "CUSUMThresholding")


def fuzzy_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts_in_blocks(spark, sf_dir, "FuzzyThresholding", max_time=3600, delta=60)


def one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by topic and reason: alerts, unusable ones, and purchases that come too late."""
    rows = typed_readings(spark, sf_dir)
    late = F.col("event_type") == "purchase"
    folder = scratch(spark, "one-pass")
    sink = SinkConf("parquet", path=f"{folder}/rows")
    job = OnePass("EMAThresholding", load_thresholds(), sink, f"{folder}/states", "dead_letters")
    Arrivals([damaged_messages(rows.filter(~late)), damaged_messages(rows.filter(late))]).work_off(
        lambda stream: stream.writeStream.foreachBatch(job), f"{folder}/checkpoint", raw=True
    )
    sent = spark.read.parquet(f"{folder}/rows")
    return sent.groupBy("topic", F.get_json_object("value", "$.reason").alias("reason")).agg(
        F.count("*").alias("messages")
    )


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the running averages hold in state after the last restart."""
    folder = scratch(spark, "state")

    def writer(stream: DataFrame):
        return ema_alerts(stream, load_thresholds()).writeStream.format("noop")

    rows = readings(stream_session(spark), sf_dir)
    Arrivals.of(*time_parts(rows)).work_off(writer, f"{folder}/checkpoint")
    state = series_state(stream_session(spark), f"{folder}/checkpoint")
    return _rounded(state.withColumn("last_at", F.timestamp_micros("last_at")), "ema")


def stream_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "routed")
    sink = SinkConf("parquet", path=f"{folder}/rows")

    def writer(stream: DataFrame):
        messages = envelope(route_alerts(threshold_alerts(stream, load_thresholds())))
        return message_writer(messages, sink, f"{folder}/checkpoint")

    rows = readings(stream_session(spark), sf_dir)
    Arrivals.of(*time_parts(rows)).work_off(writer, f"{folder}/checkpoint")
    written = spark.read.schema("key string, value string, topic string")
    return written.parquet(f"{folder}/rows").select("key", "value", "topic")


QUERIES = {
    "scan_readings": scan_readings,
    "parse_readings": parse,
    "dead_letters": dead_letters,
    "thresholds_dim": thresholds_dim,
    "classify_readings": classify,
    "threshold_alerts_internal": alerts_internal,
    "threshold_alerts_severe": alerts_severe,
    "threshold_alerts": alerts_all,
    "alerts_routed": alerts_routed,
    "alert_envelope": alert_envelope,
    "hourly_avg": hourly,
    "daily_rollup": daily,
    "daily_weighted": daily_by_readings,
    "hourly_retained": retained,
    "hourly_upsert": hourly_upsert,
    "daily_upsert": daily_upsert,
    "latest_readings": latest,
    "ema_series": ema,
    "ema_alerts": ema_alert,
    "fuzzy_alerts": fuzzy_wide,
    "fuzzy_alerts_shipped_settings": fuzzy_shipped,
    "cusum_series": cusum,
    "cusum_alerts": cusum_alert,
    "training_coverage": coverage,
    "training_window": window,
    "forecast_features": model_features,
    "forecast_training_set": training_rows,
    "forecast_training_set_by_time": training_rows_by_time,
    "label_balance": balance,
    "forecast_cells": forecast_cells,
    "forecast_cells_maintained": cells_kept_up,
    "forecast_model_fit": model_fit,
    "forecast_score": score,
    "forecast_majority": majority_score,
    "forecast_alerts": alerts_beside_forecasts,
    "stream_hourly_avg": stream_hourly,
    "stream_hourly_late": stream_hourly_late,
    "stream_hourly_retained": stream_retained,
    "stream_daily_weighted": stream_daily_weighted,
    "stream_ema_alerts": stream_ema,
    "stream_ema_state": stream_state,
    "stream_cusum_alerts": stream_cusum,
    "stream_fuzzy_alerts": stream_fuzzy,
    "stream_ema_in_blocks": ema_in_blocks,
    "stream_cusum_in_blocks": cusum_in_blocks,
    "stream_fuzzy_in_blocks": fuzzy_in_blocks,
    "stream_one_pass": one_pass,
    "stream_ema_from_history": ema_from_history_on,
    "stream_fuzzy_from_history": fuzzy_from_history_on,
    "stream_alerts_routed": stream_routed,
}
