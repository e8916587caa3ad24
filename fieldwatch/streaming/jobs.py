"""Running jobs: the metrics rollup, the alerting job, or both on one session."""

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldwatch.functions.schemas import DAILY_KEY, HOURLY_KEY, SERIES
from fieldwatch.operators.forecast import ForecastModel, forecasts, train_forecaster, with_classes
from fieldwatch.operators.registry import FORECASTER, detect
from fieldwatch.operators.rollup import daily_rollup, hourly_avg, hourly_retained, stamp_daily
from fieldwatch.operators.thresholding import breached_limit, open_category
from fieldwatch.session import build_spark, shared_folder
from fieldwatch.sources.readings import (
    SourceConf,
    decode_readings,
    parse_readings,
    read_readings_batch,
    read_readings_stream,
    valid_readings,
)
from fieldwatch.sources.thresholds import SHIPPED, Thresholds, load_thresholds
from fieldwatch.streaming.retention import newest_hours
from fieldwatch.streaming.sinks import (
    TOPICS,
    BatchWriter,
    SinkConf,
    envelope,
    jdbc_target,
    latest_rows,
    message_value,
    message_writer,
    newest_version,
    read_current,
    read_table,
    route_alerts,
    topic_of,
    upsert_files,
    upsert_jdbc,
)
from fieldwatch.streaming.snapshots import TableFolder, read_parts
from fieldwatch.streaming.steps import OnePass

MODES = ("anomaly", "metrics", "all")
BATCH_MODES = ("daily", "train")
# Names of the rollup tables.
HOURLY_TABLE = "sensor_averages_hourly"
DAILY_TABLE = "sensor_averages_daily"
# Unusable messages go here unless the settings name another topic.
DEAD_LETTERS = "site-sensor-dead-letters"
# How often a running job looks for ended queries and newer models.
WAIT_SECONDS = 10


@dataclass(frozen=True)
class JobConf:
    """Everything a job needs to know.

    ``checkpoint`` and the table paths must lie on storage all executors share;
    without ``checkpoint`` the session's ``spark.checkpoint.dir`` is used.
    ``serving_path`` takes the change log of the newest hours. ``one_pass`` reads and
    parses messages once for alerts, unusable and late ones, with detectors that cut
    micro-batches into blocks. ``available_now`` works off what is there and stops.
    """

    source: SourceConf
    sink: SinkConf
    checkpoint: str | None = None
    hourly_path: str | None = None
    daily_path: str | None = None
    postgres_uri: str | None = None
    detector: str = "Thresholding"
    detector_params: dict = field(default_factory=dict)
    topics: Mapping[str, str] = field(default_factory=lambda: dict(TOPICS))
    dead_letter_topic: str | None = None
    thresholds_path: str = str(SHIPPED)
    model_path: str | None = None
    serving_path: str | None = None
    one_pass: bool = False
    available_now: bool = False


def conf_from_env(env: Mapping[str, str] = os.environ) -> JobConf:
    """Job settings from environment variables."""
    # Names of the variables, and their defaults but for DEAD_LETTER_TOPIC.
    servers = env.get("KAFKA_BOOTSTRAP_SERVERS", "kafka:29092")
    limit = env.get("MAX_OFFSETS_PER_TRIGGER")
    return JobConf(
        source=SourceConf(
            "kafka",
            bootstrap_servers=servers,
            topic=env.get("SENSOR_TOPIC", "site-sensor-raw"),
            max_per_trigger=int(limit) if limit else None,
        ),
        sink=SinkConf("kafka", bootstrap_servers=servers),
        checkpoint=env.get("CHECKPOINT_LOCATION"),
        hourly_path=env.get("HOURLY_PATH"),
        daily_path=env.get("DAILY_PATH"),
        postgres_uri=env.get("POSTGRES_URI"),
        detector=env.get("ALGORITHM", "Thresholding"),
        topics={
            "orange": env.get("INTERNAL_ALERTS_TOPIC", TOPICS["orange"]),
            "red": env.get("SEVERE_ALERTS_TOPIC", TOPICS["red"]),
            "forecast": env.get("FORECASTS_ALERTS_TOPIC", TOPICS["forecast"]),
        },
        dead_letter_topic=env.get("DEAD_LETTER_TOPIC", DEAD_LETTERS),
        thresholds_path=env.get("THRESHOLDS_PATH", str(SHIPPED)),
        model_path=env.get("MODEL_PATH"),
        serving_path=env.get("SERVING_PATH"),
        one_pass=env.get("ONE_PASS", "") == "1",
    )


def query_folder(spark: SparkSession, conf: JobConf, name: str) -> str:
    """Checkpoint folder of one query; the same one after a restart."""
    return f"{conf.checkpoint or shared_folder(spark)}/{name}"


def _start(writer, conf: JobConf) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if conf.available_now else writer).start()


def table_writer(
    path: str | None, conf: JobConf, table: str, keys: list[str], versioned: bool = False
) -> BatchWriter:
    """Upserts into the files below ``path``, the database, or both; the last key is a time."""
    writers = [upsert_files(path, keys, versioned)] if path else []
    if conf.postgres_uri:
        writers.append(upsert_jdbc(jdbc_target(conf.postgres_uri), table, keys))
    if not writers:
        raise ValueError(f"{table} needs a path or POSTGRES_URI")

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(writers) == 1:
            return writers[0](batch, batch_id)
        kept = batch.persist()
        for writer in writers:
            writer(kept, batch_id)
        kept.unpersist()

    return write


def start_metrics(spark: SparkSession, conf: JobConf) -> StreamingQuery:
    """Hourly means of the stream, upserted into the hourly table.

    The progress of the query counts all messages, and the unusable ones, of each
    micro-batch as the observed metric ``messages``.
    """
    decoded = decode_readings(read_readings_stream(spark, conf.source)).observe(
        "messages",
        F.count("*").alias("messages"),
        F.count_if(F.col("reason").isNotNull()).alias("unusable"),
    )
    writer = (
        hourly_avg(valid_readings(decoded))
        .writeStream.outputMode("update")
        .foreachBatch(table_writer(conf.hourly_path, conf, HOURLY_TABLE, HOURLY_KEY))
        .option("checkpointLocation", query_folder(spark, conf, "metrics"))
    )
    return _start(writer, conf)


def start_serving(spark: SparkSession, conf: JobConf) -> StreamingQuery:
    """Changes to the newest hours of each series, kept as files; ``retained_hours`` reads them."""
    valid, _ = parse_readings(read_readings_stream(spark, conf.source))
    writer = (
        newest_hours(valid)
        .writeStream.outputMode("update")
        .foreachBatch(upsert_files(conf.serving_path))
        .option("checkpointLocation", query_folder(spark, conf, "serving"))
    )
    return _start(writer, conf)


def changed_days(spark: SparkSession, hourly_path: str, after: int | None = None) -> DataFrame:
    """Daily means of the days touched after a version.

    All hours of these days count, whichever batch wrote them; the manifest names the
    days and their files, and no other file is opened. Without ``after`` every day is
    computed.
    """
    snapshot = TableFolder(spark, hourly_path).snapshot()
    versions = read_parts(spark, hourly_path, snapshot, snapshot.days_after(after))
    return daily_rollup(latest_rows(versions, HOURLY_KEY))


def refresh_daily(spark: SparkSession, conf: JobConf) -> int | None:
    """Bring the daily table up to the newest hourly batch; returns its id, None if there is none.

    The daily table's own versions are those of the hourly batches it has
    seen, so a run takes up where the last one ended. Without hourly files the hourly
    table of the database counts, all days that it holds.
    """
    if not conf.hourly_path:
        return daily_from_database(spark, conf)
    newest = newest_version(spark, conf.hourly_path)
    if newest is None:
        return None
    seen = newest_version(spark, conf.daily_path) if conf.daily_path else None
    if seen is None or newest > seen:
        write = table_writer(conf.daily_path, conf, DAILY_TABLE, DAILY_KEY, versioned=True)
        write(stamp_daily(changed_days(spark, conf.hourly_path, seen)), newest)
    return newest


def daily_from_database(spark: SparkSession, conf: JobConf) -> int:
    """Every day of the database's hourly table, written as the next version."""
    if not conf.postgres_uri:
        raise ValueError("the daily table needs hourly means: set HOURLY_PATH or POSTGRES_URI")
    seen = newest_version(spark, conf.daily_path) if conf.daily_path else None
    version = 0 if seen is None else seen + 1
    hourly = read_table(spark, jdbc_target(conf.postgres_uri), HOURLY_TABLE, HOURLY_KEY[-1])
    write = table_writer(conf.daily_path, conf, DAILY_TABLE, DAILY_KEY, versioned=True)
    write(stamp_daily(daily_rollup(hourly)), version)
    return version


def serving_hours(spark: SparkSession, hourly_path: str, keep: int = 25) -> DataFrame:
    """The newest hours of each series, as a bounded view of the hourly table."""
    return hourly_retained(read_current(spark, HOURLY_KEY, hourly_path), keep)


def forecast_messages(
    readings: DataFrame, thresholds: Thresholds, model: ForecastModel, topics: Mapping[str, str]
) -> DataFrame:
    """Alerts and forecasts of each reading as messages, in one pass.

    Every reading gives three forecast messages, and one alert message where it
    breaches a limit.
    """
    value = F.col("concentration")
    limited = thresholds.join(readings, ["orange_min", "red_min"], "left")
    rows = limited.withColumns({"alert_category": open_category(value), "limit": breached_limit(value)})
    scored = with_classes(rows, model)
    alert = F.struct(
        topic_of(F.col("alert_category"), topics).alias("topic"),
        message_value(
            [
                *SERIES,
                "event_time",
                "concentration",
                F.col("limit").alias("metric_value"),
                F.lit("hard_threshold").alias("metric_name"),
                "alert_category",
            ]
        ).alias("value"),
    )
    forecast = [
        F.struct(F.lit(topics["forecast"]).alias("topic"), message_value(columns).alias("value"))
        for columns in forecasts()
    ]
    messages = F.array(alert, *forecast)
    return (
        scored.select(F.col("site_id").alias("key"), F.inline(messages))
        .filter(F.col("topic").isNotNull())
        .select("key", "value", "topic")
    )


def load_or_train(spark: SparkSession, conf: JobConf, thresholds: Thresholds) -> ForecastModel:
    """The saved model, or one trained on the source's history and then saved."""
    if conf.model_path and ForecastModel.newest(spark, conf.model_path):
        return ForecastModel.load(spark, conf.model_path)
    return train(spark, conf, thresholds)


def train(spark: SparkSession, conf: JobConf, thresholds: Thresholds) -> ForecastModel:
    """A model of the source's history, saved where the settings say."""
    history, _ = parse_readings(read_readings_batch(spark, conf.source))
    model = train_forecaster(history, thresholds)
    if conf.model_path and model.trained:
        model.save(conf.model_path)
    return model


def model_for(spark: SparkSession, conf: JobConf) -> ForecastModel | None:
    """The model of the configured detector, None for one without."""
    if conf.detector != FORECASTER:
        return None
    return load_or_train(spark, conf, load_thresholds(conf.thresholds_path))


def start_alerts(spark: SparkSession, conf: JobConf, model: ForecastModel | None) -> StreamingQuery:
    """One query that writes all alerts, and forecasts, to their topics."""
    valid, _ = parse_readings(read_readings_stream(spark, conf.source))
    thresholds = load_thresholds(conf.thresholds_path)
    if model:
        messages = forecast_messages(valid, thresholds, model, conf.topics)
    else:
        alerts = detect(conf.detector, valid, thresholds, **conf.detector_params)
        messages = envelope(route_alerts(alerts, conf.topics))
    return _start(message_writer(messages, conf.sink, query_folder(spark, conf, "anomaly")), conf)


def start_dead_letters(spark: SparkSession, conf: JobConf) -> StreamingQuery:
    """One query that writes unusable messages to their topic."""
    _, dead = parse_readings(read_readings_stream(spark, conf.source))
    letters = dead.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct("value", "reason")).alias("value"),
        F.lit(conf.dead_letter_topic).alias("topic"),
    )
    # A file sink logs its batches in its folder, so each query has its own.
    sink = replace(conf.sink, path=conf.sink.path and f"{conf.sink.path}_dead_letters")
    return _start(message_writer(letters, sink, query_folder(spark, conf, "dead_letters")), conf)


def start_one_pass(spark: SparkSession, conf: JobConf) -> StreamingQuery:
    """One query, one read and one parse for alerts, unusable messages and late readings."""
    folder = query_folder(spark, conf, "one_pass")
    write = OnePass(
        conf.detector,
        load_thresholds(conf.thresholds_path),
        conf.sink,
        f"{folder}-states",
        conf.dead_letter_topic or DEAD_LETTERS,
        conf.topics,
        conf.detector_params,
    )
    raw = read_readings_stream(spark, conf.source).select("value")
    return _start(raw.writeStream.foreachBatch(write).option("checkpointLocation", folder), conf)


def start(
    spark: SparkSession, mode: str, conf: JobConf, model: ForecastModel | None = None
) -> dict[str, StreamingQuery]:
    """Start the queries of a mode on one session; unusable messages go out where a topic is named."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; known: {', '.join(MODES)}")
    queries = {}
    if mode in ("metrics", "all"):
        queries["metrics"] = start_metrics(spark, conf)
        if conf.serving_path:
            queries["serving"] = start_serving(spark, conf)
    if mode in ("anomaly", "all") and conf.one_pass and conf.detector != FORECASTER:
        queries["anomaly"] = start_one_pass(spark, conf)
    elif mode in ("anomaly", "all"):
        queries["anomaly"] = start_alerts(spark, conf, model or model_for(spark, conf))
        if conf.dead_letter_topic:
            queries["dead_letters"] = start_dead_letters(spark, conf)
    return queries


def watch(
    spark: SparkSession, conf: JobConf, queries: dict[str, StreamingQuery], model: ForecastModel | None
) -> None:
    """Wait until a query ends, and raise what ended it.

    When a newer model is saved meanwhile, the forecasting query goes on with it
    from its checkpoint.
    """
    while all(query.isActive for query in queries.values()):
        next(iter(queries.values())).awaitTermination(WAIT_SECONDS)
        newest = ForecastModel.newest(spark, conf.model_path) if model and conf.model_path else None
        if newest and newest != model.version and queries["anomaly"].isActive:
            model = ForecastModel.load(spark, conf.model_path)
            queries["anomaly"].stop()
            queries["anomaly"] = start_alerts(spark, conf, model)
    for query in queries.values():
        if not query.isActive:
            query.awaitTermination()


def run(mode: str = "all", conf: JobConf | None = None, spark: SparkSession | None = None) -> None:
    """Run a mode until a query ends, then stop the others.

    With ``available_now`` every query runs to its own end. The batch modes
    refresh the daily table or train the forecaster, and end.
    """
    conf = conf or conf_from_env()
    spark = spark or build_spark(f"fieldwatch-{mode}")
    if mode == "daily":
        refresh_daily(spark, conf)
        return
    if mode == "train":
        train(spark, conf, load_thresholds(conf.thresholds_path))
        return
    model = model_for(spark, conf) if mode in ("anomaly", "all") else None
    queries = start(spark, mode, conf, model)
    try:
        if conf.available_now:
            for query in queries.values():
                query.awaitTermination()
        else:
            watch(spark, conf, queries, model)
    finally:
        for query in queries.values():
            if query.isActive:
                query.stop()
