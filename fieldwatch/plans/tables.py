"""The given tables seen as readings and as raw messages."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fieldwatch.session import ROCKSDB, shared_folder
from fieldwatch.sources.readings import SourceConf, parse_readings, read_readings_stream

# Fixed value: the unit sent with every reading.
UNIT = "µg/m³"
# Parts that the streams over the given table arrive in.
STREAM_BATCHES = 3
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def as_readings(events: DataFrame) -> DataFrame:
    """Events as readings of five sites and two pollutants."""
    site = F.concat(F.lit("SITE_"), F.lpad((F.col("user_id") % 5 + 1).cast("string"), 2, "0"))
    return events.select(
        site.alias("site_id"),
        F.when(F.col("event_id") % 2 == 0, "PM2.5").otherwise("PM10").alias("pollutant_type"),
        F.col("ts").cast("timestamp").alias("event_time"),
        "event_id",
        F.least(F.col("value") * F.lit(5.0), F.lit(500.0)).alias("concentration"),
        "event_type",
    )


def typed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings with the event type they came from."""
    return as_readings(spark.read.parquet(f"{sf_dir}/events.parquet"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_readings(spark, sf_dir).drop("event_type")


def time_parts(rows: DataFrame, parts: int = STREAM_BATCHES) -> list[DataFrame]:
    """Readings in ranges of time of about as many rows each."""
    at = F.unix_micros("event_time")
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx(at, shares, 1000)).head()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    found = []
    for after, until in zip(bounds[:-1], bounds[1:], strict=True):
        part = rows if after is None else rows.filter(at > after)
        found.append(part if until is None else part.filter(at <= until))
    return found


class Arrivals:
    """Messages that arrive as files, one part after the other."""

    def __init__(self, parts: list[DataFrame]):
        self.parts = parts
        self.spark = parts[0].sparkSession
        self.folder = scratch(self.spark, "arrivals")

    @staticmethod
    def of(*parts: DataFrame) -> "Arrivals":
        """Parts of readings, sent as messages."""
        return Arrivals([wire_messages(part) for part in parts])

    def raw_stream(self) -> DataFrame:
        """The messages that have arrived, read as the jobs do."""
        return read_readings_stream(self.spark, SourceConf("text", path=self.folder))

    def stream(self) -> DataFrame:
        """The readings that have arrived, parsed as the jobs do."""
        valid, _ = parse_readings(self.raw_stream())
        return valid.withColumn("event_id", F.col("sensor_id").cast("long"))

    def work_off(
        self, writer: Callable[[DataFrame], DataStreamWriter], checkpoint: str, raw: bool = False
    ) -> None:
        """Let one part after the other arrive; a new query goes on from the checkpoint each time."""
        for part in self.parts:
            part.select("value").write.mode("append").text(self.folder)
            started = (
                writer(self.raw_stream() if raw else self.stream())
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            started.awaitTermination()


def stream_session(spark: SparkSession) -> SparkSession:
    """A session like the given one, but with state in RocksDB; the given one stays as it is."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def wire_messages(rows: DataFrame, event_type: bool = False) -> DataFrame:
    """Readings as JSON messages in a ``value`` column."""
    message = F.struct(
        F.col("event_id").cast("string").alias("sensor_id"),
        "site_id",
        F.date_format("event_time", TIMESTAMP_FORMAT).alias("timestamp"),
        "pollutant_type",
        "concentration",
        F.lit(UNIT).alias("unit"),
    )
    kept = ["event_type"] if event_type else []
    return rows.select(F.to_json(message).alias("value"), *kept)


def damaged_messages(rows: DataFrame) -> DataFrame:
    """Typed readings as messages, broken in a way that depends on the event type."""
    rows = rows.withColumn("site_id", F.when(F.col("event_type") != "click", F.col("site_id")))
    sent = wire_messages(rows, event_type=True)
    cut = F.expr("left(value, length(value) - 1)")
    garbled = F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"garbage"')
    value = (
        F.when(F.col("event_type") == "error", cut)
        .when(F.col("event_type") == "signup", garbled)
        .otherwise(F.col("value"))
    )
    return sent.select(value.alias("value"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on shared storage for one run of a query."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
