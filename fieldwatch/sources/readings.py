"""Scans of raw readings, and the parse step from message to typed row."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldwatch.functions.columns import is_measured
from fieldwatch.functions.schemas import READING_WIRE

CORRUPT = "_corrupt"
# A micro-batch is always bounded, also the first one over a long history.
OFFSETS_PER_TRIGGER = 5_000_000
BYTES_PER_TRIGGER = str(1 << 30)
READING_COLUMNS = [*READING_WIRE.fieldNames(), "event_time"]


@dataclass(frozen=True)
class SourceConf:
    """Where readings come from.

    ``format`` is ``kafka``, or ``text`` (one JSON message per line), or
    ``parquet`` (a table with a ``value`` column). ``max_per_trigger`` bounds a
    micro-batch: offsets for Kafka, files for the others. Without it a default
    number of offsets or bytes applies.
    """

    format: str
    path: str | None = None
    bootstrap_servers: str | None = None
    topic: str | None = None
    max_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self, streaming: bool) -> dict[str, str]:
        chosen: dict[str, str] = {}
        if self.format == "kafka":
            chosen = {
                "kafka.bootstrap.servers": str(self.bootstrap_servers),
                "subscribe": str(self.topic),
                "startingOffsets": "earliest",
            }
        if streaming and self.format == "kafka":
            chosen["maxOffsetsPerTrigger"] = str(self.max_per_trigger or OFFSETS_PER_TRIGGER)
        elif streaming and self.max_per_trigger:
            chosen["maxFilesPerTrigger"] = str(self.max_per_trigger)
        elif streaming:
            chosen["maxBytesPerTrigger"] = BYTES_PER_TRIGGER
        return {**chosen, **self.options}


def _load(reader, conf: SourceConf, streaming: bool) -> DataFrame:
    reader = reader.format(conf.format).options(**conf.reader_options(streaming))
    if conf.format == "kafka":
        return reader.load()
    if conf.format == "parquet":
        reader = reader.schema("value string")
    return reader.load(conf.path)


def read_readings_stream(spark: SparkSession, conf: SourceConf) -> DataFrame:
    """Raw messages as a stream, from the earliest one kept."""
    return _load(spark.readStream, conf, streaming=True)


def read_readings_batch(spark: SparkSession, conf: SourceConf) -> DataFrame:
    """The same messages as a bounded table."""
    return _load(spark.read, conf, streaming=False)


def decode_readings(raw: DataFrame) -> DataFrame:
    """One typed row per message; ``reason`` says why a row is unusable."""
    schema = StructType([*READING_WIRE.fields, StructField(CORRUPT, StringType())])
    message = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    # As a generator the JSON is parsed once; as a plain column the optimizer
    # would repeat the parse in every condition on its fields.
    typed = (
        raw.select(F.col("value").cast("string").alias("value"))
        .select("value", F.inline(F.array(message)))
        .withColumn("event_time", F.col("timestamp").try_cast("timestamp"))
    )
    reason = (
        F.when(F.col("value").isNull() | F.col(CORRUPT).isNotNull(), "malformed_json")
        .when(F.col("site_id").isNull(), "missing_site_id")
        .when(F.col("pollutant_type").isNull(), "missing_pollutant_type")
        .when(F.col("timestamp").isNull(), "missing_timestamp")
        .when(F.col("event_time").isNull(), "bad_timestamp")
        .when(~is_measured(F.col("concentration")), "missing_concentration")
    )
    return typed.withColumn("reason", reason).drop(CORRUPT)


def valid_readings(decoded: DataFrame) -> DataFrame:
    """The usable rows of decoded messages."""
    return decoded.filter(F.col("reason").isNull()).select(*READING_COLUMNS)


def parse_readings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw messages into valid readings and dead letters with a reason."""
    decoded = decode_readings(raw)
    dead = decoded.filter(F.col("reason").isNotNull()).select("value", "reason")
    return valid_readings(decoded), dead
