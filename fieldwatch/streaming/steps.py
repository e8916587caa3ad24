"""Detectors over micro-batches as tables: no task gathers a series, one read feeds all sinks.

A micro-batch is cut into even, ordered blocks by the batch operators, so a series with
nearly all rows spreads over tasks. What each series ends with (its average, sum or
timer) is a table beside the query's checkpoint, and the next micro-batch begins with it.

The micro-batch is parsed once and kept for as long as it is written from: alerts,
unusable messages, and readings that come before what their series has reached already.
All of them are written under the number of the batch, so a batch that is sent again
replaces what it left.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.blocks import usable
from fieldwatch.operators.cusum import cusum_step
from fieldwatch.operators.dwell import fuzzy_step
from fieldwatch.operators.ema import ema_step
from fieldwatch.operators.registry import detect
from fieldwatch.sources.readings import decode_readings, valid_readings
from fieldwatch.sources.thresholds import Thresholds
from fieldwatch.streaming.sinks import TOPICS, SinkConf, envelope, message_value, route_alerts

# Detectors that remember a series, by the name that a deployment is configured with.
STEPS: dict[str, Callable[..., tuple[DataFrame, DataFrame]]] = {
    "EMAThresholding": ema_step,
    "CUSUMThresholding": cusum_step,
    "FuzzyThresholding": fuzzy_step,
}
LATE = "late_reading"


def _batches(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = (status.getPath().getName().partition("=") for status in files.listStatus(path))
    return sorted(int(number) for key, _, number in names if key == "batch")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class SeriesStates:
    """What series end with after each micro-batch: one small table for each batch."""

    folder: str

    def before(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """The table that a batch begins with; the batch's own is left out where it was sent before."""
        earlier = [number for number in _batches(spark, self.folder) if number < batch]
        return spark.read.parquet(f"{self.folder}/batch={earlier[-1]}") if earlier else None

    def write(self, begun: DataFrame | None, ended: DataFrame, batch: int) -> None:
        """Series of the batch as they ended, all others as they began. The table before it
        is kept for a repeat of this batch, older ones go."""
        spark = ended.sparkSession
        if begun is not None:
            ended = ended.unionByName(begun.join(ended, SERIES, "left_anti"))
        ended.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        for number in [n for n in _batches(spark, self.folder) if n < batch][:-1]:
            _remove(spark, f"{self.folder}/batch={number}")


def late_and_in_time(readings: DataFrame, begun: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Readings that are older than the last one of their series, and the others."""
    if begun is None:
        return readings.limit(0), readings
    reached = begun.select(*SERIES, F.col("last_at").alias("reached"))
    placed = readings.join(reached, SERIES, "left")
    is_late = F.coalesce(F.unix_micros("event_time") < F.col("reached"), F.lit(False))
    return placed.filter(is_late).drop("reached"), placed.filter(~is_late).drop("reached")


def alerts_of_batch(
    readings: DataFrame,
    batch: int,
    detector: str,
    thresholds: Thresholds,
    states: SeriesStates,
    keep: Callable[[DataFrame, DataFrame], None],
    **settings,
) -> None:
    """Detect over one micro-batch; ``keep`` takes its alerts and its late readings."""
    if detector not in STEPS:
        alerts = detect(detector, readings, thresholds, **settings)
        return keep(alerts, readings.limit(0))
    begun = states.before(readings.sparkSession, batch)
    late, in_time = late_and_in_time(usable(readings), begun)
    alerts, ended = STEPS[detector](in_time, thresholds, begun=begun, **settings)
    keep(alerts, late)
    states.write(begun, ended, batch)


def step_alerts(
    path: str, detector: str, thresholds: Thresholds, folder: str, **settings
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of a detector's alerts into files, for streams of readings."""

    def write(batch: DataFrame, number: int) -> None:
        def keep(alerts: DataFrame, late: DataFrame) -> None:
            alerts.write.mode("overwrite").parquet(f"{path}/alerts/batch={number}")
            late.write.mode("overwrite").parquet(f"{path}/late/batch={number}")

        alerts_of_batch(batch, number, detector, thresholds, SeriesStates(folder), keep, **settings)

    return write


@dataclass(frozen=True)
class OnePass:
    """A ``foreachBatch`` writer of everything that raw messages give, read and parsed once."""

    detector: str
    thresholds: Thresholds
    sink: SinkConf
    folder: str
    dead_letter_topic: str
    topics: Mapping[str, str] = field(default_factory=lambda: dict(TOPICS))
    settings: dict = field(default_factory=dict)

    def __call__(self, raw: DataFrame, batch: int) -> None:
        decoded = decode_readings(raw).persist()
        try:
            alerts_of_batch(
                valid_readings(decoded), batch, self.detector, self.thresholds, SeriesStates(self.folder),
                partial(self._keep, decoded, batch), **self.settings,
            )
        finally:
            decoded.unpersist()

    def _keep(self, decoded: DataFrame, batch: int, alerts: DataFrame, late: DataFrame) -> None:
        dead = decoded.filter(F.col("reason").isNotNull()).select("value", "reason")
        known = [name for name in late.columns if name != "event_time"]
        tardy = late.select(message_value(known).alias("value"), F.lit(LATE).alias("reason"))
        letters = dead.unionByName(tardy).select(
            F.lit(None).cast("string").alias("key"),
            F.to_json(F.struct("value", "reason")).alias("value"),
            F.lit(self.dead_letter_topic).alias("topic"),
        )
        self._send(envelope(route_alerts(alerts, self.topics)).unionByName(letters), batch)

    def _send(self, messages: DataFrame, batch: int) -> None:
        """One write of all messages: files of the batch's own, or Kafka by the topic column."""
        writer = messages.write.format(self.sink.format).options(**self.sink.options)
        if self.sink.format == "kafka":
            writer.option("kafka.bootstrap.servers", str(self.sink.bootstrap_servers)).save()
        else:
            writer.mode("overwrite").partitionBy("topic").save(f"{self.sink.path}/batch={batch}")
