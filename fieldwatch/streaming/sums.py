"""Hourly and daily sums that add up, kept as files without reading what is there.

A micro-batch writes the sums of its own readings by hour, and those hours' sums by day.
Readers add up the rows of a key, and so does the folding of crowded days. Late readings
need no special care: they are one more row. A batch that is sent again is known by its
writer's name and number, and counts once.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import DAILY_KEY, HOURLY_KEY
from fieldwatch.operators.rollup import added_up, daily_sums, hourly_sums, weighted_mean
from fieldwatch.streaming.sinks import BatchWriter, read_versions
from fieldwatch.streaming.snapshots import BATCH_ID, DAY, Fold, write_version


def sums_of(keys: list[str]) -> Fold:
    """Folds parts into one row of each key, the sum of all."""

    def fold(parts: DataFrame) -> DataFrame:
        return added_up(parts, [*keys, DAY], F.max(BATCH_ID).alias(BATCH_ID))

    return fold


def add_sums(hourly_path: str, daily_path: str, name: str) -> BatchWriter:
    """A ``foreachBatch`` writer of readings' sums by hour and day.

    ``name`` stands for the query; another one, or one with a new checkpoint that reads
    other readings, takes another name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        hours = hourly_sums(batch).persist()
        try:
            for rows, path, keys in ((hours, hourly_path, HOURLY_KEY), (daily_sums(hours), daily_path, DAILY_KEY)):
                write_version(rows, path, keys[-1], None, sums_of(keys), (name, batch_id))
        finally:
            hours.unpersist()

    return write


def read_means(spark: SparkSession, path: str, keys: list[str], name: str, days: list[str] | None = None) -> DataFrame:
    """Means of all readings of each key, with their number, of some days only if named."""
    return weighted_mean(added_up(read_versions(spark, path, days), keys), name)
