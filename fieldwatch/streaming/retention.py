"""The newest hours of each series, kept as a stream: a change log of upserts and deletes.

State is a map from hour to sum and count, of at most ``keep`` hours a series. Readings
are summed by hour in the tasks that read them, so a series sends one row for each hour
and Arrow batch, not its readings. An hour that is not among the newest never comes back
among them, so what was dropped is never missed and no watermark is needed: a late
reading changes its hour for as long as that is held.
"""

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldwatch.functions.schemas import HOURLY_KEY, SERIES
from fieldwatch.operators.blocks import usable
from fieldwatch.streaming.sinks import read_current

KEEP = 25
HOUR = 3600
UPSERT, DELETE = "upsert", "delete"
PARTIAL = "site_id string, pollutant_type string, hour bigint, total double, readings bigint"
CHANGES = "site_id string, pollutant_type string, hour bigint, avg_value double, change string"


def _sum_by_hour(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.Table.from_batches([batch]).group_by([*SERIES, "hour"])
        sums = rows.aggregate([("concentration", "sum"), ("concentration", "count")])
        yield from sums.rename_columns([*SERIES, "hour", "total", "readings"]).to_batches()


class NewestHours(StatefulProcessor):
    """Sums of the newest hours of one series; what changes goes out."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.hours = handle.getMapState("hours", "hour bigint", "total double, readings bigint")

    def handleInputRows(self, key, rows, timerValues):
        came: dict[int, tuple[float, int]] = {}
        for part in rows:
            sums = part.groupby("hour")[["total", "readings"]].sum()
            for hour, total, readings in sums.itertuples(name=None):
                before = came.get(hour, (0.0, 0))
                came[int(hour)] = (before[0] + float(total), before[1] + int(readings))
        held = {hour: value for (hour,), value in self.hours.iterator()}
        newest = set(sorted(held.keys() | came.keys())[-self.keep :])
        changes = []
        for hour in sorted(held.keys() - newest):
            self.hours.removeKey((hour,))
            changes.append((hour, None, DELETE))
        for hour in sorted(came.keys() & newest):
            total, readings = (a + b for a, b in zip(held.get(hour, (0.0, 0)), came[hour], strict=True))
            self.hours.updateValue((hour,), (total, readings))
            changes.append((hour, total / readings, UPSERT))
        if changes:
            frame = pd.DataFrame(changes, columns=["hour", "avg_value", "change"])
            frame["avg_value"] = frame["avg_value"].astype("float64")
            frame.insert(0, "site_id", key[0])
            frame.insert(1, "pollutant_type", key[1])
            yield frame

    def close(self) -> None:
        pass


def newest_hours(readings: DataFrame, keep: int = KEEP) -> DataFrame:
    """Changes to the newest ``keep`` hourly means of each series, for a stream.

    ``change`` says whether a mean is new or changed, or its hour is among the newest no
    more. A micro-batch names an hour of a series once.
    """
    hour = F.floor(F.unix_seconds("event_time") / HOUR).cast("long")
    thin = usable(readings).select(*SERIES, hour.alias("hour"), "concentration")
    return (
        thin.mapInArrow(_sum_by_hour, PARTIAL)
        .groupBy(*SERIES)
        .transformWithStateInPandas(
            statefulProcessor=NewestHours(keep), outputStructType=CHANGES, outputMode="Update", timeMode="None"
        )
        .select(*SERIES, F.timestamp_seconds(F.col("hour") * HOUR).alias("start_time"), "avg_value", "change")
    )


def retained_hours(spark: SparkSession, path: str) -> DataFrame:
    """The newest hours as the change log below ``path`` leaves them."""
    current = read_current(spark, HOURLY_KEY, path)
    return current.filter(F.col("change") == UPSERT).drop("change")
