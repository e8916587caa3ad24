"""Keyed streaming state for the detectors that remember a series.

A micro-batch's rows of a series are put in order and folded by the same
functions the batch operators use; how many there can be is bounded by the
source's ``max_per_trigger``, and ``steps`` cuts a series that is too long for a
task into blocks. With ``strict_order`` rows wait in state until the watermark
has passed them, so rows that arrive out of order across micro-batches fold in
order too.

A stream can take over from a table: the batch operators find the average, sum or timer
that each series of the table ends with, and a new query begins with these as its state.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldwatch.functions.columns import severity
from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.blocks import seconds_to_micros, tie_columns, usable
from fieldwatch.operators.cusum import METRIC as CUSUM_METRIC
from fieldwatch.operators.cusum import (
    MILLIONTHS,
    CusumRule,
    cusum_state,
    excess,
    level,
    running_sums,
)
from fieldwatch.operators.dwell import CATEGORY, METRICS, UNSET, dwell, fuzzy_state, with_bands
from fieldwatch.operators.ema import METRIC, check_alpha, ema_state, smooth
from fieldwatch.sources.thresholds import Thresholds

OUTPUT = (
    "site_id string, pollutant_type string, at bigint, concentration double, "
    "metric_value double, metric_name string, alert_category string"
)


#: Rows that wait lie in buckets of so many microseconds of their times.
BUCKET = 15 * 60 * 1_000_000


def encoded(frame: pd.DataFrame) -> bytes:
    """Rows as one value of the state."""
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def decoded(rows: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(rows)).read_pandas()


class SeriesProcessor(StatefulProcessor):
    """Order, gaps and waiting rows; subclasses fold the values.

    Rows that wait lie in buckets of time, and a batch adds a part of its own to each
    bucket that it has rows for. So what a batch reads and writes are its own rows, those
    that the watermark has passed since the last one, and one bucket at most beside: not
    all that waits.

    ``row_schema`` lists the columns a waiting row keeps, ``order`` those that
    sort a series, ``carry_schema`` the subclass's state, which ends in the
    time of the last reading.
    """

    carry_schema: str

    def __init__(self, row_schema: str, order: list[str], gap: int | None, strict: bool):
        self.row_schema = row_schema
        self.columns = [part.split()[0] for part in row_schema.split(", ")]
        self.order = order
        self.gap = gap
        self.strict = strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carry = handle.getValueState("carry", self.carry_schema)
        if self.strict:
            self.buckets = handle.getMapState("buckets", "bucket bigint", "parts int, least bigint")
            self.waiting = handle.getMapState("waiting", "bucket bigint, part int", "rows binary")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        names = [part.split()[0] for part in self.carry_schema.split(", ")]
        (row,) = initialState[names].to_dict("records")
        # Plain numbers; ``UNSET`` marks a timer that does not run.
        carry = tuple(None if row[name] == UNSET else row[name] for name in names)
        self.carry.update(carry)
        if self.gap is not None:
            self.handle.registerTimer((carry[-1] + self.gap) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        frame = pd.concat([part[self.columns] for part in rows], ignore_index=True)
        yield from self._advance(key, frame, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._advance(key, pd.DataFrame(columns=self.columns), timerValues)

    def _advance(self, key, frame, timers):
        watermark = timers.getCurrentWatermarkInMs() * 1000
        wake = None
        if self.strict:
            frame, wake = self._release(frame, watermark)
        carry = self.carry.get() if self.carry.exists() else None
        if len(frame):
            frame = frame.sort_values(self.order, kind="stable", ignore_index=True)
            at = frame["at"].to_numpy(np.int64)
            starts = np.zeros(len(at), dtype=bool)
            starts[0] = carry is None
            if self.gap is not None:
                starts[0] = starts[0] or at[0] - carry[-1] > self.gap
                starts[1:] = np.diff(at) > self.gap
            alerts, kept = self.fold(frame, starts, carry)
            carry = (*kept, int(at[-1]))
            self.carry.update(carry)
            if len(alerts):
                alerts.insert(0, "site_id", key[0])
                alerts.insert(1, "pollutant_type", key[1])
                yield alerts
        if self.gap is not None and carry is not None:
            idle = carry[-1] + self.gap
            if wake is None and watermark > idle:
                self.carry.clear()
            elif wake is None:
                wake = idle
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if wake is not None:
            self.handle.registerTimer(max(wake // 1000, watermark // 1000) + 1)

    def _release(self, frame, watermark):
        """Rows the watermark has passed, in this batch or before, and the time the next one waits for."""
        buckets = {bucket: (parts, least) for (bucket,), (parts, least) in self.buckets.iterator()}
        due = frame["at"].to_numpy(np.int64) <= watermark
        self._hold(buckets, frame[~due])
        released = [frame[due]]
        for bucket in sorted(bucket for bucket, (_, least) in buckets.items() if least <= watermark):
            parts, _ = buckets.pop(bucket)
            keys = [(bucket, number) for number in range(parts)]
            held = pd.concat([decoded(self.waiting.getValue(key)[0]) for key in keys], ignore_index=True)
            for key in keys:
                self.waiting.removeKey(key)
            self.buckets.removeKey((bucket,))
            due = held["at"].to_numpy(np.int64) <= watermark
            released.append(held[due])
            # Only the bucket in which the watermark stands keeps rows.
            self._hold(buckets, held[~due])
        wake = min((least for _, least in buckets.values()), default=None)
        filled = [part for part in released if len(part)]
        return pd.concat(filled, ignore_index=True) if filled else frame[:0], wake

    def _hold(self, buckets, rows):
        """Put rows into the buckets of their times; rows that wait already are not touched."""
        for bucket, part in rows.groupby(rows["at"].to_numpy(np.int64) // BUCKET):
            parts, least = buckets.get(bucket, (0, None))
            first = int(part["at"].min())
            buckets[bucket] = (parts + 1, first if least is None else min(first, least))
            self.waiting.updateValue((bucket, parts), (encoded(part),))
            self.buckets.updateValue((bucket,), buckets[bucket])

    def fold(self, frame, starts, carry):
        raise NotImplementedError

    def close(self) -> None:
        pass


class EmaProcessor(SeriesProcessor):
    carry_schema = "ema double, last_at bigint"

    def __init__(self, alpha: float, **common):
        super().__init__(**common)
        self.alpha = alpha

    def fold(self, frame, starts, carry):
        values = frame["concentration"].to_numpy(np.float64)
        ema = smooth(values, starts, self.alpha, carry[0] if carry else None)
        orange = (ema >= frame["orange_min"]) & (ema < frame["orange_max"])
        red = ~orange & (ema >= frame["red_min"])
        hits = (orange | red).to_numpy()
        alerts = pd.DataFrame(
            {
                "at": frame["at"][hits],
                "concentration": values[hits],
                "metric_value": ema[hits],
                "metric_name": METRIC,
                "alert_category": np.where(red[hits], "red", "orange"),
            }
        )
        return alerts, (float(ema[-1]),)


class CusumProcessor(SeriesProcessor):
    carry_schema = "total bigint, last_at bigint"

    def fold(self, frame, starts, carry):
        sums = running_sums(frame["excess"].to_numpy(np.int64), starts, carry[0] if carry else 0)
        red = sums >= frame["red_level"].to_numpy(np.int64)
        hits = sums >= frame["orange_level"].to_numpy(np.int64)
        alerts = pd.DataFrame(
            {
                "at": frame["at"][hits],
                "concentration": frame["concentration"][hits],
                "metric_value": sums[hits] / MILLIONTHS,
                "metric_name": CUSUM_METRIC,
                "alert_category": np.where(red[hits], "red", "orange"),
            }
        )
        return alerts, (int(sums[-1]),)


class FuzzyProcessor(SeriesProcessor):
    carry_schema = "band int, timer bigint, last_at bigint"

    def fold(self, frame, starts, carry):
        at = frame["at"].to_numpy(np.int64)
        values = frame["concentration"].to_numpy(np.float64)
        band = frame["band"].to_numpy(np.int64)
        rows, elapsed, last_band, timer = dwell(
            band,
            at,
            frame["allowed"].to_numpy(np.float64),
            starts,
            carry[0] if carry else 0,
            carry[1] if carry else None,
        )
        severities = frame["severity"].to_numpy(np.int64)
        hard = np.flatnonzero(severities)
        fixed = pd.DataFrame(
            {
                "at": at[hard],
                "concentration": values[hard],
                "metric_value": values[hard],
                "metric_name": "hard_threshold",
                "alert_category": np.where(severities[hard] == 2, "red", "orange"),
            }
        )
        timed = pd.DataFrame(
            {
                "at": at[rows],
                "concentration": values[rows],
                "metric_value": np.array(elapsed, dtype=np.float64) / 1e6,
                "metric_name": [METRICS[zone] for zone in band[rows]],
                "alert_category": [CATEGORY[zone] for zone in band[rows]],
            }
        )
        parts = [part for part in (fixed, timed) if len(part)]
        alerts = pd.concat(parts, ignore_index=True) if parts else fixed
        return alerts, (last_band, timer)


def _run(
    rows: DataFrame,
    processor_type,
    payload: list[str],
    watermark: str,
    max_gap,
    strict,
    state: DataFrame | None = None,
    **params,
) -> DataFrame:
    ties = tie_columns(rows)
    columns = ["at", *ties, *payload]
    watched = (
        usable(rows)
        .withColumn("at", F.unix_micros("event_time"))
        .select(*SERIES, "event_time", *columns)
        .withWatermark("event_time", watermark)
    )
    types = dict(watched.dtypes)
    processor = processor_type(
        row_schema=", ".join(f"{name} {types[name]}" for name in columns),
        order=["at", *ties, "concentration"],
        gap=seconds_to_micros(max_gap),
        strict=strict,
        **params,
    )
    return (
        watched.groupBy(*SERIES)
        .transformWithStateInPandas(
            statefulProcessor=processor,
            outputStructType=OUTPUT,
            outputMode="Append",
            timeMode="EventTime",
            initialState=None if state is None else state.groupBy(*SERIES),
        )
        .withColumn("event_time", F.timestamp_micros("at"))
        .select(
            *SERIES, "event_time", "concentration", "metric_value", "metric_name", "alert_category"
        )
    )


def stream_ema_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    alpha: float,
    max_gap: float | None,
    watermark: str,
    strict_order: bool,
    history: DataFrame | None = None,
) -> DataFrame:
    limits = ["orange_min", "orange_max", "red_min"]
    return _run(
        thresholds.join(readings, limits),
        EmaProcessor,
        ["concentration", *limits],
        watermark,
        max_gap,
        strict_order,
        None if history is None else ema_state(history, thresholds, alpha, max_gap),
        alpha=check_alpha(alpha),
    )


def stream_cusum_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    rule: CusumRule,
    max_gap: float | None,
    watermark: str,
    strict_order: bool,
    history: DataFrame | None = None,
) -> DataFrame:
    levels = {"orange_level": level(rule.orange_sum), "red_level": level(rule.red_sum)}
    rows = thresholds.join(readings, ["orange_min"]).withColumns({"excess": excess(rule)} | levels)
    return _run(
        rows,
        CusumProcessor,
        ["concentration", "excess", *levels],
        watermark,
        max_gap,
        strict_order,
        None if history is None else cusum_state(history, thresholds, rule, max_gap),
    )


def stream_fuzzy_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    max_time: float,
    delta: float,
    max_gap: float | None,
    watermark: str,
    strict_order: bool,
    history: DataFrame | None = None,
) -> DataFrame:
    banded = with_bands(readings, thresholds, max_time, delta)
    class_id = severity(F.col("concentration"), F.col("orange_min"), F.col("red_min"))
    rows = thresholds.join(banded, ["orange_min", "red_min"]).withColumn("severity", class_id)
    return _run(
        rows,
        FuzzyProcessor,
        ["concentration", "band", "allowed", "severity"],
        watermark,
        max_gap,
        strict_order,
        None if history is None else fuzzy_state(history, thresholds, max_time, delta, max_gap),
    )


def series_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a detector's query remembers of each series, read from its checkpoint.

    One row per series: its key, the carried average, sum or timer, and the time of its
    last reading, as of the last finished micro-batch.
    """
    held = spark.read.format("statestore").option("stateVarName", "carry").load(checkpoint)
    return held.select("key.*", "value.*")
