"""Exponential moving average per series, and alerts on it."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.blocks import (
    FAN_OUT,
    Place,
    behind,
    filled,
    numbers,
    ordered_blocks,
    seconds_to_micros,
    series_starts,
    tie_columns,
    with_carries,
)
from fieldwatch.operators.effects import Effects
from fieldwatch.sources.thresholds import Thresholds

# Fixed value: the metric name carried by these alerts.
METRIC = "ema"


def check_alpha(alpha: float) -> float:
    if not 0 < alpha <= 1:
        raise ValueError(f"alpha must lie in (0, 1], got {alpha}")
    return alpha


def smooth(values: np.ndarray, starts: np.ndarray, alpha: float, carry: float | None) -> np.ndarray:
    """The average after each value; it restarts wherever ``starts`` is set.

    When the first row does not start a series, ``carry`` is the average
    before it.
    """
    carried = not starts[0]
    if carried:
        values = np.concatenate(([carry], values))
        starts = np.concatenate(([True], starts))
    series = pd.Series(values)
    if starts[1:].any():
        series = series.groupby(np.cumsum(starts))
    smoothed = series.ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return smoothed[1:] if carried else smoothed


def block_ends(ordered: DataFrame, alpha: float, gap: int | None) -> DataFrame:
    """One row per block: its first and last row, and its effect on the average.

    The average it ends with is a weighted sum over the block's last stretch of one
    series, taken in the JVM.
    """
    decay = 1.0 - alpha
    place = F.struct(*SERIES, "at")
    edges = ordered.groupBy("block").agg(
        F.min_by(place, "pos").alias("head"),
        F.max_by(place, "pos").alias("tail"),
        F.min_by("concentration", "pos").alias("first_value"),
        F.count("*").alias("row_count"),
    )
    rows = ordered.select("block", "pos", "at", *SERIES, "concentration")
    if gap is not None:
        before = F.lag("at").over(Window.partitionBy("block", *SERIES).orderBy("pos"))
        rows = rows.withColumn("restart", F.when(F.col("at") - before > gap, F.col("pos")))
        restarts = rows.groupBy("block", *SERIES).agg(F.max("restart").alias("since"))
        tails = edges.select("block", *[F.col(f"tail.{name}").alias(name) for name in SERIES])
        edges = edges.join(restarts.join(tails, ["block", *SERIES]).select("block", "since"), "block")
    else:
        edges = edges.withColumn("since", F.lit(None).cast("long"))
    # One row per block.
    known = F.broadcast(edges.select("block", "tail", "row_count", "since"))
    same = [F.col(name) == F.col(f"tail.{name}") for name in SERIES]
    stretch = rows.select("block", "pos", *SERIES, "concentration").join(known, "block")
    stretch = stretch.filter(same[0] & same[1] & (F.col("pos") >= F.coalesce("since", F.lit(0))))
    weight = F.pow(F.lit(decay), (F.col("row_count") - 1 - F.col("pos")).cast("double"))
    sums = stretch.groupBy("block").agg(
        F.sum(F.lit(alpha) * weight * F.col("concentration")).alias("total"),
        F.min("pos").alias("start"),
        F.min_by("concentration", "pos").alias("start_value"),
    )
    # The first value of a stretch counts in full.
    rest = F.pow(F.lit(decay), (F.col("row_count") - F.col("start")).cast("double"))
    end_value = F.col("total") + rest * F.col("start_value")
    # Started at average c instead of its own first value, a block of n rows ends
    # (1 - alpha)**n * (c - first value) higher; nothing is left of c where the stretch
    # is not the whole block.
    factor = F.when(F.col("start") == 0, F.pow(F.lit(decay), F.col("row_count").cast("double"))).otherwise(0.0)
    return edges.join(sums, "block").select(
        "block",
        F.lit(0).alias("part"),
        F.col("head.site_id").alias("head_site"),
        F.col("head.pollutant_type").alias("head_pollutant"),
        F.col("head.at").alias("head_at"),
        F.col("tail.site_id").alias("tail_site"),
        F.col("tail.pollutant_type").alias("tail_pollutant"),
        F.col("tail.at").alias("tail_at"),
        factor.alias("p"),
        (end_value - factor * F.col("first_value")).alias("q"),
        end_value.alias("fresh"),
    )


AVERAGES = Effects(
    "double",
    pa.float64(),
    chain=lambda first, second: (first[0] * second[0], first[1] * second[0] + second[1]),
    after=lambda effect, given: effect[0] * given + effect[1],
    forgets=lambda average: (0.0, average),
)


def _emit(alpha: float, gap: int | None, columns: list[str]):
    def run(batches):
        tail, carry = None, None
        for batch in filled(batches):
            starts = series_starts(batch, tail, gap)
            if tail is None:
                carry = batch.column("carry")[0].as_py()
                starts[0] = carry is None
            smoothed = smooth(numbers(batch, "concentration"), starts, alpha, carry)
            tail, carry = Place.of(batch, batch.num_rows - 1), float(smoothed[-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in columns), pa.array(smoothed)],
                names=[*columns, "ema"],
            )

    return run


def _smoothed(
    readings: DataFrame,
    alpha: float,
    max_gap: float | None,
    blocks: int | None,
    ties: list[str],
    begun: DataFrame | None = None,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    check_alpha(alpha)
    gap = seconds_to_micros(max_gap)
    # A first value counts in full, so an average stands as one.
    started = behind(begun, readings, F.col("last_at"), concentration=F.col("ema"))
    ordered = ordered_blocks(started, ["concentration", "seed"], blocks)
    carried = with_carries(
        ordered, block_ends(ordered, alpha, gap), AVERAGES.merge(gap), AVERAGES.schema, AVERAGES.fold(gap), "double", fan_out
    )
    columns = [*SERIES, "at", *ties, "concentration", "seed"]
    types = dict(ordered.dtypes)
    schema = ", ".join(f"{name} {types[name]}" for name in columns) + ", ema double"
    return (
        carried.select(*columns, "carry")
        .mapInArrow(_emit(alpha, gap, columns), schema)
        .filter(~F.col("seed"))
        .select(
            *SERIES, F.timestamp_micros("at").alias("event_time"), *ties, "concentration", "ema"
        )
    )


def ema_series(
    readings: DataFrame,
    alpha: float = 0.3,
    max_gap: float | None = None,
    blocks: int | None = None,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Every reading of a batch table with the moving average of its series.

    ``max_gap`` (seconds) restarts a series after a longer silence.
    """
    return _smoothed(readings, alpha, max_gap, blocks, tie_columns(readings), fan_out=fan_out)


def alerts_on_ema(series: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Alerts where the average lies in the orange band or at red and above."""
    value = F.col("ema")
    category = F.when(
        (value >= F.col("orange_min")) & (value < F.col("orange_max")), "orange"
    ).when(value >= F.col("red_min"), "red")
    return (
        thresholds.join(series, ["orange_min", "orange_max", "red_min"])
        .withColumn("alert_category", category)
        .filter(F.col("alert_category").isNotNull())
        .select(
            *SERIES,
            "event_time",
            "concentration",
            F.col("ema").alias("metric_value"),
            F.lit(METRIC).alias("metric_name"),
            "alert_category",
        )
    )


def ema_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    alpha: float = 0.3,
    max_gap: float | None = None,
    watermark: str = "1 hour",
    strict_order: bool = False,
    blocks: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Alerts on the moving average, for a batch table or a stream.

    A stream goes on from the averages that the table ``history`` ends with, if one is
    given.
    """
    if readings.isStreaming:
        from fieldwatch.streaming.detectors import stream_ema_alerts

        return stream_ema_alerts(
            readings, thresholds, alpha, max_gap, watermark, strict_order, history
        )
    if history is not None:
        raise ValueError("history is handed to streams; unite tables instead")
    known = readings.filter(F.col("pollutant_type").isin(list(thresholds.limits)))
    return alerts_on_ema(_smoothed(known, alpha, max_gap, blocks, []), thresholds)


def ema_step(
    readings: DataFrame,
    thresholds: Thresholds,
    alpha: float = 0.3,
    max_gap: float | None = None,
    blocks: int | None = None,
    begun: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Alerts of a batch table, and the average that each of its series ends with.

    ``begun`` holds the averages that series begin with, as the second result of the
    table before. Only series with limits are watched.
    """
    ties = tie_columns(readings)
    known = readings.filter(F.col("pollutant_type").isin(list(thresholds.limits)))
    smoothed = _smoothed(known, alpha, max_gap, blocks, ties, begun)
    order = F.struct("event_time", *ties, "concentration")
    state = smoothed.groupBy(*SERIES).agg(
        F.max_by("ema", order).alias("ema"), F.unix_micros(F.max("event_time")).alias("last_at")
    )
    return alerts_on_ema(smoothed, thresholds), state


def ema_state(history: DataFrame, thresholds: Thresholds, *settings, **more) -> DataFrame:
    """The average that each series ends with, and the time of its last reading."""
    return ema_step(history, thresholds, *settings, **more)[1]
