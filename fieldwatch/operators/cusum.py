"""Cumulative-sum detector: alerts on small excesses that last.

The sum of a series follows Page's rule, ``S = max(0, S + x - k)``, where ``k`` is an
allowance: readings above it add to the sum, readings below it wear it off. The effect
of any stretch of readings on the sum is ``S -> max(floor, S + shift)``, and that of two
stretches one after the other has the same form. So a block of readings is summarised by
two numbers, these go up a tree, and sums come down it (``operators/blocks.py``).

Sums are whole numbers of millionths. They do not depend on where blocks or
micro-batches are cut, to the last digit.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

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
    with_neighbours,
)
from fieldwatch.operators.effects import Effects, ends
from fieldwatch.sources.thresholds import Thresholds

METRIC = "cusum"
MILLIONTHS = 1_000_000
#: An excess or shortfall of a reading counts up to a million units.
MOST = 10**12
#: Shifts end here; sums beyond 4.6e12 units would take millions of such readings.
FAR = 1 << 62


@dataclass(frozen=True)
class CusumRule:
    """Shares of a pollutant's orange limit: the allowance, and the sums that alert."""

    allowance: float = 0.8
    orange_sum: float = 1.0
    red_sum: float = 2.0

    def __post_init__(self) -> None:
        if not 0 < self.orange_sum < self.red_sum:
            raise ValueError("need 0 < orange_sum < red_sum")


def excess(rule: CusumRule) -> Column:
    """Millionths of a reading above the allowance."""
    above = (F.col("concentration") - F.col("orange_min") * F.lit(rule.allowance)) * F.lit(float(MILLIONTHS))
    bounded = F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), above))
    return F.round(bounded).cast("long")


def level(share: float) -> Column:
    """Millionths of a share of the orange limit."""
    return F.round(F.col("orange_min") * F.lit(share * MILLIONTHS)).cast("long")


def running_sums(excesses: np.ndarray, starts: np.ndarray, carry: int) -> np.ndarray:
    """The sum after each reading; it begins at zero wherever ``starts`` is set.

    ``carry`` is the sum before the first row, used where that row starts nothing.
    """
    total = np.cumsum(excesses)
    first = np.flatnonzero(starts)
    sums = np.empty(len(total), dtype=np.int64)
    edges = [*([0] if not len(first) or first[0] else []), *first.tolist(), len(total)]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        begun = carry if low == 0 and not starts[0] else 0
        stretch = total[low:high] - (total[low - 1] if low else 0)
        sums[low:high] = stretch - np.minimum.accumulate(np.minimum(stretch, -begun))
    return sums


def chained(first: tuple[int, int], second: tuple[int, int]) -> tuple[int, int]:
    """Shift and floor of two stretches, one after the other."""
    shift = max(-FAR, min(FAR, first[0] + second[0]))
    return shift, max(second[1], first[1] + second[0])


def after(effect: tuple[int, int], given: int) -> int:
    """The sum behind a stretch that is given one."""
    return max(effect[1], given + effect[0])


SUMS = Effects("bigint", pa.int64(), chained, after, lambda total: (-FAR, total))


def _summarise(gap: int | None):
    """Where a block begins and ends, and its effect on the sum; none is left of what
    came before where a series begins inside it."""

    def run(batches):
        head = tail = block = None
        effect = (0, 0)
        for batch in filled(batches):
            starts = series_starts(batch, tail, gap)
            if head is None:
                head, block = Place.of(batch, 0), batch.column("block")[0].as_py()
                starts[0] = False
            excesses = numbers(batch, "excess")
            begins = np.flatnonzero(starts)
            end = int(running_sums(excesses, starts, 0)[-1])
            effect = (-FAR, end) if len(begins) else chained(effect, (int(excesses.sum()), end))
            tail = Place.of(batch, batch.num_rows - 1)
        if head is not None:
            unit = {"block": block, "part": 0, "p": effect[0], "q": effect[1], "fresh": after(effect, 0)}
            yield SUMS.row(unit | ends("head", head) | ends("tail", tail))

    return run


def _emit(gap: int | None, columns: list[str]):
    def run(batches):
        tail, carry = None, 0
        for batch in filled(batches):
            starts = series_starts(batch, tail, gap)
            if tail is None:
                given = batch.column("carry")[0].as_py()
                starts[0], carry = given is None, given or 0
            sums = running_sums(numbers(batch, "excess"), starts, carry)
            tail, carry = Place.of(batch, batch.num_rows - 1), int(sums[-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in columns), pa.array(sums)], names=[*columns, "total"]
            )

    return run


def cusum_series(
    readings: DataFrame,
    thresholds: Thresholds,
    rule: CusumRule = CusumRule(),
    max_gap: float | None = None,
    blocks: int | None = None,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Every reading of a batch table with the sum of its series as ``cusum``.

    Pollutants without limits have no allowance and are left out. ``max_gap`` (seconds)
    restarts a series after a longer silence. Sums are exact for up to 10**12 readings
    of a series.
    """
    return _summed(readings, thresholds, rule, max_gap, blocks, fan_out).select(
        *SERIES, "event_time", *tie_columns(readings), "concentration", (F.col("total") / MILLIONTHS).alias("cusum")
    )


def _summed(
    readings: DataFrame,
    thresholds: Thresholds,
    rule: CusumRule,
    max_gap: float | None,
    blocks: int | None,
    fan_out: int = FAN_OUT,
    begun: DataFrame | None = None,
) -> DataFrame:
    gap = seconds_to_micros(max_gap)
    exceeding = thresholds.join(readings, ["orange_min"]).withColumn("excess", excess(rule))
    # A first excess is the sum, so a sum stands as one.
    started = behind(begun, exceeding, F.col("last_at"), concentration=F.lit(0.0), excess=F.col("total"))
    ordered = ordered_blocks(started, ["concentration", "excess", "orange_min", "seed"], blocks)
    carried = with_neighbours(
        ordered, ["excess"], F.lit(True), _summarise(gap), SUMS.schema, SUMS.merge(gap), SUMS.fold(gap), "bigint", fan_out
    )
    columns = [*SERIES, "at", *tie_columns(readings), "concentration", "orange_min", "seed"]
    types = dict(ordered.dtypes)
    schema = ", ".join(f"{name} {types[name]}" for name in columns) + ", total bigint"
    return (
        carried.select(*columns, "excess", "carry")
        .mapInArrow(_emit(gap, columns), schema)
        .filter(~F.col("seed"))
        .withColumn("event_time", F.timestamp_micros("at"))
    )


def alert_category(rule: CusumRule) -> Column:
    """Red from the red sum, orange from the orange sum, else null."""
    return F.when(F.col("total") >= level(rule.red_sum), "red").when(F.col("total") >= level(rule.orange_sum), "orange")


def alerts_on_sums(summed: DataFrame, rule: CusumRule) -> DataFrame:
    return (
        summed.withColumn("alert_category", alert_category(rule))
        .filter(F.col("alert_category").isNotNull())
        .select(
            *SERIES,
            "event_time",
            "concentration",
            (F.col("total") / MILLIONTHS).alias("metric_value"),
            F.lit(METRIC).alias("metric_name"),
            "alert_category",
        )
    )


def cusum_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    rule: CusumRule = CusumRule(),
    max_gap: float | None = None,
    watermark: str = "1 hour",
    strict_order: bool = False,
    blocks: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Alerts while the sum of a series is at the orange or red level, table or stream.

    The sum is not set back by an alert; it falls as readings do. A stream goes on from
    the sums that the table ``history`` ends with, if one is given.
    """
    if readings.isStreaming:
        from fieldwatch.streaming.detectors import stream_cusum_alerts

        return stream_cusum_alerts(readings, thresholds, rule, max_gap, watermark, strict_order, history)
    if history is not None:
        raise ValueError("history is handed to streams; unite tables instead")
    return alerts_on_sums(_summed(readings, thresholds, rule, max_gap, blocks), rule)


def cusum_step(
    readings: DataFrame,
    thresholds: Thresholds,
    rule: CusumRule = CusumRule(),
    max_gap: float | None = None,
    blocks: int | None = None,
    begun: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Alerts of a batch table, and the sum that each of its series ends with.

    ``begun`` holds the sums that series begin with, as the second result of the table
    before.
    """
    summed = _summed(readings, thresholds, rule, max_gap, blocks, begun=begun)
    order = F.struct("at", *tie_columns(readings), "concentration")
    state = summed.groupBy(*SERIES).agg(
        F.max_by("total", order).alias("total"), F.max("at").alias("last_at")
    )
    return alerts_on_sums(summed, rule), state


def cusum_state(history: DataFrame, thresholds: Thresholds, *settings, **more) -> DataFrame:
    """The sum that each series ends with, and the time of its last reading."""
    return cusum_step(history, thresholds, *settings, **more)[1]
