"""Fuzzy detector: fixed limits plus a limit on time spent just below them.

A band of width ``delta`` lies under the orange and the red limit. The time a
series may stay in a band shrinks linearly from ``max_time`` at its floor to
zero at the limit. The timer starts with the first reading of a run of
consecutive readings in one band, restarts after it fires and is dropped when
the run ends. So the timer is all that one block has to tell the next.
"""

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.blocks import (
    FAN_OUT,
    Place,
    behind,
    filled,
    numbers,
    one_row,
    ordered_blocks,
    seconds_to_micros,
    series_starts,
    with_neighbours,
)
from fieldwatch.operators.thresholding import open_orange_alerts
from fieldwatch.sources.thresholds import Thresholds

# Metric names carried by the dwell alerts, by band.
ORANGE_BAND, RED_BAND = 1, 2
METRICS = {ORANGE_BAND: "fuzzy_zone_orange_duration", RED_BAND: "fuzzy_zone_red_duration"}
CATEGORY = {ORANGE_BAND: "orange", RED_BAND: "red"}
LONGEST_TIME = 86400

SUMMARY = (
    "block int, part int, head_site string, head_pollutant string, head_at bigint, head_band int, "
    "tail_site string, tail_pollutant string, tail_at bigint, tail_band int, "
    "timer bigint, reach array<bigint>, leaves array<bigint>"
)


def band_limits(
    thresholds: Thresholds, max_time: float, delta: float
) -> dict[str, dict[str, float]]:
    """Band floors and the straight line of allowed seconds, per pollutant."""
    if max_time > LONGEST_TIME:
        raise ValueError(f"max_time is at most {LONGEST_TIME} seconds, got {max_time}")
    if delta <= 0:
        raise ValueError(f"delta must be positive, got {delta}")
    bands = {}
    for pollutant, row in thresholds.limits.items():
        if delta > row["red_min"] - row["orange_min"]:
            raise ValueError(f"{pollutant}: delta reaches below the orange limit")
        bands[pollutant] = {}
        for name in ("orange", "red"):
            limit = row[f"{name}_min"]
            floor = limit - delta
            # The line from the full wait at the floor to none at the limit.
            slope = (0 - max_time) / (limit - floor)
            bands[pollutant] |= {
                f"{name}_floor": floor,
                f"{name}_slope": slope,
                f"{name}_intercept": max_time - slope * floor,
            }
    return bands


BAND_COLUMNS = [f"{name}_{part}" for name in ("orange", "red") for part in ("floor", "slope", "intercept")]


def with_bands(readings: DataFrame, thresholds: Thresholds, max_time: float, delta: float) -> DataFrame:
    """Add ``band`` (0 outside) and ``allowed`` seconds to each reading."""
    value = F.col("concentration")
    bands = band_limits(thresholds, max_time, delta)
    in_red = (value >= F.col("red_floor")) & (value < F.col("red_min"))
    in_orange = (value >= F.col("orange_floor")) & (value < F.col("orange_min"))
    joined = thresholds.join(
        readings, ["orange_min", "red_min", *BAND_COLUMNS], "inner", bands
    )
    return (
        joined.withColumn("band", F.when(in_red, RED_BAND).when(in_orange, ORANGE_BAND).otherwise(0))
        .withColumn(
            "allowed",
            F.when(in_red, F.col("red_slope") * value + F.col("red_intercept")).when(
                in_orange, F.col("orange_slope") * value + F.col("orange_intercept")
            ).otherwise(0.0),
        )
        .drop("orange_min", "red_min", *BAND_COLUMNS)
    )


def due_micros(allowed: np.ndarray) -> np.ndarray:
    """Least whole microseconds whose seconds are not below ``allowed``."""
    due = np.ceil(allowed * 1e6)
    due = np.where((due - 1) / 1e6 >= allowed, due - 1, due)
    due = np.where(due / 1e6 < allowed, due + 1, due)
    return due.astype(np.int64)


def dwell(
    band: np.ndarray,
    at: np.ndarray,
    allowed: np.ndarray,
    starts: np.ndarray,
    last_band: int,
    timer: int | None,
) -> tuple[list[int], list[int], int, int | None]:
    """Rows that fire with their elapsed microseconds, and the state after.

    ``last_band`` and ``timer`` are the state before the first row; they count
    only where that row goes on with the series and the band.
    """
    rows, elapsed = [], []
    inside = np.flatnonzero(band)
    before = -1
    columns = zip(
        inside.tolist(),
        band[inside].tolist(),
        at[inside].tolist(),
        due_micros(allowed[inside]).tolist(),
        starts[inside].tolist(),
        strict=True,
    )
    for row, zone, now, due, start in columns:
        if start or zone != last_band or row != before + 1:
            timer = None
        if timer is None:
            timer = now
        if now - timer >= due:
            rows.append(row)
            elapsed.append(now - timer)
            timer = None
        before, last_band = row, zone
    if before != len(band) - 1:
        return rows, elapsed, 0, None
    return rows, elapsed, last_band, timer


# -- a block that is one single run ------------------------------------------
#
# Where a series stays in one band for a whole block, the timer the block hands
# on depends on the timer it was given. That dependence is a step function of
# the given start time s: rows fire at the first ``reach >= s`` (reach = time
# minus due time), after which the rest of the block runs from a fresh start.
# It is kept as the rising record values of reach with the timer left after
# each; past the last record nothing fires and s itself is handed on. ``UNSET``
# marks no timer.

UNSET = np.iinfo(np.int64).min
# Steps per summary row: a block with more spreads over several rows.
STEPS = 1024


def run_response(at: np.ndarray, due: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Step function of one run, and the timer it leaves when given none."""
    reach = (at - due).tolist()
    times = at.tolist()
    size = len(times)
    fresh = [UNSET] * (size + 1)
    ahead_reach: list[int] = []  # negated reach, rising: nearer rows reach less far
    ahead_row: list[int] = []
    for row in range(size - 1, -1, -1):
        while ahead_reach and -ahead_reach[-1] <= reach[row]:
            ahead_reach.pop()
            ahead_row.pop()
        ahead_reach.append(-reach[row])
        ahead_row.append(row)
        fires = bisect_right(ahead_reach, -times[row]) - 1
        fresh[row] = times[row] if fires < 0 else fresh[ahead_row[fires] + 1]
    records = np.array([-value for value in ahead_reach[::-1]], dtype=np.int64)
    leaves = np.array([fresh[row + 1] for row in ahead_row[::-1]], dtype=np.int64)
    return records, leaves, fresh[0]


def respond(reach: np.ndarray, leaves: np.ndarray, fresh: int, given: np.ndarray) -> np.ndarray:
    """Timers handed on for the given ones."""
    step = np.searchsorted(reach, given, side="left")
    fired = step < len(reach)
    out = np.where(fired, leaves[np.minimum(step, len(reach) - 1)], given)
    return np.where(given == UNSET, fresh, out)


def chain(first, second):
    """The response of two stretches of a run, one after the other."""
    reach, leaves, fresh = first
    beyond = second[0] > reach[-1]
    return (
        np.concatenate((reach, second[0][beyond])),
        np.concatenate((respond(*second, leaves), second[1][beyond])),
        int(respond(*second, np.array([fresh]))[0]),
    )


def needed_steps(reach: np.ndarray, leaves: np.ndarray, first_at: int):
    """Steps a timer from before the block can meet, equal ones merged."""
    used = int(np.searchsorted(reach, first_at, side="left")) + 1
    reach, leaves = reach[:used], leaves[:used]
    last_of_step = np.append(leaves[1:] != leaves[:-1], True)
    return reach[last_of_step], leaves[last_of_step]


class Stretches:
    """The response of a run from those of its stretches.

    A stretch is joined to the one before it once it is of its size, so the work
    grows with the number of steps but for a logarithm. Steps that no timer from
    before a stretch can meet are left out, and a timer waits ``max_time`` at most: what
    is kept are steps of the readings in that time, however long the run is.
    """

    def __init__(self) -> None:
        self.parts: list[tuple] = []

    def add(self, first_at: int, response) -> None:
        reach, leaves, fresh = response
        self.parts.append((first_at, (*needed_steps(reach, leaves, first_at), fresh)))
        while len(self.parts) > 1 and len(self.parts[-2][1][0]) <= 2 * len(self.parts[-1][1][0]):
            self._join_last()

    def _join_last(self) -> None:
        _, second = self.parts.pop()
        first_at, first = self.parts.pop()
        reach, leaves, fresh = chain(first, second)
        self.parts.append((first_at, (*needed_steps(reach, leaves, first_at), fresh)))

    def response(self):
        while len(self.parts) > 1:
            self._join_last()
        return self.parts[0][1]


def _summary(unit: dict, stretches: Stretches | None):
    """The rows of one summary; ``unit`` holds all but the steps."""
    reach, leaves, _ = stretches.response() if stretches else (None, None, None)
    kinds = {"block": pa.int32(), "part": pa.int32()}
    for end in ("head", "tail"):
        kinds |= {f"{end}_site": pa.string(), f"{end}_pollutant": pa.string()}
        kinds |= {f"{end}_at": pa.int64(), f"{end}_band": pa.int32()}
    kinds["timer"] = pa.int64()
    for part, low in enumerate(range(0, 1 if reach is None else len(reach), STEPS)):
        cut = slice(low, low + STEPS)
        yield one_row(
            **{name: ((unit | {"part": part})[name], kind) for name, kind in kinds.items()},
            reach=(None if reach is None else reach[cut], pa.list_(pa.int64())),
            leaves=(None if reach is None else leaves[cut], pa.list_(pa.int64())),
        )


def _ends(end: str, place: Place, band: int) -> dict:
    return {
        f"{end}_site": place.site_id,
        f"{end}_pollutant": place.pollutant_type,
        f"{end}_at": place.at,
        f"{end}_band": band,
    }


def _summarise(gap: int | None):
    """The summary of a block, from its readings in a band and its two ends."""

    def run(batches):
        head = tail = timer = block = None
        head_band = tail_band = rows = size = 0
        stretches = Stretches()
        for batch in filled(batches):
            starts = series_starts(batch, tail, gap)
            band, at = numbers(batch, "band"), numbers(batch, "at")
            allowed = numbers(batch, "allowed")
            first = head is None
            if first:
                head, head_band = Place.of(batch, 0), int(band[0])
                block, size = (batch.column(name)[0].as_py() for name in ("block", "row_count"))
            one_run = (
                head_band > 0
                and (band == head_band).all()
                and not starts[1:].any()
                and (first or not starts[0])
            )
            if not one_run:
                stretches = None
            elif stretches:
                stretches.add(int(at[0]), run_response(at, due_micros(allowed)))
            _, _, tail_band, timer = dwell(band, at, allowed, starts, tail_band, timer)
            tail = Place.of(batch, batch.num_rows - 1)
            rows += batch.num_rows
        if head is None:
            return
        ends = _ends("head", head, head_band) | _ends("tail", tail, tail_band)
        yield from _summary({"block": block, "timer": timer} | ends, stretches if rows == size else None)

    return run


def _units(batches):
    """Summaries with their ``response``, from rows ordered by group, block and part."""
    unit, reach, leaves = None, [], []

    def whole():
        fresh = UNSET if unit["timer"] is None else unit["timer"]
        found = (np.concatenate(reach), np.concatenate(leaves), fresh) if reach else None
        return unit | {"response": found}

    for batch in filled(batches):
        names = [name for name in batch.schema.names if name not in ("reach", "leaves")]
        for row, found in enumerate(batch.select(names).to_pylist()):
            if found["part"] == 0:
                if unit:
                    yield whole()
                unit, reach, leaves = found, [], []
            if batch.column("reach")[row].is_valid:
                reach.append(batch.column("reach")[row].values.to_numpy())
                leaves.append(batch.column("leaves")[row].values.to_numpy())
    if unit:
        yield whole()


def _goes_on(unit: dict, before: dict, gap: int | None) -> bool:
    """True when a unit begins in the run that the one before it ends in."""
    head = Place(unit["head_site"], unit["head_pollutant"], unit["head_at"])
    tail = Place(before["tail_site"], before["tail_pollutant"], before["tail_at"])
    return head.continues(tail, gap) and unit["head_band"] == before["tail_band"]


def _timer_after(unit: dict, given: int | None) -> int | None:
    """The timer that a unit hands on when it is given one."""
    if given is None or unit["response"] is None:
        return unit["timer"]
    left = int(respond(*unit["response"], np.array([given]))[0])
    return None if left == UNSET else left


def _merge(gap: int | None):
    """One summary for each group of neighbouring ones."""

    def run(batches):
        whole, stretches = None, None
        for unit in _units(batches):
            if whole is None or whole["block"] != unit["group"]:
                if whole:
                    yield from _summary(whole, stretches)
                whole = unit | {"block": unit["group"]}
                stretches = Stretches() if unit["response"] else None
            else:
                goes_on = _goes_on(unit, whole, gap)
                whole["timer"] = _timer_after(unit, whole["timer"] if goes_on else None)
                whole |= {name: value for name, value in unit.items() if name.startswith("tail_")}
                if not goes_on or not unit["response"]:
                    stretches = None
            if stretches:
                stretches.add(unit["head_at"], unit["response"])
        if whole:
            yield from _summary(whole, stretches)

    return run


def _fold(gap: int | None):
    """The running timer each unit is given; ``carry`` is the one given to its group."""

    def run(batches):
        blocks, timers = [], []
        before, out = None, None
        for unit in _units(batches):
            if before is None or before["group"] != unit["group"]:
                given = unit["carry"]
            else:
                given = out if _goes_on(unit, before, gap) else None
            if given is not None:
                blocks.append(unit["block"])
                timers.append(given)
            before, out = unit, _timer_after(unit, given)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array(timers, pa.int64())], names=["block", "carry"]
        )

    return run


FIRED = (
    "site_id string, pollutant_type string, at bigint, concentration double, "
    "band int, elapsed bigint"
)


def _emit(gap: int | None):
    """The readings that fire, from a block's readings in a band."""

    def run(batches):
        tail, tail_band, timer = None, 0, None
        for batch in filled(batches):
            starts = series_starts(batch, tail, gap)
            band = numbers(batch, "band")
            if tail is None and batch.column("pos")[0].as_py() == 0:
                timer = batch.column("carry")[0].as_py()
                tail_band = int(band[0])
                starts[0] = timer is None
            rows, elapsed, tail_band, timer = dwell(
                band, numbers(batch, "at"), numbers(batch, "allowed"), starts, tail_band, timer
            )
            tail = Place.of(batch, batch.num_rows - 1)
            if rows:
                hits = batch.take(pa.array(rows))
                names = [*SERIES, "at", "concentration", "band"]
                yield pa.RecordBatch.from_arrays(
                    [*(hits.column(name) for name in names), pa.array(elapsed, pa.int64())],
                    names=[*names, "elapsed"],
                )

    return run


def _leave(gap: int | None):
    """The timer after the last reading that a batch holds of each series."""

    def run(batches):
        tail, tail_band, timer = None, 0, None
        for batch in filled(batches):
            starts = series_starts(batch, tail, gap)
            band, at, allowed = (numbers(batch, name) for name in ("band", "at", "allowed"))
            if tail is None and batch.column("pos")[0].as_py() == 0:
                timer = batch.column("carry")[0].as_py()
                tail_band = int(band[0])
                starts[0] = timer is None
            begins = np.flatnonzero(series_starts(batch.select([*SERIES, "at"]), None, None))
            edges = [*begins.tolist(), batch.num_rows]
            ends, timers = [], []
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                part = slice(low, high)
                _, _, tail_band, timer = dwell(
                    band[part], at[part], allowed[part], starts[part], tail_band, timer
                )
                ends.append(high - 1)
                timers.append(timer)
            tail = Place.of(batch, batch.num_rows - 1)
            last = batch.take(pa.array(ends))
            yield pa.RecordBatch.from_arrays(
                [last.column("block"), last.column("pos"), pa.array(timers, pa.int64())],
                names=["block", "pos", "timer"],
            )

    return run


def readings_in_bands(ordered: DataFrame, gap: int | None, fan_out: int = FAN_OUT) -> DataFrame:
    """A table's readings inside a band, with the timer that their block is given."""
    in_band = F.col("band") > 0
    carried = with_neighbours(
        ordered,
        ["band", "allowed"],
        in_band,
        _summarise(gap),
        SUMMARY,
        _merge(gap),
        _fold(gap),
        "bigint",
        fan_out,
    )
    columns = ["concentration", "band", "allowed"]
    return carried.filter(in_band).select("block", *SERIES, "at", "pos", *columns, "carry")


def fuzzy_step(
    readings: DataFrame,
    thresholds: Thresholds,
    max_time: float = 14400,
    delta: float = 10,
    max_gap: float | None = None,
    blocks: int | None = None,
    begun: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Alerts of a batch table, and the band and timer that each of its series ends with.

    ``timer`` is ``UNSET`` where none runs. ``begun`` holds what series begin with, as
    the second result of the table before.
    """
    gap = seconds_to_micros(max_gap)
    ordered = banded_blocks(readings, thresholds, max_time, delta, blocks, begun, gap)
    real = ordered.filter(~F.col("seed"))
    place = F.struct("block", "pos")
    ends = real.groupBy(*SERIES).agg(
        F.max(place).alias("end"), F.max_by("band", place).alias("band"), F.max("at").alias("last_at")
    )
    timers = readings_in_bands(ordered, gap).mapInArrow(_leave(gap), "block int, pos bigint, timer bigint")
    state = (
        ends.select(*SERIES, "end.block", "end.pos", "band", "last_at")
        .join(timers, ["block", "pos"], "left")
        .select(*SERIES, "band", F.coalesce("timer", F.lit(UNSET)).alias("timer"), "last_at")
    )
    hard = open_orange_alerts(real.withColumn("event_time", F.timestamp_micros("at")), thresholds)
    timed = dwell_alerts(readings, thresholds, max_time, delta, max_gap, ordered=ordered)
    return hard.unionByName(timed), state


def fuzzy_state(history: DataFrame, thresholds: Thresholds, *settings, **more) -> DataFrame:
    """The band and timer that each series ends with, and the time of its last reading."""
    return fuzzy_step(history, thresholds, *settings, **more)[1]


def dwell_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    max_time: float = 14400,
    delta: float = 10,
    max_gap: float | None = None,
    blocks: int | None = None,
    ordered: DataFrame | None = None,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Only the alerts on time spent in a band, for a batch table."""
    gap = seconds_to_micros(max_gap)
    if ordered is None:
        ordered = banded_blocks(readings, thresholds, max_time, delta, blocks)
    inside = readings_in_bands(ordered, gap, fan_out).drop("block")
    red = F.col("band") == RED_BAND
    return inside.mapInArrow(_emit(gap), FIRED).select(
        *SERIES,
        F.timestamp_micros("at").alias("event_time"),
        "concentration",
        (F.col("elapsed") / F.lit(1e6)).alias("metric_value"),
        F.when(red, METRICS[RED_BAND]).otherwise(METRICS[ORANGE_BAND]).alias("metric_name"),
        F.when(red, CATEGORY[RED_BAND]).otherwise(CATEGORY[ORANGE_BAND]).alias("alert_category"),
    )


def banded_blocks(
    readings: DataFrame,
    thresholds: Thresholds,
    max_time: float,
    delta: float,
    blocks: int | None = None,
    begun: DataFrame | None = None,
    gap: int | None = None,
) -> DataFrame:
    """Readings with their bands in ordered blocks, behind the states they begin with.

    A timer that runs stands as rows in its band from its start to the last reading, none
    further apart than ``gap``, that can't fire; else the last reading stands as one
    outside of all bands.
    """
    banded = with_bands(readings, thresholds, max_time, delta)
    if begun is not None:
        step = F.lit(min(gap or LONGEST_TIME * 1_000_000, LONGEST_TIME * 1_000_000))
        waits = F.concat(F.sequence("timer", "last_at", step), F.array("last_at"))
        runs = F.col("timer") != UNSET
        begun = begun.select(
            *SERIES,
            F.when(runs, F.col("band")).otherwise(0).alias("band"),
            F.explode(F.when(runs, waits).otherwise(F.array("last_at"))).alias("last_at"),
        )
    started = behind(
        begun, banded, F.col("last_at"),
        concentration=F.lit(0.0), band=F.col("band"), allowed=F.lit(2.0 * LONGEST_TIME),
    )
    return ordered_blocks(started, ["concentration", "band", "allowed", "seed"], blocks)


def fuzzy_alerts(
    readings: DataFrame,
    thresholds: Thresholds,
    max_time: float = 14400,
    delta: float = 10,
    max_gap: float | None = None,
    watermark: str = "24 hours",
    strict_order: bool = False,
    blocks: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Fixed-limit and dwell alerts, for a batch table or a stream.

    A reading in the red band can give two alerts: the fixed orange one and
    the dwell one. A stream goes on from the timers that the table ``history`` ends
    with, if one is given.
    """
    if readings.isStreaming:
        from fieldwatch.streaming.detectors import stream_fuzzy_alerts

        return stream_fuzzy_alerts(
            readings, thresholds, max_time, delta, max_gap, watermark, strict_order, history
        )
    if history is not None:
        raise ValueError("history is handed to streams; unite tables instead")
    return fuzzy_step(readings, thresholds, max_time, delta, max_gap, blocks)[0]
