"""Ordered work over series of any length.

One series may hold a large share of all rows, so no operator here gathers a
series into one task. Readings are range-partitioned by (series, time, tie):
Spark samples the rows and cuts the order into even blocks, through the middle
of a long series where needed. The ordered blocks are written once; then

1. ``summarise`` turns every block into one row, from the few rows that matter
   to the block's neighbours (Spark filters them out beforehand),
2. summaries go up a tree: ``merge`` makes one of ``FAN_OUT`` neighbouring ones. On
   the way down ``fold`` finds what each is told by the one before it, so no task
   sees more than one group of summaries at a time,
3. an operator reads the blocks in order, batch by batch, with that value (one row
   per block at most, so it is small enough to broadcast).
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.columns import is_measured
from fieldwatch.functions.schemas import SERIES
from fieldwatch.session import materialise

TIE_BREAKS = ("event_id", "sensor_id")
#: Blocks, or groups of them, under one node of the tree of summaries.
FAN_OUT = 64
#: A row for each block goes to every task, so there are no more blocks than this.
MOST_BLOCKS = 200_000
Batches = Iterable[pa.RecordBatch]
Step = Callable[[Batches], Iterator[pa.RecordBatch]]


def usable(readings: DataFrame) -> DataFrame:
    """Readings that belong to a series and carry a time and a number."""
    present = [F.col(name).isNotNull() for name in (*SERIES, "event_time")]
    keep = is_measured(F.col("concentration"))
    for condition in present:
        keep = keep & condition
    return readings.filter(keep)


def tie_columns(readings: DataFrame) -> list[str]:
    """Columns that order readings of one series at the same time."""
    return [name for name in TIE_BREAKS if name in readings.columns]


def ordered_blocks(
    readings: DataFrame, payload: list[str], blocks: int | None = None
) -> DataFrame:
    """Readings in even, ordered blocks, written to the checkpoint folder.

    ``at`` is the event time in microseconds, ``block`` the number of the block
    and ``pos`` the row's place in it. Without ``blocks`` the session's shuffle
    partitions apply and AQE merges small ones; there are ``MOST_BLOCKS`` at most. The
    written rows keep each row's block fixed, also when an executor is lost later.
    """
    asked = blocks or int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if asked > MOST_BLOCKS:
        blocks = MOST_BLOCKS
    ties = tie_columns(readings)
    thin = usable(readings).select(
        *SERIES, F.unix_micros("event_time").alias("at"), *ties, *payload
    )
    begun = [F.desc("seed")] if "seed" in payload else []
    order = [*SERIES, "at", *begun, *ties, "concentration"]
    # Equal rows are interchangeable; their input task lets many copies be cut too.
    ranged = thin.withColumn("origin", F.spark_partition_id()).repartitionByRange(
        *([blocks] if blocks else []), *order, "origin"
    )
    in_order = ranged.sortWithinPartitions(*order).drop("origin")
    # Fixed layout of this function: the task above, the row in it in the low 33 bits.
    numbered = in_order.withColumn("place", F.monotonically_increasing_id())
    return materialise(
        numbered.withColumn("block", F.shiftright("place", 33).cast("int"))
        .withColumn("pos", F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("place")
    )


def behind(begun: DataFrame | None, readings: DataFrame, at: Column, **values: Column) -> DataFrame:
    """Readings behind rows that bring their series to a state that they begin with.

    ``begun`` holds a row per series; ``at`` is the time that its row stands for and
    ``values`` are the columns that the operator reads. Such rows carry ``seed`` and come
    first of all at their time.
    """
    if begun is None:
        return readings.withColumn("seed", F.lit(False))
    types = dict(readings.dtypes)
    columns = {name: F.lit(None).cast(kind) for name, kind in types.items() if name not in SERIES}
    columns |= {"event_time": F.timestamp_micros(at)}
    columns |= {name: value.cast(types[name]) for name, value in values.items()}
    seeds = begun.select(*SERIES, *(value.alias(name) for name, value in columns.items()), F.lit(True).alias("seed"))
    return readings.withColumn("seed", F.lit(False)).unionByName(seeds)


def with_neighbours(
    blocks: DataFrame,
    columns: list[str],
    telling: Column,
    summarise: Step,
    summary_schema: str,
    merge: Step,
    fold: Step,
    carry_type: str,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Blocks with what the one before them passes on, as ``carry`` in their first row.

    ``summarise`` sees the first and last row of each block and those for which
    ``telling`` holds, an expression that may use ``row_count``. A summary may take
    several rows, in the order of their ``part``.
    """
    sizes = blocks.groupBy("block").agg((F.max("pos") + 1).alias("row_count"))
    edge = (F.col("pos") == 0) | (F.col("pos") == F.col("row_count") - 1)
    told = blocks.join(F.broadcast(sizes), "block").filter(edge | telling)
    summaries = told.select("block", "pos", "row_count", *SERIES, "at", *columns).mapInArrow(
        summarise, summary_schema
    )
    return with_carries(blocks, summaries, merge, summary_schema, fold, carry_type, fan_out)


def with_carries(
    blocks: DataFrame,
    summaries: DataFrame,
    merge: Step,
    summary_schema: str,
    fold: Step,
    carry_type: str,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Blocks with the carry that their summaries make, in the first row of each."""
    # Blocks are numbered by task, so there are no more than tasks.
    most = blocks.rdd.getNumPartitions()
    carries = carried_down(summaries, most, merge, summary_schema, fold, carry_type, fan_out)
    carried = blocks.join(F.broadcast(carries), "block", "left")
    return carried.withColumn("carry", F.when(F.col("pos") == 0, F.col("carry")))


def carried_down(
    summaries: DataFrame,
    most: int,
    merge: Step,
    summary_schema: str,
    fold: Step,
    carry_type: str,
    fan_out: int,
) -> DataFrame:
    """``block`` and ``carry``, from summaries of blocks with numbers below ``most``."""
    if fan_out < 2:
        raise ValueError("fan_out must be 2 or more")

    def grouped(units: DataFrame) -> DataFrame:
        return units.withColumn("group", F.floor(F.col("block") / fan_out).cast("int"))

    def in_order(units: DataFrame) -> DataFrame:
        return units.repartition("group").sortWithinPartitions("group", "block", "part")

    levels = [summaries]
    while most > fan_out:
        levels[-1] = materialise(levels[-1])
        levels.append(in_order(grouped(levels[-1])).mapInArrow(merge, summary_schema))
        most = -(-most // fan_out)
    top = grouped(levels.pop()).withColumn("carry", F.lit(None).cast(carry_type))
    carries = in_order(top).mapInArrow(fold, f"block int, carry {carry_type}")
    while levels:
        # One row per group of the level below.
        told = F.broadcast(carries.withColumnRenamed("block", "group"))
        level = grouped(levels.pop()).join(told, "group", "left")
        carries = in_order(level).mapInArrow(fold, f"block int, carry {carry_type}")
    return carries


@dataclass(frozen=True)
class Place:
    """Where a row stands: its series and time."""

    site_id: str
    pollutant_type: str
    at: int
    pos: int | None = None

    @staticmethod
    def of(batch: pa.RecordBatch, row: int) -> "Place":
        known = [name for name in ("at", "pos") if name in batch.schema.names]
        return Place(
            batch.column("site_id")[row].as_py(),
            batch.column("pollutant_type")[row].as_py(),
            *(batch.column(name)[row].as_py() for name in known),
        )

    def continues(self, earlier: "Place | None", gap: int | None) -> bool:
        """True when this row goes on with the series of ``earlier``."""
        if earlier is None:
            return False
        if (self.site_id, self.pollutant_type) != (earlier.site_id, earlier.pollutant_type):
            return False
        return gap is None or self.at - earlier.at <= gap


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def series_starts(batch: pa.RecordBatch, before: Place | None, gap: int | None) -> np.ndarray:
    """Flag the rows of a batch that begin a series or follow a long gap.

    Where rows carry their ``pos``, one whose neighbour was left out counts too.
    """
    starts = np.empty(batch.num_rows, dtype=bool)
    first = Place.of(batch, 0)
    starts[0] = not first.continues(before, gap)
    if before is not None and first.pos is not None:
        starts[0] |= first.pos != before.pos + 1
    changed = np.zeros(batch.num_rows - 1, dtype=bool)
    for name in SERIES:
        column = batch.column(name)
        differs = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
        changed |= differs.to_numpy(zero_copy_only=False)
    if gap is not None:
        changed |= np.diff(numbers(batch, "at")) > gap
    if first.pos is not None:
        changed |= np.diff(numbers(batch, "pos")) != 1
    starts[1:] = changed
    return starts


def filled(batches: Batches) -> Iterator[pa.RecordBatch]:
    return (batch for batch in batches if batch.num_rows)


def one_row(**values) -> pa.RecordBatch:
    """A single-row batch; each value is a (python value, arrow type) pair."""
    return pa.RecordBatch.from_arrays(
        [pa.array([value], kind) for value, kind in values.values()], names=list(values)
    )


def seconds_to_micros(seconds: float | None) -> int | None:
    return None if seconds is None else int(seconds * 1_000_000)
