"""Targets by time: the severity of the first reading at or after a time ahead.

Readings lie in even, ordered blocks that cut through series (``operators/blocks.py``).
A block answers what it can from its own rows. What lies beyond its last series' end in
it is found from a table of the parts that cut series leave in blocks, one row per part:

- a time in the gap before a part is answered by that part's first reading,
- a time inside a part goes, as a request, to the block that holds the part. It meets
  there only the rows within the longest wait of the part before, its halo in time.

A request goes to one block however many blocks its wait spans, and no request leaves a
block when the wait ends inside it. A block that is asked very often is answered in
several tasks, each with the block's halo.
"""

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.blocks import filled, numbers, ordered_blocks, series_starts, tie_columns
from fieldwatch.session import materialise

#: Requests that one task answers.
REQUESTS = 1 << 20
ROWS_AT_ONCE = 1 << 14


class Parts:
    """The parts that blocks hold of each series which more than one block holds."""

    def __init__(self, table: pa.Table):
        found: dict[tuple[str, str], list[int]] = {}
        names = zip(*(table.column(name).to_pylist() for name in SERIES), strict=True)
        for row, series in enumerate(names):
            found.setdefault(series, []).append(row)
        columns = {name: table.column(name).to_numpy() for name in ("block", "first_at", "last_at", "first_severity")}
        self.of = {
            series: {name: column[rows] for name, column in columns.items()} for series, rows in found.items()
        }

    def after(self, series: tuple[str, str], block: int) -> dict[str, np.ndarray] | None:
        """Parts of a series in later blocks, None if there are none."""
        parts = self.of.get(series)
        if parts is None:
            return None
        later = parts["block"] > block
        return {name: column[later] for name, column in parts.items()} if later.any() else None

    def end_before(self, series: tuple[str, str], block: int) -> int | None:
        """The last time of a series before a block."""
        parts = self.of.get(series)
        if parts is None or not (parts["block"] < block).any():
            return None
        return int(parts["last_at"][parts["block"] < block].max())


def cut_series(ordered: DataFrame) -> Parts:
    """Parts of series that several blocks hold: at most two rows for each block, sent to every task."""
    parts = ordered.groupBy(*SERIES, "block").agg(
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.min_by("severity", "pos").alias("first_severity"),
    )
    held = F.count("*").over(Window.partitionBy(*SERIES))
    cut = parts.withColumn("held", held).filter("held > 1").drop("held")
    return Parts(cut.orderBy("block").toArrow())


def _look_ahead(parts: Parts, waits: list[int], columns: list[str]):
    """Rows of a block with their answers, or the block where an answer lies."""

    def run(batches):
        rows = pa.Table.from_batches(held) if (held := list(filled(batches))) else None
        if rows is None:
            return
        whole = rows.combine_chunks().to_batches()[0]
        at, severity = numbers(whole, "at"), numbers(whole, "severity").astype(np.int32)
        block, size = whole.column("block")[0].as_py(), whole.num_rows
        edges = [*np.flatnonzero(series_starts(whole, None, None)).tolist(), size]

        def series(row: int) -> tuple[str, str]:
            return tuple(whole.column(name)[row].as_py() for name in SERIES)

        answers = np.full((len(waits), size), -1, dtype=np.int32)
        asked = np.full((len(waits), size), -1, dtype=np.int32)
        later = parts.after(series(size - 1), block)
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            for i, wait in enumerate(waits):
                place = np.searchsorted(at[low:high], at[low:high] + wait) + low
                inside = place < high
                answers[i, low:high][inside] = severity[place[inside]]
                if high < size or later is None or inside.all():
                    continue
                outside = np.flatnonzero(~inside) + low
                wanted = at[outside] + wait
                part = np.searchsorted(later["last_at"], wanted)
                known = part < len(later["last_at"])
                outside, wanted, part = outside[known], wanted[known], part[known]
                in_gap = wanted <= later["first_at"][part]
                answers[i, outside[in_gap]] = later["first_severity"][part[in_gap]]
                asked[i, outside[~in_gap]] = later["block"][part[~in_gap]]
        before = parts.end_before(series(0), block)
        halo = np.zeros(size, dtype=bool)
        if before is not None:
            halo[: np.searchsorted(at[: edges[1]], before + max(waits)) + 1] = True
            halo[edges[1] :] = False

        def nullable(values: np.ndarray) -> pa.Array:
            return pa.array(values, pa.int32(), mask=values < 0)

        out = pa.RecordBatch.from_arrays(
            [
                *(whole.column(name) for name in columns),
                pa.array(halo),
                *map(nullable, answers),
                *map(nullable, asked),
            ],
            [*columns, "halo", *(f"answer_{i}" for i in range(len(waits))), *(f"asks_{i}" for i in range(len(waits)))],
        )
        for start in range(0, size, ROWS_AT_ONCE):
            yield out.slice(start, ROWS_AT_ONCE)

    return run


def _reply(batches):
    """Severity of the next reading for each request, from rows of a task in falling time."""
    now, severity = None, -1
    for batch in filled(batches):
        keys = list(zip(*(numbers(batch, name).tolist() for name in ("block", "salt")), strict=True))
        severities, is_request = numbers(batch, "severity").tolist(), numbers(batch, "request").astype(bool)
        given = np.empty(batch.num_rows, dtype=np.int32)
        for row, key in enumerate(keys):
            if key != now:
                now, severity = key, -1
            if not is_request[row]:
                severity = severities[row]
            given[row] = severity
        found = np.flatnonzero(is_request)
        kept = batch.take(pa.array(found))
        yield pa.RecordBatch.from_arrays(
            [kept.column("origin"), kept.column("row"), kept.column("wait"), pa.array(given[found])],
            ["origin", "row", "wait", "given"],
        )


def first_at_or_after(
    classified: DataFrame, waits: Mapping[str, int], blocks: int | None = None, requests: int = REQUESTS
) -> DataFrame:
    """Readings with the severity of their series' first reading at or after each wait.

    ``waits`` maps the names of the new columns to seconds. Null where the series has no
    reading that late. Of readings at the same time the first in order counts (by tie
    columns, then concentration).
    """
    micros = [int(wait * 1_000_000) for wait in waits.values()]
    if not micros or min(micros) <= 0:
        raise ValueError("waits must be longer than zero")
    if classified.isEmpty():
        # No rows, no blocks to look into.
        return classified.select("*", *(F.lit(None).cast("int").alias(name) for name in waits))
    ordered = ordered_blocks(classified, ["concentration", "severity"], blocks)
    columns = [*SERIES, "at", *tie_columns(classified), "concentration", "severity", "block", "pos"]
    types = dict(ordered.dtypes)
    fields = [f"{name} {types[name]}" for name in columns] + ["halo boolean"]
    fields += [f"{kind}_{i} int" for kind in ("answer", "asks") for i in range(len(micros))]
    looked = ordered.select(*columns).mapInArrow(
        _look_ahead(cut_series(ordered), micros, columns), ", ".join(fields)
    )
    answered = materialise(looked)
    is_open = F.coalesce(*(F.col(f"asks_{i}") for i in range(len(micros)))).isNotNull()
    wanted = F.array(
        *(
            F.struct(F.col(f"asks_{i}").alias("block"), (F.col("at") + wait).alias("at"), F.lit(i).alias("wait"))
            for i, wait in enumerate(micros)
        )
    )
    asked = (
        answered.filter(is_open)
        .select(F.col("block").alias("origin"), F.col("pos").alias("row"), F.explode(wanted).alias("to"))
        .select("origin", "row", "to.*")
        .filter("block IS NOT NULL")
    )
    # One row for each block that is asked.
    loads = F.broadcast(
        asked.groupBy("block").agg(F.ceil(F.count("*") / F.lit(requests)).cast("int").alias("tasks"))
    )
    salt = F.pmod(F.xxhash64("origin", "row", "wait"), F.col("tasks")).cast("int")
    none = F.lit(None)
    requested = asked.join(loads, "block").select(
        "block", salt.alias("salt"), "at", F.lit(True).alias("request"), F.lit(0).cast("long").alias("pos"),
        none.cast("int").alias("severity"), "origin", "row", "wait",
    )
    halos = answered.filter("halo").join(loads, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"), "at", F.lit(False).alias("request"),
        "pos", "severity", none.cast("int").alias("origin"), none.cast("long").alias("row"), none.cast("int").alias("wait"),
    )
    replies = (
        requested.unionByName(halos)
        .withColumn("severity", F.coalesce("severity", F.lit(-1)))
        .repartition("block", "salt")
        .sortWithinPartitions("block", "salt", F.desc("at"), "request", F.desc("pos"))
        .mapInArrow(_reply, "origin int, row long, wait int, given int")
    )
    given = replies.groupBy(F.col("origin").alias("block"), F.col("row").alias("pos")).agg(
        *(F.max(F.when(F.col("wait") == i, F.col("given"))).alias(f"given_{i}") for i in range(len(micros)))
    )
    known = [F.col(f"answer_{i}").alias(name) for i, name in enumerate(waits)]
    joined = [F.coalesce(f"answer_{i}", f"given_{i}").alias(name) for i, name in enumerate(waits)]
    kept = [*SERIES, F.timestamp_micros("at").alias("event_time"), *columns[3:-2]]
    closed = answered.filter(~is_open).select(*kept, *known)
    return closed.unionByName(answered.filter(is_open).join(given, ["block", "pos"]).select(*kept, *joined))
