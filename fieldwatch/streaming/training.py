"""Training history kept up to date: every reading is labelled once.

A reading's targets are known when the twelfth one after it has come. Batches of readings
come in order of time; each is put behind the few last readings of every series that
still wait for targets, and what is complete then is

- written to the labelled rows, by day, and
- counted in a table of classes by day, hour, weekday and concentration.

So the window of the last days moves over counts that are there already: whole days are
sums of counts, and only the day in which the window begins, and the readings that still
wait, are looked at row by row. Concentrations are counted on a fine grid, on which the
edges of bins lie; the quantiles that edges follow come from the same counts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.columns import HORIZONS, features
from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.blocks import tie_columns, usable
from fieldwatch.operators.forecast import (
    BINS,
    CELL,
    CLASSES,
    ForecastModel,
    class_counts,
    count_name,
    fit_cells,
    with_cell,
)
from fieldwatch.operators.history import TARGETS, WINDOW_DAYS, lead_targets
from fieldwatch.operators.thresholding import classify_readings
from fieldwatch.session import materialise
from fieldwatch.sources.thresholds import Thresholds
from fieldwatch.streaming.snapshots import BATCH_ID, DAY, TableFolder, read_parts, write_version

WRITER = "history"
#: Concentrations are counted in steps of one unit up to this one.
MOST_STEPS = 5000
COUNTS = [count_name(name, class_id) for name in HORIZONS for class_id in CLASSES]
COUNTED = [DAY, "step", "hour", "day_of_week"]


def grid_step(concentration: Column) -> Column:
    """The whole units of a concentration, from 0 to ``MOST_STEPS``."""
    return F.least(F.greatest(F.floor(concentration), F.lit(0)), F.lit(MOST_STEPS)).cast("int")


def summed(rows: DataFrame, keys: list[str], *others: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in COUNTS), *others)


def fold_counts(rows: DataFrame) -> DataFrame:
    """Parts of the counts as one: counts add up."""
    return summed(rows, [*COUNTED, "at"], F.max(BATCH_ID).alias(BATCH_ID))


def as_they_are(rows: DataFrame) -> DataFrame:
    """Parts of the labelled rows as one: each row stands in one of them."""
    return rows


class TrainingHistory:
    """Labelled readings and their counts below a folder."""

    def __init__(self, spark: SparkSession, path: str, thresholds: Thresholds):
        self.spark, self.thresholds = spark, thresholds
        self.labelled, self.counts, self.waiting = (f"{path}/{name}" for name in ("labelled", "counts", "waiting"))

    def seen(self) -> int | None:
        """The last batch that is in; None before the first."""
        return TableFolder(self.spark, self.counts).snapshot().batches.get(WRITER)

    def _waiting(self, batch: int | None) -> DataFrame | None:
        return None if batch is None else self.spark.read.parquet(f"{self.waiting}/batch={batch}")

    def _labelled(self, rows: DataFrame) -> DataFrame:
        """Readings with features and targets."""
        led = lead_targets(classify_readings(rows, self.thresholds))
        return led.withColumns(
            {name: made for name, made in zip(
                ("concentration_norm", "hour", "day_of_week"), features(F.col("concentration"), F.col("event_time")), strict=True
            )}
        )

    def add(self, readings: DataFrame, batch: int) -> None:
        """Take in a batch; one that is in already is left alone.

        Batches are numbered upwards, and their readings come in order of time. One that
        comes late is placed among the readings of its series that still wait and changes
        no target that was given. The counts are written last, and what they do not know
        of yet is written anew after a crash.
        """
        before = self.seen()
        if before is not None and batch <= before:
            return
        rows = usable(readings).select(*SERIES, "event_time", *tie_columns(readings), "concentration")
        waiting = self._waiting(before)
        led = materialise(self._labelled(rows if waiting is None else waiting.unionByName(rows)))
        # The farthest target is there for all but the last readings of a series.
        complete = F.col(TARGETS["3hr"]).isNotNull()
        led.filter(~complete).select(rows.columns).write.mode("overwrite").parquet(f"{self.waiting}/batch={batch}")
        done = led.filter(complete)
        write_version(done, self.labelled, "event_time", batch, as_they_are, (WRITER, batch))
        counted = (
            done.withColumns({"at": F.to_date("event_time"), "step": grid_step(F.col("concentration"))})
            .groupBy("at", *COUNTED[1:])
            .agg(
                *(
                    F.count_if(F.col(TARGETS[name]) == class_id).alias(count_name(name, class_id))
                    for name in HORIZONS
                    for class_id in CLASSES
                )
            )
        )
        write_version(counted, self.counts, "at", batch, fold_counts, (WRITER, batch))

    def _window(self, days: int) -> tuple[DataFrame, DataFrame] | None:
        """Counts of the window's whole days, and its other rows; None without readings."""
        batch = self.seen()
        waiting = self._waiting(batch)
        newest = None if waiting is None else waiting.agg(F.max("event_time")).head()[0]
        if newest is None:
            return None
        begins = waiting.agg((F.max("event_time") - F.make_dt_interval(F.lit(days))).alias("begins"))
        since, first_day = begins.select("begins", F.to_date("begins").cast("string")).head()
        counts = TableFolder(self.spark, self.counts).snapshot()
        later = {day for day in counts.days_after(None) if day > first_day}
        whole = read_parts(self.spark, self.counts, counts, later)
        labelled = TableFolder(self.spark, self.labelled).snapshot()
        first = read_parts(self.spark, self.labelled, labelled, {first_day}).filter(F.col(BATCH_ID) <= batch)
        last = self._labelled(waiting)
        rows = first.select(last.columns).unionByName(last) if labelled.parts else last
        return whole, rows.filter(F.col("event_time") >= F.lit(since))

    def cells(self, edges: list[float], days: int = WINDOW_DAYS) -> DataFrame:
        """Class counts per cell of the last ``days`` days, for edges on the grid.

        Edges are scaled concentrations, as ``class_counts`` takes them.
        """
        if any(abs(edge * 1000 - round(edge * 1000)) > 1e-6 or not 0 < edge * 1000 <= MOST_STEPS for edge in edges):
            raise ValueError(f"edges have to be whole units of concentration from 1 to {MOST_STEPS}")
        window = self._window(days)
        if window is None:
            return self.spark.createDataFrame([], "bin int, hour int, day_of_week int, " + ", ".join(f"{n} double" for n in COUNTS))
        whole, rows = window
        on_grid = with_cell(whole.withColumn("concentration_norm", F.col("step") / F.lit(1000.0)), edges)
        counted = on_grid.select(*CELL, *(F.col(name).cast("double").alias(name) for name in COUNTS))
        return summed(counted.unionByName(class_counts(rows, edges)), CELL)

    def edges(self, bins: int = BINS, days: int = WINDOW_DAYS) -> list[float]:
        """Quantile edges on the grid: at most ``bins - 1`` numbers."""
        window = self._window(days)
        if window is None:
            return []
        whole, rows = window
        # Every row of whole days has its nearest target, so these counts are those of rows.
        nearest = [F.col(count_name("15min", class_id)) for class_id in CLASSES]
        steps = whole.select("step", sum(nearest[1:], nearest[0]).alias("rows")).unionByName(
            rows.select(grid_step(F.col("concentration")).alias("step"), F.lit(1).cast("long").alias("rows"))
        )
        # At most one row for each step.
        found = steps.groupBy("step").agg(F.sum("rows").alias("rows")).orderBy("step").collect()
        total, passed, cuts = sum(row["rows"] for row in found), 0, set()
        for row in found:
            below = passed * bins // max(1, total)
            passed += row["rows"]
            if passed * bins // total > below and 0 < row["step"]:
                cuts.add(row["step"] / 1000.0)
        return sorted(cuts)[: bins - 1]

    def fit(self, days: int = WINDOW_DAYS, bins: int = BINS, **settings) -> ForecastModel:
        """A forecaster of the window, fitted on its counts; no reading of a whole day is read again."""
        edges = self.edges(bins, days)
        return fit_cells(self.cells(edges, days), edges, bins=bins, **settings)
