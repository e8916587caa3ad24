"""Preparing history for the forecaster: coverage, window and targets."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldwatch.functions.columns import HORIZON_SECONDS, HORIZONS, features
from fieldwatch.functions.schemas import SERIES
from fieldwatch.operators.ahead import first_at_or_after
from fieldwatch.operators.blocks import ordered_blocks, tie_columns
from fieldwatch.operators.thresholding import classify_readings
from fieldwatch.sources.thresholds import Thresholds

# Training needs this many days and uses this many.
MIN_DAYS = 5
WINDOW_DAYS = 15
# Target column of each horizon.
TARGETS = {"15min": "target_15m", "1hr": "target_1hr", "3hr": "target_3hr"}
FARTHEST = max(HORIZONS.values())

# Rows of a window; neighbouring windows share the rows that targets reach ahead.
WINDOW_ROWS = 16_384


def training_coverage(readings: DataFrame, min_days: float = MIN_DAYS) -> DataFrame:
    """First and last event time, the span in days and whether it suffices."""
    span = (F.unix_micros("max_time") - F.unix_micros("min_time")) / F.lit(86_400_000_000.0)
    return (
        readings.agg(F.min("event_time").alias("min_time"), F.max("event_time").alias("max_time"))
        .withColumn("span_days", span)
        .withColumn("ready", F.coalesce(F.col("span_days") >= min_days, F.lit(False)))
    )


def training_window(
    readings: DataFrame, days: int = WINDOW_DAYS, newest: int | None = None
) -> DataFrame:
    """Readings of the last ``days`` days before the newest one.

    Where the ``newest`` time (in microseconds) is known already, the filter
    holds a plain value that reaches the file scan; else a subquery finds it.
    """
    if newest is not None:
        cutoff = F.timestamp_micros(F.lit(newest - days * 86_400_000_000))
    else:
        cutoff = readings.agg(
            (F.max("event_time") - F.make_dt_interval(F.lit(days))).alias("cutoff")
        ).scalar()
    return readings.filter(F.col("event_time") >= cutoff)


def forecast_features(readings: DataFrame) -> DataFrame:
    """Readings with the model features beside them."""
    return readings.select("*", *features(F.col("concentration"), F.col("event_time")))


def lead_targets(
    classified: DataFrame,
    blocks: int | None = None,
    window_rows: int = WINDOW_ROWS,
    mode: str = "rows",
) -> DataFrame:
    """Severity 1, 4 and 12 readings ahead in the same series; null at its end.

    In ``mode`` "time" the severity of the first reading 15 minutes, 1 hour and 3 hours
    ahead or later, whatever the readings' distance.

    Rows are numbered through all ordered blocks and cut into windows of even size.
    The first rows of each window also stand at the end of the one before, so a lead
    never leaves its window and no window holds more than a bounded number of rows.
    """
    if mode not in ("rows", "time"):
        raise ValueError(f"unknown mode {mode}; known: rows, time")
    if mode == "time":
        waits = {TARGETS[name]: seconds for name, seconds in HORIZON_SECONDS.items()}
        return first_at_or_after(classified, waits, blocks)
    if window_rows < FARTHEST:
        raise ValueError(f"window_rows must be {FARTHEST} or more")
    ordered = ordered_blocks(classified, ["concentration", "severity"], blocks)
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block.
    offsets = (
        ordered.groupBy("block")
        .agg(F.count("*").alias("rows"))
        .select("block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    )
    number = F.col("offset") + F.col("pos")
    own = F.floor(F.col("number") / window_rows)
    shared = (F.col("number") % window_rows < FARTHEST) & (F.col("own") > 0)
    windows = F.when(shared, F.array("own", F.col("own") - 1)).otherwise(F.array("own"))
    dealt = (
        ordered.join(F.broadcast(offsets), "block")
        .withColumn("number", number)
        .withColumn("own", own)
        .withColumn("window", F.explode(windows))
    )
    ahead = Window.partitionBy("window", *SERIES).orderBy("number")
    targets = [
        F.lead("severity", lead).over(ahead).alias(TARGETS[name]) for name, lead in HORIZONS.items()
    ]
    columns = [*SERIES, *tie_columns(classified), "concentration", "severity"]
    return dealt.select(
        *columns, *targets, F.timestamp_micros("at").alias("event_time"), "window", "own"
    ).filter("window = own").drop("window", "own")


def forecast_training_set(
    readings: DataFrame,
    thresholds: Thresholds,
    days: int = WINDOW_DAYS,
    newest: int | None = None,
    blocks: int | None = None,
    mode: str = "rows",
) -> DataFrame:
    """Features and targets of the readings in the training window."""
    classified = classify_readings(training_window(readings, days, newest), thresholds)
    led = lead_targets(classified, blocks, mode=mode)
    return led.select(
        *SERIES,
        "event_time",
        *tie_columns(readings),
        *features(F.col("concentration"), F.col("event_time")),
        F.col("severity").alias("category"),
        *TARGETS.values(),
    )


def label_balance(training: DataFrame) -> DataFrame:
    """Rows per class and number of distinct classes, for each horizon."""
    counts = training.agg(
        *(
            F.count_if(F.col(target) == class_id).alias(f"{target}_{class_id}")
            for target in TARGETS.values()
            for class_id in range(3)
        )
    )
    rows = [
        F.struct(
            F.lit(name).alias("timescale"),
            *(F.col(f"{target}_{class_id}").alias(f"class_{class_id}") for class_id in range(3)),
        )
        for name, target in TARGETS.items()
    ]
    present = sum((F.col(f"class_{class_id}") > 0).cast("int") for class_id in range(3))
    return counts.select(F.inline(F.array(*rows))).withColumn("classes", present)
