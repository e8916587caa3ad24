"""Hourly and daily means, the bounded serving view and the latest readings."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import DAILY_KEY, HOURLY_KEY, SERIES
from fieldwatch.operators.blocks import usable


def hourly_avg(readings: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Mean concentration per hour, site and pollutant.

    Partial means are built before the shuffle, so a busy series sends one row
    per hour and input task. A stream drops hours older than the watermark.
    """
    if readings.isStreaming:
        readings = readings.withWatermark("event_time", watermark)
    return (
        readings.groupBy(F.window("event_time", "1 hour").alias("hour"), *SERIES)
        .agg(F.avg("concentration").alias("avg_value"))
        .select(*SERIES, F.col("hour.start").alias("start_time"), "avg_value")
    )


def daily_rollup(hourly: DataFrame) -> DataFrame:
    """Unweighted mean of the hourly means per site, pollutant and day."""
    return hourly.groupBy(*SERIES, F.to_date("start_time").alias("log_date")).agg(
        F.avg("avg_value").alias("daily_avg")
    )


def hourly_sums(readings: DataFrame) -> DataFrame:
    """Sum and number of measured readings per hour, site and pollutant.

    Such rows add up: those of two batches are those of both together.
    """
    measured = usable(readings)
    return (
        measured.groupBy(F.window("event_time", "1 hour").alias("hour"), *SERIES)
        .agg(F.sum("concentration").alias("total"), F.count("*").alias("readings"))
        .select(*SERIES, F.col("hour.start").alias("start_time"), "total", "readings")
    )


def daily_sums(hours: DataFrame) -> DataFrame:
    """Sums of hours per day."""
    return added_up(hours.withColumn("log_date", F.to_date("start_time")), DAILY_KEY)


def added_up(sums: DataFrame, keys: list[str], *others: Column) -> DataFrame:
    """One row for each key."""
    return sums.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("readings").alias("readings"), *others)


def weighted_mean(sums: DataFrame, name: str) -> DataFrame:
    """The mean of all readings, with their number beside it."""
    return sums.withColumn(name, F.col("total") / F.col("readings")).drop("total")


def daily_weighted(readings: DataFrame) -> DataFrame:
    """Mean of a day's readings per site and pollutant: hours weigh by their readings."""
    return weighted_mean(daily_sums(hourly_sums(readings)), "daily_avg")


def stamp_daily(daily: DataFrame) -> DataFrame:
    """Daily rows with the time they were computed, as the daily table holds them."""
    return daily.withColumn("last_updated_at", F.current_timestamp())


def hourly_retained(hourly: DataFrame, keep: int = 25) -> DataFrame:
    """The newest ``keep`` hours of each series.

    Spark limits each input task to ``keep`` rows per series before the shuffle.
    """
    newest = Window.partitionBy(*SERIES).orderBy(F.col("start_time").desc())
    return (
        hourly.withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= keep)
        .select(*HOURLY_KEY, "avg_value")
    )


def latest_readings(readings: DataFrame, site_id: str, keep: int = 50, tie: str | None = None) -> DataFrame:
    """The last ``keep`` readings of each pollutant at one site."""
    order = [F.col("event_time").desc()] + ([F.col(tie).desc()] if tie else [])
    newest = Window.partitionBy("pollutant_type").orderBy(*order)
    return (
        readings.filter(F.col("site_id") == site_id)
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= keep)
        .drop("rank")
    )
