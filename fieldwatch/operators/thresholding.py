"""Stateless severity rules: narrow filters with no shuffle and no Python."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.columns import alert_name, is_measured, severity
from fieldwatch.sources.thresholds import Thresholds


def classify_readings(readings: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Add ``severity`` (0, 1, 2) and ``alert_category`` to every reading.

    The orange upper edge plays no part here, and a pollutant without limits
    is clean.
    """
    joined = thresholds.join(readings, ["orange_min", "red_min"], "left")
    class_id = severity(F.col("concentration"), F.col("orange_min"), F.col("red_min"))
    return (
        joined.withColumn("severity", F.when(is_measured(F.col("concentration")), class_id).otherwise(0))
        .withColumn("alert_category", alert_name(F.col("severity")))
        .select(*readings.columns, "severity", "alert_category")
    )


def _breaches(readings: DataFrame, thresholds: Thresholds, floor: str) -> DataFrame:
    """Readings that can breach at all, with their limits beside them.

    The lowest limit is a literal, so the filter reaches the file scan before
    the exact rule runs per pollutant.
    """
    value = F.col("concentration")
    possible = readings.filter((value >= F.lit(thresholds.lowest(floor))) & ~F.isnan(value))
    return thresholds.join(possible, ["orange_min", "orange_max", "red_min"])


def as_hard_alert(readings: DataFrame, category, metric_value="concentration") -> DataFrame:
    """Rows as alerts on a fixed limit."""
    return readings.select(
        "site_id",
        "pollutant_type",
        "event_time",
        "concentration",
        F.col(metric_value).alias("metric_value"),
        F.lit("hard_threshold").alias("metric_name"),
        category.alias("alert_category"),
    )


def internal_alerts(readings: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Orange alerts: orange min inclusive up to orange max exclusive."""
    value = F.col("concentration")
    hits = _breaches(readings, thresholds, "orange_min").filter(
        (value >= F.col("orange_min")) & (value < F.col("orange_max"))
    )
    return as_hard_alert(hits, F.lit("orange"))


def severe_alerts(readings: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Red alerts: red min and anything above it."""
    hits = _breaches(readings, thresholds, "red_min").filter(
        F.col("concentration") >= F.col("red_min")
    )
    return as_hard_alert(hits, F.lit("red"))


def threshold_alerts(readings: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Orange and red alerts in one pass over the readings."""
    value = F.col("concentration")
    category = F.when(value >= F.col("red_min"), "red").when(
        (value >= F.col("orange_min")) & (value < F.col("orange_max")), "orange"
    )
    hits = _breaches(readings, thresholds, "orange_min").withColumn("alert_category", category)
    return as_hard_alert(hits.filter(F.col("alert_category").isNotNull()), F.col("alert_category"))


def open_category(value: Column) -> Column:
    """Red from red min, orange from orange min up to it whatever orange max says, else null."""
    return F.when(value >= F.col("red_min"), "red").when(value >= F.col("orange_min"), "orange")


def breached_limit(value: Column) -> Column:
    """The limit that a reading of an open category breaches."""
    return F.when(value >= F.col("red_min"), F.col("red_min")).otherwise(F.col("orange_min"))


def open_orange_alerts(readings: DataFrame, thresholds: Thresholds, report_limit: bool = False) -> DataFrame:
    """Alerts where orange reaches up to red min, whatever orange max says.

    The concentration itself is reported, or the breached limit.
    """
    value = F.col("concentration")
    hits = (
        _breaches(readings, thresholds, "orange_min")
        .filter(value >= F.col("orange_min"))
        .withColumn("metric_value", breached_limit(value) if report_limit else value)
    )
    return as_hard_alert(hits, open_category(value), "metric_value")
