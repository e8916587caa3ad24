"""Column expressions shared by batch, streaming, training and scoring."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity class ids and their names in the forecast output.
CLASS_NAMES = {0: "green_yellow", 1: "orange", 2: "red"}
# Forecast horizon name -> rows ahead in the series.
HORIZONS = {"15min": 1, "1hr": 4, "3hr": 12}
# The times that the horizons are named by, in seconds.
HORIZON_SECONDS = {"15min": 900, "1hr": 3600, "3hr": 10_800}


def is_measured(concentration: Column) -> Column:
    """True where the concentration is a finite number."""
    return concentration.isNotNull() & (F.abs(concentration) < F.lit(float("inf")))


def severity(concentration: Column, orange_min: Column, red_min: Column) -> Column:
    """Class id 0, 1 or 2. Null limits (an unknown pollutant) give 0."""
    return (
        F.when(concentration >= red_min, F.lit(2))
        .when(concentration >= orange_min, F.lit(1))
        .otherwise(F.lit(0))
    )


def alert_name(class_id: Column) -> Column:
    """Class id as the alert word: clean, orange or red."""
    return F.when(class_id == 2, "red").when(class_id == 1, "orange").otherwise("clean")


def class_name(class_id: Column) -> Column:
    """Class id as the forecast word; a missing class counts as green_yellow."""
    return (
        F.when(class_id == 2, CLASS_NAMES[2])
        .when(class_id == 1, CLASS_NAMES[1])
        .otherwise(CLASS_NAMES[0])
    )


def features(concentration: Column, event_time: Column) -> list[Column]:
    """Model features: scaled concentration, hour 0-23, weekday Monday=0."""
    return [
        (concentration / F.lit(1000.0)).alias("concentration_norm"),
        F.hour(event_time).alias("hour"),
        F.weekday(event_time).alias("day_of_week"),
    ]
