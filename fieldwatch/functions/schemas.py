"""Fixed schemas of the messages and tables. Nothing is inferred."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

SERIES = ["site_id", "pollutant_type"]

# The wire format of a reading.
READING_WIRE = StructType(
    [
        StructField("sensor_id", StringType(), False),
        StructField("site_id", StringType(), False),
        StructField("timestamp", StringType(), False),
        StructField("pollutant_type", StringType(), False),
        StructField("concentration", DoubleType(), False),
        StructField("unit", StringType(), True),
    ]
)

# Columns of forecasts.
FORECAST = StructType(
    [
        StructField("site_id", StringType(), False),
        StructField("event_time", TimestampType(), False),
        StructField("pollutant_type", StringType(), False),
        StructField("timescale", StringType(), False),
        StructField("predicted_category", StringType(), False),
    ]
)

# Columns of the hourly table.
HOURLY = StructType(
    [
        StructField("site_id", StringType(), False),
        StructField("pollutant_type", StringType(), False),
        StructField("start_time", TimestampType(), False),
        StructField("avg_value", DoubleType(), True),
    ]
)
HOURLY_KEY = ["site_id", "pollutant_type", "start_time"]

DAILY_KEY = ["site_id", "pollutant_type", "log_date"]
