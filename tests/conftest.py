import os
import sys
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from fieldwatch.session import ROCKSDB  # noqa: E402

DATA = Path(os.environ.get("FIELDWATCH_TESTDATA", "/root/testdata"))
START = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fieldwatch-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_tables():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test tables are not here")
    return str(folder)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


SCHEMA = "site_id string, pollutant_type string, event_time timestamp, event_id bigint, concentration double"


def make_readings(spark, rows, pollutant="PM10", site="SITE_01"):
    """Readings of one series from (seconds, concentration) pairs."""
    return spark.createDataFrame(
        [(site, pollutant, at(sec), i, float(x)) for i, (sec, x) in enumerate(rows)], SCHEMA
    )


def alert_rows(df):
    """Alerts as sorted (site, pollutant, seconds, value, metric, name, category)."""
    return sorted(
        (
            row["site_id"],
            row["pollutant_type"],
            round((row["event_time"].replace(tzinfo=UTC) - START).total_seconds(), 6),
            row["concentration"],
            round(row["metric_value"], 6),
            row["metric_name"],
            row["alert_category"],
        )
        for row in df.collect()
    )
