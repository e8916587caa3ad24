"""Every registered query against its SQL on the same tables."""

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from fieldwatch.plans.oracle import ORACLE
from fieldwatch.plans.queries import QUERIES

SLOW = {"forecast_model_fit", "forecast_score"}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return str(value)
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    return float(value)


@pytest.fixture(scope="session")
def sql(small_tables):
    connection = duckdb.connect()
    for path in Path(small_tables).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_but_the_fitted_ones_has_sql():
    assert set(QUERIES) - set(ORACLE) == SLOW


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sql, small_tables, name):
    ours = QUERIES[name](spark, small_tables)
    columns = sorted(ours.columns)
    theirs = sql.execute(ORACLE[name])
    names = [part[0] for part in theirs.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = sorted(
        (tuple(plain(row[i]) for i in order) for row in theirs.fetchall()), key=repr
    )
    found = sorted(
        (tuple(plain(row[column]) for column in columns) for row in ours.collect()), key=repr
    )
    assert found == expected


def test_entry_gives_alerts(spark, small_tables):
    assert entry_points.entry(spark).count() > 0
