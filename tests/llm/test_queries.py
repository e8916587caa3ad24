"""Every query with SQL against it, on the same tables; the others give all their rows."""

from pathlib import Path

import duckdb
import pytest

from fieldwatch.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def sql(small_tables):
    connection = duckdb.connect()
    for path in Path(small_tables).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_its_sql(spark, sql, small_tables, name):
    ours = QUERIES[name](spark, small_tables)
    theirs = sql.execute(ORACLE[name])
    names = [part[0] for part in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    expected = sorted(theirs.fetchall(), key=repr)
    assert sorted((tuple(row[n] for n in names) for row in ours.collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op5_decontaminate"}))
def test_gives_a_row_for_every_row(spark, small_tables, name):
    source = "pages" if name == "op9_html_text" else "documents"
    rows = spark.read.parquet(f"{small_tables}/{source}.parquet").count()
    assert QUERIES[name](spark, small_tables).count() == rows
