"""Sinks: keyed upserts of rollups and topic-routed alert messages."""

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.schemas import HOURLY_KEY
from fieldwatch.streaming.snapshots import (
    BATCH_ID,
    DAY,
    Fold,
    TableFolder,
    read_parts,
    write_version,
)

# Default topic of each alert category and of forecasts.
TOPICS = {"orange": "alerts_internal", "red": "alerts_severe", "forecast": "alerts_forecasts"}
MICROSECOND_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

BatchWriter = Callable[[DataFrame, int], None]
# Tasks, and so connections, that read one database table.
DATABASE_READERS = 16


# -- messages -----------------------------------------------------------------


def message_value(columns: list[str]) -> Column:
    """The named columns as one JSON text; times keep their microseconds."""
    return F.to_json(F.struct(*columns), MICROSECOND_FORMAT)


def envelope(rows: DataFrame) -> DataFrame:
    """Rows as messages: key is the site, value is the JSON of all columns.

    A ``topic`` column stays beside them and is not part of the value.
    """
    columns = [name for name in rows.columns if name != "topic"]
    kept = ["topic"] if "topic" in rows.columns else []
    return rows.select(
        F.col("site_id").cast("string").alias("key"), message_value(columns).alias("value"), *kept
    )


def topic_of(category: Column, topics: Mapping[str, str]) -> Column:
    return F.when(category == "orange", topics["orange"]).when(category == "red", topics["red"])


def route_alerts(alerts: DataFrame, topics: Mapping[str, str] = TOPICS) -> DataFrame:
    """Add each alert's topic by its category; other categories are left out."""
    routed = alerts.withColumn("topic", topic_of(F.col("alert_category"), topics))
    return routed.filter(F.col("topic").isNotNull())


@dataclass(frozen=True)
class SinkConf:
    """Where messages go: Kafka, or files below ``path`` split by topic."""

    format: str
    path: str | None = None
    bootstrap_servers: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def message_writer(messages: DataFrame, sink: SinkConf, checkpoint: str):
    """A stream writer for messages with a ``topic`` column; call ``start`` on it."""
    writer = (
        messages.writeStream.format(sink.format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**sink.options)
    )
    if sink.format == "kafka":
        return writer.option("kafka.bootstrap.servers", str(sink.bootstrap_servers))
    return writer.option("path", sink.path).partitionBy("topic")


# -- upserts into files -------------------------------------------------------


def latest_rows(versions: DataFrame, keys: list[str], version: str = BATCH_ID) -> DataFrame:
    """One row per key: the one with the highest version."""
    others = [name for name in versions.columns if name not in (*keys, version, DAY)]
    return versions.groupBy(*keys).agg(*(F.max_by(name, version).alias(name) for name in others))


def newest_of(keys: list[str]) -> Fold:
    """Folds parts into the newest row of each key, which keeps its version."""

    def fold(versions: DataFrame) -> DataFrame:
        others = [name for name in versions.columns if name not in (*keys, BATCH_ID, DAY)]
        newest = [F.max_by(name, BATCH_ID).alias(name) for name in others]
        return versions.groupBy(*keys, DAY).agg(*newest, F.max(BATCH_ID).alias(BATCH_ID))

    return fold


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The highest version of the table at a path; None where nothing is written."""
    return TableFolder(spark, path).snapshot().newest


def upsert_files(path: str, keys: list[str] = HOURLY_KEY, versioned: bool = False) -> BatchWriter:
    """A ``foreachBatch`` writer that keeps each batch's rows as a version of their own.

    Executors write the rows, and readers take the newest row of each key; the last key
    is a time. A batch holds a key once, as the update mode of an aggregation gives it.
    A writer counts on from the versions it finds, so batches stay in order when a new
    checkpoint begins at batch 0 again; ``versioned`` ids are taken as they are.
    """
    before: list[int] = [0] if versioned else []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not before:
            newest = newest_version(batch.sparkSession, path)
            before.append(0 if newest is None else newest + 1)
        write_version(batch, path, keys[-1], before[0] + batch_id, newest_of(keys))

    return write


def read_versions(spark: SparkSession, path: str, days: Iterable[str] | None = None) -> DataFrame:
    """All live rows, of some days only if named, with the batch that wrote them."""
    return read_parts(spark, path, TableFolder(spark, path).snapshot(), days)


def read_current(
    spark: SparkSession, keys: list[str], path: str, days: Iterable[str] | None = None
) -> DataFrame:
    """The upserted table as it stands, or some days of it."""
    return latest_rows(read_versions(spark, path, days), keys)


# -- upserts into a database --------------------------------------------------


@dataclass(frozen=True)
class JdbcTarget:
    """A JDBC address with its credentials."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str = "org.postgresql.Driver"

    def properties(self) -> dict[str, str]:
        known = {"user": self.user, "password": self.password, "driver": self.driver}
        return {name: value for name, value in known.items() if value}


def jdbc_target(uri: str) -> JdbcTarget:
    """``postgresql[+driver]://user:password@host:port/db`` as a JDBC target."""
    parts = urlsplit(uri)
    scheme = parts.scheme.split("+")[0]
    port = f":{parts.port}" if parts.port else ""
    return JdbcTarget(
        f"jdbc:{scheme}://{parts.hostname}{port}{parts.path}",
        unquote(parts.username) if parts.username else None,
        unquote(parts.password) if parts.password else None,
    )


def read_table(spark: SparkSession, target: JdbcTarget, table: str, time: str) -> DataFrame:
    """A database table, read in equal ranges of its time column."""
    bounds = f"(SELECT min({time}) AS low, max({time}) AS high FROM {table}) AS bounds"
    reader = spark.read.format("jdbc").option("url", target.url).options(**target.properties())
    found = reader.option("dbtable", bounds).load()
    low, high = found.select(F.col("low").cast("string"), F.col("high").cast("string")).head()
    reader = spark.read.format("jdbc").option("url", target.url).options(**target.properties())
    if low != high:
        reader = reader.options(
            partitionColumn=time, lowerBound=low, upperBound=high, numPartitions=DATABASE_READERS
        )
    return reader.option("dbtable", table).load()


def merge_statement(table: str, staging: str, columns: list[str], keys: list[str], batch_id: int) -> str:
    """One statement that moves a staged batch into the table, newest row wins."""
    names = ", ".join(columns)
    updates = ", ".join(f"{name} = EXCLUDED.{name}" for name in columns if name not in keys)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"WHERE {BATCH_ID} = {int(batch_id)} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
    )


def clear_statement(staging: str, batch_id: int) -> str:
    return f"DELETE FROM {staging} WHERE {BATCH_ID} = {int(batch_id)}"


def _run_statements(spark: SparkSession, target: JdbcTarget, statements: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(target.driver)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, target.user, target.password)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            connection.createStatement().executeUpdate(text)
        connection.commit()
    finally:
        connection.close()


def upsert_jdbc(target: JdbcTarget, table: str, keys: list[str]) -> BatchWriter:
    """A ``foreachBatch`` writer into a database table with a staging table.

    ``<table>_staging`` has the table's columns and ``batch_id``. Executors
    append to it in parallel; the server then merges the batch by key.
    """
    staging = f"{table}_staging"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _run_statements(spark, target, [clear_statement(staging, batch_id)])
        staged = batch.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
        staged.write.jdbc(target.url, staging, mode="append", properties=target.properties())
        merge = merge_statement(table, staging, batch.columns, keys, batch_id)
        _run_statements(spark, target, [merge, clear_statement(staging, batch_id)])

    return write
