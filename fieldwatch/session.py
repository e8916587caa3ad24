"""Session set-up and the shared checkpoint folder."""

import tempfile

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_local_folders: dict[str, str] = {}


def build_spark(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """One session for every job: UTC days and hours, AQE, RocksDB state."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
        # Spark sizes a batch for Python after every row unless the limit is this
        # one; the rows sent here are narrow and bounded by their number.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1))
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session that names none gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.applicationId not in _local_folders:
        made = tempfile.mkdtemp(prefix="fieldwatch-")
        _local_folders[spark.sparkContext.applicationId] = made
    return _local_folders[spark.sparkContext.applicationId]


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written rows."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
