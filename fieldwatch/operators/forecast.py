"""Forecasting the pollution category 15 minutes, 1 hour and 3 hours ahead.

The model sees three features: the scaled concentration (cut into at most
``bins`` quantile bins, as histogram boosting does), the hour and the weekday.
History of any size therefore shrinks, in one aggregation, to class counts over
at most bins x 24 x 7 cells, and the trees are boosted on those weighted cells.
A tree can only tell cells apart, so the whole model equals a table with one
row per cell; scoring is a broadcast join with that bounded table.
"""

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.columns import CLASS_NAMES, HORIZONS, class_name, features
from fieldwatch.functions.schemas import FORECAST
from fieldwatch.operators.history import TARGETS, forecast_training_set, training_coverage
from fieldwatch.operators.thresholding import open_orange_alerts
from fieldwatch.session import materialise
from fieldwatch.sources.thresholds import Thresholds

# Booster settings.
ROUNDS = 50
DEPTH = 4
STEP = 0.1
BINS = 256

HOURS, WEEKDAYS = 24, 7
CELL = ["bin", "hour", "day_of_week"]
CELL_PARTITIONS = 4
# The scoring table is broadcast: this many bins make it about 170,000 rows.
MOST_BINS = 1024
CLASSES = list(CLASS_NAMES)


@dataclass
class ForecastModel:
    """Bin edges, the class of every cell per horizon, and the fitted trees."""

    edges: list[float]
    table: DataFrame
    boosters: dict[str, dict[int, GBTClassificationModel]] = field(default_factory=dict)
    # False for the stand-in before there is enough history.
    trained: bool = True
    # The folder that holds it, once saved.
    version: str | None = None

    def save(self, path: str) -> None:
        """Write trees, scoring table and, last, edges to a new version below ``path``.

        Older versions stay, so a stream that scores with one of them goes on.
        """
        spark = self.table.sparkSession
        version = qualified(spark, f"{path}/version={time.time_ns()}")
        for name, by_class in self.boosters.items():
            for class_id, booster in by_class.items():
                booster.write().save(f"{version}/boosters/{name}/{class_id}")
        self.table.write.parquet(f"{version}/table")
        edges = spark.createDataFrame([(self.edges,)], "edges array<double>")
        edges.write.parquet(f"{version}/edges")
        self.version = version

    @staticmethod
    def newest(spark: SparkSession, path: str) -> str | None:
        """The folder of the newest complete version, if there is one."""
        found = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/edges/_SUCCESS")
        files = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
        versions = [file.getPath().getParent().getParent().toString() for file in files or []]
        return max(versions, default=None)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ForecastModel":
        """Read back what scoring needs, from the newest complete version."""
        version = ForecastModel.newest(spark, path)
        if version is None:
            raise FileNotFoundError(f"no model below {path}")
        edges = spark.read.parquet(f"{version}/edges").head()["edges"]
        table = spark.read.parquet(f"{version}/table")
        return ForecastModel(list(edges), table, version=version)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of its file system, as listings name it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def with_cell(rows: DataFrame, edges: list[float]) -> DataFrame:
    """Add the concentration bin to rows that carry the features."""
    if not edges:
        return rows.withColumn("bin", F.lit(0))
    cut = Bucketizer(
        splits=[-float("inf"), *edges, float("inf")],
        inputCol="concentration_norm",
        outputCol="bin",
        handleInvalid="keep",
    )
    return cut.transform(rows).withColumn("bin", F.col("bin").cast("int"))


def bin_edges(training: DataFrame, bins: int) -> list[float]:
    """Quantile cuts of the concentration: at most ``bins - 1`` numbers."""
    shares = [step / bins for step in range(1, bins)]
    found = training.agg(
        F.percentile_approx("concentration_norm", shares, 10_000).alias("edges")
    ).head()["edges"]
    return sorted(set(found or []))


def class_counts(training: DataFrame, edges: list[float]) -> DataFrame:
    """Training rows per cell, horizon and class; one row per cell."""
    return (
        with_cell(training, edges)
        .groupBy(*CELL)
        .agg(
            *(
                F.count_if(F.col(TARGETS[name]) == class_id).cast("double").alias(count_name(name, class_id))
                for name in HORIZONS
                for class_id in CLASSES
            )
        )
    )


def count_name(name: str, class_id: int) -> str:
    return f"rows_{name}_{class_id}"


def _fit_one(cells: DataFrame, name: str, class_id: int, settings: dict) -> GBTClassificationModel:
    """Trees for one class against the others at one horizon."""
    own = F.col(count_name(name, class_id))
    rest = sum(F.col(count_name(name, other)) for other in CLASSES if other != class_id)
    labelled = F.array(
        F.struct(F.lit(1.0).alias("label"), own.alias("weight")),
        F.struct(F.lit(0.0).alias("label"), rest.alias("weight")),
    )
    rows = cells.select("features", F.inline(labelled)).filter(F.col("weight") > 0)
    booster = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxBins=max(32, settings["bins"]),
        maxDepth=settings["depth"],
        maxIter=settings["rounds"],
        stepSize=STEP,
        seed=7,
    )
    return booster.fit(rows)


def _margin(name: str, class_id: int) -> str:
    return f"margin_{name}_{class_id}"


def _best_class(name: str, seen: list[int]) -> Column:
    """The seen class with the highest margin; the lower one on a tie."""
    if not seen:
        return F.lit(0)
    best = F.greatest(*(F.col(_margin(name, c)) for c in seen)) if len(seen) > 1 else None
    choice = F.lit(seen[-1])
    for class_id in reversed(seen[:-1]):
        choice = F.when(F.col(_margin(name, class_id)) == best, class_id).otherwise(choice)
    return choice


def all_cells(spark: SparkSession, edges: list[float]) -> DataFrame:
    """Every (bin, hour, weekday): at most bins x 24 x 7 rows."""
    per_bin = HOURS * WEEKDAYS
    cell = F.col("id")
    return spark.range(0, (len(edges) + 1) * per_bin, 1, CELL_PARTITIONS).select(
        F.floor(cell / per_bin).cast("int").alias("bin"),
        F.floor((cell % per_bin) / WEEKDAYS).cast("int").alias("hour"),
        (cell % WEEKDAYS).cast("int").alias("day_of_week"),
    )


def fit_forecaster(training: DataFrame, bins: int = BINS, **settings) -> ForecastModel:
    """Fit the three horizons on a training set; ``fit_cells`` names the settings."""
    check_bins(bins)
    edges = bin_edges(training, bins)
    return fit_cells(class_counts(training, edges), edges, bins=bins, **settings)


def check_bins(bins: int) -> None:
    if not 2 <= bins <= MOST_BINS:
        raise ValueError(f"bins lies between 2 and {MOST_BINS}, got {bins}")


def fit_cells(
    counts: DataFrame,
    edges: list[float],
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    bins: int = BINS,
    parallelism: int = 9,
) -> ForecastModel:
    """Fit the three horizons on class counts of cells.

    A horizon with one class always predicts that class; one without any row
    predicts green_yellow. The fits are small jobs over the cells and run side
    by side.
    """
    check_bins(bins)
    spark = counts.sparkSession
    assemble = VectorAssembler(inputCols=CELL, outputCol="features")
    # All nine fits read these cells; they are few, so two partitions do.
    cells = assemble.transform(materialise(counts.coalesce(2))).cache()
    totals = cells.agg(
        *(F.sum(count_name(n, c)).alias(count_name(n, c)) for n in HORIZONS for c in CLASSES)
    ).head()
    seen = {n: [c for c in CLASSES if totals[count_name(n, c)]] for n in HORIZONS}
    wanted = [(n, c) for n in HORIZONS for c in seen[n] if len(seen[n]) > 1]
    settings = {"rounds": rounds, "depth": depth, "bins": bins}

    with ThreadPoolExecutor(parallelism) as pool:
        fitted = list(pool.map(lambda job: _fit_one(cells, *job, settings), wanted))
    boosters: dict[str, dict[int, GBTClassificationModel]] = {}
    scored = assemble.transform(all_cells(spark, edges))
    for (name, class_id), booster in zip(wanted, fitted, strict=True):
        boosters.setdefault(name, {})[class_id] = booster
        raw = booster.copy().setRawPredictionCol("raw").setProbabilityCol("").setPredictionCol("")
        scored = raw.transform(scored).withColumn(
            _margin(name, class_id), vector_to_array("raw")[1]
        ).drop("raw")
    cells.unpersist()
    table = scored.select(*CELL, *(_best_class(n, seen[n]).alias(n) for n in HORIZONS))
    return ForecastModel(edges, materialise(table), boosters)


def majority_model(training: DataFrame, edges: list[float]) -> ForecastModel:
    """The most frequent class of each cell, as a baseline for the trees.

    On a tie the lower class; a cell or horizon without rows is green_yellow.
    """
    counts = class_counts(training, edges)
    votes = {_margin(n, c): F.col(count_name(n, c)) for n in HORIZONS for c in CLASSES}
    best = (_best_class(name, CLASSES).alias(name) for name in HORIZONS)
    return ForecastModel(edges, counts.withColumns(votes).select(*CELL, *best))


def untrained_model(spark: SparkSession) -> ForecastModel:
    """The stand-in before there is enough history: always green_yellow."""
    cells = all_cells(spark, [])
    return ForecastModel([], cells.select(*CELL, *(F.lit(0).alias(n) for n in HORIZONS)), trained=False)


def train_forecaster(history: DataFrame, thresholds: Thresholds, **settings) -> ForecastModel:
    """Train on the recent history, or stand in when it is too short."""
    newest = F.unix_micros("max_time").alias("newest")
    span = training_coverage(history).select("ready", newest).head()
    if not span["ready"]:
        return untrained_model(history.sparkSession)
    training = forecast_training_set(history, thresholds, newest=span["newest"])
    return fit_forecaster(training, **settings)


def forecast_score(readings: DataFrame, model: ForecastModel) -> DataFrame:
    """Three forecasts per reading, one per horizon, for a table or a stream.

    The scoring table has at most bins x 24 x 7 rows. A reading outside it is
    forecast green_yellow.
    """
    scored = with_classes(readings.select("site_id", "event_time", "pollutant_type", "concentration"), model)
    return scored.select(F.inline(F.array(*(F.struct(*row) for row in forecasts()))))


def with_classes(readings: DataFrame, model: ForecastModel) -> DataFrame:
    """Readings with the class that the model gives them, in a column for each horizon."""
    featured = readings.select("*", *features(F.col("concentration"), F.col("event_time")))
    return with_cell(featured, model.edges).join(F.broadcast(model.table), CELL, "left")


def forecasts() -> list[list[Column]]:
    """The columns of each horizon's forecast, for rows with classes."""
    names = FORECAST.fieldNames()
    return [
        [*names[:3], F.lit(name).alias(names[3]), class_name(F.col(name)).alias(names[4])] for name in HORIZONS
    ]


def forecast_alerts(readings: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The alerts raised beside forecasts, one per reading.

    Orange reaches up to red min here, and the breached limit is reported.
    """
    return open_orange_alerts(readings, thresholds, report_limit=True)
