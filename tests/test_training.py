"""Counts that are kept up to date against counts over all history."""

import random

import pytest

from conftest import SCHEMA, at
from fieldwatch.operators.forecast import bin_edges, class_counts, forecast_score
from fieldwatch.operators.history import forecast_training_set
from fieldwatch.sources.thresholds import load_thresholds
from fieldwatch.streaming import training
from fieldwatch.streaming.snapshots import TableFolder
from fieldwatch.streaming.training import TrainingHistory

LIMITS = load_thresholds()
EDGES = [0.1, 0.35, 0.43]


def made(seed, days, per_day=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(days * per_day):
        series = rng.choice(["A", "A", "A", "B", "C"])
        rows.append((series, rng.choice(["PM10", "PM2.5"]), at(rng.randrange(days * 86_400)), len(rows), rng.choice([5.5, 99.99, 100.0, 349.5, 350.0, 429.9, 430.0, 7000.0, -3.0])))
    return sorted(rows, key=lambda r: r[2])


def counted(df):
    return sorted(tuple(row[name] for name in ("bin", "hour", "day_of_week", *training.COUNTS)) for row in df.collect())


def split(rows, cuts):
    edges = [0, *cuts, len(rows)]
    return [rows[low:high] for low, high in zip(edges[:-1], edges[1:], strict=True)]


def test_moving_window_equals_all_history(spark, tmp_path, days=3):
    """After every batch: first the window holds everything, then it begins inside a day."""
    rows = made(1, 8)
    history = TrainingHistory(spark, str(tmp_path), LIMITS)
    seen = []
    for batch, part in enumerate(split(rows, [1, 180, 200])):
        history.add(spark.createDataFrame(part, SCHEMA), batch)
        seen += part
        whole = forecast_training_set(spark.createDataFrame(seen, SCHEMA), LIMITS, days)
        assert counted(history.cells(EDGES, days)) == counted(class_counts(whole, EDGES))


def test_a_repeated_batch_and_a_crash_before_the_counts(spark, tmp_path, monkeypatch):
    rows = made(2, 4)
    history = TrainingHistory(spark, str(tmp_path), LIMITS)
    first, second = (spark.createDataFrame(part, SCHEMA) for part in split(rows, [80]))
    history.add(first, 0)
    real = training.write_version

    def crash(rows, path, *rest):
        if path.endswith("counts"):
            raise RuntimeError("lost")
        real(rows, path, *rest)

    monkeypatch.setattr(training, "write_version", crash)
    with pytest.raises(RuntimeError):
        history.add(second, 1)
    before = forecast_training_set(first, LIMITS, 3)
    assert counted(history.cells(EDGES, 3)) == counted(class_counts(before, EDGES))
    monkeypatch.setattr(training, "write_version", real)
    for _ in range(2):
        history.add(second, 1)
    whole = forecast_training_set(spark.createDataFrame(rows, SCHEMA), LIMITS, 3)
    assert counted(history.cells(EDGES, 3)) == counted(class_counts(whole, EDGES))
    assert history.seen() == 1


def test_only_counts_of_whole_days_are_read(spark, tmp_path):
    rows = made(3, 9, 200)
    history = TrainingHistory(spark, str(tmp_path), LIMITS)
    history.add(spark.createDataFrame(rows, SCHEMA), 0)
    whole, others = history._window(5)
    days = {name.split("day=")[1][:10] for name in whole.inputFiles()}
    assert len(days) == 5
    files = {name.split("/labelled/")[-1].split("day=")[1][:10] for name in others.inputFiles() if "/labelled/" in name}
    assert len(files) == 1 and files < {part.day for part in TableFolder(spark, history.labelled).snapshot().parts} - days


def test_edges_are_quantiles_on_the_grid(spark, tmp_path):
    history = TrainingHistory(spark, str(tmp_path), LIMITS)
    assert history.edges() == [] and history.cells(EDGES).collect() == []
    rows = [("A", "PM10", at(i * 900), i, float(i % 100)) for i in range(1000)]
    table = spark.createDataFrame(rows, SCHEMA)
    history.add(table, 0)
    assert history.edges(4) == bin_edges(forecast_training_set(table, LIMITS), 4) == [0.024, 0.049, 0.074]
    assert len(history.edges(256)) <= 99


def test_fit_on_counts_scores_like_any_model(spark, tmp_path):
    history = TrainingHistory(spark, str(tmp_path), LIMITS)
    rows = [("A", "PM10", at(i * 900), i, 450.0 if i // 50 % 2 else 10.0) for i in range(1200)]
    history.add(spark.createDataFrame(rows, SCHEMA), 0)
    model = history.fit(bins=4, rounds=3)
    found = forecast_score(spark.createDataFrame(rows[400:401] + rows[450:451], SCHEMA), model)
    nearest = [row["predicted_category"] for row in found.orderBy("event_time").collect() if row["timescale"] == "15min"]
    assert nearest == ["green_yellow", "red"]


@pytest.mark.parametrize("edges", [[0.0], [0.1005], [9.0]])
def test_edges_off_the_grid_are_refused(spark, tmp_path, edges):
    with pytest.raises(ValueError, match="whole units"):
        TrainingHistory(spark, str(tmp_path), LIMITS).cells(edges)
