"""Detectors by the name a deployment is configured with."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from fieldwatch.operators.cusum import cusum_alerts
from fieldwatch.operators.dwell import fuzzy_alerts
from fieldwatch.operators.ema import ema_alerts
from fieldwatch.operators.forecast import forecast_alerts
from fieldwatch.operators.thresholding import threshold_alerts
from fieldwatch.sources.thresholds import Thresholds

FORECASTER = "XGBoostForecasting"

# The detector names. Each maps readings and limits to alerts;
# the forecaster's forecasts come from ``forecast_score``.
DETECTORS: dict[str, Callable[..., DataFrame]] = {
    "Thresholding": threshold_alerts,
    "EMAThresholding": ema_alerts,
    "CUSUMThresholding": cusum_alerts,
    "FuzzyThresholding": fuzzy_alerts,
    FORECASTER: forecast_alerts,
}


def detect(name: str, readings: DataFrame, thresholds: Thresholds, **params) -> DataFrame:
    """Alerts of the named detector."""
    if name not in DETECTORS:
        raise ValueError(f"unknown detector {name}; known: {', '.join(DETECTORS)}")
    return DETECTORS[name](readings, thresholds, **params)
