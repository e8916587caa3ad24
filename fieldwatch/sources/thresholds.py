"""Alert limits per pollutant: a small configuration table."""

import json
import math
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHIPPED = Path(__file__).with_name("thresholds.yaml")
CATEGORIES = ("green", "yellow", "orange", "red")
LIMIT_COLUMNS = [f"{name}_{edge}" for name in CATEGORIES for edge in ("min", "max")]
REQUIRED = ("orange_min", "orange_max", "red_min")
# A table this long is still under a megabyte; a longer one joins by shuffle.
BROADCAST_ROWS = 10_000


@dataclass(frozen=True)
class Thresholds:
    """Limits by pollutant, each a mapping of ``LIMIT_COLUMNS`` to a number."""

    limits: Mapping[str, Mapping[str, float | None]]

    def __post_init__(self):
        for pollutant, row in self.limits.items():
            for name in REQUIRED:
                if row.get(name) is None:
                    raise ValueError(f"{pollutant}: {name} is missing")
            if not row["orange_min"] < row["orange_max"] <= row["red_min"]:
                raise ValueError(f"{pollutant}: need orange min < orange max <= red min")

    def lowest(self, name: str) -> float:
        """The smallest value of one limit; infinite when there are no rows."""
        return min((row[name] for row in self.limits.values()), default=math.inf)

    def frame(self, spark: SparkSession, extra: Mapping[str, Mapping[str, float]] | None = None):
        """The limits as rows, with ``extra`` number columns per pollutant."""
        extra = extra or {}
        added = sorted({name for row in extra.values() for name in row})
        columns = {"pollutant_type": pa.array(list(self.limits), pa.string())}
        for name in LIMIT_COLUMNS:
            values = [row.get(name) for row in self.limits.values()]
            columns[name] = pa.array(values, pa.float64())
        for name in added:
            values = [extra[pollutant][name] for pollutant in self.limits]
            columns[name] = pa.array(values, pa.float64())
        return spark.createDataFrame(pa.table(columns))

    def join(
        self,
        df: DataFrame,
        columns: list[str],
        how: str = "inner",
        extra: Mapping[str, Mapping[str, float]] | None = None,
    ) -> DataFrame:
        """Put limit columns beside each row of ``df``."""
        table = self.frame(df.sparkSession, extra).select("pollutant_type", *columns)
        if len(self.limits) <= BROADCAST_ROWS:
            table = F.broadcast(table)
        return df.join(table, "pollutant_type", how)


def parse_thresholds(config: Mapping) -> Thresholds:
    """Nested pollutant -> category -> {min, max} as Thresholds."""
    limits = {}
    for pollutant, categories in config.items():
        if categories is None:
            continue
        limits[str(pollutant)] = {
            f"{name}_{edge}": float(categories[name][edge])
            for name in CATEGORIES
            for edge in ("min", "max")
            if edge in categories.get(name, {})
        }
    return Thresholds(limits)


def load_thresholds(path: str | Path = SHIPPED) -> Thresholds:
    """Read a YAML (or plain JSON) threshold file."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        config = json.loads(text)
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("PyYAML is needed for a threshold file that is not JSON") from missing
        config = yaml.safe_load(text)
    return parse_thresholds(config or {})
