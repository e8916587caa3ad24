"""The corpus pipeline: five stages over ``documents``, each on what the one before kept."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldwatch.llm.decontaminate import drop_contaminated
from fieldwatch.llm.mixing import mix
from fieldwatch.llm.quality import keep_good
from fieldwatch.llm.secrets import redact
from fieldwatch.llm.simhash import drop_near_duplicates
from fieldwatch.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. Empty texts fail; without labels only base rules count."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, that with the smallest id."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; every document stays."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their number of copies and words."""
    return mix(docs).filter("copies > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
]

#: Trees, fingerprints and rounding have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        written = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
