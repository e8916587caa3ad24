"""Quality rules: boosted trees over statistics of whole documents.

Statistics and verdict of a document are found in one pass, in the task that reads
it. The trees are fitted on at most ``LABELLED_ROWS`` labelled documents, chosen by
a hash of their id; they are flattened into arrays and go out with the function.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.boosting import FlatTrees, fit_trees, sigmoid
from fieldwatch.llm.common import documents_of, free_name

#: Bound of the labelled sample that the trees are fitted on.
LABELLED_ROWS = 10_000
#: Documents below this probability of being good are rejected.
KEEP_FROM = 0.5
FEWEST_WORDS = 20
MOST_REPEATED_PERCENT = 30
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares that the trees see, and whether the score may only fall (-1) with them.
FEATURES = {
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "log_words": 0,
    "word_length": 0,
    "distinct_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "mark_share": 0,
    "line_words": 0,
}
MIX = np.random.default_rng(8).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit sum of word hashes times odd constants.
    """
    count = len(hashes) - window + 1
    if count < 2:
        return 0
    sums = np.zeros(count, dtype=np.uint64)
    for i in range(window):
        sums += hashes[i : i + count] * MIX[i]
    ordered = np.sort(sums)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    place = np.minimum(np.searchsorted(twice, sums), len(twice) - 1)
    starts = np.flatnonzero(twice[place] == sums)
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of a text and the features made from them; all zero without words."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    duplicates = len(lines) - len(set(lines))
    repeated = repeated_words(hashes)
    ascii_bytes = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    by_byte = np.bincount(ascii_bytes, minlength=128)
    size = max(1, chars)
    features = [
        symbols / size,
        duplicates / max(1, len(lines)),
        repeated / max(1, n),
        float(np.log1p(n)),
        chars / max(1, n),
        len(np.unique(hashes)) / max(1, n),
        int(by_byte[65:91].sum()) / size,
        int(by_byte[48:58].sum()) / size,
        int(by_byte[33] + by_byte[63]) / size,
        n / max(1, len(lines)),
    ]
    return [n, chars, symbols, duplicates, repeated], features


def statistics_of(text: Column) -> Column:
    """Counts and features of a text column, as a struct."""
    schema = ", ".join([f"{name} long" for name in COUNTS] + ["features array<double>"])

    @F.arrow_udf(f"struct<{schema.replace(' ', ':').replace(',:', ',')}>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [statistics(value) for value in texts.to_pylist()]
        counts = [pa.array([row[0][i] for row in rows], pa.int64()) for i in range(len(COUNTS))]
        features = pa.array([row[1] for row in rows], pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([*counts, features], [*COUNTS, "features"])

    return found(text)


def fit_quality(docs: DataFrame, labels: DataFrame, most_rows: int = LABELLED_ROWS) -> FlatTrees:
    """Trees for the ``quality`` label (0 or 1) of documents.

    Ids with contradicting labels and labels that are neither 0 nor 1 teach nothing.
    """
    ids = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter("quality = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
        .select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("quality"))
    )
    # At most ``most_rows`` ids and numbers, whatever the tables hold.
    seen = (
        documents_of(docs)
        .join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
        .select("doc_id", "quality", statistics_of(F.col("text")).alias("found"))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.min("found.features").alias("features"))
        .orderBy("doc_id")
        .collect()
    )
    features = np.array([row.features for row in seen], dtype=float).reshape(-1, len(FEATURES))
    return fit_trees(features, np.array([row.quality for row in seen], dtype=float), list(FEATURES.values()))


def verdict_of(text: Column, trees: FlatTrees, keep_from: float = KEEP_FROM) -> Column:
    """Counts, ``base_failed``, ``score`` and ``kept`` of a text column, as a struct."""
    fields = [f"{name}:long" for name in COUNTS] + ["base_failed:boolean", "score:double", "kept:boolean"]

    @F.arrow_udf(f"struct<{','.join(fields)}>")
    def judged(texts: pa.Array) -> pa.Array:
        rows = [statistics(value) for value in texts.to_pylist()]
        counts = np.array([row[0] for row in rows], dtype=np.int64).reshape(-1, len(COUNTS))
        features = np.array([row[1] for row in rows], dtype=float).reshape(-1, len(FEATURES))
        failed = counts[:, 0] < FEWEST_WORDS
        failed |= 100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0]
        score = sigmoid(trees.score(features))
        columns = [*counts.T, failed, score, ~failed & (score >= keep_from)]
        names = [*COUNTS, "base_failed", "score", "kept"]
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    return judged(text)


def quality_verdicts(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Counts and verdict of every document.

    One row for each row of ``docs``, repeated rows included. Null and empty texts
    have no words and fail the base rule. Without usable labels the trees accept
    all that pass it. An empty table gives no rows.
    """
    trees = fit_quality(docs, labels)
    verdict = verdict_of(F.col("text"), trees, keep_from).alias("__verdict")
    return documents_of(docs).select("doc_id", verdict).select("doc_id", "__verdict.*")


def keep_good(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents that the rules accept, with all their columns."""
    trees = fit_quality(docs, labels)
    name = free_name(docs, "verdict")
    judged = docs.withColumn(name, verdict_of(F.col("text").cast("string"), trees, keep_from))
    return judged.filter(F.col(f"{name}.kept")).drop(name)
