"""Scores of documents by masked pseudo-likelihood.

Every text is split once: its words become numbers, 54 bits of a hash above the ten of
the word's bucket, and are written to the shared folder. All else reads these numbers.
Words are counted in a table that grows with the corpus, and buckets from it. In each
round every task trains a copy of the network on its part of the corpus, and the copies
are averaged by the words they have seen, in two steps so that no task adds up all of
them. What goes to the driver is one network and the most frequent words, whatever the
size of the corpus.

The network predicts a word's bucket; the word within it has the share of the bucket's
words that it makes up in the corpus. Shares of frequent words are looked up where texts
are scored, those of all others come by a join.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import documents_of
from fieldwatch.llm.masked_model import BUCKETS, Network, bucket_of, train
from fieldwatch.llm.words import texts_of, words_of
from fieldwatch.session import materialise

ROUNDS = 2
#: Each round learns from every second word of every document, a new one each time, so
#: the rounds learn from each word once; all words serve as neighbours.
EVERY = 2
#: Weights in a row, and rows of one such part that one task adds up in the first step.
PART = 4096
FANS = 64
#: Words are frequent that make up one in so many or more of all words; there are no more than so many.
FREQUENT = 1 << 16
#: Words that a task counts at once, and distinct ones whose numbers it keeps.
COUNTED = 1 << 21
KEPT = 500_000


class WordNumbers(dict):
    """The number of each word, found once: two words share one only if hash and bucket agree."""

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word) & ~(BUCKETS - 1) | bucket_of(word)
        number -= (number >> 63) << 64
        if len(self) < KEPT:
            self[word] = number
        return number


def numbered(docs: DataFrame) -> DataFrame:
    """``row``, a number of its own; ``doc_id``; ``words``, the numbers of all words."""

    @F.arrow_udf("binary")
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = WordNumbers()
        for texts in parts:
            split = map(words_of, texts_of(texts))
            yield pa.array(
                [np.fromiter(map(known.__getitem__, words), np.int64, len(words)).tobytes() for words in split],
                pa.binary(),
            )

    rows = documents_of(docs).withColumn("row", F.monotonically_increasing_id())
    return materialise(rows.select("row", "doc_id", found(F.col("text")).alias("words")))


def word_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    """Numbers of the words of each text of a column."""
    for packed in column.to_pylist():
        yield np.frombuffer(packed, dtype=np.int64)


def bucket_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    """Buckets of the words of each text of a column."""
    for words in word_arrays(column):
        yield words & (BUCKETS - 1)


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word`` and ``times``, for so many words at once."""
    waiting, pending = [], 0

    def counted() -> pa.RecordBatch:
        words, times = np.unique(np.concatenate(waiting), return_counts=True)
        waiting.clear()
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(times)], ["word", "times"])

    for batch in batches:
        for words in word_arrays(batch.column(0)):
            waiting.append(words)
            pending += len(words)
            if pending >= COUNTED:
                yield counted()
                pending = 0
    if pending:
        yield counted()


def word_counts(rows: DataFrame) -> DataFrame:
    """``word``, ``bucket`` and ``times`` of every word of the corpus."""
    counted = rows.select("words").mapInArrow(count_words, "word long, times long")
    total = counted.groupBy("word").agg(F.sum("times").alias("times"))
    return materialise(total.withColumn("bucket", F.col("word").bitwiseAND(F.lit(BUCKETS - 1))))


def word_shares(words: DataFrame, by_bucket: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``word`` and ``share``, the logarithm of its share of its bucket's words; and the
    frequent words, in order, with theirs."""
    of = words.sparkSession.createDataFrame(
        pa.table({"bucket": np.arange(BUCKETS), "of": by_bucket.astype(np.int64)})
    )
    shares = words.join(F.broadcast(of), "bucket").withColumn("share", F.log(F.col("times") / F.col("of")))
    often = F.col("times") * F.lit(FREQUENT) >= F.lit(int(by_bucket.sum()))
    frequent = shares.filter(often).orderBy("word").select("word", "share").toArrow()
    columns = (frequent.column(name).to_numpy() for name in ("word", "share"))
    return shares.filter(~often).select("word", "share"), *columns


def bucket_counts(words: DataFrame) -> np.ndarray:
    """Words per bucket, from the counts of words."""
    total = np.zeros(BUCKETS)
    for bucket, times in words.groupBy("bucket").agg(F.sum("times")).collect():
        total[bucket] = times
    return total


def train_part(start: np.ndarray, every: int, first: int):
    """Train a copy of a network on a task's texts; its weights times the words seen."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of(start)
        texts = (buckets for batch in batches for buckets in bucket_arrays(batch.column(0)))
        seen = train(network, texts, every, first)
        task = TaskContext.get().partitionId()
        weights = (network.flat() - start).astype(np.float64) * seen
        parts = [weights[at : at + PART].astype(np.float32) for at in range(0, len(weights), PART)] if seen else []
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(parts)), pa.int32()),
                pa.array([task % FANS] * len(parts), pa.int32()),
                pa.array([float(seen)] * len(parts), pa.float64()),
                pa.array(list(parts), pa.list_(pa.float32())),
            ],
            ["part", "fan", "seen", "weights"],
        )

    return run


def add_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows of the same part and fan, a row at a time."""
    totals: dict[tuple[int, int], list] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            weights = batch.column(3)[i].values.to_numpy().astype(np.float64)
            if key in totals:
                totals[key][0] += batch.column(2)[i].as_py()
                totals[key][1] += weights
            else:
                totals[key] = [batch.column(2)[i].as_py(), weights]
    keys = list(totals)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([part for part, _ in keys], pa.int32()),
            pa.array([fan for _, fan in keys], pa.int32()),
            pa.array([totals[key][0] for key in keys], pa.float64()),
            pa.array([totals[key][1].astype(np.float32) for key in keys], pa.list_(pa.float32())),
        ],
        ["part", "fan", "seen", "weights"],
    )


def fit_network(rows: DataFrame, by_bucket: np.ndarray, rounds: int = ROUNDS, every: int = EVERY) -> Network:
    """A network trained on all rows of ``numbered``. Without words it knows nothing but evens out."""
    schema = "part int, fan int, seen double, weights array<float>"
    network = Network.start(by_bucket)
    for number in range(rounds):
        flat = network.flat()
        train_copies = train_part(flat, every, number * every // rounds)
        copies = rows.select("words").mapInArrow(train_copies, schema)
        sums = copies.repartition("part", "fan").mapInArrow(add_parts, schema)
        sums = sums.withColumn("fan", F.lit(0)).repartition("part").mapInArrow(add_parts, schema)
        for row in sums.collect():
            at = row.part * PART
            flat[at : at + PART] += np.array(row.weights, dtype=np.float32) / np.float32(row.seen)
        network = Network.of(flat)
    return network


def score_documents(docs: DataFrame, rounds: int = ROUNDS, every: int = EVERY) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them.

    ``doc_id``, ``n_words``, ``log_likelihood`` (sum over the words of the logarithm of
    their probability given both sides: that of the bucket times the word's share of it), ``mean_log_probability`` and ``perplexity``
    (null without words). One row for each row of ``docs``, repeated rows included; null
    and empty texts have no words and likelihood 0. An empty table gives no rows.
    """
    rows = numbered(docs)
    words = word_counts(rows)
    by_bucket = bucket_counts(words)
    shares, often, often_share = word_shares(words, by_bucket)
    flat = fit_network(rows, by_bucket, rounds, every).flat()

    @F.arrow_udf("struct<n_words:long,bucketwise:double,within:double,rest:array<long>,times:array<long>>")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        network = Network.of(flat)
        for texts in parts:
            counts, within, rest, times = [], [], [], []
            for numbers in word_arrays(texts):
                place = np.minimum(np.searchsorted(often, numbers), max(0, len(often) - 1))
                known = often[place] == numbers if len(often) else np.zeros(len(numbers), dtype=bool)
                counts.append(len(numbers))
                within.append(float(often_share[place[known]].sum()))
                others, repeats = np.unique(numbers[~known], return_counts=True)
                rest.append(others)
                times.append(repeats)
            sums = list(network.scores(bucket_arrays(texts)))
            offsets = np.cumsum([0, *map(len, rest)]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *each])) for each in (rest, times)
            ]
            columns = [pa.array(counts, pa.int64()), pa.array(sums, pa.float64()), pa.array(within, pa.float64()), *lists]
            yield pa.StructArray.from_arrays(columns, ["n_words", "bucketwise", "within", "rest", "times"])

    found = materialise(rows.select("row", "doc_id", scored(F.col("words")).alias("score")).select("row", "doc_id", "score.*"))
    rest = found.select("row", F.inline(F.arrays_zip(F.col("rest").alias("word"), F.col("times").alias("times"))))
    sums = rest.join(shares, "word").groupBy("row").agg(F.sum(F.col("times") * F.col("share")).alias("beyond"))
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return (
        found.drop("rest", "times")
        .join(sums, "row", "left")
        .withColumn("log_likelihood", F.col("bucketwise") + F.col("within") + F.coalesce("beyond", F.lit(0.0)))
        .select("doc_id", "n_words", "log_likelihood")
        .withColumn("mean_log_probability", mean)
        .withColumn("perplexity", F.exp(-F.col("mean_log_probability")))
    )
