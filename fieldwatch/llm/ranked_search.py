"""Ranked lexical search that scores equal bags of words once.

A document is cut down to its bag: how often it holds each term of the items, and its
length class ``m``. Documents of one bag and ``m`` have one score for any item. They meet
by the bag's hash and are compared by the whole bag; a class keeps its ``top`` smallest
ids, as no item ranks more of its members. Tasks score classes, keep the ``top`` best of
each item, and only those classes are expanded.

Items are taken in blocks of at most about ``BLOCK_CHARS`` characters and ``BLOCK_ITEMS``
items, with a pass over the documents for each; a block's vocabulary is what goes out
with the functions.
"""

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from fieldwatch.llm.words import texts_of, words_of
from fieldwatch.session import materialise

TOP = 20
BLOCK_CHARS = 200_000
BLOCK_ITEMS = 256
#: Scores that wait before they are cut down to the best of each item.
WAITING = 100_000
#: Stands after all ids, for rows without one.
LAST_ID = 2**63 - 1
RANKED = "item_id long, rank int, doc_id long, score long"


def dealt_items(items: DataFrame, block_chars: int, block_items: int) -> tuple[DataFrame, int]:
    """Items with a ``number`` of their own and a ``block``, and the number of blocks.

    Blocks of more than one item hold at most twice the named amounts.
    """
    numbered = materialise(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .withColumn("number", F.monotonically_increasing_id())
    )
    size = F.coalesce(F.length("text"), F.lit(0))
    chars, rows = numbered.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).head()
    blocks = max(1, -(-chars // block_chars), -(-rows // block_items))
    while True:
        dealt = numbered.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.sum(size).alias("chars"), F.count("*").alias("rows"))
        over = (F.col("rows") > 1) & (
            (F.col("chars") > 2 * block_chars) | (F.col("rows") > 2 * block_items)
        )
        if sizes.filter(over).isEmpty():
            return dealt, blocks
        blocks *= 2


@dataclass(frozen=True)
class Block:
    """Items of one block: their terms as numbers."""

    item_ids: list[int | None]
    vocabulary: dict[bytes, int]
    terms: list[Counter]

    @staticmethod
    def of(rows: list[Row]) -> "Block":
        """Terms are numbered in their order, so that results do not depend on that of rows."""
        counts = [Counter(words_of((row["text"] or "").encode())) for row in rows]
        vocabulary = {term: i for i, term in enumerate(sorted(set().union(*counts)))}
        return Block([row["item_id"] for row in rows], vocabulary, counts)

    def weights(self, weight: np.ndarray) -> np.ndarray:
        """Weight of each term (rows) in each item (columns), repeats included.

        Whole numbers; kept as doubles where no score can leave their exact range.
        """
        heaviest = int(weight.max(initial=0)) * 1_000_000
        most = max((sum(count.values()) for count in self.terms), default=0) * heaviest
        table = np.zeros((len(self.vocabulary), len(self.terms)), dtype=np.float64 if most < 2**53 else np.int64)
        for column, count in enumerate(self.terms):
            for term, times in count.items():
                number = self.vocabulary[term]
                table[number, column] = times * int(weight[number])
        return table


def as_bag(text: bytes | None, vocabulary: dict[bytes, int]) -> tuple[int, bytes]:
    """Number of all terms, and the bag: numbers of known terms in order, then their counts."""
    words = words_of(text)
    known = sorted(
        (vocabulary[word], times) for word, times in Counter(words).items() if word in vocabulary
    )
    return len(words), np.array(known, dtype="<i4").reshape(-1, 2).T.tobytes()


def bag_of(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Terms and counts of a bag."""
    terms, times = np.frombuffer(bag, dtype="<i4").reshape(2, -1)
    return terms, times


def count_terms(vocabulary: dict[bytes, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [as_bag(text, vocabulary) for text in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in made], pa.int64()),
                    pa.array([bag for _, bag in made], pa.binary()),
                ],
                ["doc_id", "n", "bag"],
            )

    return run


def count_holders(size: int):
    """How many of a task's documents hold each term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for bag in batch.column("bag").to_pylist():
                held[bag_of(bag)[0]] += 1
        terms = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms.astype(np.int32)), pa.array(held[terms])], ["term", "held"]
        )

    return run


class Best:
    """The best classes of each item that a task has seen: highest score, then smallest id."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.floors = np.ones(items)
        self.kept: list[tuple[np.ndarray, ...]] = []
        self.members: dict[int, list] = {}
        self.waiting = 0
        self.seen = 0

    def add(self, scores: np.ndarray, members: list[list]) -> None:
        """Scores of classes (rows) for all items (columns)."""
        row, item = np.nonzero(scores >= self.floors)
        firsts = np.array([ids[0] if ids[0] is not None else LAST_ID for ids in members], dtype=np.int64)
        for i in set(row.tolist()):
            self.members[self.seen + i] = members[i]
        self.kept.append((item, scores[row, item].astype(np.int64), firsts[row], row + self.seen))
        self.seen += len(members)
        self.waiting += len(row)
        if self.waiting > WAITING:
            self.cut()

    def cut(self) -> None:
        """Of each item only the ``top`` best stay; their last is the item's new floor."""
        if not self.kept:
            return
        item, score, first, place = (np.concatenate(part) for part in zip(*self.kept, strict=True))
        order = np.lexsort((place, first, -score, item))
        item, score, first, place = item[order], score[order], first[order], place[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        full = rank == self.top - 1
        self.floors[item[full]] = np.maximum(self.floors[item[full]], score[full])
        stays = rank < self.top
        self.kept = [(item[stays], score[stays], first[stays], place[stays])]
        still = set(place[stays].tolist())
        self.members = {at: ids for at, ids in self.members.items() if at in still}
        self.waiting = 0


def score_classes(weights: np.ndarray, top: int):
    """Best classes of each item in a task, with their members."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(weights.shape[1], top)
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = np.empty((batch.num_rows, weights.shape[1]), dtype=weights.dtype)
            lengths = batch.column("m").to_numpy()
            for row, bag in enumerate(batch.column("bag").to_pylist()):
                terms, times = bag_of(bag)
                times = times.astype(np.int64)
                parts = 1_000_000_000 * times // (1000 * times + 12 * int(lengths[row]))
                scores[row] = parts.astype(weights.dtype) @ weights[terms]
            best.add(scores, batch.column("doc_ids").to_pylist())
        best.cut()
        item, score, _, place = best.kept[0] if best.kept else (np.empty(0, np.int64),) * 4
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item.astype(np.int32)),
                pa.array(score.astype(np.int64)),
                pa.array([best.members[at] for at in place.tolist()], pa.list_(pa.int64())),
            ],
            ["item", "score", "doc_ids"],
        )

    return run


def classes_of(bags: DataFrame, top: int) -> DataFrame:
    """One row for each distinct bag and ``m``, with its ``top`` smallest ids.

    Spark cuts each task's part of a class to ``top`` rows before the shuffle.
    """
    same = ["hash", "m", "bag"]
    hashed = bags.withColumn("hash", F.xxhash64("bag"))
    in_order = Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last())
    first = hashed.withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= top)
    members = F.sort_array(F.collect_list(F.struct("place", "doc_id")))
    return first.groupBy(*same).agg(members.getField("doc_id").alias("doc_ids")).drop("hash")


def search_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """Ranked documents for the items of one block."""
    counted = materialise(docs.mapInArrow(count_terms(block.vocabulary), "doc_id long, n long, bag binary"))
    documents, words = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).head()
    known = counted.filter(F.length("bag") > 0)
    held = known.select("bag").mapInArrow(count_holders(len(block.vocabulary)), "term int, held long")
    holders = np.zeros(len(block.vocabulary), dtype=np.int64)
    # One row for each term of the block.
    for term, total in held.groupBy("term").agg(F.sum("held")).collect():
        holders[term] = total
    weight = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holders.tolist()],
        dtype=np.int64,
    )
    m = F.expr(f"75 + (25 * n * {documents}L) div {max(1, words or 0)}L")
    classes = materialise(classes_of(known.withColumn("m", m), top))
    scored = classes.select("m", "bag", "doc_ids").mapInArrow(
        score_classes(block.weights(weight), top), "item int, score long, doc_ids array<long>"
    )
    first = F.col("doc_ids")[0].asc_nulls_last()
    best_classes = Window.partitionBy("item").orderBy(F.desc("score"), first)
    best_documents = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = (
        scored.withColumn("place", F.row_number().over(best_classes))
        .filter(F.col("place") <= top)
        .select("item", "score", F.explode("doc_ids").alias("doc_id"))
        .withColumn("rank", F.row_number().over(best_documents))
        .filter(F.col("rank") <= top)
    )
    # One number for each item of the block.
    ids = F.array(*[F.lit(item_id).cast("long") for item_id in block.item_ids])
    return ranked.select(ids[F.col("item")].alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block_chars: int = BLOCK_CHARS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The ``top`` documents with the highest score above 0 for each item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other
    columns are left alone. Returns ``item_id``, ``rank`` from 1, ``doc_id`` and
    ``score``, equal scores by ascending id, rows without an id last. Every row is a
    document, and every row of the items is ranked by itself, also where ids repeat.
    Null and empty texts have no terms: such documents are never found, such items find
    nothing. Empty tables give none. Whole texts count, however long.
    """
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt, blocks = dealt_items(items, block_chars, block_items)
    results = []
    for number in range(blocks):
        rows = dealt.filter(F.col("block") == number).orderBy("number").collect()  # one block
        block = Block.of(rows)
        if block.vocabulary:
            found = search_block(thin, block, top)
            results.append(materialise(found) if blocks > 1 else found)
    if not results:
        return docs.sparkSession.createDataFrame([], RANKED)
    return reduce(DataFrame.unionByName, results)
