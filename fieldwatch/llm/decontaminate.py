"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive words; hashes of the selected words are joined
between benchmark and documents, so words at the ignored places may differ. The masks
follow from how many words of a window may differ: two of its parts must then be equal,
and there is a mask for every distance of two parts. So no window is missed. Every hit
gives an alignment of a document and an item, along which windows of words are
compared one by one. The benchmark is the stated query set: it passes by in blocks of
bounded size, each broadcast to one pass over the documents, which are never shuffled.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import documents_of, free_name
from fieldwatch.llm.words import texts_of, words_of
from fieldwatch.session import materialise

#: Words that are compared, and the share of them that must be equal.
OVERLAP = 13
SIMILARITY = 0.8
#: Passages of fewer words must be equal in all of them.
EXACT_BELOW = 6
#: Words in a block of the benchmark, which bounds what is broadcast. Longer items are
#: searched in pieces that overlap.
BLOCK_WORDS = 200_000
PIECE_WORDS = 4096
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SLOTS = 1 << 20
#: Blocks of the benchmark that one pass over whole documents looks for.
BLOCKS_IN_A_PASS = 4
#: Hits that are turned into alignments at a time, which bounds memory.
HITS_AT_ONCE = 1 << 20
FOUND = "item_id long, doc_start long, doc_end long, item_start long, item_end long, n_equal long"


def equal_words(window: int, similarity: float) -> int:
    """How many words of a window must be equal."""
    return window if window < EXACT_BELOW else int(np.ceil(similarity * window - 1e-9))


def seed_masks(window: int, similarity: float) -> list[tuple[int, ...]]:
    """Places that the masks select. ``changed`` words leave two of ``changed + 2`` parts equal."""
    if window == 1:
        return [(0,)]
    changed = window - equal_words(window, similarity)
    part = max(1, window // (changed + 2))
    return [
        (*range(part), *range(apart * part, (apart + 1) * part)) for apart in range(1, changed + 2)
    ]


@dataclass
class Block:
    """Pieces of the benchmark with the hashes of their windows under each mask."""

    ids: list[int | None] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    size: int = 0

    def add(self, item_id: int | None, offset: int, words: list[bytes]) -> None:
        codes = [self.vocabulary.setdefault(word, len(self.vocabulary) + 1) for word in words]
        self.ids.append(item_id)
        self.offsets.append(offset)
        self.words.append(np.array(codes, dtype=np.uint64))
        self.size += len(words)

    def seeds(self, overlap: int, similarity: float) -> dict[tuple[int, ...], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By mask: sorted hashes with the piece and place of each."""
        made = defaultdict(list)
        for piece, codes in enumerate(self.words):
            for mask in seed_masks(min(overlap, len(codes)), similarity):
                hashes = seed_hashes(codes, mask)
                made[mask].append((hashes, np.full(len(hashes), piece), np.arange(len(hashes))))
        seeds = {}
        for mask, parts in made.items():
            hashes, pieces, places = (np.concatenate(part) for part in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            seeds[mask] = hashes[order], pieces[order], places[order]
        return seeds


def seed_hashes(codes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the selected words of every window."""
    count = max(0, len(codes) - mask[-1])
    hashes = np.zeros(count, dtype=np.uint64)
    for place in mask:
        hashes = (hashes ^ codes[place : place + count]) * FACTOR
        hashes ^= hashes >> np.uint64(29)
    return hashes


def blocks_of(items: Iterator, block_words: int, overlap: int = OVERLAP) -> Iterator[Block]:
    """The benchmark, a bounded number of words at a time."""
    block = Block()
    for item in items:
        words = words_of(item.text.encode() if item.text else None)
        if not words:
            continue
        for start in range(0, max(1, len(words) - overlap), PIECE_WORDS):
            piece = words[start : start + PIECE_WORDS + overlap]
            if block.size and block.size + len(piece) > block_words:
                yield block
                block = Block()
            block.add(item.item_id, start, piece)
    if block.size:
        yield block


class Searcher:
    """Finds passages of one block in documents."""

    def __init__(self, block: Block, overlap: int, similarity: float) -> None:
        self.block, self.overlap, self.similarity = block, overlap, similarity
        self.seeds = block.seeds(overlap, similarity)
        self.slots = {}
        for mask, (hashes, _, _) in self.seeds.items():
            taken = np.zeros(SLOTS, dtype=bool)
            taken[(hashes % np.uint64(SLOTS)).astype(np.int64)] = True
            self.slots[mask] = taken

    def alignments(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Pieces and shifts at which a seed of the piece stands in the document."""
        found = np.empty(0, dtype=np.int64)
        known = codes != 0
        # A piece and a shift in one number; shifts run from minus a piece's length up.
        least, width = -PIECE_WORDS - self.overlap, len(codes) + PIECE_WORDS + self.overlap + 1
        for mask, (hashes, pieces, places) in self.seeds.items():
            if len(codes) <= mask[-1] or not known.any():
                continue
            mine = seed_hashes(codes, mask)
            likely = np.flatnonzero(self.slots[mask][(mine % np.uint64(SLOTS)).astype(np.int64)])
            low = np.searchsorted(hashes, mine[likely], "left")
            times = np.searchsorted(hashes, mine[likely], "right") - low
            hit = times > 0
            likely, low, times = likely[hit], low[hit], times[hit]
            portion = np.cumsum(times) // HITS_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), len(likely)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                some = times[start:end]
                where = np.repeat(likely[start:end], some)
                nth = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                row = np.repeat(low[start:end], some) + nth
                found = np.union1d(found, pieces[row] * width + (where - places[row] - least))
        return [(pair // width, pair % width + least) for pair in found.tolist()]

    def overlap_at(self, codes: np.ndarray, piece: int, shift: int) -> tuple[int, ...] | None:
        """Place in the document, in the item, and equal words, if enough are equal in a window."""
        item = self.block.words[piece]
        first, last = max(0, -shift), min(len(item), len(codes) - shift)
        need = min(self.overlap, len(item))
        if last - first < need:
            return None
        equal = np.concatenate([[0], np.cumsum(item[first:last] == codes[first + shift : last + shift])])
        alike = np.flatnonzero(equal[need:] - equal[:-need] >= equal_words(need, self.similarity))
        if not len(alike):
            return None
        start, end = int(alike[0]), int(alike[-1]) + need
        offset = self.block.offsets[piece] + first
        return (
            start + first + shift, end + first + shift, start + offset, end + offset,
            int(equal[end] - equal[start]),
        )

    def passages(self, text: bytes | None) -> list[tuple]:
        """The longest overlap with each item: id, place in both, equal words."""
        words = words_of(text)
        codes = np.fromiter((self.block.vocabulary.get(word, 0) for word in words), np.uint64, len(words))
        best: dict[int | None, tuple] = {}
        for piece, shift in self.alignments(codes):
            span = self.overlap_at(codes, piece, shift)
            if span:
                item = self.block.ids[piece]
                best[item] = max(best.get(item, span), span, key=lambda s: (s[-1], -s[0], -s[2]))
        return [(item, *span) for item, span in best.items()]


def passages_of(text: Column, handle, overlap: int, similarity: float) -> Column:
    """The passages of one block in a text column, as an array."""

    names = [part.split()[0] for part in FOUND.split(", ")]
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))

    @F.arrow_udf(f"array<struct<{FOUND.replace(' long', ':long')}>>")
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher = Searcher(Block(*handle.value), overlap, similarity)
        for texts in parts:
            passages = map(searcher.passages, texts_of(texts))
            yield pa.array([[dict(zip(names, p, strict=True)) for p in some] for some in passages], kind)

    return found(text)


def benchmark_blocks(benchmark: DataFrame, block_words: int, overlap: int) -> Iterator[Block]:
    """Blocks of the benchmark, one in memory; texts that repeat count once, under their smallest id."""
    items = benchmark.groupBy(F.col("text").cast("string").alias("text")).agg(
        F.min("item_id").alias("item_id")
    )
    return blocks_of(items.toLocalIterator(), block_words, overlap)


def sent(docs: DataFrame, block: Block):
    """The handle of a block that goes out to all tasks."""
    return docs.sparkSession.sparkContext.broadcast(
        (block.ids, block.offsets, block.words, block.vocabulary)
    )


def longest_of_blocks(passages: DataFrame) -> DataFrame:
    """One row per row of the documents and item, as an item may stand in several blocks.

    Rows that repeat have equal passages in each block, so as many stay as there were.
    """
    keys = ["doc_id", "text_hash", "item_id"]
    rank = F.struct("n_equal", -F.col("doc_start"), -F.col("item_start"))
    names = [part.split()[0] for part in FOUND.split(", ")[1:]]
    return (
        passages.groupBy(*keys, "block")
        .agg(F.max(rank).alias("rank"), F.first(F.struct(*names)).alias("at"), F.count("*").alias("times"))
        .groupBy(keys)
        .agg(F.max_by(F.struct("at", "times"), "rank").alias("best"))
        .select(*keys, "best.at.*", F.explode(F.sequence(F.lit(1), "best.times")).alias("copy"))
        .drop("copy")
    )


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    overlap: int = OVERLAP,
    similarity: float = SIMILARITY,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents and the benchmark items that they hold a passage of.

    A passage is ``overlap`` words in a row (all words of a shorter item) of which a
    share of ``similarity`` equals those of the item, place by place; items of fewer
    than ``EXACT_BELOW`` words must be equal in all. One row for each row of ``docs``
    and item: ``doc_id``, ``item_id``, where the passage stands in both (words from 0,
    end exclusive; from the first alike window to the last along the best alignment)
    and ``n_equal`` words. Words are compared in lower case, without marks. Null and
    empty texts hold none, null and empty items are in none; of items with equal texts
    the smallest id counts. A document without passages and an empty table give no
    rows. A benchmark of one block is searched when the result is read; one of several
    is searched at once, block by block, and only passages are written.
    """
    slim = documents_of(docs).withColumn("text_hash", F.xxhash64("text"))
    blocks = benchmark_blocks(benchmark, block_words, overlap)
    block, passages, number = next(blocks, None), None, 0
    while block:
        handle, after = sent(docs, block), next(blocks, None)
        found = slim.withColumn(
            "at", F.explode(passages_of(F.col("text"), handle, overlap, similarity))
        ).select("doc_id", "text_hash", F.lit(number).alias("block"), "at.*")
        if after or number:
            found = materialise(found)
            handle.destroy()
        passages = passages.unionByName(found) if passages else found
        block, number = after, number + 1
    if passages is None:
        nothing = [F.lit(None).cast("long").alias(part.split()[0]) for part in FOUND.split(", ")]
        return slim.limit(0).select("doc_id", *nothing)
    return (longest_of_blocks(passages) if number > 1 else passages.drop("block")).drop("text_hash")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, similarity: float = SIMILARITY,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns.

    Repeated rows stay or go together; null and empty texts stay, and all rows where the
    benchmark is empty. Every ``BLOCKS_IN_A_PASS`` blocks what is left is written down.
    """
    clean, name = docs, free_name(docs, "contaminated")
    handles = []
    for block in benchmark_blocks(benchmark, block_words, overlap):
        if len(handles) == BLOCKS_IN_A_PASS:
            clean = materialise(clean)
            for handle in handles:
                handle.destroy()
            handles = []
        handles.append(sent(docs, block))
        found = passages_of(F.col("text").cast("string"), handles[-1], overlap, similarity)
        clean = clean.withColumn(name, found).filter(F.size(name) == 0).drop(name)
    return clean
