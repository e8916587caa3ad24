"""Near-duplicates by SimHash fingerprints, searched in BK-trees.

A fingerprint is the bitwise majority of the hashes of a text's shingles. Two
fingerprints that differ in at most ``distance`` bits agree in all but ``distance``
of any number of bands, so a tree is built for each value of each choice of that many
bands, and only fingerprints with that value search it: what a task holds depends on
a shard, not on the corpus. Large corpora take more bands, whose shards are smaller.
A shard with more than ``TREE_SIZE`` fingerprints is dealt to
several trees, and its fingerprints search each of them, so a large group of near
copies spreads over tasks as well. Every tree is shipped by the shuffle to the one
task that needs it; broadcasting all of them would grow with the corpus.
"""

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations, islice, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import documents_of, free_name, key_to_id, row_key
from fieldwatch.llm.components import components
from fieldwatch.session import materialise

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints in one tree at most. Splits work, never drops any.
TREE_SIZE = 1024
BITS = 64
HASHES_AT_ONCE = 255 * 256
LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set.

    One bit of each byte at a time: 255 numbers add up without a carry between bytes.
    """
    padded = np.zeros(-(-len(hashes) // 255) * 255, dtype=np.uint64)
    padded[: len(hashes)] = hashes
    rows = padded.reshape(-1, 255)
    counts = np.empty((8, 8), dtype=np.int64)
    for bit in range(8):
        lanes = ((rows >> np.uint64(bit)) & LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(BITS)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text in UTF-8, unsigned; zero for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    count = max(1, len(words) - shingle + 1)
    lasts = islice(ends, min(shingle, len(words)) - 1, None)
    pieces = (joined[start : end - 1] for start, end in zip([0, *ends], lasts, strict=False))
    hashes = map(xxhash.xxh64_intdigest, pieces, repeat(SEED))
    set_bits = np.zeros(BITS, dtype=np.int64)
    for done in range(0, count, HASHES_AT_ONCE):
        some = min(HASHES_AT_ONCE, count - done)
        set_bits += bit_counts(np.fromiter(islice(hashes, some), np.uint64, some))
    return sum(1 << bit for bit in np.flatnonzero(2 * set_bits > count).tolist())


def fingerprint_of(text: Column | str, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column, as a signed long."""

    @F.arrow_udf("long")
    def made(texts: pa.Array) -> pa.Array:
        values = [fingerprint(text, shingle) for text in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return made(text)


class BKTree:
    """Numbers under integer Hamming distance; a child hangs on its distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node, new = 0, len(self.values)
        while new:
            apart = (self.values[node] ^ value).bit_count()
            if apart not in self.children[node]:
                self.children[node][apart] = new
                break
            node = self.children[node][apart]
        self.values.append(value)
        self.children.append({})

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all values within ``radius``, along edges that can lead there."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            apart = (self.values[node] ^ value).bit_count()
            if apart <= radius:
                found.append(node)
            children = self.children[node]
            if len(children) <= 2 * radius:
                open_nodes += [to for edge, to in children.items() if -radius <= edge - apart <= radius]
            else:
                open_nodes += [
                    children[edge]
                    for edge in range(apart - radius, apart + radius + 1)
                    if edge in children
                ]
        return found


class Shard:
    """A tree of at most its members' size, and which of them are linked so far."""

    def __init__(self) -> None:
        self.tree = BKTree()
        self.parent: list[int] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def links(self, value: int, radius: int, member: bool) -> Iterator[tuple[int, int]]:
        """Links of one more fingerprint, without those that close a circle.

        A member joins the tree; a visitor only links those that it is near to, and is
        forgotten.
        """
        mine: int | None = None
        for place in self.tree.near(value, radius):
            there = self.root(place)
            if mine is None or there != mine:
                yield value, self.tree.values[place]
            if mine is not None:
                self.parent[there] = mine
            else:
                mine = there
        if member:
            self.parent.append(len(self.parent) if mine is None else mine)
            self.tree.add(value)


def search_shards(radius: int):
    """Walk rows sorted by shard, tree and role, a row at a time."""

    def signed(values: list[int]) -> pa.Array:
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = Shard(), None
        for batch in batches:
            keys = zip(*(batch.column(name).to_pylist() for name in ("band", "part", "tree")), strict=True)
            values = batch.column("print").to_numpy().view(np.uint64).tolist()
            a, b = [], []
            for key, value, visits in zip(keys, values, batch.column("visits").to_pylist(), strict=True):
                if key != now:
                    shard, now = Shard(), key
                for one, other in shard.links(value, radius, not visits):
                    a.append(one)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([signed(a), signed(b)], ["a", "b"])

    return search


def band_masks(bands: int, distance: int) -> list[int]:
    """The bits, as signed longs, of every choice of all but ``distance`` of the bands."""
    bounds = [BITS * i // bands for i in range(bands + 1)]
    bits = [(1 << high) - (1 << low) for low, high in zip(bounds[:-1], bounds[1:], strict=True)]
    masks = [sum(chosen) for chosen in combinations(bits, bands - distance)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def bands_for(prints: int, distance: int, tree_size: int = TREE_SIZE) -> int:
    """The number of bands with the fewest searches: all find the same links.

    A fingerprint searches its own tree and half of the others of each of its shards.
    """

    def searches(bands: int) -> float:
        shard = prints / 2.0 ** (BITS * (bands - distance) / bands)
        return comb(bands, distance) * (1 + shard / tree_size / 2)

    return min(range(distance + 1, min(BITS, distance + 8) + 1), key=searches)


def fingerprint_links(
    prints: DataFrame,
    distance: int = DISTANCE,
    tree_size: int = TREE_SIZE,
    bands: int | None = None,
) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints at ``distance`` or fewer bits.

    ``prints`` has one long column ``print`` of distinct values. Of the links in a
    tree, those that would close a circle are left out, so there are fewer than
    searches; the components are those of all links, for any number of ``bands``
    above ``distance``. Without it the number follows from that of the fingerprints.
    """
    if not 0 <= distance < BITS:
        raise ValueError("distance must be from 0 to 63")
    bands = bands or bands_for(prints.count(), distance, tree_size)
    keys = [
        F.struct(F.lit(i).alias("band"), F.col("print").bitwiseAND(F.lit(mask)).alias("part"))
        for i, mask in enumerate(band_masks(bands, distance))
    ]
    banded = prints.select("print", F.explode(F.array(*keys)).alias("at")).select(
        "print", "at.band", "at.part"
    )
    shared = (
        banded.groupBy("band", "part")
        .agg(F.count("*").alias("size"))
        .filter("size > 1")
        .withColumn("trees", F.ceil(F.col("size") / tree_size).cast("int"))
    )
    own = F.pmod(F.xxhash64("print", F.lit("tree")), F.col("trees")).cast("int")
    dealt = (
        banded.join(shared, ["band", "part"])
        .withColumn("own", own)
        .select("band", "part", "print", "own", F.explode(F.sequence(F.lit(0), "own")).alias("tree"))
        .select("band", "part", "tree", "print", (F.col("tree") != F.col("own")).alias("visits"))
    )
    return (
        dealt.repartition("band", "part", "tree")
        .sortWithinPartitions("band", "part", "tree", "visits", "print")
        .mapInArrow(search_shards(distance), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, tree_size: int = TREE_SIZE
) -> DataFrame:
    """Fingerprint and near-duplicate component of every document.

    Returns ``doc_id``, ``key`` (the id, or a number from the text where there is
    none), ``print`` (signed) and ``component`` (smallest key reachable), one row for
    each row of ``docs``, repeated rows included. Null and empty texts have
    fingerprint zero and are linked like any other. An empty table gives none.
    """
    rows = materialise(
        documents_of(docs).select(
            "doc_id", row_key().alias("key"), fingerprint_of(F.col("text"), shingle).alias("print")
        )
    )
    first = materialise(rows.groupBy("print").agg(F.min("key").alias("first")))
    links = fingerprint_links(first.select("print"), distance, tree_size)
    roots = components(links)
    member = first.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    least = member.groupBy("root").agg(F.min("first").alias("component"))
    group = member.join(least, "root").select(F.col("print").alias("__print"), "component")
    return rows.join(group, F.col("print") == F.col("__print")).drop("__print")


def component_ids(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` in hex and ``component_id``, null if no member has an id."""
    return near_duplicates(docs, shingle, distance).select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        key_to_id(F.col("component")).alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The document with the smallest id of each component, all its columns.

    Of rows that repeat an id, one stays. Where no document of a component has an
    id, one of them stays.
    """
    chosen = (
        near_duplicates(docs, shingle, distance)
        .filter(F.col("key") == F.col("component"))
        .select(F.col("key").alias("__chosen"))
        .distinct()
    )
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, row_key())
    kept = keyed.join(chosen, F.col(key) == F.col("__chosen")).drop("__chosen")
    return kept.dropDuplicates([key]).drop(key)
