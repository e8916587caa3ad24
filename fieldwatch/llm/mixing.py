"""Mixing sources to target weights by pivotal rounding.

A source's documents are taken at one rate, its target over its size. The whole
part of the rate is the number of copies all of them get; the fraction is the
probability of one more. Two documents at a time settle their fractions: a random
share of words moves from one to the other until one of them is taken or left.
Words are preserved in every step, so a source misses its target by less than its
last document. Blocks of documents settle first; the one document that each leaves
open goes up a tree of blocks, so no task ever holds a source.
"""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldwatch.llm.words import sorted_groups, texts_of
from fieldwatch.session import materialise

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 7
#: Documents of a block, and blocks under one node of the tree, on average.
BLOCK_ROWS = 256
#: More sources than these are joined by shuffle.
BROADCAST_SOURCES = 2_000
SMALLEST = 1e-9
WORD = (1 << 64) - 1


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    """Words between ASCII white space; none for null."""
    return pa.array([len((text or b"").split()) for text in texts_of(texts)], pa.int64())


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, from 0 in code point order, null last; sorted in parts."""
    order = F.col("source").asc_nulls_last()
    numbered = materialise(
        sources.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("row", F.monotonically_increasing_id())
    )
    # Fixed layout of this function: the part above, the row in it in the low 33 bits.
    rows = numbered.withColumn("part", F.shiftright("row", 33)).withColumn(
        "row", F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy("part")
        .agg(F.count("*").alias("size"))
        .withColumn("first", F.coalesce(F.sum("size").over(before), F.lit(0)))
    )
    place = (F.col("first") + F.col("row")).alias("place")
    return rows.join(parts.select("part", "first"), "part").select(*sources.columns, place)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source``, ``rows``, ``source_size`` and ``target`` of every source.

    The level is raised until all words are shared out; sources at their limit stay there.
    """
    sources = sizes.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum("size").alias("source_size")
    )
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weighed = materialise(
        ranked(sources)
        .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("limit", (F.col("source_size") * most).cast("double"))
        .drop("place")
    )
    total = weighed.agg(F.sum("source_size")).head()[0] or 0
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("limit")
        at_limit, open_weight, now_full = weighed.agg(
            F.sum(F.when(over, F.col("limit"))),
            F.sum(F.when(~over, F.col("weight"))),
            F.count(F.when(over, 1)),
        ).head()
        if now_full == full or not open_weight:
            break
        level, full = (total - (at_limit or 0.0)) / open_weight, now_full
    share = F.least(F.col("weight") * F.lit(level), F.col("limit"))
    return weighed.select("source", "rows", "source_size", share.alias("target"))


def chance(*parts: int) -> float:
    """A number from 0 to 1 that depends on ``parts`` alone."""
    state = 0
    for part in parts:
        # The constants of the splitmix64 generator.
        state = (state + part + 0x9E3779B97F4A7C15) & WORD
        state = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & WORD
        state = ((state ^ (state >> 27)) * 0x94D049BB133111EB) & WORD
        state ^= state >> 31
    return (state >> 11) / (1 << 53)


def settle(p: float, size: int, q: float, other: int, draw: float) -> tuple[float, float]:
    """Move words between two fractions until one is 0 or 1; each keeps its expected value."""
    to_first = min((1 - p) * size, q * other)
    to_second = min(p * size, (1 - q) * other)
    moved = to_first if draw * (to_first + to_second) < to_second else -to_second
    return snapped(p + moved / size), snapped(q - moved / other)


def snapped(p: float) -> float:
    return 0.0 if p < SMALLEST else 1.0 if p > 1 - SMALLEST else p


def settle_blocks(seed: int, last: bool):
    """Settle the open documents of each block in turn; the last level leaves none open."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        schema = None

        def closed(row: dict) -> dict:
            return row | {"copies": row["copies"] + int(row["open"]), "open": 0.0}

        def left(row: dict) -> dict:
            if last:
                row["open"] = float(chance(seed, row["tie"]) < row["open"])
            return closed(row) if row["open"] in (0.0, 1.0) else row

        for new_block, rows in sorted_groups(batches, ["source", "block"]):
            schema, out = rows.schema, []
            if new_block and held:
                out.append(left(held))
                held = None
            for row in rows.to_pylist():
                row["open"] = snapped(row["open"])
                if row["open"] not in (0.0, 1.0) and held:
                    draw = chance(seed, held["tie"], row["tie"])
                    held["open"], row["open"] = settle(
                        held["open"], held["size"], row["open"], row["size"], draw
                    )
                    if held["open"] in (0.0, 1.0):
                        out.append(closed(held))
                        held = None
                if row["open"] in (0.0, 1.0):
                    out.append(closed(row))
                else:
                    held = row
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist([left(held)], schema)

    return run


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """How often the mix takes each document.

    Sources in code point order, null last, weigh ``weights`` in turn and share all
    words; none gets more than ``most_copies`` times its own. Returns one row for each
    row of ``docs``: ``doc_id``, ``source``, ``size`` in words, ``source_size``,
    ``target``, ``copies`` and ``taken`` words. Null and empty texts have size 0 and
    take no part in the rounding. Reruns give the same; rows that repeat id, source
    and size may swap their copies. An empty table gives no rows.
    """
    sizes = materialise(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text").cast("string")).alias("size"),
        )
    )
    targets = materialise(source_targets(sizes, weights, most_copies))
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    named = targets.withColumnRenamed("source", "__source")
    joined = sizes.join(
        F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("__source"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = F.least(rate, F.lit(float(most_copies)))
    tie = F.xxhash64("doc_id", "size", "source").bitwiseAND(F.lit((1 << 63) - 1))
    blocks = F.ceil(F.col("rows") / block_rows)
    open_rows = joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.floor(rate).cast("long").alias("copies"),
        F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0).alias("open"),
        tie.alias("tie"),
        F.pmod(tie, blocks).alias("block"),
        blocks.alias("blocks"),
    )
    wide = targets.agg(F.max(F.ceil(F.col("rows") / block_rows))).head()[0] or 1
    settled = []
    last = False
    while not last:
        last = wide == 1
        level = open_rows.drop("blocks")
        done = materialise(
            level.repartition("source", "block")
            .sortWithinPartitions("source", "block", F.desc("size"), "tie")
            .mapInArrow(settle_blocks(seed + len(settled), last), nullable(level.schema))
        )
        settled.append(done.filter("open = 0"))
        wide = -(-wide // block_rows)
        open_rows = done.filter("open > 0").select(
            *[name for name in done.columns if name != "block"],
            F.floor(F.col("block") / block_rows).alias("block"),
            F.lit(0).alias("blocks"),
        )
    mixed = settled[0]
    for more in settled[1:]:
        mixed = mixed.unionByName(more)
    return mixed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
