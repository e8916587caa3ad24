"""Prefix trie of conversations, with subtree totals rolled up in bands of depths.

A node is a distinct sequence of first turns. Conversations are numbered over even,
range-partitioned parts, so that one of any length is cut up, and their turns are cut
into bands of ``BAND`` depths. A node's id is a hash of the turns of its band and of the
band's start, and a start is the id of a prefix of whole bands: the same function one
level up, on a sequence ``BAND`` times shorter.

Totals take the same levels. A node explodes to its ancestors inside its band only, at
most ``BAND`` rows. That gives totals within bands; the roots of all bands are a tree
``BAND`` times less deep, whose totals the same rollup completes, and completed totals of
band roots are then added to the ancestors within the band above. So there are as many
rounds as the depth has digits to the base ``BAND``.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.llm.words import sorted_groups
from fieldwatch.session import materialise

BAND = 16
#: Conversations share the head of the one whose id is the last multiple
#: of ``FAMILY``, at most ``LONGEST_HEAD`` turns of it.
FAMILY, LONGEST_HEAD = 20, 3
WORD = r"[^\x20\x09-\x0D]+"
ROOT = ""
#: Neighbouring ids (two to this power) whose decimals are joined before they are hashed.
JOINED = 16


def short_hash(text: Column) -> Column:
    """128 bits of SHA-256, in hex."""
    return F.left(F.sha2(text, 256), F.lit(32))


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in ordered parts, and where each conversation's rows in a part begin.

    The first has ``conv``, ``digest`` of role and text, ``words``, ``part`` and ``pos``;
    the second ``conv``, ``part``, ``start`` (first ``pos``), ``earlier`` rows of the
    conversation in parts before, and all its rows as ``total``. Turns of the same number
    are ordered by their digest. No step gathers a conversation.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = short_hash(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    thin = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "digest"]
    # Equal rows are interchangeable; their input task lets many copies be cut too.
    ranged = thin.withColumn("origin", F.spark_partition_id()).repartitionByRange(*order, "origin")
    placed = ranged.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    turns = materialise(
        placed.select(
            "conv", "digest", "words",
            F.shiftright("place", 33).cast("int").alias("part"),
            F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("pos"),
        )
    )
    parts = Window.partitionBy("conv").orderBy("part")
    spans = (
        turns.groupBy("conv", "part")
        .agg(F.min("pos").alias("start"), F.count("*").alias("here"))
        .withColumn("earlier", F.coalesce(F.sum("here").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", F.sum("here").over(Window.partitionBy("conv")))
        .drop("here")
    )
    return turns, materialise(spans)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of all rebuilt conversations, and the conversations.

    A conversation takes the first ``crc32 of its decimal id % 4`` turns of the one whose
    id is the last multiple of 20 (of smaller size, for negative ids), then its own after
    as many. Returns ``conv``, ``depth`` from 1, ``digest``, ``words``, ``turns``, and
    ``conv`` with its ``turns``.
    """
    turns, spans = numbered_turns(conversations)
    at = F.col("pos") - F.col("start") + F.col("earlier")
    base = F.col("conv") - F.col("conv") % FAMILY
    heads = (
        turns.filter(F.col("conv") == base)
        .join(spans.filter(F.col("earlier") < LONGEST_HEAD), ["conv", "part"])
        .withColumn("at", at)
        .filter(F.col("at") < LONGEST_HEAD)
        .groupBy(F.col("conv").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("head"))
    )
    wanted = (F.crc32(F.encode(F.col("conv").cast("string"), "utf-8")) % (LONGEST_HEAD + 1)).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("wanted")), F.expr("array()").cast(heads.schema["head"].dataType))
    families = materialise(
        spans.filter("earlier = 0")
        .select("conv", "total", base.alias("base"), wanted.alias("wanted"))
        .join(heads, "base", "left")
        .withColumn("head", head)
        .withColumn("taken", F.size("head"))
        .withColumn("turns", F.col("taken") + F.greatest(F.col("total") - F.col("wanted"), F.lit(0)))
        .drop("base", "total")
    )
    borrowed = families.select("conv", "turns", F.posexplode("head").alias("place", "turn")).select(
        "conv", (F.col("place") + 1).cast("long").alias("depth"), "turn.digest", "turn.words", "turns"
    )
    own = (
        turns.join(spans.join(families.drop("head"), "conv"), ["conv", "part"])
        .filter(at >= F.col("wanted"))
        .select("conv", (at - F.col("wanted") + F.col("taken") + 1).alias("depth"), "digest", "words", "turns")
    )
    return borrowed.unionByName(own), families.select("conv", "turns")


def with_starts(bands: DataFrame) -> DataFrame:
    """Bands (``conv``, ``band`` from 0, array ``digests``) with their nodes' ``ids``.

    An id is a hash of the band's start and its digests so far. A band's start is the id
    of the sequence of whole bands before it.
    """
    whole = bands.filter(F.size("digests") == BAND).select(
        "conv",
        (F.col("band") + 1).alias("depth"),
        short_hash(F.array_join("digests", "")).alias("digest"),
    )
    first = bands.filter("band = 0").withColumn("start", F.lit(ROOT))
    later = bands.filter("band > 0")
    if not later.isEmpty():
        above = with_starts(banded(whole))
        starts = above.select(
            "conv", "band", F.posexplode("ids").alias("place", "start")
        ).select("conv", (F.col("band") * BAND + F.col("place") + 1).alias("band"), "start")
        first = first.unionByName(later.join(starts, ["conv", "band"]))
    ids = F.transform(
        F.sequence(F.lit(1), F.size("digests")),
        lambda i: short_hash(F.concat("start", F.array_join(F.slice("digests", F.lit(1), i), ""))),
    )
    return materialise(first.withColumn("ids", ids).drop("start", "digests"))


def banded(rows: DataFrame, *others: str) -> DataFrame:
    """Rows (``conv``, ``depth`` from 1, ``digest``) as arrays of at most ``BAND``."""
    band = F.expr(f"(depth - 1) div {BAND}")
    kept = [F.first(name).alias(name) for name in others if name != "words"]
    items = F.sort_array(F.collect_list(F.struct("depth", "digest", *[n for n in others if n == "words"])))
    grouped = rows.groupBy("conv", band.alias("band")).agg(items.alias("items"), *kept)
    arrays = [F.col("items.digest").alias("digests")]
    arrays += [F.col("items.words").alias("words")] if "words" in others else []
    return grouped.select("conv", "band", *arrays, *[name for name in others if name != "words"])


def node_rows(bands: DataFrame) -> DataFrame:
    """Every conversation at every depth: the node that it passes and that node's parent."""
    ends = bands.filter(F.size("ids") == BAND).select(
        "conv", (F.col("band") + 1).alias("band"), F.element_at("ids", -1).alias("before")
    )
    first = bands.filter("band = 0").withColumn("before", F.lit(ROOT))
    linked = first.unionByName(bands.filter("band > 0").join(ends, ["conv", "band"]))
    at = F.posexplode(F.arrays_zip("ids", "words")).alias("place", "node")
    rows = linked.select("conv", "band", "turns", "before", "ids", at)
    return rows.select(
        "conv",
        F.col("node.ids").alias("id"),
        F.col("node.words").alias("words"),
        (F.col("band") * BAND + F.col("place") + 1).alias("depth"),
        F.when(F.col("place") == 0, F.col("before"))
        .otherwise(F.get("ids", F.col("place") - 1))
        .alias("parent"),
        (F.col("band") * BAND + F.col("place") + 1 == F.col("turns")).alias("ends"),
    )


def rolled_up(nodes: DataFrame, bands: DataFrame, deepest: int) -> DataFrame:
    """Totals of ``leaves`` and ``saved`` over the subtree of every node.

    ``nodes`` has ``id``, a conversation ``conv`` that passes it, its ``depth`` from 1 and
    own values; ``bands`` has the ids that conversations pass.
    """
    at = F.col("depth") - 1
    own = nodes.withColumns({"band": F.expr(f"(depth - 1) div {BAND}"), "place": (at % BAND).cast("int")})
    passed = bands.select("conv", "band", "ids")
    inside = own.join(passed, ["conv", "band"]).select(
        F.explode(F.slice("ids", F.lit(1), F.col("place") + 1)).alias("id"), "leaves", "saved"
    )

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    within = materialise(summed(inside))
    if deepest <= BAND:
        return within
    roots = own.filter("place = 0").select("id", "conv", (F.col("band") + 1).alias("depth")).join(within, "id")
    path = bands.select("conv", (F.col("band") + 1).alias("depth"), F.col("ids")[0].alias("digest"))
    up = banded(path).withColumnRenamed("digests", "ids")
    complete = rolled_up(roots, up, -(-deepest // BAND))
    # The band above a band root is whole, and the root's conversation passes all of it.
    under = roots.filter("depth > 1").select("id", "conv", (F.col("depth") - 2).alias("band"))
    given = under.join(complete, "id").drop("id").join(passed, ["conv", "band"])
    return summed(within.unionByName(given.select(F.explode("ids").alias("id"), "leaves", "saved")))


def hash_joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each id's pieces in order, with commas between them."""

    def row(name: str, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()])], ["id", "ends_sha256"])

    now, digest = None, None
    for new, batch in sorted_groups(batches, ["id"]):
        if new:
            if digest:
                yield row(now, digest)
            now, digest = batch.column("id")[0].as_py(), hashlib.sha256()
        for place, piece in enumerate(batch.column("piece").to_pylist()):
            digest.update((("" if new and place == 0 else ",") + piece).encode())
    if digest:
        yield row(now, digest)


def ends_hashed(ends: DataFrame) -> DataFrame:
    """``id`` and the hash of the ids of conversations that end there.

    Neighbouring ids are joined first, at most 65,536 in a group; a hash over many ids
    has to be taken in turn, so a task reads a node's pieces one by one.
    """
    block = F.shiftright("conv", JOINED)
    numbers = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = ends.groupBy("id", block.alias("block")).agg(F.array_join(numbers, ",").alias("piece"))
    return pieces.repartition("id").sortWithinPartitions("id", "block").select("id", "piece").mapInArrow(
        hash_joined, "id string, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations.

    Rows without ``conv_id`` belong to no conversation. Turns are ordered by ``turn``,
    null first, equal ones by a hash of role and text; null roles and texts are empty,
    repeated rows are turns like any other. Returns ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. An empty table has no nodes, not even a root.
    """
    turns, families = rebuilt_turns(conversations)
    bands = with_starts(banded(turns, "words", "turns"))
    passes = materialise(node_rows(bands))
    counted = passes.groupBy("id", "depth", "parent", "words").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs")
    )
    nodes = materialise(counted)
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    grown = materialise(
        nodes.join(children, "id", "left")
        .withColumn("leaves", F.col("n_children").isNull().cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    )
    deepest = grown.agg(F.max("depth")).head()[0] or 0
    totals = rolled_up(grown.select("id", "conv", "depth", "leaves", "saved"), bands, deepest)
    whole = grown.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    members = families.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    # Both sides are one row.
    root = materialise(
        members.join(F.broadcast(whole), F.lit(True)).select(
            F.lit(ROOT).alias("id"),
            F.lit(0).cast("long").alias("depth"),
            F.lit(None).cast("string").alias("parent"),
            "conv",
            "n_convs",
            "n_children",
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        )
    )
    below = grown.drop("leaves", "saved", "words").join(
        totals.select("id", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), "id"
    )
    trie = below.unionByName(root)
    names = grown.select("id", "conv").unionByName(root.select("id", "conv"))
    parents = names.select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv_id"))
    ends = passes.filter("ends").select("id", "conv").unionByName(
        families.filter("turns = 0").select(F.lit(ROOT).alias("id"), "conv")
    )
    return (
        trie.join(ends_hashed(ends), "id", "left")
        .join(parents, "parent", "left")
        .select(
            F.col("conv").alias("conv_id"),
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_leaves").cast("long").alias("n_leaves"),
            F.col("saved_tokens").cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
