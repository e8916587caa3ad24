"""WARC archives: written by Spark's text writer, read back by boundary chains.

A record is a header, an empty line, its payload and two line ends. Spark cuts the
archives at every ``WARC/1.0`` line, also at those inside payloads, and in parallel
within a file. Each cut is a candidate record; its header says where the next one must
begin. Pointer jumping from the start of a file, in a number of rounds that grows with
the logarithm of its records, keeps the candidates that the file's own chain reaches.
"""

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldwatch.session import materialise

MAGIC = "WARC/1.0\r\n"
LINE = "\r\n"
END = "\r\n\r\n"
#: Smaller payloads are stored each time.
LEAST_REVISIT = 1000
#: More payloads that repeat than these are joined by shuffle.
BROADCAST_PAYLOADS = 10_000
#: Fixed value: the name of the rule by which a revisit record stands for its response.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def bytes_of(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:sha1:"), F.sha1(F.concat_ws(":", page_id, digest)), F.lit(">"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write a record for every row of ``pages`` (``page_id``, ``url``, ``html``) to ``folder``.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes, the row with the largest
    ``page_id`` is the response and the others revisit it; rows that repeat that id are
    responses too, as are all where no row has an id. A null payload is empty.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("size", bytes_of(F.col("payload")))
    repeated = materialise(
        rows.filter(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .drop("times")
    )
    few = repeated.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS
    joined = rows.join(F.broadcast(repeated) if few else repeated, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    one_line = F.regexp_replace("url", r"[\r\n]+", " ")
    headers = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        ("WARC-Target-URI", one_line),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, record_id(F.col("first"), F.col("digest")))),
        ("X-Refers-To-Page", F.when(revisit, F.col("first").cast("string"))),
        ("X-Page", F.col("page_id").cast("string")),
        ("X-Payload-Length", F.col("size").cast("string")),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(revisit, "0").otherwise(F.col("size").cast("string"))),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in headers]
    head = F.concat(F.lit(MAGIC), *[F.coalesce(line, F.lit("")) for line in lines], F.lit(LINE))
    record = F.concat(head, F.when(revisit, "").otherwise(F.col("payload")))
    joined.select(record.alias("value")).write.option("lineSep", END).text(folder)


def pieces_of(spark: SparkSession, folder: str) -> DataFrame:
    """What stands after every ``WARC/1.0`` line: ``file``, ``split``, ``row`` and ``value``."""
    return spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def header(name: str) -> Column:
    """A header's value; null where the head has none."""
    found = F.regexp_extract(F.col("head"), rf"(?i)(?:^|\r\n){name}: ?([^\r\n]*)", 1)
    return F.when(F.col("head").rlike(rf"(?i)(?:^|\r\n){name}:"), found)


def candidates_of(pieces: DataFrame) -> DataFrame:
    """Every cut with its place in the file, its header and where the next record must begin.

    A file's pieces lie one after the other: a running sum inside a split gives places
    there, and one over the splits' totals those in the file.
    """
    value = F.col("value")
    head = F.substring_index(value, END, 1)
    slim = pieces.select(
        "file",
        "split",
        "row",
        (bytes_of(value) + len(MAGIC)).alias("length"),
        head.alias("head"),
        bytes_of(head).alias("head_length"),
        (value.contains(END)).alias("whole_head"),
        value,
    )
    size = header("Content-Length").cast("long")
    body = F.expr("substring(cast(value as binary), int(head_length + 5), int(size))")
    slim = slim.withColumn("size", size)
    in_piece = F.col("length") - len(MAGIC) >= F.col("head_length") + len(END) + F.col("size")
    slim = materialise(
        slim.select(
            "file", "split", "row", "length", "head_length", "whole_head", "size",
            header("WARC-Type").alias("record_type"),
            header("X-Page").cast("long").alias("page_id"),
            header("X-Refers-To-Page").cast("long").alias("refers_to"),
            header("X-Payload-Length").cast("long").alias("full_size"),
            F.regexp_replace(header("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
            F.when(in_piece, F.sha1(body)).alias("own_digest"),
            in_piece.alias("in_piece"),
        )
    )
    before = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        slim.groupBy("file", "split")
        .agg(F.sum("length").alias("total"))
        .withColumn("first", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        .drop("total")
    )
    placed = slim.withColumn("inside", F.coalesce(F.sum("length").over(before), F.lit(0))).join(
        splits, ["file", "split"]
    )
    at = F.col("first") + F.col("inside") - len(MAGIC)
    after = at + len(MAGIC) + F.col("head_length") + len(END) + F.col("size") + len(END)
    return (
        placed.withColumn("at", at)
        .withColumn("next", F.when(F.col("whole_head"), after))
        .filter("at >= 0")
        .drop("first", "inside")
    )


def reachable(candidates: DataFrame) -> DataFrame:
    """``file`` and ``at`` of the candidates on the chain that begins at a file's start."""
    state = materialise(candidates.select("file", "at", "next", (F.col("at") == 0).alias("reached")))
    most = state.groupBy("file").count().agg(F.max("count")).head()[0] or 1
    for _ in range(ceil(log2(most)) + 1):
        to = state.select("file", F.col("at").alias("next"), F.col("next").alias("jump"))
        ahead = state.join(to, ["file", "next"], "left")
        kept = ahead.select("file", "at", F.col("jump").alias("next"), "reached", F.lit(True).alias("real"))
        told = ahead.filter("reached and next is not null").select(
            "file",
            F.col("next").alias("at"),
            F.lit(None).cast("long").alias("next"),
            F.lit(True).alias("reached"),
            F.lit(False).alias("real"),
        )
        state = materialise(
            kept.unionByName(told)
            .groupBy("file", "at")
            .agg(F.max("next").alias("next"), F.max("reached").alias("reached"), F.max("real").alias("real"))
            .filter("real")
            .drop("real")
        )
    return state.filter("reached").select("file", "at")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in ``folder``, from their own headers and payloads.

    ``page_id``, ``payload_bytes`` and ``payload_digest`` of the full payload,
    ``record_type`` and ``refers_to``. The digest of a response is taken from its
    payload as read; that of a revisit, which has none, from its header.
    """
    pieces = pieces_of(spark, folder)
    candidates = materialise(candidates_of(pieces))
    records = candidates.join(reachable(candidates), ["file", "at"])
    if records.filter(~F.col("in_piece")).isEmpty():
        complete = records.withColumn("joined", F.lit(None).cast("string"))
    else:
        complete = records.join(digests_across(pieces, candidates, records), ["file", "at"], "left")
    response = F.col("record_type") == "response"
    return complete.select(
        "page_id",
        F.when(response, F.col("size")).otherwise(F.col("full_size")).alias("payload_bytes"),
        F.when(response, F.coalesce("own_digest", "joined")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def digests_across(pieces: DataFrame, candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Digests of payloads that hold a ``WARC/1.0`` line and so lie in several pieces.

    A piece belongs to the last record that begins at or before it. Only the text of
    such payloads is read again; a piece's split and row are those of the same scan.
    """
    real = records.select(
        "file", "at", F.struct("at", "in_piece", "head_length", "size").alias("record")
    )
    so_far = Window.partitionBy("file").orderBy("at")
    owned = (
        candidates.select("file", "at", "split", "row")
        .join(real, ["file", "at"], "left")
        .withColumn("record", F.last("record", ignorenulls=True).over(so_far))
        .filter(~F.col("record.in_piece"))
        .select("file", "split", "row", F.col("at").alias("piece_at"), "record.*")
    )
    parts = pieces.select("file", "split", "row", "value").join(owned.drop("in_piece"), ["file", "split", "row"])
    in_order = F.sort_array(F.collect_list(F.struct("piece_at", "value")))
    whole = F.array_join(F.transform(in_order, lambda piece: piece["value"]), MAGIC)
    joined = parts.groupBy("file", "at", "head_length", "size").agg(whole.alias("value"))
    body = F.expr("substring(cast(value as binary), int(head_length + 5), int(size))")
    return joined.select("file", "at", F.sha1(body).alias("joined"))


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` to archives in ``folder`` and read their records back."""
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
