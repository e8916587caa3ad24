"""Conversations from messages that quote each other.

Quoted passages are runs of lines at one quote level. Each is joined, by a hash of its
normalised text, to the latest earlier message of the thread that says the same in its
own words. The join is a walk over rows sorted by thread, hash and time: a range of the
order goes to each task, cut anywhere, and one row per range carries over what the next
must know. So a passage that half of all messages quote costs no more than others, and
no pairs are made. Pointer jumping then finds roots and depths of the replies.
"""

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from fieldwatch.session import materialise

MARKS = re.compile(r"(?:[ \t]?>)+ ?")
#: Turn numbers in one part of a conversation.
PART_TURNS = 4096
ATTRIBUTION = re.compile(r"\s*(?:on|am|le|el)\b.{0,200}\b(?:wrote|said|schrieb|écrit|escribió)\s?:\s*", re.I)


def quote_lines(text: str | None) -> Iterator[tuple[int, str]]:
    """Level and content of every line; an attribution before a quote belongs to no level."""
    lines = (text or "").split("\n") if text else []
    parsed = []
    for line in lines:
        marks = MARKS.match(line)
        level = marks[0].count(">") if marks else 0
        parsed.append((level, line[marks.end() :] if level else line))
    for i, (level, line) in enumerate(parsed):
        quotes_next = i + 1 < len(parsed) and parsed[i + 1][0] > level
        if not (quotes_next and ATTRIBUTION.fullmatch(line)):
            yield level, line


def passage_hash(lines: list[str]) -> int | None:
    """Of the words of a passage, in lower case and with single spaces; none without words."""
    normal = " ".join(" ".join(lines).casefold().split())
    if not normal:
        return None
    return xxhash.xxh64_intdigest(normal.encode()) - (1 << 63)


def parse(text: str | None) -> tuple[str, list[int], list[tuple[int, int]]]:
    """Own text, hashes of its passages, and level and hash of each quoted passage.

    Empty lines and changes of level end a passage.
    """
    own: list[str] = []
    said: list[int] = []
    quoted: list[tuple[int, int]] = []
    run: list[str] = []
    last = 0

    def close() -> None:
        hashed = passage_hash(run)
        if hashed is not None and last:
            quoted.append((last, hashed))
        elif hashed is not None:
            said.append(hashed)
        run.clear()

    for level, line in quote_lines(text):
        if level != last or not line.strip():
            close()
            last = level
        run.append(line)
        if not level:
            own.append(line)
    close()
    return "\n".join(own).strip("\n"), said, quoted


def parsed_of(text: Column) -> Column:
    @F.arrow_udf("struct<own:string,said:array<long>,quoted:array<struct<level:int,hash:long>>>")
    def parsed(texts: pa.Array) -> pa.Array:
        rows = [parse(text) for text in texts.to_pylist()]
        quoted = [[{"level": level, "hash": hashed} for level, hashed in row[2]] for row in rows]
        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
        return pa.StructArray.from_arrays(
            [
                pa.array([row[0] for row in rows], pa.string()),
                pa.array([row[1] for row in rows], pa.list_(pa.int64())),
                pa.array(quoted, kind),
            ],
            ["own", "said", "quoted"],
        )

    return parsed(text)


def latest(said: list[tuple[int, str]], more: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The two latest times with their last message; a quote needs the second if it is as late as the first."""
    by_time = dict([*said, *more])
    return list(by_time.items())[-2:]


def walk(carry: dict[int, list], summary: bool):
    """Go through sorted passages and remember the latest message that said the one at hand.

    ``summary`` gives one row per task: its first key, its last key, and who said that.
    Otherwise every quote comes with who said it, ``carry`` being what earlier tasks know.
    A message does not quote itself or one of its own time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = task = None
        said: list[tuple[int, str]] = []
        out: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                key = row["thread"], row["hash"]
                if first is None:
                    first, task = key, row["task"]
                    given = carry.get(task)
                    said = list(given) if given else []
                elif key != last:
                    said = []
                last = key
                if row["level"] == 0:
                    said = latest(said, [(row["sent"], row["message"])])
                elif not summary:
                    source = next((known for known in reversed(said) if known[0] < row["sent"]), None)
                    if source is not None:
                        out.append((row["message"], row["sent"], row["level"], *source))
            if out:
                yield links(out)
                out = []
        if summary and task is not None:
            whole = first == last
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "task": task,
                        "first": repr(first),
                        "last": repr(last),
                        "whole": whole,
                        "said": [{"sent": sent, "message": message} for sent, message in said],
                    }
                ],
                pa.schema(
                    [
                        ("task", pa.int32()),
                        ("first", pa.string()),
                        ("last", pa.string()),
                        ("whole", pa.bool_()),
                        ("said", pa.list_(pa.struct([("sent", pa.int64()), ("message", pa.string())]))),
                    ]
                ),
            )

    def links(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["message", "sent", "level", "said_at", "source"])

    return run


def source_links(passages: DataFrame) -> DataFrame:
    """``message``, ``sent``, ``level``, ``source`` and the time that it ``said_at`` of every quote whose passage was said before."""
    order = ["thread", "hash", "sent", "level", "message"]
    placed = materialise(
        passages.withColumn("origin", F.spark_partition_id())
        .repartitionByRange(*order, "origin")
        .sortWithinPartitions(*order)
        .withColumn("task", F.spark_partition_id())
        .drop("origin")
    )
    ends = placed.mapInArrow(
        walk({}, True), "task int, first string, last string, whole boolean, said array<struct<sent:long,message:string>>"
    )
    # One row for each task of the walk, not for each message.
    carry: dict[int, list] = {}
    key, known = None, []
    for end in sorted(ends.collect(), key=lambda end: end.task):
        if key == end.first:
            carry[end.task] = known
        said = [(s.sent, s.message) for s in end.said]
        goes_on = end.whole and key == end.first
        known = latest(known, said) if goes_on else said
        key = end.last
    return placed.mapInArrow(walk(carry, False), "message string, sent long, level int, said_at long, source string")


def reply_roots(parents: DataFrame) -> DataFrame:
    """``message``, ``parent``, ``root`` and ``depth`` by pointer jumping; a root has no parent.

    A message whose pointer has arrived at a root takes no part in later rounds but as
    the aim of others, so the rounds that one long chain needs are short ones.
    """
    is_root = F.col("parent").isNull()
    state = materialise(
        parents.select(
            "message",
            "parent",
            F.coalesce("parent", "message").alias("root"),
            F.when(is_root, 0).otherwise(1).cast("long").alias("depth"),
            is_root.alias("arrived"),
        )
    )
    arrived, on_the_way = state.filter("arrived"), state.filter("not arrived")
    while not on_the_way.isEmpty():
        to = arrived.unionByName(on_the_way).select(
            F.col("message").alias("__at"),
            F.col("root").alias("__root"),
            F.col("depth").alias("__depth"),
            F.col("arrived").alias("__arrived"),
        )
        jumped = materialise(
            on_the_way.join(to, F.col("root") == F.col("__at")).select(
                "message",
                "parent",
                F.col("__root").alias("root"),
                (F.col("depth") + F.col("__depth")).alias("depth"),
                F.col("__arrived").alias("arrived"),
            )
        )
        arrived = arrived.unionByName(jumped.filter("arrived"))
        on_the_way = jumped.filter("not arrived")
    return arrived.drop("arrived")


def link_quotes(messages: DataFrame) -> DataFrame:
    """Replies found from quotes.

    ``messages`` has ``thread``, ``sent`` (a long), ``message`` (an id) and ``text``.
    Returns, for each of its rows, ``message``, ``thread``, ``sent``, ``parent``, ``root``
    and ``depth``, and ``own``, the text without quotes and their attributions. The
    parent is the source of the passages at the lowest level that has one: of several,
    that of most passages, then the latest, then the largest id. A message without thread, time or
    id, or without a quote that was said before, starts a conversation of its own. Rows
    that repeat an id share their parent. Null and empty texts say nothing. Rows sorted
    by ``root``, ``sent`` and ``message`` are in reply order, as a parent is always sent
    before its replies.
    """
    rows = materialise(
        messages.select(
            F.col("thread").cast("string").alias("thread"),
            F.col("sent").cast("long").alias("sent"),
            F.col("message").cast("string").alias("message"),
            parsed_of(F.col("text").cast("string")).alias("__parsed"),
        ).select("thread", "sent", "message", "__parsed.*")
    )
    linked = F.col("thread").isNotNull() & F.col("sent").isNotNull() & F.col("message").isNotNull()
    usable = rows.filter(linked)
    said = usable.select("thread", "sent", "message", F.lit(0).alias("level"), F.explode(F.array_distinct("said")).alias("hash"))
    quoted = usable.select("thread", "sent", "message", F.explode("quoted").alias("quote")).select(
        "thread", "sent", "message", "quote.level", "quote.hash"
    )
    found = source_links(said.unionByName(quoted))
    votes = found.groupBy("message", "level", "source").agg(
        F.count("*").alias("passages"), F.max("said_at").alias("said_at")
    )
    parents = votes.groupBy("message").agg(
        F.max_by("source", F.struct(-F.col("level"), "passages", "said_at", "source")).alias("parent")
    )
    ids = usable.select("message").distinct().join(parents, "message", "left")
    tree = reply_roots(ids).select(F.col("message").alias("__message"), "parent", "root", "depth")
    return rows.join(tree, F.col("message") == F.col("__message"), "left").select(
        "message",
        "thread",
        "sent",
        "parent",
        F.coalesce("root", "message").alias("root"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "own",
    )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The rows of ``link_quotes``, sorted within each task, tasks in order."""
    order = ["root", "sent", "message"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)


def quoted_text(text: Column) -> Column:
    """A text with a quote mark before every line."""
    return F.regexp_replace(text, "(?md)^", "> ")


def with_earlier(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``turns`` with ``before`` and ``second``, the turns before each as ``turn``, ``role`` and ``text``.

    A long conversation is cut by turn number, so no task orders all of it. Only the
    first two rows of a part lack what they need: they find it in a second pass over the
    first and last two rows of each part of such conversations. Null turns come first;
    rows that repeat a turn are ordered by role and text.
    """
    order = ["turn", "role", "text"]
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-(1 << 62)))
    rows = turns.select("conv_id", *order, part.alias("part"), F.struct(*order).alias("said"))

    def earlier(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumns({name: F.lag("said", n).over(window) for name, n in (("before", 1), ("second", 2))})

    parts = Window.partitionBy("conv_id", "part")
    inside = earlier(rows, parts.orderBy(*order)).withColumns(
        {"nth": F.row_number().over(parts.orderBy(*order)), "size": F.count("*").over(parts)}
    )
    cut = (
        rows.groupBy(F.col("conv_id").alias("__conv"))
        .agg(F.min("part").alias("least"), F.max("part").alias("most"))
        .filter("least < most")
        .select("__conv", F.lit(True).alias("cut"))
    )
    marked = inside.join(cut, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    first, last = F.col("nth") <= 2, F.col("size") - F.col("nth") < 2
    is_cut = F.col("cut").isNotNull()
    edges = marked.filter(is_cut & (first | last)).drop("before", "second")
    across = earlier(edges, Window.partitionBy("conv_id").orderBy(*order, "part", "nth")).filter(first)
    columns = ["conv_id", *order, "before", "second"]
    return marked.filter(~(is_cut & first)).select(columns).unionByName(across.select(columns))


def as_mail(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Turns as mails: each quotes the turn before it, with that turn's quote of the one before."""
    said = conversations.select(
        "conv_id", "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    turns = with_earlier(said, part_turns)
    text, before, second = F.col("text"), F.col("before.text"), F.col("second.text")
    quote = F.concat_ws("\n", quoted_text(quoted_text(second)), quoted_text(before))
    attribution = F.concat(F.lit("On day "), F.col("before.turn"), F.lit(" "), F.col("before.role"), F.lit(" wrote:"))
    mail = F.when(before.isNull(), text).otherwise(F.concat_ws("\n", attribution, quote, F.lit(""), text))
    return turns.select(
        F.col("conv_id").alias("thread"),
        F.col("turn").alias("sent"),
        F.concat_ws(":", "conv_id", F.when(F.col("turn").isNotNull(), F.format_string("%010d", F.col("turn").cast("long")))).alias("message"),
        mail.alias("text"),
    )
