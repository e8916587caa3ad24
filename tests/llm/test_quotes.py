import random

import pytest
from pyspark.sql import functions as F

from fieldwatch.llm.quotes import as_mail, in_reply_order, link_quotes, parse

SCHEMA = "thread string, sent long, message string, text string"


def normal(lines):
    return " ".join(" ".join(lines).casefold().split())


def slow_parse(text):
    """Own passages and quoted passages with their level, line by line."""
    said, quoted, run, last = [], [], [], 0
    for line in [*(text or "").split("\n"), None]:
        level, rest = 0, line
        while line is not None and rest.lstrip(" \t").startswith(">") and len(rest) - len(rest.lstrip(" \t")) <= 1:
            level, rest = level + 1, rest.lstrip(" \t")[1:]
        if line is None or level != last or not rest.strip():
            if normal(run):
                (said if last == 0 else quoted).append(normal(run) if last == 0 else (last, normal(run)))
            run, last = [], level
        run.append(rest or "")
    return said, quoted


def slow_parents(rows):
    """For each message, by comparison with all earlier ones of its thread."""
    parsed = {row: slow_parse(row[3]) for row in rows}
    parents = {}
    for row in rows:
        votes = {}
        for level, passage in parsed[row][1]:
            earlier = [r for r in rows if r[0] == row[0] and r[1] < row[1] and passage in parsed[r][0]]
            if earlier:
                said_at, source = max((r[1], r[2]) for r in earlier)
                votes[level, said_at, source] = votes.get((level, said_at, source), 0) + 1
        if votes:
            lowest = min(level for level, *_ in votes)
            parents[row[2]] = max((n, *source) for (level, *source), n in votes.items() if level == lowest)[-1]
    return parents


def mails(seed, count=150):
    rnd = random.Random(seed)
    rows = []
    for i in range(count):
        thread = rnd.choice(["a", "a", "a", "b", "c"])
        earlier = [r for r in rows if r[0] == thread]
        own = [rnd.choice(["yes", "No.", "the same line", f"text {i}", f"é {i}\nsecond line"]) for _ in range(rnd.randint(0, 2))]
        text = "\n\n".join(own)
        if earlier and rnd.random() < 0.8:
            source = rnd.choice(earlier)[3]
            quote = "\n".join(rnd.choice([">", "> "]) + line for line in source.split("\n"))
            text = f"{quote}\n\n{text.upper() if rnd.random() < 0.2 else text}"
        rows.append((thread, rnd.choice([i, i, max(0, i - 1)]), f"m{i:04}", text))
    return rows


def test_quote_levels():
    text = "Own  Line\n\nOn Monday X wrote:\n> a b\n> c\n>> deeper\n> > deeper too\n>\n> d\nlast"
    own, said, quoted = parse(text)
    assert own == "Own  Line\n\nlast"
    assert len(said) == 2 and [level for level, _ in quoted] == [1, 2, 1]
    assert parse("> A B\n>C")[2][0][1] == parse("a   b\nc")[1][0]
    assert parse(None) == parse("") == ("", [], [])


@pytest.mark.parametrize("partitions", [1, 2, 40])
def test_parents_equal_those_found_by_all_comparisons(spark, partitions):
    rows = mails(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = slow_parents(rows)
    assert {r.message: r.parent for r in found if r.parent} == expected
    for r in found:
        root, depth = r.message, 0
        while root in expected:
            root, depth = expected[root], depth + 1
        assert (r.root, r.depth) == (root, depth)


def test_of_equally_quoted_sources_the_latest_is_the_parent(spark):
    rows = [("t", 1, "z", "first passage"), ("t", 2, "a", "second passage"), ("t", 3, "m", "> first passage\n\n> second passage\n\nYes.")]
    found = link_quotes(spark.createDataFrame(rows, "thread string, sent long, message string, text string")).collect()
    assert {r.message: r.parent for r in found} == {"z": None, "a": None, "m": "a"}


def test_long_turn_numbers_keep_their_digits(spark):
    turns = [10**11 + 1, 10**11 + 2, 5, 12 * 10**11 + 1]
    rows = [(7, turn, "user", f"text {turn}") for turn in turns]
    mails = as_mail(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(int(r.message.split(":")[1]) for r in mails) == sorted(turns)
    assert "7:0000000005" in {r.message for r in mails}


def test_mail_made_of_turns_comes_back(spark, small_tables):
    turns = spark.read.parquet(f"{small_tables}/conversations.parquet")
    found = in_reply_order(link_quotes(as_mail(turns))).collect()
    text = {(r.conv_id, r.turn): r.text for r in turns.collect()}
    assert len(found) == len(text)
    place = {}
    for i, r in enumerate(found):
        place[r.message] = i
        assert r.own == text[int(r.thread), r.sent]
        first = min(turn for conv, turn in text if conv == int(r.thread))
        assert r.depth == r.sent - first and (r.parent is None) == (r.sent == first)
    assert all(place[r.parent] < place[r.message] for r in found if r.parent)


def test_a_long_conversation_is_cut_without_losing_neighbours(spark):
    """Parts of any length, also of one or two turns, give the mails of an uncut conversation."""
    rnd = random.Random(3)
    turns = sorted(rnd.sample(range(400), 90))
    rows = [("long", turn, "user", f"text {turn}") for turn in turns]
    rows += [("long", turns[5], "user", "again"), ("long", None, "user", "no turn"), (None, 1, "user", None), (None, 2, "bot", "b")]
    rows += [(f"c{i % 7}", i, None, f"short {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    whole = as_mail(df.withColumn("before", F.lit(1)), 1 << 40)
    mails = sorted(map(repr, whole.collect()))
    assert len(mails) == len(rows) and any("> > text" in mail for mail in mails)
    for part_turns in (1, 3, 16, 128):
        assert sorted(map(repr, as_mail(df, part_turns).collect())) == mails
    assert as_mail(df.limit(0)).collect() == []


def test_nulls_repeats_and_long_texts(spark):
    rows = [
        ("t", 1, "a", "hello there"), ("t", 2, "b", "> hello there"), ("t", 2, "b", "> hello there"), ("t", 3, "c", None),
        (None, 4, "d", "> hello there"), ("t", None, "e", "> hello there"), ("t", 5, None, "> hello there"),
        ("t", 6, "f", "> " + "w " * 50_000), ("t", 7, "g", ">" * 5000 + " x"), ("u", 9, "h", "> hello there"), ("t", 0, "i", "> hello there"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("parent", F.lit(1)).withColumn("own", F.lit(2))
    found = link_quotes(df).collect()
    assert len(found) == len(rows)
    assert sorted((r.message, r.parent) for r in found if r.parent) == [("b", "a"), ("b", "a")]
    assert link_quotes(df.limit(0)).collect() == []
