import hashlib
import random
import zlib

import pytest

from fieldwatch.llm import prefix_trie as module
from fieldwatch.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, id string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow_trie(rows):
    """The trie as nested dictionaries over whole sequences of turns."""
    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in own.items()}
    members, ends = {}, {}
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        path = tuple(own.get(base, [])[:h] + own[conv][h:])
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append(conv)
        ends.setdefault(path, []).append(conv)
    totals = {path: [0, 0, 0] for path in members}  # children, leaves, saved
    for path in members:
        if path:
            totals[path[:-1]][0] += 1
    for path, convs in members.items():
        leaf = totals[path][0] == 0
        saved = (len(convs) - 1) * len(path[-1][1].split()) if path else 0
        for depth in range(len(path) + 1):
            totals[path[:depth]][1] += leaf
            totals[path[:depth]][2] += saved
    return sorted(
        (
            convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), *totals[path],
            hashlib.sha256(",".join(map(str, ends.get(path, []))).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


def found(spark, rows, parts=3):
    table = spark.createDataFrame([(*row, 0, "x") for row in rows], SCHEMA).repartition(parts)
    return sorted(tuple(row) for row in prefix_trie(table).select(*COLUMNS).collect())


def made(seed, conversations, longest, words=3):
    rng = random.Random(seed)
    return [
        (conv, turn, rng.choice(["user", "assistant"]), " ".join(rng.choices(["a", "b"], k=rng.randrange(words))))
        for conv in conversations
        for turn in range(rng.randint(1, longest))
    ]


def test_equals_whole_sequences(spark):
    rows = made(1, range(90), 6)
    assert found(spark, rows) == slow_trie(rows)


def test_family_without_its_first_conversation(spark):
    rows = made(2, [*range(21, 60), *range(-45, -30), 40], 3)
    assert found(spark, rows) == slow_trie(rows)


@pytest.mark.parametrize("band", [2, 3, 16])
def test_deep_conversations_take_several_bands(spark, monkeypatch, band):
    monkeypatch.setattr(module, "BAND", band)
    deep = [(conv, turn, "user", f"turn {turn}" + " x" * (conv == 5 and turn > 70)) for conv in (0, 4, 5, 20) for turn in range(90)]
    rows = deep + made(3, range(6, 18), 5)
    assert found(spark, rows) == slow_trie(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, None, None, "first"), (0, 1, "user", None), (0, 1, "user", None), (0, 1, "user", ""),
        (1, 5, "user", "a b c"), (1, 5, "user", "a b c"), (1, -3, None, None), (None, 1, "user", "nobody"),
        (2, 1, "us", "er"), (3, 1, "u", "ser"), (4, 1, "", "user"),
    ]
    assert found(spark, rows) == slow_trie(rows)


def test_one_conversation_and_one_first_turn_hold_many_rows(spark):
    rows = [(0, turn % 50, "user", "again") for turn in range(600)]
    rows += [(conv, turn, "user", "hello" if turn == 0 else f"{conv % 40}") for conv in range(100, 400) for turn in range(4)]
    assert found(spark, rows, 7) == slow_trie(rows)


def test_long_text_and_turnless_conversations(spark):
    rows = [(20, 0, "user", "word " * 50_000), (40, 0, "user", "x")]
    turnless = [conv for conv in range(60, 80) if zlib.crc32(str(conv).encode()) % 4 and conv != 60][:3]
    rows += [(conv, 0, "user", "only") for conv in turnless] + [(conv, 0, "user", "lost") for conv in range(21, 40)]
    assert found(spark, rows) == slow_trie(rows)
    alone = [(turnless[0], 0, "user", "only")]
    assert found(spark, alone) == slow_trie(alone)
    assert len(found(spark, alone)) == 1


def test_empty_table_has_no_root(spark):
    assert found(spark, []) == found(spark, [(None, 1, "user", "nobody")]) == []
