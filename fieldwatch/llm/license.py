"""License scans: an exact set-similarity join of text blocks with license notices.

A block holds a notice if it has at least ``CONTAINMENT`` of the notice's different
words. Words are ordered from the rarest in the corpus to the most frequent. A block that
holds enough of a notice has one of the notice's rarest words, so only blocks with such a
word are looked at (prefix filter), only for notices short enough for the block (length
filter), and only while the words still to come can reach the number needed (positional
filter). Notices are held against blocks of at least twice their length, which overlap by
half, so none falls between two. They are a small table that goes out with the function.
"""

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import documents_of
from fieldwatch.llm.words import texts_of, words_of

# Phrases that are always reported, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices as licenses ask for them, with the labels that they give.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "licensed under the apache license version 2 0 you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
CONTAINMENT = 0.9
#: Words in the smallest blocks. Notices of over half as many are held against larger ones.
BLOCK = 64


def block_of(n_words: int) -> int:
    """Words in the blocks for a notice, twice its own at least: ``BLOCK`` doubled as often as needed."""
    block = BLOCK
    while block < 2 * n_words:
        block *= 2
    return block


def block_starts(n_words: int, block: int = BLOCK) -> range:
    """Starts of overlapping blocks: any half a block of words in a row lies in one of them."""
    stride = block // 2
    return range(0, max(1, n_words - stride) if n_words else 0, stride)


def notice_words(notice: str) -> list[str]:
    """Words of a notice, as those of the documents are taken."""
    return [word.decode() for word in words_of(notice.encode())]


def need_of(size: int, containment: float) -> int:
    return max(1, ceil(containment * size - 1e-9))


@dataclass
class Notice:
    """A notice, its label and its words' ranks, from the rarest on."""

    phrase: str
    label: str
    ranks: list[int]
    need: int


class Index:
    """Notices for one size of blocks by their rarest words; ranks follow the global frequency."""

    def __init__(self, notices: Mapping[str, str], rank: Mapping[bytes, int], containment: float, block: int = BLOCK) -> None:
        self.block = block
        self.notices: list[Notice] = []
        self.by_prefix: dict[int, list[tuple[int, int]]] = {}
        for phrase, label in notices.items():
            ranks = sorted({rank[word] for word in words_of(phrase.encode())})
            need = need_of(len(ranks), containment)
            for place, first in enumerate(ranks[: len(ranks) - need + 1]):
                self.by_prefix.setdefault(first, []).append((len(self.notices), place))
            self.notices.append(Notice(phrase, label, ranks, need))
        self.shortest = min((notice.need for notice in self.notices), default=0)
        self.prefix_ranks = np.array(sorted(self.by_prefix), dtype=np.int64)

    def matches(self, ranks: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """Block start, notice and containment of every block and notice that reach the threshold."""
        rare = np.isin(ranks, self.prefix_ranks)
        if not rare.any():
            return
        before = np.concatenate([[0], np.cumsum(rare)])
        for start in block_starts(len(ranks), self.block):
            end = min(start + self.block, len(ranks))
            if before[end] == before[start]:
                continue
            block = sorted({rank for rank in ranks[start:end].tolist() if rank >= 0})
            if len(block) < self.shortest:
                continue
            yield from ((start, *match) for match in self.join(block))

    def join(self, block: list[int]) -> Iterator[tuple[int, float]]:
        """Notices that a block of sorted ranks holds enough of."""
        seen: set[int] = set()
        members = set(block)
        # Beyond its own prefix a block has too few words left for any notice.
        for place, rank in enumerate(block[: len(block) - self.shortest + 1]):
            for number, at in self.by_prefix.get(rank, ()):
                notice = self.notices[number]
                if number in seen or len(block) < notice.need:
                    continue
                # The first shared word: what follows it on both sides bounds the overlap.
                seen.add(number)
                if 1 + min(len(block) - place - 1, len(notice.ranks) - at - 1) < notice.need:
                    continue
                shared = sum(r in members for r in notice.ranks)
                if shared >= notice.need:
                    yield number, shared / len(notice.ranks)


class Scanner:
    """The fixed phrases, and an index of notices for each size of blocks."""

    def __init__(self, notices: Mapping[str, str], frequency: Mapping[str, int], containment: float) -> None:
        vocabulary = sorted(wanted_words(notices), key=lambda word: (frequency.get(word, 0), word))
        self.rank = {word.encode(): i for i, word in enumerate(vocabulary)}
        by_block: dict[int, dict[str, str]] = {}
        for phrase, label in notices.items():
            if words := notice_words(phrase):
                by_block.setdefault(block_of(len(words)), {})[phrase] = label
        self.indexes = [Index(some, self.rank, containment, block) for block, some in sorted(by_block.items())]
        self.phrases = [
            ([self.rank[word.encode()] for word in phrase.split()], label) for phrase, label in PHRASES.items()
        ]

    def ranks_of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.rank.get(word, -1) for word in words), np.int64, len(words))

    def matches(self, ranks: np.ndarray) -> Iterator[tuple[int, int, Notice, float]]:
        """Start and end of a block, the notice it holds, and how much of it."""
        for index in self.indexes:
            for start, number, share in index.matches(ranks):
                yield start, min(start + index.block, len(ranks)), index.notices[number], share

    def phrase_places(self, ranks: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        """Label and all starts of every fixed phrase that stands in a text."""
        for phrase, label in self.phrases:
            count = len(ranks) - len(phrase) + 1
            if count < 1:
                continue
            here = ranks[:count] == phrase[0]
            for i, rank in enumerate(phrase[1:], 1):
                here &= ranks[i : i + count] == rank
            starts = np.flatnonzero(here)
            if len(starts):
                yield label, starts


def wanted_words(notices: Mapping[str, str]) -> set[str]:
    """All words of the notices and the phrases."""
    return {word for phrase in (*notices, *PHRASES) for word in notice_words(phrase)}


def word_frequencies(docs: DataFrame, notices: Mapping[str, str] = NOTICES) -> dict[str, int]:
    """How often each word of the notices stands in all documents; one number per word."""
    wanted = {word.encode() for word in wanted_words(notices)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(wanted, 0)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                for word in filter(wanted.__contains__, words_of(text)):
                    total[word] += 1
        names = [word.decode() for word in total]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total.values(), pa.int64())], ["word", "times"])

    counted = documents_of(docs).select("text").mapInArrow(count, "word string, times long")
    return dict(counted.groupBy("word").agg(F.sum("times")).collect())


FOUND = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "n_blocks": pa.int64(),
}
SPARK_NAMES = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


def scan_text(text: bytes | None, scanner: Scanner) -> dict:
    """What a text says about licenses."""
    ranks = scanner.ranks_of(words_of(text))
    places = list(scanner.phrase_places(ranks))
    starts = [int(start) for _, found in places for start in found]
    base = {label for label, _ in places}
    matches = list(scanner.matches(ranks))
    return {
        "n_words": len(ranks),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {notice.label for _, _, notice, _ in matches})),
        "score": 1.0 if base else max((share for *_, share in matches), default=0.0),
        "n_blocks": len({(start, end) for start, end, _, _ in matches}),
    }


def scan_of(text: Column, scanner: Scanner) -> Column:
    schema = ",".join(f"{name}:{SPARK_NAMES[kind]}" for name, kind in FOUND.items())

    @F.arrow_udf(f"struct<{schema}>")
    def scanned(texts: pa.Array) -> pa.Array:
        rows = [scan_text(text, scanner) for text in texts_of(texts)]
        return pa.array(rows, pa.struct(list(FOUND.items())))

    return scanned(text)


def scan_licenses(
    docs: DataFrame, notices: Mapping[str, str] = NOTICES, containment: float = CONTAINMENT
) -> DataFrame:
    """Fixed phrases and license notices of every document.

    ``n_base`` counts all places of the phrases, ``first_word`` and ``last_word`` are the
    first and last of them; ``labels`` are those of phrases and notices; ``score`` is 1
    with a phrase, else the largest containment found; ``n_blocks`` counts blocks with a
    notice. ``notices`` may have any length; their case and marks don't count, and those
    without words are passed over. One row for each row of ``docs``, repeated rows
    included. Null and empty texts have no words, no labels and score 0. An empty table
    gives no rows.
    """
    scanner = Scanner(notices, word_frequencies(docs, notices), containment)
    scanned = scan_of(F.col("text"), scanner).alias("__scan")
    return documents_of(docs).select("doc_id", scanned).select("doc_id", "__scan.*")


def find_notices(
    docs: DataFrame, notices: Mapping[str, str] = NOTICES, containment: float = CONTAINMENT
) -> DataFrame:
    """Every block of words that holds a notice: the join itself.

    ``doc_id``, ``notice``, its ``label``, the block's ``first_word`` and ``end_word``
    (words from 0, end exclusive), and ``containment``, the share of the notice's
    different words in it. As blocks overlap, a notice may stand in two. Documents
    without a notice, null and empty texts and an empty table give no rows; rows that
    repeat give theirs each.
    """
    scanner = Scanner(notices, word_frequencies(docs, notices), containment)
    names = {"notice": pa.string(), "label": pa.string(), "first_word": pa.int64(), "end_word": pa.int64(), "containment": pa.float64()}
    schema = ",".join(f"{name}:{SPARK_NAMES[kind]}" for name, kind in names.items())

    @F.arrow_udf(f"array<struct<{schema}>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [
            [
                dict(zip(names, (notice.phrase, notice.label, start, end, share), strict=True))
                for start, end, notice, share in scanner.matches(scanner.ranks_of(words_of(text)))
            ]
            for text in texts_of(texts)
        ]
        return pa.array(rows, pa.list_(pa.struct(list(names.items()))))

    slim = documents_of(docs).select("doc_id", F.explode(found(F.col("text"))).alias("at"))
    return slim.select("doc_id", "at.*")


def license_sql(notices: Mapping[str, str] = NOTICES, containment: float = CONTAINMENT) -> str:
    """The same result as SQL, block by block and notice by notice."""
    phrases = ", ".join(f"({phrase.split()!r}, '{label}')" for phrase, label in PHRASES.items())
    worded = {phrase: notice_words(phrase) for phrase in notices}
    texts = ", ".join(
        f"({i}, {sorted(set(words))!r}, '{notices[phrase]}', {need_of(len(set(words)), containment)}, {block_of(len(words))})"
        for i, (phrase, words) in enumerate(worded.items())
        if words
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
phrases(phrase, label) AS (VALUES {phrases}),
notices(number, words, label, need, block) AS (VALUES {texts}),
places AS (
  SELECT r, label, place FROM (
    SELECT r, words, unnest(range(len(words))) AS place FROM worded) w, phrases
  WHERE words[place + 1] = phrase[1] AND words[place + 1 : place + len(phrase)] = phrase),
blocks AS (
  SELECT r, size, start, least(start + size, len(words)) AS stop, list_distinct(words[start + 1 : start + size]) AS block FROM (
    SELECT r, words, size, unnest(range(0, CASE WHEN len(words) = 0 THEN 0 ELSE greatest(1, len(words) - size // 2) END, size // 2)) AS start
    FROM worded, (SELECT DISTINCT block AS size FROM notices))),
held AS (
  SELECT r, start, stop, label, len(list_intersect(blocks.block, notices.words)) / len(notices.words)::DOUBLE AS share
  FROM blocks, notices WHERE size = notices.block AND len(list_intersect(blocks.block, notices.words)) >= need),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
method AS (SELECT r, max(share) AS share, count(DISTINCT (start, stop)) AS n_blocks FROM held GROUP BY r),
named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT r, label FROM places UNION SELECT r, label FROM held) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score,
  coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM worded LEFT JOIN base USING (r) LEFT JOIN method USING (r) LEFT JOIN named USING (r)
"""
