import random
import re

import pytest
from pyspark.sql import functions as F

from fieldwatch.llm import decontaminate
from fieldwatch.llm.decontaminate import drop_contaminated, find_passages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))


def slow_pairs(docs, items, overlap=13, most_changed=0.2):
    """All pairs of places, compared word by word."""
    first = {}
    for i, text in sorted(items, key=lambda x: (x[0] is None, x[0])):
        first.setdefault(text, i)
    found = set()
    for text, i in first.items():
        item = slow_words(text)
        need = min(overlap, len(item))
        if not item:
            continue
        equal = need if need < 6 else (1 - most_changed) * need - 1e-9
        for d, body in docs:
            words = slow_words(body)
            for a in range(len(item) - need + 1):
                window = item[a : a + need]
                if any(
                    sum(x == y for x, y in zip(window, words[b : b + need], strict=True)) >= equal
                    for b in range(len(words) - need + 1)
                ):
                    found.add((d, i))
                    break
    return found


def slow_held(repeated, items):
    """Short items that repeat the one word of a document."""
    return {(d, i) for d, word in repeated.items() for i, text in items if set(slow_words(text)) == {word}}


def corpus(seed=1, changes=(0, 1, 2, 4, 6, 9)):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(400)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(words(rnd.choice([1, 2, 3, 5, 6, 12, 14, 30, 45])))) for i in range(25)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, "too few words"), (104, "rep " * 40)]
    docs = []
    for d in range(150):
        body = words(rnd.choice([0, 4, 60]))
        if rnd.random() < 0.6:
            item = rnd.choice(items[:25])[1].split()
            cut = item[rnd.choice([0, 0, min(5, len(item) - 1)]) :]
            for _ in range(rnd.choice(changes)):
                cut[rnd.randrange(len(cut))] = "Other"
            body = [*body, *(w.upper() if w.isascii() else w for w in cut), *words(5)]
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(body)))
    docs += [(900, None), (901, ""), (902, "rep " * 5000), (903, "w1é " * 20_000), (904, docs[0][1])]
    return docs, items


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, None, None, None) for i, t in docs], SCHEMA),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("block_words", [200_000, 60])
def test_finds_the_pairs_found_word_by_word(spark, block_words):
    docs, items = corpus()
    d, b = tables(spark, docs, items)
    found = {(r.doc_id, r.item_id) for r in find_passages(d, b, block_words=block_words).collect()}
    short = [(i, t) for i, t in docs if len(t or "") < 5000]
    expected = slow_pairs(short, items) | {(902, 104)} | slow_held({903: "w1é"}, items)
    assert found == expected


def test_finds_all_with_every_fifth_word_changed(spark):
    docs, items = corpus(2, changes=(0,))
    changed = [(i, " ".join("x" if n % 5 == 4 else w for n, w in enumerate(t.split()))) for i, t in items[:25]]
    d, b = tables(spark, changed, items[:25])
    expected = slow_pairs(changed, items[:25])
    assert {(r.doc_id, r.item_id) for r in find_passages(d, b).collect()} == expected


def test_spans_hold_the_passage(spark):
    docs, items = corpus(3)
    d, b = tables(spark, docs, items)
    text, passage = dict(docs), dict(items)
    for r in find_passages(d, b).collect():
        here = slow_words(text[r.doc_id])[r.doc_start : r.doc_end]
        there = slow_words(passage[r.item_id])[r.item_start : r.item_end]
        assert len(here) == len(there)
        assert sum(x == y for x, y in zip(here, there, strict=True)) == r.n_equal


def test_a_long_item_is_found_in_pieces(spark):
    rnd = random.Random(6)
    words = [f"v{rnd.randrange(10**9)}" for _ in range(9000)]
    docs = [(i, "a b c " + " ".join(words[at : at + 20]) + " d") for i, at in enumerate(range(0, 8980, 449))]
    d, b = tables(spark, docs, [(1, " ".join(words))])
    found = find_passages(d, b).collect()
    assert sorted(r.doc_id for r in found) == [i for i, _ in docs]
    assert all(r.n_equal >= 13 and r.item_start >= 0 for r in found)


def test_clean_documents_stay_with_all_columns(spark):
    docs, items = corpus(4)
    d, b = tables(spark, [*docs, (None, "no id"), (5, "x"), (5, "x")], items)
    wide = d.withColumn("__contaminated", F.lit(1)).withColumn("item_id", F.lit("a"))
    kept = drop_contaminated(wide, b)
    assert kept.columns == wide.columns
    leaks = {r.doc_id for r in find_passages(d, b).collect()}
    ids = [i for i, _ in [*docs, (None, ""), (5, "x"), (5, "x")]]
    assert kept.count() == sum(1 for i, t in docs if i not in leaks) + 1 + 2
    assert {r.doc_id for r in kept.collect()} - {5} == set(ids) - leaks - {5}


def test_empty_tables(spark):
    d, b = tables(spark, *corpus())
    assert find_passages(d.limit(0), b).collect() == []
    none = find_passages(d, b.limit(0))
    assert none.collect() == [] and none.columns == find_passages(d, b).columns
    assert drop_contaminated(d, b.limit(0)).count() == d.count()


def test_passages_whose_seeds_repeat_in_the_item_are_found(spark):
    w = [f"word{i}" for i in range(13)]
    early = [*w[:3], "a", "b", "c", *w[6:9], *w[4:7], "d", "e", "f", *w[10:]]
    changed = [word if i not in (3, 9) else f"other{i}" for i, word in enumerate(w)]
    docs = spark.createDataFrame([(1, f"so it goes {' '.join(changed)} and on", None, None, 1)], SCHEMA)
    items = spark.createDataFrame([(7, " ".join([*early, *w]))], "item_id long, text string")
    [row] = find_passages(docs, items).collect()
    assert (row.doc_id, row.item_id, row.doc_start, row.item_start, row.n_equal) == (1, 7, 3, 18, 11)


def test_long_items_are_searched_across_their_pieces_for_any_overlap(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 32)
    words = [f"word{i}" for i in range(150)]
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    rows = [(i, " ".join(words[i : i + 24]), None, None, 1) for i in range(127)]
    found = find_passages(spark.createDataFrame(rows, SCHEMA), items, overlap=24, similarity=1.0)
    assert sorted((r.doc_id, r.item_start, r.n_equal) for r in found.collect()) == [(i, i, 24) for i in range(127)]


def test_items_of_few_words_are_found_word_for_word(spark):
    rows = [(1, "So the quick, brown fox jumps high"), (2, "the quick brown cat jumps"), (3, "jumps the quick"), (4, "fox"), (5, "Fox! fox fox")]
    items = spark.createDataFrame([(7, "the quick brown fox jumps"), (8, "fox"), (9, "--")], "item_id long, text string")
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], SCHEMA)
    found = sorted((r.doc_id, r.item_id, r.doc_start, r.n_equal) for r in find_passages(docs, items).collect())
    assert found == [(1, 7, 1, 5), (1, 8, 4, 1), (4, 8, 0, 1), (5, 8, 0, 1)]
    assert {r.doc_id for r in drop_contaminated(docs, items).collect()} == {2, 3}


def test_an_item_in_two_blocks_gives_one_row_for_each_row(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 32)
    monkeypatch.setattr(decontaminate, "BLOCKS_IN_A_PASS", 2)
    words = [f"word{i}" for i in range(200)]
    items = spark.createDataFrame([(7, " ".join(words)), (8, "other " * 20)], "item_id long, text string")
    rows = [(1, " ".join(words)), (1, " ".join(words)), (None, " ".join(words[30:60])), (2, "other " * 14), (3, "clean"), (3, None)]
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], SCHEMA)
    found = find_passages(docs, items, block_words=45)
    assert sorted((r.doc_id or 0, r.item_id) for r in found.collect()) == [(0, 7), (1, 7), (1, 7), (2, 8)]
    assert found.columns == find_passages(docs, items).columns
    assert sorted(r.doc_id for r in drop_contaminated(docs, items, block_words=45).collect()) == [3, 3]
