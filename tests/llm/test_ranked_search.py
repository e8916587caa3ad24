import math
import re
from collections import Counter

import pytest

from fieldwatch.llm import ranked_search
from fieldwatch.llm.ranked_search import Block, classes_of, dealt_items, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS, ITEMS = "doc_id long, text string, item_id long, rank int", "item_id long, text string, doc_id int"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def slow_ranks(docs, items, top=20):
    """Every document against every item, straight from the formula."""
    bags = [Counter(terms(text)) for _, text in docs]
    number, words = sum(map(bool, bags)), sum(sum(bag.values()) for bag in bags)
    held = Counter(term for bag in bags for term in bag)
    found = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), bag in zip(docs, bags, strict=True):
            m = 75 + (25 * sum(bag.values()) * number) // words if words else 0
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * held[term] + 1)))
                * (1_000_000_000 * bag[term] // (1000 * bag[term] + 12 * m))
                for term in terms(text)
                if bag[term]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scores[:top], 1)]
    return sorted(found, key=repr)


def found(spark, docs, items, parts=4, **settings):
    left = spark.createDataFrame([(i, t, 9, 9) for i, t in docs], DOCS).repartition(parts)
    right = spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS)
    result = rank_documents(left, right, **settings)
    assert dict(result.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted((tuple(row) for row in result.collect()), key=repr)


def corpus():
    words = "alpha Beta gamma delta epsilon zeta éta theta_iota kappa 42".split()
    docs = [(i, " ".join(words[(i * j) % 10] for j in range(1, 3 + i % 7))) for i in range(60)]
    docs += [(100 + i, "alpha beta, gamma.") for i in range(40)]
    return docs + [(99, "Gamma alpha-BETA"), (98, "unknown words only here")]


ITEMS_OF = [(1, "alpha beta"), (2, "gamma Gamma éta"), (3, "theta iota 42 kappa nowhere"), (4, None), (5, "..."), (None, "delta")]


@pytest.mark.parametrize("settings", [{}, {"top": 3}, {"block_items": 1}, {"block_chars": 10}])
def test_equals_the_formula(spark, settings):
    expected = slow_ranks(corpus(), ITEMS_OF, settings.get("top", 20))
    assert found(spark, corpus(), ITEMS_OF, **settings) == expected


def test_same_bag_in_any_order_is_one_class_with_its_smallest_ids(spark):
    rows = [(i, 3, bytearray(b"same")) for i in range(50, 0, -1)] + [(None, 3, bytearray(b"same")), (7, 4, bytearray(b"same"))]
    bags = spark.createDataFrame(rows, "doc_id long, m long, bag binary").repartition(5)
    classes = {(row["m"], tuple(row["doc_ids"])) for row in classes_of(bags, 5).collect()}
    assert classes == {(3, (1, 2, 3, 4, 5)), (4, (7,))}


def test_cutting_waiting_scores_keeps_the_best(spark, monkeypatch):
    block = Block.of([{"item_id": 1, "text": "alpha beta gamma"}])
    assert list(block.vocabulary) == [b"alpha", b"beta", b"gamma"]
    best = ranked_search.Best(2, 3)
    monkeypatch.setattr(ranked_search, "WAITING", 4)
    scores = [[5, 0], [7, 1], [5, 0], [9, 1], [5, 1], [7, 1], [1, 1]]
    for i, row in enumerate(scores):
        best.add(ranked_search.np.array([row]), [[100 - i]])
    best.cut()
    item, score, first, _ = best.kept[0]
    assert list(zip(item.tolist(), score.tolist(), first.tolist(), strict=True)) == [
        (0, 9, 97), (0, 7, 95), (0, 7, 99), (1, 1, 94), (1, 1, 95), (1, 1, 96),
    ]


def test_nulls_repeats_and_long_texts(spark):
    docs = [(1, "alpha"), (1, "alpha"), (None, "alpha"), (None, None), (2, ""), (3, "beta " * 30_000 + "alpha"), (4, "gamma")]
    items = [(7, "alpha"), (7, "alpha"), (8, "ALPHA beta")]
    assert found(spark, docs, items) == slow_ranks(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "alpha")]) == found(spark, [(1, "alpha")], []) == found(spark, [(1, None)], [(1, "a")]) == []


def test_blocks_of_items_are_bounded(spark):
    items = spark.createDataFrame([(1, "word " * (20 if i else 100)) for i in range(50)], "item_id long, text string")
    dealt, blocks = dealt_items(items, 200, 10)
    sizes = dealt.selectExpr("block", "length(text) AS chars").groupBy("block").agg({"chars": "sum", "*": "count"}).collect()
    assert sum(row["count(1)"] for row in sizes) == 50 and blocks >= 6
    assert all(row["count(1)"] == 1 or (row["count(1)"] <= 20 and row["sum(chars)"] <= 400) for row in sizes)
