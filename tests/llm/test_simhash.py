import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from fieldwatch.llm.components import components
from fieldwatch.llm.simhash import (
    BKTree,
    bands_for,
    component_ids,
    drop_near_duplicates,
    fingerprint,
    fingerprint_links,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    prints = [slow_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc_id, _), x in zip(rows, label, strict=True):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(x)) for (d, _), p, x in zip(rows, prints, label, strict=True)]


def texts(seed=1, count=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(200)]
    made = []
    for _ in range(count):
        if made and rnd.random() < 0.5:
            words = rnd.choice(made).split()
            words[rnd.randrange(len(words))] = "Changed"
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 80, 400]))]
        made.append(" ".join(words))
    return [*made, "", None, " \t\n", "A b", "x" * 50_000, "word " * 70_000, made[0], made[0]]


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fingerprints_equal_those_counted_bit_by_bit():
    for text in texts():
        given = None if text is None else text.encode()
        assert fingerprint(given) == slow_fingerprint(text)


def test_components_equal_those_of_all_pairs(spark):
    rows = list(enumerate(texts()))
    rows += [(None, "no id"), (None, "no id"), (7, "w1é"), (7, "w1é")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert as_set(component_ids(df)) == sorted(slow_components(rows), key=repr)


def test_tree_finds_all_within_the_radius():
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    values = [centre]
    values += [centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(300)]
    values += [rnd.getrandbits(64) for _ in range(300)]
    tree = BKTree()
    for value in values:
        tree.add(value)
    for query in values[::7]:
        expected = [i for i, value in enumerate(values) if (value ^ query).bit_count() <= 3]
        assert sorted(tree.near(query, 3)) == expected


def test_many_small_trees_give_the_same_components(spark):
    rnd = random.Random(5)
    centre = rnd.getrandbits(62)
    values = {centre ^ (1 << rnd.randrange(62)) ^ (1 << rnd.randrange(62)) for _ in range(400)}
    values |= {rnd.getrandbits(62) for _ in range(50)}
    prints = spark.createDataFrame([(v,) for v in values], "print long")

    def groups(tree_size):
        links = fingerprint_links(prints, 3, tree_size)
        return as_set(components(links))

    assert groups(7) == groups(1024)


@pytest.mark.parametrize(("bands", "distance"), [(4, 3), (5, 3), (6, 3), (2, 1), (1, 0)])
def test_any_number_of_bands_gives_the_components_of_all_pairs(spark, bands, distance):
    rnd = random.Random(bands)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    values = set(centres)
    for _ in range(120):
        value = rnd.choice(centres)
        for bit in rnd.choices(range(64), k=rnd.randint(0, 5)):
            value ^= 1 << bit
        values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = fingerprint_links(spark.createDataFrame([(v,) for v in signed], "print long"), distance, 16, bands)
    root = {v: v for v in signed}
    for _ in signed:
        for a in signed:
            near = [b for b in signed if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance]
            root[a] = min(root[b] for b in near)
    found = dict(components(links).collect())
    assert {v: found.get(v, v) for v in signed} == root


def test_bands_grow_with_the_corpus():
    assert bands_for(0, 3) == bands_for(1_000_000, 3) == 4
    assert bands_for(20_000_000_000, 3) == 5
    assert bands_for(5, 63) == 64


def test_components_of_a_long_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 300)]
    star = [(1000, i) for i in range(1, 50)]
    rows = [*path, *star, (5000, 5000), (None, 3)]
    random.Random(2).shuffle(rows)
    found = dict(components(spark.createDataFrame(rows, "a long, b long")).collect())
    assert found == {**{i: 100 for i in range(101, 301)}, **{i: 1 for i in [*range(2, 50), 1000]}}


def test_one_document_of_each_group_stays_with_all_columns(spark):
    rows = [(1, "a b c d", "en", "s", 7), (2, "A b c d", "en", "s", 7), (3, "other words", None, None, None)]
    rows += [(3, "other words", None, None, None), (None, "alone", "en", "s", 5), (None, "alone", "en", "s", 5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("print", F.lit("kept")).withColumn("key", F.lit(1))
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "alone"), (1, "a b c d"), (3, "other words"),
    ]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert component_ids(empty).collect() == []
    assert drop_near_duplicates(empty).collect() == []
