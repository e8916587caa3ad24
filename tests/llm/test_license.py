import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldwatch.llm.license import (
    BLOCK,
    NOTICES,
    Scanner,
    block_of,
    block_starts,
    find_notices,
    license_sql,
    scan_licenses,
    word_frequencies,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks"]


def texts(count=150, seed=3):
    rnd = random.Random(seed)
    made = [None, "", " ,.! ", "GNU General Public License", "cc-by CC BY cc. by é cc by", "mit\nlicense " * 9000, "x" * 70_000]
    notices = list(NOTICES)
    for _ in range(count):
        words = [rnd.choice(["the", "of", "license", "é", "word", "under", "2", "this"]) for _ in range(rnd.choice([0, 10, 31, 64, 200]))]
        for _ in range(rnd.choice([0, 1, 1, 2])):
            notice = rnd.choice(notices).split()
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                notice[rnd.randrange(len(notice))] = "other"
            at = rnd.randrange(len(words) + 1)
            words[at:at] = notice
        made.append(rnd.choice([" ", "\n", ", "]).join(w.upper() if rnd.random() < 0.3 and w.isascii() else w for w in words))
    return made


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)


def test_equals_the_comparison_of_all_blocks_with_all_notices(spark, tmp_path):
    rows = list(enumerate(texts())) + [(None, "MIT License"), (4, "x"), (4, "x")]
    df = table(spark, rows)
    df.write.parquet(f"{tmp_path}/documents")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    expected = connection.execute(license_sql()).fetchall()
    wide = df.withColumn("score", F.lit("x")).withColumn("word", F.lit(1))
    found = scan_licenses(wide).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("containment", [0.5, 0.75, 1.0])
def test_filters_lose_no_notice(containment):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    notices = {" ".join(rnd.sample(words, rnd.randint(2, 12))): str(i) for i in range(30)}
    scanner = Scanner(notices, {w: rnd.randrange(50) for w in words}, containment)
    [index] = scanner.indexes
    for _ in range(300):
        block = sorted(scanner.rank[w.encode()] for w in rnd.sample(words, rnd.randint(1, 25)))
        expected = {
            i for i, notice in enumerate(index.notices)
            if len(set(notice.ranks) & set(block)) >= containment * len(notice.ranks) - 1e-9
        }
        assert {number for number, _ in index.join(block)} == expected


@pytest.mark.parametrize("block", [BLOCK, 4 * BLOCK])
def test_every_run_of_half_a_block_lies_in_one(block):
    for n in range(0, 4 * block, 7):
        covered = {i for start in block_starts(n, block) for i in range(start, min(n, start + block))}
        assert covered == set(range(n))
        for at in range(n - block // 2 + 1):
            assert any(s <= at and at + block // 2 <= s + block for s in block_starts(n, block))
    assert [block_of(n) for n in (1, 32, 33, 64, 65, 1000)] == [64, 64, 128, 128, 256, 2048]


@pytest.mark.parametrize("length", [33, 50, 120, 700])
def test_long_notices_are_found_at_every_place(spark, tmp_path, length):
    notice = ", ".join(f"Legal{i}" for i in range(length))
    notices = {notice: "long", "licensed under cc by 4 0": "cc-by-4.0", " -- ": "none"}
    rows = [(i, f"{'filler ' * i * 5} ({notice}) {'end ' * 300}") for i in range(0, 64, 3 if length < 700 else 21)]
    rows += [(1000, notice.rsplit(",", length // 5)[0]), (1001, None), (1002, "")]
    df = table(spark, rows)
    found = scan_licenses(df, notices).select(COLUMNS).collect()
    assert {r.doc_id for r in found if r.labels == "long" and r.score == 1.0} == {i for i, _ in rows[:-3]}
    blocks = find_notices(df.withColumn("label", F.lit(1)), notices).collect()
    assert {r.doc_id for r in blocks} == {i for i, _ in rows[:-3]}
    for r in blocks:
        held = set(dict(rows)[r.doc_id].lower().replace(",", "").replace("(", "").replace(")", "").split()[r.first_word : r.end_word])
        assert r.containment == sum(f"legal{i}" in held for i in range(length)) / length >= 0.9
    df.write.parquet(f"{tmp_path}/documents")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(map(tuple, found), key=repr) == sorted(connection.execute(license_sql(notices)).fetchall(), key=repr)


def test_frequencies_cover_all_documents(spark):
    df = table(spark, [(i, "the LICENSE, the") for i in range(50)] + [(60, None)])
    counts = word_frequencies(df)
    assert counts["the"] == 100 and counts["license"] == 50 and counts["gnu"] == 0
    assert scan_licenses(df.limit(0)).collect() == []
