import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldwatch.llm.mixing import chance, mix, settle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], SCHEMA)


def slow_targets(size_of):
    """Share by weight; cut what is above the limit and share the rest again."""
    names = sorted(size_of, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target = sum(size_of.values()), {}
    while True:
        free = [s for s in names if s not in target]
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        full = [s for s in free if share[s] > 3 * size_of[s]]
        if not full:
            return target | share
        target |= {s: 3.0 * size_of[s] for s in full}


def rows_of(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        source = rnd.choice(["a"] * 6 + ["b", "c", "Z", "é", None, "tiny"[: rnd.choice([4, 4])]])
        if source == "tiny" and rnd.random() < 0.9:
            source = "a"
        rows.append((i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300])), source))
    return rows


@pytest.mark.parametrize("block_rows", [4, 256])
def test_targets_and_words_taken(spark, block_rows):
    rows = rows_of(1)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    expected = slow_targets(sizes)
    found = mix(table(spark, rows), block_rows=block_rows).collect()
    assert len(found) == len(rows)
    taken, longest = Counter(), Counter()
    for row in found:
        assert row.target == pytest.approx(expected[row.source])
        assert row.source_size == sizes[row.source]
        assert 0 <= row.copies <= 3 and row.taken == row.copies * row.size
        taken[row.source] += row.taken
        longest[row.source] = max(longest[row.source], row["size"])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= longest[source]
    again = mix(table(spark, rows[::-1]), block_rows=block_rows).collect()
    assert sorted((r.doc_id, r.copies) for r in found) == sorted((r.doc_id, r.copies) for r in again)


def test_every_document_keeps_its_expected_copies():
    total = [0.0, 0.0]
    for i in range(20_000):
        p, q = settle(0.3, 10, 0.6, 25, chance(i))
        assert p * 10 + q * 25 == pytest.approx(0.3 * 10 + 0.6 * 25)
        assert p in (0.0, 1.0) or q in (0.0, 1.0)
        total = [total[0] + p, total[1] + q]
    assert total[0] / 20_000 == pytest.approx(0.3, abs=0.02)
    assert total[1] / 20_000 == pytest.approx(0.6, abs=0.02)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "x", None), (2, None, "s"), (3, "", None), (4, "w " * 50_000, "s")]
    df = table(spark, rows).withColumn("size", F.lit("x")).withColumn("target", F.lit(0)).withColumn("open", F.lit(1))
    found = mix(df).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in found) == Counter(
        [(1, "s", 2), (1, "s", 2), (None, None, 1), (2, "s", 0), (3, None, 0), (4, "s", 50_000)]
    )
    assert all(r.taken == 0 for r in found if r["size"] == 0)


def test_empty_tables(spark):
    assert mix(table(spark, [])).collect() == []
    assert [r.taken for r in mix(table(spark, [(1, None, "a")])).collect()] == [0]
