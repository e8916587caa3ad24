import math
from collections import defaultdict

import numpy as np
import pytest

from fieldwatch.llm.vector_search import COORDINATE_FROM, NONE, Bucket, rounds_of, top_products

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(1024 * float(np.float32(x))) for x in vector]


def slow_top(rows, queries, top=10):
    """Every product of a query with every other vector."""
    usable = {i: whole(v) for i, v, *_ in rows if i is not None and whole(v) is not None}
    found = []
    for q in queries:
        if q not in usable:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(usable[q], v, strict=False)), i) for i, v in usable.items() if i != q
        )
        found += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores[:top], 1)]
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def found(spark, rows, every=5, **settings):
    vectors = table(spark, rows)
    result = top_products(vectors, vectors.filter(f"vec_id % {every} = 0"), **settings)
    assert dict(result.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    return sorted(tuple(row) for row in result.collect())


@pytest.mark.parametrize("bucket_components", [1 << 19, 24])
def test_equals_all_products(spark, bucket_components):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8) * 3.0 ** rng.integers(-2, 3)) for i in range(60)]
    assert found(spark, rows, bucket_components=bucket_components) == slow_top(rows, range(0, 60, 5))


def test_a_third_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=16)
    rows = [(i, hot if i % 3 == 0 else hot + rng.normal(size=16) / 50 if i % 3 == 1 else rng.normal(size=16)) for i in range(150)]
    assert found(spark, rows, bucket_components=16 * 16) == slow_top(rows, range(0, 150, 5))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (5, [0.0, 0.0]), (10, []), (15, None), (20, [1.0, None]), (25, [nan, 1.0]), (30, [inf, 1.0]),
        (None, [9.0, 9.0]), (7, [1.0, 2.0, 5.0]), (8, [-1.0, -0.0001]), (-5, [0.5, -2.5]), (9, [1e30, 1.0]),
    ]
    kept = [row for row in rows if row[0] != 9]
    assert found(spark, rows) == slow_top(kept, [-5, 0, 5, 10, 15, 20, 25, 30])


def test_repeated_rows_count_once_and_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2**20, 2**20, size=3) / 8) for i in range(20)]
    assert found(spark, rows + rows[:10]) == slow_top(rows, range(0, 20, 5))
    assert found(spark, [(0, [2.0]), (0, [1.0]), (1, [3.0])]) == [(0, 1, 1, 1024 * 3072)]


def test_empty_tables_and_other_columns(spark):
    empty = table(spark, [])
    assert top_products(empty, empty).collect() == []
    vectors = spark.createDataFrame([(0, [1.0], 7, 8), (1, [2.0], 7, 8)], "vec_id long, embedding array<float>, rank int, score int")
    assert [tuple(row) for row in top_products(vectors, vectors.filter("vec_id = 0")).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]


def test_pruning_verifies_few_and_loses_none():
    """Near copies of the query lie within few coordinates; short vectors are never verified."""
    rng = np.random.default_rng(4)
    directions = rng.normal(size=(2000, 16))
    directions /= np.linalg.norm(directions, axis=1)[:, None]
    query = np.floor(1024 * directions[0]).astype(np.int64)[None]
    near = directions[0] + rng.normal(size=(20, 16)) / 200
    for scale, share in ((np.ones(2020), 0.25), (np.repeat([0.01, 1.0], [2000, 20]), 0.02)):
        vectors = np.floor(1024 * np.concatenate([directions, near]) * scale[:, None]).astype(np.int64)
        scores = (vectors @ query[0]).tolist()
        ids = np.arange(2020)
        expected = sorted(((-s, i) for i, s in enumerate(scores) if i != 0))[:10]
        floor = -expected[-1][0]
        bucket = Bucket(ids, np.linalg.norm(vectors, axis=1), vectors)
        lengths = np.linalg.norm(query, axis=1)
        assert floor / lengths[0] / bucket.longest > COORDINATE_FROM
        _, places, best = bucket.best(np.array([0]), lengths, query, np.array([floor]), 10)
        assert [(-s, i) for s, i in zip(best.tolist(), bucket.ids[places].tolist(), strict=True)] == expected
        assert bucket.verified < share * 2020
        # Without a floor nothing can be left out.
        _, places, best = bucket.best(np.array([0]), lengths, query, np.array([NONE]), 10)
        assert [(-s, i) for s, i in zip(best.tolist(), bucket.ids[places].tolist(), strict=True)] == expected


def test_rounds_cover_all_buckets_once():
    for buckets in (0, 1, 2, 17, 300):
        covered = defaultdict(int)
        for start, until in rounds_of(buckets):
            for bucket in range(start, until):
                covered[bucket] += 1
        assert covered == dict.fromkeys(range(buckets), 1)
    assert len(rounds_of(1_000_000)) <= 6
