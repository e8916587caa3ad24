import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fieldwatch.llm.boosting import fit_trees, sigmoid
from fieldwatch.llm.quality import (
    COUNTS,
    fit_quality,
    keep_good,
    quality_verdicts,
    statistics,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)
    }
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [len(words), sum(map(len, words)), symbols, duplicates, len(covered)]


def texts(count=60, seed=4):
    rnd = random.Random(seed)
    made = [None, "", " \n\t\x0b", "a\n\na\n a\na", "é ü 漢字 x 😀", "w " * 30_000, "x" * 40_000]
    for _ in range(count):
        words = [rnd.choice(["a", "bé", "c#", "d|", "E5"]) for _ in range(rnd.choice([3, 12, 30, 200]))]
        made.append("".join(w + rnd.choice([" ", "\n", "\r\n", "  "]) for w in words))
    return made


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)


def labelled(spark, count=800):
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(count):
        good = rnd.random() < 0.6
        words = [f"word{rnd.randrange(5000)}" + ("" if good else "###") for _ in range(60)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_counts_equal_those_counted_window_by_window():
    for text in texts():
        assert statistics(text)[0] == slow_counts(text)


def test_verdicts_of_all_rows(spark):
    rows = list(enumerate(texts())) + [(None, "n"), (1, ""), (1, "")]
    _, labels, _ = labelled(spark)
    df = table(spark, rows).withColumn("kept", F.lit("x")).withColumn("features", F.lit(1))
    found = quality_verdicts(df, labels).collect()
    assert len(found) == len(rows)
    expected = Counter((i, *slow_counts(t)) for i, t in rows)
    assert Counter((r.doc_id, *(r[c] for c in COUNTS)) for r in found) == expected
    for row in found:
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert not (row.kept and row.base_failed)


def test_held_out_accuracy(spark):
    docs, labels, truth = labelled(spark)
    some = labels.filter("doc_id % 2 = 0")
    found = {r.doc_id: r.kept for r in quality_verdicts(docs, some).collect()}
    right = [found[i] == bool(good) for i, good, _ in truth if i % 2]
    assert np.mean(right) > 0.98


def test_the_sample_is_bounded_and_contradictions_are_left_out(spark):
    docs, labels, _ = labelled(spark, 50)
    both = labels.union(labels.selectExpr("doc_id", "1 - quality", "toxic"))
    trees = fit_quality(docs, both)
    assert len(trees.roots) == 0
    assert fit_quality(docs, labels, most_rows=5).score(np.zeros((1, 10))).shape == (1,)


def test_scores_fall_with_a_constrained_feature():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < sigmoid(3 * np.sin(6 * x[:, 0]) + 2 * x[:, 1])).astype(float)
    trees = fit_trees(x, y, [-1, 0, 0])
    grid = np.tile(rng.random((50, 1, 3)), (1, 101, 1))
    grid[:, :, 0] = np.linspace(0, 1, 101)
    scores = trees.score(grid.reshape(-1, 3)).reshape(50, 101)
    assert (np.diff(scores, axis=1) <= 1e-12).all()
    free = fit_trees(x, y, [0, 0, 0]).score(grid.reshape(-1, 3)).reshape(50, 101)
    assert (np.diff(free, axis=1) > 0).any()


def test_good_documents_stay_with_all_columns(spark):
    docs, labels, truth = labelled(spark)
    wide = docs.withColumn("__verdict", F.lit(3))
    kept = keep_good(wide, labels)
    assert kept.columns == wide.columns
    good = {i for i, good, _ in truth if good}
    assert len(good ^ {r.doc_id for r in kept.collect()}) < 5


def test_empty_tables(spark):
    docs, labels, _ = labelled(spark, 30)
    assert quality_verdicts(docs.limit(0), labels).collect() == []
    accepted = quality_verdicts(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in accepted)
