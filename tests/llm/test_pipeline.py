import random

import corpus_pipeline
from fieldwatch.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rnd, n=60):
    return " ".join(f"word{rnd.randrange(3000)}" for _ in range(n))


def corpus(spark, folder):
    rnd = random.Random(8)
    passage = sentence(rnd, 25)
    secret = " token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" "
    rows, labels, expected = [], [], {}
    for i in range(300):
        kind = rnd.choice(["clean", "clean", "junk", "leak", "secret", "copy", "short"])
        text = sentence(rnd, 300 if kind in ("clean", "copy") else 60)
        if kind == "junk":
            text = text.replace(" ", "### ")
        if kind == "leak":
            changed = passage.split()
            changed[7] = "other"
            text = f"{text} {' '.join(changed)}"
        if kind == "secret":
            text += secret + "end"
        if kind == "short":
            text = "too short"
        rows.append((i, text, "en", rnd.choice(["a", "b", None]), len(text)))
        labels.append((i, int(kind not in ("junk", "short")), 0))
        if kind in ("clean", "secret", "copy"):
            expected[i] = text.replace(secret, ' [secret]" ')
        if kind == "copy":
            words = text.split()
            words[9] = "changed"
            rows.append((1000 + i, text, "en", "a", len(text)))
            rows.append((1000 + i, text, "en", "a", len(text)))
    rows += [(None, None, None, None, None), (7000, "", None, None, 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return expected


def test_stages_keep_what_plain_rules_keep(spark, tmp_path):
    expected = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    assert {r.doc_id: r.text for r in docs.collect()} == expected
    assert docs.count() == len(expected)


def test_the_run_takes_whole_copies_of_what_is_left(spark, tmp_path):
    expected = corpus(spark, str(tmp_path))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= expected.keys()
    assert all(r.taken == r.copies * len(expected[r.doc_id].split()) and 1 <= r.copies <= 3 for r in rows)
    total = sum(len(text.split()) for text in expected.values())
    assert abs(sum(r.taken for r in rows) - total) <= 3 * 300


def test_stages_take_an_empty_table(spark, tmp_path):
    corpus(spark, str(tmp_path))
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} >= {f"op{n}" for n in range(1, 11)}
    assert set(ORACLE) <= set(QUERIES)
