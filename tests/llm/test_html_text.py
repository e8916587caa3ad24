import random
import re
import time
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldwatch.llm.html_text import (
    blocks_of,
    default_tree,
    extract,
    features_of,
    labelled_pages,
    main_text,
)

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{margin:0}</style></head><body>
<script>var t="</p>"; if (a<b) {}</script><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy this now, it is very cheap.</div>
<article><h1>A &amp; B</h1><p><b>First   part<br>of&nbsp;text &lt;p&gt; here.<p>Of.</p>
<p title="a > b">Café &eacute; &#233;</p><div class="comments"><p>I like it a lot.</p></div></article>
<form><label>Name</label></form><aside>More words are here</aside><footer>&copy; site &middot; All rights.</footer>"""


def test_a_page():
    assert main_text(PAGE, default_tree()) == "A & B\nFirst part of text <p> here.\nOf.\nCafé é é"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<<<>>>", "<p", "<a href='x", "</div></div>", "<script>alert(1)", "<!--"])
def test_broken_pages_give_no_text(page):
    assert isinstance(main_text(page, default_tree()), str)
    assert "alert" not in main_text(page, default_tree())


def test_held_out_accuracy():
    pages = [blocks_of(page) for page in labelled_pages(count=90, seed=77)]
    truth = np.array([block.text.startswith("t") for page in pages for block in page])
    found = np.concatenate([default_tree().decide(features_of(page)) for page in pages])
    assert (truth == found).mean() > 0.97


def test_blocks_hold_all_text_once():
    rnd = random.Random(2)
    for _ in range(200):
        parts = rnd.choices(["<p>", "</p>", "<div>", "</div>", "<b>", "one ", "two&amp;", "<br>", "<span class='ad'>", "</span>", "<a>", "</a>"], k=25)
        page = "".join(parts)
        plain = unescape(re.sub(r"<br>", " ", re.sub(r"<(?!br)[^>]*>", "", page)))
        joined = "".join(block.text for block in blocks_of(page))
        assert joined.replace(" ", "") == "".join(plain.split())


def test_given_pages_give_their_article(spark, small_tables):
    pages = spark.read.parquet(f"{small_tables}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for row in extract(pages).collect():
        article = re.search(r"<article>(.*)</article>", html[row.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n".join(filter(None, blocks))
        assert row.n_chars == len(row.text)


def test_rows_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "u", ""), (3, "u", "<article><p>" + "long " * 200_000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("a"))
    found = sorted(((r.page_id or 0), r.n_chars) for r in extract(df).collect())
    assert found == [(0, 0), (1, 47), (1, 47), (2, 0), (3, 999_999)]
    assert extract(df.limit(0)).collect() == []


def test_time_grows_with_the_tags_of_a_broken_page():
    def seconds(count):
        page = "<div>word<span class='ad'>x" * count + "</p></main>" * count
        start = time.process_time()
        assert len(blocks_of(page)) == 2 * count
        return time.process_time() - start

    seconds(100)
    assert seconds(16_000) < 12 * seconds(4000) + 0.2
