import hashlib
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldwatch.llm.warc import MAGIC, archived, read_archives, write_archives


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows):
    """What the records must say, by plain rules."""
    largest, times = {}, Counter()
    for page, _, html in rows:
        times[html or ""] += 1
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", page), page)
    found = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = largest.get(html or "") if len(payload) >= 1000 and times[html or ""] > 1 else None
        revisit = first is not None and page != first
        found.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(found, key=repr)


def rows_of(count, seed=1):
    rnd = random.Random(seed)
    forged = f"{MAGIC}WARC-Type: response\r\nX-Page: 999999\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = []
    for i in range(count):
        html = "".join(rnd.choice(["é", "<p>", "\r\n", "\n", "\r\n\r\n", "x" * 50, " "]) for _ in range(rnd.choice([0, 3, 90])))
        if rnd.random() < 0.2:
            html = html[: len(html) // 2] + rnd.choice([forged, MAGIC, MAGIC * 3, forged * 2]) + html[len(html) // 2 :]
        rows.append((i, f"http://h/{i}", html))
    same = "same é " * 300
    rows += [(1000 + i, "u", same) for i in range(40)] + [(3000, "u", forged * 50), (3001, "u", forged * 50), (3002, None, "s"), (3003, "a\r\nb", "s")]
    rows += [(5000, "u", None), (None, None, None), (None, "u", same), (4000, "u", "y" * 999), (4001, "u", "y" * 999), (4002, "u", "z" * 1000), (4002, "u", "z" * 1000)]
    return rows


def as_list(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_records_come_back_whatever_the_splits(spark, tmp_path, split):
    rows = rows_of(300)
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    wide = table(spark, rows).withColumn("size", F.lit(1)).withColumn("payload", F.lit("no"))
    write_archives(wide.coalesce(3), folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert as_list(read_archives(spark, folder)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bytes_of_an_archive(spark, tmp_path):
    write_archives(table(spark, [(1, "http://h/é", "pâyload")]), f"{tmp_path}/a")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "a").glob("part-*")))
    head, _, rest = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.0\r\nWARC-Type: response\r\n") and b"Content-Length: 8" in head
    assert rest == "pâyload\r\n\r\n".encode()


def test_long_payload_and_empty_table(spark, tmp_path):
    rows = [(1, "u", "w" * 3_000_000), (2, "u", "w" * 3_000_000)]
    assert as_list(archived(table(spark, rows), f"{tmp_path}/long")) == expected(rows)
    assert as_list(archived(table(spark, []), f"{tmp_path}/none")) == []
