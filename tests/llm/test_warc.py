from __future__ import annotations

import base64
import gzip
import hashlib

from seqprep.llm import warc
from seqprep.llm.shared import new_folder

ROWS = [
    (1, "http://a.org/x\r\ny%", "<p>é\r\n\r\nWARC/1.1</p>"),
    (2, None, None),
    (3, "http://b.org", ""),
    (4, "http://b.org", "same"),
    (5, "http://c.org", "same"),
    (5, "http://c.org", "same"),
    (6, "http://c.org", "long " * 40_000),
    (None, "http://d.org", "same"),
    (None, "http://e.org", "alone"),
]
SCHEMA = "page_id long, url string, html string, file string, OFFSET string"


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA).repartition(3)
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(df, folder)
    assert index.count() == len(ROWS)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(ROWS)
    keepers = {"": 3, "same": 5}
    want = []
    for page, url, html in ROWS:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        keeper = keepers.get(html or "", page)
        refers = keeper if keeper != page else None
        want.append((page, url, len(payload), digest, "response" if refers is None else "revisit", refers, None if refers else payload))
    plain = [(*r[:-1], None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(map(repr, plain)) == sorted(map(repr, want))


def test_selected_records_and_gzip_members(spark):
    df = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(200)], "page_id long, url string, html string")
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(df.coalesce(2), folder)
    some = index.where("page_id % 7 = 0")
    got = warc.read_records(some, folder).collect()
    assert sorted(r.page_id for r in got) == list(range(0, 200, 7))
    assert all(bytes(r.payload).decode() == f"page {r.page_id} " * 50 for r in got)
    one = index.orderBy("file", "offset").first()
    data = gzip.open(one.file).read()
    assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC-Type: response") >= 50


def test_urls_stand_unchanged_in_the_archive(spark):
    urls = ["http://x/a%20b", "http://x/a%2520b?q=%0A", "http://x/é", "http://x/1\n2"]
    df = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(df, folder)
    targets = set()
    for row in index.collect():
        with open(row.file, "rb") as file:
            file.seek(row.offset)
            head = gzip.decompress(file.read(row.length)).partition(b"\r\n\r\n")[0].decode()
        targets.add(head.partition("WARC-Target-URI: ")[2].partition("\r\n")[0])
    assert targets == {*urls[:3], "http://x/1%0A2"}
    assert {r.url for r in warc.read_records(index, folder).collect()} == set(urls)


def test_tasks_are_dealt_by_archive_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 1 << 12)
    monkeypatch.setattr(warc, "TASK_BYTES", 1 << 13)
    rows = [(i, "http://h", hashlib.sha512(str(i).encode()).hexdigest() * 8) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(df.coalesce(2), folder)
    got = warc.read_records(index, folder)
    total = sum(r.length for r in index.select("length").collect())
    assert got.rdd.getNumPartitions() >= total // (1 << 13)
    assert sorted(r.page_id for r in got.collect()) == list(range(300))


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = new_folder(spark, "warc-test")
    assert warc.read_records(warc.write_archives(df, folder), folder).collect() == []
