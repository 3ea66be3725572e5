"""Archives written, read back and read by standard rules."""

import base64
import gzip
import hashlib

from ohlcraft.llm import common, queries, warc
from tests.conftest import SF_DIR
from tests.llm.sql import same_as_sql


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, length int, digest string")


def test_query_equals_sql(spark):
    same_as_sql(spark, "op6_indexed_warc", SF_DIR)


def test_revisits_of_equal_payloads(spark):
    rows = [(5, "http://a/", "x" * 40), (3, "http://b/\n", "x" * 40), (9, None, "x" * 40), (1, "u", "y"),
            (2, "u", None), (4, "u", ""), (None, "u", "y"), (None, "u", "z"), (7, "u", "é\r\n\r\nü"), (7, "u", "é\r\n\r\nü")]
    pages = _pages(spark, [(*r, 0, "clash") for r in rows])
    folder = common.new_folder(spark, "warc")
    index = warc.write_archives(pages, folder)
    assert index.count() == len(rows)
    found = {(r.page_id, r.payload_digest): r for r in warc.resolved(warc.read_records(index)).collect()}
    firsts = {5: 3, 9: 3, 4: 2}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row = found[page_id, digest]
        assert row.payload_bytes == len(payload)
        first = firsts.get(page_id) if page_id else {"y": 1}.get(html)
        assert (row.record_type, row.refers_to) == (("revisit", first) if first else ("response", None))
    texts = {r.page_id: r.payload for r in warc.read_records(index.where("page_id IN (7, 1)")).collect()}
    assert bytes(texts[7]).decode() == "é\r\n\r\nü" and bytes(texts[1]) == b"y"


def test_archives_are_gzip_members_in_a_row(spark):
    index = warc.write_archives(
        _pages(spark, [(i, "u", "p" * i, 0, "") for i in range(50)]).coalesce(1), common.new_folder(spark, "warc"))
    paths = {r.path for r in index.collect()}
    whole = b"".join(gzip.open(path.removeprefix("file:")).read() for path in paths)
    assert whole.count(b"WARC/1.1\r\n") == 50


def test_least_bytes_and_empty_table(spark):
    rows = [(1, "u", "a", 0, ""), (2, "u", "a", 0, ""), (3, "u", "bb", 0, ""), (4, "u", "bb", 0, "")]
    index = warc.write_archives(_pages(spark, rows), common.new_folder(spark, "warc"), min_bytes=2)
    assert {r.page_id for r in index.where("record_type = 'revisit'").collect()} == {4}
    index = warc.write_archives(_pages(spark, []), common.new_folder(spark, "warc"))
    assert warc.resolved(warc.read_records(index)).count() == 0
