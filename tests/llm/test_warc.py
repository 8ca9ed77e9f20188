"""Archives: round trip, format and index."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from millwright.llm import warc
from millwright.llm.rawfiles import new_folder
from tests.llm.helpers import rows_of

FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def page_rows():
    rows = [(i, f"http://h{i % 7}.example.com/p/{i}?q=1#top", f"<p>{i}</p>" * (i % 30)) for i in range(120)]
    rows += [(200 + i, "http://hot.example.com/", "same page " * 20) for i in range(40)]
    rows += [(300, None, None), (301, "", ""), (302, "http://a.b/\r\nX: y é", "\r\n\r\n\0" * 60)]
    rows += [(None, "http://n.u/", "same page " * 20), (303, "http://big.b/", "xé" * 9_000_000)]
    return rows


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and page_id is not None:
            first[raw] = min(page_id, first.get(raw, page_id))
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        to = first.get(raw)
        refers = to if to is not None and to != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), kind, refers))
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(page_rows(), "page_id bigint, url string, html string").withColumn(
        "payload", F.lit("clash")
    )


@pytest.fixture(scope="module")
def folder(spark, pages):
    path = new_folder(spark, "test-warc")
    warc.write_archives(pages.repartition(3), path)
    return path


def test_files_are_gzip_members_of_warc_records(spark, folder):
    content = [bytes(r.content) for r in warc.read_raw(spark, folder).collect()]
    whole = b"".join(gzip.decompress(c) for c in content)
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(page_rows())
    assert whole.startswith(b"WARC/1.1\r\n")


def test_archives_round_trip(spark, folder):
    assert rows_of(warc.read_archives(spark, folder), *FIELDS) == sorted(expected(page_rows()), key=repr)


@pytest.mark.parametrize("lines", [3000, 4])
def test_lookup_by_index(spark, pages, folder, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    index = warc.build_index(warc.read_archives(spark, folder))
    if lines == 4:
        assert index.count() > 30
    got = warc.lookup(index, pages)
    assert rows_of(got, *FIELDS) == sorted(expected(page_rows()), key=repr)
    strangers = spark.createDataFrame([(1, "http://no.where/"), (None, None), (5, "")], "page_id bigint, url string")
    assert warc.lookup(index, strangers).count() == 0
    assert warc.lookup(index, pages.limit(0)).count() == 0


def test_ranges_hold_the_payloads(spark, pages, folder):
    captures = warc.read_archives(spark, folder).filter("record_type = 'response' AND page_id < 100")
    payloads = {r.page_id: bytes(r.payload) for r in warc.read_captures(spark, folder, captures).collect()}
    assert payloads
    html = {i: h for i, _, h in page_rows()}
    assert all(payloads[i] == html[i].encode() for i in payloads)


@pytest.mark.parametrize("seeks", [True, False])
def test_fetched_records_say_what_the_index_says(spark, pages, folder, monkeypatch, seeks):
    monkeypatch.setattr(warc, "can_seek", lambda _: seeks)
    captures = warc.lookup(warc.build_index(warc.read_archives(spark, folder)), pages)
    got = warc.fetch(spark, folder, captures, with_payload=False)
    assert rows_of(got, *FIELDS) == sorted(expected(page_rows()), key=repr)


def test_only_the_wanted_ranges_are_read(spark, folder):
    captures = warc.read_archives(spark, folder).orderBy("path", "offset").collect()
    wanted = [c for i, c in enumerate(captures) if i % 10 in (3, 4)]
    read = []

    class Counting:
        def __init__(self, path):
            self.file = warc.open_file(path)

        def seek(self, place):
            self.file.seek(place)

        def read(self, size):
            read.append(size)
            return self.file.read(size)

        def close(self):
            self.file.close()

    places = [(c.path, c.offset, c.length, c.payload_digest) for c in wanted]
    got = [fields for fields, _ in warc.read_ranges(places, Counting)]
    assert got == [tuple(c[f] for f in FIELDS) for c in wanted]
    assert sum(read) == sum(c.length for c in wanted)
    assert len(read) < len(wanted)  # neighbours are read together
    moved = [(p, o, n, "0" * 64) for p, o, n, _ in places[:1]]
    with pytest.raises(ValueError, match="another record"):
        list(warc.read_ranges(moved))


def test_empty_table(spark, pages):
    path = new_folder(spark, "test-warc")
    warc.write_archives(pages.limit(0), path)
    index = warc.build_index(warc.read_archives(spark, path))
    assert warc.lookup(index, pages).count() == 0


def test_repeated_rows_are_all_found(spark):
    rows = [(1, "http://a.b/", "short")] * 25 + [(2, "http://a.b/", "short")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = new_folder(spark, "test-warc")
    warc.write_archives(pages, path)
    index = warc.build_index(warc.read_archives(spark, path))
    assert warc.lookup(index, pages).count() == 26


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com/a/b?x=1#f", "com,example,www)/a/b?x=1"),
        ("https://example.com:8080", "com,example:8080)/"),
        ("http://user@example.com:80/", "com,example)/"),
        ("example.com/x", "com,example)/x"),
        ("http://[bad/x", "http://[bad/x"),
        (None, ""),
        ("", ""),
    ],
)
def test_keys(url, key):
    assert warc.reversed_host_key(url) == key
