from __future__ import annotations

import hashlib
import io
import struct

import pyarrow.fs as pafs
import zstandard
from aqarlens.llm.warc import DICTIONARY_MAGIC, archive_pages, read_archive, read_archives

PAGE = "<html>" + "same payload in many pages " * 10 + "</html>"
ROWS = [
    (5, "http://a/%0A?q=1", PAGE),
    (3, "http://b/\r\nX: y", PAGE),
    (9, None, PAGE),
    (4, "http://c", None),
    (6, "http://d", ""),
    (7, "http://e", "short"),
    (8, "http://e", "short"),
    (10, "http://f", "WARC/1.1\r\n\r\nContent-Length: 7\r\n\r\n" * 20),
    (11, "http://g", "é漢" * 50_000),
    (3, "http://b/\r\nX: y", PAGE),
    (None, "http://h", PAGE),
    (None, "http://i", "only without an id " * 20),
]
ROWS += [(k, f"http://hot/{k}", PAGE) for k in range(200, 260)]
ROWS += [(k, f"http://own/{k}", f"<p>page {k} " + "of much the same text " * 20) for k in range(300, 360)]


def _pages(spark):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    return frame.selectExpr("*", "'x' AS payload", "1 AS digest", "2 AS refers_to", "3 AS payload_bytes")


def test_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    manifest = archive_pages(spark, _pages(spark).repartition(4), folder)
    got = read_archives(manifest).collect()
    assert len(got) == len(ROWS) == manifest.agg({"n_records": "sum"}).first()[0]
    want = []
    for page, url, html in ROWS:
        data = (html or "").encode()
        ids = [p for p, _, h in ROWS if h == html and p is not None and len(data) >= 100]
        first = min(ids, default=page)
        revisit = page != first and len(data) >= 100
        want.append((page, url, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                     first if revisit else None, None if revisit else data))
    have = [(*r[:6], None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_records_can_be_read_alone(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    archive_pages(spark, _pages(spark).coalesce(1), folder)
    fs, root = pafs.FileSystem.from_uri(folder)
    sizes = []
    for info in fs.get_file_info(pafs.FileSelector(root)):
        data = fs.open_input_stream(info.path).read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == DICTIONARY_MAGIC
        sizes.append(size)
        known = zstandard.ZstdCompressionDict(data[8 : 8 + size]) if size else None
        rest, frames = data[8 + size :], 0
        while rest:
            plain = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            record = plain.decompress(rest)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            rest, frames = plain.unused_data, frames + 1
        assert frames == len(list(read_archive(io.BytesIO(data))))
    assert max(sizes) > 0


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(archive_pages(spark, none, f"file://{tmp_path}/none")).count() == 0
