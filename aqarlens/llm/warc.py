"""WARC archives whose records share an embedded Zstandard dictionary.

Every task writes archive files of its own: a leading skippable frame holds a
dictionary trained on the file's first records (``SAMPLE_BYTES`` of them, a
documented bound; every record is then compressed with it), and each record
is one Zstandard frame, so any record can be read alone.  A payload of
``min_payload`` bytes or more is stored once, by the page with the smallest id;
the others become revisit records that name it.

Files are named per task attempt and the manifest (a stage table that Spark
commits) lists those of successful attempts only, so retries and lost
executors leave nothing half-written in what is read back.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.llm.common import new_folder, stage

#: Magic number of the skippable frame that holds a dictionary (fixed by the format).
DICTIONARY_MAGIC = 0x184D2A5D
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
FILE_BYTES = 1 << 30
MIN_PAYLOAD = 100

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(page_id, refers_to) of the pages whose payload an earlier page already has.

    Only ids and digests are shuffled.  The smallest id per digest is a
    partially aggregated minimum, and the way back is a join whose hot digests
    AQE splits.  Rows that repeat an id and payload are all responses; pages
    without an id refer to the smallest id that has the payload.
    """
    keys = pages.select("page_id", "digest").where(F.col("payload_bytes") >= min_payload)
    first = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    pairs = keys.join(first.drop("n"), "digest").where("not page_id <=> refers_to and refers_to is not null")
    return pairs.select("page_id", "digest", "refers_to").distinct()


def records_to_write(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Page rows with digest, length and refers_to; revisits carry no payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns(
        {"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    seen = revisits(rows, min_payload).withColumnsRenamed({"page_id": "__id", "digest": "__digest"})
    on = rows["page_id"].eqNullSafe(seen["__id"]) & (rows["digest"] == seen["__digest"])
    payload = F.when(F.col("refers_to").isNull(), F.col("payload")).cast("binary")
    return rows.join(seen, on, "left").select(
        "page_id", "url", "payload_bytes", "digest", "refers_to", payload.alias("payload")
    )


def _record(page_id, url, n_bytes, digest, refers_to, payload) -> bytes:
    """One WARC record; the block of a revisit is the response's header without its body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"") if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url is not None:
        # Line ends would break the header; per cent signs keep the way back exact.
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary of the records; empty if they are too few or too uniform."""
    if len(records) < 8 or sum(map(len, records)) < 8 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, records)) // 4), records).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """One archive file: the dictionary frame first, then a frame per record."""

    def __init__(self, stream, sample: list[bytes]):
        self.stream, self.n_records, self.n_bytes = stream, 0, 0
        dictionary = train_dictionary(sample)
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=data)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.n_records += 1


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write every row of ``records_to_write`` into archives below ``folder``; returns the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        sample, sampled, writer, path, stream, done = [], 0, None, None, None, []

        def begin():
            nonlocal writer, path, stream
            path = f"part-{uuid.uuid4().hex}.warc.zst"
            stream = fs.open_output_stream(posixpath.join(root, path))
            writer = ArchiveWriter(stream, sample)

        def end():
            nonlocal writer
            stream.close()
            done.append((f"{folder}/{path}", writer.n_records, writer.n_bytes))
            writer = None

        def put(record):
            if writer is None:
                begin()
            writer.add(record)
            if writer.n_bytes >= FILE_BYTES:
                end()

        waiting = True
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload_bytes", "digest", "refers_to", "payload")]
            for k in range(batch.num_rows):
                record = _record(*(c[k].as_py() for c in columns))
                if waiting:
                    sample.append(record)
                    sampled += len(record)
                    if sampled < SAMPLE_BYTES:
                        continue
                    waiting = False
                    for held in sample:
                        put(held)
                else:
                    put(record)
        if waiting:
            for held in sample:
                put(held)
        if writer is not None:
            end()
        if done:
            names, counts, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"path": list(names), "n_records": pa.array(counts, pa.int64()), "n_bytes": pa.array(sizes, pa.int64())}
            )

    return stage(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def _exactly(stream, n: int) -> bytes:
    parts = []
    while n:
        part = stream.read(n)
        if not part:
            raise EOFError("the archive ends within a record")
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, one record in memory at a time."""
    magic, size = struct.unpack("<II", _exactly(stream, 8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    dictionary = _exactly(stream, size)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    plain = zstandard.ZstdDecompressor(dict_data=data).stream_reader(stream, read_across_frames=True)
    held = b""
    while True:
        while (at := held.find(b"\r\n\r\n")) < 0:
            part = plain.read(1 << 16)
            if not part:
                if held:
                    raise EOFError("the archive ends within a header")
                return
            held += part
        headers = dict(line.split(": ", 1) for line in held[:at].decode().split("\r\n")[1:])
        held = held[at + 4 :]
        size = int(headers["Content-Length"]) + 4
        if len(held) < size:
            held += _exactly(plain, size - len(held))
        yield headers, held[: size - 4]
        held = held[size:]


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_archives(manifest: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """All records of the manifest's archives as rows of ``RECORDS``.

    The digest of a response is computed from the payload read back and
    compared with its header; a revisit's comes from its header, as does the
    length of the payload it stands for.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def rows_of(path: str) -> Iterator[tuple]:
        fs, name = pafs.FileSystem.from_uri(path)
        with fs.open_input_stream(name) as stream:
            for headers, block in read_archive(stream):
                at = block.index(b"\r\n\r\n")
                length = int(block[:at].rsplit(b"Content-Length: ", 1)[1])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                payload = None
                if headers["WARC-Type"] == "response":
                    payload = block[at + 4 :]
                    if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"a payload of {path} does not match its header")
                url = headers.get("WARC-Target-URI")
                if url is not None:
                    url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                page, seen = _page(headers["WARC-Record-ID"]), _page(headers.get("WARC-Refers-To"))
                yield page, url, length, digest, headers["WARC-Type"], seen, payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in rows_of(path):
                    rows.append(row)
                    size += 256 + len(row[-1] or b"")
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                            schema=schema,
                        )
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                        schema=schema,
                    )

    files = manifest.select("path").repartition(max(8, manifest.sparkSession.sparkContext.defaultParallelism))
    return files.mapInArrow(read, RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write a record per page below ``folder`` and return the manifest.

    Null html is an empty payload, a null url leaves out the target header and
    a null page_id gives a record without a number.  Of equal payloads shorter
    than ``min_payload`` bytes each is stored.  Rows that repeat an id and a
    payload are stored each.  Other columns are not read.  An empty table
    writes no file.
    """
    return write_archives(records_to_write(pages, min_payload), folder)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = read_archives(archive_pages(spark, pages, new_folder(spark, "warc")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS f
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to
FROM f
"""
