"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

A file starts with a skippable frame that holds the dictionary; every record behind it is a Zstandard frame of its own, so records
can be read one at a time. The dictionary is built from a bounded sample of the records that are archived.

Of records with equal payloads of at least ``SMALLEST`` bytes, that with the largest page id is the response and the others are revisits
of it: they hold the headers of the response, with its length, and no payload. Records with smaller payloads are all responses.

NULL payload counts as empty. Rows without a page id are archived too; one is never revisited, so copies none of which has an id are
all responses. Rows repeated with the largest id are all responses. An empty table writes no file. NULL and odd URLs are kept as text
without line breaks. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import filesystem, replacing, small
from ledgerlane.sources.publish import store

SMALLEST = 1000
LEVEL = 3
#: Dictionary: its size, and the records and bytes a record it is built from.
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 10, 600, 16 << 10
#: Fixed values of the format: a skippable frame, the magic number of a dictionary and of a frame.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
DATE = "2024-01-01T00:00:00Z"
_READ = 1 << 20

_FILES = "file string, records long"
_ROWS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html_crc32 long"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def compose(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record; a revisit if ``refers_to`` is given, then without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record; names in lower case."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(_field(line) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return named, dict(_field(line) for line in http.decode().split("\r\n")[1:]), payload


def _field(line: str) -> tuple[str, str]:
    name, _, value = line.partition(": ")
    return name.lower(), value


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples' own end where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def frames(source: pa.NativeFile) -> Iterator[bytes]:
    """The records of an archive, one at a time; no more than one and a read-ahead are held."""
    kind, size = struct.unpack("<II", source.read(8))
    if kind != SKIPPABLE:
        raise ValueError("the archive has no dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
    waiting = source.read(_READ)
    while waiting:
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not waiting and not (waiting := source.read(_READ)):
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(waiting))
            waiting = frame.unused_data if frame.eof else b""
        yield b"".join(parts)
        waiting = waiting or source.read(_READ)


def _planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, size and refers_to of every row. Only pages with copies are looked up, by digest."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html").cast("long")})
    copied = rows.where(F.col("size") >= SMALLEST).groupBy("digest").agg(F.count("*").alias("_copies"), F.max("page_id").alias("_response"))
    copied = store(copied.where("_copies > 1 AND _response IS NOT NULL").select(F.col("digest").alias("_digest"), "_response"), "warc-copies")
    rows = rows.join(small(copied), F.col("digest") == F.col("_digest"), "left")
    revisits = F.when((F.col("size") >= SMALLEST) & ~F.col("page_id").eqNullSafe(F.col("_response")), F.col("_response"))
    return rows.select("page_id", "url", "html", "digest", "size", revisits.alias("refers_to"))


def write_archives(pages: DataFrame, uri: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to the folder ``uri``; returns the files and their records.

    Each task writes one file, which appears when it is whole.
    """
    planned = _planned(pages)
    # The sample's records: responses of the smallest digests, one each, cut to a bound. Only digests are compared for it.
    full = planned.where("refers_to IS NULL")
    picked = full.groupBy("digest").agg(F.min("page_id").alias("_page")).orderBy("digest").limit(SAMPLE_RECORDS)
    picked = store(picked.withColumnRenamed("digest", "_picked"), "warc-sample")
    chosen = (F.col("digest") == F.col("_picked")) & F.col("page_id").eqNullSafe(F.col("_page"))
    told = full.join(F.broadcast(picked), chosen).dropDuplicates(["digest"]).orderBy("digest")
    told = told.select("page_id", "url", F.expr(f"left(html, {SAMPLE_BYTES})").alias("html"), "digest", "size").collect()
    book = build_dictionary([compose(r.page_id, r.url, r.html.encode(), r.digest, r.size, None) for r in told])
    shared = pages.sparkSession.sparkContext.broadcast(book)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (files, root), written = filesystem(uri), 0
        name = f"part-{TaskContext.get().partitionId():06d}.warc.zst"
        first = next(batches, None)
        if first is None:
            return
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared.value))
        with replacing(files, f"{root}/{name}") as out:
            out.write(struct.pack("<II", SKIPPABLE, len(shared.value)) + shared.value)
            batch = first
            while batch is not None:
                for row in zip(*(batch.column(k).to_pylist() for k in ("page_id", "url", "html", "digest", "size", "refers_to"))):
                    page_id, url, html, digest, size, refers_to = row
                    out.write(packer.compress(compose(page_id, url, html.encode(), digest, size, refers_to)))
                    written += 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([written], pa.int64())], ["file", "records"])

    return store(planned.mapInArrow(write, _FILES).where("records > 0"), "warc-files")


def read_archives(spark: SparkSession, uri: str, files: DataFrame) -> DataFrame:
    """One row per record, from the archives alone: digests of responses are taken from their payloads, not from their headers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, root = filesystem(uri)
        names = [part.split()[0] for part in _ROWS.split(", ")]
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with source.open_input_stream(f"{root}/{name}", compression=None) as archive:
                    rows = []
                    for record in frames(archive):
                        rows.append(_told(record))
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), _SCHEMA)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), _SCHEMA)

    # One file a task; the list of files is as long as the number of tasks that wrote them.
    count = max(1, files.count())
    return files.repartitionByRange(count, "file").mapInArrow(read, _ROWS)


_SCHEMA = pa.schema([(part.split()[0], pa.string() if part.endswith("string") else pa.int64()) for part in _ROWS.split(", ")])


def _told(record: bytes) -> tuple:
    import zlib

    warc, http, payload = parse(record)
    response = warc["warc-type"] == "response"
    digest = hashlib.sha1(payload).hexdigest() if response else warc["warc-payload-digest"].removeprefix("sha1:")
    return (
        _page_id(warc["warc-record-id"]),
        warc.get("warc-target-uri"),
        len(payload) if response else int(http["content-length"]),
        digest,
        warc["warc-type"],
        None if response else _page_id(warc["warc-refers-to"]),
        zlib.crc32(payload) if response else None,
    )
