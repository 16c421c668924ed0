from __future__ import annotations

import hashlib
import struct

import pytest
import zstandard

from ledgerlane.llm import warc
from ledgerlane.sources.publish import scratch

SCHEMA = "page_id long, url string, html string, digest string, size string"


def archive(spark, rows, partitions=3):
    uri = scratch(spark, "test-warc")
    frame = spark.createDataFrame([(i, u, h, "d", "s") for i, u, h in rows], SCHEMA).repartition(partitions)
    files = warc.write_archives(frame, uri)
    return uri, files, warc.read_archives(spark, uri, files)


def expected(rows):
    payloads = [(h or "").encode() for _, _, h in rows]
    out = []
    for (page, _, _), payload in zip(rows, payloads):
        same = [i for (i, _, _), p in zip(rows, payloads) if p == payload and i is not None]
        revisit = len(payload) >= 1000 and same and page != max(same)
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return out


def key(row):
    return tuple(map(str, row))


ROWS = [
    *((k, f"http://site{k}.example/ä", f"<html>{'page %d ' % (k % 7) * 300}</html>") for k in range(60)),
    *((100 + k, None, f"<p>tiny {k % 3}</p>\r\n\r\nWARC/1.1\r\n\r\n") for k in range(9)),
    (200, "http://x.example/ with\nbreaks", None),
    (201, "", ""),
    (None, "u", "z" * 5000),
    (None, "u", "z" * 5000),
    (None, "u", f"<html>{'page 1 ' * 300}</html>"),
    (300, "u", "é€😀" * 400),
    (301, "u", "é€😀" * 400),
    (302, "u", "x" * 1_500_000),
]


def test_round_trip(spark):
    _, _, read = archive(spark, ROWS)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect()]
    assert sorted(found, key=key) == sorted(expected(ROWS), key=key)


def test_archives_can_be_read_without_this_module(spark):
    uri, files, _ = archive(spark, ROWS)
    payloads = []
    for row in files.collect():
        data = open(f"{uri.removeprefix('file:')}/{row.file}", "rb").read()
        kind, size = struct.unpack("<II", data[:8])
        assert kind == 0x184D2A5D
        reader, rest, records = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])), data[8 + size :], 0
        while rest:
            frame = reader.decompressobj()
            record, rest, records = frame.decompress(rest), frame.unused_data, records + 1
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            head, block, _ = warc.parse(record)
            if head["warc-type"] == "response":
                payloads.append(record.partition(b"\r\n\r\n")[2].partition(b"\r\n\r\n")[2][:-4])
        assert records == row.records
    assert sorted(payloads) == sorted((h or "").encode() for (_, _, h), e in zip(ROWS, expected(ROWS)) if e[3] == "response")


def test_dictionary_makes_archives_smaller(spark, monkeypatch):
    rows = [(k, f"http://site.example/{k}", f"<html><head><title>{k}</title></head><body class='wide'><p>text number {k * k}</p></body></html>") for k in range(400)]
    size = lambda uri, files: sum(len(open(f"{uri.removeprefix('file:')}/{r.file}", "rb").read()) for r in files.collect())
    with_dictionary = size(*archive(spark, rows, 1)[:2])
    monkeypatch.setattr(warc, "build_dictionary", lambda samples: b"")
    assert with_dictionary < 0.7 * size(*archive(spark, rows, 1)[:2])


def test_repeated_rows_of_the_largest_id_are_responses(spark):
    rows = [(5, "u", "y" * 2000)] * 3 + [(4, "u", "y" * 2000)]
    _, _, read = archive(spark, rows)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in read.collect()) == [(4, "revisit", 5)] + [(5, "response", None)] * 3


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    uri = scratch(spark, "test-warc")
    files = warc.write_archives(frame, uri)
    assert files.count() == 0 and warc.read_archives(spark, uri, files).count() == 0


def test_a_cut_archive_is_refused(tmp_path):
    import pyarrow as pa

    record = zstandard.ZstdCompressor().compress(warc.compose(1, "u", b"abc" * 100, "0" * 40, 300, None))
    whole = struct.pack("<II", warc.SKIPPABLE, 0) + record
    assert len(list(warc.frames(pa.BufferReader(whole)))) == 1
    with pytest.raises(ValueError):
        list(warc.frames(pa.BufferReader(whole[:-5])))
