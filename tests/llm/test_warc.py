import base64
import hashlib
import io
import struct

import pytest
import zstandard
from cases import LONG
from pyspark.sql import functions as F

from readloom.llm import warc

PAGES = [
    (1, "http://a/", "<p>same</p>"),
    (2, "http://b/ with space\r\nX: y", "<p>same</p>"),
    (3, None, None),
    (4, "http://d/", ""),
    (5, "http://e/%41", LONG),
    (None, "http://f/", "<p>same</p>"),
    (None, "http://g/", "alone"),
    (0, "http://h/", "<p>other</p>"),
    (0, "http://h/", "<p>other</p>"),
    (9, "ü", "Ünï <p>other</p>\r\n\r\nWARC/1.1\r\n"),
]


def expected(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def table(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("payload", F.lit(1)).withColumn("first", F.lit("mine")).withColumn("digest", F.lit(2))


@pytest.mark.parametrize("size", [1, 16 << 20])
def test_round_trip(spark, tmp_path, size):
    archives = warc.write_pages(table(spark, PAGES), str(tmp_path), archive_bytes=size)
    rows = warc.read_archives(archives).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected(PAGES)
    assert {r["url"] for r in rows} == {u or "" for _, u, _ in PAGES}
    assert archives.agg(F.sum("records")).first()[0] == len(PAGES)


def test_smaller_payloads_are_all_responses(spark, tmp_path):
    rows = warc.read_archives(warc.write_pages(table(spark, PAGES), str(tmp_path), least=1000)).collect()
    assert {r["record_type"] for r in rows} == {"response"}


def test_empty_table(spark, tmp_path):
    archives = warc.write_pages(table(spark, PAGES).where("false"), str(tmp_path))
    assert warc.read_archives(archives).count() == 0


def archive(pages):
    out = io.BytesIO()
    warc.write_archive(out, pages)
    return out.getvalue()


def read(data):
    return list(warc.read_archive(io.BytesIO(data), "x", block=37))


ONE = [warc.Page(i, f"u{i}", f"<p>{i}</p>".encode() * 40, None, False) for i in range(300)]


def test_dictionary_leads_and_frames_are_records():
    data = archive(ONE)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 0
    assert [r[0] for r in read(data)] == list(range(300))
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    assert plain.decompressobj().decompress(data[8 + size :]) == warc.record(ONE[0])


def test_compressed_dictionary():
    data = archive(ONE)
    size = struct.unpack("<II", data[:8])[1]
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed + data[8 + size :]
    assert read(again) == read(data)


def broken(change):
    record = change(warc.record(ONE[0]))
    return struct.pack("<II", warc.SKIPPABLE, 0) + zstandard.ZstdCompressor().compress(record)


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/7"),
        lambda r: r.replace(b"WARC-Date", b"WARC-Dote"),
        lambda r: r.replace(b"</p>", b"</q>"),
        lambda r: r[:-1],
        lambda r: r + b"x",
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: metadata"),
        lambda r: r.replace(b"\r\n\r\n", b"\n"),
        lambda r: r.replace(b"Content-Length: 4", b"Content-Length: 5"),
        lambda r: r.replace(b"sha1:", b"md5:"),
        lambda r: r.replace(b"urn:page:0", b"urn:page:x"),
    ],
)
def test_broken_records_are_errors(change):
    with pytest.raises(warc.BadArchive):
        read(broken(change))


def test_broken_archives_are_errors():
    data = archive(ONE)
    for bad in (data[:5], b"\x00" * 20, data[:-3], data + b"junk", data[: struct.unpack("<II", data[:8])[1]]):
        with pytest.raises(warc.BadArchive):
            read(bad)
    assert read(data[: 8 + struct.unpack("<II", data[:8])[1]]) == []
