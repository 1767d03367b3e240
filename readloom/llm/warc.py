"""Zstandard WARC archives: written with a dictionary, read back record by record.

An archive begins with a skippable frame that holds its dictionary (magic number
0x184D2A5D); each record then is a Zstandard frame of its own. The reader loads the
dictionary, decodes frame by frame, and checks what it finds: the version line, the
needed headers, that the block is as long as ``Content-Length`` says and followed by two
line ends, that the payload has the length and SHA-1 its headers say, and that nothing is
left over. A file that breaks one of these is an error that names file and offset.

Of records with equal payloads of ``least`` bytes or more, that with the smallest id is a
response; the others are revisits of the profile "identical payload digest", which hold
the headers and refer to it. Rows that share this smallest id and payload are all
responses. Archives are written by the tasks into a shared folder under names of their
own, so that a task that is run again spoils nothing; the list of those of successful
tasks is kept in a checkpoint. An archive ends at ``archive_bytes`` of payload; a record is
never cut.

Defined results: a null payload is empty, a null address is empty; a null id is written
as such and read back as null, and is never the smallest if there is another; an empty
table writes no archive; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import checkpoint

# Magic numbers of the dictionary's skippable frame and of a Zstandard frame.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")
NAME = "urn:page:"
DATE = "2024-01-01T00:00:00Z"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
#: Payloads that a dictionary is made from, and its size.
TAUGHT, DICTIONARY = 200, 16 << 10


class BadArchive(ValueError):
    pass


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def one_line(value: str) -> str:
    """A header's value: control characters would end it, so they are written as in an address."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def plain_value(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


@dataclass(frozen=True)
class Page:
    page_id: int | None
    url: str
    payload: bytes
    first: int | None  # page that this one repeats; itself for a response
    revisit: bool


def record(page: Page) -> bytes:
    """The whole record, with its two line ends."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(page.payload)}\r\n\r\n"
    ).encode()
    block = http if page.revisit else http + page.payload
    headers = [
        ("WARC-Type", "revisit" if page.revisit else "response"),
        ("WARC-Record-ID", f"<{NAME}{'' if page.page_id is None else page.page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", one_line(page.url)),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(page.payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page.revisit:
        headers += [("WARC-Refers-To", f"<{NAME}{page.first}>"), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary for such payloads; empty if there is too little to learn from."""
    some = [p for p in payloads[:TAUGHT] if p]
    try:
        return zstandard.train_dictionary(min(DICTIONARY, sum(map(len, some)) // 10), some).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(some)[:DICTIONARY] if some else b""


def write_archive(out, pages: list[Page]) -> None:
    learnt = dictionary([p.payload for p in pages if not p.revisit])
    out.write(struct.pack("<II", SKIPPABLE, len(learnt)) + learnt)
    packed = zstandard.ZstdCompressor(
        level=3, dict_data=zstandard.ZstdCompressionDict(learnt) if learnt else None, write_content_size=True
    )
    for page in pages:
        out.write(packed.compress(record(page)))


def headers_of(lines: bytes, at: str) -> dict[str, str]:
    first, *rest = lines.decode().split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", first):
        raise BadArchive(f"{at}: no version line")
    found = {}
    for line in rest:
        name, colon, value = line.partition(":")
        if not colon or not name or name in found:
            raise BadArchive(f"{at}: header {line!r}")
        found[name] = value.strip()
    lacking = [n for n in NEEDED if n not in found]
    if lacking:
        raise BadArchive(f"{at}: lacks {', '.join(lacking)}")
    return found


def id_of(name: str, at: str) -> int | None:
    found = re.fullmatch(rf"<{NAME}(-?\d*)>", name)
    if not found:
        raise BadArchive(f"{at}: record id {name!r}")
    return int(found[1]) if found[1] else None


def parse(data: bytes, at: str) -> tuple:
    """Row of ``READ`` of one decoded record, after all checks."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise BadArchive(f"{at}: headers don't end")
    headers = headers_of(head, at)
    if not headers["Content-Length"].isdigit():
        raise BadArchive(f"{at}: Content-Length {headers['Content-Length']!r}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive(f"{at}: the block is not {length} bytes and two line ends")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^Content-Length: *(\d+)\r?$", http)
    if not gap or not http.startswith(b"HTTP/1.") or not stated:
        raise BadArchive(f"{at}: no HTTP headers with a length")
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"]
    if not re.fullmatch(r"sha1:[A-Z2-7]{32}", digest):
        raise BadArchive(f"{at}: payload digest {digest!r}")
    refers_to = None
    if kind == "response":
        if len(payload) != int(stated[1]) or digest != f"sha1:{base32_sha1(payload)}":
            raise BadArchive(f"{at}: the payload differs from its length or digest")
    elif kind == "revisit":
        if payload or "WARC-Refers-To" not in headers or headers.get("WARC-Profile") != PROFILE:
            raise BadArchive(f"{at}: not a revisit of a known profile")
        refers_to = id_of(headers["WARC-Refers-To"], at)
    else:
        raise BadArchive(f"{at}: record type {kind!r}")
    url = plain_value(headers.get("WARC-Target-URI", ""))
    return id_of(headers["WARC-Record-ID"], at), int(stated[1]), digest[5:], kind, refers_to, url


def read_archive(file, name: str, block: int = 1 << 18) -> Iterator[tuple]:
    """Rows of ``READ`` of an open archive, a frame at a time."""
    start = file.read(8)
    if len(start) < 8:
        raise BadArchive(f"{name}: no leading frame")
    magic, size = struct.unpack("<II", start)
    learnt = file.read(size)
    if magic != SKIPPABLE or len(learnt) != size:
        raise BadArchive(f"{name}: no dictionary frame")
    if learnt[:4] == FRAME:  # a dictionary may itself be compressed
        learnt = zstandard.ZstdDecompressor().decompressobj().decompress(learnt)
    context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learnt) if learnt else None)
    held, offset = file.read(block), 8 + size
    while held:
        frame, data, taken = context.decompressobj(), [], 0
        if held[:4] != FRAME[: len(held[:4])]:
            raise BadArchive(f"{name} at {offset}: not a Zstandard frame")
        while True:
            try:
                data.append(frame.decompress(held))
            except zstandard.ZstdError as broken:
                raise BadArchive(f"{name} at {offset}: {broken}") from None
            taken += len(held)
            if frame.eof:
                held = frame.unused_data
                taken -= len(held)
                break
            held = file.read(block)
            if not held:
                raise BadArchive(f"{name} at {offset}: the last frame is cut off")
        yield parse(b"".join(data), f"{name} at {offset}")
        offset += taken
        held = held or file.read(block)


def marked(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """(page_id, url, payload, first, revisit): which page each one repeats."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    firsts = rows.where(F.length("payload") >= least).groupBy("digest", F.length("payload").alias("size"))
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1")
    # A table of its own: the join then shuffles both sides, and a payload in very many rows can be split.
    firsts = checkpoint(firsts.select(F.col("digest").alias("of"), "size", "first"), spread=True)
    same = (F.col("digest") == F.col("of")) & (F.length("payload") == F.col("size"))
    met = rows.join(firsts, same, "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return met.select("page_id", "url", "payload", "first", revisit.alias("revisit"))


def write_pages(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    archive_bytes: int = 16 << 20,
) -> DataFrame:
    """Write archives of all rows; (path, records) of each."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        held: list[Page] = []
        size = 0

        def written() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}") as out:
                write_archive(out, held)
            columns = [pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([len(held)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["path", "records"])

        for batch in batches:
            for row in zip(*batch.columns):
                page, address, payload, first, revisit = (x.as_py() for x in row)
                held.append(Page(page, address or "", payload or b"", first, revisit))
                size += len(held[-1].payload)
                if size >= archive_bytes:
                    yield written()
                    held, size = [], 0
        if held:
            yield written()

    return checkpoint(marked(pages, page_id, url, html, least).mapInArrow(write, "path string, records long"))


def read_archives(archives: DataFrame, path: str = "path") -> DataFrame:
    """Rows of ``READ`` of all records in the archives named by a column."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in READ.split(",")]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, place = filesystem(uri)
                with store.open_input_stream(place) as file:
                    rows = list(read_archive(file, uri))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return archives.select(F.col(f"`{path}`").alias("path")).mapInArrow(read, READ)
