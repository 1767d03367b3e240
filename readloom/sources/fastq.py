"""FASTQ as a Spark data source, and the writer.

Plain files are cut into byte ranges, one partition each. A record belongs to the
range in which its header line starts; a reader finds the first one by looking for
four lines that form a record, because '@' may also open a quality line. Files ending
in .gz cannot be entered in the middle and are one partition each.

Files are opened through ``pyarrow.fs``, so any URI it knows can be read. Bytes are
handled in blocks of a few megabytes and go to Spark as Arrow batches.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .reports import sample_folder
from .single_files import write_files

SCHEMA = "path string, read_id string, seq string, qual string"
ARROW_SCHEMA = pa.schema([(c, pa.string()) for c in ("path", "read_id", "seq", "qual")])
BLOCK = 4 << 20
RANGE = 128 << 20
# Names of read files, and of the parts that :func:`write_fastq` writes.
ENDING = re.compile(r"(\.(fastq|fq)|(^|/)part-[^/]*\.txt)(\.gz)?$")


def open_filesystem(path: str):
    """File system and path in it. Paths without a scheme, or with that of files, are local or mounted."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def header_lines(stream, block: int = 1 << 16) -> list[str]:
    """Lines of an open file up to the first that doesn't begin with '@' and two capitals."""
    lines, rest = [], b""
    while True:
        data = stream.read(block)
        *whole, rest = (rest + data).split(b"\n")
        for line in [*whole, *([] if data else [rest])]:
            if not re.match(rb"@[A-Z][A-Z](\t|$)", line):
                return lines
            lines.append(line.decode().rstrip("\r"))
        if not data:
            return lines


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


def _is_record(lines: list[bytes]) -> bool:
    return (
        lines[0].startswith(b"@")
        and lines[2].startswith(b"+")
        and len(lines[1].rstrip(b"\r")) == len(lines[3].rstrip(b"\r"))
    )


def first_record(data: bytes) -> int | None:
    """Offset of the first header after the first line end; None if bytes are missing.

    Two records in a row must fit, so that a quality line that starts with '@' is not
    taken for a header.
    """
    at = data.find(b"\n") + 1
    if at == 0:
        return None
    for _ in range(4):
        lines = data[at:].split(b"\n", 8)
        if len(lines) < 9:
            return None
        if _is_record(lines[0:4]) and _is_record(lines[4:8]):
            return at
        at += len(lines[0]) + 1
    raise ValueError("not a FASTQ file: no record within four lines")


def to_batch(path: str, text: bytes) -> pa.RecordBatch:
    """Whole records -> one Arrow batch."""
    lines = text.decode("ascii").replace("\r\n", "\n").split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    heads, seqs, quals = lines[0::4], lines[1::4], lines[3::4]
    whole = len(lines) % 4 == 0 and all(h.startswith("@") for h in heads) and all(p.startswith("+") for p in lines[2::4])
    if not whole or any(len(s) != len(q) for s, q in zip(seqs, quals)):
        raise ValueError(f"broken FASTQ record in {path}")
    ids = [h[1:].split(None, 1)[0] if len(h) > 1 else "" for h in heads]
    columns = [pa.array([path] * len(ids), pa.string()), pa.array(ids), pa.array(seqs), pa.array(quals)]
    return pa.record_batch([c.cast(pa.string()) for c in columns], schema=ARROW_SCHEMA)


def cut_records(data: bytes) -> int:
    """Length of the leading part of ``data`` that is whole records."""
    spare = data.count(b"\n") % 4
    end = len(data)
    for _ in range(spare + 1):
        end = data.rfind(b"\n", 0, end)
    return end + 1


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.range = int(options.get("rangebytes", RANGE))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        parts: list[InputPartition] = []
        for root in self.paths:
            files, inner = open_filesystem(root)
            info = files.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(root)
            if info.type == fs.FileType.Directory:
                found = files.get_file_info(fs.FileSelector(inner, recursive=True))
                infos = [i for i in found if i.type == fs.FileType.File and _is_data(i.path[len(inner) :])]
            else:
                infos = [info]
            prefix = root[: root.index(inner)] if inner in root else ""
            for i in sorted(infos, key=lambda i: i.path):
                step = i.size if i.path.endswith(".gz") else self.range
                parts += [
                    ByteRange(prefix + i.path, s, min(s + step, i.size)) for s in range(0, i.size, max(step, 1))
                ]
        return parts or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if partition.start >= partition.end:
            return
        files, inner = open_filesystem(partition.path)
        if inner.endswith(".gz"):
            with files.open_input_stream(inner, compression="gzip") as stream:
                yield from self._whole(partition.path, stream)
        else:
            with files.open_input_file(inner) as handle:
                yield from self._part(partition, handle)

    def _whole(self, path: str, stream) -> Iterator[pa.RecordBatch]:
        rest = b""
        while block := stream.read(BLOCK):
            data = rest + block
            cut = cut_records(data)
            if cut:
                yield to_batch(path, data[:cut])
            rest = data[cut:]
        if rest.strip():
            yield to_batch(path, rest)

    def _part(self, part: ByteRange, handle) -> Iterator[pa.RecordBatch]:
        # Start one byte early: a header that opens the range follows a line end.
        at = max(part.start - 1, 0)
        handle.seek(at)
        data = handle.read(BLOCK)
        if part.start:
            while (begin := first_record(data)) is None:
                more = handle.read(BLOCK)
                if not more:
                    begin = last_records(data)
                    break
                data += more
            at, data = at + begin, data[begin:]
        while data and at < part.end:
            more = handle.read(BLOCK)
            cut = cut_records(data) if more else len(data)
            chunk = records_before(data[:cut], part.end - at)
            if chunk.strip():
                yield to_batch(part.path, chunk)
            at, data = at + cut, data[cut:] + more


def _is_data(path: str) -> bool:
    """Whether a path below the folder that is read names a read file, and nothing on its way is hidden."""
    return bool(ENDING.search(path)) and not any(part.startswith((".", "_")) for part in path.split("/"))


def records_before(records: bytes, limit: int) -> bytes:
    """The records whose header starts before offset ``limit``."""
    if len(records) <= limit:
        return records
    ends = (m.end() for i, m in enumerate(re.finditer(b"\n", records)) if i % 4 == 3)
    return records[: next((end for end in ends if end >= limit), len(records))]


def last_records(data: bytes) -> int:
    """Offset of the first header in a file's last lines, counted from its end.

    ``data`` starts inside a line. Used when fewer than two whole records are left.
    """
    lines = data.removesuffix(b"\n").split(b"\n")
    for i in range(1 + (len(lines) - 1) % 4, len(lines), 4):
        if all(_is_record(lines[j : j + 4]) for j in range(i, len(lines), 4)):
            return sum(len(x) + 1 for x in lines[:i])
    return len(data)


class FastqDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "readloom_fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(dict(self.options))


def sample_of_path(path: str | Column) -> Column:
    """Sample id in a read file's name: no ending, no trailing ``_1`` or ``.sra``. A folder
    ``sample=...`` on the way to the file names it instead."""
    # Patterns begin at the text's first character: else each place of a path without a match is tried.
    name = F.regexp_extract(F.substring_index(path, "/", -1), r"^([^/]+?)(?:\.fastq|\.fq)?(?:\.gz)?$", 1)
    return F.coalesce(
        F.nullif(sample_folder(path), F.lit("")), F.regexp_replace(name, r"(\.trimmed|_1|\.sra)+$", "")
    )


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark takes it for."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def read_fastq(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """reads(sample, read_id, seq, qual). ``path``: files or folders, comma between.

    In folders, files named like reads are read; what lies under names that begin with
    '.' or '_' is not. A record without its '+' line, or with bases and qualities of
    different number, is an error.
    """
    path = ",".join(qualified(spark, p) for p in path.split(",") if p)
    # Send the reader's code along, so that workers need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FastqDataSource)
    rows = spark.read.format("readloom_fastq").option("rangeBytes", range_bytes).load(path)
    return rows.select(sample_of_path("path").alias("sample"), "read_id", "seq", "qual")


def fastq_text(read_id: str = "read_id", seq: str = "seq", qual: str = "qual") -> Column:
    return F.concat_ws("\n", F.concat(F.lit("@"), F.col(read_id)), F.col(seq), F.lit("+"), F.col(qual))


def write_fastq(reads: DataFrame, path: str, compression: str = "gzip", by_sample: bool = False) -> None:
    """One record per read; with ``by_sample`` in one folder ``sample=...`` per sample,
    from which :func:`read_fastq` takes its name again."""
    text = reads.select(*(["sample"] if by_sample else []), fastq_text().alias("value"))
    writer = text.write.option("compression", compression)
    (writer.partitionBy("sample") if by_sample else writer).text(path)


def write_sample_files(
    reads: DataFrame,
    path: str,
    ending: str = ".fastq.gz",
    samples: Sequence[str] = (),
    before_publishing: Callable[[], None] = lambda: None,
) -> DataFrame:
    """One file for each sample, ``path``/sample+``ending``, and (file, bytes, lines) of each.

    Gzip members or plain text by the ending; ``samples`` get a file even without reads. Reads
    keep the order of the rows.
    """
    rows = reads.select(F.col("sample").alias("name"), fastq_text().alias("line"))
    gz = ending.endswith(".gz")
    return write_files(rows, path, ending, gz, names=samples, before_publishing=before_publishing)
