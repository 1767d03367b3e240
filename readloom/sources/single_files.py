"""Text files that all tasks write together: one whole file for each name.

Spark's own writers leave a file for each task. Here every task writes the lines of all names that
it meets as *pieces* into one file of its own, each piece a whole gzip member (a
concatenation of members is one ``.gz`` file) or plain text. What it returns is the index
of its pieces; Spark commits that as a table, so pieces of a task attempt that failed or lost
are in no index. From the index follows where each piece belongs in its file, and a second job,
again of all tasks, copies the pieces to their places. The folder then gets its name
in one step. No task and not the driver sees a whole file, and a copy that runs twice
writes the same bytes to the same place.

Lines keep the order of the rows: pieces stand in the order of partitions.

Writing at a place needs a file system that executors mount (a path, or ``file:``); on
others an error says so. A null name, or one that would leave the folder, is an error.
"""

from __future__ import annotations

import gzip
import os
import shutil
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INDEX = "name string, part int, seq int, piece string, at long, bytes long, lines long"
#: Bytes of a name's lines that make a piece, and of all lines that a task holds.
PIECE, HELD = 1 << 22, 1 << 25
COPY = 1 << 22


def local_path(path: str) -> str:
    """The path that executors open, of a qualified one."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"one file for each name needs a mounted file system that all executors share, not {path}")
    return path


def piece_writer(folder: str, compress: bool):
    """From batches (name, line) to the index of the pieces written below ``folder``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        piece = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        index, at, total, out = [], 0, 0, None

        def flush(name: str) -> int:
            nonlocal at, out
            lines, size = held.pop(name), sizes.pop(name)
            data = b"".join(lines)
            data = gzip.compress(data, 6, mtime=0) if compress else data
            out = out or open(piece, "xb")
            out.write(data)
            index.append((name, part, len(index), piece, at, len(data), len(lines)))
            at += len(data)
            return size

        try:
            for batch in batches:
                for name, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                    line += b"\n"
                    held.setdefault(name, []).append(line)
                    sizes[name] = sizes.get(name, 0) + len(line)
                    total += len(line)
                    if sizes[name] >= PIECE:
                        total -= flush(name)
                    while total >= HELD:
                        total -= flush(max(sizes, key=sizes.get))
            for name in list(held):
                flush(name)
        finally:
            if out:
                out.flush()
                os.fsync(out.fileno())
                out.close()
        if index:
            columns = [pa.array(c) for c in zip(*index)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], [x.split()[0] for x in INDEX.split(", ")])

    return write


def copier(folder: str, ending: str, header: bytes):
    """From batches (name, piece, at, bytes, place, lines) to (name, bytes, lines) of what was copied."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, piece, at, size, place, _ in zip(*(c.to_pylist() for c in batch.columns)):
                target = os.open(f"{folder}/{name}{ending}", os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    if place == 0 and header:
                        os.pwrite(target, header, 0)
                    if piece is None:
                        continue
                    with open(piece, "rb") as source:
                        source.seek(at)
                        left, place = size, place + len(header)
                        while left:
                            data = source.read(min(left, COPY))
                            if not data:
                                raise OSError(f"{piece} ends before its pieces do")
                            os.pwrite(target, data, place)
                            left, place = left - len(data), place + len(data)
                finally:
                    os.close(target)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(5)], ["name", "bytes", "lines"])

    return copy


def placed_pieces(index: DataFrame) -> DataFrame:
    """(name, piece, at, bytes, place, lines): where in its name's file each piece begins.

    Sums over the pieces of a task, then over the tasks of a name: no window holds all pieces of a name.
    """
    before = Window.unboundedPreceding, -1
    parts = index.groupBy("name", "part").agg(F.sum("bytes").alias("all"))
    parts = parts.select(
        F.col("name").alias("of"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("all").over(Window.partitionBy("name").orderBy("part").rowsBetween(*before)), F.lit(0)).alias("skip"),
    )
    within = F.coalesce(F.sum("bytes").over(Window.partitionBy("name", "part").orderBy("seq").rowsBetween(*before)), F.lit(0))
    pieces = index.withColumn("within", within)
    found = pieces.join(parts, (F.col("name") == F.col("of")) & (F.col("part") == F.col("of_part")))
    return found.select("name", "piece", "at", "bytes", (F.col("within") + F.col("skip")).alias("place"), "lines")


def write_files(
    rows: DataFrame,
    path: str,
    ending: str = "",
    compress: bool = False,
    header: str | None = None,
    names: Sequence[str] = (),
    before_publishing: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Write ``rows`` (name, line) to ``path``/name+ending, and return (file, bytes, lines) of each.

    ``names`` get a file even without lines. With ``header`` every file begins with that line.
    ``path`` must not be there yet; it gets its name after ``before_publishing``, unless that
    raises an error. After an error the caller clears the folder ``path``.* beside it.
    """
    spark = rows.sparkSession
    # Send the writers' code along, so that workers need not have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    final = local_path(files.makeQualified(place).toString())
    work = f"{final.rstrip('/')}.{uuid.uuid4().hex}"
    if os.path.exists(final):
        raise FileExistsError(final)
    for folder in ("pieces", "files"):
        os.makedirs(f"{work}/{folder}")
    wrong = F.raise_error(F.concat(F.lit("no file name: "), F.coalesce("name", F.lit("null"))))
    usable = F.col("name").isNotNull() & ~F.col("name").rlike(r"/|\x00") & ~F.col("name").isin("", ".", "..")
    checked = rows.select(F.when(usable, F.col("name")).otherwise(wrong).alias("name"), F.coalesce("line", F.lit("")).alias("line"))
    checked.mapInArrow(piece_writer(f"{work}/pieces", compress), INDEX).write.parquet(f"file://{work}/index")
    index = spark.read.schema(INDEX).parquet(f"file://{work}/index")
    if names:
        none = spark.createDataFrame([(n, -1, 0, None, 0, 0, 0) for n in names], INDEX)
        index = index.unionByName(none)
    begin = f"{header}\n".encode() if header is not None else b""
    begin = gzip.compress(begin, 6, mtime=0) if begin and compress else begin
    # Pieces without bytes come first at their place, so that a file's header stands before its first piece.
    copied = placed_pieces(index).hint("rebalance").mapInArrow(
        copier(f"{work}/files", ending, begin), "name string, bytes long, lines long"
    )
    copied.groupBy("name").agg(
        F.concat("name", F.lit(ending)).alias("file"), (F.sum("bytes") + len(begin)).alias("bytes"), F.sum("lines").alias("lines")
    ).drop("name").write.parquet(f"file://{work}/written")
    before_publishing()
    os.rename(f"{work}/files", final)
    shutil.rmtree(f"{work}/pieces")
    return spark.read.parquet(f"file://{work}/written")
