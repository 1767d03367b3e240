"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", name: str = "readloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. On a cluster use the cluster's own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.driver.memory", memory)
    shuffle = str(cpus) if str(cpus).isdigit() else "8"
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": shuffle}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows that one task of a shuffle is meant to get.
TASK_ROWS = 500_000
#: Bytes of files that one task is meant to read, where it also counts groups before the shuffle.
TASK_BYTES = 16 << 20


def partitions_for(df: DataFrame) -> int:
    """Partitions for a shuffle of the rows of ``df``, so that a task's share does not grow with the table.

    ``df`` should be a table as read or stored: counting its rows then reads no column.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


@contextmanager
def many_partitions(df: DataFrame) -> Iterator[bool]:
    """For what is computed inside: as many partitions at each shuffle as the rows of ``df`` need.

    Shuffles of aggregates and joins take their number of partitions from the session, however many rows there
    are, and adaptive execution merges them by compressed bytes, which say little of the memory of a row.
    The settings change only where the rows need more than a partition for each core, and are set back;
    gives whether that is so, as a lazy plan would run without them.
    """
    conf, needed = df.sparkSession.conf, partitions_for(df)
    if needed <= df.sparkSession.sparkContext.defaultParallelism:
        yield False
        return
    wanted = {
        "spark.sql.shuffle.partitions": str(max(needed, int(conf.get("spark.sql.shuffle.partitions")))),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
    }
    before = {key: conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            conf.set(key, value)
        yield True
    finally:
        for key, value in before.items():
            conf.set(key, value)


#: Rows of an Arrow batch where they hold whole texts.
TEXT_ROWS = 500


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """For what is computed inside: Arrow batches of at most ``TEXT_ROWS`` rows.

    A batch is counted in rows, and stands several times in the memory of an executor and of its Python
    workers; ten thousand texts of some kilobytes are tens of megabytes each time, long ones far more.
    The setting is set back, so a lazy plan would run without it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        # Zero or less is no limit.
        spark.conf.set(key, str(min(TEXT_ROWS, int(before)) if int(before) > 0 else TEXT_ROWS))
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared checkpoint folder, its lineage cut.

    For small aggregates that several plans start from: these are then short to build, and
    what is behind the aggregate is read once.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed now and kept as Parquet in the shared scratch folder: for tables as long as the input."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, bench) falls back to a temporary
    folder of this machine; a cluster session without it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "readloom")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
