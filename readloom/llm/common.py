"""What the operators share: tables, checkpoints, words of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Byte sequences between these are words; the same six as ``bytes.split()`` uses.
WHITE = " \t\n\v\f\r"


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def checkpoint(df: DataFrame, spread: bool = False) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, lineage cut.

    ``spread`` deals the rows out evenly first and so forgets by which key they lay:
    a later join on that key shuffles both sides, and adaptive execution can split hot keys.

    The folder is ``spark.checkpoint.dir``; only a local session without that setting
    gets one of its own. Spark deletes the files with the data frame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return (df.hint("rebalance") if spread else df).checkpoint()


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each value, null as the empty text, one at a time."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def shared_columns(columns: list[Column], like: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` with ``columns`` appended; what already has such a name in ``df`` gives way."""
    names = set(like.columns)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *columns)
