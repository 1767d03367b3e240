"""Cross-step reports (R1-R4). Every input here already has one row per sample, or per
sample and metric; nothing touches reads or alignments again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def general_stats(*tables: DataFrame) -> DataFrame:
    """One row per sample, all columns of all tables (full outer joins)."""
    return reduce(lambda left, right: left.join(right, "sample", "full_outer"), tables)


def status_matrix(qc_status: DataFrame, samples: Sequence[str] | None = None) -> DataFrame:
    """R2: module x sample grid of verdicts.

    Without ``samples`` Spark looks the names up first, which costs a small job.
    """
    grouped = qc_status.groupBy("module")
    pivoted = grouped.pivot("sample", list(samples)) if samples is not None else grouped.pivot("sample")
    return pivoted.agg(F.first("status"))


def stage_union(stages: dict[str | None, DataFrame]) -> DataFrame:
    """The same table from several stages, with the stage as a column.

    A table under the name None has its stages in it already, from one pass over them all.
    """
    tagged = [df if name is None else df.withColumn("stage", F.lit(name)) for name, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
