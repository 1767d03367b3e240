"""Sample manifests and listings (S11-S14, R6). A listing is (sample, path, length)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# File name endings tried for a sample, first choice first.
READ_SUFFIXES = ["_1.fastq", "_1.fastq.gz", ".fastq", ".fastq.gz", ".sra.fastq", ".sra.fastq.gz"]


def resolve_inputs(listing: DataFrame, suffixes: Sequence[str] = READ_SUFFIXES) -> DataFrame:
    """The first existing candidate file of each sample in ``listing``.

    ``listing(sample, path)`` names samples, with a null path where nothing exists.
    A sample without any candidate gets an error text that lists what was tried. The
    choice is a ``min`` over (priority, path), so it is combined before the shuffle.
    """
    name = F.element_at(F.split("path", "/"), -1)
    priority = F.coalesce(
        *[F.when(name == F.concat(F.col("sample"), F.lit(s)), F.lit(i)) for i, s in enumerate(suffixes)]
    )
    choice = F.when(priority.isNotNull(), F.struct(priority.alias("priority"), F.col("path").alias("path")))
    tried = F.concat_ws(", ", *[F.concat(F.col("sample"), F.lit(s)) for s in suffixes])
    return (
        listing.groupBy("sample")
        .agg(F.min(choice).alias("_best"))
        .select(
            "sample",
            F.col("_best.path").alias("path"),
            F.when(F.col("_best").isNull(), F.concat(F.lit("not found: "), tried)).alias("error"),
        )
    )


def pending(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Manifest rows whose sample has no finished, non-empty file."""
    finished = done.where(F.col("length") > 0).select("sample").distinct()
    return manifest.join(finished, "sample", "left_anti")


def too_small(manifest: DataFrame, min_bytes: int = 1_000_000) -> DataFrame:
    """Files strictly smaller than ``min_bytes``."""
    return manifest.where(F.col("length") < min_bytes)


def size_verdicts(manifest: DataFrame, min_bytes: int = 1_000_000) -> DataFrame:
    """S13 per file: whether it is large enough."""
    return manifest.withColumn("passed", F.col("length") >= min_bytes)


def size_gate(manifest: DataFrame, min_bytes: int = 1_000_000) -> DataFrame:
    """S13 as a gate: passes the rows on, and fails the job on a file that is too small."""
    message = F.concat(F.lit("file too small: "), F.col("path"))
    small = F.col("length") < min_bytes
    return manifest.where(F.when(small, F.raise_error(message).cast("boolean")).otherwise(True))


def size_report(manifest: DataFrame) -> DataFrame:
    """Files and bytes per sample, and in total (sample null)."""
    return manifest.rollup("sample").agg(
        F.count("*").alias("n_files"), F.sum(F.col("length").cast("long")).alias("bytes")
    )


def completeness_check(manifest: DataFrame, outputs: DataFrame, stages: Sequence[str]) -> DataFrame:
    """(sample, stage) pairs without a non-empty output."""
    required = manifest.select("sample").distinct().select(
        "sample", F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage")
    )
    present = outputs.where(F.col("length") > 0).select("sample", "stage").distinct()
    return required.join(present, ["sample", "stage"], "left_anti")
