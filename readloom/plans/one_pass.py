"""Writing and reporting in one pass: the report comes from an observation of the job that writes.

An observation has no groups, so every sample has sums of its own, 12 for each. That is meant for the
samples of a run, a few dozen at most; a run of many is written in groups of samples.
A read of a sample that isn't named is an error, after the job and before any file has its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.bases import bases_at_least, bind, gc_count
from ..operators import trim
from ..sources import fastq, text_tables

MEASURES = ("bases", "q20_bases", "q30_bases", "gc_bases")
REPORT = ", ".join(
    [
        "sample string",
        *[f"{r} long" for r in trim.REASONS],
        *[f"{when}_{m} long" for when in ("before", "after") for m in ("reads", *MEASURES)],
    ]
)


def _measures(seq: str, qual: str) -> Column:
    values = (F.length(seq), bases_at_least(qual, 20), bases_at_least(qual, 30), gc_count(seq))
    return F.struct(*[v.cast("long").alias(n) for n, v in zip(MEASURES, values)])


def observed(chain: DataFrame, samples: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``chain`` with an observation of outcomes and totals of each sample."""
    watched = bind(chain, "_before", _measures("raw_seq", "raw_qual"))
    watched = bind(watched, "_after", _measures("seq", "qual"))
    number = F.lit(None).cast("int")
    for i, name in enumerate(samples):
        number = F.when(F.col("sample") == name, i).otherwise(number)
    watched = bind(watched, "_no", F.coalesce(number, F.lit(-1)))
    # One number for each outcome, so that a sum has two whole numbers to compare.
    outcome = F.coalesce(F.array_position(F.array(*map(F.lit, trim.REASONS)), F.col("reason")), F.lit(0))
    watched = bind(watched, "_outcome", outcome.cast("int"))

    def total(hit: Column, value: Column) -> Column:
        return F.sum(F.when(hit, value).otherwise(F.lit(0).cast("long")))

    sums = [F.count(F.when(F.col("_no") < 0, 1)).alias("unnamed")]
    for i in range(len(samples)):
        own = F.col("_no") == i
        kept = own & (F.col("_outcome") == 1 + trim.REASONS.index(trim.PASSED))
        sums += [F.count(F.when(own & (F.col("_outcome") == k + 1), 1)).alias(f"{i}_{r}") for k, r in enumerate(trim.REASONS)]
        sums += [total(own, F.col("_before")[m]).alias(f"{i}_before_{m}") for m in MEASURES]
        sums += [total(kept, F.col("_after")[m]).alias(f"{i}_after_{m}") for m in MEASURES]
    seen = Observation()
    return watched.observe(seen, *sums).select(*chain.columns), seen


def write_trimmed(chain: DataFrame, path: str, samples: Sequence[str], ending: str = ".trimmed.fastq.gz") -> DataFrame:
    """Write the reads that passed, one file for each sample, and return the report (``REPORT``) of the same pass.

    Samples of which no read passed get an empty file.
    """
    samples = list(dict.fromkeys(samples))
    watched, seen = observed(chain, samples)

    def check() -> None:
        if unnamed := seen.get["unnamed"]:
            raise ValueError(f"{unnamed} reads are of none of the samples {samples}")

    fastq.write_sample_files(trim.trimmed_reads(watched), path, ending, samples, before_publishing=check)
    got = {k: v or 0 for k, v in seen.get.items()}
    rows = []
    for i, name in enumerate(samples):
        outcomes = [got[f"{i}_{r}"] for r in trim.REASONS]
        reads = {"before": sum(outcomes), "after": got[f"{i}_{trim.PASSED}"]}
        totals = [x for when in ("before", "after") for x in (reads[when], *(got[f"{i}_{when}_{m}"] for m in MEASURES))]
        rows.append((name, *outcomes, *totals))
    return chain.sparkSession.createDataFrame(rows, REPORT)


def write_matrix(matrix: DataFrame, path: str, name: str, keys: Sequence[str] = ("Geneid", "Length")) -> DataFrame:
    """``matrix`` as one tab-separated file, and its shape as counted by the job that wrote it."""
    seen = Observation()
    text_tables.write_matrix_file(matrix.observe(seen, F.count(F.lit(1)).alias("n_genes")), path, name)
    samples = [c for c in matrix.columns if c not in keys]
    row = (seen.get["n_genes"], len(samples), ",".join(samples))
    return matrix.sparkSession.createDataFrame([row], "n_genes long, n_samples long, sample_columns string")
