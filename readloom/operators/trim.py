"""Read trimming and filtering.

One narrow chain over ``reads(read_id, sample, seq, qual)``: cut by window quality,
drop a poly-G tail, cut the adapter, then give the first filter that fails. No step
shuffles; only the per-sample counts do.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.adapters import before_adapter_or_part
from ..functions.bases import bases_at_least, bases_below, bind, col, gc_count, n_count
from .frequent import frequent_kmers

UNIVERSAL_ADAPTER = "AGATCGGAAGAG"
PASSED, TOO_MANY_N, LOW_QUALITY, TOO_SHORT = "passed", "too_many_N", "low_quality", "too_short"
REASONS = [PASSED, TOO_MANY_N, LOW_QUALITY, TOO_SHORT]


def _cut_to(reads: DataFrame, keep: Column) -> DataFrame:
    """Shorten bases and qualities to the first ``keep`` characters."""
    cut = bind(reads, "_keep", keep)
    return cut.withColumns({c: F.substr(c, F.lit(1), F.col("_keep")) for c in ("seq", "qual")}).drop("_keep")


def window_cut(window: int = 4, mean: int = 20):
    """Arrow function: quality strings -> bases before the first window whose mean score
    is below ``mean``; the whole length if there is none or the read is shorter.

    Running sums over array elements need lambda functions, which Spark interprets one
    element at a time; on whole Arrow columns the same scan is ten times faster. The
    inner function carries no reference to this package, so workers need not have it.
    """

    def first_bad_window(quals: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        filled = pc.fill_null(quals, "").cast(pa.large_binary())
        ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        raw = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        sums = np.concatenate(([0], np.cumsum(raw.astype(np.int64) - 33)))
        starts, lengths = ends[:-1], np.diff(ends)
        bad = np.flatnonzero(sums[window:] - sums[:-window] < mean * window)
        # First bad window at or after each read's start; it counts if it ends inside.
        first = np.append(bad, np.iinfo(np.int64).max)[np.searchsorted(bad, starts)]
        keep = np.where(first <= ends[1:] - window, first - starts, lengths)
        return pa.array(keep.astype(np.int32), mask=quals.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(first_bad_window, "int")


def _bind_window_cut(reads: DataFrame, name: str, window: int, mean: int) -> DataFrame:
    found = reads.withColumn("_found", window_cut(window, mean)("qual"))
    return bind(found, name, F.col("_found")).drop("_found")


def cut_right(reads: DataFrame, window: int = 4, mean: int = 20) -> DataFrame:
    """Slide a window from the 5' end; cut from the first bad one to the end."""
    cut = _bind_window_cut(reads, "_window", window, mean)
    return _cut_to(cut, F.col("_window")).drop("_window")


def before_poly_g(seq: Column, min_len: int = 10) -> Column:
    """Length of ``seq`` without a trailing run of at least ``min_len`` G."""
    body, n = F.length(F.rtrim(seq, F.lit("G"))), F.length(seq)
    return F.when(n - body >= min_len, body).otherwise(n)


def before_adapter(seq: Column, length: Column, probe: Column) -> Column:
    """Length of the first ``length`` bases of ``seq`` up to the first whole ``probe``.

    The first hit in the whole read decides: if it does not end within ``length``, no
    later one does. A null probe cuts nothing.
    """
    at = F.coalesce(F.position(probe, seq), F.lit(0))
    inside = (at > 0) & (at - 1 + F.length(probe) <= length)
    return F.when(inside, at - 1).otherwise(length)


def trim_poly_g(reads: DataFrame, min_len: int = 10) -> DataFrame:
    """Drop a trailing run of at least ``min_len`` G."""
    return _cut_to(reads, before_poly_g(F.col("seq"), min_len))


def trim_adapter(reads: DataFrame, adapter: str | Column = UNIVERSAL_ADAPTER) -> DataFrame:
    """T4: cut at the first occurrence of the adapter (a string or a column)."""
    probe = F.lit(adapter) if isinstance(adapter, str) else adapter
    return _cut_to(reads, before_adapter(F.col("seq"), F.length("seq"), probe))


def trim_adapter_or_part(
    reads: DataFrame, adapter: str = UNIVERSAL_ADAPTER, min_overlap: int = 6, bases_for_one: int = 8
) -> DataFrame:
    """T4 with mismatches: cut where the adapter begins, or as much of it as the read has left.

    At least ``min_overlap`` bases are compared, with one mismatch for each ``bases_for_one`` of them.
    """
    found = reads.withColumn("_found", before_adapter_or_part("seq", adapter, min_overlap, bases_for_one))
    return _cut_to(found, F.col("_found")).drop("_found")


def trim_detected_adapter(reads: DataFrame, detected: DataFrame) -> DataFrame:
    """T4 with the adapter found per sample by T11; samples without one stay uncut.

    ``detected`` has at most one row per sample.
    """
    joined = reads.join(F.broadcast(detected.select("sample", "adapter")), "sample", "left")
    return trim_adapter(joined, F.col("adapter")).drop("adapter")


def fails_quality(qual: str | Column = "qual", q: int = 20, pct: int = 30) -> Column:
    """T5: more than ``pct`` percent of the bases are below ``q`` (integer test)."""
    return bases_below(qual, q) * 100 > F.length(col(qual)) * pct


def fails_n(seq: str | Column = "seq", limit: int = 5) -> Column:
    """More than ``limit`` N."""
    return n_count(seq) > limit


def fails_length(seq: str | Column = "seq", minimum: int = 36) -> Column:
    """Shorter than ``minimum``."""
    return F.length(col(seq)) < minimum


def low_quality_filter(reads: DataFrame, q: int = 20, pct: int = 30) -> DataFrame:
    return reads.where(~fails_quality("qual", q, pct))


def n_filter(reads: DataFrame, limit: int = 5) -> DataFrame:
    return reads.where(~fails_n("seq", limit))


def length_filter(reads: DataFrame, minimum: int = 36) -> DataFrame:
    return reads.where(~fails_length("seq", minimum))


def trim_chain(
    reads: DataFrame,
    adapter: str | None = UNIVERSAL_ADAPTER,
    detected: DataFrame | None = None,
    min_overlap: int | None = None,
    window: int = 4,
    mean: int = 20,
    poly_g: int = 10,
    n_limit: int = 5,
    low_quality: int = 20,
    low_quality_pct: int = 30,
    min_length: int = 36,
) -> DataFrame:
    """All trimming steps, then ``reason``: 'passed' or the first filter that failed.

    Keeps the untrimmed strings as ``raw_seq`` and ``raw_qual`` so that one pass over
    the reads can report both stages. With ``min_overlap`` the adapter (not a detected one) is
    found with mismatches and in part, see :func:`trim_adapter_or_part`.
    """
    seq = F.col("seq")
    out = _bind_window_cut(reads, "_window", window, mean)
    out = bind(out, "_body", before_poly_g(F.substr(seq, F.lit(1), F.col("_window")), poly_g))
    probe = F.lit(adapter).cast("string")
    if detected is not None:
        out = out.join(F.broadcast(detected.select("sample", "adapter")), "sample", "left")
        probe = F.col("adapter")
    if min_overlap is not None and adapter and detected is None:
        out = out.withColumn("_found", before_adapter_or_part(F.substr(seq, F.lit(1), F.col("_body")), adapter, min_overlap))
        keep = F.col("_found")
    else:
        keep = before_adapter(seq, F.col("_body"), probe)
    out = bind(out, "_keep", keep)
    out = out.select(
        *reads.columns,
        F.col("seq").alias("raw_seq"),
        F.col("qual").alias("raw_qual"),
        "_keep",
    ).withColumns({c: F.substr(c, F.lit(1), F.col("_keep")) for c in ("seq", "qual")})
    reason = (
        F.when(fails_n("seq", n_limit), TOO_MANY_N)
        .when(fails_quality("qual", low_quality, low_quality_pct), LOW_QUALITY)
        .when(fails_length("seq", min_length), TOO_SHORT)
        .otherwise(PASSED)
    )
    return bind(out, "reason", reason).drop("_keep")


def trimmed_reads(chain: DataFrame) -> DataFrame:
    """The reads that passed, with the columns of ``reads``."""
    return chain.where(F.col("reason") == PASSED).drop("raw_seq", "raw_qual", "reason")


def filter_reasons(chain: DataFrame) -> DataFrame:
    """Reads per sample and outcome; outcomes that never occur stay with 0."""
    counts = chain.groupBy("sample").agg(
        *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS]
    )
    pairs = [F.struct(F.lit(r).alias("reason"), F.col(r).alias("n_reads")) for r in REASONS]
    return counts.select("sample", F.inline(F.array(*pairs)))


def both_stages(chain: DataFrame, before: str = "raw", after: str = "trimmed") -> DataFrame:
    """(sample, stage, seq, qual) for the raw reads and the reads that passed.

    Both stages come out of one pass over the input.
    """

    def stage(name: str, seq: str, qual: str) -> Column:
        return F.struct(F.lit(name).alias("stage"), F.col(seq).alias("seq"), F.col(qual).alias("qual"))

    raw, kept = stage(before, "raw_seq", "raw_qual"), stage(after, "seq", "qual")
    rows = F.when(F.col("reason") == PASSED, F.array(raw, kept)).otherwise(F.array(raw))
    return chain.select("sample", F.inline(rows))


def read_totals(reads: DataFrame, by: tuple[str, ...] = ("sample", "stage")) -> DataFrame:
    """Reads, bases, Q20 and Q30 bases, GC bases and mean length."""

    def total(c: Column) -> Column:
        return F.sum(c.cast("long"))

    return (
        reads.groupBy(*by)
        .agg(
            F.count("*").alias("n_reads"),
            total(F.length("seq")).alias("bases"),
            total(bases_at_least("qual", 20)).alias("q20_bases"),
            total(bases_at_least("qual", 30)).alias("q30_bases"),
            total(gc_count("seq")).alias("gc_bases"),
        )
        .withColumn("mean_length", F.col("bases").cast("double") / F.col("n_reads"))
    )


def before_after(chain: DataFrame) -> DataFrame:
    """T9 for both stages of a trimming run."""
    return read_totals(both_stages(chain))


def overrepresented_kmers(reads: DataFrame, k: int = 20, top: int = 20) -> DataFrame:
    """The most frequent k-mers of each sample, counted over all positions.

    Equal counts are ordered by k-mer. See :mod:`.frequent`: a summary names the candidates, and
    only these are counted and shuffled.
    """
    return frequent_kmers(reads, k, top)


def detect_adapter(reads: DataFrame, candidates: dict[str, str]) -> DataFrame:
    """The candidate contained in most reads of a sample, if any is.

    All candidates are counted side by side in one aggregate; equal counts go to the
    candidate listed first.
    """
    names = list(candidates)
    counts = reads.groupBy("sample").agg(
        *[F.count(F.when(F.contains("seq", F.lit(candidates[a])), 1)).alias(f"_{i}") for i, a in enumerate(names)]
    )
    entries = [
        F.struct(
            F.col(f"_{i}").alias("n_reads"),
            F.lit(-i).alias("_first"),
            F.lit(a).alias("name"),
            F.lit(candidates[a]).alias("adapter"),
        )
        for i, a in enumerate(names)
    ]
    best = F.array_max(F.array(*entries))
    return (
        counts.select("sample", best.alias("_best"))
        .where(F.col("_best.n_reads") > 0)
        .select("sample", "_best.name", "_best.adapter", "_best.n_reads")
    )
