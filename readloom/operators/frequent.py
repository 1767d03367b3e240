"""The most frequent k-mers without shuffling all of them.

Each task keeps a frequency summary for each sample: exact counts of a batch are added to
at most ``size`` counters, and what is over is taken off again by subtracting the largest count
that has no counter from all (Misra and Gries). A counter is then too low by no more than what was
subtracted, and a k-mer without one stands no oftener than that. Summaries of tasks add
up, their errors too. So per sample the smallest count among the best is known from below; k-mers
that can reach it are candidates, and only these are counted exactly, in a second pass. Where
the error reaches that count, or too many are candidates, nothing is decided and all k-mers
of that sample are counted.

K-mers are whole numbers in base five (A, C, G, T, N). Reads with other letters, and k over 27,
take the full count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "ACGTN"
LONGEST = 27  # 5 ** 27 < 2 ** 63
#: Rows of a summary that are no k-mer: the error of a task, and reads with other letters.
ERROR, OTHER = -1, -2


def summarise(k: int, size: int, chosen: dict[str | None, list[int]] | None = None):
    """From batches (sample, seq) to (sample, kmer, n): a summary, or with ``chosen`` the exact counts of these."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        code = np.full(256, 9, np.int64)
        code[list(b"ACGTN")] = range(5)
        held: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
        errors: dict[str | None, int] = {}
        others: set[str | None] = set()

        def added(name: str | None, kmers: np.ndarray) -> None:
            values, n = np.unique(kmers, return_counts=True)
            if name in held:
                old, m = held[name]
                values, place = np.unique(np.concatenate([old, values]), return_inverse=True)
                n = np.bincount(place, np.concatenate([m, n])).astype(np.int64)
            if chosen is None and len(values) > size:
                most = int(np.partition(n, len(n) - size - 1)[len(n) - size - 1])
                errors[name] = errors.get(name, 0) + most
                values, n = values[n > most], n[n > most] - most
            held[name] = values, n

        for batch in batches:
            if not batch.num_rows:
                continue
            names = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            seqs = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            edges = np.frombuffer(seqs.buffers()[1], np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
            raw = code[np.frombuffer(seqs.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]]
            edges = edges - edges[0]
            sample = names.indices.to_numpy(zero_copy_only=False)
            for i, name in enumerate(x.as_py() for x in names.dictionary):
                own = np.flatnonzero(sample == i)
                many = np.maximum(edges[own + 1] - edges[own] - k + 1, 0)
                at = np.arange(many.sum()) + np.repeat(edges[own] - np.cumsum(many) + many, many)
                kmers, odd = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
                for j in range(k):
                    base = raw[at + j]
                    odd |= base > 4
                    kmers = kmers * 5 + base
                if odd.any():
                    others.add(name)
                    kmers = kmers[~odd]
                if chosen is not None:
                    kmers = kmers[np.isin(kmers, np.array(chosen.get(name, []), np.int64))]
                if len(kmers):
                    added(name, kmers)
        rows = [(name, int(v), int(m)) for name, (values, n) in held.items() for v, m in zip(values, n)]
        if chosen is None:
            rows += [(name, ERROR, e) for name, e in errors.items()] + [(name, OTHER, 1) for name in others]
        if rows:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["sample", "kmer", "n"])

    return count


def kmer_text(kmer: Column, k: int) -> Column:
    """Bases of a k-mer's number in base five."""
    letters = []
    for j in range(k):
        place = F.call_function("div", kmer, F.lit(5 ** (k - 1 - j)).cast("long")) % 5
        letters.append(F.substr(F.lit(LETTERS), (place + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


def all_kmers(reads: DataFrame, k: int) -> DataFrame:
    """(sample, kmer, n) of every k-mer."""
    n = F.length("seq")
    return (
        reads.where(n >= k)
        .select("sample", "seq", F.explode(F.sequence(F.lit(1), n - (k - 1))).alias("_i"))
        .groupBy("sample", F.substr("seq", F.col("_i"), F.lit(k)).alias("kmer"))
        .agg(F.count("*").alias("n"))
    )


def best(kmers: DataFrame, top: int) -> DataFrame:
    """The ``top`` of each sample, equal counts in the order of the k-mers.

    The count that the last of them must have is read off a histogram of counts, so only k-mers at
    or above it are sorted. Where ties leave many, Spark applies ``row_number() <= top`` to
    each map partition before the shuffle; one sample never sends all its k-mers to one task.
    """
    higher = Window.partitionBy("sample").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        kmers.groupBy("sample", "n")
        .agg(F.count("*").alias("_kmers"))
        .withColumn("_ahead", F.coalesce(F.sum("_kmers").over(higher), F.lit(0)))
        .where(F.col("_ahead") < top)
        .groupBy("sample")
        .agg(F.min("n").alias("_needed"))
    )
    needed = F.broadcast(needed.withColumnRenamed("sample", "_of"))  # one row per sample
    frequent = kmers.join(needed, F.col("sample").eqNullSafe(F.col("_of"))).where(F.col("n") >= F.col("_needed"))
    rank = F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("n"), "kmer"))
    return frequent.select("sample", "kmer", "n", rank.alias("rank")).where(F.col("rank") <= top)


def candidates(reads: DataFrame, k: int, top: int, size: int, most: int) -> dict[str | None, list[int] | None]:
    """For each sample the k-mers that may be among the ``top``, at most ``most``; None if that isn't decided."""
    summary = reads.select("sample", "seq").mapInArrow(summarise(k, size), "sample string, kmer long, n long")
    summary = summary.groupBy("sample", "kmer").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("sample")
    rank = F.row_number().over(by.orderBy(F.desc("n")))
    listed = summary.where("kmer >= 0").withColumn("rank", rank).where(F.col("rank") <= most + 1)
    notes = summary.where("kmer < 0").select(F.col("sample").alias("of"), F.col("kmer").alias("note"), F.col("n").alias("size"))
    notes = notes.groupBy("of").agg(
        F.max(F.when(F.col("note") == ERROR, F.col("size"))).alias("error"), F.max(F.col("note") == OTHER).alias("other")
    )
    per = listed.groupBy("sample").agg(
        F.sort_array(F.collect_list(F.struct("n", "kmer")), asc=False).alias("kmers"), F.count(F.lit(1)).alias("count")
    )
    found = {}
    met = per.withColumn("held", F.lit(True)).join(notes.withColumn("noted", F.lit(True)), F.col("sample").eqNullSafe(F.col("of")), "full")
    name = F.when(F.col("held"), F.col("sample")).otherwise(F.col("of"))
    for row in met.withColumn("sample", name).toLocalIterator():
        error, kmers = row["error"] or 0, row["kmers"] or []
        least = kmers[top - 1]["n"] if len(kmers) >= top else 0
        may = [x["kmer"] for x in kmers if x["n"] + error >= least]
        decided = not row["other"] and len(may) <= most and (not error or least > error)
        found[row["sample"]] = may if decided else None
    return found


def frequent_kmers(reads: DataFrame, k: int = 20, top: int = 20, size: int = 4096, most: int = 4096) -> DataFrame:
    """(sample, kmer, n, rank) of the ``top`` k-mers of each sample, counted over all positions."""
    if k > LONGEST:
        return best(all_kmers(reads, k), top)
    found = candidates(reads, k, top, size, most)
    chosen = {name: kmers for name, kmers in found.items() if kmers is not None}
    counted = reads.select("sample", "seq").mapInArrow(summarise(k, size, chosen), "sample string, kmer long, n long")
    counted = counted.groupBy("sample", "kmer").agg(F.sum("n").alias("n"))
    counted = counted.select("sample", kmer_text(F.col("kmer"), k).alias("kmer"), "n")
    open_ = [name for name, kmers in found.items() if kmers is None]
    if open_:
        named = F.col("sample").isin([n for n in open_ if n is not None])
        mine = F.coalesce(named, F.lit(None in open_))
        counted = counted.unionByName(all_kmers(reads.where(mine), k))
    return best(counted, top)
