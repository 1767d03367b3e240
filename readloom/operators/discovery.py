"""Adapters of samples without a list to choose from.

An adapter follows inserts: what follows its first bases is nearly always the same, what
stands before them is not. So of the most frequent k-mers of a sample the seed is the one
that stands most often besides its commonest neighbours before it; in a read that is copied, or
inside an adapter, a k-mer has one neighbour only. The texts after and before the seed in all
reads that hold it are grown as prefix trees, base by base, while one branch holds nearly
all reads that go on. Where none does, the adapter begins or ends. A sample whose seed
is rare, or grows to less than ``min_length``, has no adapter.

Counts cover all reads. K-mers are counted in Arrow batches and combined before the shuffle, at most
``4 ** k`` for a sample; neighbours only of ``candidates`` k-mers a sample, whose list goes to the
tasks; trees come from the distinct texts, and only branches that matter reach one row for a sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

NEIGHBOURS = 3  # bases before a seed


def count_kmers(k: int, chosen: dict[str | None, list[int]] | None = None):
    """From batches (sample, seq) to (sample, kmer, before, n).

    All k-mers with ``before`` -1, or the ``chosen`` ones by the bases before them. K-mers with
    other letters than A, C, G and T, with fewer than four different pairs of neighbours, or with
    one base in more than six tenths of their places are left out.
    """
    width = NEIGHBOURS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        code = np.full(256, 4, np.int64)
        code[list(b"ACGT")] = range(4)
        for batch in batches:
            if not batch.num_rows:
                continue
            names = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            seqs = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            edges = np.frombuffer(seqs.buffers()[1], np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
            raw = code[np.frombuffer(seqs.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]]
            edges = edges - edges[0]
            first = edges[:-1] + (width if chosen is not None else 0)
            many = np.maximum(edges[1:] - k + 1 - first, 0)
            at = np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)
            of = np.repeat(np.arange(len(many)), many)
            sample = names.indices.to_numpy(zero_copy_only=False)[of].astype(np.int64)
            kmer, whole = np.zeros(len(at), np.int64), np.ones(len(at), bool)
            for j in range(k):
                base = raw[at + j]
                whole &= base < 4
                kmer = kmer * 4 + (base & 3)
            before = np.full(len(at), -1, np.int64)
            if chosen is not None:
                listed = [np.array(chosen.get(n.as_py(), []), np.int64) for n in names.dictionary]
                for i, own in enumerate(listed):
                    whole &= (sample != i) | np.isin(kmer, own)
                before[:] = 0
                for j in range(width):
                    base = raw[at - width + j]
                    whole &= base < 4
                    before = before * 4 + (base & 3)
            cells = (sample * 4**k + kmer) * (4**width + 1) + before + 1
            cells, n = np.unique(cells[whole], return_counts=True)
            before, cells = cells % (4**width + 1) - 1, cells // (4**width + 1)
            sample, kmer = cells // 4**k, cells % 4**k
            bases = [(kmer >> 2 * j) & 3 for j in range(k)]
            pairs = np.zeros(len(kmer), np.int64)
            for a, b in zip(bases[1:], bases):
                pairs |= np.left_shift(1, a * 4 + b)
            most = np.max([sum(x == c for x in bases) for c in range(4)], axis=0)
            use = (np.bitwise_count(pairs) >= 4) & (most * 10 <= k * 6)
            if use.any():
                columns = [names.dictionary.take(pa.array(sample[use])), *(pa.array(c[use]) for c in (kmer, before, n))]
                yield pa.RecordBatch.from_arrays(columns, ["sample", "kmer", "before", "n"])

    return count


def kmer_text(kmer: Column, k: int) -> Column:
    """Bases of a k-mer's number."""
    letters = [F.substr(F.lit("ACGT"), F.shiftright(kmer, 2 * (k - 1 - j)).bitwiseAND(F.lit(3)).cast("int") + 1, F.lit(1)) for j in range(k)]
    return F.concat(*letters)


def seeds(reads: DataFrame, k: int = 10, candidates: int = 256) -> DataFrame:
    """(sample, seed, n): of a sample's most frequent k-mers that with the most hits besides its commonest neighbours."""
    kinds = "sample string, kmer long, before long, n long"
    slim = reads.select("sample", "seq")
    kmers = slim.mapInArrow(count_kmers(k), kinds).groupBy("sample", "kmer").agg(F.sum("n").alias("n"))
    # Spark cuts each partition to the best ranks before the shuffle.
    rank = F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("n"), "kmer"))
    frequent = kmers.withColumn("rank", rank).where(F.col("rank") <= candidates).groupBy("sample")
    chosen = {r["sample"]: r["kmers"] for r in frequent.agg(F.collect_list("kmer").alias("kmers")).collect()}
    cells = slim.mapInArrow(count_kmers(k, chosen), kinds).groupBy("sample", "kmer", "before").agg(F.sum("n").alias("n"))
    several = cells.groupBy("sample", "kmer").agg((F.sum("n") - F.max("n")).alias("n")).where("n > 0")
    best = several.groupBy("sample").agg(F.max(F.struct("n", -F.col("kmer"))).alias("best"))
    return best.select("sample", kmer_text(-F.col("best.col2"), k).alias("seed"), F.col("best.n").alias("n"))


def branches(texts: DataFrame, by: list[str], share: float, support: Column) -> DataFrame:
    """``by`` and ``path``: the bases that a prefix tree grows while one branch dominates.

    ``texts`` has ``by``, text and n. A branch must hold ``share`` of what goes on from its
    parent, and that must be ``support`` at least.
    """
    depth = F.explode(F.sequence(F.lit(1), F.length("text"))).alias("depth")
    edges = texts.where("text <> ''").select(*by, "text", "n", "least", depth)
    edges = edges.groupBy(*by, F.substr("text", F.lit(1), F.col("depth")).alias("path")).agg(
        F.sum("n").alias("n"), F.max("least").alias("least")
    )
    parent = F.substr("path", F.lit(1), F.length("path") - 1)
    total = F.sum("n").over(Window.partitionBy(*by, parent))
    kept = edges.withColumn("total", total).where((F.col("total") >= support) & (F.col("n") >= F.col("total") * share))
    steps = F.sort_array(F.collect_list(F.struct(F.length("path").alias("depth"), "path")))
    grown = F.aggregate(
        steps, F.lit(""), lambda all_, x: F.when((x["depth"] == F.length(all_) + 1) & x["path"].startswith(all_), x["path"]).otherwise(all_)
    )
    return kept.groupBy(*by).agg(grown.alias("path"))


def found_adapters(
    reads: DataFrame,
    k: int = 10,
    candidates: int = 256,
    reach: int = 40,
    share: float = 0.8,
    support_pct: int = 5,
    min_length: int = 16,
    min_reads: int = 20,
    min_pct: int = 1,
) -> DataFrame:
    """T11 without a list: (sample, adapter, n_reads), one row for each sample that has an adapter.

    ``n_reads`` are the reads with the seed, ``min_reads`` and ``min_pct`` percent of all at least. The
    adapter grows up to ``reach`` bases either way; a step needs ``support_pct`` percent of ``n_reads``.
    """
    chosen = F.broadcast(seeds(reads, k, candidates).select("sample", "seed"))  # one row for each sample
    hits = reads.select("sample", "seq").join(chosen, "sample").where(F.contains("seq", F.col("seed")))
    at = F.instr("seq", F.col("seed"))
    after = F.substr("seq", at + k, F.lit(reach))
    before = F.reverse(F.substr("seq", F.greatest(at - reach, F.lit(1)), F.least(at - 1, F.lit(reach))))
    sides = F.array(F.struct(F.lit("after").alias("side"), after.alias("text")), F.struct(F.lit("before").alias("side"), before.alias("text")))
    texts = hits.select("sample", "seed", F.inline(sides)).groupBy("sample", "seed", "side", "text").agg(F.count(F.lit(1)).alias("n"))
    texts = stored(texts, "adapter-texts")  # used twice: all reads are behind it
    # Every read has a row on either side, so the sum over one side counts the reads.
    counts = texts.where("side = 'after'").groupBy("sample", "seed").agg(F.sum("n").alias("n_reads"))
    totals = F.broadcast(reads.groupBy("sample").agg(F.count(F.lit(1)).alias("total")))
    enough = (F.col("n_reads") >= min_reads) & (F.col("n_reads") * 100 >= F.col("total") * min_pct)
    counts = counts.join(totals, "sample").where(enough).drop("total")
    support = F.col("least")
    few = counts.select("sample", (F.col("n_reads") * support_pct / 100).alias("least"))
    paths = branches(texts.join(F.broadcast(few), "sample"), ["sample", "side"], share, support)

    def path(side: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col("path"))), F.lit("")).alias(side)

    grown = counts.join(paths, "sample", "left").groupBy("sample", "seed", "n_reads").agg(path("before"), path("after"))
    adapter = F.concat(F.reverse("before"), "seed", "after")
    return grown.select("sample", adapter.alias("adapter"), "n_reads").where(F.length("adapter") >= min_length)
