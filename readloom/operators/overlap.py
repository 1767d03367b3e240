"""Reads to genes.

The interval join never meets a raw read. Alignments are first counted per placement
(sample, chrom, pos, cigar, strand), the distinct placements are cut into blocks, and
the exons of a gene are merged into disjoint islands inside position bins. These reduced tables meet in an equi-join on
(chrom, bin) with the overlap test as residual predicate.

Spark picks the join by its own size check: under
``spark.sql.autoBroadcastJoinThreshold`` the islands are broadcast, the partitioning of
the placements survives the join and the aggregate behind it needs no shuffle. Above
it both sides are shuffled on (chrom, bin) and adaptive execution splits large bins.
Of many rows, what is counted or joined per placement is computed at once, in partitions by the
number of rows (:func:`..session.many_partitions`): a task then holds no more of them with more input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cigar import placed_blocks
from ..functions.intervals import bins, with_samples
from ..session import checkpoint, many_partitions, stored
from .align import REVERSE, SECONDARY, SUPPLEMENTARY, UNMAPPED, has_flag, is_mapped

GENOME_BIN = 16_384

ASSIGNED = "Assigned"
AMBIGUOUS = "Unassigned_Ambiguity"
MAPPING_QUALITY = "Unassigned_MappingQuality"
MULTI_MAPPING = "Unassigned_MultiMapping"
NO_FEATURES = "Unassigned_NoFeatures"
IS_UNMAPPED = "Unassigned_Unmapped"
STATUSES = [ASSIGNED, IS_UNMAPPED, MAPPING_QUALITY, MULTI_MAPPING, NO_FEATURES, AMBIGUOUS]

PLACED = ["chrom", "pos", "cigar", "strand"]


def merged_exons(exons: DataFrame, width: int = GENOME_BIN, by: tuple[str, ...] = ("gene_id", "chrom", "strand")) -> DataFrame:
    """Disjoint islands (bin, i_start, i_end) covered by the exons of each gene.

    Exons are clipped to position bins. Per bin and start only the longest piece is
    kept (a plain max, combined on the map side), which leaves at most ``width`` rows
    for the merging window, however many exons a gene has.
    """
    clipped = exons.select(*by, "start_pos", "end_pos", F.explode(bins("start_pos", "end_pos", width)).alias("bin"))
    low = F.col("bin") * width
    pieces = (
        clipped.select(
            *by,
            "bin",
            F.greatest(F.col("start_pos"), low).alias("_s"),
            F.least(F.col("end_pos"), low + (width - 1)).alias("_e"),
        )
        .groupBy(*by, "bin", "_s")
        .agg(F.max("_e").alias("_e"))
    )
    in_bin = Window.partitionBy(*by, "bin").orderBy("_s")
    before = F.max("_e").over(in_bin.rowsBetween(Window.unboundedPreceding, -1))
    starts = pieces.withColumn("_new", F.when(F.col("_s") <= before + 1, 0).otherwise(1))
    numbered = starts.withColumn("_island", F.sum("_new").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy(*by, "bin", "_island")
        .agg(F.min("_s").alias("i_start"), F.max("_e").alias("i_end"))
        .drop("_island")
    )


def gene_length(exons: DataFrame, width: int = GENOME_BIN) -> DataFrame:
    """Bases in the union of a gene's exons (per contig, then summed)."""
    return (
        merged_exons(exons, width, ("gene_id", "chrom"))
        .groupBy("gene_id")
        .agg(F.sum(F.col("i_end") - F.col("i_start") + 1).cast("int").alias("length"))
    )


def placements(alignments: DataFrame, *extra: str) -> DataFrame:
    """Mapped rows counted per placement (and per ``extra`` column); many rows at once and stored."""
    strand = F.when(has_flag(REVERSE), "-").otherwise("+")
    mapped = alignments.where(is_mapped()).withColumn("strand", strand)
    counted = mapped.groupBy(*extra, *PLACED).agg(F.count("*").alias("n"))
    with many_partitions(alignments) as many:
        return stored(counted, "placements") if many else counted


def strand_match(rule: int, read: str = "strand", gene: str = "gene_strand") -> Column:
    """0 ignores strands, 1 wants the same strand, 2 the opposite one."""
    if rule == 0:
        return F.lit(True)
    same = F.col(read) == F.col(gene)
    return same if rule == 1 else ~same


def _hits(placed: DataFrame, exons: DataFrame, width: int, how: str) -> DataFrame:
    """Rows of ``placed`` with each (gene_id, gene_strand) island a block touches.

    A gene comes out once per block and island. With ``how="left"`` rows without a hit
    stay, with nulls.
    """
    cut = placed_blocks(placed, outer=how == "left")
    left = cut.withColumn("bin", F.explode_outer(bins("b_start", "b_end", width)))
    right = merged_exons(exons, width).withColumnsRenamed({"strand": "gene_strand", "chrom": "_c", "bin": "_b"})
    touch = (F.col("b_start") <= F.col("i_end")) & (F.col("b_end") >= F.col("i_start"))
    same_bin = (F.col("chrom") == F.col("_c")) & (F.col("bin") == F.col("_b"))
    return left.join(right, same_bin & touch, how).select(*placed.columns, "gene_id", "gene_strand")


def overlap_join(placed: DataFrame, exons: DataFrame, width: int = GENOME_BIN) -> DataFrame:
    """(placement, gene_id, gene_strand) where a block and an exon share a base.

    ``placed`` holds distinct placements. Each pair comes out once. With many placements the table is
    computed at once and stored, in as many partitions as they need.
    """
    pairs = _pairs(placed, exons, width)
    with many_partitions(placed) as many:
        return stored(pairs, "overlaps") if many else pairs


def _pairs(placed: DataFrame, exons: DataFrame, width: int) -> DataFrame:
    return _hits(placed.select(*PLACED), exons, width, "inner").distinct()


def placement_genes(placed: DataFrame, exons: DataFrame, strand: int = 0, width: int = GENOME_BIN) -> DataFrame:
    """Genes hit per placement: ``n_genes`` and, where it is one, ``gene_id``.

    Placements without a gene are not listed.
    """
    hits = _pairs(placed, exons, width).where(strand_match(strand))
    per = hits.groupBy(*PLACED).agg(F.count("*").alias("n_genes"), F.min("gene_id").alias("_gene"))
    return per.select(*PLACED, "n_genes", F.when(F.col("n_genes") == 1, F.col("_gene")).alias("gene_id"))


def assign_reads(alignments: DataFrame, exons: DataFrame, strand: int = 0, width: int = GENOME_BIN) -> DataFrame:
    """Every mapped row with its number of genes, and the gene if there is one.

    The join back to the rows is on the placement, whose side here is unique and dealt out
    anew before the join, so that both sides are shuffled for it: a placement shared by
    many reads makes a large left partition, which adaptive execution then splits. With many
    rows the table is computed at once and stored, in as many partitions as they need.
    """
    mapped = alignments.where(is_mapped()).withColumn("strand", F.when(has_flag(REVERSE), "-").otherwise("+"))
    genes = placement_genes(mapped.select(*PLACED).distinct(), exons, strand, width)
    n = F.coalesce("n_genes", F.lit(0).cast("long"))
    status = F.when(n == 1, ASSIGNED).when(n > 1, AMBIGUOUS).otherwise(NO_FEATURES)
    assigned = mapped.join(genes.hint("rebalance"), PLACED, "left").withColumn("n_genes", n).withColumn("status", status)
    with many_partitions(alignments) as many:
        return stored(assigned, "assigned") if many else assigned


def _counted_outcomes(
    alignments: DataFrame, early: Column, exons: DataFrame, rules: dict[str, int], none: str, many: str, width: int
) -> DataFrame:
    """(sample, n, one column per rule): the gene, or the reason why there is none.

    ``early`` names the outcome of rows that never reach the overlap. They share the
    first aggregate with the placements, so the alignments are read once. A placement
    hits one gene if the smallest and the largest gene id it meets are the same.
    """
    strand = F.when(has_flag(REVERSE), "-").otherwise("+")
    marked = alignments.select("sample", early.alias("_early"), "chrom", "pos", "cigar", strand.alias("strand"))
    open_rows = F.col("_early").isNull()
    keys = ["sample", "_early", *PLACED]
    placed = (
        marked.withColumns({c: F.when(open_rows, F.col(c)) for c in PLACED}).groupBy(*keys).agg(F.count("*").alias("n"))
    )
    hits = _hits(placed, exons, width, "left")
    ends = []
    for name, rule in rules.items():
        gene = F.when(strand_match(rule), F.col("gene_id"))
        ends += [F.min(gene).alias(f"_low_{name}"), F.max(gene).alias(f"_high_{name}")]
    genes = hits.groupBy(*keys).agg(F.max("n").alias("n"), *ends)

    def outcome(name: str) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        late = F.when(low.isNull(), none).when(low == high, low).otherwise(many)
        return F.coalesce("_early", late).alias(name)

    return genes.select("sample", "n", *[outcome(name) for name in rules])


def assigned_counts(
    alignments: DataFrame, exons: DataFrame, min_mapq: int = 10, strand: int = 0, width: int = GENOME_BIN
) -> DataFrame:
    """(sample, status, gene_id, n): rows per outcome, gene named where assigned.

    Precedence: unmapped, low mapping quality, multi-mapping, then the overlap. The table, a row for
    each sample and gene, is counted at once and checkpointed: grids, matrices and rates
    that start from it need not count again.
    """
    early = (
        F.when(has_flag(UNMAPPED), IS_UNMAPPED)
        .when(F.col("mapq") < min_mapq, MAPPING_QUALITY)
        .when(F.col("nh") > 1, MULTI_MAPPING)
    )
    outcomes = _counted_outcomes(alignments, early, exons, {"_to": strand}, NO_FEATURES, AMBIGUOUS, width)
    failed = F.col("_to").isin(*[s for s in STATUSES if s != ASSIGNED])
    counts = outcomes.groupBy(
        "sample",
        F.when(failed, F.col("_to")).otherwise(ASSIGNED).alias("status"),
        F.when(~failed, F.col("_to")).alias("gene_id"),
    ).agg(F.sum("n").alias("n"))
    with many_partitions(alignments):
        return checkpoint(counts)


def assignment_summary(counts: DataFrame) -> DataFrame:
    """Alignment rows per sample and status; statuses without rows stay with 0.

    ``counts`` comes from :func:`assigned_counts`, where each sample with a row is.
    """
    zero = F.lit(0).cast("long")
    per = counts.groupBy("sample").agg(
        *[F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), zero).alias(s) for s in STATUSES]
    )
    pairs = [F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES]
    return per.select("sample", F.inline(F.array(*pairs)))


def gene_counts(counts: DataFrame) -> DataFrame:
    """(gene_id, sample, count) of the assigned rows."""
    return (
        counts.where(F.col("status") == ASSIGNED)
        .groupBy("gene_id", "sample")
        .agg(F.sum("n").alias("count"))
    )


def gene_counts_by_strand(
    reads: DataFrame, alignments: DataFrame, exons: DataFrame, width: int = GENOME_BIN
) -> DataFrame:
    """Gene x {unstranded, forward, reverse} counts of uniquely mapped reads.

    Followed by the rows N_unmapped, N_multimapping, N_noFeature and N_ambiguous. Each
    read counts at its primary row. ``reads(sample, ...)`` are those given to the aligner;
    the ones without a mapped primary row are N_unmapped, whether they have a row or not. The
    overlap join runs once; the three strand rules are three conditional aggregates over
    its result. Samples are those of ``reads``.
    """
    primary = alignments.where(~has_flag(SECONDARY) & ~has_flag(SUPPLEMENTARY))
    early = F.when(has_flag(UNMAPPED), "N_unmapped").when(F.col("nh") > 1, "N_multimapping")
    rules = {"unstranded": 0, "forward": 1, "reverse": 2}
    outcomes = _counted_outcomes(primary, early, exons, rules, "N_noFeature", "N_ambiguous", width)
    with many_partitions(alignments):
        outcomes = checkpoint(outcomes.groupBy("sample", *rules).agg(F.sum("n").alias("n")))
        totals = checkpoint(reads.groupBy("sample").agg(F.count("*").alias("_reads")))
    # One row per rule, added up per target in a single aggregate.
    entries = [F.struct(F.lit(r).alias("rule"), F.col(r).alias("gene_id")) for r in rules]
    counted = (
        outcomes.select("sample", "n", F.inline(F.array(*entries)))
        .groupBy("gene_id", "sample")
        .agg(*[F.sum(F.when(F.col("rule") == r, F.col("n"))).alias(r) for r in rules])
    )
    extra = exons.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(x) for x in ("N_unmapped", "N_multimapping", "N_noFeature", "N_ambiguous")])).alias("gene_id")
    )
    placed = outcomes.where(F.col("unstranded") != "N_unmapped").groupBy("sample").agg(F.sum("n").alias("_placed"))
    zero = F.lit(0).cast("long")
    missing = totals.join(placed, "sample", "left").select(
        F.lit("N_unmapped").alias("gene_id"),
        "sample",
        *[(F.col("_reads") - F.coalesce("_placed", zero)).alias(r) for r in rules],
    )
    cells = counted.where(F.col("gene_id") != "N_unmapped").unionByName(missing)
    grid = with_samples(exons.select("gene_id").distinct().unionByName(extra), totals)
    return grid.join(cells, ["gene_id", "sample"], "left").select(
        "gene_id", "sample", *[F.coalesce(r, zero).alias(r) for r in rules]
    )
