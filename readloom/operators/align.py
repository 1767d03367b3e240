"""Operators over the alignment table.

``alignments(sample, read_id, flag, chrom, pos, cigar, mapq, nh, nm)``; whether a row
is mapped is decided by its flag, never by a null position. Where a question depends
only on how a read is placed (chrom, pos, cigar), it is answered once per distinct
placement: copies of the same placement collapse before anything is joined, so a
third of all reads on one spot is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bases import int_div, percent
from ..functions.cigar import blocks, cigar_ops, placed_introns, query_length, ref_end
from ..functions.intervals import with_samples
from ..functions.md import counted_sites, located, mismatches
from ..session import partitions_for

# Bits of the alignment flag.
PAIRED, PROPER_PAIR, UNMAPPED, MATE_UNMAPPED, REVERSE = 1, 2, 4, 8, 16
SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048

PLACEMENT = ["chrom", "pos", "cigar"]

# Intron end pairs (first two and last two bases) of each strand.
FORWARD_MOTIFS = ["GTAG", "GCAG", "ATAC"]
REVERSE_MOTIFS = ["CTAC", "CTGC", "GTAT"]


def has_flag(bit: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(F.lit(bit)) != 0


def is_mapped() -> Column:
    return ~has_flag(UNMAPPED)


def flag_bits(alignments: DataFrame) -> DataFrame:
    """One boolean column per flag bit in use."""
    return alignments.withColumns(
        {
            "is_unmapped": has_flag(UNMAPPED),
            "is_reverse": has_flag(REVERSE),
            "is_secondary": has_flag(SECONDARY),
            "is_qcfail": has_flag(QC_FAIL),
            "is_duplicate": has_flag(DUPLICATE),
            "is_supplementary": has_flag(SUPPLEMENTARY),
        }
    )


def mapq_filter(alignments: DataFrame, minimum: int = 10) -> DataFrame:
    """P5: keep mapping quality >= ``minimum``."""
    return alignments.where(F.col("mapq") >= minimum)


def with_cigar_ops(alignments: DataFrame) -> DataFrame:
    """A1: the CIGAR as an array of (len, op)."""
    return alignments.withColumn("ops", cigar_ops("cigar"))


def with_ref_end(alignments: DataFrame) -> DataFrame:
    """A2: last reference position of each alignment."""
    return alignments.withColumn("ref_end", ref_end("pos", "cigar"))


def aligned_blocks(alignments: DataFrame) -> DataFrame:
    """A3: one row per aligned block of every mapped row; blocks end at N runs."""
    return alignments.where(is_mapped()).select("*", F.inline(blocks("pos", "cigar")))


def spliced(alignments: DataFrame) -> DataFrame:
    return alignments.where(is_mapped() & F.contains("cigar", F.lit("N")))


def junctions(alignments: DataFrame) -> DataFrame:
    """A4: introns with their supporting reads, unique and multi-mapping.

    One shuffle: reads over the same intron are combined on the map side.
    """
    rows = spliced(alignments).select("sample", "chrom", "pos", "cigar", "nh")
    return (
        placed_introns(rows)
        .groupBy("sample", "chrom", "i_start", "i_end")
        .agg(
            F.count(F.when(F.col("nh") == 1, 1)).alias("n_unique"),
            F.count(F.when(F.col("nh") > 1, 1)).alias("n_multi"),
        )
    )


def intron_length_filter(alignments: DataFrame, shortest: int = 20, longest: int = 1_000_000) -> DataFrame:
    """A5: drop rows with an N run outside [shortest, longest]."""
    return alignments.where(
        F.forall(cigar_ops("cigar"), lambda x: (x["op"] != "N") | x["len"].between(shortest, longest))
    )


def annotated_junctions(exons: DataFrame, key: str = "transcript_id", width: int = 65_536) -> DataFrame:
    """(chrom, i_start, i_end) of the introns between neighbouring exons of ``key``.

    Each exon is paired with the one before it in two levels: inside position bins,
    then from the last exon of a bin to the first of the next used bin. No window
    therefore sees more than one bin of a transcript, or one row per bin.
    """
    by = [key, "chrom"]
    distinct = exons.select(*by, "start_pos", "end_pos").distinct().withColumn("_bin", int_div(F.col("start_pos"), width))
    inside = Window.partitionBy(*by, "_bin").orderBy("start_pos", "end_pos")
    within = distinct.withColumn("_prev_end", F.lag("end_pos").over(inside)).select(
        "chrom", "start_pos", "_prev_end"
    )
    ends = distinct.groupBy(*by, "_bin").agg(
        F.min(F.struct("start_pos", "end_pos")).alias("_first"),
        F.max(F.struct("start_pos", "end_pos")).alias("_last"),
    )
    across = ends.select(
        "chrom",
        F.col("_first.start_pos").alias("start_pos"),
        F.lag("_last.end_pos").over(Window.partitionBy(*by).orderBy("_bin")).alias("_prev_end"),
    )
    return (
        within.unionByName(across)
        .where(F.col("start_pos") > F.col("_prev_end") + 1)
        .select("chrom", (F.col("_prev_end") + 1).alias("i_start"), (F.col("start_pos") - 1).alias("i_end"))
        .distinct()
    )


def junction_overhangs(
    alignments: DataFrame, annotated: DataFrame, novel: int = 8, known: int = 1
) -> DataFrame:
    """Each intron of each distinct spliced placement, its overhang and what it needs."""
    found = spliced(alignments).select(*PLACEMENT).distinct()
    cells = placed_introns(found)
    marked = cells.join(annotated.withColumn("annotated", F.lit(True)), ["chrom", "i_start", "i_end"], "left")
    is_known = F.coalesce("annotated", F.lit(False))
    needed = F.when(is_known, known).otherwise(novel)
    return marked.select(
        *PLACEMENT,
        "i_start",
        "i_end",
        "overhang",
        is_known.alias("annotated"),
        (F.col("overhang") >= needed).alias("enough"),
    )


def overhang_filter(alignments: DataFrame, annotated: DataFrame, novel: int = 8, known: int = 1) -> DataFrame:
    """Drop rows with a junction whose overhang is too short.

    Only the placements that fail are joined against the alignments.
    """
    bad = junction_overhangs(alignments, annotated, novel, known).where(~F.col("enough"))
    return drop_placements(alignments, bad)


def drop_placements(alignments: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of ``alignments`` placed like none of the rows of ``bad``.

    Rows that are unmapped or not spliced cannot be in ``bad`` and skip the join: a second
    scan of columns costs less than a shuffle of all rows. The distinct placements are dealt
    out anew before the join, so that both of its sides are shuffled for it and adaptive
    execution splits a placement that very many reads share.
    """
    could_be = F.coalesce(is_mapped() & F.contains("cigar", F.lit("N")), F.lit(False))
    distinct = bad.select(*PLACEMENT).distinct().hint("rebalance")
    checked = alignments.where(could_be).join(distinct, PLACEMENT, "left_anti")
    return alignments.where(~could_be).unionByName(checked)


def multimap_cap(alignments: DataFrame, maximum: int = 20) -> DataFrame:
    """Rows of reads with more than ``maximum`` hits become unmapped: flag set, place and
    CIGAR taken away. Rows without the tag stay as they are."""
    over = F.coalesce(F.col("nh") > maximum, F.lit(False)) & is_mapped()
    emptied = {c: F.when(~over, F.col(c)) for c in ("chrom", "pos")}
    return alignments.withColumns(
        {
            "flag": F.when(over, F.col("flag").bitwiseOR(F.lit(UNMAPPED))).otherwise(F.col("flag")),
            **emptied,
            "cigar": F.when(over, F.lit("*")).otherwise(F.col("cigar")),
            "mapq": F.when(over, F.lit(0)).otherwise(F.col("mapq")),
        }
    )


def mismatch_filter(alignments: DataFrame, maximum: int = 999, percent_of_read: int = 4) -> DataFrame:
    """Keep NM <= ``maximum`` and NM <= ``percent_of_read`` % of the read length.

    NM also counts inserted and deleted bases; an aligner's own ratio is over
    mismatches only. Rows without the tag stay, unmapped ones among them.
    """
    few = (F.col("nm") <= maximum) & (F.col("nm") * 100 <= query_length("cigar") * percent_of_read)
    return alignments.where(F.col("nm").isNull() | few)


def exact_mismatch_filter(alignments: DataFrame, maximum: int = 999, percent_of_read: int = 4) -> DataFrame:
    """A8 over mismatches alone: as :func:`mismatch_filter`, with the count that MD gives.

    Inserted and deleted bases don't count. Rows without MD are judged by NM, those without
    either stay.
    """
    found = F.coalesce(mismatches("md"), F.col("nm"))
    few = (found <= maximum) & (found * 100 <= query_length("cigar") * percent_of_read)
    return alignments.where(found.isNull() | few)


def mismatch_sites(alignments: DataFrame) -> DataFrame:
    """(sample, chrom, ref_pos, base, n): mapped reads that differ from the reference base at a position.

    Equal sites are counted in each Arrow batch, then in as many partitions as the rows need, so no task holds
    more of them with more input, and copies of a read are few rows of the one shuffle.
    """
    slim = alignments.where(is_mapped() & (mismatches("md") > 0)).select("sample", "chrom", "pos", "cigar", "md")
    sites = slim.mapInArrow(counted_sites(located(5, 2, 3, 4)), "sample string, chrom string, ref_pos long, base string, n long")
    keys = ["sample", "chrom", "ref_pos", "base"]
    return sites.repartition(partitions_for(alignments), *keys).groupBy(*keys).agg(F.sum("n").alias("n"))


def junction_motifs(found: DataFrame, contigs: DataFrame, chunk: int) -> DataFrame:
    """Add ``motif`` (first and last two intron bases) to (chrom, i_start, i_end) rows.

    ``contigs(chrom, chunk_no, offset, seq)`` holds the reference in pieces of
    ``chunk`` bases. Four single bases are looked up, because a pair may lie on two
    pieces. A junction outside the reference has no motif.
    """
    spots = found.select("chrom", "i_start", "i_end").distinct()
    wanted = F.array(F.col("i_start"), F.col("i_start") + 1, F.col("i_end") - 1, F.col("i_end"))
    lookups = spots.select("*", F.posexplode(wanted).alias("_at", "_p")).withColumn(
        "chunk_no", int_div(F.col("_p") - 1, chunk)
    )
    bases = lookups.join(contigs.select("chrom", "chunk_no", "offset", "seq"), ["chrom", "chunk_no"]).select(
        "chrom",
        "i_start",
        "i_end",
        "_at",
        F.upper(F.substr("seq", (F.col("_p") - F.col("offset")).cast("int"), F.lit(1))).alias("_base"),
    )

    def base(i: int) -> Column:
        return F.max(F.when(F.col("_at") == i, F.col("_base")))

    motifs = bases.groupBy("chrom", "i_start", "i_end").agg(F.concat(*[base(i) for i in range(4)]).alias("motif"))
    return found.join(motifs, ["chrom", "i_start", "i_end"], "left")


def _motif_strand() -> Column:
    return F.when(F.col("motif").isin(*FORWARD_MOTIFS), "+").when(F.col("motif").isin(*REVERSE_MOTIFS), "-")


def _placement_strands(alignments: DataFrame, contigs: DataFrame, chunk: int) -> DataFrame:
    """Per spliced placement: number of junctions, canonical ones, and strands seen."""
    found = spliced(alignments).select(*PLACEMENT).distinct()
    cells = placed_introns(found)
    return (
        junction_motifs(cells, contigs, chunk)
        .withColumn("_strand", _motif_strand())
        .groupBy(*PLACEMENT)
        .agg(
            F.count("*").alias("n_junctions"),
            F.count("_strand").alias("n_canonical"),
            F.min("_strand").alias("_low"),
            F.max("_strand").alias("_high"),
        )
    )


def noncanonical_filter(alignments: DataFrame, contigs: DataFrame, chunk: int) -> DataFrame:
    """Drop rows with a junction that has none of the known intron motifs."""
    placements = _placement_strands(alignments, contigs, chunk)
    return drop_placements(alignments, placements.where(F.col("n_canonical") < F.col("n_junctions")))


def strand_from_intron(alignments: DataFrame, contigs: DataFrame, chunk: int) -> DataFrame:
    """A10: strand of each spliced placement from its intron motifs.

    '.' where the junctions disagree or none has a known motif.
    """
    strand = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(".")
    return _placement_strands(alignments, contigs, chunk).select(
        *PLACEMENT, "n_junctions", F.coalesce(strand, F.lit(".")).alias("strand")
    )


def coordinate_sort(alignments: DataFrame, dictionary: DataFrame, partitions: int | None = None) -> DataFrame:
    """Global order by dictionary position, then coordinate; unplaced rows last.

    Range partitioning also uses the read id and flag, so that many reads on one
    coordinate can be spread over several partitions. The dictionary is one row per contig
    of a reference, thousands at most, and is broadcast: a shuffle by contig would send
    all alignments to a few tasks.
    """
    ordinals = F.broadcast(dictionary.select("chrom", "ordinal"))
    placed = alignments.join(ordinals, "chrom", "left").withColumn(
        "ordinal", F.coalesce(F.col("ordinal").cast("long"), F.lit(2**62))
    )
    keys = ["ordinal", "pos", "read_id", "flag"]
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


# Line of the report, condition on the row.
def _flagstat_lines() -> dict[str, Column]:
    yes = F.lit(True)
    primary = ~has_flag(SECONDARY) & ~has_flag(SUPPLEMENTARY)
    paired = primary & has_flag(PAIRED)
    return {
        "total": yes,
        "primary": primary,
        "secondary": has_flag(SECONDARY),
        "supplementary": has_flag(SUPPLEMENTARY) & ~has_flag(SECONDARY),
        "duplicates": has_flag(DUPLICATE),
        "mapped": is_mapped(),
        "primary mapped": primary & is_mapped(),
        "paired in sequencing": paired,
        "properly paired": paired & has_flag(PROPER_PAIR) & is_mapped(),
        "singletons": paired & is_mapped() & has_flag(MATE_UNMAPPED),
    }


def flagstat(alignments: DataFrame) -> DataFrame:
    """(sample, metric, passed, failed, passed_pct) counts by flag, in one pass.

    ``passed_pct`` is the share of all rows that passed QC.
    """
    lines = _flagstat_lines()
    failed = has_flag(QC_FAIL)
    aggs = []
    for i, condition in enumerate(lines.values()):
        aggs.append(F.count(F.when(condition & ~failed, 1)).alias(f"_p{i}"))
        aggs.append(F.count(F.when(condition & failed, 1)).alias(f"_f{i}"))
    rows = [
        F.struct(F.lit(name).alias("metric"), F.col(f"_p{i}").alias("passed"), F.col(f"_f{i}").alias("failed"))
        for i, name in enumerate(lines)
    ]
    return (
        alignments.groupBy("sample")
        .agg(*aggs)
        .select("sample", F.col("_p0").alias("_all"), F.inline(F.array(*rows)))
        .select("sample", "metric", "passed", "failed", percent(F.col("passed"), F.col("_all")).alias("passed_pct"))
    )


def idxstats(alignments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Mapped and unmapped rows per sample and contig, zero rows kept, plus '*'.

    An unmapped row that carries a contig is counted as unmapped there; '*' holds the
    rows that have none.
    """
    chrom = F.when(F.col("chrom").isNull(), "*").otherwise(F.col("chrom"))
    counts = alignments.groupBy("sample", chrom.alias("chrom")).agg(
        F.count(F.when(is_mapped(), 1)).alias("mapped"), F.count(F.when(~is_mapped(), 1)).alias("unmapped")
    )
    spark = alignments.sparkSession
    star = spark.range(1).select(F.lit("*").alias("chrom"), F.lit(0).cast("long").alias("length"))
    contigs = dictionary.select("chrom", F.col("length").cast("long").alias("length")).unionByName(star)
    grid = with_samples(contigs, counts.select("sample"))
    zero = F.lit(0).cast("long")
    return grid.join(counts, ["sample", "chrom"], "left").select(
        "sample",
        "chrom",
        "length",
        F.coalesce("mapped", zero).alias("mapped"),
        F.coalesce("unmapped", zero).alias("unmapped"),
    )


def chrm_fraction(alignments: DataFrame, contig: str = "chrM", warn: float = 20.0) -> DataFrame:
    """Share of mapped rows on the mitochondrial contig, to one decimal.

    Null (and no warning) for a sample without mapped rows or without rows there.
    """
    mapped = is_mapped()
    counts = alignments.groupBy("sample").agg(
        F.count(F.when(mapped & (F.col("chrom") == contig), 1)).alias("chrm_reads"),
        F.count(F.when(mapped, 1)).alias("mapped"),
    )
    share = F.when(
        (F.col("mapped") > 0) & (F.col("chrm_reads") > 0),
        F.round(percent(F.col("chrm_reads"), F.col("mapped")), 1),
    )
    return counts.withColumn("chrm_pct", share).withColumn("warn", F.coalesce(F.col("chrm_pct") > warn, F.lit(False)))


def alignment_rates(reads: DataFrame, alignments: DataFrame, multimap_max: int = 20) -> DataFrame:
    """Unique, multi-mapping and unmapped share of the input reads per sample.

    ``reads`` are those given to the aligner, which need not write a row for a read that
    it can't place. A read is unique if its largest NH is 1 (or it has no such tag),
    multi-mapping up to ``multimap_max``. Reads without a mapped row, or above the cap,
    are unmapped.
    """
    hits = F.coalesce("nh", F.lit(1))
    per_read = alignments.where(is_mapped()).groupBy("sample", "read_id").agg(F.max(hits).alias("_nh"))
    mapped = per_read.groupBy("sample").agg(
        F.count(F.when(F.col("_nh") == 1, 1)).alias("_unique"),
        F.count(F.when(F.col("_nh").between(2, multimap_max), 1)).alias("_multi"),
    )
    totals = reads.groupBy("sample").agg(F.count("*").alias("n_reads"))
    zero = F.lit(0).cast("long")
    unique, multi = F.coalesce("_unique", zero), F.coalesce("_multi", zero)
    n = F.col("n_reads")
    return totals.join(mapped, "sample", "left").select(
        "sample",
        "n_reads",
        unique.alias("n_unique"),
        multi.alias("n_multi"),
        (n - unique - multi).alias("n_unmapped"),
        percent(unique, n).alias("pct_unique"),
        percent(multi, n).alias("pct_multi"),
        percent(n - unique - multi, n).alias("pct_unmapped"),
    )
