"""The workflow's data work as lazy plans over operators.

Each function takes DataFrames and returns one. Where several plans start from the
same costly table (reads, trimmed reads, alignments), write it once with
:func:`materialise` and pass the stored table in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bases import bases_at_least, gc_count, percent
from ..operators import align, expression, overlap, reads_qc, report, trim
from ..session import scratch_dir


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    The stored table survives the loss of executors and cuts the lineage.
    """
    path = scratch_dir(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quantify(
    alignments: DataFrame, exons: DataFrame, min_mapq: int = 10, strand: int = 0, width: int = overlap.GENOME_BIN
) -> DataFrame:
    """Alignments and exons -> dense long count matrix with gene lengths."""
    counted = overlap.assigned_counts(alignments, exons, min_mapq, strand, width)
    return expression.count_matrix(overlap.gene_counts(counted), overlap.gene_length(exons, width), counted)


def trim_report(chain: DataFrame) -> DataFrame:
    """The trimming report, one nested row per sample: one aggregate over the reads."""

    def stage(seq: str, qual: str, counted: Column) -> Column:
        def total(c: Column) -> Column:
            return F.coalesce(F.sum(F.when(counted, c.cast("long"))), F.lit(0).cast("long"))

        bases = total(F.length(seq))
        return F.struct(
            F.count(F.when(counted, 1)).alias("total_reads"),
            bases.alias("total_bases"),
            total(bases_at_least(qual, 20)).alias("q20_bases"),
            total(bases_at_least(qual, 30)).alias("q30_bases"),
            (total(gc_count(seq)).cast("double") / F.nullif(bases, F.lit(0))).alias("gc_content"),
        )

    outcomes = {
        "passed_filter_reads": trim.PASSED,
        "low_quality_reads": trim.LOW_QUALITY,
        "too_many_N_reads": trim.TOO_MANY_N,
        "too_short_reads": trim.TOO_SHORT,
    }
    return chain.groupBy("sample").agg(
        F.struct(
            stage("raw_seq", "raw_qual", F.lit(True)).alias("before_filtering"),
            stage("seq", "qual", F.col("reason") == trim.PASSED).alias("after_filtering"),
        ).alias("summary"),
        F.struct(*[F.count(F.when(F.col("reason") == r, 1)).alias(n) for n, r in outcomes.items()]).alias(
            "filtering_result"
        ),
    )


def general_stats(
    chain: DataFrame, alignments: DataFrame, exons: DataFrame, width: int = overlap.GENOME_BIN
) -> DataFrame:
    """R1 from the workflow's tables: read, trimming, alignment and assignment rates.

    The reads that passed trimming are what the aligner was given, and so what alignment
    rates are shares of. Samples without reads have no such rates.
    """
    totals = trim.before_after(chain)

    def at(stage: str, column: str):
        return F.max(F.when(F.col("stage") == stage, F.col(column)))

    reads = totals.groupBy("sample").agg(
        at("raw", "n_reads").alias("raw_reads"),
        at("raw", "bases").alias("raw_bases"),
        at("trimmed", "n_reads").alias("trimmed_reads"),
        at("trimmed", "bases").alias("trimmed_bases"),
        percent(at("trimmed", "n_reads"), at("raw", "n_reads")).alias("pass_pct"),
    )
    aligned = align.alignment_rates(trim.trimmed_reads(chain), alignments)
    counted = overlap.assigned_counts(alignments, exons, width=width)
    assigned = counted.groupBy("sample").agg(
        percent(
            F.sum(F.when(F.col("status") == overlap.ASSIGNED, F.col("n")).otherwise(0)), F.sum("n")
        ).alias("assigned_pct")
    )
    return report.general_stats(
        reads, aligned.select("sample", "pct_unique", "pct_multi", "pct_unmapped"), assigned
    )


def summary_table(staged: DataFrame) -> DataFrame:
    """Read statistics before and after trimming, per sample and metric.

    ``staged(sample, stage, seq, qual)`` is read once.
    """
    return reads_qc.qc_compare(reads_qc.stage_metrics(staged))


def report_measures(cells: DataFrame) -> DataFrame:
    """The measures of Q11 from the cells of parsed QC reports (S6): (sample, measure, value).

    Each report is a few hundred cells. A module without a table has no measure.
    """
    entry = F.struct("metric", "value")
    rows = cells.where(F.col("metric").isNotNull()).groupBy("sample", "module", "row_no")
    rows = rows.agg(F.map_from_entries(F.collect_list(entry)).alias("cell"))

    def number(name: str) -> Column:
        return F.try_element_at("cell", F.lit(name)).try_cast("double")

    def module(name: str, **measures: Column) -> DataFrame:
        pairs = [F.struct(F.lit(m).alias("measure"), c.alias("value")) for m, c in measures.items()]
        one = rows.where(F.col("module") == name).groupBy("sample").agg(F.array(*pairs).alias("pairs"))
        return one.select("sample", F.inline("pairs")).where(F.col("value").isNotNull())

    def statistic(name: str) -> Column:
        return F.max(F.when(F.col("cell")["Measure"] == name, F.col("cell")["Value"]))

    ends = F.split(statistic("Sequence length"), "-")
    shortest, longest = (F.element_at(ends, i).cast("double") for i in (1, -1))
    apart = F.greatest(F.abs(number("A") - number("T")), F.abs(number("G") - number("C")))
    shares = F.transform(
        F.filter(F.map_entries("cell"), lambda x: x["key"] != "Position"), lambda x: x["value"].cast("double")
    )
    histogram = rows.where(F.col("module") == "Per sequence GC content").select(
        "sample", number("GC Content").alias("gc"), number("Count").alias("n_reads")
    )
    deviation = reads_qc.gc_deviation(histogram.where("gc is not null"))
    parts = [
        module(
            "Basic Statistics",
            total_sequences=statistic("Total Sequences").cast("double"),
            min_length=shortest,
            length_spread=longest - shortest,
        ),
        module(
            "Per base sequence quality",
            min_lower_quartile=F.min(number("Lower Quartile")),
            min_median=F.min(number("Median")),
        ),
        module("Per sequence quality scores", mode_quality=-F.max(F.struct(number("Count"), -number("Quality")))["col2"]),
        module("Per base sequence content", max_base_difference=F.max(apart)),
        module("Per base N content", max_pct_n=F.max(number("N-Count"))),
        module("Sequence Duplication Levels", dedup_pct=F.max(number("Total Deduplicated Percentage"))),
        module("Overrepresented sequences", max_sequence_pct=F.max(number("Percentage"))),
        module("Adapter Content", max_adapter_pct=F.max(F.array_max(shares))),
        deviation.select("sample", F.lit("gc_deviation").alias("measure"), F.col("gc_deviation").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def general_stats_of_reports(trimmed: DataFrame, logs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """R1 put together from report files, as the merging step does.

    ``trimmed`` comes from the trimming reports (S10), ``logs`` from the alignment logs (S8),
    ``outcomes(sample, status, n)`` from the counting summary.
    """

    def rate(*labels: str) -> Column:
        value = F.regexp_replace("value", "%", "").try_cast("double")
        return F.sum(F.when(F.col("label").isin(*labels), value))

    reads = trimmed.select(
        "sample",
        F.col("before_total_reads").alias("raw_reads"),
        F.col("before_total_bases").alias("raw_bases"),
        F.col("after_total_reads").alias("trimmed_reads"),
        F.col("after_total_bases").alias("trimmed_bases"),
        percent(F.col("after_total_reads"), F.col("before_total_reads")).alias("pass_pct"),
    )
    unmapped = [f"% of reads unmapped: {why}" for why in ("too many mismatches", "too short", "other")]
    aligned = logs.groupBy("sample").agg(
        rate("Uniquely mapped reads %").alias("pct_unique"),
        rate("% of reads mapped to multiple loci").alias("pct_multi"),
        rate(*unmapped).alias("pct_unmapped"),
    )
    assigned = outcomes.groupBy("sample").agg(
        percent(F.sum(F.when(F.col("status") == overlap.ASSIGNED, F.col("n")).otherwise(0)), F.sum("n")).alias(
            "assigned_pct"
        )
    )
    return report.general_stats(reads, aligned, assigned)
