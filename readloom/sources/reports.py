"""Readers for the small report files of the workflow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the verdict file and of idxstats.
STATUS_SCHEMA = "status string, module string, file string"
IDXSTATS_SCHEMA = "chrom string, length long, mapped long, unmapped long"
# Fields used of the trimming report; other fields of the file are not read.
_STAGE = "struct<total_reads:long,total_bases:long,q20_bases:long,q30_bases:long,gc_content:double>"
TRIM_SCHEMA = (
    f"summary struct<before_filtering:{_STAGE},after_filtering:{_STAGE}>, "
    "filtering_result struct<passed_filter_reads:long,low_quality_reads:long,"
    "too_many_N_reads:long,too_short_reads:long>"
)
# Fixed value: the rate lines of an alignment log.
ALIGN_LOG = r"Uniquely mapped|mapped to multiple|% of reads unmapped"


def sample_folder(path: str | Column) -> Column:
    """Sample named by a folder ``sample=...`` on the way to a file; empty if there is none."""
    value = F.regexp_extract(path, r"^.*/sample=([^/]+)/", 1)
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def _file_name(path: str | Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _sample_before(pattern: str) -> Column:
    """Sample in front of ``pattern`` in the file's name, or that of a sample folder."""
    path = F.col("_metadata.file_path")
    named = F.regexp_extract(_file_name(path), rf"^(.*?)(?:{pattern})", 1)
    return F.coalesce(F.nullif(sample_folder(path), F.lit("")), named)


def _sample_of_report() -> Column:
    """Sample in '<sample>.sra_fastqc/<file>'; the folder may be a partition's, 'report=...'."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return F.regexp_replace(folder, r"^[^=/]*=|(_1|\.sra|\.trimmed)*_fastqc$", "")


def read_qc_report(spark: SparkSession, path: str) -> DataFrame:
    """qc_metrics(sample, module, status, row_no, metric, value) of sectioned text.

    A report is a few hundred lines, read as one value. Each table cell becomes one
    row named by its column; ``row_no`` counts the rows of a module from 1. A header
    line before the last one (``#name<TAB>value``) is a metric of row 0. A module without
    a table is one row that has its status and nothing else.
    """
    return parse_qc_report(spark.read.text(path, wholetext=True).select(_sample_of_report().alias("sample"), "value"))


def parse_qc_report(reports: DataFrame) -> DataFrame:
    """The cells of ``reports(sample, value)``, one whole report per row."""
    text = F.regexp_replace("value", "\r\n", "\n")
    sections = reports.withColumn("value", text).select("sample", F.explode(F.split("value", ">>END_MODULE")).alias("section"))
    lines = F.filter(F.split(F.regexp_extract("section", r"(?s)>>(.*)", 1), "\n"), lambda x: x != "")
    modules = sections.where(F.col("section").contains(">>")).select("sample", lines.alias("lines")).select(
        "sample",
        F.split(F.get("lines", F.lit(0)), "\t").alias("title"),
        F.filter("lines", lambda x, i: (i > 0) & x.startswith("#")).alias("heads"),
        F.filter("lines", lambda x, i: (i > 0) & ~x.startswith("#")).alias("rows"),
    )
    columns = F.split(F.substr(F.get("heads", F.size("heads") - 1), F.lit(2)), "\t")
    # Extra header lines carry one value each.
    extra = F.transform(
        F.slice("heads", 1, F.greatest(F.size("heads") - 1, F.lit(0))),
        lambda h: F.struct(
            F.lit(0).alias("row_no"),
            F.substring_index(F.substr(h, F.lit(2)), "\t", 1).alias("metric"),
            F.substring_index(h, "\t", -1).alias("value"),
        ),
    )
    cells = F.flatten(
        F.transform(
            F.when(F.size("heads") > 0, F.col("rows")).otherwise(F.array().cast("array<string>")),
            lambda r, i: F.transform(
                F.arrays_zip(F.col("columns").alias("c"), F.split(r, "\t").alias("v")),
                lambda x: F.struct((i + 1).alias("row_no"), x["c"].alias("metric"), x["v"].alias("value")),
            ),
        )
    )
    return modules.withColumn("columns", columns).select(
        "sample",
        F.get("title", F.lit(0)).alias("module"),
        F.get("title", F.lit(1)).alias("status"),
        F.inline_outer(F.concat(extra, cells)),
    )


def read_qc_status(spark: SparkSession, path: str) -> DataFrame:
    """qc_status(sample, module, status) of the three-column verdict file."""
    return parse_qc_status(spark.read.schema(STATUS_SCHEMA).option("sep", "\t").csv(path))


def parse_qc_status(rows: DataFrame) -> DataFrame:
    """(status, module, file) rows with the sample taken from the file name."""
    sample = F.regexp_replace("file", r"(_1|\.sra|\.trimmed)*\.(fastq|fq)(\.gz)?$", "")
    return rows.select(sample.alias("sample"), "module", "status")


def read_align_log(spark: SparkSession, path: str) -> DataFrame:
    """Rate lines (sample, line, label, value) of an alignment log."""
    return parse_align_log(spark.read.text(path).select(_sample_before(r"_?Log\.final\.out").alias("sample"), "value"))


def parse_align_log(lines: DataFrame) -> DataFrame:
    """The rate lines among ``lines(sample, value)``."""
    return lines.where(F.col("value").rlike(ALIGN_LOG)).select(
        "sample",
        F.regexp_replace("value", r"^\s+", "").alias("line"),
        F.trim(F.regexp_extract("value", r"^\s*(.*?)\s*\|", 1)).alias("label"),
        F.trim(F.regexp_extract("value", r"\|\s*(.*)$", 1)).alias("value"),
    )


def read_flagstat(spark: SparkSession, path: str) -> DataFrame:
    """(sample, label, passed, failed) of flagstat text.

    Lines are told apart by their label, not by their place in the file.
    """
    sample = _sample_before(r"_Aligned\.sortedByCoord\.out\.flagstat|\.flagstat")
    return parse_flagstat(spark.read.text(path).select(sample.alias("sample"), "value"))


def parse_flagstat(lines: DataFrame) -> DataFrame:
    """The counted lines among ``lines(sample, value)``.

    Shares and the note on QC are taken off a label; other brackets belong to it.
    """
    pattern = r"^(\d+) \+ (\d+) (.+?)\s*(?:\([^()]*(?:%|N/A|QC-passed)[^()]*\))?$"
    return lines.where(F.col("value").rlike(pattern)).select(
        "sample",
        F.regexp_extract("value", pattern, 3).alias("label"),
        F.regexp_extract("value", pattern, 1).cast("long").alias("passed"),
        F.regexp_extract("value", pattern, 2).cast("long").alias("failed"),
    )


def read_idxstats(spark: SparkSession, path: str) -> DataFrame:
    """(sample, chrom, length, mapped, unmapped)."""
    rows = spark.read.schema(IDXSTATS_SCHEMA).option("sep", "\t").csv(path)
    sample = _sample_before(r"_Aligned\.sortedByCoord\.out\.idxstats|\.idxstats")
    return rows.select(sample.alias("sample"), "chrom", "length", "mapped", "unmapped")


def read_count_summary(spark: SparkSession, path: str) -> DataFrame:
    """Assignment outcomes (path, status, n) of a counting summary: one column per alignment file."""
    table = spark.read.option("sep", "\t").option("header", True).csv(path)
    if "Status" not in table.columns:
        raise ValueError("missing expected column: Status")
    files = [c for c in table.columns if c.endswith(".bam")]
    if not files:
        raise ValueError("no count columns found")
    quoted = [F.col(f"`{c}`") for c in files]
    long = table.select("Status", *quoted).unpivot(["Status"], [F.col(f"`{c}`") for c in files], "path", "cell")
    return long.select("path", F.col("Status").alias("status"), F.col("cell").cast("long").alias("n"))


def read_trim_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per trimming report: totals before and after, reads per outcome."""
    rows = spark.read.schema(TRIM_SCHEMA).option("multiLine", True).json(path)
    sample = _sample_before(r"\.fastp\.json|\.json")
    return flatten_trim_report(rows.select(sample.alias("sample"), "summary", "filtering_result"))


def flatten_trim_report(rows: DataFrame) -> DataFrame:
    """Flat columns of ``rows(sample, summary, filtering_result)``."""
    fields = ["total_reads", "total_bases", "q20_bases", "q30_bases", "gc_content"]
    outcomes = ["passed_filter_reads", "low_quality_reads", "too_many_N_reads", "too_short_reads"]
    return rows.select(
        "sample",
        *[F.col(f"summary.before_filtering.{f}").alias(f"before_{f}") for f in fields],
        *[F.col(f"summary.after_filtering.{f}").alias(f"after_{f}") for f in fields],
        *[F.col(f"filtering_result.{o}").alias(o) for o in outcomes],
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """manifest(sample, path, length, modified) of the files below ``path``, by metadata
    only: the file contents are not read."""
    from .fastq import sample_of_path

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        sample_of_path("path").alias("sample"), "path", "length", F.col("modificationTime").alias("modified")
    )
