"""Readers for GTF, FASTA, SAM and count-matrix text."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bases import int_div
from ..operators.features import contig_name, parse_attributes
from .fastq import header_lines, open_filesystem
from .reports import sample_folder
from .single_files import write_files

# Columns of the annotation format.
GTF_SCHEMA = (
    "chrom string, source string, feature string, start_pos long, end_pos long, "
    "score string, strand string, frame string, attributes string"
)
ALIGNMENT_FILE = r"_Aligned\.sortedByCoord\.out$"
CHUNK = 16_384


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Features; '#' lines skipped, attributes as a map, '.' scores as null."""
    rows = (
        spark.read.schema(GTF_SCHEMA)
        .option("sep", "\t")
        .option("comment", "#")
        .option("quote", "")
        .csv(path)
    )
    return rows.withColumns(
        {"score": F.col("score").try_cast("double"), "attributes": parse_attributes("attributes")}
    )


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """S3: contigs(chrom, chunk_no, offset, seq), each contig cut at multiples of ``chunk``.

    Read line by line, so a contig is never one row. The lines of one file split are
    ordered among themselves; which contig a split starts in, and at which offset, is
    worked out on a table with one row per split and contig. ``offset`` is 0-based.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        F.regexp_replace("value", r"\s+$", "").alias("_text"),
    )
    is_header = F.col("_text").startswith(">")
    in_split = Window.partitionBy("_file", "_block").orderBy("_line")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_part", F.sum(F.when(is_header, 1).otherwise(0)).over(so_far))
    bases = F.when(is_header, 0).otherwise(F.length("_text")).cast("long")
    before = (
        Window.partitionBy("_file", "_block", "_part").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    )
    lines = lines.withColumn("_at", F.coalesce(F.sum(bases).over(before), F.lit(0).cast("long")))

    parts = lines.groupBy("_file", "_block", "_part").agg(
        F.max(F.when(is_header, contig_name(F.col("_text")))).alias("_name"), F.sum(bases).alias("_bases")
    )
    in_file = Window.partitionBy("_file").orderBy("_block", "_part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("chrom", F.last("_name", ignorenulls=True).over(in_file)).withColumn(
        "_contig", F.sum(F.when(F.col("_name").isNotNull(), 1).otherwise(0)).over(in_file)
    )
    earlier = (
        Window.partitionBy("_file", "_contig").orderBy("_block", "_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.withColumn("_start", F.coalesce(F.sum("_bases").over(earlier), F.lit(0).cast("long")))

    placed = (
        lines.where(~is_header & (F.length("_text") > 0))
        .join(parts.select("_file", "_block", "_part", "chrom", "_start"), ["_file", "_block", "_part"])
        .withColumn("_from", F.col("_start") + F.col("_at"))
        .withColumn("_to", F.col("_from") + F.length("_text") - 1)
    )
    # A line that crosses a chunk border is cut there.
    pieces = placed.select(
        "chrom",
        "_from",
        "_to",
        "_text",
        F.explode(F.sequence(int_div(F.col("_from"), chunk), int_div(F.col("_to"), chunk))).alias("chunk_no"),
    ).withColumn("_low", F.greatest(F.col("_from"), F.col("chunk_no") * chunk))
    high = F.least(F.col("_to"), (F.col("chunk_no") + 1) * chunk - 1)
    piece = F.substr(
        "_text", (F.col("_low") - F.col("_from") + 1).cast("int"), (high - F.col("_low") + 1).cast("int")
    )
    # At most ``chunk`` bases are gathered per group.
    return (
        pieces.groupBy("chrom", "chunk_no")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("_low").alias("at"), piece.alias("s")))).alias("_p"))
        .select(
            "chrom",
            F.col("chunk_no").cast("int").alias("chunk_no"),
            (F.col("chunk_no") * chunk).alias("offset"),
            F.array_join(F.transform("_p", lambda x: x["s"]), "").alias("seq"),
        )
    )


def _tag(tags: Column, name: str) -> Column:
    return F.element_at(tags, F.lit(name))


def _sam_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), "value")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments. The sample comes from the file name, or from a folder ``sample=...``;
    tags are a map of strings. A line of fewer than eleven fields is an error."""
    fields = F.split("value", "\t")
    name = F.regexp_replace(F.regexp_extract("_file", r"([^/]+?)\.sam(?:\.gz)?$", 1), ALIGNMENT_FILE, "")
    sample = F.coalesce(F.nullif(sample_folder("_file"), F.lit("")), name)
    broken = F.raise_error(F.concat(F.lit("broken alignment line in "), F.col("_file"), F.lit(": "), F.col("value")))
    rows = (
        _sam_lines(spark, path)
        .where(~F.col("value").rlike(r"^@[A-Z][A-Z](\t|$)") & (F.col("value") != ""))
        .select(sample.alias("sample"), F.when(F.size(fields) >= 11, fields).otherwise(broken).alias("f"))
    )
    tags = F.map_from_entries(
        F.transform(
            F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))),
            lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substr(t, F.lit(6)).alias("value")),
        )
    )

    def field(i: int) -> Column:
        return F.get("f", F.lit(i))

    return rows.select("sample", "f", tags.alias("tags")).select(
        "sample",
        field(0).alias("read_id"),
        field(1).cast("int").alias("flag"),
        F.nullif(field(2), F.lit("*")).alias("chrom"),
        field(3).cast("long").alias("pos"),
        field(4).cast("int").alias("mapq"),
        field(5).alias("cigar"),
        field(9).alias("seq"),
        field(10).alias("qual"),
        _tag(F.col("tags"), "NH").cast("int").alias("nh"),
        _tag(F.col("tags"), "NM").cast("int").alias("nm"),
        "tags",
    )


def read_sam_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """dictionary(chrom, length, ordinal) from the leading @SQ lines of all files at ``path``.

    Each file is read up to the first line that is not part of its header. ``ordinal`` counts
    the contigs from 0, in the order of the first file by path that names them, and their place
    in it. Files that disagree on the length of a contig are an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")  # names only
    cloudpickle.register_pickle_by_value(sys.modules[open_filesystem.__module__])

    def header(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, inner = open_filesystem(name)
                with store.open_input_stream(inner, compression="detect") as stream:
                    lines = header_lines(stream)
                columns = [pa.array([name] * len(lines), pa.string()), pa.array(range(len(lines)), pa.int64())]
                yield pa.record_batch([*columns, pa.array(lines, pa.string())], ["path", "place", "value"])

    lines = files.mapInArrow(header, "path string, place long, value string").where(F.col("value").startswith("@SQ\t"))
    contig = (
        lines.select(
            F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"),
            F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"),
            F.struct("path", "place").alias("at"),
        )
        .groupBy("chrom")
        .agg(F.min("length").alias("length"), F.max("length").alias("longest"), F.min("at").alias("at"))
    )
    differ = F.raise_error(F.concat(F.lit("files disagree on the length of contig "), F.col("chrom")))
    order = Window.partitionBy(F.lit(0)).orderBy("at")  # one row per contig
    return contig.select(
        "chrom",
        F.when(F.col("length") == F.col("longest"), F.col("length")).otherwise(differ).alias("length"),
        (F.row_number().over(order) - 1).cast("long").alias("ordinal"),
    )


def read_count_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Long counts(gene_id, length, path, count) of a wide featureCounts table.

    The columns that end in .bam are unpivoted; cells that are not numbers become 0. Counts
    are doubles, as reads may be counted in parts.
    """
    matrix = spark.read.option("sep", "\t").option("comment", "#").option("header", True).csv(path)
    for column in ("Geneid", "Length"):
        if column not in matrix.columns:
            raise ValueError(f"missing expected column: {column}")
    cells = [c for c in matrix.columns if c.endswith(".bam")]
    if not cells:
        raise ValueError("no count columns found")
    quoted = [F.col(f"`{c}`") for c in cells]
    long = matrix.select("Geneid", "Length", *quoted).unpivot(
        ["Geneid", "Length"], [F.col(f"`{c}`") for c in cells], "path", "cell"
    )
    return long.select(
        F.col("Geneid").alias("gene_id"),
        F.col("Length").cast("int").alias("length"),
        "path",
        F.coalesce(F.col("cell").try_cast("double"), F.lit(0.0)).alias("count"),
    )


def write_matrix_tsv(matrix: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """A wide matrix as tab-separated text with a header line in each part."""
    out = matrix.select(*columns) if columns else matrix
    out.write.option("sep", "\t").option("header", True).csv(path)


def write_matrix_file(matrix: DataFrame, path: str, name: str) -> DataFrame:
    """A wide matrix as one tab-separated file ``path``/name.tsv with one header line.

    Rows keep their order. Null is an empty cell; a cell with a tab or a line end is an error.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in matrix.columns]
    wrong = F.raise_error(F.lit("a cell holds a tab or a line end"))
    cells = [F.when(c.rlike(r"[\t\r\n]"), wrong).otherwise(c) for c in cells]
    rows = matrix.select(F.lit(name).alias("name"), F.concat_ws("\t", *cells).alias("line"))
    return write_files(rows, path, ".tsv", header="\t".join(matrix.columns), names=[name])


def read_matrix_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back what :func:`write_matrix_tsv` wrote."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)
