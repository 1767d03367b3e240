"""Annotation and text filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTRIBUTE = r'(\w+)\s+("[^"]*"|[^;"\s]+)'


def filter_contig(df: DataFrame, contig: str) -> DataFrame:
    """Rows of one contig; a plain equality, so it reaches a Parquet scan."""
    return df.where(F.col("chrom") == contig)


def filter_contig_lines(lines: DataFrame, contig: str, column: str = "value") -> DataFrame:
    """P1 on text: rows of the contig and all comment lines."""
    line = F.col(column)
    return lines.where(line.startswith("#") | (F.substring_index(line, "\t", 1) == contig))


def contig_name(header: str | Column) -> Column:
    """Name in a FASTA header: after '>', up to the first whitespace."""
    return F.regexp_extract(header, r"^>?(\S*)", 1)


def feature_type(features: DataFrame, kind: str = "exon") -> DataFrame:
    """Features of one type."""
    return features.where(F.col("feature") == kind)


def parse_attributes(text: str | Column) -> Column:
    """``key "value"; key value; ...`` -> map; a repeated key keeps its first value."""
    keys = F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(1))
    values = F.transform(
        F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(2)), lambda v: F.btrim(v, F.lit('"'))
    )
    entries = F.arrays_zip(keys.alias("key"), values.alias("value"))
    first = F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    return F.map_from_entries(first)


def attribute(features: DataFrame, name: str) -> DataFrame:
    """One attribute as a column of the same name."""
    return features.withColumn(name, F.element_at("attributes", F.lit(name)))


def grep_lines(lines: DataFrame, pattern: str, column: str = "value") -> DataFrame:
    """Lines that match, with leading white space removed."""
    return lines.where(F.col(column).rlike(pattern)).withColumn(
        column, F.regexp_replace(column, r"^\s+", "")
    )
