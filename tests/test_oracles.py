"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from readloom.catalog.queries import QUERIES

SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    with connect(sf_dir) as c:
        yield c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["gene_id", "length", "mean_tpm", "rank"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    assert differences(entry_point.queries()[name](spark, sf_dir), con, SQL[name]) == []


def test_fixtures_read_every_letter(spark, sf_dir, con):
    """No letter of a document is left out of the reads or of the contigs."""
    from pyspark.sql import functions as F

    from readloom.catalog import fixtures as fx

    for path in (sf_dir, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        letters = docs.agg(F.sum(F.length(F.regexp_replace(F.lower("text"), r"[^\p{L}]", "")))).first()[0]
        assert fx.reads(spark, path).agg(F.sum(F.length("qual"))).first()[0] == letters
        pieces = fx.contigs(spark, path).agg(F.count("*"), F.min(F.length("seq"))).first()
        assert pieces[1] == fx.CONTIG_CHUNK and pieces[0] * fx.CONTIG_CHUNK >= letters
