"""The binned interval join and the counts behind it, against brute force."""

import random

import pytest
from pyspark.sql import functions as F
from test_align import table

from readloom.catalog import fixtures as fx
from readloom.operators import expression, overlap
from readloom.plans import workflow

EXONS = "gene_id string, chrom string, start_pos long, end_pos long, strand string"


def brute_pairs(placed, exons):
    """Placements and exons as tuples -> set of (placement, gene)."""
    import re

    out = set()
    for p in placed:
        at = p.pos
        for n, op in re.findall(r"(\d+)([A-Z=])", p.cigar):
            n = int(n)
            if op in "MDX=":
                for e in exons:
                    if e.chrom == p.chrom and at <= e.end_pos and at + n - 1 >= e.start_pos:
                        out.add((p.chrom, p.pos, p.cigar, p.strand, e.gene_id, e.strand))
            if op in "MDNX=":
                at += n
    return out


@pytest.mark.parametrize("width", [1, 13, 512, 16_384])
def test_binned_join_equals_brute_force(spark, width):
    rng = random.Random(3)
    rows = [(rng.randrange(1, 900), rng.choice(["51M", "30M150N21M", "5S46M", "25M3D26M"]), {"flag": rng.choice([0, 16])}) for _ in range(200)]
    genes = []
    for g in range(30):
        for _ in range(rng.randrange(1, 5)):
            s = rng.randrange(1, 1200)
            genes.append((f"g{g}", "c", s, s + rng.randrange(0, 90), "+" if g % 2 else "-"))
    exons = spark.createDataFrame(genes, EXONS)
    placed = overlap.placements(table(spark, *rows))
    got = {tuple(r) for r in overlap.overlap_join(placed, exons, width).collect()}
    assert got == brute_pairs(placed.collect(), exons.collect())


def test_one_base_is_enough(spark):
    exons = spark.createDataFrame([("g", "c", 150, 200, "+")], EXONS)
    rows = overlap.assign_reads(table(spark, (100, "51M"), (99, "51M"), (200, "51M"), (201, "51M")), exons)
    assert [r.n_genes for r in rows.orderBy("read_id").collect()] == [1, 0, 1, 0]


def test_an_intron_over_an_exon_is_no_hit(spark):
    exons = spark.createDataFrame([("g", "c", 140, 160, "+")], EXONS)
    r = overlap.assign_reads(table(spark, (100, "30M150N21M")), exons).first()
    assert (r.n_genes, r.gene_id, r.status) == (0, None, overlap.NO_FEATURES)


def test_two_exons_of_one_gene_are_one_gene(spark):
    exons = spark.createDataFrame([("g", "c", 100, 110, "+"), ("g", "c", 120, 130, "+"), ("h", "c", 500, 510, "+")], EXONS)
    r = overlap.assign_reads(table(spark, (100, "51M")), exons).first()
    assert (r.n_genes, r.gene_id, r.status) == (1, "g", overlap.ASSIGNED)


@pytest.mark.parametrize("rule,genes", [(0, {"p", "m"}), (1, {"p"}), (2, {"m"})])
def test_strand_rules(spark, rule, genes):
    exons = spark.createDataFrame([("p", "c", 1, 50, "+"), ("m", "c", 101, 150, "-")], EXONS)
    df = table(spark, (1, "10M"), (101, "10M"))
    got = {r.gene_id for r in overlap.assign_reads(df, exons, rule).where("n_genes = 1").collect()}
    assert got == genes


def test_precedence_of_outcomes(spark):
    exons = spark.createDataFrame([("g", "c", 1, 50, "+"), ("h", "c", 40, 60, "+")], EXONS)
    df = table(
        spark,
        (1, "10M", {"flag": 4, "mapq": 0, "nh": 3}),
        (1, "10M", {"mapq": 9, "nh": 3}),
        (1, "10M", {"mapq": 10, "nh": 2}),
        (1, "10M"),
        (1, "10M"),
        (35, "10M"),
        (100, "10M"),
    )
    counted = overlap.assigned_counts(df, exons)
    got = {r.status: r.n for r in overlap.assignment_summary(counted).collect()}
    assert got == {
        overlap.IS_UNMAPPED: 1,
        overlap.MAPPING_QUALITY: 1,
        overlap.MULTI_MAPPING: 1,
        overlap.ASSIGNED: 2,
        overlap.AMBIGUOUS: 1,
        overlap.NO_FEATURES: 1,
    }
    assert [tuple(r) for r in overlap.gene_counts(counted).collect()] == [("g", "s", 2)]


def test_statuses_add_up_to_all_rows(spark, sf_dir):
    a = fx.alignments(spark, sf_dir)
    counted = overlap.assigned_counts(a, fx.exons(spark, sf_dir), width=fx.BIN)
    assert counted.agg(F.sum("n")).first()[0] == a.count()


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_gene_length_is_the_union(spark, width):
    exons = spark.createDataFrame(
        [("g", "c", 1, 10, "+"), ("g", "c", 5, 20, "+"), ("g", "c", 21, 30, "+"), ("g", "c", 40, 40, "+"), ("g", "d", 1, 5, "+"), ("h", "c", 3, 3, "-")],
        EXONS,
    )
    got = {r.gene_id: r.length for r in overlap.gene_length(exons, width).collect()}
    assert got == {"g": 36, "h": 1}


def test_genes_without_reads_stay_in_the_matrix(spark):
    exons = spark.createDataFrame([("g", "c", 1, 50, "+"), ("z", "other", 1, 9, "+")], EXONS)
    df = table(spark, (1, "10M"), (300, "10M", {"sample": "t"}))
    got = {(r.gene_id, r.sample): (r["count"], r.length) for r in workflow.quantify(df, exons).collect()}
    assert got == {("g", "s"): (1, 50), ("g", "t"): (0, 50), ("z", "s"): (0, 9), ("z", "t"): (0, 9)}


def test_a_third_of_all_reads_on_one_spot(spark):
    """Copies collapse before the join: the hot placement is one row."""
    df = spark.range(30_000).select(
        F.lit("s").alias("sample"),
        F.col("id").cast("string").alias("read_id"),
        F.lit(0).alias("flag"),
        F.lit("c").alias("chrom"),
        F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") + 1000).cast("long").alias("pos"),
        F.lit("51M").alias("cigar"),
        F.lit(255).alias("mapq"),
        F.lit(1).alias("nh"),
        F.lit(0).alias("nm"),
    )
    exons = spark.createDataFrame([("g", "c", 120, 130, "+")], EXONS)
    assert overlap.placements(df).where("pos = 100").collect()[0].n == 10_000
    counts = overlap.gene_counts(overlap.assigned_counts(df, exons))
    assert [tuple(r) for r in counts.collect()] == [("g", "s", 10_000)]


def test_no_nested_loop_in_the_interval_join(spark, sf_dir):
    placed = overlap.placements(fx.alignments(spark, sf_dir))
    plan = overlap.overlap_join(placed, fx.exons(spark, sf_dir), fx.BIN)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tpm_and_cpm_add_up_to_a_million(spark, sf_dir):
    counts = fx.counts(spark, sf_dir)
    sums = (
        expression.tpm(counts).groupBy("sample").agg(F.sum("tpm").alias("t")).join(
            expression.cpm(counts).groupBy("sample").agg(F.sum("cpm").alias("c")), "sample"
        )
    ).collect()
    assert len(sums) == 3
    for r in sums:
        assert r.t == pytest.approx(1e6) and r.c == pytest.approx(1e6)


def test_mean_counts_a_missing_sample_as_zero(spark):
    rows = [("g", "a", 10, 100), ("g", "b", 30, 100), ("h", "a", 10, 100)]
    counts = spark.createDataFrame(rows, "gene_id string, sample string, count long, length int")
    tpm = expression.tpm(counts, with_samples=True)
    for n in (None, 2):
        got = {r.gene_id: r.mean_tpm for r in expression.mean_tpm(tpm, n).collect()}
        assert got == {"g": pytest.approx(750_000.0), "h": pytest.approx(250_000.0)}
    assert [(r.gene_id, r["rank"]) for r in expression.top_genes(tpm, 1).collect()] == [("g", 1)]
    with pytest.raises(ValueError, match="number of samples"):
        expression.mean_tpm(expression.tpm(counts))


def test_unmapped_reads_without_a_row(spark):
    exons = spark.createDataFrame([("g", "c", 1, 50, "+")], EXONS)
    df = table(spark, (1, "10M"), (1, "10M", {"flag": 4}), (1, "10M", {"flag": 256}))
    reads = spark.createDataFrame([("s",)] * 5, "sample string")
    got = {r.gene_id: r.unstranded for r in overlap.gene_counts_by_strand(reads, df, exons).collect()}
    assert got == {"g": 1, "N_unmapped": 4, "N_multimapping": 0, "N_noFeature": 0, "N_ambiguous": 0}


def scans(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("lineitem.parquet")


def test_alignments_are_read_once(spark, sf_dir, monkeypatch):
    """What is counted at once reads the alignments once, and nothing behind it reads them again."""
    from readloom.plans import workflow

    a, exons = fx.alignments(spark, sf_dir), fx.exons(spark, sf_dir)
    reads = spark.createDataFrame([("A",), ("N",), ("R",)], "sample string")
    cut, real = [], overlap.checkpoint
    monkeypatch.setattr(overlap, "checkpoint", lambda df: cut.append(df) or real(df))
    for make in (
        lambda: overlap.assignment_summary(overlap.assigned_counts(a, exons, width=fx.BIN)),
        lambda: workflow.quantify(a, exons, width=fx.BIN),
        lambda: expression.tpm(workflow.quantify(a, exons, width=fx.BIN)),
        lambda: overlap.gene_counts_by_strand(reads, a, exons, fx.BIN),
    ):
        cut.clear()
        assert scans(make()) == 0
        assert sum(map(scans, cut)) == 1


def test_partitions_follow_the_rows(spark, sf_dir, monkeypatch):
    """Tables of many rows are dealt over more partitions than the session names, with the same rows."""
    from readloom import session

    a, exons = fx.alignments(spark, sf_dir), fx.exons(spark, sf_dir)
    reads = fx.input_reads(spark, sf_dir)

    def rows(df):
        return sorted(map(str, df.collect()))

    makes = (
        lambda: overlap.overlap_join(overlap.placements(a), exons, fx.BIN),
        lambda: overlap.assign_reads(a, exons, width=fx.BIN),
        lambda: overlap.assigned_counts(a, exons, width=fx.BIN),
        lambda: overlap.gene_counts_by_strand(reads, a, exons, fx.BIN),
    )
    few = [rows(make()) for make in makes]
    widths = []
    for name in ("stored", "checkpoint"):
        real = getattr(overlap, name)
        seen = lambda df, *args, real=real: widths.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or real(df, *args)
        monkeypatch.setattr(overlap, name, seen)
    monkeypatch.setattr(session, "TASK_ROWS", 300)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert [rows(make()) for make in makes] == few
    assert len(widths) == 6 and min(widths) > 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sample_rules(spark):
    wide = spark.createDataFrame([("g", 5, 1, 2)], "Geneid string, Length int, `/x/ab_a.bam` int, other int")
    assert expression.rename_columns_by_sample(wide, ["a", "ab"]).columns == ["Geneid", "Length", "ab", "other"]
    with pytest.raises(ValueError, match="none of the samples"):
        expression.select_samples(wide, ["zz"])
    with pytest.raises(ValueError, match="missing"):
        expression.require_columns(wide, ["Geneid", "Chr"])
    long = spark.createDataFrame([("g", "a", 1)], "gene_id string, sample string, count long")
    assert expression.select_samples(long, ["a", "b"]).count() == 1
    with pytest.raises(Exception, match="none of the samples"):
        expression.select_samples(long, ["b"]).count()


def test_cells_that_are_no_numbers_become_zero(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("",)], "v string")
    assert [r.v for r in expression.coerce_numeric(df, ["v"]).collect()] == [1.5, 0.0, 0.0, 0.0]
