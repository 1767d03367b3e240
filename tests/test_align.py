"""Hand cases for CIGARs, junctions and flag counts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from readloom.functions import cigar as cg
from readloom.operators import align

SCHEMA = "sample string, read_id string, flag int, chrom string, pos long, cigar string, mapq int, nh int, nm int"


def table(spark, *rows):
    """Rows of (pos, cigar) with optional keyword changes."""
    data = []
    for i, row in enumerate(rows):
        pos, cigar, changes = (*row, {})[:3]
        base = {"sample": "s", "read_id": f"r{i}", "flag": 0, "chrom": "c", "mapq": 255, "nh": 1, "nm": 0}
        base.update(changes)
        data.append((base["sample"], base["read_id"], base["flag"], base["chrom"], pos, cigar, base["mapq"], base["nh"], base["nm"]))
    return spark.createDataFrame(data, SCHEMA)


def ids(df):
    return sorted(r.read_id for r in df.collect())


@pytest.mark.parametrize(
    "cigar,blocks,end,query",
    [
        ("51M", [(100, 150, 51)], 150, 51),
        ("30M150N21M", [(100, 129, 30), (280, 300, 21)], 300, 51),
        ("5S46M", [(100, 145, 46)], 145, 51),
        ("20M2I29M", [(100, 148, 49)], 148, 51),
        ("25M3D26M", [(100, 153, 51)], 153, 51),
        ("3H2S10=5X10N4D6M2S", [(100, 114, 15), (125, 134, 6)], 134, 25),
        ("*", [], 99, 0),
    ],
)
def test_blocks(spark, cigar, blocks, end, query):
    row = table(spark, (100, cigar)).select(
        cg.blocks("pos", "cigar").alias("b"), cg.ref_end("pos", "cigar").alias("e"), cg.query_length("cigar").alias("q")
    )
    r = row.first()
    assert ([tuple(x) for x in r.b], r.e, r.q) == (blocks, end, query)


def test_junctions_count_unique_and_multi(spark):
    df = table(
        spark,
        (100, "10M20N5M"),
        (95, "15M20N5M30N5M"),
        (100, "10M20N5M", {"nh": 2}),
        (100, "10M20N5M", {"flag": 4}),
    )
    got = {(r.i_start, r.i_end): (r.n_unique, r.n_multi) for r in align.junctions(df).collect()}
    assert got == {(110, 129): (2, 1), (135, 164): (1, 0)}


def test_intron_limits(spark):
    df = table(spark, (1, "9M19N9M"), (1, "9M20N9M"), (1, "9M1000000N9M"), (1, "9M1000001N9M"), (1, "9M"))
    assert ids(align.intron_length_filter(df)) == ["r1", "r2", "r4"]


def test_overhang(spark):
    exons = spark.createDataFrame(
        [("t", "c", 1, 100), ("t", "c", 151, 200), ("t", "c", 301, 400)],
        "transcript_id string, chrom string, start_pos long, end_pos long",
    )
    known = align.annotated_junctions(exons)
    assert sorted((r.i_start, r.i_end) for r in known.collect()) == [(101, 150), (201, 300)]
    df = table(
        spark,
        (98, "3M50N40M"),  # known intron, 3 bases
        (97, "3M50N40M"),  # not annotated, 3 bases
        (93, "8M51N40M"),  # not annotated, 8 bases
        (94, "7M51N40M"),
        (100, "7M"),
        (97, "3M50N40M", {"flag": 4}),
    )
    assert ids(align.overhang_filter(df, known)) == ["r0", "r2", "r4", "r5"]


@pytest.mark.parametrize("width", [7, 64, 65_536])
def test_annotated_junctions_do_not_depend_on_the_bins(spark, sf_dir, width):
    from readloom.catalog import fixtures as fx

    exons = fx.exons(spark, sf_dir)
    a = align.annotated_junctions(exons, "gene_id", width)
    b = align.annotated_junctions(exons, "gene_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_multimap_cap(spark):
    df = table(spark, (1, "5M", {"nh": 20}), (1, "5M", {"nh": 21, "flag": 16}), (1, "5M", {"nh": None, "flag": 4}), (1, "5M", {"nh": None}))
    rows = {r.read_id: r for r in align.multimap_cap(df).collect()}
    assert {k: (r.flag, r.pos, r.cigar) for k, r in rows.items()} == {
        "r0": (0, 1, "5M"),
        "r1": (20, None, "*"),
        "r2": (4, 1, "5M"),
        "r3": (0, 1, "5M"),
    }


def test_mismatch_share(spark):
    df = table(spark, (1, "50M", {"nm": 2}), (1, "49M", {"nm": 2}), (1, "5S45M", {"nm": 2}))
    assert ids(align.mismatch_filter(df)) == ["r0", "r2"]
    untagged = table(spark, (1, "5M", {"nm": None}), (0, "*", {"nm": None, "flag": 4}))
    assert ids(align.mismatch_filter(untagged)) == ["r0", "r1"]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_placement_with_most_rows_is_split(spark, small_thresholds):
    from readloom.operators import overlap

    hot = F.col("id") % 5 != 0
    df = spark.range(0, 60_000, numPartitions=8).select(
        F.lit("s").alias("sample"),
        F.md5(F.col("id").cast("string")).alias("read_id"),
        F.lit(0).alias("flag"),
        F.lit("c").alias("chrom"),
        F.when(hot, 100).otherwise(F.col("id") + 1000).cast("long").alias("pos"),
        F.when(hot, "30M150N21M").otherwise("7M90N44M").alias("cigar"),
        F.lit(255).alias("mapq"),
        F.lit(1).alias("nh"),
        F.lit(0).alias("nm"),
    )
    known = spark.createDataFrame([("c", 1, 2)], "chrom string, i_start long, i_end long")
    kept = align.overhang_filter(df, known)
    assert "LeftAnti" in (plan := executed(kept)) and "skew=true" in plan
    assert kept.count() == 48_000
    exons = spark.createDataFrame([("g", "c", 1, 200, "+")], "gene_id string, chrom string, start_pos long, end_pos long, strand string")
    assigned = overlap.assign_reads(df, exons)
    assert "skew=true" in executed(assigned)
    assert assigned.where("gene_id = 'g'").count() == 48_000


def contigs(spark, seq, chunk):
    rows = [("c", i // chunk, i, seq[i : i + chunk]) for i in range(0, len(seq), chunk)]
    return spark.createDataFrame(rows, "chrom string, chunk_no int, offset long, seq string")


@pytest.mark.parametrize("chunk", [3, 5, 100])
def test_motifs_across_chunks(spark, chunk):
    #      1234567890123456789012345678
    seq = "AAAAGTCCCCAGAAAACTCCACAAAATT"
    df = table(
        spark,
        (1, "4M8N4M"),  # GT..AG
        (13, "4M6N4M"),  # CT..AC
        (1, "4M7N4M"),  # GT..CA: no known motif
        (1, "4M8N4M6N4M"),  # both strands
        (20, "4M"),
        (20, "4M8N40M"),  # runs past the contig
    )
    ref = contigs(spark, seq, chunk)
    strands = {(r.pos, r.cigar): r.strand for r in align.strand_from_intron(df, ref, chunk).collect()}
    assert strands == {
        (1, "4M8N4M"): "+",
        (13, "4M6N4M"): "-",
        (1, "4M7N4M"): ".",
        (1, "4M8N4M6N4M"): ".",
        (20, "4M8N40M"): ".",
    }
    assert ids(align.noncanonical_filter(df, ref, chunk)) == ["r0", "r1", "r3", "r4"]


def test_coordinate_sort_is_global(spark, sf_dir):
    from readloom.catalog import fixtures as fx

    a = fx.alignments(spark, sf_dir)
    placed = a.unionByName(a.limit(3).withColumn("chrom", F.lit(None).cast("string")))
    out = align.coordinate_sort(placed, fx.dictionary(spark, sf_dir), 5).select("ordinal", "pos").collect()
    keys = [tuple(r) for r in out]
    assert keys == sorted(keys)
    assert sum(1 for k in keys if k[0] == 2**62) == 3


def test_flagstat_pass_and_fail(spark):
    df = table(
        spark,
        (1, "5M"),
        (1, "5M", {"flag": 256}),
        (1, "5M", {"flag": 2048}),
        (1, "5M", {"flag": 4}),
        (1, "5M", {"flag": 512 | 1024}),
        (1, "5M", {"flag": 1 | 2}),
        (1, "5M", {"flag": 1 | 8}),
    )
    got = {r.metric: (r.passed, r.failed) for r in align.flagstat(df).collect()}
    assert got == {
        "total": (6, 1),
        "primary": (4, 1),
        "secondary": (1, 0),
        "supplementary": (1, 0),
        "duplicates": (0, 1),
        "mapped": (5, 1),
        "primary mapped": (3, 1),
        "paired in sequencing": (2, 0),
        "properly paired": (1, 0),
        "singletons": (1, 0),
    }


def test_chrm_warning(spark):
    df = table(
        spark,
        *[(1, "5M", {"sample": "a", "chrom": "chrM" if i < 2 else "c"}) for i in range(10)],
        *[(1, "5M", {"sample": "b", "chrom": "chrM" if i < 3 else "c"}) for i in range(10)],
        (1, "5M", {"sample": "n", "flag": 4, "chrom": "chrM"}),
    )
    got = {r.sample: (r.chrm_pct, r.warn) for r in align.chrm_fraction(df).collect()}
    assert got == {"a": (20.0, False), "b": (30.0, True), "n": (None, False)}


def test_idxstats_keeps_empty_contigs_and_unplaced_rows(spark):
    df = table(spark, (1, "5M"), (0, "*", {"flag": 4, "chrom": None}), (1, "5M", {"flag": 4}))
    dictionary = spark.createDataFrame([("c", 10), ("d", 20)], "chrom string, length int")
    got = {r.chrom: (r.length, r.mapped, r.unmapped) for r in align.idxstats(df, dictionary).collect()}
    assert got == {"c": (10, 1, 1), "d": (20, 0, 0), "*": (0, 0, 1)}


def test_rates_count_reads_not_rows(spark):
    df = table(
        spark,
        (1, "5M", {"read_id": "a"}),
        (1, "5M", {"read_id": "b", "nh": 2}),
        (9, "5M", {"read_id": "b", "nh": 2, "flag": 256}),
        (9, "5M", {"read_id": "c", "nh": 21}),
    )
    only = spark.createDataFrame([("s", x) for x in "wxyz"], "sample string, read_id string")
    one = align.alignment_rates(only, table(spark, (1, "5M", {"read_id": "x", "nh": None}))).first()
    assert (one.n_unique, one.pct_unmapped) == (1, 75.0)
    reads = spark.createDataFrame([("s", x) for x in "abcd"], "sample string, read_id string")
    r = align.alignment_rates(reads, df).first()
    assert (r.n_reads, r.n_unique, r.n_multi, r.n_unmapped, r.pct_unmapped) == (4, 1, 1, 2, 50.0)


@pytest.mark.parametrize(
    ("cigar", "md", "sites"),
    [
        ("10M", "10", []),
        ("10M", "0A9", [(100, "A")]),
        ("10M", "3C0T5", [(103, "C"), (104, "T")]),
        ("5S10M2H", "9G", [(109, "G")]),
        ("4M2I6M", "4A5", [(104, "A")]),
        ("4M3D6M", "4^ACG0T5", [(107, "T")]),
        ("4M3D6M", "1c2^ACG6", [(101, "C")]),
        ("4M100N6M", "3A0C5", [(103, "A"), (204, "C")]),
        ("2M50N3M1D3M60N4M", "1A3^T3C3", [(101, "A"), (219, "C")]),
    ],
)
def test_mismatch_positions(spark, cigar, md, sites):
    from readloom.functions.md import mismatch_positions, mismatches

    df = spark.createDataFrame([(100, cigar, md)], "pos long, cigar string, md string")
    assert sorted((r["ref_pos"], r["base"]) for r in mismatch_positions(df).collect()) == sites
    assert df.select(mismatches("md")).first()[0] == len(sites)


def sites_by_hand(pos, cigar, md):
    """Token by token and base by base."""
    covered, at = [], pos
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or ""):
        if pos is not None and op in "MD=XN":
            covered += [] if op == "N" else range(at, at + int(n))
            at += int(n)
    found, off = [], 0
    for token in re.findall(r"\d+|\^[A-Za-z]+|[A-Za-z]", md or ""):
        if token.isalpha():
            found.append((covered[off] if off < len(covered) else None, token.upper()))
        off += int(token) if token.isdigit() else len(token.lstrip("^"))
    return found


def test_mismatch_positions_of_many_rows_without_lambdas(spark):
    """All rows of a batch are read together, whatever their strings; no function runs token by token."""
    from readloom.functions.md import mismatch_positions

    rng = random.Random(5)
    rows = [(100, None, "3A2"), (None, "6M", "3A2"), (7, "6M", None), (7, "6M", ""), (7, "*", "A"), (7, "3M", "2A9C"), (1, "9M9", "^A^0G-1c")]
    for _ in range(500):
        cigar = "".join(f"{rng.randint(0, 12)}{rng.choice('MMMIDNSHP=X')}" for _ in range(rng.randint(1, 6)))
        md = "".join(rng.choice(["0", "3", "12", "A", "c", "^AC", "^G"]) for _ in range(rng.randint(1, 8)))
        rows.append((rng.randint(1, 10**9), cigar, md))
    rows = [(i, *row) for i, row in enumerate(rows)]
    found = mismatch_positions(spark.createDataFrame(rows, "id long, pos long, cigar string, md string").coalesce(1))
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append((r["ref_pos"], r["base"]))
    for i, pos, cigar, md in rows:
        assert sorted(got.get(i, []), key=str) == sorted(sites_by_hand(pos, cigar, md), key=str), (pos, cigar, md)
    assert "lambdafunction" not in found._jdf.queryExecution().toString()


def test_nm_and_md_decide_differently(spark):
    """Two inserted bases and one mismatch: three by NM, one by MD."""
    rows = [("a", "24M2I24M", 3, "20A27"), ("b", "50M", 3, "1A1A1A44"), ("c", "50M", 3, None), ("d", "50M", None, None), ("e", "*", 9, "")]
    df = spark.createDataFrame(rows, "read_id string, cigar string, nm int, md string")
    assert [r["read_id"] for r in align.mismatch_filter(df).collect()] == ["d"]
    assert [r["read_id"] for r in align.exact_mismatch_filter(df).orderBy("read_id").collect()] == ["a", "d", "e"]
