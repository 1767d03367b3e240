"""Hand cases at the limits of the trimming and filtering rules."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.operators import trim


def q(*scores):
    return "".join(chr(s + 33) for s in scores)


def reads(spark, *rows):
    data = [(f"r{i}", "s", seq, qual) for i, (seq, qual) in enumerate(rows)]
    return spark.createDataFrame(data, "read_id string, sample string, seq string, qual string")


def column(df, name="seq"):
    return [r[name] for r in df.orderBy("read_id").collect()]


def test_window_mean_of_exactly_20_is_kept(spark):
    df = reads(spark, ("ACGTAC", q(40, 20, 20, 20, 20, 20)), ("ACGTAC", q(40, 20, 20, 20, 19, 40)))
    assert column(trim.cut_right(df)) == ["ACGTAC", "A"]


def test_cut_right_edges(spark):
    df = reads(
        spark,
        ("ACG", q(2, 2, 2)),  # shorter than the window
        ("", ""),
        ("ACGT", q(2, 2, 2, 2)),  # first window is bad
        ("ACGTACGT", q(40, 40, 40, 40, 2, 2, 2, 40)),
        ("ACGT", q(40, 40, 40, 40)),  # a bad window must not span two reads
        ("ACGT", q(2, 40, 40, 40)),
        (None, None),
    )
    out = column(trim.cut_right(df))
    assert out == ["ACG", "", "", "ACG", "ACGT", "ACGT", None]


@pytest.mark.parametrize("window,mean", [(4, 20), (3, 25), (1, 10)])
def test_cut_right_against_brute_force(spark, window, mean):
    rng = random.Random(7)
    rows = []
    for _ in range(300):
        n = rng.randrange(0, 60)
        rows.append(("".join(rng.choice("ACGT") for _ in range(n)), q(*[rng.choice([2, 15, 20, 27, 37]) for _ in range(n)])))

    def expected(seq, qual):
        for i in range(len(qual) - window + 1):
            if sum(ord(c) - 33 for c in qual[i : i + window]) < mean * window:
                return seq[:i]
        return seq

    got = {r.read_id: r.seq for r in trim.cut_right(reads(spark, *rows), window, mean).collect()}
    assert got == {f"r{i}": expected(*row) for i, row in enumerate(rows)}


def test_poly_g(spark):
    df = reads(spark, ("ACGT" + "G" * 9, "I" * 13), ("ACT" + "G" * 10, "I" * 13), ("G" * 12, "I" * 12))
    out = trim.trim_poly_g(df)
    assert column(out) == ["ACGTGGGGGGGGG", "ACT", ""]
    assert [len(x) for x in column(out, "qual")] == [13, 3, 0]


def test_adapter(spark):
    a = trim.UNIVERSAL_ADAPTER
    df = reads(spark, ("TT" + a + "CC", "I" * 16), (a[:-1], "I" * 11), (a, "I" * 12))
    assert column(trim.trim_adapter(df)) == ["TT", a[:-1], ""]


def test_adapter_cut_short_by_an_earlier_step_is_not_found(spark):
    a = trim.UNIVERSAL_ADAPTER
    # Quality drops inside the adapter, so the 12-mer is gone before adapter trimming.
    seq = "ACGT" * 10 + a
    qual = "I" * 46 + "#" * 6
    out = trim.trim_chain(reads(spark, (seq, qual))).collect()[0]
    assert out.seq == seq[:44] or a not in out.seq
    assert len(out.seq) >= 40


def test_quality_share_of_exactly_30_percent_is_kept(spark):
    df = reads(spark, ("A" * 10, q(*[19] * 3, *[20] * 7)), ("A" * 10, q(*[19] * 4, *[20] * 6)))
    assert column(trim.low_quality_filter(df), "read_id") == ["r0"]


def test_n_limit(spark):
    df = reads(spark, ("N" * 5 + "A", "I" * 6), ("N" * 6, "I" * 6))
    assert column(trim.n_filter(df), "read_id") == ["r0"]


def test_length_limit(spark):
    df = reads(spark, ("A" * 36, "I" * 36), ("A" * 35, "I" * 35))
    assert column(trim.length_filter(df), "read_id") == ["r0"]


def test_first_failing_filter_is_the_reason(spark):
    df = reads(
        spark,
        ("N" * 6 + "A" * 20, "5" * 26),  # too many N and too short
        ("A" * 20, "I" * 20),
        ("AC" * 20, "I" * 40),
        ("AC" * 20, "I" * 30 + "1" + "I" * 9),
    )
    chain = trim.trim_chain(df)
    assert column(chain, "reason") == ["too_many_N", "too_short", "passed", "passed"]
    counts = {r.reason: r.n_reads for r in trim.filter_reasons(chain).collect()}
    assert counts == {"passed": 2, "too_many_N": 1, "low_quality": 0, "too_short": 1}


def test_chain_equals_its_steps(spark, sf_dir):
    from readloom.catalog import fixtures as fx

    raw = fx.reads(spark, sf_dir)
    steps = trim.trim_adapter(trim.trim_poly_g(trim.cut_right(raw)))
    chain = trim.trim_chain(raw).select(*raw.columns)
    assert steps.exceptAll(chain).count() == 0
    assert chain.exceptAll(steps).count() == 0


def test_before_is_passed_plus_failed(spark, sf_dir):
    from readloom.catalog import fixtures as fx

    raw = fx.reads(spark, sf_dir)
    chain = trim.trim_chain(raw)
    assert trim.filter_reasons(chain).agg(F.sum("n_reads")).first()[0] == raw.count()
    assert chain.where(F.length("seq") > F.length("raw_seq")).count() == 0


def test_detected_adapter(spark):
    df = reads(spark, ("AAAACTGTCTCTTATACC", "I" * 18), ("CTGTCTCTTATA", "I" * 12), ("GGGGGGGGGGGG", "I" * 12))
    names = {"PolyG": "G" * 12, "Nextera": "CTGTCTCTTATA"}
    found = trim.detect_adapter(df, names)
    assert [tuple(r) for r in found.collect()] == [("s", "Nextera", "CTGTCTCTTATA", 2)]
    assert column(trim.trim_chain(df, detected=found)) == ["AAAA", "", ""]
    none = trim.detect_adapter(df.limit(0), names)
    assert column(trim.trim_adapter(df, F.lit(None).cast("string"))) == column(df)
    assert none.count() == 0


def test_kmers_against_brute_force(spark, sf_dir):
    from collections import Counter

    from readloom.catalog import fixtures as fx

    rows = fx.reads(spark, sf_dir).where(F.col("sample") == "src1").collect()
    counts = Counter(r.seq[i : i + 12] for r in rows for i in range(len(r.seq) - 11))
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:5]
    got = trim.overrepresented_kmers(fx.reads(spark, sf_dir), 12, 5).where(F.col("sample") == "src1")
    assert [(r.kmer, r.n) for r in got.orderBy("rank").collect()] == best
