"""Frequent k-mers by summaries against a full count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from readloom.operators import frequent


def brute(rows, k, top):
    out = set()
    for sample in {s for s, _ in rows}:
        counts = Counter(seq[i : i + k] for s, seq in rows if s == sample and seq for i in range(len(seq) - k + 1))
        ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:top]
        out |= {(sample, kmer, n, i + 1) for i, (kmer, n) in enumerate(ranked)}
    return out


def made(rng, n, motifs, length=40):
    out = []
    for _ in range(n):
        seq = "".join(rng.choice("ACGT") for _ in range(length))
        if rng.random() < 0.5:
            at = rng.randrange(length - 12)
            seq = seq[:at] + rng.choice(motifs) + seq[at + 12 :]
        out.append(seq)
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "sample string, seq string").repartition(5)


@pytest.mark.parametrize("size", [3, 64, 100_000])
def test_against_full_count(spark, size):
    rng = random.Random(size)
    motifs = ["".join(rng.choice("ACGT") for _ in range(12)) for _ in range(4)]
    rows = [("a", s) for s in made(rng, 600, motifs)] + [("b", s) for s in made(rng, 300, motifs[:1] * 3)]
    rows += [(None, "ACGTNNACGTACGTAC"), ("short", "ACG"), ("null", None), ("odd", "ACGTXACGTACGTTTT"), ("lower", "acgtacgtacgt")]
    df = table(spark, rows)
    for top in (1, 5):
        got = {tuple(r) for r in frequent.frequent_kmers(df, 8, top, size=size, most=50).collect()}
        assert got == brute(rows, 8, top)


def test_what_is_decided(spark):
    rng = random.Random(1)
    motif = "ACCTGATTGCAA"
    rows = [("hot", s) for s in made(rng, 2000, [motif])]
    rows += [("flat", "".join(rng.choice("ACGT") for _ in range(40))) for _ in range(2000)]
    rows += [("few", "ACGTACGTTTGA")] * 3
    found = frequent.candidates(table(spark, rows), 10, 3, size=200, most=100)
    assert found["flat"] is None
    assert {motif[i : i + 10] for i in range(3)} <= {text(x, 10) for x in found["hot"]} and len(found["hot"]) <= 100
    assert {text(x, 10) for x in found["few"]} == {"ACGTACGTTT", "CGTACGTTTG", "GTACGTTTGA"}


def text(kmer, k):
    return "".join(frequent.LETTERS[kmer // 5**j % 5] for j in reversed(range(k)))


def test_only_candidates_are_shuffled(spark):
    rng = random.Random(2)
    rows = [("hot", s) for s in made(rng, 3000, ["ACCTGATTGCAA"])]
    df = table(spark, rows)
    found = frequent.candidates(df, 10, 3, size=500, most=100)
    exact = df.select("sample", "seq").mapInArrow(frequent.summarise(10, 500, found), "sample string, kmer long, n long")
    assert exact.select("kmer").distinct().count() == len(found["hot"]) < 100
    assert frequent.all_kmers(df, 10).count() > 50_000


def test_long_kmers_and_empty(spark):
    rows = [("a", "ACGT" * 12), ("a", "ACGT" * 10)]
    got = {tuple(r) for r in frequent.frequent_kmers(table(spark, rows), 30, 2).collect()}
    assert got == brute(rows, 30, 2)
    assert frequent.frequent_kmers(table(spark, rows).where(F.lit(False)), 10, 2).count() == 0
