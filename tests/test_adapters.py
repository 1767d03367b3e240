"""Adapters with mismatches, in part, and without a list of candidates."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.functions.adapters import adapter_start, allowed_mismatches
from readloom.operators import discovery, trim

ADAPTER = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"


def brute(seq, adapter, min_overlap, bases_for_one):
    for p in range(len(seq) - min_overlap + 1):
        k = min(len(adapter), len(seq) - p)
        if sum(a != b for a, b in zip(seq[p:], adapter)) <= allowed_mismatches(k, bases_for_one):
            return p
    return len(seq)


def noisy(rng, text, rate):
    return "".join(rng.choice("ACGTN") if rng.random() < rate else c for c in text)


@pytest.mark.parametrize(
    ("adapter", "min_overlap", "bases_for_one"),
    [(ADAPTER, 6, 8), (ADAPTER, 1, 100), (ADAPTER, 33, 5), ("ACGT", 2, 2), (ADAPTER * 3, 10, 8), ("A" * 70, 4, 10)],
)
def test_against_brute_force(spark, adapter, min_overlap, bases_for_one):
    rng = random.Random(len(adapter) + min_overlap)
    seqs = [None, "", "A", "ACGTACGT"]
    for _ in range(400):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 3, 20, 45, 60, 64, 100, 190])))
        body = insert + noisy(rng, adapter, rng.choice([0, 0.02, 0.1, 0.2])) + "".join(rng.choice("ACGT") for _ in range(rng.randrange(40)))
        seqs.append(body[: rng.choice([51, 63, 64, 65, 128, 150, 300])])
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string")
    got = {r["i"]: r["k"] for r in df.select("i", adapter_start(adapter, min_overlap, bases_for_one)("s").alias("k")).collect()}
    assert got == {i: None if s is None else brute(s, adapter, min_overlap, bases_for_one) for i, s in enumerate(seqs)}


def test_settings():
    assert [allowed_mismatches(k, 8) for k in (7, 8, 33, 200)] == [0, 1, 4, 6]
    with pytest.raises(ValueError):
        adapter_start("ACGT", 5)


def reads(spark, seqs, sample="s"):
    rows = [(f"r{i:05d}", sample, s, "I" * len(s)) for i, s in enumerate(seqs)]
    return spark.createDataFrame(rows, "read_id string, sample string, seq string, qual string")


def test_trimming_cuts_qualities_too(spark):
    df = reads(spark, ["TTTT" + ADAPTER, "TTTT" + ADAPTER[:7], "TTTT" + ADAPTER[:5], "GG" + ADAPTER[:4] + "T" + ADAPTER[5:]])
    out = trim.trim_adapter_or_part(df, ADAPTER).orderBy("read_id").collect()
    assert [r["seq"] for r in out] == ["TTTT", "TTTT", "TTTT" + ADAPTER[:5], "GG"]
    assert [len(r["qual"]) for r in out] == [4, 4, 9, 2]


def test_chain_with_parts(spark):
    insert = "ACGTTGCATGCCATTGACCATGCTAGCATTCAGGATCCATA"
    df = reads(spark, [insert + ADAPTER[:10], insert + "TTACCTGATG"])
    found = {r["read_id"]: r["seq"] for r in trim.trim_chain(df, ADAPTER, min_overlap=6).collect()}
    assert found == {"r00000": insert, "r00001": insert + "TTACCTGATG"}
    assert trim.trim_chain(df, ADAPTER).where(F.col("seq") == insert).count() == 0


def sequenced(rng, n, adapter, length=60, share=0.3):
    out = []
    for _ in range(n):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.randrange(15, 50) if rng.random() < share else length))
        tail = "".join(rng.choice("ACGT") for _ in range(length))
        out.append((insert + noisy(rng, adapter, 0.01) + tail)[:length])
    return out


def test_found_without_a_list(spark):
    rng = random.Random(8)
    other = "CTGTCTCTTATACACATCTCCGAGCC"
    copied = "".join(rng.choice("ACGT") for _ in range(60))
    parts = [
        reads(spark, sequenced(rng, 3000, ADAPTER), "one"),
        reads(spark, sequenced(rng, 3000, other), "two"),
        reads(spark, ["".join(rng.choice("ACGT") for _ in range(60)) for _ in range(3000)], "clean"),
        # A read that stands often is no adapter: it always stands at the same place.
        reads(spark, sequenced(rng, 2000, ADAPTER) + [copied] * 3000, "copies"),
        reads(spark, ["ACGT" * 15, "", "ACG"], "few"),
    ]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    found = {r["sample"]: (r["adapter"], r["n_reads"]) for r in discovery.found_adapters(df).collect()}
    assert {k: v[0] for k, v in found.items()} == {"one": ADAPTER, "two": other, "copies": ADAPTER}
    assert all(n > 300 for _, n in found.values())
    assert discovery.found_adapters(df.where("false")).count() == 0


def test_null_reads_and_samples(spark):
    rows = [("r1", None, "ACGT" * 10, "I" * 40), ("r2", "s", None, None)]
    df = spark.createDataFrame(rows, "read_id string, sample string, seq string, qual string")
    assert discovery.found_adapters(df).count() == 0


def test_reads_are_searched_for_the_seed_once(spark):
    """What counts and grows the texts around a seed starts from a stored table of them."""
    df = reads(spark, sequenced(random.Random(3), 2000, ADAPTER), "one")
    found = discovery.found_adapters(df)
    assert [r["adapter"] for r in found.collect()] == [ADAPTER]
    assert "Contains(" not in found._jdf.queryExecution().optimizedPlan().toString()
