import random

import numpy as np
import pytest
import xxhash
from cases import AWKWARD, documents, empty

from readloom.llm import simhash


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, radius=4):
    label = {c: c for c in codes}
    changed = True
    while changed:
        changed = False
        for a in codes:
            for b in codes:
                if (a ^ b).bit_count() <= radius and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("text", ["", " \n", "one", "One tWo three", "Ä Ö ü a B c d e f", " ".join(map(str, range(99)))])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(1000))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def planted_codes(rng, centres=12, copies=15, flips=3):
    codes = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(copies):
            code = centre
            for bit in rng.sample(range(64), rng.randrange(flips + 1)):
                code ^= 1 << bit
            codes.add(code)
    return sorted(codes)


def test_tree_finds_every_pair():
    rng = random.Random(1)
    codes = np.array(planted_codes(rng), np.uint64)
    forest = simhash.Forest(np.zeros(len(codes), np.int64), codes.view(np.int64))
    pairs = set()
    for a, b in forest.within(np.arange(len(codes)), 4):
        pairs |= set(zip(a.tolist(), b.tolist()))
    distance = np.bitwise_count(codes[:, None] ^ codes[None, :])
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(distance <= 4))))


@pytest.mark.parametrize("shard_rows", [8192, 5])
def test_links_connect_what_brute_force_connects(spark, shard_rows):
    codes = planted_codes(random.Random(2))
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    edges = simhash.links(spark.createDataFrame([(c,) for c in signed], "code long"), 4, 6, shard_rows)
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    expected = brute_components(codes)
    groups = {}
    for code, own in zip(codes, signed):
        groups.setdefault(expected[code], set()).add(own)
    ours = {}
    for own in signed:
        ours.setdefault(found.get(own, own), set()).add(own)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(41)}


def test_awkward_rows(spark):
    docs = documents(spark, code="mine", root=3)
    groups = simhash.simhash_groups(docs).collect()
    assert len(groups) == len(AWKWARD)
    by_code = {}
    for r in groups:
        by_code.setdefault(r["code"], set()).add(r["component_id"])
    assert all(len(x) == 1 for x in by_code.values())
    empties = {r["component_id"] for r in groups if r["code"] == 0}
    assert empties == {2}
    assert {r["component_id"] for r in groups if r["doc_id"] == 7} == {1}
    assert [r["component_id"] for r in groups if r["doc_id"] is None] == [None]
    assert simhash.simhash_groups(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = documents(spark, code="mine")
    left = simhash.one_of_each_group(docs)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "2", "5", "None", "8", "9"])


def test_a_row_that_stands_often_is_one_row_for_each_task(spark):
    """Repeated rows go before the shuffle, not in the one task that they would meet in."""
    rows = [(1, "a text that stands in a third of all rows")] * 2000 + [(i, f"other text number {i} here") for i in range(2, 40)]
    left = simhash.one_of_each_group(documents(spark, rows).repartition(4), radius=1)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate(") + plan.count("Aggregate ") >= 2
    found = left.collect()
    assert sum(r["doc_id"] == 1 for r in found) == 1 and len(found) <= 39


def test_query_against_brute_force(spark, sf_dir):
    from readloom.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    codes = {i: brute_fingerprint(t) for i, t in texts.items()}
    label = brute_components(sorted(set(codes.values())))
    smallest = {}
    for i, c in codes.items():
        smallest[label[c]] = min(i, smallest.get(label[c], i))
    found = QUERIES["op2_simhash"].run(spark, sf_dir).collect()
    assert {tuple(r) for r in found} == {(i, f"{c:016x}", smallest[label[c]]) for i, c in codes.items()}
