import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from cases import AWKWARD, documents, empty

from readloom.llm import byte_bpe
from readloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return byte_bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.rank, special_tokens={}
    )


def encode(vocabulary, text):
    return np.frombuffer(vocabulary.encode(regex.findall(public_tokenizers.PATTERN, text)), "<u4").tolist()


def test_random_texts(vocabulary, reference):
    rng = random.Random(5)
    letters = "abcdefghijklmnop qrstuvwxyz ABC  \n\téß中\U0001f600'1234567890-=_.,;   "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(400)]
    texts += ["a" * 5000, " " * 3000 + "x", "ab" * 2000, "=-" * 700, "\x00\x01" * 50, "the" * 900, "<|endoftext|>"]
    for text in texts:
        ids = encode(vocabulary, text)
        assert ids == reference.encode_ordinary(text)
        assert vocabulary.decode(np.array(ids, "<u4").tobytes()).decode() == text


def test_every_pair_rule_against_merging(vocabulary, reference):
    rng, tokens = random.Random(6), list(vocabulary.token)
    for _ in range(2000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        together = reference._encode_single_piece(vocabulary.token[a] + vocabulary.token[b])
        assert vocabulary.compatible(a, b) == (together == [a, b])


def test_append_and_edit(vocabulary):
    rng = random.Random(7)
    base = b" ".join(rng.choice([b"the", b"quick", b"brown", b"zzz", b"\xff\x00"]) for _ in range(600))
    for _ in range(60):
        table = byte_bpe.PrefixTable(vocabulary, base[:500])
        before = list(table.last)
        table.append(base[500:])
        assert table.last[:500] == before and table.last == byte_bpe.PrefixTable(vocabulary, base).last
        start = rng.randrange(len(base))
        stop = min(len(base), start + rng.randrange(12))
        new = bytes(rng.choice(base) for _ in range(rng.randrange(12)))
        worked = table.replace(start, stop, new)
        assert table.last == byte_bpe.PrefixTable(vocabulary, base[:start] + new + base[stop:]).last
        assert worked <= len(new) + 4 * vocabulary.longest


def test_bounded_memory(ranks, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    small = byte_bpe.Vocabulary(ranks)
    text = "seven different words are here and some more of them again"
    assert encode(small, text) == reference.encode_ordinary(text)
    assert len(small.known) <= 5 and len(small.older) <= 5 and len(small.pairs) <= 15


def test_awkward_rows(spark, ranks, reference):
    docs = documents(spark, n_tokens="mine", other=1)
    found = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    assert found.columns.count("n_tokens") == 1 and "other" in found.columns
    rows = found.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        ids = reference.encode_ordinary(r["text"] or "")
        packed = np.array(ids, "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert bytes(r["ids"]) == packed
    assert byte_bpe.encode_documents(empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


def test_query_against_the_library(spark, sf_dir, reference):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op5_byte_bpe"].run(spark, sf_dir).collect():
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
