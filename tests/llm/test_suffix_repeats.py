import random
import re

import numpy as np
import pytest
from cases import AWKWARD, documents, empty, rows

from readloom.llm.suffix_repeats import Limits, deepest_intervals, repeat_spans, sorted_together, suffix_repeats


def brute_depth(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            n = 0
            while i != j and max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            best = max(best, n)
        out.append(best)
    return out


def test_depths_against_brute_force():
    rng = random.Random(0)
    for _ in range(150):
        many = [[bytes([97 + rng.randrange(3)]) for _ in range(rng.randrange(1, 30))] for _ in range(3)]
        for words, depth in zip(many, sorted_together(many)):
            assert depth.tolist() == brute_depth(words)


def test_single_symbol():
    assert deepest_intervals(np.array([0])).tolist() == [0]


def brute(text, limits=Limits()):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    depth = brute_depth(words) if n < 400 else None
    failed = n < 50 or 100 * len(inside) > 50 * n
    covered = {i + k for i, d in enumerate(depth or []) if d >= limits.min_words for k in range(d)}
    chars = sum(len(words[i]) for i in covered)
    longest = max([d for d in depth or [] if d >= limits.min_words], default=0)
    total = sum(map(len, words))
    kept = not failed and chars <= limits.max_covered * total and longest <= limits.max_longest
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return n, total, symbols, len(lines) - len(set(lines)), len(inside), longest, chars, failed, kept


COLUMNS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words longest_repeat covered_chars base_failed kept".split()
)


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for i in range(60):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 120))]
        if i % 3 == 0 and base:
            base += base[: rng.randrange(len(base))]
        if i % 4 == 0:
            base = [w + rng.choice(["", "\n", "#|", "é"]) for w in base]
        texts.append((i, " ".join(base)))
    found = suffix_repeats(documents(spark, texts)).select("doc_id", *COLUMNS).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {i: brute(t) for i, t in texts}


def test_awkward_rows_and_clashing_columns(spark):
    docs = documents(spark, kept="mine", n_words=-1, other=5)
    found = suffix_repeats(docs)
    assert found.columns.count("kept") == found.columns.count("n_words") == 1 and "other" in found.columns
    got = {(r["doc_id"], r["text"]): tuple(r[c] for c in COLUMNS) for r in found.collect()}
    for key in AWKWARD:
        if len(key[1] or "") < 1000:
            assert got[key] == brute(key[1])
    assert got[AWKWARD[4]][:2] == (40_000, sum(map(len, AWKWARD[4][1].split()))) and got[AWKWARD[4]][-1]
    assert found.count() == len(AWKWARD)
    assert suffix_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize(("copies", "kept"), [(1, True), (3, False)])
def test_repeated_passage(spark, copies, kept):
    passage = " ".join(f"p{i}" for i in range(40))
    text = " ".join([*(f"u{i}" for i in range(120)), *[passage] * copies])
    assert suffix_repeats(documents(spark, [(1, text)])).first()["kept"] is kept


def test_spans_of_maximal_repeats():
    text = "a b c d e x a b c d e y b c d"
    assert repeat_spans(text, 3) == [(0, 5), (6, 5), (12, 3)]
    assert repeat_spans(None) == [] == repeat_spans("")
