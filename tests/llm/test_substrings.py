import random

import pytest
from cases import AWKWARD, documents, empty
from pyspark.sql import functions as F

from readloom.llm.substrings import dedup_substrings, levels


def brute(rows, window):
    """{(doc_id, text): (text left, words removed)}; rows of equal id and text are one document."""
    places = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, text in places:
        words, gone = text.encode().split(), set()
        for p in range(len(words) - window + 1):
            own = tuple(words[p : p + window])
            if own in seen:
                gone |= set(range(p, p + window))
            seen.add(own)
        out[i, text] = (b" ".join(w for p, w in enumerate(words) if p not in gone).decode(), len(gone))
    return out


def check(spark, rows, **lengths):
    found = dedup_substrings(documents(spark, rows), **lengths).collect()
    expected = {k[0]: v for k, v in brute(rows, lengths["window"]).items()}
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in found} == expected


@pytest.mark.parametrize(("window", "base"), [(4, 1), (4, 2), (4, 4), (6, 3), (8, 1), (20, 5)])
def test_against_brute_force(spark, window, base):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(4 * window))) for _ in range(60)]
    pieces = [t.split()[:window] for t in texts]
    texts += [" ".join([*rng.choice(pieces), "x", *rng.choice(pieces), *rng.choice(pieces)]) for _ in range(40)]
    check(spark, [(i, t + rng.choice(["", " ", "\t\n"])) for i, t in enumerate(texts)], window=window, base=base)


def test_passages_and_copies(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage, whole, long = prose(60), prose(150), prose(9000)
    rows = [(i, f"{prose(40)} {passage}\n{prose(30)}") for i in range(20)] + [(100 + i, whole) for i in range(30)]
    rows += [(200, long), (201, f"{prose(5)} {long}"), (202, f"{passage} {passage}"), (203, " ".join(["same"] * 90))]
    check(spark, rows, window=20, base=5)


def test_spans_and_columns(spark):
    words = [f"v{i}" for i in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join(["a", *words[:25], "b", *words[10:]]))]
    found = dedup_substrings(documents(spark, rows, removed="mine", marks=4, row=5, id=6), window=20).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in found] == [0, 45] and found[0]["removed"] == []
    assert [tuple(x) for x in found[1]["removed"]] == [(1, 25), (27, 46)]
    assert found[1]["text"] == "a b" and found[1]["n_words"] == 47 and (found[1]["marks"], found[1]["row"], found[1]["id"]) == (4, 5, 6)


def test_awkward_rows(spark):
    found = dedup_substrings(documents(spark, AWKWARD), window=20).collect()
    assert len(found) == len(AWKWARD)
    left = {r["doc_id"]: r for r in found}
    assert left[2]["text"] is None and left[2]["n_words"] == 0 and left[3]["text"] == "" and left[4]["text"] == ""
    assert left[5]["n_words"] == 40_000 and left[5]["n_removed"] == 0
    assert dedup_substrings(empty(spark)).count() == 0


def test_repeated_ids(spark):
    """Equal rows are one document and cut alike; a null id comes first."""
    text = " ".join(f"t{i}" for i in range(25))
    rows = [(5, text)] * 3 + [(5, f"other {text}"), (None, f"first {text}"), (6, text)]
    found = sorted((r["doc_id"] or 0, r["text"]) for r in dedup_substrings(documents(spark, rows), window=20).collect())
    assert found == [(0, f"first {text}"), (5, ""), (5, ""), (5, ""), (5, "other"), (6, "")]


def test_many_equal_passages(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = documents(spark, [(i, f"start{i} {passage} end{i}") for i in range(3000)])
    assert dedup_substrings(docs, window=20).agg(F.sum("n_removed")).first()[0] == 2999 * 50


def test_texts_are_shuffled_once(spark, tmp_path):
    """The plan has one exchange of the texts, the other two of them are that one again."""
    docs = documents(spark, [(i, f"start{i} " + " ".join(f"p{j + i % 3}" for j in range(40))) for i in range(300)])
    found = dedup_substrings(docs.select("doc_id", "text"), window=20)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1


def test_levels():
    assert levels(5, 20) == [5, 10, 20]
    with pytest.raises(AssertionError):
        levels(3, 20)
