import random

from cases import AWKWARD, documents, empty
from pyspark.sql import functions as F

from readloom.llm.line_windows import dedup_lines


def brute(rows, window=3):
    """{(doc_id, text): text left}: windows by place; rows of equal id and text are one place."""
    places = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, out = set(), {}
    for i, text in places:
        lines, gone = text.split("\n"), set()
        for p in range(len(lines) - window + 1):
            own = tuple(lines[p : p + window])
            if any(x.strip(" \t\r\v\f") for x in own):
                if own in seen:
                    gone |= set(range(p, p + window))
                seen.add(own)
        out[i, text] = "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", " ", ""]) for _ in range(rng.randrange(14)))) for i in range(80)]
    found = {(r["doc_id"], i): r["text"] for r in dedup_lines(documents(spark, rows)).collect() for i in [r["doc_id"]]}
    assert {k[0]: v for k, v in found.items()} == {i: t for (i, _), t in brute(rows).items()}


def test_passage_across_documents(spark):
    passage = "\n".join(f"line {i} of the passage" for i in range(6))
    rows = [(1, f"own 1\n{passage}\nend 1"), (2, f"{passage}"), (3, f"a\nb\n{passage}\nc"), (4, "own 1\nb\nend")]
    left = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(documents(spark, rows)).collect()}
    assert left == {1: (rows[0][1], 8, 0), 2: ("", 6, 6), 3: ("a\nb\nc", 9, 6), 4: (rows[3][1], 3, 0)}


def test_awkward_rows(spark):
    docs = documents(spark, n_lines="mine", later=3, h1=4)
    found = dedup_lines(docs)
    assert found.columns.count("n_lines") == 1 and {"later", "h1"} <= set(found.columns)
    rows = found.collect()
    assert len(rows) == len(AWKWARD)
    left = {(r["doc_id"]): r["text"] for r in rows}
    assert left[2] is None and left[3] == "" and left[4] == " \t\n\n " and left[8] == "one\ntwo\nthree\nfour"
    assert left[1] == left[7] == "plain words of a short text"
    assert dedup_lines(empty(spark)).count() == 0


def test_repeated_rows_are_one_document(spark):
    rows = [(5, "a\nb\nc\na\nb\nc")] * 2 + [(5, "x\na\nb\nc"), (None, "q\nr\ns"), (6, "q\nr\ns")]
    left = sorted((r["doc_id"] or 0, r["text"]) for r in dedup_lines(documents(spark, rows)).collect())
    assert left.count((5, "a\nb\nc")) + left.count((5, "")) >= 1
    assert (0, "q\nr\ns") in left and (6, "") in left
    again = sorted((r["doc_id"] or 0, r["text"]) for r in dedup_lines(documents(spark, rows[::-1])).collect())
    assert again == left


def test_many_equal_windows(spark):
    rows = [(i, f"start {i}\nx\ny\nz\nend {i}") for i in range(500)]
    found = dedup_lines(documents(spark, rows)).agg(F.sum("n_removed")).first()[0]
    assert found == 499 * 3
