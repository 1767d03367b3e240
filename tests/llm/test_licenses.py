import random

import pytest
from cases import AWKWARD, documents, empty

from readloom.llm import licenses

MIT = " ".join(licenses.TEMPLATES[2][1].split())


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


@pytest.mark.parametrize("number", range(len(licenses.TEMPLATES)))
def test_every_template_is_found_where_it_stands(scanner, number):
    name, text = licenses.TEMPLATES[number]
    text = " ".join(text.split())
    found = scanner.scan(f"Some words of ours before it.\n{text}\nand some of the words after.")
    assert [(m[0], m[1]) for m in found] == [(name, 1.0)]
    assert found[0][3:] == (30, 30 + len(text))


def test_changed_words_and_gaps(scanner):
    words = MIT.split()
    rng = random.Random(1)
    for place in rng.sample(range(len(words)), 8):
        words[place] = "changed"
    del words[40:44]
    words[60:60] = ["three", "new", "words"]
    found = scanner.scan("x " * 50 + " ".join(words))
    assert [m[0] for m in found] == ["MIT"] and 0.8 < found[0][1] < 1


def test_two_licences_and_one_twice(scanner):
    text = "Released under the MIT License. " + "word " * 80 + "Licensed under CC BY-NC 4.0. " + "word " * 80
    assert [m[0] for m in scanner.scan(text + "Released under the MIT License.")] == ["MIT", "CC-BY-NC-4.0", "MIT"]


def test_common_words_are_no_licence(scanner):
    assert scanner.scan("the rights to use a copy of the file, and to permit all of it to any person " * 30) == []
    assert scanner.scan("The terms of the License") == []


def test_long_text(scanner):
    text = "filler " * 200_000 + MIT
    (match,) = scanner.scan(text)
    assert text[match[3] : match[4]] == MIT


def test_winnowing_keeps_a_fingerprint_in_every_stretch(scanner):
    s = scanner.settings
    for number, codes in enumerate(scanner.templates):
        places = {p for hits in scanner.index.values() for n, p in hits if n == number}
        for start in range(len(codes) - (s.gram + s.window - 1) + 1):
            assert places & set(range(start, start + s.window))


def brute_align(scanner, codes, number):
    """Unbanded local alignment: matched words of the best one."""
    template = scanner.templates[number]
    cells = [[(0, 0)] * (len(codes) + 1) for _ in range(len(template) + 1)]
    best = (0, 0)
    for i, word in enumerate(template, 1):
        for j, other in enumerate(codes, 1):
            score, many = cells[i - 1][j - 1]
            step = (score + 2, many + 1) if word == other else (score - 1, many)
            down, left = cells[i - 1][j], cells[i][j - 1]
            cell = max(step, (down[0] - 1, down[1]), (left[0] - 1, left[1]), (0, 0))
            cells[i][j] = cell
            best = max(best, cell)
    return best[1]


def test_banded_alignment_against_the_whole_table(scanner):
    rng = random.Random(2)
    for _ in range(10):
        words = MIT.split()[:60]
        for place in rng.sample(range(60), 5):
            words[place] = "other"
        text = [scanner.code(w) for w in ["pad"] * 20 + words + ["pad"] * 20]
        import numpy as np

        codes = np.array(text)
        hits = [c for c in scanner.candidates(codes) if c[0] == 2]
        assert max(scanner.align(codes, *c)[0] for c in hits) == brute_align(scanner, text, 2)


def brute_matches(scanner, codes):
    """Matched words of unbanded alignments of the one template: the best one, then those before and after it."""
    template, wide = scanner.templates[0], len(codes) + len(scanner.templates[0])
    if len(codes) < scanner.settings.least_coverage * len(template):
        return []
    many, begin, end = scanner.align(codes, 0, -wide, wide)
    assert many == brute_align(scanner, codes.tolist(), 0)
    if not many:
        return []
    own = [many] if many >= scanner.settings.least_coverage * len(template) else []
    return brute_matches(scanner, codes[:begin]) + own + brute_matches(scanner, codes[end:])


@pytest.mark.parametrize("number", [0, 3, 5, 10, 13])
def test_statements_close_to_each_other(scanner, number):
    name, text = licenses.TEMPLATES[number]
    for gap in (0, 1, 4, 7, 13):
        found = scanner.scan((text + " and" * gap + "\n") * 60)
        assert [(m[0], m[1]) for m in found] == [(name, 1.0)] * 60


def test_matches_against_unbanded_alignments():
    import numpy as np

    rng = random.Random(3)
    words = [f"w{i}" for i in range(16)]
    scanner = licenses.Scanner([("own", " ".join(words))])
    for _ in range(8):
        text = []
        for _ in range(rng.randint(1, 7)):
            cut = rng.randint(0, 3)
            text += words[cut:] if rng.random() < 0.5 else words[: len(words) - cut]
            text += ["pad"] * rng.randint(0, 9)
        codes = np.array([scanner.code(w) for w in text])
        assert [m[2] for m in scanner.scan(" ".join(text))] == brute_matches(scanner, codes)


@pytest.mark.parametrize(
    "text",
    [
        "Licensed under CC BY-XY 4.0.",
        "Licensed under CC BY 5.0.",
        "This work is licensed under the GNU General Public License, version 1.",
        "This work is licensed under the GNU Other General Public License, version 3.",
        "Licensed under the Apache License, Version 1.1.",
        "Released under the Other License.",
        licenses.GNU_NOTICE.format(what="program", kind="General", version="1"),
        licenses.GNU_NOTICE.format(what="program", kind="Other General", version="3"),
        licenses.GNU_TITLE.format(kind="General", version="1", date="February 1989 Copyright (C) 1989"),
        licenses.TEMPLATES[4][1].replace("Apache License, Version 2.0", "Educational Community License, Version 2.0"),
        licenses.TEMPLATES[7][1] + " Neither the name of us may be used in any way.",
        " ".join(licenses.TEMPLATES[8][1].split()).replace(
            "and this permission notice appear in all copies",
            "appear in all copies and that both that copyright notice and this permission notice appear in supporting text",
        ),
        MIT.replace("The above", "The Software shall be used for Good, not Evil. The above"),
    ],
)
def test_an_unlisted_sibling_takes_no_name(scanner, text):
    assert scanner.scan(f"Some words before. {text} And some words after.") == []


@pytest.mark.parametrize("number", [n for n, (_, text) in enumerate(licenses.TEMPLATES) if len(text.split()) > 20])
def test_a_damaged_text_takes_no_siblings_name(scanner, number):
    name, text = licenses.TEMPLATES[number]
    rng = random.Random(number)
    for _ in range(2):
        words = text.split()
        for place in rng.sample(range(len(words)), 3):
            words[place] = "changed"
        assert {m[0] for m in scanner.scan(" ".join(words))} <= {name}


def test_every_match_comes_from_an_alignment(scanner, monkeypatch):
    """Without alignments nothing is found, however literally a template stands there."""
    text = "\n".join(" ".join(x.split()) for _, x in licenses.TEMPLATES)
    assert len(scanner.scan(text)) > 60
    aligned, real = [], licenses.Scanner.align
    monkeypatch.setattr(licenses.Scanner, "align", lambda *a: aligned.append(a[2]) or real(*a))
    short = [n for n, (_, x) in enumerate(licenses.TEMPLATES) if len(x.split()) <= 15]
    assert all([m[0] for m in scanner.scan(licenses.TEMPLATES[n][1])] == [licenses.TEMPLATES[n][0]] for n in short)
    assert set(short) <= set(aligned)
    monkeypatch.setattr(licenses.Scanner, "align", lambda *a: (0, 0, 0))
    assert scanner.scan(text) == []


def test_a_short_statement_with_a_word_more_or_less(scanner):
    assert scanner.scan("Released under the MIT License.") != []
    for text in ("Released under the new MIT License.", "Released under MIT License.", "Released under the MIT and License."):
        assert scanner.scan(f"Words before. {text} Words after.") == []


def test_marks_between_words_are_passed_over(scanner):
    text = "# Licensed under the Apache License ,\n# Version 2.0 ."
    (match,) = scanner.scan(text)
    assert match[:3] == ("Apache-2.0", 1.0, 7) and text[match[3] : match[4]] == text[2:-2]


def test_awkward_rows(spark):
    docs = documents(spark, licenses="mine", other=2)
    found = licenses.scan_documents(docs)
    assert found.columns.count("licenses") == 1 and found.count() == len(AWKWARD)
    assert all(r["licenses"] == [] for r in found.collect())
    assert licenses.scan_documents(empty(spark)).count() == 0


def test_query_finds_the_stated_licences(spark):
    from readloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stated = {"MIT": "Released under the MIT License.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    stated |= {"GPL-3.0": "licensed under the GNU General Public License, version 3."}
    stated |= {"Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    expected = {(r["doc_id"], n) for r in docs.collect() for n, s in stated.items() if s in (r["text"] or "")}
    rows = QUERIES["op8_licenses"].run(spark, sf).collect()
    assert {(r["doc_id"], r["license"]) for r in rows} == expected
