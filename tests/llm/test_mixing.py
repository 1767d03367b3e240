from fractions import Fraction

import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from readloom.llm import mixing


def brute_shares(budget, children):
    """{name: (weight, capacity)} to budgets: share by weight, fill those that are full, share what is left again."""
    out, open_ = {}, dict(children)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {n for n, (w, c) in open_.items() if Fraction(budget * w, total) >= c}
        if not full:
            return out | {n: budget * w // total for n, (w, _) in open_.items()}
        # One at a time, the first to fill: the others may get more than they had before.
        first = min(full, key=lambda n: Fraction(open_[n][1], open_[n][0]))
        out[first] = open_[first][1]
        budget -= open_.pop(first)[1]
    return out


def brute_budgets(leaves, weights, budget, epochs):
    weigh = lambda level, name: getattr(weights, level).get(name, weights.other)
    leaves = {k: v for k, v in leaves.items() if all(weigh(level, n) > 0 for level, n in zip(mixing.LEVELS, k))}
    able = lambda prefix: sum(t * epochs for k, t in leaves.items() if k[: len(prefix)] == prefix)
    budgets = {(): min(budget, able(()))}
    for depth, level in enumerate(mixing.LEVELS):
        for above in [k for k in budgets if len(k) == depth]:
            names = {k[depth] for k in leaves if k[:depth] == above}
            children = {n: (weigh(level, n), able((*above, n))) for n in names}
            budgets |= {(*above, n): b for n, b in brute_shares(budgets[above], children).items()}
    return {k: b for k, b in budgets.items() if len(k) == 3}


LEAVES = {
    ("web", "en", "a"): 1000,
    ("web", "en", "b"): 10,
    ("web", "de", "a"): 50,
    ("books", "en", "a"): 30,
    ("books", "fr", "c"): 7,
    ("forum", "", "a"): 400,
}
WEIGHTS = mixing.Weights(domain={"web": 5, "books": 4}, lang={"en": 3, "de": 2}, source={"b": 9})


@pytest.mark.parametrize("budget", [0, 1, 17, 100, 700, 1497, 2000, 9999])
@pytest.mark.parametrize("epochs", [1, 3])
def test_budgets_against_brute_force(spark, budget, epochs):
    leaves = spark.createDataFrame([(*k, v) for k, v in LEAVES.items()], "domain string, lang string, source string, tokens long")
    found = mixing.leaf_budgets(leaves, WEIGHTS, F.lit(budget), epochs).collect()
    expected = brute_budgets(LEAVES, WEIGHTS, budget, epochs)
    assert {tuple(r)[:3]: r["budget"] for r in found} == expected


def test_nodes_without_weight(spark):
    leaves = spark.createDataFrame([(*k, v) for k, v in LEAVES.items()], "domain string, lang string, source string, tokens long")
    weights = mixing.Weights(domain={"web": 1}, lang={"de": 0}, other=1)
    found = mixing.leaf_budgets(leaves, weights, F.lit(500), 1).collect()
    expected = brute_budgets(LEAVES, weights, 500, 1)
    assert {tuple(r)[:3]: r["budget"] for r in found} == expected and all(k[1] != "de" for k in expected)


def made(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7))) for i in range(300)]
    return documents(spark, rows, epoch="mine", n_tokens="mine")


@pytest.mark.parametrize("times", [1, 5])
def test_leaves_spend_their_budget(spark, times):
    docs = made(spark)
    mixed = mixing.mix(docs, WEIGHTS, F.expr(f"supply * {times} div 2"), F.lit("web"), max_epochs=3, seed=1)
    assert mixed.columns.count("epoch") == 1
    rows = mixed.collect()
    leaves, spent = {}, {}
    for r in docs.collect():
        key = ("web", r["lang"] or "", r["source"] or "")
        leaves[key] = leaves.get(key, 0) + len(r["text"].split())
    for r in rows:
        key = ("web", r["lang"] or "", r["source"] or "")
        spent[key] = spent.get(key, 0) + r["tokens_taken"]
        assert 0 < r["tokens_taken"] <= r["n_tokens"] == len(r["text"].split())
    expected = brute_budgets(leaves, WEIGHTS, sum(leaves.values()) * times // 2, 3)
    assert spent == {k: b for k, b in expected.items() if b}
    for key, tokens in leaves.items():
        whole = expected[key] // tokens
        for epoch in range(whole):
            of_epoch = [r["doc_id"] for r in rows if r["epoch"] == epoch and ("web", r["lang"] or "", r["source"] or "") == key]
            assert len(of_epoch) == len(set(of_epoch))
            assert sum(len(" ".join(["w"] * (1 + i % 7)).split()) for i in of_epoch) == tokens


def test_epochs_differ_and_seeds_repeat(spark):
    docs = made(spark)
    pick = lambda seed: {
        r["doc_id"] for r in mixing.mix(docs, WEIGHTS, F.expr("supply div 3"), F.lit("web"), 3, seed).collect()
    }
    assert pick(1) == pick(1) != pick(2)


def test_joined_by_shuffle_alike(spark, monkeypatch):
    docs = made(spark)
    near = sorted(map(tuple, mixing.mix(docs, WEIGHTS, F.expr("supply"), F.lit("x")).select("doc_id", "epoch").collect()))
    monkeypatch.setattr(mixing, "FEW_LEAVES", 0)
    far = sorted(map(tuple, mixing.mix(docs, WEIGHTS, F.expr("supply"), F.lit("x")).select("doc_id", "epoch").collect()))
    assert near == far


def test_awkward_rows(spark):
    docs = documents(spark, domain="mine")
    mixed = mixing.mix(docs, WEIGHTS, F.expr("supply"), F.lit(None).cast("string"), max_epochs=1)
    rows = mixed.collect()
    assert sum(r["tokens_taken"] for r in rows) == sum(r["n_tokens"] for r in rows)
    assert {r["domain"] for r in rows} == {""}
    taken = [r["doc_id"] for r in rows]
    assert 2 not in taken and 3 not in taken and 4 not in taken and None in taken and taken.count(7) == 2
    assert mixing.mix(empty(spark), WEIGHTS, F.expr("supply"), F.lit("x")).count() == 0
    assert mixing.mix(docs, WEIGHTS, F.lit(0), F.lit("x")).count() == 0


def test_tokens_beyond_a_long(spark):
    """Capacities of 10 ** 17 tokens times weights don't overflow."""
    leaves = spark.createDataFrame(
        [("web", "en", f"s{i}", 10**17 // (i + 1)) for i in range(20)], "domain string, lang string, source string, tokens long"
    )
    weights = mixing.Weights(source={f"s{i}": 1000 + i for i in range(20)})
    rows = mixing.leaf_budgets(leaves, weights, F.expr("supply"), 4).collect()
    supply = sum(10**17 // (i + 1) for i in range(20))
    assert supply - 40 <= sum(r["budget"] for r in rows) <= supply
    assert all(0 < r["budget"] <= 4 * r["tokens"] for r in rows)


def test_rows_of_one_id_lie_apart(spark):
    """Different texts of one id have orders of their own."""
    docs = documents(spark, [(5, f"text {i}") for i in range(200)])
    order = docs.select(mixing.seeded(1, F.lit(0), F.col("doc_id"), F.md5(F.col("text").cast("binary"))).substr(1, 3)).distinct().count()
    assert order > 150
    mixed = mixing.mix(docs, WEIGHTS, F.expr("supply div 2"), F.lit("x"), 1)
    assert mixed.agg(F.sum("tokens_taken")).first()[0] == pytest.approx(200, abs=8)


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(made(spark), WEIGHTS, F.expr("supply"), F.lit("x"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
