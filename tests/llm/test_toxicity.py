import pytest
from cases import AWKWARD, documents, empty
from pyspark.sql import functions as F

from readloom.llm import toxicity
from readloom.llm.queries import QUERIES

BAD = ["you stupid idiot go away", "what an idiot that is", "pathetic idiot trash", "idiot scum all of them"] * 8
GOOD = ["a pleasant walk in the park", "the report was on time", "bread and butter", "rain fell on the hills"] * 24


@pytest.fixture(scope="module")
def corpus(spark):
    texts = list(enumerate([*BAD, *GOOD]))
    labels = spark.createDataFrame([(i, int(i < len(BAD))) for i, _ in texts], "doc_id long, toxic int")
    return documents(spark, texts), labels


def test_learns_the_words(spark, corpus):
    model = toxicity.fit(*corpus)
    assert model.score({"such", "an", "idiot"}) > 0.3 > model.score({"such", "a", "pleasant", "day"})


def test_neutral_mentions_do_not_move_scores(spark):
    # Every toxic text names a group, no other does: without the penalty the name would carry weight.
    texts = [(i, f"{t} {'muslims' if i < len(BAD) else ''}") for i, t in enumerate([*BAD, *GOOD])]
    labels = spark.createDataFrame([(i, int(i < len(BAD))) for i, _ in texts], "doc_id long, toxic int")
    docs = documents(spark, texts)
    plain = toxicity.fit(docs, labels, settings=toxicity.Settings(fairness=0.0))
    fair = toxicity.fit(docs, labels, settings=toxicity.Settings(fairness=1000.0))

    def moved(model):
        return abs(model.score({"a", "walk", "with", "muslims"}) - model.score({"a", "walk", "with"}))

    assert moved(fair) < 0.02 < moved(plain)
    assert fair.score({"stupid", "idiot"}) > 0.3


def test_counterfactuals_swap_inside_the_group():
    before, after = toxicity.counterfactuals("the muslims met two men", 0)
    assert "muslims" in before and "christians" in after and "women" not in before and "muslims" not in after
    assert toxicity.counterfactuals("no group here", 0) is None


def test_awkward_rows(spark, corpus):
    model = toxicity.fit(*corpus)
    docs = documents(spark, score="mine", toxic=4)
    found = toxicity.score_documents(docs, model)
    assert found.columns.count("score") == 1 and found.count() == len(AWKWARD)
    scores = {(r["doc_id"], r["text"]): r["score"] for r in found.collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert scores[2, None] == scores[3, ""] == scores[4, " \t\n\n "]
    for key, score in scores.items():
        words = set(toxicity.WORD.findall((key[1] or "").lower()))
        assert score == pytest.approx(model.score(words))
    assert toxicity.score_documents(empty(spark), model).count() == 0


def test_without_labels_of_both_kinds(spark, corpus):
    docs, labels = corpus
    none = toxicity.fit(docs, labels.where("false"))
    assert none.score({"idiot"}) < 1e-6
    assert toxicity.fit(docs, labels.where("toxic = 1")).score({"walk"}) > 0.99
    assert toxicity.fit(empty(spark), labels).weights == {}


def test_null_and_double_labels(spark, corpus):
    docs, labels = corpus
    odd = spark.createDataFrame([(None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels.union(odd)).score({"idiot"}) > 0.3


def test_sample_is_bounded(spark, corpus):
    settings = toxicity.Settings(sample=20)
    assert toxicity.labelled(*corpus, "doc_id", "text", "toxic", settings).count() == 20


def test_an_id_in_a_third_of_all_rows_is_one_row(spark, corpus):
    docs, labels = corpus
    many = docs.where("doc_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    settings = toxicity.Settings()
    once = toxicity.labelled(docs, labels, "doc_id", "text", "toxic", settings).count()
    assert toxicity.labelled(docs.unionByName(many), labels, "doc_id", "text", "toxic", settings).count() == once


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op3_toxicity"].run(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    hits = sum(r["predicted"] for r in rows if r["toxic"] == 1)
    wrong = sum(r["predicted"] for r in rows if r["toxic"] == 0)
    assert hits >= 0.9 * sum(r["toxic"] for r in rows)
    assert wrong <= 0.02 * sum(1 - r["toxic"] for r in rows)
