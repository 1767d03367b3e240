import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from readloom import session
from readloom.llm import byte_bpe, mixing, simhash, toxicity
from readloom.llm.queries import domain
from test_line_windows import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "byte_bpe"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipe") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_columns_and_kept_rows(steps):
    for _, after in steps[:-1]:
        assert after.columns == COLUMNS
    for before, after in steps[:3]:
        assert 0.8 * before.count() <= after.count() <= before.count()
        assert after.select("doc_id").distinct().count() == after.count()


def test_line_stage_keeps_every_line_somewhere(steps):
    before, after = steps[1]
    lines = F.explode(F.split("text", "\n")).alias("line")
    had = {r[0] for r in before.select(lines).collect()}
    assert had == {r[0] for r in after.select(lines).collect()}
    assert after.where("n_chars <> length(text)").count() == 0


def test_toxicity_stage_drops_what_the_model_rejects(spark, sf_dir, steps):
    before, after = steps[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = toxicity.fit(before, labels)
    kept = {
        r["doc_id"] for r in before.collect() if model.score(set(toxicity.WORD.findall((r["text"] or "").lower()))) < 0.3
    }
    assert kept == {r["doc_id"] for r in after.collect()}


def test_line_stage_against_brute_force(steps):
    before, after = steps[1]
    left = brute_lines([(r["doc_id"], r["text"]) for r in before.collect()])
    left = {i: t for (i, own), t in left.items() if t.split() or t == own}
    assert left == {r["doc_id"]: r["text"] for r in after.collect() if r["text"] is not None}


def test_simhash_stage_against_brute_force(steps):
    before, after = steps[2]
    codes = {r["doc_id"]: brute_fingerprint(r["text"]) for r in before.collect()}
    label = brute_components(sorted(set(codes.values())))
    smallest = {}
    for i, c in codes.items():
        smallest[label[c]] = min(i, smallest.get(label[c], i))
    assert sorted(smallest.values()) == sorted(r["doc_id"] for r in after.collect())


def test_mixing_stage_takes_prefixes(steps):
    """Every leaf gives its share of whole documents and one beginning, in the words that count."""
    before, after = steps[3]
    own = {r["doc_id"]: r["text"] for r in before.collect()}
    mixed = mixing.mix(before, corpus_pipeline.WEIGHTS, F.expr("supply * 6 div 5"), domain(), max_epochs=4, seed=7)
    expected, parts = [], 0
    for r in mixed.collect():
        words = re.findall(r"[^ \t-\r]+", own[r["doc_id"]])
        part = r["tokens_taken"] < len(words)
        parts += part
        expected.append((r["doc_id"], " ".join(words[: r["tokens_taken"]]) if part else own[r["doc_id"]]))
    assert parts > 0
    rows = after.collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted(expected)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    tokens = lambda texts: sum(len(re.findall(r"[^ \t-\r]+", t)) for t in texts)
    supply = tokens(own.values())
    assert tokens(r["text"] for r in rows) == pytest.approx(1.2 * supply, rel=0.01)


def test_last_stage(spark, steps):
    docs, coded = steps[-1]
    ranks = byte_bpe.Vocabulary(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))).rank
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def digest(text):
        return hashlib.sha256(np.array(library.encode_ordinary(text), "<u4").tobytes()).hexdigest()

    # A document may be there several times, and once more in part.
    expected = sorted((r["doc_id"], digest(r["text"])) for r in docs.collect())
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in coded.collect()) == expected


def test_run_gives_the_same(spark, sf_dir, steps):
    columns = ["doc_id", "n_tokens", "ids_sha256"]
    ran = corpus_pipeline.run(spark, sf_dir).select(*columns)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, steps[-1][1].select(*columns).collect()))


def test_last_stage_takes_small_batches(spark, sf_dir, monkeypatch):
    """No Arrow batch of texts is of the session's 10,000 rows, and the setting is as before."""
    seen, encode = spark.sparkContext.accumulator(0), byte_bpe.encode_documents
    key, most = "spark.sql.execution.arrow.maxRecordsPerBatch", session.TEXT_ROWS

    def large(batches):
        for batch in batches:
            seen.add(int(batch.num_rows > most))
            yield batch

    def watched(docs, *args, **settings):
        return encode(docs.mapInArrow(large, docs.schema), *args, **settings)

    monkeypatch.setattr(byte_bpe, "encode_documents", watched)
    docs = spark.range(3 * most).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).coalesce(1)
    before = spark.conf.get(key)
    assert dict(corpus_pipeline.STAGES)["byte_bpe"](spark, docs, sf_dir).count() == 3 * most
    assert seen.value == 0 and spark.conf.get(key) == before


def test_line_stage_cuts_once(spark, sf_dir):
    """One Python worker for each task: the filter on what the cut gives does not compute it again."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, "a\nb\nc\nd", "en", "s", 7) for i in range(3)], kinds)
    left = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, sf_dir)
    assert left._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in left.collect()] == [(0, "a\nb\nc\nd", "en", "s", 7)]


@pytest.mark.parametrize("stage", ["fingerprints", "labelled texts"])
def test_eager_steps_take_small_batches(spark, stage):
    """What reads whole texts at once gets no Arrow batch of the session's 10,000 rows; the setting is as before."""
    seen = spark.sparkContext.accumulator(0)
    key, most = "spark.sql.execution.arrow.maxRecordsPerBatch", session.TEXT_ROWS

    def large(batches):
        for batch in batches:
            seen.add(int(batch.num_rows > most))
            yield batch

    docs = spark.range(3 * most).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).coalesce(1)
    docs, before = docs.mapInArrow(large, docs.schema), spark.conf.get(key)
    if stage == "fingerprints":
        assert simhash.simhash_groups(docs).count() == 3 * most
    else:
        toxicity.fit(docs, spark.range(20).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic")))
    assert seen.value == 0 and spark.conf.get(key) == before


@pytest.mark.parametrize("stage", range(5))
def test_empty_input(spark, sf_dir, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    assert corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir).count() == 0
