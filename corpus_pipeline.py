"""Corpus pipeline: documents through five operators in turn.

Each stage takes (spark, docs, sf_dir) and returns a data frame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import byte_bpe, line_windows, mixing, simhash, toxicity
from readloom.llm.common import table
from readloom.llm.queries import domain
from readloom.session import scratch_dir, stored, text_batches

#: Domains and languages have weights; no source counts more than another.
WEIGHTS = mixing.Weights(
    domain={"web": 5, "forum": 3, "books": 2}, lang={"en": 6, "de": 2, "fr": 2, "es": 1}, other=2
)


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.3; the classifier learns from the labels that aren't held out."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return toxicity.score_documents(docs, model, into="_score").where("_score < 0.3").drop("_score")


def repeated_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of earlier three-line windows; those that lose all words go."""
    cut = line_windows.dedup_lines(docs).where("n_removed = 0 or text rlike '[^ \\\\t-\\\\r]'")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each_group(docs, shingle=4, radius=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights have them read: 1.2 times all tokens, four epochs at most.

    Of the last document of a leaf, which counts in part, only the words that count are left,
    joined by blanks.
    """
    rows = mixing.mix(docs, WEIGHTS, F.expr("supply * 6 div 5"), domain(), max_epochs=4, seed=7)
    part = F.col("tokens_taken") < F.col("n_tokens")
    words = F.regexp_extract_all("text", F.lit(r"[^ \t-\r]+"), F.lit(0))
    text = F.when(part, F.array_join(F.slice(words, F.lit(1), F.col("tokens_taken").cast("int")), " ")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    rows = rows.withColumn("n_chars", F.when(part, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and digests of them and of what they decode to.

    Computed at once, in small batches and with half the matches remembered: the executors still hold
    what the stages before took.
    """
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    with text_batches(spark):
        rows = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep_text=False, remembered=60_000)
        return stored(rows, "corpus-ids")


STAGES = [
    ("toxicity", toxic_documents_out),
    ("line_dedup", repeated_lines_out),
    ("simhash", near_copies_out),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: The classifier's scores, the fingerprints and the encoding can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
