"""Queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    chat,
    licenses,
    line_windows,
    merkle,
    mixing,
    one_bit,
    simhash,
    sql,
    substrings,
    suffix_repeats,
    toxicity,
    trie,
    warc,
)
from .common import table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = Query(run, sql)
        return run

    return add


@query("op1_suffix_repeats")
def _(spark, sf):
    judged = suffix_repeats.suffix_repeats(table(spark, sf, "documents", "doc_id", "text"))
    return judged.drop("text")


@query("op2_simhash")
def _(spark, sf):
    groups = simhash.simhash_groups(table(spark, sf, "documents", "doc_id", "text"), shingle=4, radius=4)
    return groups.select("doc_id", simhash.hex_code(F.col("code")).alias("fingerprint"), "component_id")


@query("op3_toxicity")
def _(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    labels = table(spark, sf, "labels", "doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op4_one_bit")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    return one_bit.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


@query("op5_byte_bpe")
def _(spark, sf):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf, "documents", "doc_id", "text")
    return byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep_text=False, keep_ids=False)


@query("op6_chat", sql.CHAT)
def _(spark, sf):
    turns = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], turns.schema
    )
    return chat.read_back(chat.format_turns(turns.unionByName(marked)))


#: What the mixing query aims at: books and forums are rarer than the web, the largest source counts little.
WEIGHTS = mixing.Weights(
    domain={"web": 5, "forum": 3, "books": 2}, lang={"en": 6, "de": 2, "fr": 2, "es": 1}, source={"src0": 1}, other=2
)


def domain() -> Column:
    """Web, forum or books, by the number in a source's name."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    return F.element_at(F.array(F.lit("web"), F.lit("forum"), F.lit("books")), F.coalesce(number.try_cast("int"), F.lit(0)) % 3 + 1)


@query("op7_mixing", sql.MIXING)
def _(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, WEIGHTS, F.expr("supply * 6 div 5"), domain(), max_epochs=4, seed=7)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "tokens_taken")


@query("op8_licenses")
def _(spark, sf):
    scanned = licenses.scan_documents(table(spark, sf, "documents", "doc_id", "text"))
    return scanned.select("doc_id", F.posexplode("licenses").alias("match", "found")).select("doc_id", "match", "found.*")


@query("op9_warc", sql.WARC)
def _(spark, sf):
    archives = warc.write_pages(table(spark, sf, "pages", "page_id", "url", "html"))
    rows = warc.read_archives(archives)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_line_windows", sql.LINES)
def _(spark, sf):
    cut = line_windows.dedup_lines(table(spark, sf, "documents", "doc_id", "text"))
    return cut.select("doc_id", "text", "n_lines", "n_removed")


@query("op11_merkle", sql.MERKLE)
def _(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "source", "lang", "n_chars", "text")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    whole = merkle.leaf_of([*others, F.col("text")])
    claimed = F.when(hit, merkle.leaf_of([*others, lower])).otherwise(whole)
    built = merkle.manifest(docs, [*others, F.col("text")], claimed=claimed)
    rows = merkle.verified(built, "claimed")
    return rows.select(
        F.col("id").alias("doc_id"),
        merkle.text_of(F.col("digest")).alias("leaf"),
        merkle.text_of(F.col("subroot")).alias("subroot"),
        merkle.text_of(F.col("root")).alias("root"),
        F.sha2(merkle.text_of(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        merkle.text_of(F.col("folded")).alias("folded_root"),
        "verified",
    )


@query("op12_prefix_trie", sql.TRIE)
def _(spark, sf):
    turns = trie.digested(table(spark, sf, "conversations", "conv_id", "turn", "role", "text"), "conv_id", "turn", "role", "text")
    lender = F.expr("conv - conv % 20")
    rows, convs = trie.rebuilt(turns, lender, F.crc32(F.col("conv").cast("string")) % 4, most=3)
    return trie.prefix_trie(rows, convs)


@query("op13_substrings", sql.SUBSTRINGS)
def _(spark, sf):
    cut = substrings.dedup_substrings(table(spark, sf, "documents", "doc_id", "text"), window=20, base=5)
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cut.select(
        "doc_id", F.col("n_words").cast("long"), F.col("n_removed").cast("long"), kept.alias("kept_sha256")
    )
