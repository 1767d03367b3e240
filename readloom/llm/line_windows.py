"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a text are a window, named by 128 bits of hashes. A
window found twice or more anywhere is kept at its first place, by document id and line;
the lines that its later occurrences cover go, overlapping ones merged. A line goes only
if the same line stands at an earlier place, and following that back ends at a kept one:
so of every passage one copy stays, whole or as parts of earlier passages.

Only hashes are shuffled for the search; windows that occur once are dropped before their
places are looked up again. A window in a third of all documents is pre-counted on the
map side, and its places are joined to a table of repeated windows that adaptive
execution may split.

Defined results: a null text has no lines and stays null; a text of under ``window``
lines has no window and stays as it is; a window without any word counts for nothing;
rows with equal id and equal text are one document at one place, and each such row is
cut alike; rows with equal ids and different texts are ordered by hash of the text; a null
id comes first; an empty table gives none. Other columns pass through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, checkpoint


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, version, pos, h1, h2) of every window; ``docs`` has doc_id, version and text."""
    lines = lines_of(F.col("text"))
    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(0), F.size(lines) - window))
    hashed = F.transform(
        lines,
        lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), (F.trim(x, F.lit(WHITE)) != "").alias("word")
        ),
    )
    rows = docs.where(F.col("text").contains("\n")).select("doc_id", "version", starts.alias("starts"), hashed.alias("hashed"))
    rows = rows.select("doc_id", "version", "hashed", F.explode("starts").alias("pos"))
    at = [F.get("hashed", F.col("pos") + i) for i in range(window)]
    return rows.where(reduce(or_, [x["word"] for x in at])).select(
        "doc_id",
        "version",
        "pos",
        F.xxhash64(*[x["a"] for x in at]).alias("h1"),
        F.xxhash64(*[x["b"] for x in at]).alias("h2"),
    )


def without(window: int):
    """Arrow function of a text and the starts of windows that go: the text left, and the number of lines gone.

    Declared non-deterministic, which it is not: Spark would else compute it once more for a filter on its results,
    with a second Python worker in each task.
    """

    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        left, gone = [], []
        for text, own in zip(texts, starts):
            if text.as_py() is None or own.as_py() is None:
                left.append(None)
                gone.append(0)
                continue
            lines = text.as_py().split("\n")
            covered = {p + i for p in own.as_py() for i in range(window)}
            left.append("\n".join(x for i, x in enumerate(lines) if i not in covered))
            gone.append(len(covered))
        return pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(gone, pa.int32())], ["text", "gone"])

    return F.arrow_udf(cut, "text string, gone int").asNondeterministic()


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with the text cut, and columns n_lines, n_removed (removed lines)."""
    own, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    short = docs.select(own.alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("text"))
    found = checkpoint(occurrences(short, window))
    place = F.struct("doc_id", "version", "pos")
    repeated = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = repeated.where(~F.col("first").eqNullSafe(F.col("last")))
    repeated = checkpoint(repeated.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first"), spread=True)
    later = found.join(repeated, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    later = later.where(~place.eqNullSafe(F.col("first")))
    gone = later.groupBy(F.col("doc_id").alias("of_id"), F.col("version").alias("of_version")).agg(
        F.collect_set("pos").alias("later")
    )
    gone = checkpoint(gone, spread=True)
    names = ("n_lines", "n_removed")
    others = [c for c in docs.columns if c not in names]
    rest = F.struct(*[F.col(f"`{c}`") for c in others if c != text])
    rows = docs.select(rest.alias("row"), own.alias("id"), body.alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    met = rows.join(gone, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version")), "left")
    met = met.withColumn("cut", without(window)(F.when(F.col("later").isNotNull(), F.col("text")), F.col("later")))
    left = F.coalesce(F.col("cut.text"), F.col("text"))
    return met.select(
        *[left.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in others],
        F.coalesce(F.size(lines_of(F.col("text"))), F.lit(0)).alias("n_lines"),
        F.col("cut.gone").alias("n_removed"),
    )
