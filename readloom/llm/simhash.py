"""SimHash near-duplicates: BK-trees over fingerprints, components of their links.

Each text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints are dealt
into shards so that two within the radius meet in one shard at least: the bits are cut
into ``blocks``, and every choice of ``blocks - radius`` of them (two differing bits can
spoil two blocks at most) names a shard by its bits. Each shard holds a BK-tree: the
children of a node are keyed by their whole-number Hamming distance to it, and a search
goes down those edges only that are within the radius of its own distance. A shard of
over ``shard_rows`` fingerprints is cut into slices, and every two slices make a tree of
their own, so a tree is bounded whatever the data. Trees reach the tasks by a shuffle,
not by a broadcast from the driver, which would have to hold all fingerprints.
From a task come only the edges of local spanning stars, never all pairs; the components
of these follow by minimum labels with pointer jumping.

Defined results: null and empty texts, and those of white space alone, have fingerprint
zero and are linked as any other; equal ids and repeated rows each keep their row; a null
id is never a component's name unless the component has nothing else; very long texts
are hashed in blocks; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import text_batches
from .common import checkpoint, texts

SEED = 42
HASHES_AT_ONCE = 1 << 15
#: Pairs that a search compares at a time; some ten numbers are held for each.
FRONTIER = 1 << 18
#: Rows of shards that are searched together.
ROWS_AT_ONCE = 1 << 17


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Bits that over half the shingles' hashes have; letters A-Z count as lower case."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(shingle, len(words)) - 1 :]
    first = np.r_[0, ends[:-1] + 1][: len(last)]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(last), HASHES_AT_ONCE):
        cut = slice(at, at + HASHES_AT_ONCE)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[cut].tolist(), last[cut].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > len(last)))


def fingerprints(text: Column, shingle: int = 4) -> Column:
    """The fingerprint as a signed long."""

    def column(values: pa.Array) -> pa.Array:
        found = np.array([fingerprint(x, shingle) for x in texts(values)], np.uint64)
        return pa.array(found.view(np.int64), pa.int64())

    return F.arrow_udf(column, "long")(text)


class Forest:
    """A BK-tree for each shard, as arrays. ``shard`` is sorted; codes differ inside a shard."""

    def __init__(self, shard: np.ndarray, code: np.ndarray):
        self.code = code = code.view(np.uint64)  # bits of a negative number would be counted without its sign
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        sizes = np.diff(np.r_[starts, len(shard)])
        self.root = np.repeat(starts, sizes)
        self.size = np.repeat(sizes, sizes)
        rest = np.flatnonzero(self.root != np.arange(len(code)))
        at = self.root[rest]
        keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(rest):
            key = at * 65 + np.bitwise_count(code[rest] ^ code[at])
            edges, first, of = np.unique(key, return_index=True, return_inverse=True)
            keys.append(edges)
            children.append(rest[first])
            at = rest[first][of]
            onward = at != rest
            rest, at = rest[onward], at[onward]
        self.keys, self.children = np.concatenate(keys), np.concatenate(children)
        order = np.argsort(self.keys)
        self.keys, self.children = self.keys[order], self.children[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) of one shard at ``radius`` or less."""
        at = self.root[queries]
        while len(queries):
            distance = np.bitwise_count(self.code[queries] ^ self.code[at]).astype(np.int64)
            hit = distance <= radius
            yield queries[hit], at[hit]
            low = np.searchsorted(self.keys, at * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.keys, at * 65 + np.minimum(distance + radius, 64), "right")
            many = high - low
            queries = np.repeat(queries, many)
            at = self.children[np.arange(len(queries)) + np.repeat(low - np.cumsum(many) + many, many)]


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest member) after the links a-b."""
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped


def stars(shard: np.ndarray, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, local representative) that connect what is within the radius."""
    order = np.lexsort((code, shard))
    shard, code = shard[order], code[order]
    forest = Forest(shard, code)
    values, slot = np.unique(code, return_inverse=True)
    label = np.arange(len(values))
    queries = np.flatnonzero(forest.size > 1)
    blocks = np.cumsum(forest.size[queries]) // FRONTIER
    for block in np.split(queries, np.flatnonzero(np.diff(blocks)) + 1):
        for a, b in forest.within(block, radius):
            label = joined(label, slot[a], slot[b])
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def shard_columns(code: Column, radius: int, blocks: int) -> Column:
    """All shards of a fingerprint: number of the choice of blocks, and their bits."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    shards = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in chosen)
        bits = code.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))
        shards.append(F.struct(F.lit(number).alias("choice"), bits.alias("bits")))
    return F.explode(F.array(*shards))


def links(codes: DataFrame, radius: int, blocks: int, shard_rows: int) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of column ``code`` that connect all links."""
    dealt = codes.select("code", shard_columns(F.col("code"), radius, blocks).alias("shard")).select(
        "code", "shard.choice", "shard.bits"
    )
    large = dealt.groupBy("choice", "bits").count().where(F.col("count") > shard_rows)
    large = checkpoint(large.withColumn("slices", F.ceil(F.col("count") / shard_rows).cast("int")).drop("count"))
    own = F.pmod(F.xxhash64("code"), F.col("slices")).cast("int")
    every = F.transform(
        F.sequence(F.lit(0), F.col("slices") - 1), lambda i: F.array(F.least(i, F.col("own")), F.greatest(i, F.col("own")))
    )
    if large.isEmpty():
        cut = dealt.withColumn("pair", F.lit(0))
    else:
        # A slice's tree stands for every two slices: (own, i) for all i.
        cut = dealt.join(large, ["choice", "bits"], "left").withColumn("own", F.coalesce(own, F.lit(0)))
        several = F.explode(F.when(F.col("slices").isNull(), F.array(F.array(F.lit(0), F.lit(0)))).otherwise(every))
        cut = cut.withColumn("pair", several).withColumn("pair", F.hash("pair"))
    cut = cut.select(F.xxhash64("choice", "bits", "pair").alias("shard"), "code")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, values, held = [], [], 0

        def found(whole: bool) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
            shard, code = np.concatenate(shards), np.concatenate(values)
            end = len(shard) if whole else int(np.searchsorted(shard, shard[-1]))
            a, b = stars(shard[:end], code[:end], radius) if end else (code[:0], code[:0])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]), shard[end:], code[end:]

        for batch in batches:
            if not batch.num_rows:
                continue
            shards.append(batch.column(0).to_numpy())
            values.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= ROWS_AT_ONCE:
                out, shard, code = found(False)
                yield out
                shards, values, held = [shard], [code], len(shard)
        if held:
            yield found(True)[0]

    dealt_out = cut.repartition("shard").sortWithinPartitions("shard")
    return dealt_out.mapInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) reaches.

    Every round each node takes the smallest label around it, then its label's label.
    Labels only fall, so an unchanged sum means that none has changed.
    """
    both = checkpoint(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), spread=True)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    labels = checkpoint(labels.withColumn("root", F.least("node", "root")), spread=True)
    total = F.sum(F.col("root").cast("decimal(38,0)")).alias("total")
    before = labels.agg(total).first()["total"]
    while before is not None:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("heard"))
        near = labels.join(heard, F.col("node") == F.col("a")).select("node", F.least("root", "heard").alias("root"))
        up = near.select(F.col("node").alias("up"), F.col("root").alias("top"))
        labels = checkpoint(near.join(up, F.col("root") == F.col("up")).select("node", F.col("top").alias("root")), spread=True)
        after = labels.agg(total).first()["total"]
        if after == before:
            break
        before = after
    return labels


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    radius: int = 4,
    blocks: int | None = None,
    shard_rows: int = 8192,
) -> DataFrame:
    """(doc_id, version, code, root, component_id) of every row.

    ``version`` is a hash of the text, ``code`` the signed fingerprint, ``root`` the smallest
    fingerprint of its component, ``component_id`` the smallest id there.
    ``blocks`` is ``radius + 2`` by default; more of them make shards smaller and each
    fingerprint go to more shards, ``comb(blocks, radius)`` of them.
    """
    blocks = blocks or radius + 2
    assert radius < blocks <= 64 and comb(blocks, radius) <= 1000, "too many shards for a fingerprint"
    body = F.col(f"`{text}`")
    prints = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("version"), fingerprints(body, shingle).alias("code")
    )
    with text_batches(docs.sparkSession):
        prints = checkpoint(prints)
    codes = checkpoint(prints.groupBy("code").agg(F.min("doc_id").alias("first_id")), spread=True)
    roots = components(checkpoint(links(codes, radius, blocks, shard_rows)))
    linked = checkpoint(codes.join(roots, F.col("code") == F.col("node")).select("code", "root", "first_id"), spread=True)
    names = checkpoint(linked.groupBy(F.col("root").alias("of")).agg(F.min("first_id").alias("name")), spread=True)
    named = linked.join(names, F.col("root") == F.col("of")).select(F.col("code").alias("linked"), "root", "name")
    mapping = codes.join(named, F.col("code") == F.col("linked"), "left").select(
        F.col("code").alias("own"),
        F.coalesce("root", "code").alias("root"),
        F.coalesce("name", "first_id").alias("component_id"),
    )
    mapping = checkpoint(mapping, spread=True)
    return prints.join(mapping, F.col("code") == F.col("own")).select("doc_id", "version", "code", "root", "component_id")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, one row for each group.

    Ids before null, of equal ids that of the smaller hash of the text; of repeated rows one.
    """
    groups = simhash_groups(docs, doc_id, text, **settings)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "version")).alias("best")
    # Keys without nulls: the join and the removal of repeated rows then need one and the same shuffle. Repeated
    # rows go first, so that of a row in a third of the table each task sends one copy.
    key = ["bare", "id", "version"]
    stay = groups.groupBy("root").agg(best).select("best.bare", F.coalesce("best.doc_id", F.lit(0)).alias("id"), "best.version")
    stay = checkpoint(stay.distinct(), spread=True)
    own = F.col(f"`{doc_id}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        own.isNull().alias("bare"),
        F.coalesce(own, F.lit(0)).alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("version"),
    )
    kept = rows.dropDuplicates(key).join(stay, key, "left_semi")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def hex_code(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")
