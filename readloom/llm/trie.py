"""Prefix trie of conversations by fixed-length block hashing.

A node of the trie is a distinct sequence of first turns (role and text). Conversations are
cut into blocks of ``block`` turns, each with a digest, and grouped by what stands before a block
and by the block: conversations that share all blocks so far are one group, and their
next blocks either are all alike or part. Where they are alike, the block's turns are a chain of
nodes with the same members, taken from any one of them, without grouping by turn. Only
where blocks of a group differ are their members grouped turn by turn, to find the
boundary where they part. After that a conversation mostly goes on alone, in whole blocks.

Digests of sequences are exclusive ors of hashes of (position, turn), two of 64 bits, so that what
stands before every block follows from running sums over ranges of blocks: no round for each
depth, and no task for a whole long conversation.

Sums over subtrees don't walk the trie either. Every node is owned by its smallest member.
What a conversation owns is the end of its path, so the subtree of a node holds all
that its members own, but for what the node's owner owns above it. Two sums over members, one
of the saved tokens and one of owned leaves, give both.

Defined results: null roles and texts are empty; a null turn number comes first, equal ones in the
order of role and text, so repeated rows are turns of their own; a null conversation id is one
conversation, which names a node only if no other does and is written as nothing among the ends; an empty
table has no nodes, not even a root. Only the ids of conversations that end at one and the same node
are hashed in one task, as a stream of sorted rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint
from .places import placed

BLOCK = 4
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "d1", "d2"]


def digested(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, t1, t2, words) of each turn, in the order of its conversation; texts stay behind."""
    who, what = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        who.alias("role"),
        what.alias("text"),
        F.xxhash64(who, what).alias("t1"),
        F.xxhash64(F.lit(7), who, what).alias("t2"),
        F.regexp_count(what, F.lit(WORDS)).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    return placed(rows, ["conv"], order, drop=("turn", "role", "text"))


def rebuilt(rows: DataFrame, lender: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another, and all their ids.

    ``lender`` names the other conversation and ``borrowed``, ``most`` at the highest, the
    number of turns; both are made of ``conv``. A conversation's own first turns, so many, give
    way, whether or not the lender has as many. Returns (conv, at, t1, t2, words) and (conv).
    """
    rows = rows.withColumn("take", F.coalesce(borrowed, F.lit(0)).cast("long")).withColumn("lender", lender)
    convs = checkpoint(rows.groupBy("conv").agg(F.first("take").alias("take"), F.first("lender").alias("lender")), spread=True)
    loans = checkpoint(rows.where(F.col("place") < most).select(F.col("conv").alias("of"), "place", "t1", "t2", "words"), spread=True)
    has = checkpoint(loans.groupBy("of").agg(F.max("place").alias("top")), spread=True)
    lent = convs.join(loans, F.col("lender") == F.col("of")).where("place < take")
    own = rows.where("place >= take").join(has, F.col("lender") == F.col("of"), "left")
    before = F.least(F.col("take"), F.coalesce(F.col("top") + 1, F.lit(0)))
    own = own.select("conv", (F.col("place") - F.col("take") + before).alias("at"), "t1", "t2", "words")
    return lent.select("conv", F.col("place").alias("at"), "t1", "t2", "words").unionByName(own), convs.select("conv")


def digest_after(first: str, turns: str, hash_name: str, count: Column) -> Column:
    return F.aggregate(F.slice(turns, 1, count), F.col(first), lambda x, t: x.bitwiseXOR(t[hash_name]))


def blocks_of(rows: DataFrame, block: int) -> DataFrame:
    """(conv, start, p1, p2, e1, e2, turns): blocks with the digests before and after, and whether the group parts."""
    at = F.col("at")
    hashed = rows.select(
        "conv", "at", "words", F.xxhash64(at, "t1", "t2").alias("h1"), F.xxhash64(F.lit(3), at, "t1", "t2").alias("h2")
    )
    found = hashed.groupBy("conv", (F.expr(f"at div {block}") * block).alias("start")).agg(
        F.sort_array(F.collect_list(F.struct("at", "h1", "h2", "words"))).alias("turns"),
        F.bit_xor("h1").alias("x1"),
        F.bit_xor("h2").alias("x2"),
    )
    found = placed(found, ["conv"], [F.col("start").asc()], xors=("x1", "x2"))
    end = [F.col(f"before_x{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"e{i}") for i in (1, 2)]
    found = found.select("conv", "start", F.col("before_x1").alias("p1"), F.col("before_x2").alias("p2"), *end, "turns")
    found = checkpoint(found, spread=True)
    end = F.struct("e1", "e2")
    groups = found.groupBy("start", "p1", "p2").agg(*[f(x).alias(f"{n}{x}") for x in ("e1", "e2") for n, f in (("lo", F.min), ("hi", F.max))])
    parting = groups.where("loe1 <> hie1 or loe2 <> hie2").select(
        F.col("start").alias("g0"), F.col("p1").alias("g1"), F.col("p2").alias("g2"), F.lit(True).alias("parts")
    )
    parting = checkpoint(parting, spread=True)
    same = (F.col("start") == F.col("g0")) & (F.col("p1") == F.col("g1")) & (F.col("p2") == F.col("g2"))
    return found.join(parting, same, "left").drop("g0", "g1", "g2")


def units_of(blocks: DataFrame) -> DataFrame:
    """(conv, start, p1, p2, turns, depth, d1, d2): runs of turns that all members of their group share.

    A whole block where the group stays together, single turns where it parts. (depth, d1, d2) is
    the node at the end of the run.
    """
    spread = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.struct(
            (F.col("start") + i - 1).alias("start"),
            digest_after("p1", "turns", "h1", i - 1).alias("p1"),
            digest_after("p2", "turns", "h2", i - 1).alias("p2"),
            F.slice("turns", i, F.lit(1)).alias("turns"),
            (F.col("start") + i).alias("depth"),
            digest_after("p1", "turns", "h1", i).alias("d1"),
            digest_after("p2", "turns", "h2", i).alias("d2"),
        ),
    )
    whole = F.array(
        F.struct("start", "p1", "p2", "turns", (F.col("start") + F.size("turns")).alias("depth"),
                 F.col("e1").alias("d1"), F.col("e2").alias("d2"))
    )
    runs = blocks.select("conv", F.explode(F.when(F.col("parts"), spread).otherwise(whole)).alias("run"))
    return runs.select("conv", "run.*")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, d1, d2, ends): SHA-256 of the comma-joined ids of conversations that end at a node, ascending."""
    kinds = {f.name: f for f in ends.schema}
    schema = T.StructType([*[kinds[c] for c in NODE], T.StructField("ends", T.StringType())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            done = []
            depths, firsts, seconds, ids = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*NODE, "text"))
            for node, text in zip(zip(depths, firsts, seconds), ids):
                if node != key:
                    if key is not None:
                        done.append((*key, running.hexdigest()))
                    key, running = node, hashlib.sha256(text.encode())
                else:
                    running.update(f",{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*NODE, "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, running.hexdigest())], [*NODE, "ends"])

    text = F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("text")
    rows = ends.repartition(*NODE).sortWithinPartitions(*NODE, F.col("conv").asc_nulls_first())
    return rows.select(*NODE, text).mapInArrow(stream, schema)


def renamed(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def node_join(nodes: DataFrame, other: DataFrame, key: list[str] = NODE) -> DataFrame:
    """Left join of ``other`` (depth, d1, d2, ...) to the columns ``key`` of ``nodes``."""
    other = renamed(other, NODE, "of_")
    same = [F.col(a) == F.col(f"of_{b}") for a, b in zip(key, NODE)]
    return nodes.join(other, same, "left").drop(*[f"of_{c}" for c in NODE])


def prefix_trie(rows: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of ``rows`` (conv, at, t1, t2, words).

    ``at`` counts a conversation's turns from 0 without gaps; ``convs`` (conv) are all
    conversations, with those that have no turn. Columns: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    rows = checkpoint(rows)
    units = checkpoint(units_of(blocks_of(rows, block)), spread=True)
    runs = units.groupBy(*NODE).agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.first(F.struct("start", "p1", "p2", "turns")).alias("run")
    )
    runs = runs.select(F.struct(*NODE).alias("unit"), "owner", "n_convs", "run.*")
    at = F.posexplode("turns").alias("i", "turn")
    nodes = runs.select("unit", "owner", "n_convs", "start", "p1", "p2", "turns", at).select(
        "unit",
        "owner",
        "n_convs",
        (F.col("start") + F.col("i") + 1).alias("depth"),
        digest_after("p1", "turns", "h1", F.col("i") + 1).alias("d1"),
        digest_after("p2", "turns", "h2", F.col("i") + 1).alias("d2"),
        (F.col("start") + F.col("i")).alias("up"),
        digest_after("p1", "turns", "h1", F.col("i")).alias("u1"),
        digest_after("p2", "turns", "h2", F.col("i")).alias("u2"),
        F.col("turn.words").alias("words"),
    )
    none = F.lit(None).cast("long")
    top = convs.agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.struct(*[F.lit(0).cast("long").alias(c) for c in NODE]).alias("unit"), "owner", "n_convs",
        *[F.lit(0).cast("long").alias(c) for c in NODE], *[none.alias(c) for c in ("up", "u1", "u2")], F.lit(0).cast("long").alias("words"),
    )
    nodes = checkpoint(nodes.unionByName(top), spread=True)
    children = nodes.where("up is not null").groupBy(F.col("up").alias("depth"), F.col("u1").alias("d1"), F.col("u2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = node_join(nodes, checkpoint(children, spread=True)).withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = checkpoint(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), spread=True)

    # What each conversation owns: saved tokens, and its last node if that has no children.
    owned = nodes.groupBy("owner").agg(
        F.sum(F.when(F.col("n_convs") > 1, F.col("saved")).otherwise(0)).alias("owned"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"),
    )
    owned = checkpoint(owned.where("owned > 0 or leaf > 0").withColumnRenamed("owner", "of"), spread=True)
    members = units.select("conv", *NODE).unionByName(convs.select("conv", *[F.lit(0).cast("long").alias(c) for c in NODE]))
    sums = members.join(owned, F.col("conv").eqNullSafe(F.col("of"))).groupBy(*NODE).agg(
        F.sum("owned").alias("in_all"), F.sum("leaf").alias("n_leaves")
    )
    # Of a chain of owned nodes only those with other members have something to add up.
    chain = Window.partitionBy("owner").orderBy(F.col("depth").desc())
    shared = nodes.where("n_convs > 1").select(
        *NODE,
        F.sum("saved").over(chain.rowsBetween(Window.unboundedPreceding, 0)).alias("below"),
        F.sum("saved").over(Window.partitionBy("owner")).alias("owned"),
    )
    parents = nodes.select(*NODE, F.col("owner").alias("parent_conv_id"))
    lengths = rows.groupBy("conv").agg(
        F.count(F.lit(1)).alias("depth"),
        F.bit_xor(F.xxhash64("at", "t1", "t2")).alias("d1"),
        F.bit_xor(F.xxhash64(F.lit(3), "at", "t1", "t2")).alias("d2"),
    )
    lengths = checkpoint(lengths.withColumnRenamed("conv", "of"), spread=True)
    ends = convs.join(lengths, F.col("conv").eqNullSafe(F.col("of")), "left")
    ends = ends.select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in NODE])
    found = node_join(nodes, checkpoint(sums, spread=True), ["unit.depth", "unit.d1", "unit.d2"])
    found = node_join(found, checkpoint(shared, spread=True))
    found = node_join(found, checkpoint(ends_digests(ends), spread=True))
    found = node_join(found, checkpoint(parents, spread=True), ["up", "u1", "u2"])
    saved = F.when(F.col("n_convs") > 1, F.col("in_all") - F.col("owned") + F.col("below")).otherwise(0)
    return found.select(
        F.col("owner").alias("conv_id"),
        F.col("depth"),
        "parent_conv_id",
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"),
        F.coalesce(saved, F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
