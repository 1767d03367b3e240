"""Merkle manifest of a dataset, checked by a recursive query that climbs from every leaf.

Each row is a leaf, the digest of its fields. Per branch (a language, say) the leaves in
order of their ids are cut into runs of ``fan``, each run's digests are hashed to a node,
the nodes again, until one is left: the branch's subroot. The subroots in order of the
branches' names are the leaves of one more tree, whose top is the root.

The built levels are stored as node rows linked to their parents: a row (tree, level, idx) holds
the digests of its run and which place of which run it takes itself. A tree's top has one row more,
alone in its run, that links a branch to its place among the subroots and ends the climb
at the root. Verifying is one recursive query over that table: each leaf brings the
digest that its row has now, goes up run by run, puts its own digest in its place and
hashes. A step is a join on the parents' key; what is handed on to the next step is one
digest for a leaf, and through which run it goes. The other digests of that run are a
step of the leaf's proof; they are appended behind the recursion, which would
otherwise write seven of them for every leaf and step once more.

Digests are kept as 32 bytes and hashed as lowercase hexadecimal text. A branch with a third of
all rows is ordered in ranges, and no task sees more of it than others.

Defined results: a null field is ``-`` in the digest, others are their length in UTF-8 bytes,
``:`` and the value; a null branch comes first and is a branch; null ids come first, equal ones in
the order of their leaf; repeated rows are leaves of their own; a lone leaf is its branch's subroot, a lone
subroot the root, and a proof without siblings is empty; an empty table gives no rows.
Columns that are no field are not covered and not returned.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import checkpoint
from .places import placed

SIZE = 32  # bytes of a digest
FAN = 8
#: Branches up to this number are broadcast to the leaves, more are joined by shuffle.
FEW_BRANCHES = 20_000
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest_of(hexes: Column) -> Column:
    """32 bytes of the SHA-256 of digests given as bytes, one after another."""
    return F.unhex(F.sha2(F.lower(F.hex(hexes)).cast("binary"), 256))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_of(fields: list[Column]) -> Column:
    """Digest of a row's fields."""
    framed = [
        F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
        for x in (f.cast("string") for f in fields)
    ]
    return F.unhex(F.sha2(F.concat(*framed).cast("binary"), 256))


@dataclass(frozen=True)
class Manifest:
    """Stored tables: leaves (id, tree, place, leaf and what was kept with them), nodes, subroots, and the root."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: bytes | None
    fan: int


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def grown(leaves: DataFrame, path: str, fan: int) -> DataFrame:
    """Runs of all levels above the leaves (tree, place, digest), as a table at ``path``; a tree's top is alone in the last."""
    below, level = leaves.select("tree", F.col("place").alias("idx"), "digest"), 1
    while True:
        slot = (F.col("idx") % fan).cast("int").alias("slot")
        runs = below.groupBy("tree", F.expr(f"idx div {fan}").alias("idx")).agg(
            F.sort_array(F.collect_list(F.struct(slot, "digest"))).alias("run")
        )
        joined = F.aggregate("run", F.lit(b""), lambda all_, x: F.concat(all_, x["digest"]))
        runs = runs.select("tree", "idx", joined.alias("children"), ((F.col("idx") == 0) & (F.size("run") == 1)).alias("alone"))
        level_path = f"{path}/level={level}"
        runs = stored(runs, level_path)
        below = runs.where("not alone").select("tree", "idx", digest_of(F.col("children")).alias("digest"))
        if below.isEmpty():
            break
        level += 1
    return leaves.sparkSession.read.parquet(path)


def manifest(
    docs: DataFrame, fields: list[Column], doc_id: str = "doc_id", branch: str = "lang", fan: int = FAN, **kept: Column
) -> Manifest:
    """The manifest of ``docs``; ``kept`` are columns that stay with the leaves."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "merkle")
    name = F.col(f"`{branch}`").cast("string")
    slim = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        name.alias("branch"),
        leaf_of(fields).alias("digest"),
        *[c.alias(n) for n, c in kept.items()],
    )
    order = [F.col("id").asc_nulls_first(), F.col("digest").asc(), *[F.col(n).asc_nulls_first() for n in kept]]
    # The empty name is the tree of the subroots.
    tree = F.coalesce(F.concat(F.octet_length("branch").cast("string"), F.lit(":"), F.col("branch")), F.lit("-"))
    leaves = placed(slim, ["branch"], order).withColumn("tree", tree)
    leaves = stored(leaves, f"{path}/leaves")
    nodes = grown(leaves, f"{path}/nodes", fan)
    names = leaves.groupBy("tree", "branch").count().select(F.col("tree").alias("of"), "branch")
    tops = nodes.where("alone").join(names, F.col("tree") == F.col("of")).select("tree", "branch", "children")
    tops = placed(tops, [], [F.col("branch").asc_nulls_first()]).select(
        F.col("tree").alias("of"), "place", F.col("children").alias("digest")
    )
    subroots = stored(tops, f"{path}/subroots")
    above = grown(subroots.withColumn("tree", F.lit("")), f"{path}/above", fan)
    found = above.where("alone").select("children").first()
    up = [F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.expr(f"idx div {fan}").alias("up_idx")]
    own = ["tree", "level", "idx", "children", "alone"]
    inner = nodes.unionByName(above).where("not alone").select(*own, *up, (F.col("idx") % fan).cast("int").alias("slot"))
    place = F.col("place")
    ends = nodes.where("alone").join(subroots.select("of", "place"), F.col("tree") == F.col("of"))
    ends = ends.select(
        *own, F.lit("").alias("up_tree"), F.lit(1).alias("up_level"), F.expr(f"place div {fan}").alias("up_idx"),
        (place % fan).cast("int").alias("slot"),
    )
    none = [F.lit(None).cast(t).alias(n) for n, t in (("up_tree", "string"), ("up_level", "int"), ("up_idx", "long"), ("slot", "int"))]
    linked = inner.unionByName(ends).unionByName(above.where("alone").select(*own, *none))
    return Manifest(leaves, stored(linked, f"{path}/linked"), subroots, bytes(found[0]) if found else None, fan)


#: The anchor is every leaf, on its way to the run above it; a step goes through that run to the one above. The last
#: row of a leaf is on its way to the run that holds the root alone.
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT tree AS of_tree, place AS of_place, 0 AS step, tree AS at_tree, level AS at_level, place div {{fan}} AS at_idx,
    CAST(place % {{fan}} AS INT) AS at_slot, claimed AS folded
  FROM {{leaves}}
  UNION ALL
  SELECT c.of_tree, c.of_place, c.step + 1, n.up_tree, n.up_level, n.up_idx, n.slot,
    IF(n.alone, c.folded, unhex(sha2(CAST(lower(hex(concat(substring(n.children, 1, {SIZE} * c.at_slot), c.folded,
      substring(n.children, {SIZE} * c.at_slot + {SIZE + 1})))) AS BINARY), 256)))
  FROM climb c JOIN {{nodes}} n ON c.at_tree = n.tree AND c.at_level = n.level AND c.at_idx = n.idx
  WHERE n.up_tree IS NOT NULL
)
SELECT of_tree, of_place, step, at_tree, at_level, at_idx, at_slot, folded FROM climb
"""


@contextmanager
def unlimited_recursion(spark: SparkSession):
    """A recursive query may give as many rows as there are leaves and levels."""
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)


def climbed(built: Manifest, claimed: str = "digest") -> DataFrame:
    """(of_tree, of_place, folded, proof) of every leaf: the root its digest ``claimed`` leads to, and all siblings on the way."""
    spark = built.leaves.sparkSession
    # The level may become null on the way, so it must not be a constant.
    level = F.when(F.col("tree").isNotNull(), F.lit(1)).alias("level")
    leaves = built.leaves.select("tree", "place", level, F.col(claimed).alias("claimed"))
    with unlimited_recursion(spark):
        steps = spark.sql(CLIMB.replace("{fan}", str(built.fan)), leaves=leaves, nodes=built.nodes)
        same = [F.col(f"at_{c}") == F.col(c) for c in ("tree", "level", "idx")]
        met = steps.join(built.nodes, same)
        before, after = (F.substring("children", 1, SIZE * F.col("at_slot")), F.substring("children", SIZE * F.col("at_slot") + SIZE + 1, SIZE * built.fan))
        siblings = F.when(~F.col("alone"), F.concat(before, after))
        root = F.when(F.col("up_tree").isNull(), F.col("folded"))
        climbs = met.groupBy("of_tree", "of_place").agg(
            F.sort_array(F.collect_list(F.when(siblings.isNotNull(), F.struct("step", siblings.alias("siblings"))))).alias("steps"),
            F.max(root).alias("folded"),
        )
        proof = F.aggregate("steps", F.lit(b""), lambda all_, x: F.concat(all_, x["siblings"]))
        return checkpoint(climbs.select("of_tree", "of_place", "folded", proof.alias("proof")))


def verified(built: Manifest, claimed: str = "digest") -> DataFrame:
    """Leaves with id, digest, what was kept, and subroot, root, proof, folded (all as bytes) and verified."""
    climbs = climbed(built, claimed)
    subroots = built.subroots.select("of", F.col("digest").alias("subroot"))
    few = subroots.count() <= FEW_BRANCHES
    rows = built.leaves.join(
        climbs, (F.col("tree") == F.col("of_tree")) & (F.col("place") == F.col("of_place"))
    ).join(F.broadcast(subroots) if few else subroots, F.col("tree") == F.col("of"))
    root = F.lit(built.root).cast("binary")
    own = [c for c in built.leaves.columns if c not in ("tree", "place")]
    return rows.select(*own, "subroot", root.alias("root"), "proof", "folded", (F.col("folded") == root).alias("verified"))
