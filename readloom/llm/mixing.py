"""Mixing sources to target weights by a budget handed down a domain-language-source tree.

The root's budget of tokens is shared among domains by weight, each domain's among its
languages, each language's among its sources. No node gets more than its sources can
give, their tokens times ``max_epochs``; what one can't take goes to its siblings by
weight, and only what all siblings can't take stays with the nodes above, whose own
shares were cut to what they can give before. Each leaf then reads its documents epoch by
epoch in seeded orders until its budget is spent: whole epochs first, then a prefix of the
tokens of one more, whose last document may count in part.

Shares follow from a window over the few nodes of each parent: in the order of what they
can give per weight, a node is full if the rest of the budget, shared by weight among
it and all after it, would give it as much or more; all others share what is left. All
in whole numbers; the fractions of a token lost by rounding are not handed out.
The seeded order is that of a digest. Token sums of its first digits find where a leaf's
budget runs out, and only the rows with those digits are ranked one by one: a source with
a third of all rows is never sorted in one task.

Defined results: null domain, language or source is the empty name; nodes without a
weight get ``other``, those with a weight under one are no part of the tree; documents
without tokens are never taken; equal ids are ordered by the digest of their text, and
repeated rows take each other's place; an empty table or budget gives no rows. Other
columns pass through, those named like a result give way to it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

LEVELS = ("domain", "lang", "source")
RESULT = ("domain", "epoch", "n_tokens", "tokens_taken")
#: Leaves up to this number are broadcast to the documents, more are joined by shuffle.
FEW_LEAVES = 20_000
#: Hexadecimal digits of the seeded order whose sums are taken first.
DIGITS = 3


@dataclass(frozen=True)
class Weights:
    """Whole-number weights by name for each level; ``other`` for names that are not there."""

    domain: dict[str, int] = field(default_factory=dict)
    lang: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)
    other: int = 1

    def column(self, level: str) -> Column:
        weight = F.lit(self.other)
        for name, own in getattr(self, level).items():
            weight = F.when(F.col(level) == name, own).otherwise(weight)
        return weight.cast("long")


def word_count(text: Column) -> Column:
    """Words between blanks, tabs and line ends; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def shared(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``nodes`` (parent columns, name, weight, capacity, above) with the part of ``above`` that each gets."""
    fraction = (F.col("capacity") % F.col("weight")) / F.col("weight")
    order = Window.partitionBy(*parent).orderBy(F.expr("capacity div weight"), fraction, "name")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*parent)
    rated = nodes.withColumn("rest", F.col("above") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    rated = rated.withColumn("heavy", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # Products of tokens and weights outgrow a long at some 10 ** 14 tokens.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("capacity", "heavy", "rest", "weight")}
    rated = rated.withColumn("full", wide["capacity"] * wide["heavy"] <= wide["rest"] * wide["weight"])
    rated = rated.withColumn("left", F.col("above") - F.coalesce(F.sum(F.expr("if(full, capacity, 0)")).over(whole), F.lit(0)))
    rated = rated.withColumn("open", F.sum(F.expr("if(full, 0, weight)")).over(whole))
    return rated.withColumn("budget", F.expr("if(full, capacity, cast(weight AS decimal(19,0)) * `left` div open)"))


def leaf_budgets(leaves: DataFrame, weights: Weights, budget: Column, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) of the leaves (domain, lang, source, tokens).

    ``budget`` is a whole number of tokens and may use ``supply``, the tokens of the tree.
    """
    able = leaves.withColumns({f"{level}_weight": weights.column(level) for level in LEVELS})
    able = able.where(" and ".join(f"{level}_weight > 0" for level in LEVELS))
    able = able.withColumn("capacity", F.col("tokens") * max_epochs).withColumn("root", F.lit(0))
    total = able.groupBy("root").agg(F.sum("tokens").alias("supply"), F.sum("capacity").alias("capacity"))
    above = total.select("root", F.greatest(F.least(budget.cast("long"), "capacity"), F.lit(0)).alias("above"))
    parent = ["root"]
    for level in LEVELS:
        sums = able.groupBy(*parent, level).agg(F.max(f"{level}_weight").alias("weight"), F.sum("capacity").alias("capacity"))
        nodes = sums.join(above, parent).withColumn("name", F.col(level))
        parent = [*parent, level]
        above = shared(nodes, parent[:-1]).select(*parent, F.col("budget").alias("above"))
    return able.join(above, parent).select(*LEVELS, "tokens", F.col("above").alias("budget"))


def seeded(seed: int, epoch: Column, doc_id: Column, print_: Column) -> Column:
    """Order of rows in an epoch. The text's digest counts too, so that rows of one id lie apart."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), name, F.coalesce(print_, F.lit(""))).cast("binary"))


def mix(
    docs: DataFrame,
    weights: Weights,
    budget: Column,
    domain: Column,
    max_epochs: int = 4,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """``docs`` as often as they are read, with domain, epoch, n_tokens and tokens_taken."""
    body, own = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    count = word_count(body) if tokens is None else tokens
    place = {
        "domain": F.coalesce(domain, F.lit("")),
        "lang": F.coalesce(F.col("lang"), F.lit("")),
        "source": F.coalesce(F.col("source"), F.lit("")),
    }
    print_ = F.md5(body.cast("binary")).alias("print")
    slim = docs.select(own.alias("id"), print_, count.alias("n_tokens"), *[c.alias(n) for n, c in place.items()])
    slim = checkpoint(slim.where("n_tokens > 0"))
    leaves = checkpoint(slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")))
    plan = leaf_budgets(leaves, weights, budget, max_epochs).where("budget > 0")
    plan = plan.select(
        *LEVELS, F.expr("budget div tokens").cast("int").alias("whole"), (F.col("budget") % F.col("tokens")).alias("part")
    )
    plan = checkpoint(plan)
    few = plan.count() <= FEW_LEAVES

    def near(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    digest = seeded(seed, F.col("whole"), F.col("id"), F.col("print"))
    sums = slim.join(near(plan), list(LEVELS)).withColumn("head", F.substring(digest, 1, DIGITS))
    sums = sums.groupBy(*LEVELS, "head", "whole", "part").agg(F.sum("n_tokens").alias("tokens"))
    running = Window.partitionBy(*LEVELS).orderBy("head")
    sums = sums.withColumn("upto", F.sum("tokens").over(running))
    # Where the prefix of the last epoch ends: the digits, and what is left for their rows.
    ends = sums.where((F.col("upto") >= F.col("part")) & (F.col("upto") - F.col("tokens") < F.col("part")))
    ends = ends.select(*LEVELS, F.col("head").alias("end"), (F.col("part") - F.col("upto") + F.col("tokens")).alias("rest"))
    plan = plan.join(ends, list(LEVELS), "left").withColumnsRenamed({n: f"leaf_{n}" for n in LEVELS})
    plan = checkpoint(plan)
    others = [c for c in docs.columns if c not in RESULT]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        own.alias("id"),
        print_,
        count.alias("n_tokens"),
        *[c.alias(n) for n, c in place.items()],
    )
    rows = rows.join(near(plan), [F.col(n) == F.col(f"leaf_{n}") for n in LEVELS]).where("n_tokens > 0")
    rows = rows.withColumn("digest", digest).withColumn("head", F.substring("digest", 1, DIGITS))
    epochs = F.expr("if(times > 0, sequence(0, times - 1), array())")
    apart = rows.where(~F.col("head").eqNullSafe(F.col("end")))
    apart = apart.withColumn("times", F.col("whole") + F.expr("if(head < end, 1, 0)"))
    apart = apart.select("row", "domain", "n_tokens", F.explode(epochs).alias("epoch"))
    apart = apart.withColumn("tokens_taken", F.col("n_tokens"))
    order = Window.partitionBy(*LEVELS).orderBy("digest", "id", "print", "n_tokens")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = rows.where(F.col("head") == F.col("end")).withColumn("left", F.col("rest") - before)
    last = last.withColumn("times", F.col("whole") + F.expr("if(`left` > 0, 1, 0)"))
    last = last.select("row", "domain", "n_tokens", "whole", "left", F.explode(epochs).alias("epoch"))
    taken = F.when(F.col("epoch") == F.col("whole"), F.least("n_tokens", "left")).otherwise(F.col("n_tokens"))
    last = last.select("row", "domain", "n_tokens", "epoch", taken.alias("tokens_taken"))
    return apart.unionByName(last).select(*[F.col("row").getField(c).alias(c) for c in others], *RESULT)
