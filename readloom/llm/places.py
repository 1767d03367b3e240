"""Places and running digests in ordered groups, without a task for a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

_PART = 33  # bits that a row's number in its partition takes in monotonically_increasing_id


def placed(df: DataFrame, group: list[str], order: list[Column], xors: tuple[str, ...] = (), drop: tuple[str, ...] = ()):
    """``df`` with the ``place`` (long, from 0) of each row in its group; rows that order alike stand in any order.

    For each column in ``xors`` there is also ``before_...``, the bits of all rows before in
    the group combined by exclusive or. Columns in ``drop`` serve for the order only.

    Rows are dealt out by ranges of group and order, so that a group of a third of all rows lies
    in many partitions, and numbered inside a partition. What is added for the partitions
    before has one row for a partition at most (the group that goes on from the one before),
    and is broadcast.
    """
    sort = [*[F.col(g).asc_nulls_first() for g in group], *order]
    rows = df.repartitionByRange(*sort).sortWithinPartitions(*sort).drop(*drop)
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", _PART))
    rows = checkpoint(rows)
    bits = [F.bit_xor(x).alias(f"_{x}") for x in xors]
    parts = rows.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), *bits)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("_part").alias("_of_part"),
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.sum("_n").over(earlier).alias("_skip"),
        *[F.bit_xor(f"_{x}").over(earlier).alias(f"_skip_{x}") for x in xors],
    )
    parts = F.broadcast(checkpoint(parts.where("_skip is not null")))
    same = [F.col("_part") == F.col("_of_part"), *[F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group]]
    own = Window.partitionBy("_part", *group).orderBy("_at")
    found = rows.withColumn("place", F.row_number().over(own).cast("long") - 1)
    for x in xors:
        upto = F.bit_xor(x).over(own.rowsBetween(Window.unboundedPreceding, -1))
        found = found.withColumn(f"before_{x}", F.coalesce(upto, F.lit(0)))
    found = found.join(parts, same, "left")
    found = found.withColumn("place", F.col("place") + F.coalesce("_skip", F.lit(0)))
    for x in xors:
        found = found.withColumn(f"before_{x}", F.col(f"before_{x}").bitwiseXOR(F.coalesce(f"_skip_{x}", F.lit(0))))
    kept = [c for c in rows.columns if c not in ("_at", "_part")]
    return found.select(*kept, "place", *[f"before_{x}" for x in xors])
