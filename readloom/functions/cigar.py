"""CIGAR strings as arrays, and the reference positions derived from them.

Only the runs M, D, N, =, X move along the reference; I, S, H, P do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bases import bind, col

RUN = r"(\d+)([MIDNSHP=X])"
# One M run, or two around one intron; clipped or not.
ONE_RUN = r"^(?:\d+[SH])*(\d+)M(?:\d+[SH])*$"
TWO_RUNS = r"^(?:\d+[SH])*(\d+)M(\d+)N(\d+)M(?:\d+[SH])*$"
REF_RUNS = ("M", "D", "N", "=", "X")
QUERY_RUNS = ("M", "I", "S", "=", "X")
BLOCK_RUNS = ("M", "D", "=", "X")


def cigar_ops(cigar: str | Column) -> Column:
    """CIGAR -> ARRAY<STRUCT<len INT, op STRING>> (A1). ``*`` gives an empty array."""
    c = col(cigar)
    lens = F.regexp_extract_all(c, F.lit(RUN), F.lit(1))
    ops = F.regexp_extract_all(c, F.lit(RUN), F.lit(2))
    return F.transform(
        F.arrays_zip(lens.alias("len"), ops.alias("op")),
        lambda x: F.struct(x["len"].cast("int").alias("len"), x["op"].alias("op")),
    )


def run_length(cigar: str | Column, ops: tuple[str, ...]) -> Column:
    """Sum of the lengths of the runs whose operation is in ``ops``."""
    return F.aggregate(
        cigar_ops(cigar),
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.when(x["op"].isin(*ops), x["len"]).otherwise(0),
    )


def reference_length(cigar: str | Column) -> Column:
    return run_length(cigar, REF_RUNS)


def query_length(cigar: str | Column) -> Column:
    """Read bases the CIGAR describes, soft clips included."""
    return run_length(cigar, QUERY_RUNS)


def ref_end(pos: str | Column, cigar: str | Column) -> Column:
    """Last reference position of an alignment, 1-based closed (A2)."""
    return col(pos).cast("long") + reference_length(cigar) - 1


def blocks(pos: str | Column, cigar: str | Column) -> Column:
    """ARRAY<STRUCT<b_start, b_end, matched>>: the alignment cut at N runs (A3).

    ``matched`` counts M, = and X bases; deletions extend a block without matching.
    Alignments without indels and with at most one intron are most of the data and take
    a short way by pattern; lambda functions are slow. The others are folded run by run,
    with the open block (s, e, m) and the closed ones as state.
    """
    p, c = col(pos).cast("long"), col(cigar)
    zero = F.lit(0).cast("long")

    def block(s: Column, e: Column, m: Column) -> Column:
        return F.struct(s.alias("b_start"), e.alias("b_end"), m.alias("matched"))

    def state(s: Column, e: Column, m: Column, done: Column) -> Column:
        return F.struct(s.alias("s"), e.alias("e"), m.alias("m"), done.alias("done"))

    def closed(a: Column) -> Column:
        last = F.array(block(a["s"], a["e"], a["m"]))
        return F.when(a["e"] >= a["s"], F.concat(a["done"], last)).otherwise(a["done"])

    def step(a: Column, run: Column) -> Column:
        op = F.right(run, F.lit(1))
        length = F.substr(run, F.lit(1), F.length(run) - 1).cast("long")
        longer = state(
            a["s"], a["e"] + length, a["m"] + F.when(op == "D", zero).otherwise(length), a["done"]
        )
        after_gap = state(a["e"] + length + 1, a["e"] + length, zero, closed(a))
        return F.when(op.isin(*BLOCK_RUNS), longer).when(op == "N", after_gap).otherwise(a)

    none = F.array().cast("array<struct<b_start:bigint,b_end:bigint,matched:bigint>>")
    runs = F.regexp_extract_all(c, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0))
    folded = F.aggregate(runs, state(p, p - 1, zero, none), step, closed)

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(c, pattern, i).cast("long")

    one = F.array(block(p, p + group(ONE_RUN, 1) - 1, group(ONE_RUN, 1)))
    left, gap, right = (group(TWO_RUNS, i) for i in (1, 2, 3))
    two = F.array(block(p, p + left - 1, left), block(p + left + gap, p + left + gap + right - 1, right))
    return F.when(c.rlike(ONE_RUN), one).when(c.rlike(TWO_RUNS), two).otherwise(folded)


def introns(block_array: str | Column) -> Column:
    """ARRAY<STRUCT<i_start, i_end, overhang>> between consecutive blocks.

    ``block_array`` should be a bound column, as it is used several times. ``overhang`` is the smaller count of matched bases in the two blocks that flank
    the intron.
    """
    b = col(block_array)
    pairs = F.arrays_zip(
        F.slice(b, 1, F.greatest(F.size(b) - 1, F.lit(0))).alias("left"),
        F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))).alias("right"),
    )
    return F.transform(
        pairs,
        lambda x: F.struct(
            (x["left"]["b_end"] + 1).alias("i_start"),
            (x["right"]["b_start"] - 1).alias("i_end"),
            F.least(x["left"]["matched"], x["right"]["matched"]).alias("overhang"),
        ),
    )


def placed_blocks(placed: DataFrame, outer: bool = False) -> DataFrame:
    """``placed(pos, cigar, ...)`` with (b_start, b_end, matched), one row per block.

    With ``outer`` rows without a CIGAR stay, with nulls.
    """
    generate = F.inline_outer if outer else F.inline
    return placed.select("*", generate(blocks("pos", "cigar")))


def placed_introns(placed: DataFrame) -> DataFrame:
    """``placed(pos, cigar, ...)`` with (i_start, i_end, overhang), one row per intron."""
    cut = bind(placed, "_blocks", blocks("pos", "cigar"))
    return cut.select(*placed.columns, F.inline(introns("_blocks")))
