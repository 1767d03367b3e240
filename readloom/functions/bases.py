"""Per-read column expressions over base and quality strings.

Counting is done with ``replace`` / ``translate`` on whole strings wherever that
is possible: these stay inside generated code, while lambda functions over arrays
are interpreted element by element.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PHRED_OFFSET = 33
# Printable quality characters, lowest quality first.
QUALITY_CHARS = "".join(chr(c) for c in range(33, 127))


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often it is used later.

    The optimizer copies a plain projected expression into every later filter and
    projection that mentions it, which doubles the work at each step of a chain. It
    does not look through a generator, here one over a single-element array.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def phred(qual: str | Column) -> Column:
    """Quality string -> ARRAY<INT> of Phred scores."""
    return F.transform(F.split(col(qual), ""), lambda c: F.ascii(c) - PHRED_OFFSET)


def count_of(text: str | Column, chars: str) -> Column:
    """How many characters of ``text`` are one of ``chars``."""
    c = col(text)
    if len(chars) <= 4:
        rest = reduce(lambda acc, ch: F.replace(acc, F.lit(ch), F.lit("")), chars, c)
    else:
        rest = F.translate(c, chars, "")
    return F.length(c) - F.length(rest)


def gc_count(seq: str | Column) -> Column:
    return count_of(seq, "GC")


def acgt_count(seq: str | Column) -> Column:
    return count_of(seq, "ACGT")


def n_count(seq: str | Column) -> Column:
    return count_of(seq, "N")


def bases_below(qual: str | Column, quality: int) -> Column:
    """Bases whose Phred score is below ``quality``."""
    return count_of(qual, QUALITY_CHARS[:quality])


def bases_at_least(qual: str | Column, quality: int) -> Column:
    return F.length(col(qual)) - bases_below(qual, quality)


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division of non-negative columns; null when ``b`` is 0."""
    b = F.lit(b) if isinstance(b, int) else b
    zero = F.lit(0).cast("long")
    return F.call_function("div", a.cast("long"), F.nullif(b.cast("long"), zero))


def gc_percent_rounded(seq: str | Column) -> Column:
    """round(100 * gc / length), half up, in integer arithmetic."""
    n = F.length(col(seq))
    return int_div(200 * gc_count(seq) + n, 2 * n).cast("int")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double; null when ``whole`` is 0."""
    return 100.0 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
