"""Sources of sequences among contaminants, with mismatches (Q9).

A hit is an ungapped stretch of ``least`` bases or more that a sequence shares with a contaminant, with one
mismatch at most. One of two halves of ``least`` bases then agrees whole, so an index of the
contaminants' half-length words names all diagonals (contaminant, shift) on which a hit can
lie; on these the longest stretch with one mismatch is taken. A sequence or contaminant under
``least`` bases must stand in the other whole. The longest hit wins, then that with fewer
mismatches, then the contaminant named first.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

NO_HIT = "No Hit"
HIT = "struct<source: string, matched: int, length: int>"


def longest_stretch(mismatches: list[int], begin: int, end: int) -> tuple[int, int]:
    """Length and mismatches of the longest stretch of ``begin`` to ``end`` with one mismatch at most."""
    edges = [begin - 1, *mismatches, end]
    best = (0, 0)
    for i in range(1, len(edges) - 1):
        size = edges[i + 1] - edges[i - 1] - 1
        best = max(best, (size, -1))
    if not mismatches:
        best = (end - begin, 0)
    else:
        whole = max(b - a - 1 for a, b in zip(edges, edges[1:]))
        best = max(best, (whole, 0))
    return best


def source_of(contaminants: dict[str, str], least: int = 20):
    """Arrow function: sequences -> (source, matched bases, length of the hit); ``No Hit`` with zeros."""
    named = list(contaminants.items())
    half = least // 2
    stretch = longest_stretch

    def find(seqs: pa.Array) -> pa.Array:
        import pyarrow as pa

        index: dict[str, set[tuple[int, int]]] = {}
        for number, (_, probe) in enumerate(named):
            for place in range(len(probe) - half + 1):
                index.setdefault(probe[place : place + half], set()).add((number, place))

        def hits(seq: str):
            if len(seq) >= least:
                shifts = {(n, i - p) for i in range(len(seq) - half + 1) for n, p in index.get(seq[i : i + half], ())}
                for number, shift in shifts:
                    probe = named[number][1]
                    begin, end = max(0, shift), min(len(seq), shift + len(probe))
                    if len(probe) >= least and end - begin >= least:
                        off = [i for i in range(begin, end) if seq[i] != probe[i - shift]]
                        size, fewer = stretch(off, begin, end)
                        if size >= least:
                            yield size, fewer, -number
            for number, (_, probe) in enumerate(named):
                short = min(seq, probe, key=len)
                if len(short) < least and short and (short in seq) and (short in probe):
                    yield len(short), 0, -number

        rows = []
        for value in seqs:
            size, fewer, number = max(hits(value.as_py() or ""), default=(0, 0, 1))
            rows.append({"source": named[-number][0] if number < 1 else "No Hit", "matched": size + fewer, "length": size})
        return pa.array(rows, pa.struct([("source", pa.string()), ("matched", pa.int32()), ("length", pa.int32())]))

    return F.arrow_udf(find, "source string, matched int, length int")


def best_source(seq: str | Column, contaminants: dict[str, str], least: int = 20) -> Column:
    """(source, matched, length) of a sequence. For the few sequences that are reported, not for reads."""
    return source_of(contaminants, least)(F.col(seq) if isinstance(seq, str) else seq)
