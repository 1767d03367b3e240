"""Mismatches from MD strings: where the read differs from the reference, without its indels.

An MD string runs along the reference bases that the alignment covers, introns left out:
a number of equal bases, the reference base of a mismatch, ``^`` and the deleted bases.
Inserted and clipped bases of the read don't occur. So places in it are offsets
into the alignment's blocks (A3), which deletions belong to and introns part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bases import col


def mismatches(md: str | Column) -> Column:
    """Number of mismatched bases; null without an MD string."""
    return F.length(F.regexp_replace(col(md), r"\^[A-Za-z]+|\d+", ""))


def located(n_columns: int, pos: int, cigar: int, md: int):
    """Function for ``mapInArrow``: batches to the rows of their mismatches, with (ref_pos, base) behind.

    numpy reads all characters of a batch's MD and CIGAR strings together; lambda functions over
    arrays are interpreted token by token, for a hundred times the time. The function carries no
    reference to this package, so workers need not have it.
    """

    def locate(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        far = 1 << 40  # longer than any reference

        def characters(column):
            """Bytes of all values, the row of each, and which are digits."""
            filled = pc.fill_null(column, "").cast(pa.large_binary())
            ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
            data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            return data, np.repeat(np.arange(len(filled)), np.diff(ends)), (data >= 48) & (data <= 57)

        def begins(kind, row):
            """Whether a run of one kind of characters in one row begins at each place."""
            first = kind.copy()
            first[1:] &= ~kind[:-1] | (row[1:] != row[:-1])
            return first

        def numbers(data, row, digit):
            """First and last place of each run of digits, and its number."""
            first = np.flatnonzero(begins(digit, row))
            if not len(first):
                return first, first, first
            run = np.cumsum(begins(digit, row))[digit] - 1
            last = first + np.bincount(run) - 1
            left = last[run] - np.flatnonzero(digit)
            worth = np.where(left < 13, (data[digit] - 48.0) * 10.0 ** np.minimum(left, 13), np.where(data[digit] > 48, far, 0))
            return first, last, np.minimum(np.bincount(run, worth), far).astype(np.int64)

        for batch in batches:
            # Reference bases that a CIGAR's runs cover, and steps along the reference, added up over the batch.
            data, row, digit = characters(batch.column(cigar))
            _, last, size = numbers(data, row, digit)
            follows = (last + 1 < len(data)) & (row[np.minimum(last + 1, len(data) - 1)] == row[last]) if len(last) else last == 0
            last, size = last[follows], size[follows]
            op = data[last + 1] if len(last) else data[:0]
            covers = np.isin(op, np.frombuffer(b"MD=X", np.uint8))
            covered = np.concatenate(([0], np.cumsum(np.where(covers, size, 0))))
            along = np.concatenate(([0], np.cumsum(np.where(covers | (op == ord("N")), size, 0))))
            edges = np.searchsorted(row[last], np.arange(batch.num_rows + 1))  # a row's first run, and the one behind its last
            # Offsets of letters in MD strings; those behind ^ are deleted bases.
            data, row, digit = characters(batch.column(md))
            letter = ((data | 32) >= 97) & ((data | 32) <= 122)
            _, last, size = numbers(data, row, digit)
            step = letter.astype(np.int64)
            step[last] = size
            upto = np.cumsum(step) - step
            first = np.flatnonzero(begins(letter, row))
            deleted = (first > 0) & (data[first - 1] == ord("^")) & (row[first - 1] == row[first]) if len(first) else first == 0
            mismatch = np.flatnonzero(letter)
            mismatch = mismatch[~deleted[np.cumsum(begins(letter, row))[mismatch] - 1]] if len(mismatch) else mismatch
            of = row[mismatch]
            start = np.searchsorted(row, of) if len(of) else of
            target = covered[edges[of]] + upto[mismatch] - (upto[start] if len(of) else 0)
            run = np.searchsorted(covered[1:], target, "right")
            inside = run < edges[of + 1]
            run = np.minimum(run, len(covered) - 1)
            place = along[run] - along[edges[of]] + target - covered[run]
            known = pc.is_valid(batch.column(pos)).to_numpy(zero_copy_only=False)[of] & inside
            at = pc.fill_null(batch.column(pos).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)[of] + place
            base = pa.array((data[mismatch] & 0xDF).astype(np.uint8).view("S1")).cast(pa.string())
            taken = pa.array(of)
            columns = [c.take(taken) for c in batch.columns[:n_columns]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(at, pa.int64(), mask=~known), base], [*batch.schema.names[:n_columns], "ref_pos", "base"]
            )

    return locate


def counted_sites(locate):
    """Function for ``mapInArrow``: batches (sample, chrom, pos, cigar, md) to (sample, chrom, ref_pos, base, n).

    Equal sites of a batch are one row, so that many reads on one spot are few rows.
    """

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for sites in locate(batches):
            if not sites.num_rows:
                continue
            codes = [sites[c].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for c in ("sample", "chrom", "base")]
            at = pc.fill_null(sites["ref_pos"], -(1 << 62)).to_numpy(zero_copy_only=False)
            order = np.lexsort((*codes, at))
            new = np.zeros(len(order), bool)
            for values in (*codes, at):
                new[1:] |= values[order][1:] != values[order][:-1]
            new[0] = True
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(order)))
            columns = [sites[c].take(pa.array(order[first])) for c in ("sample", "chrom", "ref_pos", "base")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], ["sample", "chrom", "ref_pos", "base", "n"])

    return count


def mismatch_positions(alignments: DataFrame) -> DataFrame:
    """``alignments(pos, cigar, md, ...)`` with (ref_pos, base), one row for each mismatch.

    ``ref_pos`` is null beyond the blocks of the alignment, and without a position or CIGAR.
    """
    names = alignments.columns
    added = [T.StructField("ref_pos", T.LongType()), T.StructField("base", T.StringType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in alignments.schema.fields] + added)
    kept = alignments.where(mismatches("md") > 0)
    return kept.mapInArrow(located(len(names), *(names.index(c) for c in ("pos", "cigar", "md"))), schema)
