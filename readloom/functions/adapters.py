"""Adapters in reads, with mismatches and cut off by the read's end, by bit-parallel matching.

A read's positions are the bits of 64-bit words. For each base there is one word of where it
stands; shifted by the offset of an adapter base it tells at once for 64 starts whether that base
agrees. Mismatches are counted in bit slices: three words hold the counters of 64 starts,
a fourth those that ran over. So an adapter of 33 bases costs some 300 word operations for
a read of up to 64 bases, over whole Arrow batches. Longer reads take several words, and
bits move in from the next one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mismatches that three bit slices can tell apart from too many.
MOST_MISMATCHES = 6


def allowed_mismatches(overlap: int, bases_for_one: int) -> int:
    """One mismatch for each ``bases_for_one`` bases compared, at most ``MOST_MISMATCHES``."""
    return min(overlap // bases_for_one, MOST_MISMATCHES)


def adapter_start(adapter: str, min_overlap: int = 6, bases_for_one: int = 8):
    """Arrow function: sequences -> number of bases before the adapter, or the whole length.

    The adapter begins at the first position from which its bases, as many as the read has left,
    agree but for one mismatch per ``bases_for_one`` of them; at least ``min_overlap``
    must be compared. Case counts, and any letter that differs is a mismatch, N too. The inner
    function carries no reference to this package.
    """
    if not 0 < min_overlap <= len(adapter):
        raise ValueError("min_overlap must be from 1 to the adapter's length")
    size = len(adapter)
    allowed = [allowed_mismatches(k, bases_for_one) for k in range(size + 1)]
    batch_bases = 1 << 24

    def starts(seqs: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        one, every = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)

        def below(n: np.ndarray) -> np.ndarray:
            """Words whose bits under ``n`` are set."""
            n = np.clip(n, 0, 64)
            return np.where(n == 64, every, (one << np.minimum(n, 63).astype(np.uint64)) - one)

        def found(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            words = np.maximum((lengths + 63) // 64, 1)
            first = np.cumsum(words) - words
            total = int(words.sum())
            place = np.arange(len(raw)) + np.repeat(first * 64 - (np.cumsum(lengths) - lengths), lengths)
            chunk = np.arange(total) - np.repeat(first, words)
            n = np.repeat(lengths, words)
            more = np.r_[chunk[1:] > 0, False]  # the next word is of the same read

            def packed(hits: np.ndarray) -> np.ndarray:
                bits = np.zeros(total * 64, np.uint8)
                bits[place] = hits
                return np.packbits(bits, bitorder="little").view("<u8")

            def shifted(word: np.ndarray, j: int) -> np.ndarray:
                whole, rest = divmod(j, 64)
                for _ in range(whole):
                    word = np.where(more, np.r_[word[1:], np.uint64(0)], np.uint64(0))
                if not rest:
                    return word
                after = np.where(more, np.r_[word[1:], np.uint64(0)], np.uint64(0))
                return (word >> np.uint64(rest)) | (after << np.uint64(64 - rest))

            base = {c: packed(raw == ord(c)) for c in set(adapter)}
            there = below(n - chunk * 64)
            count = [np.zeros(total, np.uint64) for _ in range(3)]
            over = np.zeros(total, np.uint64)
            for j, c in enumerate(adapter):
                carry = shifted(there, j) & ~shifted(base[c], j)
                for slot in range(3):
                    count[slot], carry = count[slot] ^ carry, count[slot] & carry
                over |= carry
            hit = np.zeros(total, np.uint64)
            for most in sorted(set(allowed[min_overlap:])):
                overlaps = [k for k in range(min_overlap, size + 1) if allowed[k] == most]
                # Starts whose overlap is one of these: from n - longest (from 0 for the whole adapter) to n - shortest.
                begin = 0 if overlaps[-1] == size else n - overlaps[-1]
                region = below(n - overlaps[0] + 1 - chunk * 64) & ~below(begin - chunk * 64)
                # At most ``most``: compare the three slices with the bits of the number.
                less, same = np.zeros(total, np.uint64), np.full(total, every)
                for slot in (2, 1, 0):
                    if most >> slot & 1:
                        less, same = less | (same & ~count[slot]), same & count[slot]
                    else:
                        same = same & ~count[slot]
                hit |= (less | same) & ~over & region
            at = np.bitwise_count((hit & (~hit + one)) - one).astype(np.int64) + chunk * 64
            at = np.where(hit != 0, at, np.iinfo(np.int64).max)
            return np.minimum(np.minimum.reduceat(at, first), lengths) if len(lengths) else lengths

        filled = pc.fill_null(seqs, "").cast(pa.large_binary())
        ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
        lengths = np.diff(ends)
        keep = [np.zeros(0, np.int64)]
        begin = 0
        while begin < len(lengths):
            end = max(int(np.searchsorted(ends, ends[begin] + batch_bases, "right")) - 1, begin + 1)
            end = min(end, len(lengths))
            keep.append(found(data[ends[begin] : ends[end]], lengths[begin:end]))
            begin = end
        return pa.array(np.concatenate(keep).astype(np.int32), mask=seqs.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(starts, "int")


def before_adapter_or_part(seq: str | Column, adapter: str, min_overlap: int = 6, bases_for_one: int = 8) -> Column:
    """Bases of ``seq`` before the adapter, a part of it at the read's end included."""
    return adapter_start(adapter, min_overlap, bases_for_one)(F.col(seq) if isinstance(seq, str) else seq)
