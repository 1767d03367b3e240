"""Quality rule: repetition inside a text by suffix array.

The suffixes of a text's words are sorted by prefix doubling, many texts of a batch at
once. Each suffix sits in one deepest longest-common-prefix interval; its depth is the
longest prefix that occurs elsewhere in the text. Where the word before can't be taken
in as well, this is an occurrence of a maximal repeated substring. The union of those of
``min_words`` words or more gives the covered share of the text's word characters, the
longest gives the longest repeat; both are limited.

Defined results: a null text has no words; a text under ``floor`` words fails the base
rules whatever its repeats; a single text may be of any length (its arrays take about
a hundred bytes a word); rows are judged one by one, so repeated rows and ties get equal
answers, and an empty table gives none. Other columns pass through, those named like
a result give way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, texts

SYMBOLS = b"#*$%&|<>"

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_repeats long,"
    " longest_repeat long, covered_chars long, base_failed boolean, kept boolean"
)

#: Words that are sorted together.
TOGETHER = 400_000


@dataclass(frozen=True)
class Limits:
    min_words: int = 8  # shorter repeats are ordinary language
    max_covered: float = 0.3  # share of the word characters inside repeats
    max_longest: int = 50  # words of the longest repeat: longer ones are passages, not phrases
    floor: int = 50  # words of the shortest text that passes
    window: int = 3
    max_window_share: float = 0.5


def deepest_intervals(codes: np.ndarray) -> np.ndarray:
    """Per position, the length of the longest prefix of its suffix that occurs elsewhere.

    ``codes`` are whole numbers from zero, the last of them unique. Suffix ranks are
    refined for 1, 2, 4, ... symbols until all differ; only suffixes of equal rank are
    sorted again. The ranks of each step then give the common prefix of neighbours in
    the suffix array.
    """
    n = len(codes)
    counts = np.bincount(codes)
    rank = (np.cumsum(counts) - counts)[codes]
    active = np.flatnonzero(counts[codes] > 1)
    levels = [(1, rank.astype(np.int32))]
    step = 1
    while len(active):
        key = rank[active] * np.int64(n + 1) + rank[active + step]
        order = np.argsort(key)
        active, key = active[order], key[order]
        old = rank[active]
        at = np.arange(len(active))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        fresh = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[active] = old + first - group
        alone = fresh & np.r_[fresh[1:], True]
        active = active[~alone]
        step *= 2
        levels.append((step, rank.astype(np.int32)))
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, np.int64)
    near = np.flatnonzero(levels[0][1][left] == levels[0][1][right])
    a, b, found = left[near], right[near], common[near]
    for size, ranks in reversed(levels):
        same = ranks[a] == ranks[b]
        a[same] += size
        b[same] += size
        found[same] += size
    common[near] = found
    depth = np.zeros(n, np.int64)
    depth[suffixes[:-1]] = common
    depth[suffixes[1:]] = np.maximum(depth[suffixes[1:]], common)
    return depth


def covered(depth: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Which positions lie in ``[i, i + size[i])`` of any i with ``size[i]`` over zero."""
    n = len(depth)
    starts = np.flatnonzero(size) if isinstance(size, np.ndarray) else np.flatnonzero(depth >= size)
    ends = starts + (size[starts] if isinstance(size, np.ndarray) else size)
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


def spans_of(depth: np.ndarray, min_words: int) -> np.ndarray:
    """Per position the words of the maximal repeat that begins there, or zero.

    A repeat at i is not maximal there if the one at i - 1 holds it whole.
    """
    held = np.r_[False, depth[:-1] == depth[1:] + 1]
    return np.where((depth >= min_words) & ~held, depth, 0)


def sorted_together(many: list[list[bytes]]) -> list[np.ndarray]:
    """``deepest_intervals`` of several texts' words; repeats are sought inside each text only."""
    coded, offset = [], 0
    for words in many:
        seen: dict[bytes, int] = {}
        own = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
        coded += [own + offset, np.array([offset + len(seen)])]
        offset += len(seen) + 1
    depth = deepest_intervals(np.concatenate(coded))
    ends = np.cumsum([len(words) + 1 for words in many])
    return [depth[end - len(words) - 1 : end - 1] for end, words in zip(ends, many)]


def char_counts(words: list[bytes]) -> np.ndarray:
    """Code points of each word: its bytes without those that continue a code point."""
    joined = np.frombuffer(b" ".join(words), np.uint8)
    heads = np.r_[0, np.cumsum((joined & 0xC0) != 0x80)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return heads[ends] - heads[np.r_[0, ends[:-1] + 1]]


def judged(text: bytes, words: list[bytes], depth: np.ndarray, limits: Limits) -> tuple:
    n = len(words)
    chars = char_counts(words) if n else np.zeros(0, np.int64)
    total = int(chars.sum())
    lines = [x for x in text.split(b"\n") if x.strip(WHITE.encode())] if b"\n" in text else []
    repeat_words = int(covered(depth, limits.window).sum()) if n else 0
    spans = spans_of(depth, limits.min_words) if n else depth
    longest = int(spans.max()) if n else 0
    inside = int(chars[covered(depth, spans)].sum()) if longest else 0
    failed = n < limits.floor or repeat_words > limits.max_window_share * n
    kept = not failed and inside <= limits.max_covered * total and longest <= limits.max_longest
    return (
        n,
        total,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words,
        int(np.count_nonzero(spans)),
        longest,
        inside,
        failed,
        kept,
    )


def judge(column: pa.Array, limits: Limits) -> pa.Array:
    out: list[tuple] = []
    batch: list[tuple[bytes, list[bytes]]] = []
    held = 0

    def flush() -> None:
        depths = sorted_together([words for _, words in batch])
        out.extend(judged(text, words, depth, limits) for (text, words), depth in zip(batch, depths))
        batch.clear()

    for text in texts(column):
        words = text.split()
        batch.append((text, words))
        held += len(words) + 1
        if held >= TOGETHER:
            flush()
            held = 0
    if batch:
        flush()
    columns = list(zip(*out)) or [()] * 10
    kinds = [pa.int64()] * 8 + [pa.bool_()] * 2
    names = [x.split()[0] for x in RESULT.split(",")]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def repeat_spans(text: str | None, min_words: int = 8) -> list[tuple[int, int]]:
    """First word and number of words of each occurrence of a maximal repeat in one text."""
    words = (text or "").encode().split()
    if not words:
        return []
    spans = spans_of(sorted_together([words])[0], min_words)
    return [(int(i), int(spans[i])) for i in np.flatnonzero(spans)]


def suffix_repeats(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the counts and verdicts of ``RESULT``. Narrow: no shuffle."""

    def column(values: pa.Array) -> pa.Array:
        return judge(values, limits)

    rule = F.arrow_udf(column, RESULT)
    names = [x.split()[0] for x in RESULT.split(",")]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    found = docs.select(*others, rule(F.col(f"`{text}`")).alias("_repeats"))
    return found.select(*others, *[F.col(f"_repeats.{n}").alias(n) for n in names])
