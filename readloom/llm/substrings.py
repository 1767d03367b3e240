"""Substring dedup by level-wise doubling.

A window of ``window`` words whose word sequence starts earlier too (smaller document id,
or earlier in the same document) is a repeat, and the words it covers go. Which windows
repeat is found level by level, at ``base`` words, twice as many, and so on up to ``window``:
a window is looked at on a level only if the shorter windows in it repeat on all levels
before, so most positions drop out at the first level and no candidate is left at a
length that nothing repeats at.

The first level need not look at every position. Of the base windows inside a whole
window one is its seed, that with the smallest hash, the leftmost of equals; equal windows
have equal seeds at equal places, so a window with a seed that stands once stands once
itself. About one position in eight is a seed. On the way up, the seed grows to the right
where that stays inside the whole window, else to the left; again equal windows have equal
chains.

Each level is one aggregate by window hash with partial sums before the shuffle, so a
window in a third of all documents is one row per task. A window that stands once
hands its own place back to its document, where the chain through it ends; on the last
level each window hands back the first of its places, and whatever a document has besides
those is a repeat. Nothing is joined by hash, and no list of a window's places is made.
Texts are shuffled once by document id for the upper levels and the cut (exchanges that
are alike are reused). Hashes of upto the last level only choose candidates; on the last
one two hashes of 64 bits stand for a window.

Defined results: a null text has no words and stays null; a text under ``window`` words
stays whole; the text left is its kept words joined by one blank; rows with equal id and
text are one document, and each is cut alike; rows with equal ids and different texts are
documents ordered by hash of the text; a null id comes first; an empty table gives none.
Other columns pass through, those named like a result give way to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, checkpoint

#: Bytes of text that are hashed together.
BYTES_AT_ONCE = 1 << 22
#: Marks of a document are level * STRIDE + word.
STRIDE = 1 << 40
RESULT = ("n_words", "n_removed", "removed")

_BLANK = np.zeros(256, bool)
_BLANK[list(WHITE.encode())] = True
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of each word, taken eight bytes at a time over all words together."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    left = ends - starts
    hashes = mixed(left.astype(np.uint64) * _ODD[0])
    of, at = np.arange(len(starts)), starts
    while len(of):
        lane = eight[at] & _LOW_BYTES[np.minimum(left, 8)]
        hashes[of] = mixed(hashes[of] * _ODD[1] + lane)
        on = left > 8
        of, at, left = of[on], at[on] + 8, left[on] - 8
    return hashes


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of each ``width`` consecutive values, the first of equals."""
    low, best, size = values, np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        later = low[step:] < low[:-step]
        low = np.where(later, low[step:], low[:-step])
        best = np.where(later, best[step:], best[:-step])
        size += step
    return best


class Windows:
    """The whole windows of several texts, and the shorter ones inside each that must repeat too.

    ``data`` holds the texts one after another, ``edges`` where each begins and the last ends.
    """

    def __init__(self, data: np.ndarray, edges: np.ndarray, lengths: list[int]):
        self.lengths = lengths
        solid = ~_BLANK[data]
        outset = np.zeros(len(data) + 1, bool)
        outset[edges] = True
        begins, closes = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | outset[1:-1]
        closes[:-1] &= ~solid[1:] | outset[1:-1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(starts, edges[:-1])
        self.counts = np.diff(np.r_[self.first, len(starts)])
        self.total = len(starts)
        many = np.maximum(self.counts - lengths[-1] + 1, 0)
        self.whole = np.repeat(self.first - np.cumsum(many) + many, many) + np.arange(many.sum())
        words = word_hashes(data, starts, ends) if len(self.whole) else np.zeros(0, np.uint64)
        self.hashes = [self.base(words, lengths[0], family) for family in (0, 1)]
        self.subs = self.chains()

    def base(self, words: np.ndarray, length: int, family: int) -> np.ndarray:
        found = np.zeros(max(len(words) - length + 1, 0), np.uint64)
        for i in range(length):
            found = found * _ODD[2 + family] + words[i : i + len(found)]
        return mixed(found)

    def doubled(self, hashes: np.ndarray, length: int, family: int) -> np.ndarray:
        """Hashes of windows of twice the length from those of their halves."""
        return mixed(hashes[:-length] * _ODD[family] + hashes[length:])

    def chains(self) -> list[np.ndarray]:
        """For each level the start of the window of that length inside each whole window."""
        if not len(self.whole):
            return [self.whole] * len(self.lengths)
        window = self.lengths[-1]
        at = leftmost_minimum(self.hashes[0], window - self.lengths[0] + 1)[self.whole]
        subs = [at]
        for length in self.lengths[1:]:
            at = np.where(at + length <= self.whole + window, at, at - length // 2)
            subs.append(at)
        subs[-1] = self.whole
        return subs

    def alive(self, marks: np.ndarray, level: int) -> np.ndarray:
        """Which whole windows have no mark on the levels before ``level``. Marks are of words of all texts."""
        left = np.ones(len(self.whole), bool)
        for below in range(level):
            ended = np.zeros(self.total + 1, bool)
            ended[marks[marks // STRIDE == below] % STRIDE] = True
            left &= ~ended[self.subs[below]]
        return left

    def candidates(self, marks: np.ndarray, level: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Starts of the windows to be looked at on this level, and one hash of them, two on the last level."""
        wanted = np.zeros(self.total + 1, bool)
        wanted[self.subs[level][self.alive(marks, level)]] = True
        at = np.flatnonzero(wanted)
        if not len(at):
            return at, [np.zeros(0, np.uint64)] * 2
        found = []
        for family in (0, 1) if level == len(self.lengths) - 1 else (0,):
            hashes = self.hashes[family]
            for length in self.lengths[:level]:
                hashes = self.doubled(hashes, length, family)
            found.append(hashes[at])
        return at, found

    def repeats(self, marks: np.ndarray) -> np.ndarray:
        """Words that repeated windows cover; marks on the last level are of first places."""
        last = len(self.lengths) - 1
        again = self.alive(marks, last)
        first = np.zeros(self.total + 1, bool)
        first[marks[marks // STRIDE == last] % STRIDE] = True
        begin = self.whole[again & ~first[self.whole]]
        edge = np.zeros(self.total + 1, np.int64)
        edge[begin] += 1
        edge[begin + self.lengths[-1]] -= 1  # in a text, two repeats differ in their begin and end
        return np.cumsum(edge)[:-1] > 0


def slices(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, edges) of runs of texts of about ``BYTES_AT_ONCE``, one text at least; null is empty."""
    if not len(text):
        return
    text = text.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    begin = 0
    while begin < len(text):
        end = int(np.searchsorted(offsets, offsets[begin] + BYTES_AT_ONCE, "right")) - 1
        end = min(max(end, begin + 1), len(text))
        yield begin, end, data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def marks_of(marks: pa.Array | None, begin: int, end: int, windows: Windows) -> np.ndarray:
    """Marks of rows ``begin`` to ``end`` with words counted over all their texts."""
    if marks is None:
        return np.zeros(0, np.int64)
    cut = marks[begin:end]
    own = cut.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = cut.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return own + np.repeat(windows.first, sizes)


def emitter(lengths: list[int], level: int, n_keys: int, schema: pa.Schema | None = None) -> Callable:
    """From batches (key columns, text, marks if any) to (key columns, pos, h1 and on the last level h2)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(n_keys)
            marks = batch.column(n_keys + 1) if batch.num_columns > n_keys + 1 else None
            for begin, end, data, edges in slices(text):
                windows = Windows(data, edges, lengths)
                at, hashes = windows.candidates(marks_of(marks, begin, end, windows), level)
                if not len(at):
                    continue
                of = np.searchsorted(windows.first, at, "right") - 1
                rows = pa.array(of + begin)
                columns = [batch.column(i).take(rows) for i in range(n_keys)]
                columns.append(pa.array((at - windows.first[of]).astype(np.int32)))
                columns += [pa.array(h.view(np.int64)) for h in hashes]
                names = [*batch.schema.names[:n_keys], "pos", "h1", "h2"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return emit


def cutter(lengths: list[int]):
    """Arrow function of a text and its marks: what is left of it, number of words, and spans that go."""
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    kind = pa.struct([("text", pa.string()), ("n_words", pa.int32()), ("removed", pa.list_(span))])

    def cut(texts: pa.Array, marks: pa.Array) -> pa.Array:
        found = []
        for begin, end, data, edges in slices(texts):
            windows = Windows(data, edges, lengths)
            gone = windows.repeats(marks_of(marks, begin, end, windows))
            turns = np.flatnonzero(np.diff(np.r_[False, gone, False]))
            for i in range(end - begin):
                first, count = int(windows.first[i]), int(windows.counts[i])
                value = texts[begin + i].as_py()
                words = (value or "").encode().split()
                low, high = np.searchsorted(turns, [first, first + count])
                # Runs of two texts that touch are one run; its ends are then outside this text.
                if high > low or (count and gone[first]):
                    own = gone[first : first + count]
                    words = [w for w, out in zip(words, own.tolist()) if not out]
                    ends = np.flatnonzero(np.diff(np.r_[False, own, False]))
                    spans = [{"first": a, "last": b - 1} for a, b in ends.reshape(-1, 2).tolist()]
                else:
                    spans = []
                found.append(
                    {"text": None if value is None else b" ".join(words).decode(), "n_words": count, "removed": spans}
                )
        return pa.array(found, kind)

    return F.arrow_udf(cut, "text string, n_words int, removed array<struct<first: int, last: int>>")


def levels(base: int, window: int) -> list[int]:
    lengths = [base]
    while lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    assert base > 0 and lengths[-1] == window, "window must be base doubled some times"
    return lengths


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, base: int = 5
) -> DataFrame:
    """``docs`` with the text cut, and columns n_words, n_removed and removed (spans of words)."""
    lengths = levels(base, window)
    own, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    # Ids that stand once name a document; else the text's hash is needed too, and costs eight bytes a row.
    unique = docs.groupBy(own).count().where("count > 1").isEmpty()
    key = ["id"] if unique else ["id", "version"]
    others = [c for c in docs.columns if c not in RESULT]
    rest = F.struct(*[F.col(f"`{c}`") for c in others if c not in (text, doc_id)])
    version = [] if unique else [F.xxhash64(body).alias("version")]
    slim = docs.select(own.alias("id"), *version, body.alias("text"))
    whole = docs.select(own.alias("id"), *version, body.alias("text"), *[rest.alias("row")] * (len(others) > 2))
    place = [slim.schema[k] for k in key]

    def with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
        # A document that many rows repeat must be split; adaptive execution can if the marks are dealt out
        # anew. If ids stand once, no key is hot, and the marks stay where their aggregate put them.
        renamed = marks.withColumnsRenamed({k: f"of_{k}" for k in key})
        renamed = renamed if unique else renamed.hint("rebalance")
        same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in key]
        return rows.join(renamed, same, "left").drop(*[f"of_{k}" for k in key])

    marks = None
    for level, length in enumerate(lengths):
        last = length == window
        rows = slim if marks is None else with_marks(slim, marks)
        hashes = ["h1", "h2"] if last else ["h1"]
        fields = [*place, T.StructField("pos", T.IntegerType()), *[T.StructField(h, T.LongType()) for h in hashes]]
        found = rows.mapInArrow(emitter(lengths, level, len(key)), T.StructType(fields))
        if last:
            at = found.groupBy(*hashes).agg(F.min(F.struct(*key, "pos")).alias("at")).select("at.*")
        else:
            single = [F.min(c).alias(c) for c in (*key, "pos")]
            at = found.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n"), *single).where("n = 1")
        mark = (F.col("pos") + F.lit(level * STRIDE)).alias("mark")
        new = at.select(*key, mark).groupBy(*key).agg(F.collect_list("mark").alias("marks"))
        if marks is not None:
            new = marks.unionByName(new).groupBy(*key).agg(F.flatten(F.collect_list("marks")).alias("marks"))
        marks = checkpoint(new) if level == 0 and not last else new
    met = with_marks(whole, marks).withColumn("cut", cutter(lengths)(F.col("text"), F.col("marks")))
    gone = F.aggregate("cut.removed", F.lit(0), lambda n, s: n + s["last"] - s["first"] + 1)
    back = {text: F.col("cut.text"), doc_id: F.col("id")}
    return met.select(
        *[(back.get(c) if c in back else F.col("row").getField(c)).alias(c) for c in others],
        F.col("cut.n_words").alias("n_words"),
        gone.alias("n_removed"),
        F.col("cut.removed").alias("removed"),
    )
