"""Byte-level BPE by prefix dynamic programming, and decoding.

Every prefix of a byte string has one valid last token: the one token that ends there
and is compatible with the last token of the prefix before it. Two neighbours are
compatible if merging their bytes by rank would leave them as they are. A table of last
tokens gives the encoding by walking back from the end; bytes can be appended without
touching what is there, and after an edit only the entries near it are worked out anew:
once as many entries as the longest token has bytes agree with the old ones, so do all
after them.

Text is cut by the tokenizer's pattern first, each match encoded on its own; no special
tokens. Equal matches are remembered up to a bound.

Defined results: a null text is empty, and an empty text has no tokens; a text of any
length is encoded whole (its matches are in memory at once); repeated rows get equal
results; an empty table gives none. Other columns pass through, those named like a
result give way to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
KINDS = {"long": T.LongType(), "string": T.StringType(), "binary": T.BinaryType()}
#: Matches of a generation that a worker remembers, and a third of the pairs of tokens.
REMEMBERED = 120_000
#: Texts whose ids a worker holds.
ROWS_AT_ONCE = 256
NEVER = 1 << 60


def read_ranks(path: str) -> bytes:
    """A file of lines "base64-of-token rank"."""
    with open(path, "rb") as file:
        return file.read()


class Vocabulary:
    """Tokens by rank, and which of them can stand side by side."""

    def __init__(self, file: bytes, remembered: int | None = None):
        self.remembered_at_most = REMEMBERED if remembered is None else remembered
        lines = (line.split() for line in file.splitlines() if line.strip())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.token.values()))
        # Proper endings of tokens that are no tokens themselves.
        self.endings = {end for t in self.rank for i in range(1, len(t)) if (end := t[i:]) not in self.rank}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        # Two generations: what is not used until the younger one is full again is forgotten.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.spines: dict[tuple[int, int], list[tuple[bytes, int]]] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte or if no merges lead to it."""
        if token not in self.parts:
            pieces = [bytes([b]) for b in self.token[token]]
            while len(pieces) > 2:
                ranks = [self.rank.get(a + b, NEVER) for a, b in zip(pieces, pieces[1:])]
                at = ranks.index(min(ranks))
                if ranks[at] == NEVER:
                    break
                pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
            self.parts[token] = (self.rank[pieces[0]], self.rank[pieces[1]]) if len(pieces) == 2 else None
        return self.parts[token]

    def reachable(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self.halves(token) is not None

    def spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at the left (0) or right (1) edge while the token forms, each with the rank that ends it."""
        if (token, side) not in self.spines:
            edge, until, now = [], NEVER, token
            while True:
                edge.append((self.token[now], until))
                halves = self.halves(now)
                if halves is None:
                    break
                until, now = now, halves[side]
            self.spines[token, side] = edge
        return self.spines[token, side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge across the border comes before those that make ``a`` and ``b``.

        Of equal ranks the leftmost merges first: one inside ``a`` before the one across,
        that before one inside ``b``.
        """
        pair = a << 32 | b
        answer = self.pairs.get(pair)
        if answer is None:
            answer = True
            for left, until_left in self.spine(a, 1):
                for right, until_right in self.spine(b, 0):
                    across = self.rank.get(left + right)
                    if across is not None and across < until_left and across <= until_right:
                        answer = False
            if len(self.pairs) >= 3 * self.remembered_at_most:
                self.pairs.clear()
            self.pairs[pair] = answer
        return answer

    def encode_match(self, match: str) -> bytes:
        """Ids of one match of the pattern, as little-endian unsigned 32-bit integers."""
        whole = self.rank.get(data := match.encode())
        ids = [whole] if whole is not None and self.reachable(whole) else PrefixTable(self, data).ids()
        return struct.pack(f"<{len(ids)}I", *ids)

    def remembered(self, match: str) -> bytes:
        packed = self.known.get(match) or self.older.get(match) or self.encode_match(match)
        if len(self.known) >= self.remembered_at_most:
            self.known, self.older = {}, self.known
        self.known[match] = packed
        return packed

    def encode(self, matches: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join([known[m] for m in matches])
        except KeyError:
            return b"".join([known.get(m) or self.remembered(m) for m in matches])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class PrefixTable:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def extend(self, last: list[int], until: int) -> None:
        """Append to ``last`` up to the prefix of ``until`` bytes.

        Only one token fits, so the likeliest is tried first: the last one grown by a byte.
        """
        v, data = self.vocabulary, self.data
        rank, pairs, endings = v.rank.get, v.pairs.get, v.endings
        begin = len(last) - len(v.token[last[-1]]) if last else 0
        for end in range(len(last) + 1, until + 1):
            token = rank(data[begin:end])
            if token is not None:
                if not begin:
                    fits = v.reachable(token)
                else:
                    fits = pairs(last[begin - 1] << 32 | token)
                    if fits is None:
                        fits = v.compatible(last[begin - 1], token)
                if fits:
                    last.append(token)
                    continue
            start = end - 1
            while start >= 0:
                piece = data[start:end]
                token = rank(piece)
                if token is None:
                    if piece not in endings:
                        start = -1
                        break
                elif not start:
                    if v.reachable(token):
                        break
                else:
                    fits = pairs(last[start - 1] << 32 | token)
                    if v.compatible(last[start - 1], token) if fits is None else fits:
                        break
                start -= 1
            if start < 0:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            begin = start

    def append(self, more: bytes) -> None:
        """Longer data; no entry that is there changes."""
        self.data += more
        self.extend(self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` for the bytes from ``start`` to ``stop``; the number of entries worked out anew."""
        old = self.last
        self.data = self.data[:start] + new + self.data[stop:]
        last, shift, agreed = old[:start], stop - start - len(new), 0
        for end in range(start + 1, len(self.data) + 1):
            if agreed >= self.vocabulary.longest:
                last += old[end - 1 + shift :]
                break
            self.extend(last, end)
            same = end > start + len(new) and last[-1] == old[end - 1 + shift]
            agreed = agreed + 1 if same else 0
        else:
            end = len(self.data) + 1
        self.last = last
        return end - start - 1

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.token[out[-1]])
        return out[::-1]


def encode_documents(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    text: str = "text",
    keep_text: bool = True,
    keep_ids: bool = True,
    remembered: int | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``RESULT``: number of tokens, digest of their ids (little-endian
    unsigned 32-bit integers), digest of what these decode to, and the ids themselves.

    Rows go through in slices, so a worker holds few texts and their ids at a time. A worker remembers
    ``remembered`` matches of a generation (``REMEMBERED`` by default): fewer take less memory and more time.
    """
    # One object in each Python worker: what it has learned serves the worker's later tasks as well.
    shared = docs.sparkSession.sparkContext.broadcast({"file": ranks})
    results = [x.split() for x in RESULT.split(",")]
    names = [name for name, _ in results]
    others = [c for c in docs.columns if c not in names and (keep_text or c != text)]
    schema = T.StructType(
        [docs.schema[c] for c in others]
        + [T.StructField(n, KINDS[kind]) for n, kind in results if keep_ids or n != "ids"]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "vocabulary" not in held:
            held["vocabulary"] = Vocabulary(held.pop("file"), remembered)
        vocabulary, find = held["vocabulary"], regex.compile(pattern).findall
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()][: 3 + keep_ids]
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                rows = []
                for value in part.column(len(others)):
                    ids = vocabulary.encode(find(value.as_py() or ""))
                    decoded = hashlib.sha256(vocabulary.decode(ids)).hexdigest()
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded, ids)[: 3 + keep_ids])
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(others)], *columns], schema.names)

    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(encode, schema)
