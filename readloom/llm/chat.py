"""Chat formatting with typed content parts.

A visitor flattens a turn's parts in order: text as it is, an image, audio clip or
document as a placeholder, whose reference, place and number of expanded tokens are
recorded. The template writes a turn as

    <|turn|>ROLE \\n CONTENT <|end|> \\n

and a conversation is its turns one after another, by turn number. Control strings
inside texts and roles are escaped by one more backslash between ``<`` and ``|``, which
reading back takes away; so whatever a text says, only the template's own marks count.
The loss mask is the content of assistant turns.

Turns are formatted one by one, without a shuffle; reading back needs a conversation's
turns in order and streams through them with running digests, so a conversation may have
any number of turns.

Defined results: null texts, roles and parts are empty; a null turn number comes first,
equal ones in the order of role and text, so repeated rows are turns of their own; a null
conversation id is a conversation; an unknown kind of part is an error; an empty table
gives none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
FORMATTED = re.compile(r"<\|turn\|>([^\n]*)\n(.*)<\|end\|>\n", re.DOTALL)
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
SEGMENT = (
    "segment string, content_start int, content_end int, in_loss boolean, text_chars int, expanded_tokens long,"
    " attachments array<struct<kind: string, ref: string, position: int, tokens: long>>"
)


def escape(text: str) -> str:
    return CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Costs:
    """Tokens that a placeholder stands for."""

    patch: int = 14  # pixels of an image's patch, either way
    per_second: float = 25.0  # of audio
    per_page: int = 512  # of a document


@dataclass
class Flattener:
    """Visits parts in order; afterwards holds the content and what it refers to."""

    costs: Costs
    content: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0
    text_chars: int = 0

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part.get('kind') or 'text'}", self.unknown)(part)

    def unknown(self, part: dict) -> None:
        raise ValueError(f"no such kind of content part: {part['kind']}")

    def add(self, text: str) -> None:
        self.content.append(text)
        self.length += len(text)

    def attach(self, part: dict, tokens: int) -> None:
        place = {"kind": part["kind"], "ref": part.get("ref"), "position": self.length, "tokens": tokens}
        self.attachments.append(place)
        self.add(f"<|{part['kind']}|>")

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.text_chars += len(text)
        self.add(escape(text))

    def visit_image(self, part: dict) -> None:
        across, down = (-(-(part.get(side) or 0) // self.costs.patch) for side in ("width", "height"))
        self.attach(part, max(1, across * down))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, max(1, math.ceil((part.get("seconds") or 0) * self.costs.per_second)))

    def visit_document(self, part: dict) -> None:
        self.attach(part, max(1, (part.get("pages") or 1) * self.costs.per_page))


def format_turn(role: str | None, parts: list[dict | None], costs: Costs = Costs()) -> dict:
    flat = Flattener(costs)
    for part in parts:
        flat.visit(part)
    head = f"{TURN}{escape_role(role or '')}\n"
    content = "".join(flat.content)
    start = len(head)
    return {
        "segment": head + content + END,
        "content_start": start,
        "content_end": start + len(content),
        "in_loss": role == "assistant",
        "text_chars": flat.text_chars,
        "expanded_tokens": sum(a["tokens"] for a in flat.attachments),
        "attachments": [a | {"position": a["position"] + start} for a in flat.attachments],
    }


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and content, both as they were before formatting; placeholders stay in the content."""
    found = FORMATTED.fullmatch(segment)
    if not found:
        raise ValueError(f"not a formatted turn: {segment[:80]!r}")
    return unescape_role(found[1]), unescape(found[2])


def format_turns(turns: DataFrame, role: str = "role", content: str = "text", costs: Costs = Costs()) -> DataFrame:
    """``turns`` with the columns of ``SEGMENT``. ``content`` is a string or an array of ``PART``."""

    def column(roles: pa.Array, contents: pa.Array) -> pa.Array:
        plain = not pa.types.is_list(contents.type)
        rows = []
        for who, what in zip(roles, contents):
            value = what.as_py()
            parts = [{"kind": "text", "text": value}] if plain else value or []
            rows.append(format_turn(who.as_py(), parts, costs))
        place = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int32()), ("tokens", pa.int64())])
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.list_(place)]
        return pa.array(rows, pa.struct(list(zip(names, kinds))))

    names = [x.split()[0] for x in re.sub("<.*>", "", SEGMENT).split(",")]
    written = F.arrow_udf(column, SEGMENT)
    others = [F.col(f"`{c}`") for c in turns.columns if c not in names]
    found = turns.select(*others, written(F.col(f"`{role}`"), F.col(f"`{content}`")).alias("_turn"))
    return found.select(*others, *[F.col(f"_turn.{n}").alias(n) for n in names])


class Reading:
    """Running counts and digests of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.whole, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, in_loss: bool, start: int, end: int) -> None:
        role, content = parse_turn(segment)
        self.turns += 1
        self.chars += len(segment)
        self.whole.update(f"{role}\n{content}\n".encode())
        if in_loss:
            learnt = unescape(segment[start:end])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode())

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.turns,
            self.whole.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame, conv_id: str = "conv_id", order: tuple[str, ...] = ("turn", "role")) -> DataFrame:
    """(``DIGEST``) of each conversation, from formatted turns alone.

    Turns stand in the order of the columns ``order`` (a null string is empty, other nulls come
    first), equal ones in that of their text, which the segment gives back.
    """
    key = F.col(f"`{conv_id}`").alias("conv_id")
    texts = {f.name for f in formatted.schema if f.dataType.simpleString() == "string"}
    columns = [F.coalesce(F.col(f"`{c}`"), F.lit("")) if c in texts else F.col(f"`{c}`") for c in order]
    places = [c.alias(f"place{i}") for i, c in enumerate(columns)]
    rows = formatted.select(key, *places, "segment", "in_loss", "content_start", "content_end")
    content = F.substr("segment", F.col("content_start") + 1, F.col("content_end") - F.col("content_start"))
    plain = F.regexp_replace(content, ESCAPED.pattern, "<$1|")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", *[f"place{i}" for i in range(len(order))], plain)
    rows = rows.select("conv_id", "segment", "in_loss", "content_start", "content_end")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Reading | None = None

        def written(done: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [x.split()[0] for x in DIGEST.split(",")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

        for batch in batches:
            done = []
            for conv, segment, in_loss, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.conv_id != conv:
                    if current is not None:
                        done.append(current.row())
                    current = Reading(conv)
                current.add(segment, in_loss, start, end)
            if done:
                yield written(done)
        if current is not None:
            yield written([current.row()])

    return rows.mapInArrow(read, DIGEST)
