"""License scan: winnowed template fingerprints pick candidates, banded alignment reports them.

Templates are cut into ``gram`` words; of every ``window`` neighbouring grams the one with
the smallest hash is a fingerprint, so any stretch of ``gram + window - 1`` template words
holds one. An inverted index leads from a fingerprint to templates and positions. All
grams of a text are looked up in it, whatever the text's length. Hits of one template
whose diagonals (place in text less place in template) lie within ``band`` are a candidate;
each is aligned locally inside a band around its diagonals: 2 for equal words, -1 for an
unequal or missing one. Reported is what covers enough of the template: share of its
words, and the span in the text. What lies before and after an alignment is aligned again
as long as it holds hits, so a candidate gives as many matches as stand in it.
Of templates of up to ``whole_up_to`` words those alignments count that match every word and leave none
out between them. Of a longer one's alignments those count that hold its deciding words, and no
words of a licence that contains it. A stretch that lacks words of either kind is not aligned.

Defined results: null and empty texts have no matches; of matches whose spans overlap the
one with more matched words stands, ties go to the greater coverage, then the earlier name;
a licence stated twice is two matches; rows are scanned one by one, so repeated rows get
equal answers; an empty table gives none. Other columns pass through, ``licenses``
gives way to the result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of licences, and the words by which texts state or contain them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    ),
)

GNU_NOTICE = """This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public
    License as published by the Free Software Foundation, either version {version} of the License, or (at your option)
    any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
    even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License
    for more details."""
GNU_TITLE = """GNU {kind} PUBLIC LICENSE Version {version}, {date} Free Software Foundation, Inc. Everyone is permitted to copy
    and distribute verbatim copies of this license document, but changing it is not allowed."""
GNU = (
    ("GPL-2.0", "General", "2", "June 1991 Copyright (C) 1989, 1991"),
    ("GPL-3.0", "General", "3", "29 June 2007 Copyright (C) 2007"),
    ("LGPL-2.0", "Library General", "2", "June 1991 Copyright (C) 1991"),
    ("LGPL-2.1", "Lesser General", "2.1", "February 1999 Copyright (C) 1991, 1999"),
    ("LGPL-3.0", "Lesser General", "3", "29 June 2007 Copyright (C) 2007"),
    ("AGPL-3.0", "Affero General", "3", "19 November 2007 Copyright (C) 2007"),
)
BSD = TEMPLATES[7][1] + " {third}"
ADVERTISING = """All advertising materials mentioning features or use of this software must display the following
    acknowledgement: This product includes software developed by the organization. """
ENDORSING = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
CC_PARTS = {"SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
CC_TEXT = """Creative Commons {kind} 4.0 International Public License By exercising the Licensed Rights (defined below), You
    accept and agree to be bound by the terms and conditions of this Creative Commons {kind} 4.0 International Public
    License ("Public License"). To the extent this Public License may be interpreted as a contract, You are granted the
    Licensed Rights in consideration of Your acceptance of these terms and conditions"""


def cc_name(kind: str) -> str:
    return "-".join(["Attribution", *(CC_PARTS[part] for part in kind.split("-")[1:])])


SIBLINGS = (
    *[
        (name, GNU_NOTICE.format(what=what, kind=kind, version=version))
        for name, kind, version, _ in GNU
        for what in ("program", "library")
    ],
    *[(name, GNU_TITLE.format(kind=kind, version=version, date=date)) for name, kind, version, date in GNU],
    *[
        (name, f"This work is licensed under the GNU {kind} Public License, version {version}.")
        for name, kind, version, _ in GNU
    ],
    ("BSD-3-Clause", BSD.format(third=ENDORSING)),
    ("BSD-4-Clause", BSD.format(third=ADVERTISING + ENDORSING)),
    # MIT-0 is MIT without the sentence that asks for the notice.
    ("MIT-0", re.sub(r",\s+subject to the following conditions.*?portions of the\s+Software", "", TEMPLATES[2][1], flags=re.S)),
    (
        "Apache-2.0",
        """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,
        REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use,
        reproduction, and distribution as defined by Sections 1 through 9 of this document.""",
    ),
    (
        "MPL-2.0",
        """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity
        that creates, contributes to the creation of, or owns Covered Software.""",
    ),
    *[(f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}.") for kind in CC_KINDS for version in CC_VERSIONS],
    *[
        (f"CC-{kind}-{version}", f"This work is licensed under a Creative Commons {name} {version} {area} License.")
        for kind in CC_KINDS
        for version, area in CC_VERSIONS.items()
        for name in dict.fromkeys([cc_name(kind), cc_name(kind).replace("Derivatives", "Derivs")])
    ],
    *[(f"CC-{kind}-4.0", CC_TEXT.format(kind=cc_name(kind))) for kind in CC_KINDS],
)
TEMPLATES += tuple(
    own for own in SIBLINGS if " ".join(own[1].lower().split()) not in {" ".join(x.lower().split()) for _, x in TEMPLATES}
)

#: Words that tell a licence from its siblings: all of these must stand in a match of a long template.
DECIDING = {
    "Apache-2.0": ("apache license version 2.0",),
    "MPL-2.0": ("mozilla public license", "2.0"),
    "ISC": ("copyright notice and this permission notice appear in all copies",),
    "BSD-3-Clause": ("neither the name",),
    "BSD-4-Clause": ("all advertising materials mentioning", "neither the name"),
    **{name: (f"gnu {kind.lower()} public license", f"version {version}") for name, kind, version, _ in GNU},
    **{f"CC-{kind}-4.0": (f"creative commons {cc_name(kind).lower()} 4.0 international",) for kind in CC_KINDS},
}
#: Words of licences that contain another: none of these may stand in its match or in the ``AFTER`` words after it.
EXCLUDING = {
    "BSD-2-Clause": ("neither the name", "all advertising materials", "used to endorse or promote"),
    "BSD-3-Clause": ("all advertising materials",),
    "MIT": ("used for good not evil", "except as contained in this notice the name"),
}
AFTER = 60

EDGE = ".,;:!?\"'()[]{}<>*#/"
MATCH = "license string, coverage double, matched_words int, first_char int, end_char int"
RESULT = f"array<struct<{MATCH.replace(' string', ': string').replace(' double', ': double').replace(' int', ': int')}>>"
WORD = re.compile(r"\S+")
REMEMBERED = 300_000
#: What a step of the score counts in a cell of an alignment; templates have fewer words.
ONE = 1 << 12
EMPTY = -2


@dataclass(frozen=True)
class Settings:
    gram: int = 3
    window: int = 2
    band: int = 12
    least_coverage: float = 0.75
    whole_up_to: int = 15  # words of templates that must match whole


def normal(word: str) -> str:
    """The word as it is compared; what has no letter or digit is the empty word, which is passed over."""
    own = word.lower().strip(EDGE)
    return own if any(c.isalnum() for c in own) else ""


class Scanner:
    """Templates as numbers, and the inverted index of their fingerprints."""

    def __init__(self, templates=TEMPLATES, settings: Settings = Settings()):
        self.settings, self.names = settings, [name for name, _ in templates]
        self.numbers: dict[str, int] = {}
        self.known: dict[str, int] = {}
        self.templates = []
        for _, text in templates:
            words = [w for w in map(normal, text.split()) if w]
            self.templates.append([self.numbers.setdefault(w, len(self.numbers)) for w in words])
        self.deciding, self.excluding = (
            {
                name: [[self.numbers.setdefault(w, len(self.numbers)) for w in phrase.split()] for phrase in phrases]
                for name, phrases in by_name.items()
            }
            for by_name in (DECIDING, EXCLUDING)
        )
        self.amounts = [np.bincount(codes, minlength=len(self.numbers)) for codes in self.templates]
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, codes in enumerate(self.templates):
            grams = self.grams(np.array(codes))
            mixed = (grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)
            width = min(settings.window, len(grams))
            chosen = {i + int(np.argmin(mixed[i : i + width])) for i in range(len(grams) - width + 1)}
            for place in sorted(chosen):
                self.index[int(grams[place])].append((number, place))
        self.fingerprints = np.array(sorted(self.index), np.int64)

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """A number for each gram of known words, -1 for others. Numbers below 2^63 as there are few words."""
        n = max(0, len(codes) - self.settings.gram + 1)
        out, good = np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(self.settings.gram):
            own = codes[i : i + n]
            out = out * len(self.numbers) + own if i else own.astype(np.int64)
            good &= own >= 0
        return np.where(good, out, -1)

    def code(self, word: str) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        own = normal(word)
        self.known[word] = number = self.numbers.get(own, -1) if own else EMPTY
        return number

    def stretches(self, codes: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
        """(template, its hits that belong together as (diagonal, place in the text), in order)."""
        grams = self.grams(codes)
        at = np.searchsorted(self.fingerprints, grams)
        hit = (grams >= 0) & (at < len(self.fingerprints))
        hit[hit] = self.fingerprints[at[hit]] == grams[hit]
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for place in np.flatnonzero(hit).tolist():
            for number, own in self.index[int(grams[place])]:
                hits[number].append((place - own, place))
        out = []
        for number, found in hits.items():
            found.sort()
            begin = 0
            for i in range(1, len(found) + 1):
                d = found[i][0] if i < len(found) else None
                last, low = found[i - 1][0], found[begin][0]
                if d is None or d - last > self.settings.band or d - low > 4 * self.settings.band:
                    out.append((number, found[begin:i]))
                    begin = i
        return out

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, lowest, highest diagonal) of hits that belong together."""
        return [(number, hits[0][0], hits[-1][0]) for number, hits in self.stretches(codes)]

    def align(
        self, codes: np.ndarray, number: int, low: int, high: int, first: int = 0, end: int | None = None
    ) -> tuple[int, int, int]:
        """Best local alignment of words ``first`` to ``end`` in the band: matched words, its first and end word."""
        stop = len(codes) if end is None else end
        template, band = self.templates[number], self.settings.band
        width, start = high - low + 2 * band + 1, low - band
        # A cell is one number, score * ONE + matches, with where it began and where its last match ended.
        above, began, ended = np.zeros((3, width + 1), np.int64)
        places = np.arange(width)
        steps, fresh = places * ONE, np.ones(width, bool)
        best, found = 0, (0, 0, 0)
        for i, word in enumerate(template):
            k, until = max(0, first - i - start), min(width, stop - i - start)
            row, row_began, row_ended = np.zeros((3, width + 1), np.int64)
            if k < until:
                place = places[k:until] + (i + start)
                same = codes[i + start + k : i + start + until] == word
                before = above[k:until]
                cell = np.where(same, before + 2 * ONE + 1, before - ONE)
                begin = np.where(same & (before % ONE == 0), place, began[k:until])
                end_ = np.where(same, place + 1, ended[k:until])
                down = above[k + 1 : until + 1] - ONE
                use = down > cell
                np.copyto(cell, down, where=use)
                np.copyto(begin, began[k + 1 : until + 1], where=use)
                np.copyto(end_, ended[k + 1 : until + 1], where=use)
                # From the left a cell comes at ONE less a step: a running maximum of what is raised by its place.
                size = until - k
                raised = cell + steps[:size]
                top = np.maximum.accumulate(raised)
                np.greater_equal(raised[1:], top[:-1], out=fresh[1:size])
                source = np.maximum.accumulate(places[:size] * fresh[:size])
                cell = top - steps[:size]
                live = cell >= ONE
                np.copyto(row[k:until], cell, where=live)
                np.copyto(row_began[k:until], begin[source], where=live)
                np.copyto(row_ended[k:until], end_[source], where=live)
                peak = k + int(row[k:until].argmax())
                if row[peak] > best:
                    best = int(row[peak])
                    found = (best % ONE, int(row_began[peak]), int(row_ended[peak]))
            above, began, ended = row, row_began, row_ended
        return found

    def decided(self, codes: np.ndarray, number: int, begin: int, end: int) -> bool:
        """Whether the words are the template's own licence and not a sibling's."""
        name, words = self.names[number], codes[begin : end + AFTER].tolist()

        def stands(phrase: list[int], within: int) -> bool:
            return any(words[i : i + len(phrase)] == phrase for i in range(within - len(phrase) + 1))

        if self.short(number):
            return end - begin == len(self.templates[number])
        own = all(stands(phrase, end - begin) for phrase in self.deciding.get(name, ()))
        return own and not any(stands(phrase, len(words)) for phrase in self.excluding.get(name, ()))

    def short(self, number: int) -> bool:
        """Whether a template must stand whole, word for word."""
        return len(self.templates[number]) <= self.settings.whole_up_to

    def hopeful(self, near: np.ndarray, number: int) -> bool:
        """Whether ``near`` has words enough in common with the template, and its deciding words: else no alignment counts."""
        many = len(self.templates[number])
        common = np.minimum(np.bincount(near[near >= 0], minlength=len(self.numbers)), self.amounts[number]).sum()
        if common < self.least(number) * many:
            return False
        phrases = () if self.short(number) else self.deciding.get(self.names[number], ())
        return all(
            len(near) >= len(p) and np.all([near[i : len(near) - len(p) + 1 + i] == w for i, w in enumerate(p)], axis=0).any()
            for p in phrases
        )

    def in_band(self, codes: np.ndarray, number: int, low: int, high: int, first: int, end: int) -> int:
        """How many of the template's words stand somewhere in their part of the band: no alignment there matches more."""
        template, start = np.array(self.templates[number]), low - self.settings.band
        width = high - low + 2 * self.settings.band + 1
        begin, until = start, start + len(template) + width - 1
        own = codes[max(begin, first) : max(min(until, end), 0)]
        left = max(begin, first) - begin
        padded = np.full(until - begin, EMPTY, np.int64)
        padded[left : left + len(own)] = own
        rows = np.lib.stride_tricks.sliding_window_view(padded, width)
        return int((rows == template[:, None]).any(axis=1).sum())

    def least(self, number: int) -> float:
        return 1.0 if self.short(number) else self.settings.least_coverage

    def offer(self, queue: list[tuple], codes: np.ndarray, number: int, hits: list, first: int, end: int) -> None:
        """Best alignment of words ``first`` to ``end`` into ``queue``; where it covers too little, those of both sides."""
        rest = [(first, end)]
        while rest:
            first, end = rest.pop()
            own = [h for h in hits if first <= h[1] <= end - self.settings.gram]
            if not own:
                continue
            low, high, many = own[0][0], own[-1][0], len(self.templates[number])
            near = codes[max(first, low - self.settings.band) : max(0, min(end, high + self.settings.band + many))]
            if not self.hopeful(near, number) or self.in_band(codes, number, low, high, first, end) < self.least(number) * many:
                continue
            matched, begin, stop = self.align(codes, number, low, high, first, end)
            coverage = matched / many
            if coverage >= self.least(number) and self.decided(codes, number, begin, stop):
                heappush(queue, (-matched, -coverage, self.names[number], begin, stop, number, own, first, end))
            elif matched:
                rest += [(first, begin), (stop, end)]

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """Matches (name, coverage, matched words, first and end character), in order of place."""
        words = text.split()
        known = self.known
        numbers = [known[w] if w in known else self.code(w) for w in words]
        codes = np.array(numbers, np.int64)
        places = np.flatnonzero(codes != EMPTY)
        codes = codes[places]
        queue: list[tuple] = []
        for number, hits in self.stretches(codes):
            self.offer(queue, codes, number, hits, 0, len(codes))
        begins: list[int] = []
        kept: list[tuple] = []  # in order of place, and apart
        while queue:
            match = heappop(queue)
            begin, end, number, hits, first, stop = match[3:]
            at = bisect_left(begins, begin)
            at -= at > 0 and kept[at - 1][4] > begin
            parted = at
            while parted < len(kept) and begins[parted] < end:
                parted += 1
            taken = [k[3:5] for k in kept[at:parted]] or [(begin, end)]
            if at == parted:
                begins.insert(at, begin)
                kept.insert(at, match[:5])
            for free, until in zip([first, *[e for _, e in taken]], [*[b for b, _ in taken], stop]):
                self.offer(queue, codes, number, hits, free, until)
        if not kept:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        return [(name, -share, -many, spans[places[begin]][0], spans[places[end - 1]][1]) for many, share, name, begin, end in kept]


def scan_documents(
    docs: DataFrame, text: str = "text", templates=TEMPLATES, settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with ``licenses``, the array of its matches. Narrow."""

    def column(values: pa.Array) -> pa.Array:
        scanner = Scanner(templates, settings)
        names = [x.split()[0] for x in MATCH.split(",")]
        kinds = [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
        rows = [[dict(zip(names, match)) for match in scanner.scan(value.as_py() or "")] for value in values]
        return pa.array(rows, pa.list_(pa.struct(list(zip(names, kinds)))))

    others = [F.col(f"`{c}`") for c in docs.columns if c != "licenses"]
    return docs.select(*others, F.arrow_udf(column, RESULT)(F.col(f"`{text}`")).alias("licenses"))
