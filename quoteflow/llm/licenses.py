"""License scan by conditional compression.

Candidate blocks are the words that licenses use with as many words on both sides as the longest
template may fill; blocks that meet are one. Stretches of a block, twice as long as a template may
fill, are compressed alone and with the template as a raw zstandard dictionary; a template goes on
only where its dictionary makes a stretch smaller. There it proposes ranges: at least ``similarity``
of its words stand in them in order, with as little else between, and none of its versions or
distinguishing words is missing. The proposals of all templates are ranked by the bytes that the
dictionary saves on the range; the first is confirmed, and a template whose proposal met a confirmed
range proposes again in what is left, until no proposal is open. ``exact`` has no difference in
wording at all, ``variant`` some; the differences and the saving are reported.

Everything happens in the document's task. Defined cases: null text counts as empty and has no
blocks; texts are scanned whole, positions are code points; equal savings go to the shorter template, then by name;
repeated rows are scanned one by one; an empty table gives an empty result; other columns are kept
unless a result has their name.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import re
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from quoteflow.llm.common import others, per_text

# Public license notices. The first word of a name is the license.
TEMPLATES = {
    "AGPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU Affero General Public License for more details."
    ),
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."
    ),
    "BSL-1.0 notice": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"
    ),
    "CC-BY-4.0 short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0 code": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 short": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-NC-4.0 code": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 code": "Licensed under CC BY-SA 4.0.",
    "EPL-2.0 notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "GPL-2.0 short": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1 notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "MIT short": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MIT full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Words a confirmed template may not lack, besides words with a digit.
TELLING = frozenset(
    "apache mit bsd gnu gpl isc mpl mozilla cc by nc sa nd noncommercial sharealike reserved unencumbered "
    "neither hereby affero lesser eclipse boost".split()
)

# Words of a cue may stand on two lines, with comment signs between them.
_CUE = re.compile(
    r"licen[cs]e|copyright|all rights reserved|permission|redistribut|warrant|creative commons|CC BY|"
    r"public domain|unencumbered|free software".replace(" ", "[^a-zA-Z0-9]+"),
    re.I | re.A,
)
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")

_SIMILARITY = 80
_LEVEL = 16  # tries all ways to cut a text into matches: the fast levels miss short ones
_SIZES = {"source_size": 4096, "dict_size": 1024}  # about a stretch and a template; no limits
_STARTS = 512  # ranges compared at once

FINDING = StructType(
    [
        StructField("license", StringType()),
        StructField("template", StringType()),
        StructField("verdict", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("saved_percent", LongType()),
        StructField("differences", StringType()),
    ]
)
FIELDS = [
    StructField("n_blocks", LongType()),
    StructField("n_confirmed", LongType()),
    StructField("licenses", StringType()),
    StructField("findings", ArrayType(FINDING)),
]


def words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0], *m.span()) for m in _WORD.finditer(text.translate(_LOWER))]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_ANY_WORD = re.compile(r"[a-zA-Z0-9]+(?:\.[0-9]+)*")


def _words_before(text: str, at: int, n: int, floor: int) -> int:
    """Where the ``n`` words before ``at`` begin, or ``floor`` if there are fewer behind it."""
    size = 16 * n
    while True:
        begin = max(floor, at - size)
        starts = [m.start() for m in _ANY_WORD.finditer(text, begin, at)]
        # The first one may be cut.
        if len(starts) > n:
            return starts[-n]
        if begin == floor:
            return floor
        size *= 2


def _words_after(text: str, at: int, n: int) -> int:
    """Where the ``n`` words behind ``at`` end, or the end of the text."""
    last = next(itertools.islice(_ANY_WORD.finditer(text, at), n - 1, None), None)
    return last.end() if last else len(text)


def blocks(text: str, margin: int) -> list[tuple[int, int]]:
    """Start and end of the candidate blocks: cues and ``margin`` words on both sides, merged where they meet."""
    found: list[tuple[int, int]] = []
    begin = end = -1
    held = None  # the last cue inside the block, whose margin was not added yet
    # One more word on both sides, as a cue may begin or end inside a word.
    for cue in _CUE.finditer(text):
        if held is not None and cue.start() > end:
            end, held = _words_after(text, held, margin + 1), None
        if end >= 0 and cue.start() <= end:
            held = cue.end()
            continue
        first = _words_before(text, cue.start(), margin + 1, max(0, end))
        if end >= 0 and first > end:
            found.append((begin, end))
            begin = first
        elif end < 0:
            begin = first
        end, held = _words_after(text, cue.end(), margin + 1), None
    if end >= 0:
        found.append((begin, end if held is None else _words_after(text, held, margin + 1)))
    return found


@dataclass
class _Template:
    name: str
    words: list[str]
    needed: frozenset[str]
    compressor: zstandard.ZstdCompressor
    weights: np.ndarray  # per known word, what a match with each word of the template counts
    member: np.ndarray  # per known word, whether the template has it
    all_needed: int  # needed words, each as often as it occurs
    longest: int  # words of the longest range that can be confirmed
    least: int  # matching words of a confirmed range


class Matcher:
    """The templates as dictionaries; one per task."""

    def __init__(self, templates: dict[str, str], similarity: int = _SIMILARITY):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            _LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **_SIZES
        )
        self.plain = zstandard.ZstdCompressor(compression_params=parameters)
        self.similarity = similarity
        self.templates = []
        texts = {name: [w for w, _, _ in words(text)] for name, text in sorted(templates.items())}
        self.known = {w: k for k, w in enumerate(sorted({w for own in texts.values() for w in own}))}
        for name, own in texts.items():
            data = zstandard.ZstdCompressionDict(
                " ".join(own).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            data.precompute_compress(compression_params=parameters)
            needed = frozenset(w for w in own if w in TELLING or any(c.isdigit() for c in w))
            # A needed word outweighs all others together.
            weights = np.zeros((len(self.known) + 1, len(own)), np.int32)
            for k, w in enumerate(own):
                weights[self.known[w], k] = 1 + (len(own) + 1) * (w in needed)
            self.templates.append(
                _Template(
                    name,
                    own,
                    needed,
                    zstandard.ZstdCompressor(dict_data=data, compression_params=parameters),
                    weights,
                    weights.any(axis=1),
                    sum(w in needed for w in own),
                    100 * len(own) // similarity,
                    -(-similarity * len(own) // 100),
                )
            )

        # A confirmed range is no longer than this, so it lies in the block of any of its cues.
        self.margin = max((t.longest for t in self.templates), default=0)

    def rank(
        self, block: list[tuple[str, int, int]], templates: list[_Template] | None = None
    ) -> list[tuple[int, _Template]]:
        """The templates, the one that saves most bytes first, with the bytes they save in percent.

        Case, punctuation and line breaks are no difference: words are compressed, not the raw text.
        """
        raw = " ".join(w for w, _, _ in block).encode()
        alone = len(self.plain.compress(raw))
        chosen = self.templates if templates is None else templates
        saved = [(alone - len(t.compressor.compress(raw)), t) for t in chosen]
        best = sorted(saved, key=lambda x: (-x[0], len(x[1].words), x[1].name))
        return [(100 * s // alone, t) for s, t in best]

    def _starts(self, ids: np.ndarray, template: _Template) -> np.ndarray:
        """Words where a confirmed range can begin: enough of the template's words stand behind them."""
        member = template.member[ids]
        before = np.concatenate([[0], np.cumsum(member)])
        ends = np.minimum(np.arange(len(ids)) + template.longest, len(ids))
        return np.flatnonzero(member & (before[ends] - before[:-1] >= template.least))

    def _ranges(
        self, ids: np.ndarray, template: _Template, starts: np.ndarray, stop: int
    ) -> list[tuple[int, int, int]]:
        """Matching words, length and start of the best confirmed range that begins at each of ``starts``.

        Longest common subsequences of the template and all ranges that end before ``stop``, where
        needed words come first: if all can be matched, they are.
        """
        size, unit, found = len(template.words), len(template.words) + 1, []
        for at in range(0, len(starts), _STARTS):
            part = starts[at : at + _STARTS]
            common = np.zeros((len(part), size + 1), np.int32)
            matched, length = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for k in range(min(template.longest, stop - int(part[0]))):
                where = part + k
                inside = where < stop
                weights = template.weights[np.where(inside, ids[np.minimum(where, len(ids) - 1)], -1)]
                longer = np.where(weights > 0, common[:, :-1] + weights, 0)
                np.maximum(longer, common[:, 1:], out=longer)
                np.maximum.accumulate(longer, axis=1, out=common[:, 1:])
                needed, now = np.divmod(common[:, -1], unit)
                better = (
                    inside
                    & (needed == template.all_needed)
                    & (100 * now >= self.similarity * max(size, k + 1))
                    & (now > matched)
                )
                matched[better], length[better] = now[better], k + 1
            found += [(int(m), int(n), int(s)) for m, n, s in zip(matched, length, part) if m]
        return found

    def _differences(self, have: list[str], template: _Template) -> str:
        own = template.words
        if have == own:
            return ""
        rows = [np.zeros(len(own) + 1, np.int64)]
        for i in ids_of(self.known, have):
            weights, last = template.weights[i], rows[-1]
            longer = np.maximum(np.where(weights > 0, last[:-1] + weights, 0), last[1:])
            rows.append(np.concatenate([[0], np.maximum.accumulate(longer)]))
        lacking, extra, i, k = [], [], len(have), len(own)
        while i or k:
            if i and k and have[i - 1] == own[k - 1]:
                i, k = i - 1, k - 1
            elif k and rows[i][k] == rows[i][k - 1]:
                k -= 1
                lacking.append(own[k])
            else:
                i -= 1
                extra.append(have[i])
        return " ".join([f"-{w}" for w in reversed(lacking)] + [f"+{w}" for w in reversed(extra)])

    def saving(self, have: list[str], template: _Template) -> tuple[int, int]:
        """Bytes that the template's dictionary saves on these words, and their size without it."""
        raw = " ".join(have).encode()
        alone = len(self.plain.compress(raw))
        return alone - len(template.compressor.compress(raw)), alone

    def _smaller(self, have: list[str], ids: np.ndarray, template: _Template, first: int, stop: int) -> np.ndarray:
        """Words in ``first`` to ``stop`` where a range can begin, of stretches that the dictionary makes smaller."""
        starts = self._starts(ids[first:stop], template)
        stretch, kept = starts // template.longest, []
        for k in np.unique(stretch).tolist():
            begin = first + k * template.longest
            kept.append(self.saving(have[begin : min(begin + 2 * template.longest, stop)], template)[0] > 0)
        return first + starts[np.repeat(kept, np.unique(stretch, return_counts=True)[1]).astype(bool)]

    def _apart(self, ids: np.ndarray, open_: list[tuple[int, int, int, int]], end: int):
        """Ranges (-matching words, length, start, template) that never overlap, and the templates tied for them.

        The range with the most matching words is taken first, of these the shortest, then the first;
        the others have what is left on both sides.
        """
        heapq.heapify(open_)
        taken: list[tuple[int, int]] = []
        while open_:
            best = heapq.heappop(open_)
            _, length, start, t = best
            place = bisect.bisect_right(taken, (start, end))
            if place and taken[place - 1][1] > start:
                continue
            stop = taken[place][0] if place < len(taken) else end
            if start + length > stop:
                template = self.templates[t]
                if stop - start >= template.least:
                    for m, n, s in self._ranges(ids, template, np.array([start]), stop):
                        heapq.heappush(open_, (-m, n, s, t))
                continue
            tied = [self.templates[t]]
            while open_ and open_[0][:3] == best[:3]:
                tied.append(self.templates[heapq.heappop(open_)[3]])
            taken.insert(place, (start, start + length))
            yield best, tied

    def confirmed(self, block: list[tuple[str, int, int]]):
        """What :meth:`winners` is held against: all ranges of all templates by wording, without compression before.

        Start, end, saved percent, template and differences of notices that never overlap; savings
        only choose between templates that fit a range equally well.
        """
        have = [w for w, _, _ in block]
        ids, in_block = ids_of(self.known, have), set(have)
        open_ = []
        for t, template in enumerate(self.templates):
            if template.words and template.needed <= in_block:
                starts = self._starts(ids, template)
                open_ += [(-m, n, s, t) for m, n, s in self._ranges(ids, template, starts, len(ids))]
        for (_, length, start, _), tied in self._apart(ids, open_, len(ids)):
            saved, template = self.rank(block[start : start + length], tied)[0]
            yield start, start + length, saved, template, self._differences(have[start : start + length], template)

    def winners(self, block: list[tuple[str, int, int]]):
        """Start, end, saved percent, template and differences of the notices in ``block``, which never overlap.

        Proposals are confirmed in the order of the bytes that their template's dictionary saves.
        """
        have = [w for w, _, _ in block]
        ids, in_block = ids_of(self.known, have), set(have)
        proposed: dict[int, list[tuple[int, int]]] = {}
        ranked: list[tuple] = []

        def propose(t: int, first: int, stop: int) -> None:
            template = self.templates[t]
            starts = self._smaller(have, ids, template, first, stop)
            open_ = [(-m, n, s, t) for m, n, s in self._ranges(ids, template, starts, stop)]
            for (matched, n, s, _), _ in self._apart(ids, open_, stop):
                saved, alone = self.saving(have[s : s + n], template)
                if saved > 0:
                    bisect.insort(proposed[t], (s, s + n))
                    heapq.heappush(ranked, (-saved, matched, n, s, len(template.words), t, alone))

        for t, template in enumerate(self.templates):
            if template.words and template.needed <= in_block:
                proposed[t] = []
                propose(t, 0, len(ids))
        taken: list[tuple[int, int]] = []
        while ranked:
            saved, _, n, start, _, t, alone = heapq.heappop(ranked)
            template, end = self.templates[t], start + n
            place = bisect.bisect_right(taken, (start, len(ids)))
            if (not place or taken[place - 1][1] <= start) and (place == len(taken) or end <= taken[place][0]):
                taken.insert(place, (start, end))
                yield start, end, 100 * -saved // alone, template, self._differences(have[start:end], template)
                continue
            # Another range of this template can only lie around the lost one, up to its next proposals.
            own = proposed[t]
            k = bisect.bisect_left(own, (start, end))
            del own[k]
            first = max(own[k - 1][1] if k else 0, start - template.longest)
            stop = min(own[k][0] if k < len(own) else len(ids), end + template.longest)
            for begin, until in _left(taken, first, stop):
                propose(t, begin, until)

    def find(self, text: str) -> tuple[int, list[dict]]:
        """Number of blocks and the confirmed templates, in order."""
        found, ranges = [], blocks(text, self.margin)
        for begin, end in ranges:
            in_block = words(text[begin:end])
            for first, last, saved, template, differences in self.winners(in_block):
                found.append(
                    {
                        "license": template.name.split(" ")[0],
                        "template": template.name,
                        "verdict": "variant" if differences else "exact",
                        "start": begin + in_block[first][1],
                        "end": begin + in_block[last - 1][2],
                        "saved_percent": saved,
                        "differences": differences,
                    }
                )
        return len(ranges), sorted(found, key=lambda f: (f["start"], f["end"], f["template"]))


def _left(taken: list[tuple[int, int]], first: int, stop: int) -> list[tuple[int, int]]:
    """The parts of ``first`` to ``stop`` that no range of ``taken`` (in order) covers."""
    parts = []
    place = max(0, bisect.bisect_right(taken, (first, first)) - 1)
    for begin, end in itertools.takewhile(lambda r: r[0] < stop, itertools.islice(taken, place, None)):
        if first < begin:
            parts.append((first, begin))
        first = max(first, end)
    return parts + [(first, stop)] * (first < stop)


def ids_of(known: dict[str, int], own: list[str]) -> np.ndarray:
    """Numbers of words; all unknown ones have the last number."""
    return np.fromiter((known.get(w, len(known)) for w in own), np.int64, len(own))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, similarity: int = _SIMILARITY) -> DataFrame:
    """Every row of ``docs`` (without its text) with ``n_blocks``, ``n_confirmed``, ``licenses`` and ``findings``."""
    chosen = dict(TEMPLATES if templates is None else templates)
    held: list[Matcher] = []

    def run(texts: list[str | None]):
        if not held:
            held.append(Matcher(chosen, similarity))
        rows = []
        for text in texts:
            n, found = held[0].find(text or "")
            names = ",".join(sorted({f["license"] for f in found}))
            rows.append((n, len(found), names, found))
        return list(zip(*rows)) or [()] * len(FIELDS)

    return per_text(docs, FIELDS, run, others(docs, [f.name for f in FIELDS] + ["text"]))
