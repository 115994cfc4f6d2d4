"""License scans: matching statistics against a generalised suffix automaton of license templates.

The automaton holds every run of words of all templates. A document's words are streamed through it;
at each word it knows the longest run ending there that occurs in a template. Maximal long runs are
chained per template, in the order of document and template with small gaps, and a chain that covers
enough of its template becomes a span with that template's label. Of chains over the same words only
the one that covers most stays, so a notice gets the label of its own license.

Words are longest runs of digits, ASCII letters (lower-cased) and characters outside ASCII. NULL and
empty texts hold none. Besides, fixed phrases are found wherever their words stand consecutively;
their labels always stay. Each document is scanned where it lies: no shuffle. The automaton is built
from the templates, which are a parameter, not from the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import slices, text_bytes, words

# The phrases that decide the base labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Names of licenses. Each alone is a template, as is being licensed or released under it.
NAMES = (
    ("mit", "MIT License"),
    ("apache-2", "Apache License, Version 2.0"),
    ("bsd-2", "BSD 2-Clause License"),
    ("bsd-3", "BSD 3-Clause License"),
    ("isc", "ISC License"),
    ("gpl-2", "GNU General Public License, version 2"),
    ("gpl-3", "GNU General Public License, version 3"),
    ("lgpl-2.1", "GNU Lesser General Public License, version 2.1"),
    ("lgpl-3", "GNU Lesser General Public License, version 3"),
    ("agpl-3", "GNU Affero General Public License, version 3"),
    ("mpl-2", "Mozilla Public License, Version 2.0"),
    ("epl-2", "Eclipse Public License, Version 2.0"),
    ("boost", "Boost Software License, Version 1.0"),
    ("cc-by", "CC BY 4.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nd", "CC BY-ND 4.0"),
    ("cc-by-nc", "CC BY-NC 4.0"),
    ("cc-by-nc-sa", "CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "CC BY-NC-ND 4.0"),
)
CREATIVE_COMMONS = (
    ("cc-by", "Attribution"),
    ("cc-by-sa", "Attribution-ShareAlike"),
    ("cc-by-nd", "Attribution-NoDerivatives"),
    ("cc-by-nc", "Attribution-NonCommercial"),
    ("cc-by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
    ("cc-by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
)

# Public license texts and standard notices, as their owners word them.
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the Software."
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
APACHE_NOTICE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License."
)
MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
EPL_NOTICE = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which "
    "is available at https://www.eclipse.org/legal/epl-2.0."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means."
)
BOOST_GRANT = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
    "transmit the Software, and to prepare derivative works of the Software"
)


def gnu_notice(thing: str, name: str, version: str) -> str:
    """The notice that goes into each source file; it is worded alike for all licenses of the family."""
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published "
        f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
        f"{thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        f"of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
    )


TEMPLATES = (
    ("mit", MIT_GRANT + " " + AS_IS),
    ("isc", ISC_GRANT),
    ("bsd-2", BSD_CONDITIONS + " " + BSD_AS_IS),
    ("bsd-3", BSD_CONDITIONS + " " + BSD_NAMES + " " + BSD_AS_IS),
    ("apache-2", APACHE_NOTICE),
    ("gpl-2", gnu_notice("program", "General Public License", "2")),
    ("gpl-3", gnu_notice("program", "General Public License", "3")),
    ("lgpl-2.1", gnu_notice("library", "Lesser General Public License", "2.1")),
    ("lgpl-3", gnu_notice("library", "Lesser General Public License", "3")),
    ("agpl-3", gnu_notice("program", "Affero General Public License", "3")),
    ("mpl-2", MPL_NOTICE),
    ("epl-2", EPL_NOTICE),
    ("unlicense", UNLICENSE),
    ("boost", BOOST_GRANT),
    *[(label, name) for label, name in NAMES if len(name.split()) > 2],
    *[(label, f"{done} under {'' if name.startswith('CC') else 'the '}{name}") for label, name in NAMES for done in ("licensed", "released")],
    *[(label, f"This work is licensed under a Creative Commons {name} 4.0 International License") for label, name in CREATIVE_COMMONS],
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
)

# A run of at least so many words is kept; gaps in a chain; the part of a template that a chain has to cover,
# or the number of its words that is enough for a long one.
MIN_RUN, MAX_GAP, MIN_SHARE, ENOUGH_WORDS = 3, 6, 0.75, 12


class Run(NamedTuple):
    """A maximal common run: first word in the document, template, first word there, words."""

    at: int
    template: int
    place: int
    size: int


class Span(NamedTuple):
    label: str
    first: int
    last: int
    covered: int
    share: float


def word_ids(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return [int(k) for k in words(data, np.array([0, len(data)])).key]


class Automaton:
    """Suffix automaton of several word sequences, with the places where each state's runs end."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.labels = [label for label, _ in templates]
        self.sizes: list[int] = []
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, (_, text) in enumerate(templates):
            last = 0
            sequence = word_ids(text)
            self.sizes.append(len(sequence))
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((t, i))
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]
        self.vocabulary = np.array(sorted(self.step[0]), np.uint64)

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.size.append(size)
        self.step.append(step)
        self.link.append(link)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, parent: int, word: int, state: int) -> int:
        """A state for the shorter runs of ``state``, reached from ``parent``."""
        copy = self._state(self.size[parent] + 1, dict(self.step[state]), self.link[state])
        self.link[state] = copy
        while parent >= 0 and self.step[parent].get(word) == state:
            self.step[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, word, known)
        new, parent = self._state(self.size[last] + 1, {}, 0), last
        while parent >= 0 and word not in self.step[parent]:
            self.step[parent][word] = new
            parent = self.link[parent]
        if parent >= 0:
            known = self.step[parent][word]
            self.link[new] = known if self.size[known] == self.size[parent] + 1 else self._split(parent, word, known)
        return new

    def statistics(self, sequence: list[int]) -> list[tuple[int, int]]:
        """For each word the length of the longest run ending there that occurs in a template, and its state."""
        state = size = 0
        found = []
        for word in sequence:
            while state and word not in self.step[state]:
                state = self.link[state]
                size = self.size[state]
            if word in self.step[state]:
                state, size = self.step[state][word], size + 1
            else:
                state = size = 0
            found.append((size, state))
        return found

    def runs(self, key: np.ndarray) -> list[Run]:
        """Maximal runs of at least MIN_RUN words, for each template place where they occur."""
        slot = np.minimum(np.searchsorted(self.vocabulary, key), len(self.vocabulary) - 1)
        known = np.concatenate([[False], self.vocabulary[slot] == key, [False]])
        edge = np.flatnonzero(known[1:] != known[:-1])
        found = []
        for a, b in zip(edge[0::2], edge[1::2]):
            if b - a < MIN_RUN:
                continue
            statistics = self.statistics(key[a:b].tolist())
            for i, (size, state) in enumerate(statistics):
                grows = i + 1 < len(statistics) and statistics[i + 1][0] == size + 1
                if size >= MIN_RUN and not grows:
                    found += [Run(int(a) + i - size + 1, t, e - size + 1, size) for t, e in self.ends[state]]
        return found

    def spans(self, key: np.ndarray) -> list[Span]:
        """Chains of runs that cover enough of a template."""
        spans = []
        by_template: dict[int, list[Run]] = {}
        for run in self.runs(key):
            by_template.setdefault(run.template, []).append(run)
        for t, own in by_template.items():
            own.sort()
            best: list[tuple[int, int, int]] = []  # words covered, first word of the chain, run before
            low = 0
            for i, run in enumerate(own):
                covered, first, before = run.size, run.at, -1
                while own[low].at + self.sizes[t] + MAX_GAP < run.at:
                    low += 1
                for j in range(low, i):
                    other = own[j]
                    gap, skip = run.at - other.at - other.size, run.place - other.place - other.size
                    if 0 <= gap <= MAX_GAP and 0 <= skip <= MAX_GAP and best[j][0] + run.size > covered:
                        covered, first, before = best[j][0] + run.size, best[j][1], j
                best.append((covered, first, before))
            used = {b for _, _, b in best}
            for i, (covered, first, _) in enumerate(best):
                if i not in used:
                    share = covered / self.sizes[t]
                    last = own[i].at + own[i].size - 1
                    spans.append(Span(self.labels[t], first, last, covered, share))
        return sorted(spans, key=lambda s: (s.first, s.last, s.label, -s.covered))


def accepted(span: Span) -> bool:
    return span.share >= MIN_SHARE or span.covered >= ENOUGH_WORDS


def chosen(spans: list[Span], n_words: int) -> list[Span]:
    """Accepted spans; of those that share most of their words only the one that covers most of its template.

    Notices of related licenses differ in a word or two, so a text chains to all of them. The most words
    decide, then the larger part of the template.
    """
    good = sorted(filter(accepted, spans), key=lambda s: (-s.covered, -s.share, s.first, s.last, s.label))
    taken = np.zeros(n_words, bool)
    kept = []
    for s in good:
        own = taken[s.first : s.last + 1]
        if 2 * int(own.sum()) < len(own):
            kept.append(s)
            own[:] = True
    return sorted(kept, key=lambda s: (s.first, s.last, s.label, -s.covered))


@lru_cache(maxsize=4)
def automaton(templates: tuple[tuple[str, str], ...]) -> Automaton:
    return Automaton(templates)


SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first:bigint,last:bigint,share:double>>"
)
SPAN_TYPE = pa.list_(
    pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())])
)


def scan(docs: DataFrame, keep: list[str], text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """License marks of every text: the ``keep`` columns, then counts, labels, score and spans.

    ``n_base`` counts all places of all phrases, ``first_word`` and ``last_word`` are the smallest and
    largest of their first words. ``labels`` adds those of the accepted spans. ``score`` is 1 with a
    base label, else the largest part of a template (or of ENOUGH_WORDS) that a chain covers.
    """
    moved = docs.select(F.col(text).alias("text"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    kept_schema = "".join(f"keep_{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    wanted = [(np.array(word_ids(p), np.uint64), label) for p, label in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = automaton(templates)
        for batch in batches:
            for part in slices(batch):
                found = words(*text_bytes(part.column("text")))
                text_of = np.repeat(np.arange(part.num_rows), np.diff(found.first))
                starts: list[list[int]] = [[] for _ in range(part.num_rows)]
                base: list[set[str]] = [set() for _ in range(part.num_rows)]
                for phrase, label in wanted:
                    m = len(found.key) - len(phrase) + 1
                    if m <= 0:
                        continue
                    same = text_of[:m] == text_of[len(phrase) - 1 :]
                    for j, word in enumerate(phrase):
                        same &= found.key[j : j + m] == word
                    for i in np.flatnonzero(same):
                        starts[text_of[i]].append(int(i - found.first[text_of[i]]))
                        base[text_of[i]].add(label)
                rows = []
                for d in range(part.num_rows):
                    a, b = found.first[d], found.first[d + 1]
                    chains = use.spans(found.key[a:b])
                    good = chosen(chains, int(b - a))
                    part_covered = [max(s.share, s.covered / ENOUGH_WORDS if s.covered >= 6 else 0.0) for s in chains]
                    rows.append(
                        (
                            int(b - a), len(starts[d]), min(starts[d], default=None), max(starts[d], default=None),
                            ",".join(sorted(base[d])), ",".join(sorted(base[d] | {s.label for s in good})),
                            1.0 if base[d] else min(1.0, max(part_covered, default=0.0)),
                            [{"label": s.label, "first": s.first, "last": s.last, "share": s.share} for s in good],
                        )
                    )
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPAN_TYPE]
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(f"keep_{i}") for i in range(len(keep))]
                    + [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                    [f"keep_{i}" for i in range(len(keep))] + [f"out_{c}" for c in names],
                )

    outputs = [c.split()[0] for c in SCHEMA.split(", ")]
    made = moved.mapInArrow(run, kept_schema + ", ".join(f"out_{c}" for c in SCHEMA.split(", ")))
    return made.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"out_{c}").alias(c) for c in outputs]
    )
