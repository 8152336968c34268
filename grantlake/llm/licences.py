"""Licence scan with a generalised suffix automaton of licence templates.

The automaton has a state for each class of word runs that end at the same places of the templates.  A text is
streamed through it word by word; after each word the state gives the longest run that ends there and stands in some
template (its matching statistic); the states of its suffixes give the longest runs of the other templates.  Runs
that can't be lengthened in their template and are ``LEAST`` words or longer are matches; for
each template the matches that stand in it, in the same order as in the text and close together, are chained, and the
share of the template's words that a chain covers is its coverage.  A licence is found at a coverage of ``COVERED``, as
often as such chains stand beside each other; templates of notices, headers and whole texts are told apart.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.text import byte_column, words

LEAST = 3
#: Words of a match for templates of ``LONG_TEMPLATE`` words or more: licences share many turns of phrase.
LONG, LONG_TEMPLATE = 6, 40
GAP = 12
COVERED = 0.75
#: Score of a text that has a phrase but no covered template; else the score is the best coverage.
PHRASE_SCORE = 0.6

#: Phrases whose places are counted, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices, headers and whole texts of public licences, by label and part.
TEMPLATES = {
    "apache": {
        "notice": "licensed under the apache license version 2 0",
        "header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "header end": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    },
    "mit": {
        "notice": "released under the mit license",
        "other notice": "licensed under the mit license",
        "grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "text": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including
            without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the
            following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any
            kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable
            for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software""",
    },
    "gpl": {
        "notice": "this work is licensed under the gnu general public license version 3",
        "header": """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or
            at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
            purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program""",
    },
    "lgpl": {"notice": "licensed under the gnu lesser general public license version 3"},
    "cc-by": {"notice": "licensed under cc by 4 0", "long notice": "this work is licensed under a creative commons attribution 4 0 international license"},
    "cc-by-nc": {"notice": "licensed under cc by nc 4 0", "long notice": "this work is licensed under a creative commons attribution noncommercial 4 0 international license"},
    "cc-by-sa": {"notice": "licensed under cc by sa 4 0", "long notice": "this work is licensed under a creative commons attribution sharealike 4 0 international license"},
    "bsd": {
        "notice": "licensed under the bsd 3 clause license",
        "text": """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above
            copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
            documentation and or other materials provided with the distribution neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
            this software without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the
            implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special
            exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of
            liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage""",
    },
    "mpl": {"notice": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"},
    "isc": {
        "text": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in
            all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author
            be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious
            action arising out of or in connection with the use or performance of this software""",
    },
    "zlib": {
        "text": """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to
            anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be
            misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required
            altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed or altered from any source distribution""",
    },
    "cc0": {"notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"},
    "unlicense": {
        "notice": "this is free and unencumbered software released into the public domain",
        "text": """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled
            binary for any purpose commercial or non commercial and by any means""",
    },
}


class Automaton:
    """Generalised suffix automaton over word numbers, with the templates and end places of each state."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[set[tuple[int, int]]] = [set()]
        for number, template in enumerate(templates):
            last = 0
            for at, word in enumerate(template):
                last = self._add(last, word)
                while len(own) < len(self.next):
                    own.append(set())
                own[last].add((number, at))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                own[self.link[state]] |= own[state]
        self.ends = [sorted(s) for s in own]
        self.shorter: dict[int, dict[int, tuple[int, list[int]]]] = {}

    def inside(self, state: int, length: int) -> dict[int, tuple[int, list[int]]]:
        """template -> (words, its last words) of the longest run of each template that ends where a run of this state ends.

        The templates of the state itself have the whole run; others have what the states of its suffixes are.
        """
        if state not in self.shorter:
            out: dict[int, tuple[int, list[int]]] = {}
            at = self.link[state]
            while at > 0 and self.length[at] >= LEAST:
                found: dict[int, list[int]] = {}
                for template, last in self.ends[at]:
                    found.setdefault(template, []).append(last)
                for template, lasts in found.items():
                    out.setdefault(template, (self.length[at], lasts))
                at = self.link[at]
            self.shorter[state] = out
        own: dict[int, list[int]] = {}
        for template, last in self.ends[state]:
            own.setdefault(template, []).append(last)
        return self.shorter[state] | {template: (length, lasts) for template, lasts in own.items()}

    def _state(self, length: int, like: int | None = None) -> int:
        self.next.append({} if like is None else dict(self.next[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A state of its own for the runs of ``child`` that come from ``parent``."""
        new = self._state(self.length[parent] + 1, child)
        self.link[child] = new
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = new
            parent = self.link[parent]
        return new

    def _add(self, last: int, word: int) -> int:
        if (child := self.next[last].get(word)) is not None:  # the run is known from an earlier template
            return child if self.length[child] == self.length[last] + 1 else self._split(last, word, child)
        new, state = self._state(self.length[last] + 1), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state < 0:
            self.link[new] = 0
        else:
            child = self.next[state][word]
            self.link[new] = child if self.length[child] == self.length[state] + 1 else self._split(state, word, child)
        return new

    def statistics(self, ids: list[int]) -> list[tuple[int, int]]:
        """After each word: the longest run of the templates that ends there, and its state."""
        out, state, length = [], 0, 0
        for word in ids:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            out.append((length, state))
        return out


class Scanner:
    """Templates and phrases over one vocabulary."""

    def __init__(self, templates: dict[str, dict[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda text: [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text.encode())]
        self.labels = [(label, part) for label, texts in templates.items() for part in texts]
        self.templates = [number(t) for texts in templates.values() for t in texts.values()]
        self.phrases = [(number(p), label) for p, label in phrases.items()]
        self.automaton = Automaton(self.templates)

    def places(self, ids: np.ndarray) -> list[tuple[int, str]]:
        """(first word, label) of every place of a phrase."""
        out = []
        for phrase, label in self.phrases:
            if len(ids) >= len(phrase):
                n = len(ids) - len(phrase) + 1
                hit = np.logical_and.reduce([ids[k : k + n] == w for k, w in enumerate(phrase)])
                out += [(p, label) for p in np.flatnonzero(hit).tolist()]
        return out

    def matches(self, ids: np.ndarray) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """(first, end, [(template, its last word)]) of each template's runs of LEAST words or more that can't be lengthened.

        A run of one template may lie inside a longer one of another.
        """
        out = []
        gaps = np.flatnonzero(np.concatenate(([True], ids == 0, [True]))) - 1
        for a, b in zip(gaps[:-1] + 1, gaps[1:]):  # a word of no template ends every run
            if b - a >= LEAST:
                before: dict[int, tuple[int, list[int]]] = {}
                for end, (length, state) in enumerate([*self.automaton.statistics(ids[a:b].tolist()), (0, 0)], int(a)):
                    now = self.automaton.inside(state, length) if length >= LEAST else {}
                    for template, (n, lasts) in before.items():
                        if template not in now or now[template][0] <= n:
                            out.append((end - n, end, [(template, last) for last in lasts]))
                    before = now
        return out

    def chains(self, ids: np.ndarray) -> list[tuple[str, str, float, int, int]]:
        """(label, part, coverage, first word, end) of chains of each template that don't overlap, the best first.

        Chains that cover ``COVERED`` of their template are all given, and the best one of a template in any case.
        """
        by: dict[int, list[tuple[int, int, int]]] = {}
        for first, end, places in self.matches(ids):
            for template, at in places:
                if end - first < LONG and len(self.templates[template]) >= LONG_TEMPLATE:
                    continue
                by.setdefault(template, []).append((first, end, at + 1))
        out = []
        for template, runs in by.items():
            length = len(self.templates[template])
            every: list[tuple[int, int, int]] = []  # covered, first, end of the best chain that ends with each run
            done: list[tuple[int, int, int, int]] = []  # end, end in the template, first, covered
            for first, end, at in sorted(runs):
                covered, start = end - first, first
                for end_, at_, first_, covered_ in done:
                    share = max(0, end_ - first, at_ - (at - (end - first)))  # words both would cover
                    if at_ < at and first - end_ <= GAP and end > end_ and covered_ + (end - first) - share > covered:
                        covered, start = covered_ + (end - first) - share, first_
                done = [d for d in done if first - d[0] <= GAP] + [(end, at, start, covered)]
                every.append((covered, start, end))
            every.sort(key=lambda c: (-c[0], c[1], c[2]))
            starts: list[int] = []  # of the chains taken, which don't overlap
            ends: dict[int, int] = {}
            for n, (covered, first, end) in enumerate(every):
                if n and covered < COVERED * length:
                    break
                k = bisect_right(starts, first)
                if (not k or ends[starts[k - 1]] <= first) and (k == len(starts) or end <= starts[k]):
                    starts.insert(k, first)
                    ends[first] = end
                    out.append((*self.labels[template], min(1.0, covered / length), first, end))
        return out

    def scan(self, text: bytes) -> dict:
        parts = words(text)
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in parts), np.int64, len(parts))
        places = self.places(ids) if len(parts) > 1 else []
        spans = [c for c in self.chains(ids) if c[2] >= COVERED] if len(parts) >= LEAST else []
        base = sorted({label for _, label in places})
        return {
            "n_words": len(parts), "n_base": len(places), "first_word": min((p for p, _ in places), default=None), "last_word": max((p for p, _ in places), default=None),
            "base_labels": ",".join(base), "labels": ",".join(sorted({*base, *(s[0] for s in spans)})),
            "score": max([PHRASE_SCORE] * bool(places) + [s[2] for s in spans], default=0.0),
            "spans": [{"label": s[0], "part": s[1], "coverage": s[2], "first": s[3], "last": s[4] - 1} for s in sorted(spans, key=lambda s: (s[3], s[0], s[1], s[4]))],
        }


FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
          ("spans", pa.list_(pa.struct([("label", pa.string()), ("part", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("last", pa.int64())])))]


def licence_scan(documents: DataFrame) -> DataFrame:
    """One row per document row: places of the phrases, all labels, a score and the covered template spans.

    Null and empty texts have no words, no labels and score 0.  Columns other than doc_id and text are left out.
    """

    def scan(batches):
        scanner = Scanner()
        for batch in batches:
            found = [scanner.scan(t) for t in byte_column(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[n] for f in found], t) for n, t in FIELDS)], ["doc_id", *(n for n, _ in FIELDS)])

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, part: string, coverage: double, first: long, last: long>>"
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, schema)
