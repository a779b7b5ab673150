"""License scans by template-markup matching.

A template is a license's wording with ``{optional ... }`` and ``{any}`` regions: an optional region may be missing, and ``any`` stands
for words of any kind and number, up to where the wording that follows it stands. The wording between ``any`` regions is compiled to
token automata whose arcs are mandatory words. A scan finds the places where an automaton's first words stand, by hash, and runs it
there only; a text is accepted where all of a template's automata follow each other. Each is taken where it ends first, which leaves
the most room for the next, so no choice has to be undone and a long text is read once.

Whole licences (``LICENSES``) match from their first granting words to the last of the disclaimer, so a text with one
mandatory word changed or left out is no match. ``NOTICES`` are file headers and lines that name a licence, whose own text is elsewhere;
their labels say so.

Words are letters, digits and non-ASCII characters after lower-casing A-Z. ``PHRASES`` give base labels. The
score is 1 for a whole licence, 0.8 for a notice without one, 0.6 for a phrase alone, else 0.

Null and empty texts have no words, no labels and score 0; overlapping matches all count; repeated rows are judged alike; an
empty table gives no rows. Long texts are scanned whole. Other columns pass through; those named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidegrid.llm._frames import map_column
from tidegrid.llm._words import ALNUM, Words, chunks

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# The public wordings of licences and of lines that name one, as words.
_BSD_TERMS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    " {optional 1 } redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
    " {optional 2 } redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"
    " in the documentation and or other materials provided with the distribution"
)
_BSD_NAMES = (
    " {optional 3 } neither the name of {any} nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission"
)
_BSD_DISCLAIMER = (
    " this software is provided by {any} as is and any express or implied warranties including but not limited to the implied warranties of"
    " merchantability and fitness for a particular purpose are disclaimed in no event shall {any} be liable for any direct indirect incidental"
    " special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or"
    " profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including"
    " negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_GNU_NOTICE = (
    "is free software you can redistribute it and or modify it under the terms of the gnu {kind}general public license as published by the free"
    " software foundation either version {any} of the license or at your option any later version {any} is distributed in the hope that it"
    " will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the"
    " gnu {kind}general public license for more details"
)

#: (label, wording). A template, and what follows an ``any``, starts with a mandatory word.
LICENSES: list[tuple[str, str]] = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the"
        " software to deal in the software without restriction including without limitation the rights to use copy modify merge publish"
        " distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to"
        " the following conditions the above copyright notice and this permission notice {optional including the next paragraph } shall be"
        " included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or"
        " implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no"
        " event shall {any} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising"
        " from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and {optional or } distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and {any}"
        " disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event"
        " shall {any} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of"
        " use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the"
        " use or performance of this software",
    ),
    ("bsd-2-clause", _BSD_TERMS + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or"
        " distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any"
        " means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in"
        " the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and"
        " successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this"
        " software under copyright law the software is provided as is without warranty of any kind express or implied including but not limited"
        " to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {any} be liable for any"
        " claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the"
        " software or the use or other dealings in the software",
    ),
]
NOTICES: list[tuple[str, str]] = [
    (
        "apache-2.0-header",
        "licensed under the apache license version 2 0 the license you may not use {any} except in compliance with the license you may obtain"
        " a copy of the license at {optional http } {optional https } www apache org licenses license 2 0 unless required by applicable law or"
        " agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any"
        " kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    ("gpl-or-later-header", _GNU_NOTICE.replace("{kind}", "")),
    ("lgpl-or-later-header", _GNU_NOTICE.replace("{kind}", "lesser ")),
    ("agpl-or-later-header", _GNU_NOTICE.replace("{kind}", "affero ")),
    (
        "mpl-2.0-header",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this"
        " file you can obtain one at {optional http } {optional https } {optional www } mozilla org mpl 2 0",
    ),
    ("apache-2.0-notice", "licensed under the apache license version 2 0"),
    ("gpl-notice", "licensed under {optional the terms of } {optional the } gnu {optional lesser } {optional affero } general public license"),
    ("gpl-notice", "under the terms of the gnu {optional lesser } {optional affero } general public license"),
    ("mit-notice", "under the {optional terms of the } mit license"),
    ("bsd-notice", "under the {optional terms of the } bsd {optional style } {optional 2 } {optional 3 } {optional clause } license"),
    ("bsd-notice", "under a bsd {optional style } {optional 2 } {optional 3 } {optional clause } license"),
    ("mpl-2.0-notice", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-notice", "licensed under {optional a } {optional the } cc by {optional nc } {optional nd } {optional sa } {optional 1 } {optional 2 } {optional 3 } {optional 4 } 0"),
    ("cc-notice", "licensed under {optional a } {optional the } creative commons attribution {any} license"),
    ("copyright-notice", "copyright c {any} all rights reserved"),
]
TEMPLATES = LICENSES + NOTICES
WHOLE = {label for label, _ in LICENSES}

OUTPUT = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())]


class Automaton:
    """Wording without ``any``. States are places in it; arcs[state] is the word that leads to the next; skips have no word."""

    def __init__(self, tokens: list[str]):
        self.arcs: list[str] = []
        self.skips: dict[int, list[int]] = {}
        opened: list[int] = []
        for token in tokens:
            if token == "{optional":
                opened.append(len(self.arcs))
            elif token == "}" and opened:
                self.skips.setdefault(opened.pop(), []).append(len(self.arcs))
            else:
                self.arcs.append(token)
        self.final = len(self.arcs)
        self.head = self.arcs[: 1 if 1 in self.skips else 2]
        if opened or "}" in self.arcs or not self.head or 0 in self.skips:
            raise ValueError(f"wording needs a mandatory word first and closed regions: {' '.join(tokens)}")

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skips.get(todo.pop(), ()):
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def end(self, words: list[str]) -> int | None:
        """How many words the wording takes at the start of words, the fewest; none where it doesn't stand there."""
        states = self._closed({0})
        for k, word in enumerate(words):
            if self.final in states:
                return k
            states = self._closed({s + 1 for s in states if s < self.final and self.arcs[s] == word})
            if not states:
                return None
        return len(words) if self.final in states else None


def automata(wording: str) -> list[Automaton]:
    """Those of the wording between its ``any`` regions."""
    return [Automaton(part.split()) for part in wording.split("{any}")]


def as_regex(wording: str) -> str:
    """The template as a regular expression over words that each have a space after them."""
    regions = {"{any}": "([^ ]+ )*", "{optional": "(", "}": ")?"}
    return "".join(regions.get(token, f"{token} ") for token in wording.split())


def _hash(phrase: str) -> np.uint64:
    data = np.frombuffer(phrase.encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]), ALNUM, fold=True)
    return words.window_hashes(np.array([0]), len(words.start))[0]


class Scanner:
    def __init__(self, templates: list[tuple[str, str]]):
        self.phrases = [(p, len(p.split()), label, _hash(p)) for p, label in PHRASES.items()]
        self.templates = [(label, automata(wording)) for label, wording in templates]
        self.heads: dict[int, dict[int, list[tuple[int, int]]]] = {1: {}, 2: {}}  # of each automaton, by its head: template and place in it
        for t, (_, parts) in enumerate(self.templates):
            for k, part in enumerate(parts):
                self.heads[len(part.head)].setdefault(int(_hash(" ".join(part.head))), []).append((t, k))

    def scan(self, words: Words) -> tuple[dict[int, list[tuple[int, str]]], dict[int, set[str]]]:
        """By text: the phrases' (start, label), and the labels of templates."""
        base: dict[int, list[tuple[int, str]]] = {}
        for phrase, k, label, h in self.phrases:
            starts = words.windows(k)
            for s in starts[words.window_hashes(starts, k) == h].tolist() if len(starts) else ():
                if words.text(s, s + k).lower() == phrase.encode():
                    d = int(words.doc[s])
                    base.setdefault(d, []).append((s - int(words.first[d]), label))
        places: dict[int, dict[tuple[int, int], list[int]]] = {}
        for n, heads in self.heads.items():
            starts = words.windows(n)
            if not heads or not len(starts):
                continue
            h = words.window_hashes(starts, n)
            for i in np.flatnonzero(np.isin(h, np.array(list(heads), np.uint64))).tolist():
                s = int(starts[i])
                for part in heads[int(h[i])]:
                    places.setdefault(int(words.doc[s]), {}).setdefault(part, []).append(s)
        more = {d: {self.templates[t][0] for t, k in own if k == 0 and self._stands(words, t, own, int(words.first[d + 1]))} for d, own in places.items()}
        return base, more

    def _stands(self, words: Words, t: int, places: dict[tuple[int, int], list[int]], end: int) -> bool:
        """Whether template t's automata follow each other; places: where the head of each stands, rising."""
        at = 0
        for k, part in enumerate(self.templates[t][1]):
            best = None
            for s in places.get((t, k), ()):
                if best is not None and s >= best:
                    break
                if s >= at:
                    took = part.end(words.text(s, min(s + part.final, end)).lower().decode().split(" "))
                    if took is not None and (best is None or s + took < best):
                        best = s + took
            if best is None:
                return False
            at = best
        return True


def scan_licenses(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """documents with OUTPUT's columns."""
    scanner = Scanner(templates)

    def fn(column: pa.Array) -> list[pa.Array]:
        rows = []
        for row, last, data, offsets in chunks(column):
            words = Words(data, offsets, ALNUM, fold=True)
            base, more = scanner.scan(words)
            for d in range(last - row):
                found, labels = base.get(d, []), more.get(d, set())
                own = {label for _, label in found}
                at = [s for s, _ in found]
                rows.append((int(words.n[d]), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(own | labels)), 1.0 if labels & WHOLE else 0.8 if labels else 0.6 if own else 0.0))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]

    return map_column(documents, "text", OUTPUT, fn)
