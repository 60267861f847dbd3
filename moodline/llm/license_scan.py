"""Licence scans by template-markup matching (operator 5).

A template is a licence's wording with markup: ``[[words]]`` may be missing,
``{{name:most}}`` stands for up to that many words of any kind; all other
wording is mandatory. Templates are compiled to automata over words: states
between words, edges that demand a word or take any, and free edges past
optional parts. A text carries a template's label if the automaton accepts some
run of its words, so mandatory wording matches exactly while case, punctuation
and white space do not matter. Only places around a template's longest
mandatory run are tried, found by word hashes over whole texts.

Base places are those where a base phrase's words stand consecutively.

Cases: a null or empty text has no words and no labels. Ties cannot occur;
repeated rows give repeated results. Extra columns pass through; those named
like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from moodline.llm import ships_by_value
from moodline.llm.textbuf import Words, chunks, words

ships_by_value(__name__)

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence wording as templates.
TEMPLATES = {
    "gpl-notice": "[[this work is]] licensed under the gnu general public license [[version {{number:2}}]]",
    "apache-notice": "licensed under the apache license version {{number:2}}",
    "mit-notice": "released under the mit license",
    "cc-by-notice": "licensed under [[a]] [[creative commons]] cc by [[nc]] [[sa]] [[nd]] {{number:2}}",
    "gpl-header": "this program is free software you can redistribute it and or modify it under the terms of the "
                  "gnu general public license as published by the free software foundation either version "
                  "{{number:1}} of the license or [[at your option]] any later version",
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this file except in "
                     "compliance with the license you may obtain a copy of the license at {{url:8}}",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction including "
                "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                "the following conditions",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "[[subject to the limitations in the disclaimer below]] provided that the following conditions are met",
    "isc-text": "permission to use copy modify and [[or]] distribute this software for any purpose with or without "
                "fee is hereby granted provided that the above copyright notice and this permission notice appear in "
                "all copies",
    "mit-full": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do "
        "so subject to the following conditions the above copyright notice and this permission notice "
        "[[including the next paragraph]] shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a particular purpose "
        "and noninfringement in no event shall {{holders:10}} be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software"),
    "bsd-2-full": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met {{number:1}} redistributions of source code must "
        "retain the above copyright notice this list of conditions and the following disclaimer "
        "{{number:1}} redistributions in binary form must reproduce the above copyright notice this list "
        "of conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution this software is provided by {{holders:12}} as is and any express or "
        "implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed in no event shall {{holders:12}} be liable for "
        "any direct indirect incidental special exemplary or consequential damages including but not "
        "limited to procurement of substitute goods or services loss of use data or profits or business "
        "interruption however caused and on any theory of liability whether in contract strict liability "
        "or tort including negligence or otherwise arising in any way out of the use of this software "
        "even if advised of the possibility of such damage"),
    "bsd-3-full": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met {{number:1}} redistributions of source code must "
        "retain the above copyright notice this list of conditions and the following disclaimer "
        "{{number:1}} redistributions in binary form must reproduce the above copyright notice this list "
        "of conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution {{number:1}} neither the name of {{holders:12}} nor the names of "
        "{{holders:4}} contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission this software is provided by {{holders:12}} as is and "
        "any express or implied warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed in no event shall "
        "{{holders:12}} be liable for any direct indirect incidental special exemplary or consequential "
        "damages including but not limited to procurement of substitute goods or services loss of use "
        "data or profits or business interruption however caused and on any theory of liability whether "
        "in contract strict liability or tort including negligence or otherwise arising in any way out of "
        "the use of this software even if advised of the possibility of such damage"),
    "isc-full": (
        "permission to use copy modify and [[or]] distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this permission "
        "notice appear in all copies the software is provided as is and {{holders:8}} disclaims all "
        "warranties with regard to this software including all implied warranties of merchantability and "
        "fitness in no event shall {{holders:8}} be liable for any special direct indirect or "
        "consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in "
        "connection with the use or performance of this software"),
    "zlib-full": (
        "this software is provided as is without any express or implied warranty in no event will the "
        "{{holders:6}} be held liable for any damages arising from the use of this software permission is "
        "granted to anyone to use this software for any purpose including commercial applications and to "
        "alter it and redistribute it freely subject to the following restrictions {{number:1}} the "
        "origin of this software must not be misrepresented you must not claim that you wrote the "
        "original software if you use this software in a product an acknowledgment in the product "
        "documentation would be appreciated but is not required {{number:1}} altered source versions must "
        "be plainly marked as such and must not be misrepresented as being the original software "
        "{{number:1}} this notice may not be removed or altered from any source distribution"),
    "apache-header-full": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at {{url:8}} unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied see the "
        "license for the specific language governing permissions and limitations under the license"),
    "gpl-header-full": (
        "is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version {{number:1}} of the "
        "license or [[at your option]] any later version {{program:6}} is distributed in the hope that it "
        "will be useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose see the gnu general public license for more details you should "
        "have received a copy of the gnu general public license along with {{program:6}} if not"),
    "lgpl-header-full": (
        "is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation either version {{number:2}} "
        "of the license or [[at your option]] any later version {{program:6}} is distributed in the hope "
        "that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose see the gnu lesser general public license "
        "for more details"),
    "agpl-header-full": (
        "is free software you can redistribute it and or modify it under the terms of the gnu affero "
        "general public license as published by the free software foundation either version {{number:1}} "
        "of the license or [[at your option]] any later version {{program:6}} is distributed in the hope "
        "that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose see the gnu affero general public license "
        "for more details"),
    "mpl-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of "
        "the mpl was not distributed with this file you can obtain one at {{url:8}}"),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy "
        "modify publish use compile sell or distribute this software either in source code form or as a "
        "compiled binary for any purpose commercial or non commercial and by any means"),
    "cc-notice": (
        "licensed under [[a]] [[the]] creative commons attribution [[noncommercial]] [[sharealike]] "
        "[[noderivatives]] [[noderivs]] {{number:2}} [[international]] [[unported]] [[generic]] license"),
}

ANY = 0


def word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(words(data, np.array([0, len(data)])).hash[0])


@dataclass
class Automaton:
    """Edges leave a state on a word (its hash, or ANY); free edges need none. The last state accepts."""

    label: str
    edges: list[list[tuple[int, int]]]
    free: list[list[int]]
    anchor: list[int]  # hashes of the longest mandatory run
    before: int  # most words that may stand before that run

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def accepts_at(self, hashes: np.ndarray, start: int) -> int | None:
        """End of the longest accepted run that starts at ``start``."""
        states, at, found = self.closure({0}), start, None
        last = len(self.edges) - 1
        while states:
            if last in states:
                found = at
            if at >= len(hashes):
                break
            word = int(hashes[at])
            states = self.closure({to for s in states for on, to in self.edges[s] if on in (ANY, word)})
            at += 1
        return found


def compiled(label: str, template: str) -> Automaton:
    edges: list[list[tuple[int, int]]] = [[]]
    free: list[list[int]] = [[]]
    opened: list[int] = []
    runs: list[list[int]] = [[]]
    before, longest, at_longest = 0, [], 0

    def state() -> int:
        edges.append([])
        free.append([])
        return len(edges) - 1

    for token in re.findall(r"\[\[|\]\]|\{\{\w+:\d+\}\}|[^\s\[\]{}]+", template):
        now = len(edges) - 1
        if token == "[[":
            opened.append(now)
            runs.append([])
        elif token == "]]":
            free[opened.pop()].append(now)
            runs.append([])
        elif token.startswith("{{"):
            most = int(token.strip("{}").split(":")[1])
            for _ in range(most):
                here = len(edges) - 1
                edges[here].append((ANY, state()))
                free[here].append(now + most)
            before += most
            runs.append([])
        else:
            edges[now].append((word_hash(token), state()))
            before += 1
            if not opened:
                runs[-1].append(word_hash(token))
                if len(runs[-1]) > len(longest):
                    longest, at_longest = list(runs[-1]), before - len(runs[-1])
    if opened or not longest:
        raise ValueError(f"template {label}: unclosed markup or no mandatory words")
    return Automaton(label, edges, free, longest, at_longest)


def run_places(found: Words, run: list[int]) -> np.ndarray:
    """Word numbers (over all texts) where these words stand consecutively in one text."""
    h, n = found.hash, len(found.hash) - len(run) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(h[:n] == np.uint64(run[0]))
    for k in range(1, len(run)):
        at = at[h[at + k] == np.uint64(run[k])]
    return at[found.doc[at] == found.doc[at + len(run) - 1]]


def template_places(found: Words, automaton: Automaton) -> list[tuple[int, int, int]]:
    """(text, start, end) of the template's accepted runs, one for each place of its anchor."""
    out = []
    for at in run_places(found, automaton.anchor):
        k = int(found.doc[at])
        lo, hi = int(found.first[k]), int(found.first[k + 1])
        own = found.hash[lo:hi]
        here = int(at) - lo
        for start in range(max(0, here - automaton.before), here + 1):
            end = automaton.accepts_at(own, start)
            if end is not None and end >= here + len(automaton.anchor):
                out.append((k, start, end))
                break
    return out


def _scanner(base: dict[str, str], templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = [([word_hash(w) for w in phrase.split()], label) for phrase, label in base.items()]
        automata = [compiled(label, t) for label, t in templates.items()]
        for batch in batches:
            n = batch.num_rows
            n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            own: list[set[str]] = [set() for _ in range(n)]
            more: list[set[str]] = [set() for _ in range(n)]
            for lo, _, data, offsets in chunks(batch.column("text")):
                found = words(data, offsets)
                n_words[lo:lo + len(offsets) - 1] = found.counts()
                for hashes, label in phrases:
                    at = run_places(found, hashes)
                    row, place = found.doc[at] + lo, at - found.first[found.doc[at]]
                    np.add.at(n_base, row, 1)
                    np.minimum.at(first, row, place)
                    np.maximum.at(last, row, place)
                    for r in np.unique(row):
                        own[r].add(label)
                for automaton in automata:
                    for k, _, _ in template_places(found, automaton):
                        more[k + lo].add(automaton.label)
            none = n_base == 0
            score = [1.0 if m else 0.5 if o else 0.0 for o, m in zip(own, more, strict=True)]
            names = [f.name for f in batch.schema if f.name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(n_words), pa.array(n_base),
                 pa.array(first, mask=none), pa.array(last, mask=none),
                 pa.array([",".join(sorted(o)) for o in own], pa.string()),
                 pa.array([",".join(sorted(o | m)) for o, m in zip(own, more, strict=True)], pa.string()),
                 pa.array(score, pa.float64())],
                names=[*names, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan(docs: DataFrame, base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with text replaced by n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 with an accepted template, 0.5 with base places alone, else 0.
    """
    docs = docs.drop("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest),
                        "n_words long, n_base long, first_word long, last_word long",
                        "base_labels string, labels string, score double"])
    return docs.mapInArrow(_scanner(BASE if base is None else base, TEMPLATES if templates is None else templates), schema)
