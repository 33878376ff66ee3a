"""License scans: templates with optional and replaceable regions, compiled into token automata.

A template is plain wording with markup: `<<optional>> ... <<end>>` may be left out, `<<any a|b>>` stands for one of a
few words, and `<<var 0 9>>` for any 0 to 9 words. All other wording is mandatory and has to match word for word. A
text is scanned from each place where a template's first word stands; the longest accepted stretch counts.

Words are runs of ASCII letters and digits and of any other non-ASCII characters, A to Z taken as a to z. Beside the
templates' labels, fixed phrases give base labels wherever their words stand consecutively. Null and empty texts have
no words and no labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from lectern.llm.common import per_text

#: Phrases of the base scan and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: What the two BSD licenses have in common. Fixed values but for the markup.
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: <<optional>>1<<end>> Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. <<optional>>2<<end>> Redistributions in binary form must reproduce the above copyright notice,
    this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<var 1 12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
    THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var 1 12>> BE
    LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT
    OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
    THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""

#: Wording of licenses and of the usual notices that name them; those named -text are whole. Fixed values but for the markup.
TEMPLATES = {
    "mit-notice": """<<any released|licensed|distributed|provided|available>> under the <<optional>>terms of the<<end>> MIT License""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice <<optional>>(including the next paragraph)<<end>> shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL <<var 1 12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE""",
    "apache-2.0-notice": """<<any released|licensed|distributed|provided|available>> under the <<optional>>terms of the<<end>> Apache License
        <<optional>>Version<<end>> 2.0<<optional>> (the "License")<<end>>""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at <<var 3 12>> Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
        ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
        under the License""",
    "gpl-2.0-notice": """licensed under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>as published by the Free Software
        Foundation<<end>> <<any version|v>> 2""",
    "gpl-3.0-notice": """licensed under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>as published by the Free Software
        Foundation<<end>> <<any version|v>> 3""",
    "gpl-header": """is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version <<any 2|3>> of the License, or (at your option) any later version""",
    "cc-by-notice": """<<any released|licensed|distributed|available>> under <<optional>>a<<end>> <<optional>>the<<end>> CC BY
        <<optional>>4.0<<end>> <<optional>>3.0<<end>> <<optional>>license<<end>>""",
    "cc-by-sa-notice": """<<any released|licensed|distributed|available>> under <<optional>>a<<end>> <<optional>>the<<end>> CC BY SA""",
    "cc-by-nc-notice": """<<any released|licensed|distributed|available>> under <<optional>>a<<end>> <<optional>>the<<end>> CC BY NC""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND <<var 1 12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL <<var 1 12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE""",
    "bsd-2-clause-text": _BSD_GRANT + _BSD_DISCLAIMER,
    "bsd-3-clause-text": _BSD_GRANT + """<<optional>>3<<end>> Neither the name of <<var 1 12>> nor the names of <<any its|their|the>> contributors may be used to
        endorse or promote products derived from this software without specific prior written permission """ + _BSD_DISCLAIMER,
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
        any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
        <<optional>>1<<end>> The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
        not required. <<optional>>2<<end>> Altered source versions must be plainly marked as such, and must not be misrepresented as
        being the original software. <<optional>>3<<end>> This notice may not be removed or altered from any source distribution""",
    "bsl-1.0-text": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
        transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
        furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including
        the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in
        whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
        machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
        ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE,
        TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY
        DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
        THE USE OR OTHER DEALINGS IN THE SOFTWARE""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at <<var 1 9>>""",
    "lgpl-header": """it under the terms of the GNU <<any Lesser|Library>> General Public License as published by the Free Software Foundation
        <<any either|version>>""",
    "agpl-header": """it under the terms of the GNU Affero General Public License as published by the Free Software Foundation""",
    "cc0-notice": """<<any released|licensed|distributed|available|dedicated>> under <<optional>>the<<end>> CC0 <<optional>>1.0<<end>>""",
}

#: All ASCII that isn't a letter or a digit parts words; A to Z become a to z.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class Automaton:
    """The token automaton of one template: a state for each place between words, made deterministic as texts ask for it."""

    def __init__(self, template: str) -> None:
        self.arcs: list[list[tuple[frozenset | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        self.mandatory: list[bytes] = []
        at, open_at = 0, []
        for mark, plain in re.findall(r"<<(.*?)>>|((?:(?!<<).)+)", template, re.S):
            kind, *args = mark.split() if mark else ("text",)
            if kind == "text":
                for word in words_of(plain):
                    at = self._arc(at, frozenset([word]))
                    if not open_at:
                        self.mandatory.append(word)
            elif kind == "any":
                at = self._arc(at, frozenset(w.encode() for w in args[0].split("|")))
            elif kind == "var":
                least, most = map(int, args)
                skips = []
                for k in range(most):
                    if k >= least:
                        skips.append(at)
                    at = self._arc(at, None)
                for s in skips:
                    self.free[s].append(at)
            elif kind == "optional":
                open_at.append(at)
            elif kind == "end":
                self.free[open_at.pop()].append(at)
            else:
                raise ValueError(f"unknown markup <<{mark}>>")
        if open_at:
            raise ValueError("<<optional>> without <<end>>")
        self.final = at
        self.states = {(start := self._closed({0})): 0}
        self.sets, self.moves, self.accepts = [start], [{}], [at in start]
        self.first = set().union(*(w for s in start for w, _ in self.arcs[s] if w))
        if self.accepts[0] or any(w is None for s in start for w, _ in self.arcs[s]):
            raise ValueError("a template has to start with wording")

    def _arc(self, at: int, words: frozenset | None) -> int:
        self.arcs.append([])
        self.free.append([])
        self.arcs[at].append((words, len(self.arcs) - 1))
        return len(self.arcs) - 1

    def _closed(self, states: set[int]) -> frozenset:
        todo, found = list(states), set(states)
        while todo:
            for nxt in self.free[todo.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return frozenset(found)

    def step(self, state: int, word: bytes) -> int:
        """The next state, or -1; words that no arc names share one entry, so the table stays small."""
        move = self.moves[state]
        if word not in move:
            named = any(w and word in w for s in self.sets[state] for w, _ in self.arcs[s])
            key = word if named else None
            if key not in move:
                to = self._closed({t for s in self.sets[state] for w, t in self.arcs[s] if w is None or word in w})
                if to and to not in self.states:
                    self.states[to] = len(self.sets)
                    self.sets.append(to)
                    self.moves.append({})
                    self.accepts.append(self.final in to)
                move[key] = self.states[to] if to else -1
            return move[key]
        return move[word]

    def match(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted stretch that starts at a word, or -1."""
        state, end = 0, -1
        for k in range(at, len(words)):
            state = self.step(state, words[k])
            if state < 0:
                break
            if self.accepts[state]:
                end = k + 1
        return end


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> None:
        self.automata = {label: Automaton(t) for label, t in templates.items()}
        self.by_first: dict[bytes, list[str]] = {}
        for label, a in self.automata.items():
            for word in a.first:
                self.by_first.setdefault(word, []).append(label)
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        # a text that has none of these words has no place for any template or phrase
        self.needed = {max(p, key=len) for p, _ in self.phrases}
        for a in self.automata.values():
            self.needed |= {max(a.mandatory, key=len)} if a.mandatory else a.first

    def spans(self, words: list[bytes]) -> Iterator[tuple[int, int, str]]:
        """(first word, end, label) of each accepted stretch."""
        for k, word in enumerate(words):
            for label in self.by_first.get(word, ()):
                if (end := self.automata[label].match(words, k)) >= 0:
                    yield k, end, label

    def places(self, words: list[bytes]) -> Iterator[tuple[int, str]]:
        """(first word, label) of each place of a base phrase."""
        for k, word in enumerate(words):
            for phrase, label in self.phrases:
                if word == phrase[0] and words[k : k + len(phrase)] == phrase:
                    yield k, label

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        if self.needed.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0, []
        base, found = list(self.places(words)), list(self.spans(words))
        labels = {b for _, b in base}
        score = max([0.5 if base else 0.0, *(len(self.automata[label].mandatory) / (end - at) for at, end, label in found)])
        return len(words), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {f[2] for f in found})), min(1.0, score), [f"{label}:{at}:{end}" for at, end, label in found]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: counts of words and base places, labels, and the accepted stretches (label:first word:end).

    score is the largest share of mandatory words in an accepted stretch, 0.5 where only a base phrase stands, else 0.
    """

    def make():
        scanner = Scanner()
        return lambda texts: [scanner.scan(t) for t in texts]

    return per_text(df, id_col, text_col, "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, stretches array<string>", make)
