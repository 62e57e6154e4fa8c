"""Licence texts and notices: templates with optional and replaceable regions as token automata.

A template is compiled to an automaton over words that is run with one bit per state.  Its wording
is mandatory word by word; ``[...]`` may be missing, ``{n}`` stands for up to n words of any kind,
``a/b`` for one of several words.  A text is accepted if a run reaches the end: then all mandatory
wording matches exactly, wherever in the text it stands.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import append_columns

#: Every ASCII character that is no letter or digit becomes a space, A-Z become lower case.
WORDS = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)
#: Phrases of the contract and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: What stands in several templates: terms of the two BSD texts, and their disclaimer.
BSD_TERMS = """redistribution and use in source and binary forms with or without modification are permitted
    provided that the following conditions are met [1] redistributions of source code must retain the above
    copyright notice this list of conditions and the following disclaimer [2] redistributions in binary form
    must reproduce the above copyright notice this list of conditions and the following disclaimer in the
    documentation and or other materials provided with the distribution"""
BSD_NAMES = """[3] neither the name of {12} nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission"""
BSD_DISCLAIMER = """this software is provided by {12} as is and any express or implied warranties including but
    not limited to the implied warranties of merchantability and fitness for a particular purpose are
    disclaimed in no event shall {12} be liable for any direct indirect incidental special exemplary or
    consequential damages including but not limited to procurement of substitute goods or services loss of
    use data or profits or business interruption however caused and on any theory of liability whether in
    contract strict liability or tort including negligence or otherwise arising in any way out of the use of
    this software even if advised of the possibility of such damage"""
#: Label and markup of each template (public licence texts, the notices that the longer licences
#: prescribe, and usual short notices; fixed values).
TEMPLATES: dict[str, str] = {
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this
        software and associated documentation files the software to deal in the software without
        restriction including without limitation the rights to use copy modify merge publish distribute
        sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this
        permission notice [including the next paragraph] shall be included in all copies or substantial
        portions of the software the software is provided as is without warranty of any kind express or
        implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and noninfringement in no event shall {12} be liable for any claim damages or other
        liability whether in an action of contract tort or otherwise arising from out of or in connection
        with the software or the use or other dealings in the software""",
    "isc-text": """permission to use copy modify and or distribute this software for any purpose with or
        without fee is hereby granted provided that the above copyright notice and this permission notice
        appear in all copies the software is provided as is and {12} disclaims/disclaim all warranties with
        regard to this software including all implied warranties of merchantability and fitness in no event
        shall {12} be liable for any special direct indirect or consequential damages or any damages
        whatsoever resulting from loss of use data or profits whether in an action of contract negligence
        or other tortious action arising out of or in connection with the use or performance of this
        software""",
    "bsd-2-text": f"{BSD_TERMS} {BSD_DISCLAIMER}",
    "bsd-3-text": f"{BSD_TERMS} {BSD_NAMES} {BSD_DISCLAIMER}",
    "zlib-text": """this software is provided as is without any express or implied warranty in no event will
        {12} be held liable for any damages arising from the use of this software permission is granted to
        anyone to use this software for any purpose including commercial applications and to alter it and
        redistribute it freely subject to the following restrictions [1] the origin of this software must
        not be misrepresented you must not claim that you wrote the original software if you use this
        software in a product an acknowledgment in the product documentation would be appreciated but is
        not required [2] altered source versions must be plainly marked as such and must not be
        misrepresented as being the original software [3] this notice may not be removed or altered from
        any source distribution""",
    "apache-header": """licensed under the apache license version 2 0 the license you may not use this file
        except in compliance with the license you may obtain a copy of the license at http/https www apache
        org licenses license 2 0 unless required by applicable law or agreed to in writing software
        distributed under the license is distributed on an as is basis without warranties or conditions of
        any kind either express or implied see the license for the specific language governing permissions
        and limitations under the license""",
    "gpl-header": """free software you can redistribute it and or modify it under the terms of the gnu
        [lesser/affero] general public license as published by the free software foundation either version
        2/3 [1] of the license or at your option any later version {6} is distributed in the hope that it
        will be useful but without any warranty without even the implied warranty of merchantability or
        fitness for a particular purpose see the gnu [lesser/affero] general public license for more
        details""",
    "mpl-header": """this source code form is subject to the terms of the mozilla public license v 2 0 if a
        copy of the mpl was not distributed with this file you can obtain one at http/https mozilla org mpl
        2 0""",
    "apache-notice": "licensed/released/distributed under [the terms of] the apache license",
    "gpl-notice": "licensed/released/distributed under [the terms of] the gnu [lesser/affero] general public license",
    "mit-notice": "licensed/released/distributed under [the terms of] the mit license",
    "mpl-notice": "licensed/released/distributed under [the terms of] the mozilla public license",
    "cc-by-notice": """licensed/released/distributed under [the terms of] [a/the] [creative commons
        [attribution]] cc by""",
}


class Automaton:
    """States 0..n; an edge from each state to the next consumes a word, others consume nothing."""

    def __init__(self, markup: str) -> None:
        self.edges: list[frozenset[str] | None] = []  # None: any word
        self.mandatory: list[bool] = []
        jumps: list[tuple[int, int]] = []
        opened: list[int] = []
        for item in re.findall(r"\[|\]|\{\d+\}|[^\s\[\]{}]+", markup):
            at = len(self.edges)
            if item == "[":
                opened.append(at)
            elif item == "]":
                jumps.append((opened.pop(), at))
            elif item[0] == "{":
                end = at + int(item[1:-1])
                jumps += [(k, end) for k in range(at, end)]
                self.edges += [None] * (end - at)
                self.mandatory += [False] * (end - at)
            else:
                self.edges.append(frozenset(item.encode().split(b"/")))
                self.mandatory.append(not opened)
        self.end = len(self.edges)
        #: For each state the states reached without a word, itself included.
        reach = [1 << k for k in range(self.end + 1)]
        for a, b in sorted(jumps, reverse=True):
            reach[a] |= reach[b]
        self.reach = reach
        self.jumping = sum(1 << k for k, r in enumerate(reach) if r != 1 << k)
        self.any = sum(1 << k for k, e in enumerate(self.edges) if e is None)
        self.words: dict[bytes, int] = {}
        for k, edge in enumerate(self.edges):
            for word in edge or ():
                self.words[word] = self.words.get(word, 0) | 1 << k
        #: Mandatory words before each state.
        self.done = [sum(self.mandatory[:k]) for k in range(self.end + 1)]
        self.first = self.edges[0]

    def closed(self, states: int) -> int:
        todo = states & self.jumping
        while todo:
            low = todo & -todo
            todo ^= low
            states |= self.reach[low.bit_length() - 1]
        return states

    def starts(self, words: list[bytes]) -> list[int]:
        """Places of words that a match may begin with, in order."""
        return [k for k, w in enumerate(words) if w in self.first]

    def run(self, words: list[bytes], starts: list[int]) -> float:
        """1.0 if the template matches from one of ``starts`` on, else the share of its mandatory words
        that the longest run got through (a first word alone counts for nothing).

        All runs go through the text together, as bits of one number, and a new one joins at each
        start: every word is looked at once.
        """
        best, accept = 0, 1 << self.end
        begin, fresh = self.closed(1), set(starts)
        for start in starts:
            states, at = 0, start
            if start not in fresh:
                continue  # passed by runs that began before
            while at < len(words):
                if at in fresh:
                    fresh.discard(at)
                    states |= begin
                elif not states:
                    break
                word = words[at]
                states = self.closed((states & (self.words.get(word, 0) | self.any)) << 1)
                if states & accept:
                    return 1.0
                if states:
                    best = max(best, self.done[states.bit_length() - 1])
                at += 1
        return best / self.done[self.end] if best > 1 else 0.0


@lru_cache(maxsize=1)
def automata() -> dict[str, Automaton]:
    return {label: Automaton(markup) for label, markup in TEMPLATES.items()}


def scan(text: bytes | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = (text or b"").translate(WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for phrase, label in PHRASES.items():
        needle = b" %s " % phrase.encode()
        at, seen, number = joined.find(needle), 0, 0
        while at >= 0:
            number += joined.count(b" ", seen, at)  # words between this place and the last
            seen = at
            places.append(number)
            base.add(label)
            at = joined.find(needle, at + 1)
    labels, score = set(base), 0.0
    for label, automaton in automata().items():
        if any(b" %s " % word in joined for word in automaton.first):
            got = automaton.run(words, automaton.starts(words))
            score = max(score, got)
            if got == 1.0:
                labels.add(label)
    return (
        len(words),
        len(places),
        min(places) if places else None,
        max(places) if places else None,
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
    )


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
]


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``labels`` holds the base labels and the label of every template that accepts; ``score`` is 1.0
    if one accepts, else the largest share of mandatory words that a run matched in order before it
    failed.  A null or empty text has no words, no places, empty labels and score 0.  Repeated rows
    give repeated results, other columns are not read, an empty table gives an empty result.
    """

    def compute(texts):
        return list(zip(*map(scan, texts), strict=True))

    return append_columns(docs, text_col, compute, FIELDS, [id_col])
