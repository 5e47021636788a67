"""License scan: templates with optional and replaceable regions, compiled into token automata.

A template is words and markup:

* ``<opt> ... </opt>``: the words may be left out;
* ``<alt> a | b c </alt>``: one of the wordings;
* ``<var:1-6>``: one to six words of any kind (a name, a year).

Everything outside of markup is mandatory and must be met word for word. All templates go into one automaton over words;
its sets of states are turned into table rows as texts need them, so a word costs one dictionary look-up and only where a
template can begin. Plain phrases are templates without markup.

A text is lower-cased (A-Z) and cut into words of ASCII letters, digits and non-ASCII characters.

Defined cases: a null or empty text has no words and no notices. Overlapping notices are all reported; of one template that
fits at one place in several lengths, the longest. Repeated rows are scanned alike. Extra columns are not read. Texts may have any
length: a task holds the words of one text. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from atlaslex.llm.batches import LOWER_CASE, text_bytes, text_function

#: Phrase -> label; a mention, whatever stands around it.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_UNDER = "<alt> licensed under | licenced under | released under | distributed under | available under | published under </alt>"
_TERMS = "<opt> <alt> the | a | an </alt> <opt> terms of the </opt> </opt>"
_VERSION = "<opt> <alt> version | v </alt> </opt>"
_CC = "<alt> <opt> creative commons </opt> cc | creative commons </alt>"
_NUMBER = "<alt> 1 | 2 | 3 | 4 </alt> <alt> 0 | 5 </alt> <opt> <alt> international | unported | generic </alt> </opt> <opt> license </opt>"
_LATER = "<opt> <opt> of the license </opt> or <opt> at your option </opt> <opt> any </opt> later <opt> version </opt> </opt>"
_AS_IS = "provided <alt> as is | by the <alt> copyright holders and contributors | <var:1-8> </alt> as is </alt>"


def _version(number: str) -> str:
    """A version number with or without what announces it."""
    first, *rest = number.split()
    return " ".join([f"<alt> {_VERSION} {first} | v{first} </alt>", *rest])


def _cc(short: str, long: str) -> str:
    """A Creative Commons notice by its letters or its name."""
    return f"{_UNDER} {_TERMS} <alt> {_CC} {short} | creative commons {long} </alt> {_VERSION} {_NUMBER}"


#: Label -> template; a whole notice or the whole mandatory wording of a licence.
TEMPLATES = {
    "apache-2.0-notice": f"{_UNDER} {_TERMS} apache license {_version('2 0')}",
    "cc-by-notice": _cc("by", "attribution"),
    "cc-by-sa-notice": _cc("by sa", "attribution <alt> share alike | sharealike </alt>"),
    "cc-by-nd-notice": _cc("by nd", "attribution <alt> no derivatives | noderivatives | noderivs </alt>"),
    "cc-by-nc-notice": _cc("by nc", "attribution <alt> non commercial | noncommercial </alt>"),
    "cc-by-nc-sa-notice": _cc("by nc sa", "attribution <alt> non commercial | noncommercial </alt> <alt> share alike | sharealike </alt>"),
    "cc-by-nc-nd-notice": _cc("by nc nd", "attribution <alt> non commercial | noncommercial </alt> <alt> no derivatives | noderivatives | noderivs </alt>"),
    "cc0-notice": f"{_UNDER} {_TERMS} <alt> <opt> creative commons </opt> cc0 | creative commons zero </alt> {_VERSION} <opt> 1 0 <opt> universal </opt> </opt>",
    "gpl-2.0-notice": f"{_UNDER} {_TERMS} gnu general public license {_version('2 <opt> 0 </opt>')} {_LATER}",
    "gpl-3.0-notice": f"{_UNDER} {_TERMS} gnu general public license {_version('3 <opt> 0 </opt>')} {_LATER}",
    "lgpl-notice": f"{_UNDER} {_TERMS} gnu <alt> lesser | library </alt> general public license <alt> {_version('2 <opt> 1 </opt>')} | {_version('3')} </alt> {_LATER}",
    "agpl-3.0-notice": f"{_UNDER} {_TERMS} gnu affero general public license {_version('3 <opt> 0 </opt>')} {_LATER}",
    "mpl-2.0-notice": f"<alt> {_UNDER} {_TERMS} | subject to the terms of the </alt> mozilla public license {_version('2 0')}",
    "bsd-notice": f"{_UNDER} {_TERMS} <opt> <alt> 2 | 3 | two | three </alt> clause </opt> <opt> <alt> new | simplified | modified </alt> </opt> bsd <opt> <alt> 2 | 3 </alt> clause </opt> license",
    "mit-notice": f"{_UNDER} {_TERMS} mit license",
    "mit-license": "permission is hereby granted free of charge to any person obtaining a copy of <alt> this software | <var:1-8> </alt> and associated documentation files "
        "<alt> the software | <var:1-8> </alt> to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice <opt> including the next paragraph </opt> shall be included in all copies or substantial portions of the software the software is "
        "provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
        "<alt> noninfringement | non infringement </alt> in no event shall <var:2-12> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software",
    "isc-license": "permission to use copy modify and <opt> or </opt> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice "
        "and this permission notice appear in all copies the software is provided as is and <var:1-8> disclaims all warranties with regard to this software",
    "bsd-license": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <opt> 1 </opt> redistributions of "
        "source code must retain the above copyright notice this list of conditions and the following disclaimer <opt> 2 </opt> redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution <opt> <opt> 3 </opt> neither the name of <var:1-12> "
        f"may be used to endorse or promote products derived from this software without specific prior written permission </opt> this software is {_AS_IS} and any express or implied warranties",
    "all-rights-reserved": "copyright <opt> c </opt> <var:1-8> all rights reserved",
}

#: Every byte that is no letter, digit or part of a non-ASCII character becomes a space; A-Z become lower case.
WORDS = bytes(
    c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in bytes(range(256)).translate(LOWER_CASE)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.translate(WORDS).split()


@dataclass
class Automaton:
    """States with word, any-word and empty moves; accepting states carry labels."""

    words: list[dict[bytes, set[int]]] = field(default_factory=list)
    anything: list[set[int]] = field(default_factory=list)
    empty: list[set[int]] = field(default_factory=list)
    labels: dict[int, str] = field(default_factory=dict)

    def state(self) -> int:
        self.words.append({})
        self.anything.append(set())
        self.empty.append(set())
        return len(self.words) - 1

    def add(self, at: int, template: str, label: str) -> None:
        """Compile a template from state ``at``."""
        tokens = template.split()[::-1]
        self.labels[self._sequence(at, tokens)] = label
        if tokens:
            raise ValueError(f"{label}: markup ends too early: {template}")

    def _sequence(self, at: int, tokens: list[str]) -> int:
        while tokens and tokens[-1] not in ("|", "</alt>", "</opt>"):
            token = tokens.pop()
            if token == "<opt>":
                end = self._sequence(at, tokens)
                self._close(tokens, "</opt>")
                self.empty[at].add(end)
                at = end
            elif token == "<alt>":
                end = self.state()
                self.empty[self._sequence(self._branch(at), tokens)].add(end)
                while tokens and tokens[-1] == "|":
                    tokens.pop()
                    self.empty[self._sequence(self._branch(at), tokens)].add(end)
                self._close(tokens, "</alt>")
                at = end
            elif token.startswith("<var:"):
                low, high = map(int, token[5:-1].split("-"))
                end = self.state()
                for i in range(high):
                    following = self.state()
                    self.anything[at].add(following)
                    at = following
                    if i + 1 >= low:
                        self.empty[at].add(end)
                at = end
            else:
                following = self.state()
                self.words[at].setdefault(token.encode(), set()).add(following)
                at = following
        return at

    def _branch(self, at: int) -> int:
        start = self.state()
        self.empty[at].add(start)
        return start

    @staticmethod
    def _close(tokens: list[str], mark: str) -> None:
        if not tokens or tokens.pop() != mark:
            raise ValueError(f"{mark} is missing")

    def closure(self, states: set[int]) -> frozenset[int]:
        """The states and all that empty moves reach."""
        found, waiting = set(states), list(states)
        while waiting:
            for following in self.empty[waiting.pop()] - found:
                found.add(following)
                waiting.append(following)
        return frozenset(found)


class Scanner:
    """All templates at once; rows of the table are made when a text first needs them."""

    def __init__(self, templates: dict[str, str]):
        self.automaton = Automaton()
        start = self.automaton.state()
        for label, template in templates.items():
            self.automaton.add(self.automaton._branch(start), template, label)
        self.start = self.automaton.closure({start})
        self.first = {word for state in self.start for word in self.automaton.words[state]}
        if any(self.automaton.anything[state] for state in self.start):
            raise ValueError("a template must begin with a word")
        self.moves: dict[tuple[frozenset[int], bytes], frozenset[int]] = {}
        self.known = {word for moves in self.automaton.words for word in moves}

    def step(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        """States after a word; words that stand in no template share one entry, so the table is bounded."""
        key = (states, word if word in self.known else b"")
        if key not in self.moves:
            reached = set()
            for state in states:
                reached |= self.automaton.anything[state] | self.automaton.words[state].get(word, set())
            self.moves[key] = self.automaton.closure(reached)
        return self.moves[key]

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, first word, number of words) of every place, in order of place and label."""
        found, first = [], self.first
        for place in [i for i, word in enumerate(words) if word in first]:
            states, at, longest = self.start, place, {}
            while states and at < len(words):
                states = self.step(states, words[at])
                at += 1
                for state in states & self.automaton.labels.keys():
                    longest[self.automaton.labels[state]] = at - place
            found += [(label, place, longest[label]) for label in sorted(longest)]
        return found


@cache
def scanner() -> Scanner:
    """The phrases and templates of this module, compiled once per Python worker."""
    return Scanner({label: phrase for phrase, label in PHRASES.items()} | TEMPLATES)


NOTICE = StructType([StructField("label", StringType()), StructField("first", LongType()), StructField("length", LongType())])
FIELDS = StructType([StructField("n_words", LongType()), StructField("notices", ArrayType(NOTICE))])


def _scan_texts(texts: list[bytes]) -> dict:
    found = {"n_words": [], "notices": []}
    for text in texts:
        words = words_of(text)
        found["n_words"].append(len(words))
        found["notices"].append([dict(zip(NOTICE.names, hit, strict=True)) for hit in scanner().scan(words)])
    return found


scan = text_function(FIELDS, _scan_texts)


def find_notices(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words`` and ``notices`` (label, first word, number of words) of every document."""
    return docs.select("doc_id", scan(text_bytes()).alias("s")).select("doc_id", "s.*")


def summary(notices: DataFrame) -> DataFrame:
    """Counts and labels of ``find_notices``: mentions are the phrases, labels are theirs and the whole notices'.

    ``score``: 1 if a whole notice was found, 0.5 if only a mention, else 0.
    """
    base = F.array(*map(F.lit, PHRASES.values()))
    mentions = F.filter("notices", lambda n: F.array_contains(base, n["label"]))
    labels = F.sort_array(F.array_distinct(F.transform("notices", lambda n: n["label"])))
    n_base, n_all = F.size("mentions"), F.size("notices")
    return notices.withColumn("mentions", mentions).select(
        "doc_id",
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.array_min(F.transform("mentions", lambda n: n["first"])).alias("first_word"),
        F.array_max(F.transform("mentions", lambda n: n["first"])).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("mentions", lambda n: n["label"]))), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(n_all > n_base, 1.0).when(n_base > 0, 0.5).otherwise(0.0).alias("score"),
    )
