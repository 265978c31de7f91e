"""License scans by template-markup matching.

A template is the wording of a license notice with markup: `[[...]]` encloses optional text and
`{{a..b}}` stands for a to b words of any kind. Each template is compiled into a token automaton:
states are places in the wording, optional regions add empty moves, replaceable regions loops of
bounded length. A text has the template's label where the automaton accepts a run of its words,
which needs every mandatory word, exactly and in order. Only places where a template can start are
tried, and the automaton keeps a set of states, so work stays in proportion to the text.

Base phrases are found too, as consecutive words. Words are runs of digits, ASCII letters (lower-cased)
and characters beyond ASCII.

Defined results: a null text counts as empty: no words, empty labels, score 0. score is the share of
the mandatory words of a template that its best partial run reaches, 1 for a match or a base
phrase, and depends on nothing else in the text. A template that could start with any word is an error. Repeated rows and null ids are scanned like others. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_BSD = """redistribution and use in source and binary forms with or without modification are permitted [[{{1..6}}]] provided that the following conditions are met
[[{{1..1}}]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
[[{{1..1}}]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"""
_DISCLAIMER = """this software is provided by {{1..12}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"""

#: Fixed values: (label, template), notices in the words of their licenses. Versions and holders are replaceable, articles and set phrases optional.
TEMPLATES = (
    ("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so
subject to the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software
[[the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
in no event shall the {{1..6}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software]]"""),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "[[this {{1..4}} is]] released under the [[terms of the]] mit license"),
    ("mit", "[[this {{1..4}} is]] licensed under the [[terms of the]] mit license"),
    ("isc", """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
[[the software is provided as is and {{1..8}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness]]"""),
    ("bsd", f"{_BSD} [[{_DISCLAIMER}]]"),
    ("bsd", f"{_BSD} [[{{{{1..1}}}}]] [[all advertising materials {{{{8..30}}}}]] neither the name of {{{{1..12}}}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission [[{_DISCLAIMER}]]"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("bsd", "licensed under the [[terms of the]] [[{{1..1}}]] [[new]] bsd [[{{1..1}} clause]] license"),
    ("apache", """licensed under the apache license version {{1..2}} the license [[you]] [[{{1..3}}]] may not use this file except in compliance with the license you may obtain a copy of the license at {{1..12}}
unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied
see the license for the specific language governing permissions and limitations under the license"""),
    ("apache", "[[this {{1..4}} is]] licensed under the apache license version {{1..2}}"),
    ("apache", "apache license version {{1..2}} [[january 2004]]"),
    ("gpl", """this {{1..3}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[library]] [[affero]] general public license as published by the free software foundation either version {{1..2}} of the license or [[at your option]] any later version
[[this {{1..3}} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu [[lesser]] [[library]] [[affero]] general public license for more details]]"""),
    ("gpl", "[[this {{1..4}} is]] licensed under the [[terms of the]] gnu [[lesser]] [[affero]] general public license [[version {{1..2}}]]"),
    ("gpl", "under the terms of the gnu [[lesser]] [[affero]] general public license as published by the free software foundation"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license [[v]] [[version]] {{1..2}} if a copy of the mpl was not distributed with this file you can obtain one at {{1..8}}"),
    ("mpl", "subject to the terms of the mozilla public license [[v]] [[version]] {{1..2}}"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("unlicense", "this is free and unencumbered software released into the public domain [[anyone is free to copy modify publish use compile sell or distribute this software]]"),
    ("cc-by", "this work is licensed under [[a]] [[the]] creative commons attribution [[noncommercial]] [[sharealike]] [[noderivatives]] [[noderivs]] [[{{1..2}} international]] [[{{1..2}} unported]] license"),
    ("cc-by", "[[this {{1..4}} is]] licensed under [[a]] [[the]] creative commons attribution [[{{1..3}}]] license"),
    ("cc-by", "licensed under cc by [[nc]] [[sa]] [[nd]] {{1..2}}"),
    ("cc0", "has waived all copyright and related [[or neighboring]] rights"),
    ("reserved", "copyright [[c]] {{1..8}} all rights reserved"),
)


class Automaton:
    """Token automaton of a template: moves[state] is a list of (word or None for any, next state)."""

    def __init__(self, template: str) -> None:
        parts = re.findall(r"\[\[|\]\]|\{\{\d+\.\.\d+\}\}|[^\s\[\]{}]+", template)
        self.moves: list[list[tuple[str | None, int]]] = [[]]
        self.empty: list[list[int]] = [[]]
        self.fixed = [0]  # mandatory words on the way to a state
        self.words: list[str] = []  # mandatory ones
        open_at: list[int] = []
        at = 0
        for part in parts:
            if part == "[[":
                open_at.append(at)
            elif part == "]]":
                start, at = open_at.pop(), self._state(at, self.fixed[at])
                self.empty[at - 1].append(at)
                self.empty[start].append(at)
            elif part.startswith("{{"):
                low, high = map(int, part[2:-2].split(".."))
                ends = []
                for i in range(high):
                    if i >= low:
                        ends.append(at)
                    at = self._move(at, None, 0)
                for s in ends:
                    self.empty[s].append(at)
            else:
                at = self._move(at, part, 0 if open_at else 1)
                if not open_at:
                    self.words.append(part)
        self.end, self.mandatory = at, self.fixed[at]
        self.first = {w for s in self._closure({0}) for w, _ in self.moves[s]}

    def _state(self, before: int, fixed: int) -> int:
        self.moves.append([])
        self.empty.append([])
        self.fixed.append(fixed)
        return len(self.moves) - 1

    def _move(self, at: int, word: str | None, fixed: int) -> int:
        new = self._state(at, self.fixed[at] + fixed)
        self.moves[at].append((word, new))
        return new

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def run(self, words: list[str], start: int) -> tuple[int, float]:
        """End of the longest accepted run from start (or -1), and the share of mandatory words reached."""
        states, best, reached = self._closure({0}), -1, 0
        for i in range(start, len(words)):
            word = words[i]
            states = self._closure({t for s in states for w, t in self.moves[s] if w is None or w == word})
            if not states:
                break
            reached = max(reached, *(self.fixed[s] for s in states))
            if self.end in states:
                best = i + 1
        return best, 1.0 if best >= 0 else reached / max(1, self.mandatory)


class Scanner:
    """Finds base phrases and templates in texts."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> None:
        self.automata = [(label, Automaton(t)) for label, t in templates]
        self.phrases = [(p.split(), label) for p, label in phrases.items()]
        self.starts: dict[str, list[tuple[str, Automaton]]] = {}
        for label, a in self.automata:
            if None in a.first:
                raise ValueError(f"a template of {label} can start with any word")
            for word in a.first:
                self.starts.setdefault(word, []).append((label, a))

    def scan(self, text: str | None) -> dict:
        low = (text or "").translate(UPPER)
        words = WORDS.findall(low)
        places, base, matches, best = [], set(), [], 0.0
        for phrase, label in self.phrases:
            if phrase[-1] in low:
                at = -1
                while True:
                    try:
                        at = words.index(phrase[0], at + 1)
                    except ValueError:
                        break
                    if words[at : at + len(phrase)] == phrase:
                        places.append(at)
                        base.add(label)
        starts = self.starts
        for i in [i for i, word in enumerate(words) if word in starts]:
            for label, a in starts[words[i]]:
                end, share = a.run(words, i)
                best = max(best, share)
                if end >= 0:
                    matches.append((label, i, end))
        return {"n_words": len(words), "places": sorted(places), "base": sorted(base), "matches": matches, "score": 1.0 if places else round(best, 6)}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places, base, matches, score) for each row: word indexes of base phrases, and (label, start, end) of templates."""
    found = "struct<label:string,first:int,stop:int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        match = pa.struct([("label", pa.string()), ("first", pa.int32()), ("stop", pa.int32())])
        for batch in batches:
            rows = [scanner.scan(x.as_py()) for x in batch.column(1)]
            col = lambda name, kind: pa.array([r[name] for r in rows], kind)
            matches = pa.array([[dict(zip(("label", "first", "stop"), m, strict=True)) for m in r["matches"]] for r in rows], pa.list_(match))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), col("n_words", pa.int64()), col("places", pa.list_(pa.int64())), col("base", pa.list_(pa.string())), matches, col("score", pa.float64())],
                ["doc_id", "n_words", "places", "base", "matches", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, places array<long>, base array<string>, matches array<{found}>, score double")


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "matches.label")), ",").alias("labels"),
        "score",
    )
