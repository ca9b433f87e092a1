"""Operator 1, license scans: templates with optional and replaceable regions.

A template is plain wording with markup::

    released under the mit license <<beginOptional>>see the file <<endOptional>><<var;0;8>>

Wording is mandatory; the words between ``<<beginOptional>>`` and
``<<endOptional>>`` may be there or not (regions nest); ``<<var;lo;hi>>``
stands for ``lo`` to ``hi`` words of any kind. Each template is compiled once
into a token automaton; a place of a text is accepted when the automaton
reaches its end, that is when every mandatory word is there exactly and in
order. The longest acceptance from a place counts. A template begins with a
word (mandatory or optional), never with a replaceable region, so only the
places of its possible first words start an automaton.

Each text is scanned whole, on its own, in the task that reads it: no shuffle.

Defined cases: a null or empty text has no words and no matches; score 0.
Overlapping matches all count (places), ``score`` is the share of the words
that lie inside at least one match. Repeated rows are scanned each; an empty
table gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Templates of this operator: (label, wording with markup). License wording is fixed text.
TEMPLATES = (
    ("gpl-notice", "this <<var;1;2>> is licensed under the gnu general public license <<beginOptional>>version <<var;1;2>><<endOptional>>"
                   " <<beginOptional>>or any later version<<endOptional>>"),
    ("gpl-or-later", "either version 2 of the license or <<beginOptional>>at your option<<endOptional>> any later version"),
    ("apache-2.0", "licensed under the apache license version 2 0 <<beginOptional>>the license<<endOptional>>"),
    ("cc-by-nc", "licensed under <<beginOptional>>a<<endOptional>> cc by nc <<beginOptional>>sa<<endOptional>> <<var;0;2>>"),
    ("cc-by-sa", "licensed under <<beginOptional>>a<<endOptional>> cc by sa <<var;0;2>>"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> cc by 4 0"),
    ("mit-notice", "released under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("mit-text",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction including without limitation the"
     " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
     " persons to whom the software is furnished to do so subject to the following conditions the above copyright notice"
     " and this permission notice <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all"
     " copies or substantial portions of the software the software is provided as is without warranty of any kind express"
     " or implied including but not limited to the warranties of merchantability fitness for a particular purpose and"
     " noninfringement in no event shall <<var;1;12>> be liable for any claim damages or other liability whether in an"
     " action of contract tort or otherwise arising from out of or in connection with the software or the use or other"
     " dealings in the software"),
    ("isc-text",
     "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with"
     " or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all"
     " copies"),
    ("bsd-clauses",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the"
     " following conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code must retain the above"
     " copyright notice this list of conditions and the following disclaimer <<beginOptional>>2<<endOptional>>"
     " redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
     " disclaimer in the documentation and or other materials provided with the distribution"),
)

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;(\d+);(\d+))>>")


class Automaton:
    """A template compiled to states over words; ``longest`` runs it from a place.

    State ``s`` has word arcs ``arcs[s] = {word: closure}`` and, inside a
    replaceable region, ``any[s] = closure``; closures are sets of states with
    empty moves already followed.
    """

    def __init__(self, template: str):
        empty: list[list[int]] = [[]]
        word_to: list[tuple[bytes, int] | None] = [None]
        any_to: list[int | None] = [None]

        def state() -> int:
            empty.append([])
            word_to.append(None)
            any_to.append(None)
            return len(empty) - 1

        at, opened, last = 0, [], 0
        for m in [*_MARKUP.finditer(template), None]:
            for w in common.words(template[last : m.start() if m else len(template)].encode()):
                to = state()
                word_to[at], at = (w, to), to
                fresh = state()
                empty[at].append(fresh)
                at = fresh
            if m is None:
                break
            last = m.end()
            if m[1] == "beginOptional":
                opened.append(at)
                fresh = state()
                empty[at].append(fresh)
                at = fresh
            elif m[1] == "endOptional":
                if not opened:
                    raise ValueError("endOptional without beginOptional")
                start, end = opened.pop(), state()
                empty[start].append(end)
                empty[at].append(end)
                at = end
            else:
                low, high = int(m[2]), int(m[3])
                if low > high:
                    raise ValueError("a replaceable region needs lo <= hi")
                skips = []
                for k in range(high):
                    if k >= low:
                        skips.append(at)
                    to = state()
                    any_to[at], at = to, to
                    fresh = state()
                    empty[at].append(fresh)
                    at = fresh
                for s in skips:
                    empty[s].append(at)
        if opened:
            raise ValueError("beginOptional without endOptional")

        def closure(s: int) -> frozenset[int]:
            seen, todo = {s}, [s]
            while todo:
                for t in empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            return frozenset(seen)

        self.accept = at
        self.start = closure(0)
        self.word_arc = [None if x is None else (x[0], closure(x[1])) for x in word_to]
        self.any_arc = [None if x is None else closure(x) for x in any_to]
        self.first = {self.word_arc[s][0] for s in self.start if self.word_arc[s]}
        if self.accept in self.start or any(self.any_arc[s] for s in self.start) or not self.first:
            raise ValueError("a template begins with a word and needs a mandatory one")

    def longest(self, words: list[bytes], at: int) -> int | None:
        """End (exclusive) of the longest acceptance of ``words[at:]``, or None."""
        states, end = self.start, None
        for i in range(at, len(words)):
            w, found = words[i], set()
            for s in states:
                arc = self.word_arc[s]
                if arc is not None and arc[0] == w:
                    found |= arc[1]
                elif self.any_arc[s] is not None:
                    found |= self.any_arc[s]
            if not found:
                return end
            states = found
            if self.accept in states:
                end = i + 1
        return end


class Scanner:
    """All templates of a scan, reached by the possible first words."""

    def __init__(self, base: Mapping[str, str], templates: Iterable[tuple[str, str]]):
        self.by_first: dict[bytes, list[tuple[str, bool, Automaton]]] = {}
        for label, text, is_base in [*((v, k, True) for k, v in base.items()), *((a, b, False) for a, b in templates)]:
            automaton = Automaton(text)
            for w in automaton.first:
                self.by_first.setdefault(w, []).append((label, is_base, automaton))

    def matches(self, words: list[bytes]) -> list[tuple[int, int, str, bool]]:
        """(start, end, label, is base) of every accepted place, by start."""
        first = self.by_first
        return [
            (i, end, label, is_base)
            for i in [i for i, w in enumerate(words) if w in first]
            for label, is_base, automaton in first[words[i]]
            if (end := automaton.longest(words, i)) is not None
        ]


SCHEMA = (
    "doc_id bigint, n_words bigint, matches array<struct<start:bigint,`end`:bigint,label:string,base:boolean>>, covered bigint"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("matches", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))),
    ("covered", pa.int64()),
])


def scan_licenses(documents: DataFrame, *, base: Mapping[str, str] = BASE, templates=TEMPLATES) -> DataFrame:
    """Every accepted place of every text: ``doc_id, n_words, matches, covered``.

    ``matches`` holds (start, end, label, base) in words from 0, ``covered``
    the number of words inside at least one match.
    """
    base, templates = dict(base), tuple(templates)
    Scanner(base, templates)  # a wrong template fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        for batch in batches:
            n_words, found, covered = [], [], []
            for text in common.texts(batch.column(1)):
                words = common.words(text)
                hits = scanner.matches(words)
                n_words.append(len(words))
                found.append([{"start": s, "end": e, "label": x, "base": b} for s, e, x, b in hits])
                inside, upto = 0, 0
                for s, e, _, _ in sorted(hits):
                    inside, upto = inside + max(0, e - max(s, upto)), max(upto, e)
                covered.append(inside)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, f.type) for x, f in zip((n_words, found, covered), list(_ARROW)[1:], strict=True))],
                schema=_ARROW,
            )

    return documents.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)
