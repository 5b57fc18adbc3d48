"""Licence scans by a generalised suffix automaton of licence templates.

The words of all templates, and of the phrases that name a licence, make one
suffix automaton.  A task streams its texts through it word by word: after
every word the automaton holds the longest run of words ending there that
occurs in a template (the matching statistics), in time linear in the text.
A phrase stands at a word if the state there, or one that its suffix links
lead to, is the phrase's and the match is long enough.  Matches of ``LEAST``
words or more that cannot go on are chained: one follows another if it lies
after it in the text, within ``GAP`` words, and after it in the template; the
words it adds are counted once.  A chain that covers ``COVER`` of its template
is a span of that licence.

The automaton depends on the templates alone and goes to the tasks with the
code; texts are read in slices, so a long text needs no more memory than its
own bytes, and nothing is shuffled.

Defined results: a null text is empty; a text without words has no place, no
label and score 0; ``score`` is the greatest share of a template that one
chain covers, 1 where a phrase stands; repeated rows give equal results; an
empty table gives no rows; the other columns of the table are passed on, but
for those named like a new one, which are replaced.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, table
from .registry import register

LEAST, GAP, COVER = 4, 32, 0.5
#: Bytes of a text that are split into words at once.
SLICE = 1 << 20

# --- FIXED VALUES: phrases and their labels (given), and the notices of public licences
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

TEMPLATES = {
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "cc-by": """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of
        this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866,
        Mountain View, CA 94042, USA.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means.""",
}
# --- end FIXED VALUES

#: Bytes that stand between words: all of ASCII but digits and letters.
_GAPS = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = bytes.maketrans(_GAPS + bytes(range(65, 91)), b" " * len(_GAPS) + bytes(range(97, 123)))
_GAP = re.compile(b"[" + re.escape(_GAPS) + b"]")


def word_slices(raw: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, lists of about ``size`` bytes at a time; a slice ends with a word."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + size)
        end = gap.start() if gap else len(raw)
        yield raw[at:end].translate(_TABLE).split()
        at = end


class Automaton:
    """Suffix automaton of several word sequences.  State 0 is the empty
    match; ``ends[s]`` are the (template, end) where the matches of a state end."""

    def __init__(self, templates: list[list[bytes]], phrases: list[list[bytes]]):
        self.to: list[dict[bytes, int]] = [{}]
        self.size, self.link = [0], [-1]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate([*templates, *phrases]):
            last = 0
            for i, w in enumerate(words):
                last = self._add(last, w, ends)
                if t < len(templates):
                    ends[last].add((t, i + 1))
        order = sorted(range(1, len(self.to)), key=self.size.__getitem__, reverse=True)
        for s in order:  # what ends in a state ends in all its suffixes
            ends[self.link[s]] |= ends[s]
        self.ends = [sorted(e) if self.size[s] >= LEAST else [] for s, e in enumerate(ends)]
        named: dict[int, list[tuple[int, int]]] = {}
        for p, words in enumerate(phrases):
            s = 0
            for w in words:
                s = self.to[s][w]
            if words:
                named.setdefault(s, []).append((len(words), p))
        #: Phrases that a match in a state may end with, with their words.
        self.named: list[list[tuple[int, int]]] = [[] for _ in self.to]
        for s in reversed(order):
            self.named[s] = named.get(s, []) + self.named[self.link[s]]

    def _state(self, size: int, to: dict, link: int, ends: list) -> int:
        self.to.append(to)
        self.size.append(size)
        self.link.append(link)
        ends.append(set())
        return len(self.to) - 1

    def _split(self, p: int, q: int, w: bytes, ends: list) -> int:
        """The state of the matches of q that are one longer than those of p."""
        if self.size[q] == self.size[p] + 1:
            return q
        new = self._state(self.size[p] + 1, dict(self.to[q]), self.link[q], ends)
        self.link[q] = new
        while p >= 0 and self.to[p].get(w) == q:
            self.to[p][w] = new
            p = self.link[p]
        return new

    def _add(self, last: int, w: bytes, ends: list) -> int:
        if w in self.to[last]:
            return self._split(last, self.to[last][w], w, ends)
        new, p = self._state(self.size[last] + 1, {}, 0, ends), last
        while p >= 0 and w not in self.to[p]:
            self.to[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.to[p][w], w, ends)
        return new

    def matches(self, slices: Iterable[list[bytes]], phrase: Callable[[int, int], None]) -> Iterator[tuple[int, int, int] | int]:
        """(start, words, state) of the matches of ``LEAST`` words or more that
        cannot go on, in the order of their ends, and last the number of words.
        ``phrase(start, number)`` is called for every place of a phrase."""
        to, size, link, named = self.to, self.size, self.link, self.named
        known = {w for s in to for w in s}
        state = length = at = 0
        for words in slices:
            for i, w in enumerate(words, at):
                if w in known:
                    go, n = state, length
                    while go and w not in to[go]:
                        go = link[go]
                        n = size[go]
                    if n < length and length >= LEAST:
                        yield i - length, length, state
                    if w in to[go]:
                        state, length = to[go][w], n + 1
                    else:
                        state = length = 0
                    for many, p in named[state]:
                        if many <= length:
                            phrase(i + 1 - many, p)
                elif length:
                    if length >= LEAST:
                        yield i - length, length, state
                    state = length = 0
            at += len(words)
        if length >= LEAST:
            yield at - length, length, state
        yield at


class Chains:
    """Chains of the matches of one text with one template."""

    def __init__(self, words: int):
        self.words = words
        self.open: list[tuple[int, int, int, int]] = []  # ends in text and template, start in text, covered words
        self.best = (0, 0, 0, 0)
        self.most = 0
        self.spans: list[tuple[int, int, int]] = []

    def add(self, start: int, at: int, n: int) -> None:
        """A match of ``n`` words at ``start`` of the text and ``at`` of the template."""
        self.open = [c for c in self.open if start <= c[0] + GAP]
        if not self.open:
            self.close()
        end, to = start + n, at + n
        new = (end, to, start, n)
        for c in self.open:
            more = min(n, end - c[0], to - c[1])
            if more > 0 and c[3] + more > new[3]:
                new = (end, to, c[2], c[3] + more)
        if new[2] >= self.best[0] > 0:  # a copy of the template after another
            self.close()
        self.open.append(new)
        if new[3] > self.best[3]:
            self.best = new

    def close(self) -> None:
        end, _, start, covered = self.best
        self.most = max(self.most, covered)
        if covered >= COVER * self.words and covered:
            self.spans.append((start, end, covered))
        self.best = (0, 0, 0, 0)


def scanner(templates: dict[str, str], phrases: dict[str, str]) -> Callable[[bytes | None], tuple]:
    """A function from a text to (n_words, n_base, first_word, last_word,
    base_labels, spans, labels, score)."""
    def words(text: str) -> list[bytes]:
        return [w for part in word_slices(text.encode()) for w in part]

    labels, sizes = list(templates), [len(words(t)) for t in templates.values()]
    names = list(phrases.values())
    automaton = Automaton([words(t) for t in templates.values()], [words(p) for p in phrases])

    def scan(raw: bytes | None) -> tuple:
        chains: dict[int, Chains] = {}
        places: set[tuple[int, int]] = set()
        n = 0
        for match in automaton.matches(word_slices(raw or b""), lambda start, p: places.add((start, p))):
            if isinstance(match, int):
                n = match
                break
            start, length, state = match
            for t, end in automaton.ends[state]:
                if t not in chains:
                    chains[t] = Chains(sizes[t])
                chains[t].add(start, end - length, length)
        spans = []
        for t, c in chains.items():
            c.close()
            spans += [(start, end, labels[t], covered / c.words) for start, end, covered in c.spans]
        starts = [p[0] for p in places]
        base = sorted({names[p] for _, p in places})
        score = max([0.0, *(c.most / c.words for c in chains.values()), *([1.0] if places else [])])
        return (n, len(places), min(starts, default=None), max(starts, default=None), base,
                [dict(zip(("start", "end", "label", "covered"), s)) for s in sorted(spans)],
                sorted({*base, *(s[2] for s in spans)}), score)
    return scan


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType()),
        T.StructField("covered", T.DoubleType())]))),
    T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType())])
_ARROW = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("covered", pa.float64())])), pa.list_(pa.string()),
    pa.float64()]


def scan_licences(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """The columns of ``docs`` but for ``text``, with n_words, n_base (places of
    phrases), first_word and last_word (their least and greatest start),
    base_labels, spans (start, end, label, covered share), labels and score."""
    kept = [f for f in docs.schema.fields if f.name != "text" and f.name not in FOUND.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(templates, phrases)
        for b in batches:
            found = [scan(x.as_py()) for x in b.column(b.num_columns - 1)]
            cols = zip(*found) if found else [[]] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, t) for c, t in zip(cols, _ARROW))],
                                             names=[*(f.name for f in kept), *FOUND.names])

    rows = docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, T.StructType([*kept, *FOUND.fields]))


@register("op13_licence_spans")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")
