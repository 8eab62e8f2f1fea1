"""Licence texts in documents, by a suffix automaton of licence templates.

The templates' words are numbered, and one generalised suffix automaton holds every stretch of every template. A document's words are
streamed through it; its state after each word is the longest stretch of a template that ends there (matching statistics). Stretches that
cannot be prolonged and are long enough are chained, template by template, over short gaps; a chain that covers enough of its template is a span. Phrases are
short templates that must occur whole: they are ends of a state's stretch, found over the automaton's suffix links.

Only where several successive word pairs stand in templates is the automaton entered; elsewhere no stretch of that many words can end.
Rows: null and empty texts have no words. Places of a phrase may overlap. Texts are read whole. Other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from valora.llm.common import slices

# The contract's phrases.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Opening passages of well-known licences and usual notices, as lower-case words.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
            "and or sell copies of the software"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
                 "you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
            "copyright notice and this permission notice appear in all copies"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
)
#: A stretch of a template counts from so many words; chained ones may be so many words apart; a chain must cover such a share of its template.
LEAST_WORDS, MOST_GAP, LEAST_COVER = 4, 6, 0.6
#: ASCII to what separates words (space) or to lower case.
SEPARATED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(SEPARATED).split()


class SuffixAutomaton:
    """All stretches of several number sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length, self.owners = [{}], [-1], [0], [set()]
        for owner, sequence in enumerate(sequences):
            last = 0
            for x in sequence:
                last = self.extend(last, x)
            node = 0
            for i, x in enumerate(sequence):
                node = self.next[node][x]
                state = node
                while state > 0 and (owner, i) not in self.owners[state]:
                    self.owners[state].add((owner, i))
                    state = self.link[state]

    def extend(self, last: int, x: int) -> int:
        if x in self.next[last]:
            q = self.next[last][x]
            return q if self.length[q] == self.length[last] + 1 else self.split(last, x, q)
        new = self.add(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, x, q)
        return new

    def split(self, p: int, x: int, q: int) -> int:
        copy = self.add(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.owners[copy] = set(self.owners[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = copy
            p = self.link[p]
        return copy

    def add(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.owners.append(set())
        return len(self.next) - 1


class Scanner:
    def __init__(self, templates, phrases):
        self.templates, self.phrases = [(label, t.encode().split()) for label, t in templates], [(label, p.encode().split()) for p, label in phrases]
        texts = [words for _, words in self.templates + self.phrases]
        self.number = {w: i for i, w in enumerate(sorted({w for words in texts for w in words}))}
        sequences = [[self.number[w] for w in words] for words in texts]
        self.automaton = SuffixAutomaton(sequences)
        self.shortest = min(LEAST_WORDS, *(len(words) for _, words in self.phrases))
        n = len(self.number)
        self.pairs = np.zeros((n + 1, n + 1), bool)
        for s in sequences:
            self.pairs[s[:-1], s[1:]] = True
        ends = {}
        for k, s in enumerate(sequences[len(self.templates):]):
            node = 0
            for x in s:
                node = self.automaton.next[node][x]
            ends.setdefault(node, []).append(k)
        # By state: the phrases that its suffixes may end with.
        self.ends = [[] for _ in self.automaton.next]
        for node in sorted(range(1, len(self.ends)), key=self.automaton.length.__getitem__):
            self.ends[node] = ends.get(node, []) + self.ends[self.automaton.link[node]]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """(label, start) of phrases and (label, start, end, cover) of spans, in words."""
        places, stretches, none = [], [], len(self.number)
        ids = np.fromiter((self.number.get(w, none) for w in words), np.int64, len(words))
        if len(ids) < self.shortest:
            return [], []
        turns = np.flatnonzero(np.diff(np.concatenate([[False], self.pairs[ids[:-1], ids[1:]], [False]]).astype(np.int8)))
        auto = self.automaton
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if b - a + 1 < self.shortest:
                continue
            state, length, before = 0, 0, (0, 0)
            for i, x in enumerate(ids[a:b + 1].tolist(), a):
                while state and x not in auto.next[state]:
                    state = auto.link[state]
                    length = auto.length[state]
                if x in auto.next[state]:
                    state, length = auto.next[state][x], length + 1
                if before[1] >= LEAST_WORDS and length <= before[1]:
                    stretches.append((i - before[1], i, before[0]))
                before = (state, length)
                places += [(self.phrases[k][0], i - len(self.phrases[k][1]) + 1) for k in self.ends[state] if length >= len(self.phrases[k][1])]
            if before[1] >= LEAST_WORDS:
                stretches.append((b + 1 - before[1], b + 1, before[0]))
        return places, self.chained(stretches)

    def chained(self, stretches):
        """Stretches of one template that follow each other there and in the text, joined over gaps."""
        open_chains, done = {}, []
        for start, end, state in stretches:
            for owner, at in self.automaton.owners[state]:
                if owner >= len(self.templates):
                    continue
                chain = open_chains.get(owner)
                if chain and start <= chain[1] + MOST_GAP and at > chain[2]:
                    chain[1], chain[2], chain[3] = end, at, chain[3] + end - max(start, chain[1])
                else:
                    if chain:
                        done.append((owner, chain))
                    open_chains[owner] = [start, end, at, end - start]
        done += open_chains.items()
        spans = {(self.templates[owner][0], start, end, min(1.0, covered / len(self.templates[owner][1]))) for owner, (start, end, _, covered) in done}
        return sorted(s for s in spans if s[3] >= LEAST_COVER)


PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
SPAN = T.StructType([*PLACE.fields, T.StructField("end", T.LongType()), T.StructField("cover", T.DoubleType())])


def license_spans(documents: DataFrame, *, text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """The documents with n_words, ``phrases`` (label, start) and ``spans`` (label, start, end, cover), counted in words."""
    names = ["n_words", "phrases", "spans"]
    kept = [c for c in documents.columns if c not in names]
    places = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    covers = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))

    def run(batches):
        scanner = Scanner(templates, phrases)
        for batch in slices(batches):
            counts, found, spans = [], [], []
            for text in batch.column(text_col).to_pylist():
                words = words_of(text)
                a, b = scanner.scan(words)
                counts.append(len(words))
                found.append([{"label": x, "start": s} for x, s in a])
                spans.append([{"label": x, "start": s, "end": e, "cover": c} for x, s, e, c in b])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(counts, pa.int64()), pa.array(found, places), pa.array(spans, covers)], names=[*kept, *names])

    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField("n_words", T.LongType()), T.StructField("phrases", T.ArrayType(PLACE)),
                           T.StructField("spans", T.ArrayType(SPAN))])
    return documents.select(*kept).mapInArrow(run, schema)
