"""Licence scan with a generalised suffix automaton over template words.

The automaton holds every template's words.  A text streams through it word
by word; the matching statistics (for each place, the longest stretch ending
there that stands in some template) give the long matches.  Per template,
matches are chained in order (both in the text and in the template), and a
chain that covers enough of the template is a finding with its word span.
Short phrases (the base labels) are templates of their own that have to be
covered whole, so their findings are the places where their words stand
consecutively.

The automaton has the size of the templates and goes to the tasks with the
code; texts are scanned where they are read, without a shuffle.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hirelens.llm.common import text_slices

#: Phrases whose label counts wherever their words stand consecutively.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"),
        ("cc by", "cc-by"), ("mit license", "mit"))

#: Notices of common licences; a chain has to cover a share of one.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
     "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license", "lgpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)
#: A match shorter than this is no part of a chain (whole templates always count).
MIN_MATCH = 3
#: Words that may lie between two matches of a chain, in text and template.
MAX_GAP = 12
#: Share of a template that a chain has to cover.
MIN_COVER = 0.8

#: ASCII digits, a-z and bytes of other characters stay; A-Z are lower-cased.
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32
                   for c in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton; words are numbers from 0."""

    def __init__(self, texts: Sequence[Sequence[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: Ends of the templates' stretches that a state stands for: (template, position of the last word).
        self.ends: list[list[tuple[int, int]]] = [[]]
        for t, words in enumerate(texts):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].append((t, at))
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):  # longer ones stand below
            self.ends[self.link[s]] += self.ends[s]
        self.ends[0] = []
        #: Per state every (template, end) of its own and its suffixes' stretches, with the longest such length.
        self.places: list[dict[tuple[int, int], int]] = [{}]
        for s in range(1, len(self.next)):
            found: dict[tuple[int, int], int] = {}
            up = s
            while up > 0:
                for e in self.ends[up]:
                    found.setdefault(e, self.length[up])
                up = self.link[up]
            self.places.append(found)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        cur = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return cur

    def statistics(self, words: Sequence[int]) -> list[tuple[int, int]]:
        """For each word the state and the length of the longest stretch
        ending there that stands in a template."""
        out, s, n = [], 0, 0
        for w in words:
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if w in self.next[s]:
                s, n = self.next[s][w], n + 1
            out.append((s, n))
        return out


class Scanner:
    """Templates as an automaton, and the scan of one text's words."""

    def __init__(self, base=BASE, templates=TEMPLATES, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP,
                 min_cover: float = MIN_COVER) -> None:
        texts = [words_of(t.encode()) for t, _ in (*base, *templates)]
        self.labels = [label for _, label in (*base, *templates)]
        self.n_base, self.sizes = len(base), [len(t) for t in texts]
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.ids: dict[bytes, int] = {}
        coded = [[self.ids.setdefault(w, len(self.ids)) for w in t] for t in texts]
        self.automaton = Automaton(coded)
        v = len(self.ids)
        # Pairs of words that follow each other in a template; word v is any other word.
        self.pairs = np.zeros((v + 1, v + 1), bool)
        for t in coded:
            self.pairs[t[:-1], t[1:]] = True
        self.single = np.zeros(v + 1, bool)
        self.single[[t[0] for t in coded if len(t) == 1]] = True

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[str, int, int, float]]]:
        """Base places (phrase, start), and findings (label, first word, end,
        covered share)."""
        other = len(self.ids)
        ids = np.fromiter((self.ids.get(w, other) for w in words), np.int64, len(words))
        hit = self.single[ids]
        if len(ids) > 1:
            two = self.pairs[ids[:-1], ids[1:]]
            hit[:-1] |= two
            hit[1:] |= two
        at = np.flatnonzero(hit)
        places: list[tuple[int, int]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}  # template: (end in the text, end in it, length)
        if len(at):
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                self._run(int(run[0]), ids[run].tolist(), places, matches)
        findings = [(self.labels[p], s, s + self.sizes[p], 1.0) for p, s in places]
        for t, found in matches.items():
            findings += self._chains(t, found)
        return places, findings

    def _run(self, offset: int, ids: list[int], places, matches) -> None:
        stats = self.automaton.statistics(ids)
        here = [{e: min(n, m) for e, m in self.automaton.places[s].items()} for s, n in stats]
        for i, found in enumerate(here):
            for (t, end), m in found.items():
                size = self.sizes[t]
                if t < self.n_base:
                    if end == m - 1 == size - 1:
                        places.append((t, offset + i - size + 1))
                elif (m >= self.min_match or m == size) and not (
                        i + 1 < len(here) and here[i + 1].get((t, end + 1), 0) == m + 1):
                    matches.setdefault(t, []).append((offset + i + 1, end + 1, m))

    def _chains(self, t: int, found: list[tuple[int, int, int]]):
        """Best chain ending at each match; disjoint chains that cover
        enough, the best first."""
        found.sort()
        chain: list[tuple[int, int]] = []  # (covered, start in the text)
        for k, (x, y, m) in enumerate(found):
            covered, start = m, x - m
            for j in range(k - 1, -1, -1):
                px, py, _ = found[j]
                if x - px > self.max_gap + self.sizes[t]:
                    break
                new = min(m, x - px, y - py)
                if new > 0 and x - new - px <= self.max_gap and y - new - py <= self.max_gap \
                        and chain[j][0] + new > covered:
                    covered, start = chain[j][0] + new, chain[j][1]
            chain.append((covered, start))
        taken: list[tuple[int, int]] = []  # disjoint, in order
        for (covered, start), (x, _, _) in sorted(zip(chain, found), key=lambda c: (-c[0][0], c[1][0])):
            share = covered / self.sizes[t]
            if share < self.min_cover:
                break
            at = bisect_left(taken, (start, x))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= x):
                taken.insert(at, (start, x))
                yield self.labels[t], start, x, min(share, 1.0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None,
         findings: bool = True) -> DataFrame:
    """Per input row: id, n_words, n_base (places of all base phrases),
    first_word and last_word (their smallest and largest start), base_labels
    and labels (distinct, sorted, comma-joined), score (largest covered
    share) and, if asked for, findings (label, first word, end, share).

    Null and empty texts have no words, no places, empty labels and score 0.
    Rows may repeat and ids may be null; an empty table gives no rows; other
    columns, whatever their names, are not read.  Of overlapping chains of one
    template the one that covers most is found, of equal ones the first; time
    is linear in the text, but for sorting what is found.
    """
    scanner = scanner or Scanner()
    rows = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    finding = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("share", pa.float64())]))

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] + [finding] * findings
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"] + ["findings"] * findings

    def run(batches):
        for batch in batches:
            for part, raw, offsets in text_slices(batch):
                data, cols = raw.tobytes(), [[] for _ in kinds]
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    words = words_of(data[a:b])
                    places, found = scanner.scan(words)
                    starts = [s for _, s in places]
                    base = {scanner.labels[p] for p, _ in places}
                    row = [len(words), len(places), min(starts, default=None), max(starts, default=None),
                           ",".join(sorted(base)), ",".join(sorted({f[0] for f in found})),
                           max((f[3] for f in found), default=0.0)]
                    if findings:
                        row.append([dict(zip(("label", "start", "end", "share"), f)) for f in sorted(found)])
                    for c, v in zip(cols, row):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[id_col, *names])

    more = ", findings array<struct<label:string,start:bigint,end:bigint,share:double>>" if findings else ""
    return rows.mapInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
             f"base_labels string, labels string, score double{more}")
