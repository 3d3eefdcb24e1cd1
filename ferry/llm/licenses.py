"""License scans with a generalised suffix automaton over the words of license templates.

The automaton is built once from the templates (a fixed, small set). A file's words are streamed
through it and give matching statistics: at each word, the longest run of words ending there that
occurs in some template. Runs of at least ``min_words`` that cannot be extended are matches; per
template, matches that move forward in both the file and the template, with bounded gaps, are chained
into spans, and the share of the template that the best chain covers is the score.

Scale: one pass over each text inside its own task, no shuffle; the automaton (a few thousand states)
is the only thing each task holds.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import ship

# Well-known license notices and grants, as their licenses word them.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at""",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software""",
    "mit-short": "Released under the MIT License.",
    "gpl-short": "This work is licensed under the GNU General Public License, version 3.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}
# Fixed values of the contract: phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

MIN_WORDS = 4
MAX_GAP = 6
MIN_COVER = 0.75

SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, score double, "
          "spans array<struct<label:string,first_word:bigint,last_word:bigint,cover:double>>")

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased (on UTF-8 bytes, where every byte above 7F is a word byte)."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class SuffixAutomaton:
    """Generalised suffix automaton: all factors of the templates, words as letters."""

    def __init__(self, templates: dict[str, list[bytes]]):
        self.names = list(templates)
        self.sizes = [len(w) for w in templates.values()]
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set] = [set()]
        for t, words in enumerate(templates.values()):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w)
                self.ends[last].add((t, at))
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]
        self.vocabulary = {w for words in templates.values() for w in words}

    def _state(self, length: int, link: int, after: dict) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:  # already a factor of an earlier template
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def matches(self, words: list[bytes], at: int, end: int, min_words: int) -> Iterator[tuple[int, int, int]]:
        """(end word, length, state) of each run in words[at:end] that cannot be extended right."""
        state = size = 0
        for i in range(at, end + 1):
            w = words[i] if i < end else None
            if w is not None and w in self.next[state]:
                state, size = self.next[state][w], size + 1
                continue
            if size >= min_words:
                yield i - 1, size, state
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state, size = self.next[state][w], size + 1
            else:
                state = size = 0


def _best(found: list[tuple[int, int, int]], max_gap: int) -> list[tuple[int, int, int]]:
    """Best chain that ends in each match (file start, template start, length): words covered, first and last file word."""
    best: list[tuple[int, int, int]] = []
    for j, (f, t, n) in enumerate(found):
        here = (n, f, f + n - 1)
        for i in range(j - 1, -1, -1):
            pf, pt, pn = found[i]
            cut = max(pf + pn - f, pt + pn - t, 0)  # words of this match the earlier one has already
            if f + cut - (pf + pn) > max_gap and pf < f - 1000:
                break
            if pt < t and cut < n and f + cut - (pf + pn) <= max_gap and t + cut - (pt + pn) <= max_gap:
                got = (best[i][0] + n - cut, best[i][1], f + n - 1)
                if got[0] > here[0]:
                    here = got
        best.append(here)
    return best


def chains(found: list[tuple[int, int, int]], max_gap: int, min_words: int, least: float) -> list[tuple[int, int, int]]:
    """Chains that cover ``least`` words or more, the best first; each is built from what those before it leave."""
    out: list[tuple[int, int, int]] = []
    while found:
        found = sorted(found)
        taken: list[tuple[int, int, int]] = []
        for covered, first, last in sorted(_best(found, max_gap), key=lambda c: -c[0]):
            if covered < least:
                break
            at = bisect_left(taken, (first,))
            if (at == len(taken) or taken[at][0] > last) and (not at or taken[at - 1][1] < first):
                taken.insert(at, (first, last, covered))
        if not taken:
            break
        out += [(covered, first, last) for first, last, covered in taken]
        left = []
        for f, t, n in found:
            # the parts of a match before, between and behind the spans taken
            lo, end = f, f + n
            at = bisect_left(taken, (f,))
            for a, b, _ in taken[max(0, at - 1):]:
                if a >= end:
                    break
                if b < lo:
                    continue
                if a - lo >= min_words:
                    left.append((lo, t + lo - f, a - lo))
                lo = b + 1
            if end - lo >= min_words:
                left.append((lo, t + lo - f, end - lo))
        found = left
    return out


def scan_words(auto: SuffixAutomaton, words: list[bytes], min_words: int, max_gap: int,
               min_cover: float) -> list[tuple[str, int, int, float]]:
    """Covered template spans: (label, first word, last word, share of the template covered)."""
    known = auto.vocabulary
    found: dict[tuple[int, int], list] = {}
    at, n = 0, len(words)
    while at < n:
        # only stretches of template words can hold a match
        if words[at] not in known:
            at += 1
            continue
        end = at + 1
        while end < n and words[end] in known:
            end += 1
        if end - at >= min_words:
            for last, size, state in auto.matches(words, at, end, min_words):
                for t, t_end in auto.ends[state]:
                    found.setdefault((t, 0), []).append((last - size + 1, t_end - size + 1, size))
        at = end
    out = []
    for (t, _), rows in found.items():
        # separate places of one template: a far step in the file starts another span
        rows.sort()
        group: list = []
        for row in rows + [None]:
            if row is not None and (not group or row[0] - max(f + k for f, _, k in group[-8:]) <= max_gap):
                group.append(row)
                continue
            out += [(auto.names[t], first, last, min(1.0, covered / auto.sizes[t]))
                    for covered, first, last in chains(group, max_gap, min_words, min_cover * auto.sizes[t])]
            group = [row] if row is not None else []
    return sorted(out, key=lambda s: (s[1], s[0]))


def base_places(words: list[bytes], phrases: dict[str, list[bytes]]) -> list[tuple[int, str]]:
    """(first word, phrase) of every place where a phrase's words stand consecutively."""
    places = []
    for phrase, ws in phrases.items():
        first, at = ws[0], -1
        for _ in range(words.count(first)):
            at = words.index(first, at + 1)
            if words[at:at + len(ws)] == ws:
                places.append((at, phrase))
    return sorted(places)


def _scan(templates: dict[str, str], phrases: dict[str, str], min_words: int, max_gap: int, min_cover: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = SuffixAutomaton({k: words_of(v) for k, v in templates.items()})
        split = {p: words_of(p) for p in phrases}
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"].fillna("").tolist()):
                words = words_of(text)
                places = base_places(words, split)
                spans = scan_words(auto, words, min_words, max_gap, min_cover)
                base = {phrases[p] for _, p in places}
                rows.append((doc, len(words), len(places), places[0][0] if places else None,
                             places[-1][0] if places else None, ",".join(sorted(base)),
                             ",".join(sorted(base | {s[0] for s in spans})),
                             max([s[3] for s in spans], default=0.0),
                             [{"label": s[0], "first_word": s[1], "last_word": s[2], "cover": s[3]} for s in spans]))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_base", "first_word", "last_word",
                                              "base_labels", "labels", "score", "spans"])
            yield out.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
         min_words: int = MIN_WORDS, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER) -> DataFrame:
    """One row per document: words, phrase places, labels, best template cover and the covered spans.

    Input needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text has no words,
    no places, empty labels and score 0. Repeated rows and null doc_ids are documents like any
    other; an empty table gives an empty result. ``score`` is the best cover of a template (0 if none
    reaches ``min_cover``).
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInPandas(_scan(templates or TEMPLATES, phrases or PHRASES, min_words, max_gap, min_cover), SCHEMA)
