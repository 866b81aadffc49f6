"""License scan: winnowed fingerprints pick candidates, banded alignment confirms them.

Templates and texts are word sequences. Fingerprints are hashes of ``gram``
words, winnowed: of every ``window`` neighbouring hashes the least is kept,
so a shared run of gram + window - 1 words always shares a fingerprint. An
inverted index from fingerprint to (template, position) finds hits in a text;
each diagonal of a template with a hit is a candidate place, and a local
alignment of the template within ``band`` words of it gives the matched
words, their share of the template (coverage) and the span in the text; of
overlapping places of a template the best stays. A notice must hold the words that tell it from its relatives
(numbers, and MARKS such as "lesser" or "sharealike") and none of theirs.

Whole license texts (``license_texts``, by SPDX identifier, without the
copyright line) stand in an inverted index of their own winnowed fingerprints.
The fingerprints that a text shares with one are its anchors. Anchors are
chained in order by a score that gains the words they match and loses ``SKIP``
for every word passed over on either side, so a chain goes on over any change
that it outweighs, whatever its length, and ends where it does not. Along a
chain the alignment's band follows the anchors: between two of them it is as
wide as the words inserted or left out there and ``band`` more on both sides,
and the words equal inside it count as matched. At both ends words are added
while they match better than they miss. Kinds of places, and their coverage:

- ``text``: at least ``coverage`` of the whole license text;
- ``part``: less, but at least ``PART`` words that fill ``FILL`` of the
  span; the coverage is the share of the whole license text;
- ``notice``: a template, the coverage is the share of the template. ``whole``
  is the share of the license's text where the template is a passage of it,
  and otherwise equal to the coverage.

Of overlapping texts and parts the one that matches most stays, of equal ones
a text with the larger coverage, or all parts; a part that a passage template
of its license tells about as well is left out, and so is a passage template
within the text of another license. Only the indexes are shared with the tasks; their size is
that of the templates and texts. There is no shuffle.

Defined cases: null and empty texts and texts without a word match nothing;
a place is reported for every notice that reaches ``coverage`` there, also
when one notice holds another; spans are code points, end exclusive;
repeated rows match alike; all columns are kept and the result is one struct
column with a fresh name.
"""

from __future__ import annotations

import pkgutil
import re
from bisect import bisect_left
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.common import _WORD_TABLE, binary_text, fresh_name, mix64, with_struct, words_of

FIELDS = ("array<struct<license: string, coverage: double, matched: bigint, first_word: bigint, last_word: bigint, "
          "start: bigint, stop: bigint, kind: string, whole: double>>")

# Whole texts in license_texts.
TEXTS = ("0BSD", "Apache-2.0", "Artistic-1.0-Perl", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3",
         "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib")
PART, FILL, SKIP = 30, 0.6, 0.25
MARKS = frozenset(b"affero lesser library documentation noncommercial sharealike noderivatives noderivs nc sa nd mozilla eclipse"
                  .split())


def _gnu(what: str, name: str, version: str) -> str:
    return (f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as "
            f"published by the Free Software Foundation; either version {version} of the License, or (at your option) any "
            "later version.")


_CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
_SHORT = (("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
          ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
          ("AGPL-3.0", "Affero General Public License", "3"))
# Standard notices that the licenses or their stewards recommend.
NOTICES = (
    *((f"CC-{short}-{v}", f"Licensed under CC {short} {v}.") for short, _ in _CC for v in ("4.0", "3.0", "2.5", "2.0")
      if (short, v) != ("BY-NC", "4.0")),
    *((f"CC-{short}-{v}", f"This work is licensed under a Creative Commons {long} {v} {scope} License.") for short, long in _CC
      for v, scope in (("4.0", "International"), ("3.0", "Unported")) if (short, v) != ("BY", "4.0")),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    *((spdx, f"This work is licensed under the GNU {name}, version {v}.") for spdx, name, v in _SHORT if spdx != "GPL-3.0"),
    ("GPL-2.0-or-later", _gnu("program", "General Public License", "2")),
    ("LGPL-2.0-or-later", _gnu("library", "Library General Public License", "2")),
    ("LGPL-2.1-or-later", _gnu("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0-or-later", _gnu("library", "Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", _gnu("program", "Affero General Public License", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "2.0 which is available at"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
)
# Notices and opening passages of common licenses, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of "
                         "the GNU General Public License as published by the Free Software Foundation, either version "
                         "3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    *NOTICES,
)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@cache
def license_texts() -> tuple[tuple[str, str], ...]:
    """(SPDX identifier, whole text), read from the package also where it is an archive."""
    return tuple((name, pkgutil.get_data("sluice.llm", f"license_texts/{name}.txt").decode()) for name in TEXTS)


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash of every ``window`` neighbours (the last of equals)."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))] if len(grams) else [], np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))


def _common(a: list[int], b: list[int], band: int) -> int:
    """The number of words in the longest common subsequence of ``a`` and ``b`` that stays in the band between their
    corners: as wide as they differ in length, and ``band`` more on both sides."""
    if len(a) == len(b) == 1:
        return int(a[0] == b[0])
    if len(a) > len(b):
        a, b = b, a
    long = np.array(b)
    wide = len(b) - len(a) + 2 * band + 1
    # Row i holds the columns from i - band on; entry k is the best up to the column before its column k.
    before = np.zeros(wide + 1, np.int64)
    for i, word in enumerate(a):
        columns = np.arange(i - band, i - band + wide)
        inside = (columns >= 0) & (columns < len(b))
        equal = np.zeros(wide, np.int64)
        equal[inside] = long[columns[inside]] == word
        # The row above begins one column to the left (all rows' first entries are 0 in the first row).
        above = np.append(before[1:], before[-1]) if i else before
        now = np.maximum(above[:-1] + equal, above[1:])
        before = np.maximum.accumulate(np.concatenate([above[:1], now]))
    return int(before[-1])


class Places:
    """Places (first, last word, ...) in order, and those of them that may meet a stretch of words."""

    def __init__(self, places: list[tuple]):
        self.places = sorted(places)
        self.longest = max((p[1] - p[0] for p in places), default=0)

    def near(self, first: int, last: int) -> list[tuple]:
        return self.places[bisect_left(self.places, (first - self.longest,)):bisect_left(self.places, (last + 1,))]


class Scanner:
    """The inverted indexes of the templates and whole texts, and the search of a text in them."""

    def __init__(self, templates, gram: int, window: int, band: int, coverage: float, texts=None):
        self.gram, self.window, self.band, self.coverage = gram, window, band, coverage
        self.names = [name for name, _ in templates]
        self.words = [words_of(text.encode()) for _, text in templates]
        texts = license_texts() if texts is None else texts
        self.text_names = [name for name, _ in texts]
        text_words = [words_of(text.encode()) for _, text in texts]
        self.numbers = {w: i + 1 for i, w in enumerate(sorted({w for t in [*self.words, *text_words] for w in t}))}
        self.texts = [[self.numbers[w] for w in t] for t in text_words]
        marks = {n for w, n in self.numbers.items() if w in MARKS}
        digits = {n for w, n in self.numbers.items() if any(48 <= b <= 57 for b in w)}
        self.marks = marks
        self.needs = [{self.numbers[w] for w in t} & (marks | digits) for t in self.words]
        # Templates that are passages of their license's text: the words of that text, by template.
        whole = dict(zip(self.text_names, text_words, strict=True))
        self.passage_of = {t: len(whole[name]) for t, name in enumerate(self.names)
                           if b" " + b" ".join(self.words[t]) + b" " in b" " + b" ".join(whole.get(name, [])) + b" "}
        grams = [self._grams(np.array(t, np.uint64)) for t in self.texts]
        kept = [winnow(g, window) for g in grams]
        none = [np.empty(0, np.int64)]
        key = np.concatenate([g[k] for g, k in zip(grams, kept, strict=True)] or [np.empty(0, np.uint64)])
        owner = np.concatenate([np.full(len(k), t) for t, k in enumerate(kept)] or none)
        place = np.concatenate(kept or none)
        order = np.argsort(key, kind="stable")
        self.run_keys, self.run_text, self.run_place = key[order], owner[order], place[order]
        self.numbered = [[self.numbers[w] for w in t] for t in self.words]
        found: dict[int, list[tuple[int, int]]] = {}
        for t, numbers in enumerate(self.numbered):
            grams = self._grams(np.array(numbers, np.uint64))
            for at in winnow(grams, window).tolist():
                found.setdefault(int(grams[at]), []).append((t, at))
        self.index = found
        self.keys = np.sort(np.fromiter(found, np.uint64, len(found)))

    def _grams(self, numbers: np.ndarray) -> np.ndarray:
        gram = self.gram
        if not len(numbers):
            return np.empty(0, np.uint64)
        n = max(1, len(numbers) - gram + 1)
        total = np.zeros(n, np.uint64)
        known = np.ones(n, bool)
        for k in range(min(gram, len(numbers))):
            part = numbers[k:k + n]
            total = total * np.uint64(0x9E3779B97F4A7C15) + part
            known &= part > 0
        total = mix64(total + np.uint64(min(gram, len(numbers))))
        total[~known] = _NONE  # a word of no template: never the least, in no template
        return total

    def scan(self, raw: bytes | None) -> list[dict]:
        words = words_of(raw)
        get = self.numbers.get
        numbers = [get(w, 0) for w in words]
        own = np.array(numbers, np.uint64)
        notices = self._notices(numbers, own)
        texts = self._whole(numbers, own)
        return self._spans(raw, notices, texts) if notices or texts else []

    def _notices(self, numbers: list[int], own: np.ndarray) -> list[tuple]:
        """(template, matched words, first, last word) of the templates found."""
        grams = self._grams(own)
        if not len(grams) or not len(self.keys):
            return []
        likely = np.searchsorted(self.keys, grams)
        known = self.keys[np.minimum(likely, len(self.keys) - 1)] == grams
        if not known.any():
            return []
        at = winnow(grams, self.window)
        places = {(t, pos - place) for pos in at[known[at]].tolist() for t, place in self.index[int(grams[pos])]}
        out = set()
        for t, diagonal in sorted(places):
            # A place without the words the template needs is not aligned.
            near = set(numbers[max(0, diagonal - self.band):diagonal + len(self.numbered[t]) + self.band])
            found = self._align(self.numbered[t], numbers, diagonal) if self.needs[t] <= near else None
            if found and found[0] >= self.coverage * len(self.numbered[t]):
                inside = set(numbers[found[1]:found[2] + 1])
                if self.needs[t] <= inside and inside & self.marks <= self.needs[t]:
                    out.add((t, *found))
        return sorted(out)

    def _whole(self, numbers: list[int], own: np.ndarray) -> list[tuple]:
        """(text, matched words, first, last word) of whole license texts and long passages of them."""
        grams = self._grams(own)
        if not len(grams) or not len(self.run_keys):
            return []
        likely = np.searchsorted(self.run_keys, grams)
        shared = self.run_keys[np.minimum(likely, len(self.run_keys) - 1)] == grams
        if not shared.any():
            return []
        at = winnow(grams, self.window)
        at = at[shared[at]]
        low = likely[at]
        many = np.searchsorted(self.run_keys, grams[at], "right") - low
        if not len(at):
            return []
        hit = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pos, text, place = np.repeat(at, many), self.run_text[hit], self.run_place[hit]
        # A place of PART words has more than a few fingerprints.
        enough = np.flatnonzero(np.bincount(text, minlength=len(self.texts)) * (self.gram + self.window) >= PART)
        found = []
        for t in enough.tolist():
            mine = text == t
            order = np.lexsort((-place[mine], pos[mine]))
            found += [(t, *f) for f in self._chains(t, pos[mine][order].tolist(), place[mine][order].tolist(), numbers)]
        out: list[tuple] = []
        group, reach = [], -1
        for f in sorted(found, key=lambda f: (f[2], f)):  # places that overlap, directly or by others, are rivals
            if group and f[2] > reach:
                out += self._best(group)
                group, reach = [], -1
            group.append(f)
            reach = max(reach, f[3])
        return out + self._best(group)

    def _best(self, found: list[tuple]) -> list[tuple]:
        """Of overlapping places the one that matches most; of equal ones a text with the larger coverage, or all parts."""
        kept: list[tuple] = []
        share = lambda f: f[1] / len(self.texts[f[0]])
        for f in sorted(found, key=lambda f: (-f[1], -share(f), f)):
            rivals = [k for k in kept if k[2] <= f[3] and f[2] <= k[3] and
                      2 * (min(k[3], f[3]) - max(k[2], f[2]) + 1) > f[3] - f[2] + 1]
            if all(k[1] == f[1] and share(k) < self.coverage for k in rivals):
                kept.append(f)
        return kept

    def _chains(self, t: int, pos: list[int], place: list[int], numbers: list[int]) -> list[tuple[int, int, int]]:
        """(matched words, first, last word) of the chains of anchors, given by ascending word and descending place."""
        n, words = len(pos), self.texts[t]
        # Best chain that ends at a place or before: a prefix maximum tree over places. A chain's score is kept with the
        # loss of the words before it taken back, so that it can be compared wherever the next anchor stands.
        tree: list[tuple[float, int]] = [(-1.0, -1)] * (len(words) + 1)
        score, before, last = [0.0] * n, [-1] * n, {}
        waiting: list[int] = []
        for i in range(n):
            if waiting and pos[waiting[0]] != pos[i]:  # anchors of one word are no predecessors of each other
                for j in waiting:
                    value = (score[j] + SKIP / 2 * (pos[j] + place[j]), j)
                    k = place[j] + 1
                    while k <= len(words):
                        if tree[k][0] < value[0]:
                            tree[k] = value
                        k += k & -k
                waiting = []
            diagonal = pos[i] - place[i]
            gain = min(self.gram, pos[i] - last.get(diagonal, -self.gram))  # words that the anchor before does not hold
            last[diagonal] = pos[i]
            best, k = (-1.0, -1), place[i]
            while k > 0:
                if tree[k][0] > best[0]:
                    best = tree[k]
                k -= k & -k
            ahead = best[0] - SKIP / 2 * (pos[i] + place[i])
            score[i], before[i] = (gain + ahead, best[1]) if best[1] >= 0 and ahead > 0 else (float(self.gram), -1)
            waiting.append(i)
        out, used = [], [False] * n
        for end in sorted(range(n), key=lambda i: (-score[i], i)):
            chain, i = [], end
            while i >= 0 and not used[i]:
                used[i] = True
                chain.append(i)
                i = before[i]
            if not chain or (self.gram + self.window) * len(chain) < PART:
                continue
            chain.reverse()
            place_of = self._along([(pos[i], place[i]) for i in chain], numbers, words)
            matched, first, stop = place_of
            if matched >= self.coverage * len(words) or matched >= PART and matched >= FILL * (stop - first):
                out.append((matched, first, stop - 1))
        return out

    def _along(self, anchors: list[tuple[int, int]], numbers: list[int], words: list[int]) -> tuple[int, int, int]:
        """(matched words, first word, word after the last) of the banded alignment along a chain of anchors."""
        a, b = anchors[0]
        matched = 0
        first, start = a, b
        # Before the first anchor: as long as equal words outweigh the others.
        score = best = 0.0
        kept = taken = 0
        for k in range(1, min(a, b) + 1):
            same = numbers[a - k] == words[b - k]
            kept += same
            score += 1 if same else -1
            if score > best:
                best, taken, first, start = score, kept, a - k, b - k
        matched += taken
        stop, until = a, b
        for a, b in anchors:
            gap_a, gap_b = a - stop, b - until
            if gap_a > 0 and gap_b > 0:
                matched += _common(numbers[stop:a], words[until:b], self.band)
            # Words that the anchor shares with the one before count once.
            cut = max(0, -gap_a, -gap_b)
            matched += max(0, self.gram - cut)
            stop, until = max(stop, a + self.gram), max(until, b + self.gram)
        stop, until = min(stop, len(numbers)), min(until, len(words))
        score = best = 0.0
        kept = taken = far = 0
        for k in range(min(len(numbers) - stop, len(words) - until)):
            same = numbers[stop + k] == words[until + k]
            kept += same
            score += 1 if same else -1
            if score > best:
                best, taken, far = score, kept, k + 1
        return matched + taken, first, stop + far

    def _align(self, template: list[int], numbers: list[int], diagonal: int) -> tuple[int, int, int] | None:
        """(matched words, first, last word) of the best local alignment within ``band`` of a diagonal; of equal ones
        the nearest to it."""
        low, wide = diagonal - self.band, 2 * self.band + 1
        n = len(numbers)
        # Per diagonal offset: score, matched words, first word of the alignment that ends there.
        before = [(0, 0, -1)] * (wide + 2)
        best = ((0, 0, 0), 0, 0, 0)
        for i, word in enumerate(template):
            now = [(0, 0, -1)] * (wide + 2)
            for d in range(wide):
                j = i + low + d
                if not 0 <= j < n:
                    continue
                if numbers[j] == word:
                    score, matched, first = before[d + 1]
                    cell = (score + 1, matched + 1, j if first < 0 else first)
                else:
                    score, matched, first = before[d + 1]
                    cell = (score - 1, matched, first)
                for score, matched, first in (before[d + 2], now[d]):  # a template word or a text word is skipped
                    if score - 1 > cell[0]:
                        cell = (score - 1, matched, first)
                if cell[0] > 0:
                    now[d + 1] = cell
                    rated = (*cell[:2], -abs(d - self.band))
                    if rated > best[0]:
                        best = (rated, cell[1], cell[2], j)
            before = now
        return best[1:] if best[1] else None

    def _spans(self, raw: bytes, notices: list, texts: list) -> list[dict]:
        """Places with their code points; the best one of a template where several overlap."""
        bytes_at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_WORD_TABLE))]
        kept: list[tuple] = []
        for t, matched, first, last in sorted(notices, key=lambda f: (f[0], f[2], -f[1])):
            if kept and kept[-1][1] == t and first <= kept[-1][3]:
                if matched > kept[-1][2]:
                    kept[-1] = (first, t, matched, last)
            else:
                kept.append((first, t, matched, last))
        sure = Places([(f[2], f[3], self.text_names[f[0]]) for f in texts if f[1] >= self.coverage * len(self.texts[f[0]])])
        # A passage that two licenses share belongs to the one whose text is there.
        kept = [k for k in kept if k[1] not in self.passage_of
                or not (around := [name for a, b, name in sure.near(k[0], k[3]) if a <= k[0] and k[3] <= b])
                or self.names[k[1]] in around]
        told = Places([(k[0], k[3], k[1], k[2]) for k in kept if k[1] in self.passage_of])
        out = [(first, last, self.names[t], "notice", matched, matched / len(self.numbered[t]),
                matched / self.passage_of.get(t, len(self.numbered[t]))) for first, t, matched, last in kept]
        for t, matched, first, last in texts:
            share, name = matched / len(self.texts[t]), self.text_names[t]
            if share < self.coverage and any(self.names[k] == name and a <= last and first <= b and matched < m + PART
                                             for a, b, k, m in told.near(first, last)):
                continue
            out.append((first, last, name, "text" if share >= self.coverage else "part", matched, share, share))
        # Code points before every place that is reported, counted once through the text.
        wanted = sorted({bytes_at[first][0] for first, *_ in out} | {bytes_at[o[1]][1] for o in out})
        points, at, count = {}, 0, 0
        for byte in wanted:
            count += len(raw[at:byte].decode())
            points[byte], at = count, byte
        return [{"license": name, "coverage": share, "matched": matched, "first_word": first, "last_word": last,
                 "start": points[bytes_at[first][0]], "stop": points[bytes_at[last][1]], "kind": kind, "whole": whole}
                for first, last, name, kind, matched, share, whole in sorted(out)]


def scan_licenses(docs: DataFrame, templates=TEMPLATES, gram: int = 3, window: int = 2, band: int = 6,
                  coverage: float = 0.8, into: str = "licenses", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (text) with a struct column whose field ``found`` lists the matched places."""
    into = fresh_name(docs.columns, into)
    place = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int64()),
                       ("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
                       ("kind", pa.string()), ("whole", pa.float64())])
    texts = docs.sparkSession.sparkContext.broadcast(license_texts())  # of fixed size

    def make():
        scanner = Scanner(templates, gram, window, band, coverage, texts.value)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for lo in range(0, batch.num_rows, 512):
                rows += [scanner.scan(raw) for raw in binary_text(batch.slice(lo, 512))]
            return [pa.array(rows, pa.list_(place))]
        return compute

    return with_struct(docs, into, f"struct<found: {FIELDS}>", make, keep=keep), into
