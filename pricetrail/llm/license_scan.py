"""License notices in text, found by patience alignment with templates.

Words that occur once in both the text and the template are anchors; the longest run of anchors
in the same order in both holds, and the gaps between them are aligned in the same way, down to
gaps with words in common but no unique ones, where equal words at either end are taken. Coverage is the
share of the template's words that are matched. A notice counts from ``COVERAGE`` on.

A long text would leave no word unique, so alignment starts from stretches of text in which
a template's words are dense enough to reach the coverage at all; each notice found is cut
out and what is left on either side is looked at again. A stretch that gives no notice in one go, or one so long that
several may be in it, is aligned around each occurrence of the template's words that are rarest in it. Texts without enough of a template's words, nearly all,
are passed by after one comparison of hashed words.

Defined cases: null and empty texts have no notices; rows are judged one by one, so repeated rows have equal
results; an empty table gives no rows; a template without words is never found.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.hashing import LETTERED, word_hashes

COVERAGE = 0.8
#: A notice may have so many words more than its template, as a factor.
STRETCH = 1.5
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first number, whose second numbers grow."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            last.append(i)
        else:
            tops[pile], last[pile] = b, i
    run, i = [], last[-1] if last else -1
    while i >= 0:
        run.append(pairs[i])
        i = before[i]
    return run[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text, template) positions. Open stretches wait in a list, so depth is no matter."""
    found: list[tuple[int, int]] = []
    waiting = [(0, len(text), 0, len(template))]
    while waiting:
        a, b, c, d = waiting.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(template[c:d], c) if in_template[w] == 1}
        anchors = [(i, at[w]) for i, w in enumerate(text[a:b], a) if w in at and in_text[w] == 1]
        run = _increasing(anchors)
        if run:
            found += run
            edges = [(a - 1, c - 1), *run, (b, d)]
            waiting += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:]) if x + 1 < u and y + 1 < v]
    return sorted(found)


class Template:
    def __init__(self, name: str, text: str) -> None:
        self.name = name
        self.words = WORD.findall(text.translate(FOLD))
        self.hashes, self.counts = np.unique(
            word_hashes(text.encode(), LETTERED)[0], return_counts=True
        )
        self.least = -(-round(COVERAGE * 1000) * len(self.words) // 1000)

    def may_occur(self, hashes: np.ndarray) -> bool:
        """Whether sorted distinct words could cover enough of the template."""
        at = np.minimum(np.searchsorted(hashes, self.hashes), len(hashes) - 1)
        return bool(self.counts[hashes[at] == self.hashes].sum() >= self.least) and bool(self.words)

    def dense(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of words in which enough of the template's words stand close together."""
        own = set(self.words)
        hit = np.fromiter((w in own for w in words), bool, len(words))
        width = int(STRETCH * len(self.words)) + 1
        sums = np.concatenate(([0], np.cumsum(hit)))
        ends = np.minimum(np.arange(len(words)) + width, len(words))
        starts = np.flatnonzero(hit & (sums[ends] - sums[:-1] >= self.least))
        out: list[tuple[int, int]] = []
        for a in starts.tolist():
            b = int(ends[a])
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], b))
            else:
                out.append((a, b))
        return out

    def find(self, words: list[str]) -> list[tuple[int, int, float]]:
        """(first word, last word, coverage) of the notices, none within another."""
        out = []
        waiting = self.dense(words)
        width = int(STRETCH * len(self.words)) + 1
        while waiting:
            a, b = waiting.pop()
            if b - a > 2 * width:  # look at a stretch piece by piece, each notice wholly in one
                waiting += [(i, min(i + 2 * width, b)) for i in range(a, b - width + 1, width)]
                continue
            pairs = [(i, j) for i, j in align(words[a:b], self.words)]
            if len(pairs) < self.least:
                out += self.around(words, a, b)
                continue
            first, last = a + pairs[0][0], a + pairs[-1][0]
            several = self.around(words, first, last + 1) if last - first + 1 >= 2 * self.least else []
            out += several if len(several) > 1 else [(first, last, len(pairs) / len(self.words))]
            waiting += [(x, y) for x, y in ((a, first), (last + 1, b)) if y - x >= self.least]
        return self.apart(out)

    @staticmethod
    def apart(hits: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """The best of hits that overlap: of the highest coverage, then the shortest, then the first."""
        best: list[tuple[int, int, float]] = []
        for hit in sorted(set(hits), key=lambda h: (-h[2], h[1] - h[0], h[0])):
            if all(hit[1] < o[0] or hit[0] > o[1] for o in best):
                best.append(hit)
        return sorted(best)

    def around(self, words: list[str], a: int, b: int) -> list[tuple[int, int, float]]:
        """Notices in words[a:b], in which copies close together may leave no word unique.

        A notice lacks so few words that it has one of any ``n - least + 1`` of the template. Those that are
        rarest in the stretch are taken, and the words before and after each of their occurrences are aligned with the
        template's before and after it, in windows that a notice of the greatest length fits in.
        """
        n, counts = len(self.words), Counter(words[a:b])
        width = int(STRETCH * n) + 1
        rarest = sorted(range(n), key=lambda c: (counts[self.words[c]], c))[: n - self.least + 1]
        places: dict[str, list[int]] = {}
        for c in rarest:
            places.setdefault(self.words[c], []).append(c)
        out, free = [], a
        for i in range(a, b):
            for c in places.get(words[i], ()):
                if i < free:  # within a notice that is whole
                    break
                low = max(free, i - c - (width - n))
                before = align(words[low:i], self.words[:c])
                after = align(words[i : min(b, i + width - c)], self.words[c:])
                first, last = low + before[0][0] if before else i, i + after[-1][0]
                if len(before) + len(after) >= self.least and last - first < width:
                    out.append((first, last, (len(before) + len(after)) / n))
                    if len(before) + len(after) == n == last - first + 1:
                        free = last + 1
        return self.apart(out)


FIELDS = "doc_id string, n_notices long, licenses string, coverage double, spans string"


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """For every row doc_id, n_notices, licenses by name, the best coverage, and name:start:end in code points."""
    texts = dict(TEMPLATES if templates is None else templates)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = [Template(name, text) for name, text in sorted(texts.items())]
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                spans: list[tuple[int, str, int, float]] = []
                hashes = np.unique(word_hashes((text or "").encode("utf-8", "replace"), LETTERED)[0])
                likely = [t for t in known if len(hashes) and t.may_occur(hashes)]
                if likely:
                    placed = list(WORD.finditer(text))
                    words = [m.group().translate(FOLD) for m in placed]
                    for t in likely:
                        spans += [(placed[a].start(), t.name, placed[b].end(), c) for a, b, c in t.find(words)]
                spans.sort()
                out.append((
                    doc_id, len(spans), ",".join(sorted({s[1] for s in spans})), max((s[3] for s in spans), default=0.0),
                    ",".join(f"{name}:{start}:{end}" for start, name, end, _ in spans),
                ))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in FIELDS.split(", ")])

    # Ids travel as text, as pandas would make floats of ids among which one is null.
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(judge, FIELDS)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
