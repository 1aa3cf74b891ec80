"""License notices in texts, by patience alignment with templates.

Words that occur once in the text and once in the template are anchors. The longest
run of anchors that keeps their order, by increasing subsequence, is aligned, and the gaps between are aligned
in the same way; where a gap has no anchor, its equal ends are aligned. Coverage is the share of
the template's words that are aligned. A text is aligned as a whole, line by line, and around every occurrence of the
template's rarest words, of which a passing stretch must hold one; so a notice that repeats, or that is wrapped over lines, is found too.
A stretch must hold the words that name the license, side by side and not as the beginning of another license's name, and few others between its
own. Where notices of several licenses overlap, the one with the most aligned words stands.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+(?:[.-][0-9]+)*")

#: Short public notices, by license.
TEMPLATES = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("GPL", "Licensed under the GNU General Public License, version"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("AGPL", "Licensed under the GNU Affero General Public License, version"),
    ("CC-BY", "Licensed under CC BY 4.0"),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-ND", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-SA", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike License"),
    ("CC-BY-ND", "This work is licensed under a Creative Commons Attribution-NoDerivatives License"),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial License"),
    ("CC-BY-NC-SA", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike License"),
    ("CC-BY-NC-ND", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives License"),
)

#: Words that name a license; a notice holds one of these for its license, side by side.
NAMES = (
    ("MIT", "MIT License"), ("MIT", "free of charge"), ("Apache-2.0", "Apache License"), ("BSD", "source and binary forms"), ("MPL-2.0", "Mozilla Public License"),
    ("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"), ("AGPL", "GNU Affero General Public License"),
    ("CC-BY", "CC BY"), ("CC-BY-SA", "CC BY SA"), ("CC-BY-ND", "CC BY ND"), ("CC-BY-NC", "CC BY NC"), ("CC-BY-NC-SA", "CC BY NC SA"), ("CC-BY-NC-ND", "CC BY NC ND"),
    ("CC-BY", "Creative Commons Attribution"), ("CC-BY-SA", "Creative Commons Attribution ShareAlike"), ("CC-BY-ND", "Creative Commons Attribution NoDerivatives"),
    ("CC-BY-NC", "Creative Commons Attribution NonCommercial"), ("CC-BY-NC-SA", "Creative Commons Attribution NonCommercial ShareAlike"),
    ("CC-BY-NC-ND", "Creative Commons Attribution NonCommercial NoDerivatives"),
)


@dataclass(frozen=True)
class LicenseOptions:
    """templates: (license, text); percent: least coverage, in hundredths; names: (license, words) of which a notice of the license
    holds one, where any are given."""

    templates: tuple[tuple[str, str], ...] = TEMPLATES
    percent: int = 80
    names: tuple[tuple[str, str], ...] = NAMES


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by their first, whose seconds rise: cards on piles, each with the card below."""
    tops: list[int] = []
    cards: list[int] = []
    below: list[int] = []
    for k, (_, second) in enumerate(pairs):
        pile = bisect_left(tops, second)
        below.append(cards[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [second]
        cards[pile : pile + 1] = [k]
    chain, k = [], cards[-1] if cards else -1
    while k >= 0:
        chain.append(pairs[k])
        k = below[k]
    return chain[::-1]


def aligned(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Places (in the template, in the text) of the aligned words, in order."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(template), 0, len(text))]
    while gaps:
        a, b, c, d = gaps.pop()
        if a >= b or c >= d:
            continue
        once = {w for w, n in Counter(template[a:b]).items() if n == 1}
        counts = Counter(w for w in text[c:d] if w in once)
        place = {w: k for k, w in enumerate(text[c:d], c) if counts.get(w) == 1}
        chain = _rising([(k, place[w]) for k, w in enumerate(template[a:b], a) if w in place])
        if not chain:
            while a < b and c < d and template[a] == text[c]:
                found.append((a, c))
                a, c = a + 1, c + 1
            while a < b and c < d and template[b - 1] == text[d - 1]:
                b, d = b - 1, d - 1
                found.append((b, d))
            continue
        found += chain
        for (a1, c1), (a2, c2) in zip([(a - 1, c - 1), *chain], [*chain, (b, d)]):
            gaps.append((a1 + 1, a2, c1 + 1, c2))
    return sorted(found)


class _Names:
    """Whether a stretch of words names a license."""

    def __init__(self, names: tuple[tuple[str, str], ...]) -> None:
        phrases = [(license, words_of(text)) for license, text in names]
        # per license: a name, and what makes it the beginning of another license's name
        self.of: dict[str, list[tuple[list[str], list[list[str]]]]] = {}
        for license, words in phrases:
            longer = [w[len(words) :] for other, w in phrases if other != license and w[: len(words)] == words]
            self.of.setdefault(license, []).append((words, longer))

    def named(self, license: str, text: list[str], first: int, last: int) -> bool:
        """Whether text[first : last + 1] holds a name of the license."""
        for words, longer in self.of.get(license, []):
            n = len(words)
            for at in range(first, last + 2 - n):
                if text[at : at + n] == words and not any(text[at + n : at + n + len(x)] == x for x in longer):
                    return True
        return license not in self.of


def notices(
    text: str | None, options: LicenseOptions, templates: list[tuple[str, list[str]]]
) -> list[tuple[str, int, int, int, list[tuple[int, int, int]]]]:
    """(license, template, aligned words, template's words, places) of templates with enough coverage: the best stretch of each, and
    all that stand, as (first word, word after the last, aligned words)."""
    whole = words_of(text or "")
    known, found, parts = Counter(whole), [], None
    names = _Names(options.names)
    for k, (name, template) in enumerate(templates):
        least = options.percent * len(template)
        # no more words can be aligned than occur at all
        if not template or 100 * sum(w in known for w in template) < least:
            continue
        if parts is None:
            parts, start = [(0, whole)], 0
            for line in map(words_of, (text or "").split("\n")):
                parts.append((start, line))
                start += len(line)
            places = {}
            for place, w in enumerate(whole):
                places.setdefault(w, []).append(place)
        spans = {}
        for start, part in [*parts, *_windows(whole, places, template, least)]:
            if 100 * min(len(part), len(template)) < least:
                continue
            pairs = aligned(part, template)
            if 100 * len(pairs) >= least:
                first, last = start + pairs[0][1], start + pairs[-1][1]
                # words between that are not of the notice
                if last + 1 - first - len(pairs) <= len(template) // 2 + 2 and names.named(name, whole, first, last):
                    spans[first, last] = max(spans.get((first, last), 0), len(pairs))
        found += [(name, k, n, len(template), a, z) for (a, z), n in spans.items()]
    return _standing(found)


def _windows(whole: list[str], places: dict[str, list[int]], template: list[str], least: int) -> Iterator[tuple[int, list[str]]]:
    """(start, words) of stretches around each occurrence of words of which one is aligned in every stretch that passes, with up to a quarter of the template's words more."""
    m = len(template)
    spare = m - -(-least // 100) + 1
    seeds = sorted(range(m), key=lambda k: len(places.get(template[k], ())))[:spare]
    seen = set()
    for k in seeds:
        for at in places.get(template[k], ()):
            for slack in (0, m // 8 + 1, m // 4 + 2):
                window = max(0, at - k - slack), min(len(whole), at - k + m + slack)
                if window not in seen:
                    seen.add(window)
                    yield window[0], whole[window[0] : window[1]]


class _Spans:
    """Stretches that do not overlap."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, first: int, last: int) -> bool:
        i = bisect_left(self.ends, first)
        return i == len(self.ends) or self.starts[i] > last

    def add(self, first: int, last: int) -> None:
        i = bisect_left(self.ends, first)
        self.starts.insert(i, first)
        self.ends.insert(i, last)


def _standing(found: list[tuple[str, int, int, int, int, int]]) -> list[tuple[str, int, int, int, list[tuple[int, int, int]]]]:
    """The stretches that no better notice of another license overlaps, per template. found: (license, template, aligned, words, first, last)."""
    best: dict[int, tuple[str, int, int, int, list[tuple[int, int, int]]]] = {}
    by_license: dict[str, _Spans] = {}
    by_template: dict[int, _Spans] = {}
    for name, k, n, size, first, last in sorted(found, key=lambda x: (-x[2], x[3], x[1], x[5] - x[4], x[4])):
        if not all(spans.free(first, last) for other, spans in by_license.items() if other != name):
            continue
        places = best.setdefault(k, (name, k, n, size, []))[4]
        own = by_template.setdefault(k, _Spans())
        if own.free(first, last):
            own.add(first, last)
            places.append((first, last + 1, n))
        whole = by_license.setdefault(name, _Spans())
        if whole.free(first, last):
            whole.add(first, last)
    return [(*best[k][:4], sorted(best[k][4])) for k in sorted(best)]


def license_notices(docs: DataFrame, options: LicenseOptions = LicenseOptions()) -> DataFrame:
    """(doc_id, license, template, aligned, template_words, places): a row per row of `docs` (doc_id, text) and template found.

    `aligned` is of the best stretch; `places` has all stretches: first word, the word after the last, counted from 0, and the aligned words.

    Null and empty texts hold none. Repeated rows and rows without doc_id are searched like others; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = [(name, words_of(text)) for name, text in options.templates]
        for batch in batches:
            rows = [(i, *n) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for n in notices(t.as_py(), options, templates)]
            place = pa.list_(pa.struct([("start_word", pa.int32()), ("end_word", pa.int32()), ("aligned", pa.int32())]))
            rows = [(*r[:5], [dict(zip(("start_word", "end_word", "aligned"), p)) for p in r[5]]) for r in rows]
            columns = list(zip(*rows)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), place)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "license", "template", "aligned", "template_words", "places"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, license string, template int, aligned int, template_words int, places array<struct<start_word:int,end_word:int,aligned:int>>")
