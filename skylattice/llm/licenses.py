"""License scans by conditional compression.

Candidate blocks are the words around each cue, across line ends, as many on both sides as the longest template may take
with its differences; blocks that overlap are one. They are cut into windows of at most `window` words with an overlap of
half a window, so a text of any length is scanned whole. Each block is compressed with zstandard alone and with every
template as a raw-content dictionary, and the templates are ranked by the bytes they save. In this order their exact
wording is held against the block: words of the template that a stretch lacks, and words that it has in between, may be
no more than a stated share of the template, and the template must make the stretch itself much smaller, whatever else
is in the block. Of stretches that overlap, the one with most matched words less differences stays, then the one whose
template saves most bytes of it, then the higher ranked one: bytes saved alone would favour a stretch that reaches into
the notice beside it.

Cues are words that license notices have in common. A template that holds none of them brings its own: so many of its
longest words that a stretch with few enough differences cannot lack them all.

Defined results: a null or empty text has no blocks; a document without a confirmed template has license null; license
is the confirmed one with fewest differences, then the greatest reduction, then by name; rows that repeat are scanned each.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import DataFrame

from .shared import by_batch, read_table

# The wording of public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD": "Released under the BSD License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0": "Released under CC0 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "proprietary": "All rights reserved.",
}
# Words of a cue may stand on two lines, with comment marks between.
_CUES = re.compile(r"licen|permission|redistribut|free[\W_]+software|public[\W_]+domain|rights[\W_]+reserved|cc[\W_]+by|cc0")
_WORDS = re.compile(r"[^\W_]+(?:[.+][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


class Scanner:
    def __init__(self, templates: dict[str, str], *, window: int = 300, least_reduction: float = 0.2, most_differences: float = 0.2):
        import zstandard as z

        self.window, self.least, self.most = window, least_reduction, most_differences
        self.plain = z.ZstdCompressor(level=3, write_content_size=False)
        self.known, own = [], set()
        self.margin = max((int(len(words_of(t)) * (1 + most_differences)) for t in templates.values()), default=0)
        for name, text in templates.items():
            data = z.ZstdCompressionDict(text.encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            self.known.append((name, words_of(text), z.ZstdCompressor(level=3, dict_data=data, write_content_size=False, write_dict_id=False)))
            if not _CUES.search(text.lower()):
                own |= self.own_cues(words_of(text))
        self.cues = re.compile("|".join([_CUES.pattern, *(rf"(?<![^\W_]){re.escape(w)}(?![^\W_])" for w in sorted(own))]))

    def own_cues(self, words: list[str]) -> set[str]:
        """The longest words of a template, in all places, until there are more places than it may have differences."""
        cues, places = set(), 0
        for w in sorted(set(words), key=lambda w: (-len(w), w)):
            if places > self.most * len(words):
                break
            cues.add(w)
            places += words.count(w)
        return cues

    def blocks(self, text: str) -> list[tuple[int, str]]:
        """(number of its first word in the text, block)"""
        cues = [m.span() for m in self.cues.finditer(text.lower())]
        if not cues:
            return []
        text = text.lower() if len(text.lower()) != len(text) else text  # a few capitals grow: then cues have other places
        words = [m.span() for m in _WORDS.finditer(text)]
        begins, ends = [w[0] for w in words], [w[1] for w in words]
        runs = []
        for begin, end in cues:
            a, b = max(0, bisect_right(ends, begin) - self.margin), min(len(words), bisect_left(begins, end) + self.margin)
            if runs and a <= runs[-1][1]:
                runs[-1][1] = b
            else:
                runs.append([a, b])
        step, out = max(1, self.window // 2), []
        for a, b in runs:
            for k in range(a, max(a + 1, b - step), step):
                z = min(b, k + self.window)
                out.append((k, " ".join(text[begins[k] : begins[z] if z < len(words) else len(text)].split())))
        return out

    def matches(self, template: list[str], block: list[str]) -> list[tuple[int, int, int]]:
        """(begin, end, differences) by end, of the best alignments with few enough differences: template words left out,
        and block words between those matched."""
        most = self.most * len(template)
        have = set(block)
        if sum(w not in have for w in template) > most:
            return []
        places = np.arange(len(block) + 1)
        row, begin = np.zeros(len(block) + 1, "int64"), places  # by where the alignment ends; it may begin anywhere
        for w in template:
            new, start = row + 1, begin.copy()
            equal = np.flatnonzero([w == x for x in block]) + 1
            equal = equal[row[equal - 1] <= new[equal]]
            new[equal], start[equal] = row[equal - 1], begin[equal - 1]
            ahead = new - places
            least = np.minimum.accumulate(ahead)
            source = np.maximum.accumulate(np.where(ahead == least, places, 0))
            row, begin = least + places, start[source]
        ends = np.flatnonzero((row <= most) & (begin < places))
        return list(zip(begin[ends].tolist(), ends.tolist(), row[ends].tolist(), strict=True))

    def ranked(self, block: str) -> list[int]:
        """The templates by the bytes that each saves on the block, most first."""
        data = block.encode("utf-8", "replace")
        size = [len(c.compress(data)) for _, _, c in self.known]
        return sorted(range(len(size)), key=lambda k: (size[k], k))

    def block(self, block: str) -> list[tuple[int, int, float, int, int, int, int, int]]:
        """(bytes saved, matched words less differences, reduction, rank, template, begin, end, differences) of all matches
        confirmed."""
        places = [m.span() for m in _WORDS.finditer(block)]
        words = [block[a:b].lower() for a, b in places]
        out = []
        for rank, k in enumerate(self.ranked(block)):
            _, template, c = self.known[k]
            for begin, end, n in self.matches(template, words):
                data = block[places[begin][0] : places[end - 1][1]].encode("utf-8", "replace")
                alone, given = len(self.plain.compress(data)), len(c.compress(data))
                gain = 1 - given / alone
                if gain >= self.least:
                    out.append((alone - given, (len(template) + end - begin - n) // 2 - n, round(gain, 6), rank, k, begin, end, n))
        return out

    def text(self, text: str | None) -> tuple[int, int, str | None, str | None, float | None, int | None]:
        blocks = self.blocks(text or "")
        every = [(saved, score, gain, rank, k, at + begin, at + end, n) for at, b in blocks for saved, score, gain, rank, k, begin, end, n in self.block(b)]
        found, taken = [], []
        for _, _, gain, _, k, begin, end, n in sorted(every, key=lambda m: (-m[1], -m[0], m[3], *m[4:7])):
            at = bisect_left(taken, (begin, end))
            if (at == 0 or taken[at - 1][1] <= begin) and (at == len(taken) or end <= taken[at][0]):
                taken.insert(at, (begin, end))
                found.append((self.known[k][0], gain, n))
        if not found:
            return len(blocks), 0, None, None, None, None
        best = min(found, key=lambda x: (x[2], -x[1], x[0]))
        return len(blocks), len(found), ",".join(sorted({x[0] for x in found})), *best


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, **options) -> DataFrame:
    """n_blocks, n_confirmed (notices that do not overlap), licenses (all, by name), license, reduction and n_differences of the best, for every row."""
    templates = templates or TEMPLATES

    def start():
        scanner = Scanner(templates, **options)
        return lambda doc_ids, texts: [doc_ids, *zip(*map(scanner.text, texts), strict=True)]

    schema = "doc_id long, n_blocks long, n_confirmed long, licenses string, license string, reduction double, n_differences long"
    return by_batch(docs, ["doc_id", "text"], schema, start)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))
