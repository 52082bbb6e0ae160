"""License scans: runs of sentences and lines against license templates by the Dice
coefficient over word bigrams.

Text and templates are normalised alike: lower case, ASCII punctuation is white
space. Dice >= t needs bigram counts within the factor (2 - t) / t of each
other, so a run is compared only with templates inside that size bound and no
run grows beyond the largest; runs that begin with a sentence without any
bigram of a template are not formed, unless the next one has some.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lists, out_batch
from .decontam import words as tokens

MIN_DICE = 0.8
#: Sentences without a new bigram after which a run looks ahead.
IDLE = 3
_SENTENCE_END = re.compile(r"(?<=[.!?;:])[ \t]+").split

# Customary license notices (name, text).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
]


class Templates:
    """Bigram sets of the templates, by bigram and by size."""

    def __init__(self, templates: Sequence[tuple[str, str]], min_dice: float):
        self.min_dice = min_dice
        self.sets = []
        for name, text in templates:
            w = tokens(text)
            if len(w) > 1:
                self.sets.append((name, frozenset(zip(w, w[1:]))))
        self.bigrams = frozenset().union(*(s for _, s in self.sets))
        self.factor = (2 - min_dice) / min_dice
        self.largest = max((len(s) for _, s in self.sets), default=0) * self.factor

    def best(self, bigrams: set) -> tuple[float, str] | None:
        n, found = len(bigrams), None
        for name, s in self.sets:
            if n <= len(s) * self.factor and len(s) <= n * self.factor:
                dice = 2 * len(bigrams & s) / (n + len(s))
                if dice >= self.min_dice and (found is None or dice > found[0]):
                    found = dice, name
        return found


def segments(text: str | None) -> list[tuple[int, list[bytes]]]:
    """(line, tokens) of each sentence of each line, so that a notice inside a
    line of prose is a run of its own."""
    return [(n, tokens(x)) for n, line in enumerate((text or "").split("\n")) for x in _SENTENCE_END(line)]


class _News:
    """For runs that began long before: the next sentence with a new bigram.

    A sentence's bigrams are its own ones and the one that joins it to the
    sentence in front. ``old[j]`` is the latest start from which a run already
    holds all of them when it reaches sentence j; a tree of minima over it
    finds the next sentence that adds something in logarithmic time, however
    often a text repeats itself."""

    def __init__(self, parts: list, front: list):
        seen: dict = {}
        old = []
        for j, (_, w) in enumerate(parts):
            mine = [(b, j) for b in set(zip(w, w[1:]))]
            if w and front[j] is not None:
                mine.append(((front[j], w[0]), j - 1))  # not in a run that starts with j
            old.append(min((seen.get(b, -1) for b, _ in mine), default=len(parts)))
            for b, at in mine:
                seen[b] = max(seen.get(b, -1), at)
        self.n = 1 << max(len(old) - 1, 0).bit_length()
        self.low = [0] * self.n + old + [len(parts)] * (self.n - len(old))
        for i in range(self.n - 1, 0, -1):
            self.low[i] = min(self.low[2 * i], self.low[2 * i + 1])

    def next(self, j: int, start: int) -> int | None:
        """The first sentence from j on that is new to a run from ``start``."""
        i = j + self.n
        if j >= self.n:
            return None
        while self.low[i] >= start:
            while i & 1:  # up to where a right neighbour is left
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.n:
            i *= 2
            if self.low[i] >= start:
                i += 1
        return i - self.n


def scan_text(templates: Templates, text: str | None) -> list[tuple[int, int, str, float]]:
    """(first line, last line, license, dice) of the matching runs of
    sentences; of overlapping runs the best stays (then the first, then the
    shortest). A sentence that adds no bigram to a run leaves its similarity as
    it is, so the longer run never is the one that stays and is not compared;
    after ``IDLE`` such sentences the next ones are passed over at once
    (``_News``)."""
    parts = segments(text)
    known = templates.bigrams
    told = [not known.isdisjoint(zip(w, w[1:])) for _, w in parts]
    if not any(told):
        return []
    front, last = [], None  # the last word in front of each sentence
    for _, w in parts:
        front.append(last)
        last = w[-1] if w else last
    news = None
    runs = []
    for i, (_, w) in enumerate(parts):
        if not told[i] and not (w and any(told[i + 1:i + 2])):
            continue
        bigrams = set(zip(w, w[1:]))
        j, grown, idle = i, True, 0
        while True:
            if len(bigrams) > templates.largest:
                break
            got = templates.best(bigrams) if bigrams and grown else None
            if got:
                runs.append((-got[0], i, j, got[1]))
            j += 1
            if idle >= IDLE:
                news = news or _News(parts, front)
                j = news.next(j, i)
            if j is None or j >= len(parts):
                break
            more = parts[j][1]
            before = len(bigrams)
            if more:
                bigrams.add((front[j], more[0]))
                bigrams.update(zip(more, more[1:]))
            grown = len(bigrams) > before
            idle = 0 if grown else idle + 1
    out, used = [], set()
    for d, i, j, name in sorted(runs):
        if used.isdisjoint(range(i, j + 1)):
            used.update(range(i, j + 1))
            out.append((i, j, name, -d))
    return [(parts[i][0], parts[j][0], name, d) for i, j, name, d in sorted(out)]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), min_dice: float = MIN_DICE) -> DataFrame:
    """``id_col, first_line, last_line, license, dice``: a row per match
    (lines are numbered from 0), over whole texts. The work on a text grows
    with its length, also where it repeats itself (a line 100,000 times).

    NULL, empty and license-free texts give no row; repeated rows give a match
    each; templates of equal similarity: the first listed. Templates of fewer
    than two words cannot match. Other columns are not read; an empty table gives
    no rows."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("first_line", T.LongType()),
                           T.StructField("last_line", T.LongType()), T.StructField("license", T.StringType()),
                           T.StructField("dice", T.DoubleType())])
    templates = list(templates)

    def run(batches):
        known = Templates(templates, min_dice)
        for b in batches:
            fields = [(id_col, b.schema.field(0).type), ("first_line", pa.int64()), ("last_line", pa.int64()),
                      ("license", pa.string()), ("dice", pa.float64())]
            for part in lists(b, "__text"):
                rows = [(k, *m) for k, t in zip(part["__id"], part["__text"]) for m in scan_text(known, t)]
                if rows:
                    yield out_batch(fields, list(zip(*rows)))

    return df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)
