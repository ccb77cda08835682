"""License scans: MinHash bands over overlapping word windows retrieve templates, exact containment verifies them.

Templates and texts are sets of 5-word shingles. For each length of template, windows of that length (plus a quarter
for words put in between) and a step overlap by all but a quarter, so any occurrence lies in one window as a whole. If
it holds the required share of a template's shingles, its Jaccard similarity with the window is at least some J, and
with bands of one value, b bands miss it with probability (1 - J) ** b; b is set for each length so that this is at most
``MISS``. A window that shares a band value with a template is then compared exactly: the share of the template's
shingles that the window holds. Only documents that hold the required share of some template anywhere are looked at by
windows; one lookup of every shingle among those of all templates tells them, exactly.

Of matches that rest on the same words the nearest one is kept if asked for: matches are taken by how many of their
template's shingles they hold, then by containment, and one whose places are for the most part taken already is dropped.
So one of two versions that differ in few words stays, and a notice within a whole license text goes.

Templates are the caller's, broadcast with their tables; documents never leave their task, and nothing is shuffled.

Rows: NULL texts and those of fewer than five words hold nothing; every row is scanned by itself, repeated ones too;
templates need five words; equal templates under two names are both reported; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import license_texts
from rosterline.llm.common import SortedHashes, buffers, letters_and_digits, mix, prepare, ragged, slices, windows, words

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4
SLACK = 1.25
FAR = np.uint64(0xFFFFFFFFFFFFFFFF)

# Short public notices and statements by which texts are licensed; ``covered`` has all.
TEMPLATES = {
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit-line": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
}

MATCH = "struct<template:string,first_word:long,last_word:long,containment:double>"
SCAN = f"doc_id long, n_words long, matches array<{MATCH}>"


class Length:
    """The templates of one word count, the windows that find them, and their band values."""

    def __init__(self, word_count: int, templates: list[tuple[str, np.ndarray]], containment: float):
        self.names = [name for name, _ in templates]
        self.sets = [np.unique(shingles) for _, shingles in templates]
        span = math.ceil(SLACK * word_count)
        self.step = max(1, span // 4)
        self.size = span + self.step - SHINGLE + 1  # shingles in a window
        self.bands = 1
        for found in self.sets:
            held = math.ceil(containment * len(found))
            least = held / (self.size + len(found) - held)
            self.bands = max(self.bands, math.ceil(math.log(MISS) / math.log(1 - least)) if least < 1 else 1)
        self.factors = mix(np.arange(1, self.bands + 1, dtype=np.uint64) + np.uint64(word_count << 20)) | np.uint64(1)
        self.values = np.array([[(found * a).min() for found in self.sets] for a in self.factors])  # by band and template

    def windows(self, count: int) -> np.ndarray:
        return np.arange(0, max(count - self.size, 0) + self.step, self.step)

    def candidates(self, shingles: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window start, template) where a band value agrees; ``real`` marks shingles within one document."""
        starts = self.windows(len(shingles))
        last = np.minimum(starts + self.size, len(shingles))
        hit = np.zeros((len(starts), len(self.names)), bool)
        for a, values in zip(self.factors, self.values):
            low = np.where(real, shingles * a, FAR)
            width = 1
            while 2 * width <= self.size and 2 * width <= len(shingles):
                low = np.minimum(low[: len(low) - width], low[width:])
                width *= 2
            final = np.minimum(low[np.minimum(starts, len(low) - 1)], low[np.maximum(last - width, 0)])
            for k, value in enumerate(values):
                hit[:, k] |= final == value
        where, which = np.nonzero(hit)
        return starts[where], which


def covered() -> dict[str, str]:
    """``TEMPLATES``, whole licenses, notices and statement lines; of texts with the same words the first."""
    found: dict[tuple, tuple[str, str]] = {}
    for name, text in (TEMPLATES | license_texts.whole_texts() | license_texts.NOTICES | license_texts.lines()).items():
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes, _ = words(raw, np.array([0, len(raw)]), letters_and_digits())
        found.setdefault(tuple(hashes.tolist()), (name, text))
    return dict(found.values())


def lengths(templates: dict[str, str], containment: float = CONTAINMENT) -> list[Length]:
    by_count: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in sorted(templates.items()):
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes, _ = words(raw, np.array([0, len(raw)]), letters_and_digits())
        if len(hashes) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        by_count.setdefault(len(hashes), []).append((name, windows(hashes, SHINGLE)))
    return [Length(count, group, containment) for count, group in sorted(by_count.items())]


class Catalogue:
    """All templates, by length, and which of them each shingle is in."""

    def __init__(self, known: list[Length], containment: float):
        self.known, self.containment = known, containment
        self.sets = {name: found for length in known for name, found in zip(length.names, length.sets)}
        shingles = [found for length in known for found in length.sets]
        self.first = np.cumsum([0, *(len(length.sets) for length in known)])  # template of each length
        self.sizes = np.array([len(found) for found in shingles])
        every = np.concatenate([*shingles, np.empty(0, np.uint64)])
        template = np.repeat(np.arange(len(shingles)), self.sizes)
        order = np.lexsort((template, every))
        keys, self.counts = np.unique(every, return_counts=True)
        self.index, self.templates, self.starts = SortedHashes(keys), template[order], np.cumsum(self.counts) - self.counts

    def possible(self, shingles: np.ndarray, row_of: np.ndarray, real: np.ndarray, rows: int) -> np.ndarray:
        """By row and length: whether the row holds the required share of such a template anywhere."""
        found = self.index.find(shingles)
        at = np.flatnonzero(real & (found >= 0))
        width, kinds = max(len(self.counts), 1), len(self.sizes)
        row, shingle = np.divmod(np.unique(row_of[at] * width + found[at]), width)
        n = self.counts[shingle]
        held = np.bincount(np.repeat(row, n) * kinds + self.templates[ragged(self.starts[shingle], n)], minlength=rows * kinds)
        enough = held.reshape(rows, kinds) >= self.containment * self.sizes
        return np.stack([enough[:, a:b].any(axis=1) for a, b in zip(self.first[:-1], self.first[1:])], axis=1)


def matches(catalogue: Catalogue, hashes: np.ndarray, at: np.ndarray, nearest: bool = False) -> list[list[tuple]]:
    """Verified matches of each document of a slice: template, first and last word, containment."""
    rows = len(at) - 1
    found: list[list[tuple]] = [[] for _ in range(rows)]
    shingles = windows(hashes, SHINGLE)
    if len(shingles) == 0 or not catalogue.known:
        return found
    row_of, real = _rows(at, len(shingles))
    possible = catalogue.possible(shingles, row_of, real, rows)
    for k, length in enumerate(catalogue.known):
        some = np.flatnonzero(possible[:, k])
        if len(some):
            counts = at[some + 1] - at[some]
            for row, match in _of_length(length, hashes[ragged(at[some], counts)], np.append(0, np.cumsum(counts)), catalogue.containment):
                found[some[row]].append(match)
    merged = [_merged(x) for x in found]
    return [_nearest(x, shingles[at[row] : at[row + 1]], catalogue.sets) if x else x for row, x in enumerate(merged)] if nearest else merged


def _rows(at: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of every shingle, and whether it lies within that row."""
    row_of = np.searchsorted(at, np.arange(count), side="right") - 1
    return row_of, np.arange(count) + SHINGLE <= at[1:][row_of]


def _of_length(length: Length, hashes: np.ndarray, at: np.ndarray, containment: float) -> Iterator[tuple[int, tuple]]:
    shingles = windows(hashes, SHINGLE)
    row_of, real = _rows(at, len(shingles))
    starts, which = length.candidates(shingles, real)
    for k in np.unique(which).tolist():
        wanted = length.sets[k]
        spots = starts[which == k]
        sizes = np.minimum(spots + length.size, len(shingles)) - spots
        places = ragged(spots, sizes)
        inside = real[places] & np.isin(shingles[places], wanted)
        window, place = np.repeat(np.arange(len(spots)), sizes)[inside], places[inside]
        # Distinct shingles by window and document.
        table = np.stack([window, row_of[place], np.searchsorted(wanted, shingles[place])], axis=1)
        held, counts = np.unique(np.unique(table, axis=0)[:, :2], axis=0, return_counts=True)
        for (w, row), n in zip(held.tolist(), counts.tolist()):
            if n >= containment * len(wanted):
                own = place[(window == w) & (row_of[place] == row)] - at[row]
                yield row, (length.names[k], int(own.min()), int(own.max()) + SHINGLE - 1, n / len(wanted))


def _nearest(found: list[tuple], shingles: np.ndarray, sets: dict[str, np.ndarray]) -> list[tuple]:
    """The matches less those whose places belong for the most part to a nearer one."""
    claims = []
    for match in found:
        name, first, last, share = match
        places = first + np.flatnonzero(np.isin(shingles[first : last - SHINGLE + 2], sets[name]))
        claims.append((-len(np.unique(shingles[places])), -share, match, places))
    taken, out = np.zeros(len(shingles), bool), []
    for _, _, match, places in sorted(claims, key=lambda c: c[:3]):
        if 2 * int(taken[places].sum()) <= len(places):
            out.append(match)
            taken[places] = True
    return sorted(out)


def _merged(found: list[tuple]) -> list[tuple]:
    """Overlapping spans of a template as one, with the best containment."""
    out: list[tuple] = []
    for name, first, last, share in sorted(found):
        if out and out[-1][0] == name and first <= out[-1][2]:
            out[-1] = (name, out[-1][1], max(last, out[-1][2]), max(share, out[-1][3]))
        else:
            out.append((name, first, last, share))
    return out


SCAN_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("matches", pa.list_(pa.struct([("template", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("containment", pa.float64())])))]
)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, nearest: bool = False) -> DataFrame:
    """Per document: its words, and every place that holds a template; of competing ones all or the nearest."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(Catalogue(lengths(templates, containment), containment))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = letters_and_digits()
        names = ("template", "first_word", "last_word", "containment")
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last in slices(offsets):
                hashes, at = words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], values)
                found = [[dict(zip(names, m)) for m in of] for of in matches(shared.value, hashes, at, nearest)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(at)), pa.array(found, SCAN_ARROW.field(2).type)], schema=SCAN_ARROW
                )

    return docs.select("doc_id", "text").mapInArrow(rows, SCAN)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), covered(), nearest=True)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["template"])))
    return found.select(
        "doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
        F.array_max(F.transform("matches", lambda m: m["containment"])).alias("containment"),
    )
