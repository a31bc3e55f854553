"""License scans: MinHash bands over overlapping text windows retrieve templates,
exact shingle containment verifies them.

Texts and templates are words (ASCII lower case) and five-word shingles.  For
each size class of templates (a power of two of words) a text is covered by
windows of twice that size, each half over the next, so every occurrence of a
template lies inside one window.  The bands are single minima; their number is set
by class from the least Jaccard similarity that a full window holding ``CONTAINMENT``
of a template can have, so that such a window misses all of them with probability
``MISS`` at most.  Where every shingle is needed (templates of one to four
shingles) the least one is the key itself and nothing can be missed.  A proposed
template is accepted where the window contains at least 0.8 of its shingles (exact
set containment); the span runs from the first to the last shared word.  Windows
without any shingle of a class's templates cannot share a minimum with one of
them, so only the others are sketched.

Templates are a small list by parameter; it is shipped whole (``TEMPLATES`` is
under 4 kB).

Cases: null, empty and word-less texts hold no license; templates of fewer than
five words are one shingle; a template met in several windows or places counts
once per span; repeated rows are scanned row by row; very long texts are cut into
the same windows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import Words, chunks, mix

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
BLOCK = 4096           # shingles sketched at a time

# Short license notices, by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "MIT": "Released under the MIT License",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def bands(shingles: int, window: int) -> int:
    """Minima by which a window of at most that many shingles proposes a template it holds."""
    shared = math.ceil(CONTAINMENT * shingles)
    alike = shared / (window + shingles - shared)
    return math.ceil(math.log(MISS) / math.log(1 - alike))


def _minhash(h: np.ndarray, n: int) -> np.ndarray:
    """The first n minima of a shingle set."""
    seeds = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x51ED2701))
    low = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(h), BLOCK):
        low = np.minimum(low, mix(h[i: i + BLOCK, None] ^ seeds[None, :]).min(axis=0))
    return low


class SizeClass:
    """Templates of one size: their shingles, band keys, and keys of those that need every shingle."""

    def __init__(self, size: int, sets: dict):
        self.size = size
        self.known = np.unique(np.concatenate(list(sets.values())))
        self.keys: dict = {}
        whole = {i: s for i, s in sets.items() if math.ceil(CONTAINMENT * len(s)) == len(s)}
        for i, s in whole.items():
            self.keys.setdefault(int(s[0]), []).append(i)
        self.key_set = np.array(sorted(self.keys), dtype=np.uint64)
        banded = {i: s for i, s in sets.items() if i not in whole}
        self.n = max((bands(len(s), 2 * size - SHINGLE + 1) for s in banded.values()), default=0)
        self.bands: dict = {}
        for i, s in banded.items():
            for b, low in enumerate(_minhash(s, self.n).tolist()):
                self.bands.setdefault((b, low), []).append(i)

    def proposed(self, shingles: np.ndarray) -> set:
        out = {t for x in np.intersect1d(shingles, self.key_set).tolist() for t in self.keys[x]}
        if self.n:
            out.update(t for b, low in enumerate(_minhash(shingles, self.n).tolist()) for t in self.bands.get((b, low), ()))
        return out


class Index:
    """Templates with their shingle sets, by size class."""

    def __init__(self, templates: dict):
        self.names = sorted(templates)
        col = pa.array([templates[n] for n in self.names], pa.large_string())
        (_, _, data, offs), = list(chunks(col, 1 << 62)) or [(0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64))]
        w = Words(data, offs)
        doc, _, h = w.shingles(SHINGLE)
        self.sets = [np.unique(h[doc == i]) for i in range(len(self.names))]
        by_size: dict = {}
        for i, shingles in enumerate(self.sets):
            if len(shingles):
                by_size.setdefault(1 << int(np.ceil(np.log2(max(w.count[i], SHINGLE)))), []).append(i)
        self.classes = [SizeClass(size, {i: self.sets[i] for i in members}) for size, members in sorted(by_size.items())]

    def scan(self, words: Words):
        """[(text, template, first word, end word)] with exact containment."""
        doc, at, h = words.shingles(SHINGLE)
        found = set()
        for group in self.classes if len(h) else ():
            size = group.size
            slot = np.minimum(np.searchsorted(group.known, h), len(group.known) - 1)
            hit = np.flatnonzero(group.known[slot] == h)
            pos = at[hit] - words.first[doc[hit]]
            wins = {(d, max(p // size - j, 0)) for d, p in zip(doc[hit].tolist(), pos.tolist()) for j in (0, 1)}
            for d, j in sorted(wins):
                lo = words.first[d] + j * size
                hi = min(lo + 2 * size, words.first[d] + words.count[d])
                a = np.searchsorted(at, lo)
                z = max(np.searchsorted(at, hi - min(SHINGLE, words.count[d]), "right"), a)
                inside = h[a:z]
                if not len(inside):
                    continue
                for t in group.proposed(inside):
                    match = np.flatnonzero(np.isin(inside, self.sets[t]))
                    need = CONTAINMENT * len(self.sets[t])
                    if len(np.unique(inside[match])) < need:
                        continue
                    places = _occurrences(inside, match.tolist())
                    for one in [p for p in places if len(p) >= need] or [match.tolist()]:
                        found.add((d, t, int(at[a + one[0]]),
                                   int(at[a + one[-1]]) + min(SHINGLE, int(words.count[d]))))
        return sorted(found)


def _occurrences(shingles: np.ndarray, match: list) -> list:
    """Runs of matched places in which no shingle comes twice."""
    runs, seen = [[]], set()
    for m in match:
        if shingles[m] in seen:
            runs.append([])
            seen = set()
        seen.add(shingles[m])
        runs[-1].append(m)
    return runs


def scan(docs: DataFrame, templates: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, licenses (sorted ids), spans (id, start, end in code points)."""
    index = docs.sparkSession.sparkContext.broadcast(Index(templates or TEMPLATES))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in chunks(b.column(1)):
                w = Words(data, offs)
                spans: list[list] = [[] for _ in range(hi - lo)]
                chars = None
                for d, t, first, end in index.value.scan(w):
                    if chars is None:
                        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    spans[d].append({"id": index.value.names[t], "start": int(chars[w.start[first]] - chars[offs[d]]),
                                     "end": int(chars[w.end[end - 1]] - chars[offs[d]])})
                spans = [_outer(s) for s in spans]
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo), pa.array([sorted({x["id"] for x in s}) for s in spans],
                                                              pa.list_(pa.string())),
                     pa.array(spans, pa.list_(pa.struct([("id", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
                    names=["doc_id", "licenses", "spans"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, licenses array<string>, "
                             "spans array<struct<id:string,start:bigint,end:bigint>>"))


def _outer(spans: list) -> list:
    """Spans of one template that overlap become one."""
    out: list = []
    for s in sorted(spans, key=lambda x: (x["id"], x["start"], x["end"])):
        if out and out[-1]["id"] == s["id"] and s["start"] < out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return sorted(out, key=lambda x: (x["start"], x["id"]))


def report(docs: DataFrame) -> DataFrame:
    return scan(docs).select("doc_id", F.size("licenses").cast("bigint").alias("n_licenses"),
                             F.array_join("licenses", ",").alias("licenses"),
                             F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["id"], s["start"], s["end"])),
                                          ",").alias("spans"))
