"""Licence notices in texts: a trained paragraph classifier whose finds are compared with templates."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm import words as W
from stridelake.llm.cluster import sound_text, text_slices

UNKNOWN = "unknown"
BUCKETS = 1 << 15
#: About so many documents, and so many characters of each, give paragraphs of the unknown class; at most so many of these are taught.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, SAMPLE_PARAGRAPHS = 600, 20_000, 12_000
#: A template confirms a paragraph that holds this share of its word shingles.
MIN_SIMILARITY = 0.6

# The wording by which each licence family is declared.
TEMPLATES = {
    "agpl": [
        "licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "released under the AGPL-3.0 license",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "released under the Apache 2.0 license",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "released under the BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
        "available under the Creative Commons Attribution License",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY-NC-SA 4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Licensed under CC BY-SA 4.0",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Released under CC0 1.0 Universal",
        "dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program",
        "released under the GPL-3.0 license",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "released under the ISC License",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "licensed under the GNU Lesser General Public License, version 2.1",
        "released under the LGPL-2.1 license",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
        "released under the Mozilla Public License 2.0",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
}

_KEPT = np.zeros(256, bool)
_KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"-.+"]] = True


UNITS = ("paragraph", "sentence", "line")
_ENDS = np.zeros(256, bool)
_ENDS[[*b".:;!?"]] = True


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """data in lower case, with a space for what belongs to no word: comment marks, quotes, and marks at a word's ends."""
    plain = np.where(_KEPT[data], W.LOWER[data], np.uint8(0x20))
    soft = (plain == 0x2E) | (plain == 0x2D) | (plain == 0x2B)
    for _ in range(2):
        outer = soft.copy()
        outer[:-1] &= plain[1:] == 0x20
        plain[outer] = 0x20
        outer = soft & (plain != 0x20)
        outer[1:] &= plain[:-1] == 0x20
        plain[outer] = 0x20
    return plain


@dataclass
class Paragraphs:
    """The units with words of many texts: their text's index, their bytes' place there, and the words' hashes."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, values: pa.Array, unit: str = "line") -> Paragraphs:
        """Lines, sentences that may run over lines, or paragraphs: runs of lines up to one that holds no word."""
        data, offsets = W.buffers(values)
        plain = _word_bytes(data)
        if unit == "sentence":
            mark = _ENDS[data]
            mark[:-1] &= W.SPACES[data[1:]]
            breaks = np.flatnonzero(mark) + 1
        else:
            breaks = np.flatnonzero(data == 0x0A) + 1
        if unit != "line":
            lines = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
            blank = np.diff(np.concatenate([[0], np.cumsum(plain != 0x20)])[lines]) == 0
            bare = np.unique(np.concatenate([lines[:-1][blank], lines[1:][blank]]))
            breaks = bare if unit == "paragraph" else np.concatenate([breaks, bare])
        bounds = np.unique(np.concatenate([offsets, breaks]))
        starts, ends, counts = W.spans(plain, bounds)
        with np.errstate(over="ignore"):
            words = W.word_hashes(plain, starts, ends)
        full = counts > 0
        last = np.cumsum(counts[full]) - 1
        begin, stop = starts[last - counts[full] + 1], ends[last]
        # A unit reaches from its first word to the last, with the mark that ends it.
        stop = stop + ((stop < bounds[1:][full]) & _ENDS[data[np.minimum(stop, max(len(data) - 1, 0))]])
        text = np.searchsorted(offsets, begin, side="right") - 1
        return cls(text, begin - offsets[text], stop - offsets[text], words, counts[full])

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words, then those of the pairs (-1 where a paragraph ends), in order of the words."""
        last = np.cumsum(self.counts) - 1
        with np.errstate(over="ignore"):
            pairs = W.mix(self.words * np.uint64(0x9E3779B97F4A7C15) + np.roll(self.words, -1))
        pairs = (pairs % np.uint64(BUCKETS)).astype(np.int64)
        pairs[last] = -1
        return (self.words % np.uint64(BUCKETS)).astype(np.int64), pairs


def shingles(words: np.ndarray, width: int = 3) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.unique(W.shingle_hashes(words, np.array([len(words)]), width)[0])


@dataclass(frozen=True)
class LicenceModel:
    """weights: one row per bucket, the last for none; the first class is the unknown one, accept the least score of the others."""

    families: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: dict[str, list[np.ndarray]]
    accept: float = 0.5

    def scores(self, p: Paragraphs) -> np.ndarray:
        one, two = p.grams()
        begin = np.cumsum(p.counts) - p.counts
        total = np.add.reduceat(self.weights[one] + self.weights[two], begin, axis=0)
        z = (total / np.sqrt(2 * p.counts - 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def similarity(self, words: np.ndarray, family: str) -> float:
        """The largest share of a template's word shingles that the words hold, over the family's templates."""
        own = shingles(words)
        return max(len(np.intersect1d(own, t, assume_unique=True)) / max(len(t), 1) for t in self.templates[family])

    def find(self, values: pa.Array) -> list[list[dict]]:
        """For each text the paragraphs, sentences and lines that declare a licence, of overlapping ones of a family the best."""
        seen: list[list[dict]] = [[] for _ in range(len(values))]
        for unit in UNITS:
            p = Paragraphs.of(values, unit)
            if not len(p.counts):
                break
            scores = self.scores(p)
            ends = np.cumsum(p.counts)
            best = scores[:, 1:].argmax(axis=1) + 1
            for k in np.flatnonzero(scores[np.arange(len(best)), best] >= self.accept).tolist():
                family = self.families[best[k]]
                alike = self.similarity(p.words[ends[k] - p.counts[k] : ends[k]], family)
                seen[p.text[k]].append(
                    {
                        "start": int(p.starts[k]), "end": int(p.ends[k]), "family": family,
                        "score": float(scores[k, best[k]]), "similarity": alike, "confirmed": alike >= MIN_SIMILARITY,
                    }
                )
        return [_apart(found) if len(found) > 1 else found for found in seen]


def _apart(found: list[dict]) -> list[dict]:
    """Confirmed finds first, then by similarity and shortness; what overlaps one that stays goes."""
    kept: list[dict] = []
    for x in sorted(found, key=lambda x: (not x["confirmed"], -x["similarity"], x["end"] - x["start"], x["start"])):
        if all(x["end"] <= y["start"] or y["end"] <= x["start"] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: x["start"])


def _variants(rng: np.random.Generator, text: str, times: int) -> list[str]:
    """The text, and copies with words left out, cut short, or set among others."""
    words = text.split()
    out = [text]
    for _ in range(times):
        kept = [w for w in words if rng.random() > 0.08]
        if len(kept) > 12 and rng.random() < 0.4:
            at = int(rng.integers(0, len(kept) - 8))
            kept = kept[at : at + int(rng.integers(8, len(kept)))]
        if rng.random() < 0.4:
            kept = ["copyright", str(rng.integers(1995, 2026)), "the authors", *kept]
        out.append(" ".join(kept))
    return out


def fit(negatives: list[str], epochs: int = 6, rate: float = 0.5, seed: int = 3, times: int = 24) -> LicenceModel:
    """Logistic regression by stochastic gradient descent on varied templates and on paragraphs of other texts.

    A fifth of the examples is set aside and calibrates: it gives the temperature,
    and the least score at which a family is accepted, which turns away all but 1 in
    1000 of the paragraphs without a notice, but at most 1 in 50 of the notices.
    Paragraphs of the sample that hold much of a template aren't taught as unknown.
    """
    rng = np.random.default_rng(seed)
    families = (UNKNOWN, *sorted(TEMPLATES))
    known = {
        f: [shingles(Paragraphs.of(pa.array([t])).words) for t in TEMPLATES[f]] for f in families[1:]
    }
    texts = [(v, k) for k, f in enumerate(families) if k for t in TEMPLATES[f] for v in _variants(rng, t, times)]
    model = LicenceModel(families, np.zeros((BUCKETS + 1, len(families)), np.float32), np.zeros(len(families)), 1.0, known)
    negatives = [" ".join(x.split("\n")) for x in negatives]
    p = Paragraphs.of(pa.array(negatives, pa.string()))
    ends = np.cumsum(p.counts)
    for k in range(len(p.counts)):
        words = p.words[ends[k] - p.counts[k] : ends[k]]
        if all(model.similarity(words, f) < 0.3 for f in families[1:]):
            texts.append((negatives[p.text[k]], 0))
    common = "the license of this work is described below|all rights reserved|see the license file for details|".split("|")
    texts += [(x, 0) for x in common if x for _ in range(5)]
    order = rng.permutation(len(texts))
    held, taught = order[: len(order) // 5], order[len(order) // 5 :]
    rows = []
    for x, k in texts:
        q = Paragraphs.of(pa.array([" ".join(x.split("\n"))], pa.string()))
        one, two = q.grams() if len(q.counts) else (np.zeros(0, np.int64),) * 2
        rows.append((np.concatenate([one, two[two >= 0]]), k))
    weights, bias = model.weights, model.bias
    done, steps = 0, epochs * len(taught)
    for _ in range(epochs):
        for i in rng.permutation(taught):
            ids, k = rows[i]
            if not len(ids):
                continue
            now = rate * (1 - done / steps)
            done += 1
            size = 1 / np.sqrt(len(ids))
            z = weights[ids].sum(axis=0) * size + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[k] -= 1
            np.subtract.at(weights, ids, (now * size * g).astype(np.float32))
            bias -= 0.1 * now * g
    z = np.array([weights[rows[i][0]].sum(axis=0) / np.sqrt(max(len(rows[i][0]), 1)) + bias for i in held])
    right = np.array([rows[i][1] for i in held])

    def loss(t: float) -> float:
        s = (z - z.max(axis=1, keepdims=True)) / t
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(right)), right]).mean())

    best = min([0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0], key=loss)
    g = np.exp((z - z.max(axis=1, keepdims=True)) / best)
    g = g[:, 1:].max(axis=1) / g.sum(axis=1)
    quantile = lambda x, share, other: float(np.quantile(x, share)) if len(x) else other
    accept = min(max(quantile(g[right == 0], 0.999, 0.5), 0.05), quantile(g[right > 0], 0.02, 0.5))
    return LicenceModel(families, weights, bias, best, known, accept)


def fit_on(docs: DataFrame, id_col: str, text_col: str, documents: int = SAMPLE_DOCUMENTS) -> LicenceModel:
    """Fit with paragraphs of about `documents` documents, drawn by a hash of their id, as the unknown class.

    SAMPLE_CHARS and SAMPLE_PARAGRAPHS bound what is read of them; where there are
    more paragraphs, sentences and lines, a hash of their words draws those taught.
    """
    some = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    rate = int(min(1.0, documents / max(some.count(), 1)) * 2**30)
    drawn = some.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("licence")), F.lit(2**30)) < rate)
    texts = [r[0] for r in drawn.select(F.substring(F.col(text_col), 1, SAMPLE_CHARS)).collect()]
    values = sound_text(pa.array(texts, pa.string()))
    raw = [x.encode() for x in values.to_pylist()]
    found = {
        raw[t][a:b].decode("utf-8", "replace")
        for unit in UNITS
        for p in [Paragraphs.of(values, unit)]
        for t, a, b in zip(p.text.tolist(), p.starts.tolist(), p.ends.tolist(), strict=True)
    }
    return fit(sorted(found, key=lambda x: (zlib.crc32(x.encode()), x))[:SAMPLE_PARAGRAPHS])


def scan_licences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None
) -> DataFrame:
    """One row per document: doc_id, families (confirmed ones, sorted, each once) and found.

    Paragraphs (runs of lines with words; comment marks are none), the sentences in
    them, which may run over lines, and single lines are judged. found lists those
    whose licence family reaches the accepted score, the best of overlapping ones:
    bytes [start, end) of the text, family, score, the share of a template of the
    family that they hold, and whether that confirms the prediction. Null and empty texts find nothing; repeated rows give repeated rows, other
    columns are ignored, and an empty table gives no rows.
    """
    model = model or fit_on(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        ("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("score", pa.float64()),
        ("similarity", pa.float64()), ("confirmed", pa.bool_()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                found = shared.value.find(sound_text(part.column(1)))
                families = [sorted({x["family"] for x in f if x["confirmed"]}) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(families, pa.list_(pa.string())),
                        pa.array(found, pa.list_(pa.struct(fields))),
                    ],
                    ["doc_id", "families", "found"],
                )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {kind}, families array<string>, found array<struct<start: long, end: long, family: string, "
        "score: double, similarity: double, confirmed: boolean>>",
    )
