"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are lines, and runs of short lines that a text was wrapped into. A sparse multinomial
logistic regression over word 1- to 3-grams tells licence families and "unknown" apart. It is trained
on variations of the families' templates against paragraphs of the corpus and shuffled templates; a
temperature fitted on other variations makes its probabilities honest. A predicted family counts as
confirmed when enough of the paragraph's 3-grams stand in one of its templates, or enough of a
template's in the paragraph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Corpus paragraphs used as examples of "unknown" in training: the only bound of this module.
BACKGROUND_ROWS = 2_000
#: Variations of each template, for fitting and for calibration.
VARIATIONS = 24
#: Calibrated probability a family needs; less is unknown.
SURE = 0.6
#: Share of 3-grams in common that confirms a prediction.
CONFIRM = 0.6
#: Lines up to this many characters may be parts of a wrapped paragraph, of so many lines at most.
WRAP_CHARS, WRAP_LINES = 120, 40
#: A word of the templates that at most this share of background paragraphs hold is an anchor.
ANCHOR_SHARE = 0.005
UNKNOWN = "unknown"

#: Characteristic passages of public licences, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
        " in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of"
        " the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring"
        " rights to this work. CC0 1.0 Universal Public Domain Dedication",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in"
        " any form or by any means without the prior written permission of the publisher.",
        "Copyright. All rights reserved.",
    ),
}

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams_of(words: list[str], low: int = 1, high: int = 3) -> list[tuple[str, ...]]:
    return [tuple(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


# --- the classifier ----------------------------------------------------------------------------


@dataclass
class Classifier:
    """Weights of the n-grams that matter, by family; the last family is "unknown"."""

    families: list[str]
    grams: dict[tuple[str, ...], int]
    weights: np.ndarray  # grams + 2 rows (share of unknown words, constant), a column per family
    temperature: float
    templates: dict[str, list[set[tuple[str, ...]]]]
    anchors: frozenset[str] = field(default_factory=frozenset)

    def _row(self, words: list[str]) -> tuple[list[int], float, float]:
        find = self.grams.get
        found = sorted({k for g in grams_of(words) if (k := find(g)) is not None})
        strange = sum(1 for w in words if (w,) not in self.grams) / max(1, len(words))
        return found, 1.0 / np.sqrt(max(1, len(found))), strange

    def probabilities(self, words: list[str]) -> np.ndarray:
        found, scale, strange = self._row(words)
        z = self.weights[found].sum(axis=0) * scale + self.weights[-2] * strange + self.weights[-1]
        z = z / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()

    def confirms(self, family: str, words: list[str]) -> bool:
        """Enough 3-grams in common with a template (whole words where a paragraph is shorter)."""
        size = min(3, len(words))
        own = set(grams_of(words, size, size))
        for template in self.templates[family]:
            other = template if size == 3 else {g[i : i + size] for g in template for i in range(len(g) - size + 1)}
            both = len(own & other)
            if both and (both >= CONFIRM * len(own) or both >= CONFIRM * len(template)):
                return True
        return False

    def judge(self, paragraph: str) -> tuple[str, float, bool] | None:
        """Family, probability and whether templates confirm it; None for unknown.

        A single word, or a paragraph without any anchor, is unknown."""
        words = words_of(paragraph)
        if len(words) < 2 or self.anchors.isdisjoint(words):
            return None
        p = self.probabilities(words)
        best = int(p.argmax())
        if self.families[best] == UNKNOWN or p[best] < SURE:
            return None
        return self.families[best], float(p[best]), self.confirms(self.families[best], words)


def _examples(background: list[str], seed: int) -> list[tuple[list[str], int]]:
    """Variations of the templates by family number, and of unknown paragraphs."""
    draw = np.random.default_rng(seed)
    corpus = [w for w in (words_of(p) for p in background) if w] or [["text"]]
    names, out = list(TEMPLATES), []
    for number, name in enumerate(names):
        for template in TEMPLATES[name]:
            words = words_of(template)
            for k in range(VARIATIONS):
                kept = [w for w in words if k == 0 or draw.random() > 0.15 * draw.random()]
                if len(words) > 20 and k % 3 == 1:  # a part of a long passage
                    at = int(draw.integers(0, len(words) // 2))
                    kept = words[at : at + int(draw.integers(12, len(words) + 1))]
                filler = corpus[int(draw.integers(len(corpus)))]
                before, after = (filler[: int(draw.integers(0, 4))] if k % 2 else [] for _ in "ab")
                out.append(([*before, *kept, *after], number))
    every = sorted({w for t in TEMPLATES.values() for p in t for w in words_of(p)})
    for k in range(len(names) * VARIATIONS):  # licence words without a licence
        size = int(draw.integers(2, 14))
        picked = [every[int(i)] for i in draw.integers(0, len(every), size)]
        filler = corpus[int(draw.integers(len(corpus)))][: int(draw.integers(3, 30))]
        out.append((picked if k % 2 else [*filler, *picked[:3], *filler[::-1]], len(names)))
    out += [(w, len(names)) for w in corpus]
    return out


def fit(background: list[str], rounds: int = 200, sparsity: float = 2e-4) -> Classifier:
    """Train on variations of the templates and every other background paragraph, with proximal steps that
    make weights zero; the temperature is fitted on other variations and the paragraphs left out."""
    examples = _examples(background[::2], 1)
    names = [*TEMPLATES, UNKNOWN]
    counts: dict[tuple[str, ...], int] = {}
    for passages in TEMPLATES.values():
        for passage in passages:
            for gram in grams_of(words_of(passage)):
                counts.setdefault(gram, len(counts))
    templates = {
        n: [set(grams_of(words_of(p), min(3, len(words_of(p))), min(3, len(words_of(p))))) for p in TEMPLATES[n]]
        for n in TEMPLATES
    }
    model = Classifier(names, counts, np.zeros((len(counts) + 2, len(names))), 1.0, templates)

    def dense(rows):
        x = np.zeros((len(rows), len(counts) + 2), np.float32)
        for k, (words, _) in enumerate(rows):
            found, scale, strange = model._row(words)
            x[k, found], x[k, -2], x[k, -1] = scale, strange, 1.0
        return x, np.array([number for _, number in rows])

    x, y = dense(examples)
    wanted = np.eye(len(names), dtype=np.float32)[y]
    mass = (1.0 / np.bincount(y, minlength=len(names)))[y]
    mass = (mass / mass.sum())[:, None]
    weights = np.zeros((x.shape[1], len(names)), np.float32)
    look, rate = weights, 8.0
    for t in range(1, rounds + 1):  # accelerated proximal gradient
        z = x @ look
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        step = look - rate * (x.T @ (mass * (p - wanted)))
        new = np.sign(step) * np.maximum(np.abs(step) - rate * sparsity, 0)
        new[-2:] = step[-2:]  # the shares and the constant are not thinned out
        look = new + (t - 1) / (t + 2) * (new - weights)
        weights = new
    model.weights = weights.astype(np.float64)
    x, y = dense(_examples(background[1::2], 2))
    z = x @ weights

    def loss(temperature: float) -> float:
        s = z / temperature
        s = s - s.max(axis=1, keepdims=True)
        return float(-(s[np.arange(len(y)), y] - np.log(np.exp(s).sum(axis=1))).mean())

    model.temperature = min((float(v) for v in np.geomspace(0.2, 5, 60)), key=loss)
    leaning = np.abs(model.weights[:-2]).sum(axis=1) > 0
    common: dict[str, int] = {}
    for paragraph in background:
        for word in set(words_of(paragraph)):
            common[word] = common.get(word, 0) + 1
    model.anchors = frozenset(
        w for g, k in counts.items() if leaning[k] for w in g
        if common.get(w, 0) <= ANCHOR_SHARE * max(1, len(background))
    )
    return model


def train(docs: DataFrame, text_col: str = "text", rows: int = BACKGROUND_ROWS) -> Classifier:
    """Fit with one paragraph each of ``rows`` documents: a bounded sample of whatever the corpus holds,
    licences left out by their own words. Documents are chosen by hash of their text, and of each its
    paragraph with the lowest hash, from the whole text; longer lines are taken in pieces of 4000 characters."""
    pieces = F.regexp_extract_all(F.col(text_col), F.lit("[^\n]{1,4000}"), F.lit(0))
    plain = F.filter(pieces, lambda p: ~F.lower(p).rlike("licen[sc]e|copyright|rights reserved|spdx"))
    chosen_one = F.array_min(F.transform(plain, lambda p: F.struct(F.xxhash64(p).alias("k"), p.alias("line"))))
    lines = docs.select(chosen_one["line"].alias("line"), F.xxhash64(text_col).alias("h")).where("line IS NOT NULL")
    # Hashes alone are ranked first, so tasks send no texts that are not chosen; equal texts count once.
    cut = lines.select("h").distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    chosen = lines.where(F.col("h") <= F.lit(cut if cut is not None else 0))
    sample = chosen.groupBy("h").agg(F.min("line").alias("line")).orderBy("h")
    return fit([r.line for r in sample.collect()])


# --- the operator ------------------------------------------------------------------------------


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """Code point spans [start, end): each line with a character that counts, and each run of two or
    more short lines joined, a long run in pieces of ``WRAP_LINES`` lines that overlap by half."""
    at, run, fresh = 0, [], 0
    for line in text.split("\n"):
        end = at + len(line)
        short = bool(line.strip()) and len(line) <= WRAP_CHARS
        if line.strip():
            yield at, end
        if short:
            run.append((at, end))
            fresh += 1
        if fresh and len(run) > 1 and (not short or len(run) == WRAP_LINES):
            yield run[0][0], run[-1][1]
            fresh = 0
        if not short:
            run, fresh = [], 0
        elif len(run) == WRAP_LINES:
            run = run[WRAP_LINES // 2 :]
        at = end + 1
    if fresh and len(run) > 1:
        yield run[0][0], run[-1][1]


_FOUND = pa.struct([
    ("n_paragraphs", pa.int64()),
    ("found", pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()),
        ("confirmed", pa.bool_()),
    ]))),
])


def scan(text: Column, model: Classifier) -> Column:
    """Struct of the number of paragraphs and those of a licence family, with spans in code points."""

    def scanned(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            text, count, found = text.as_py() or "", 0, []
            plain = model.anchors.isdisjoint(words_of(text))
            for start, end in paragraphs(text):
                count += 1
                if plain:
                    continue
                if judged := model.judge(text[start:end]):
                    found.append({"start": start, "end": end, "family": judged[0],
                                  "probability": judged[1], "confirmed": judged[2]})
            out.append({"n_paragraphs": count, "found": found})
        return pa.array(out, _FOUND)

    return F.arrow_udf(
        scanned,
        "struct<n_paragraphs:long,found:array<struct<start:long,end:long,family:string,probability:double,confirmed:boolean>>>",
    )(text)


def scan_licences(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row per document (doc_id, text; others are not read): doc_id, n_paragraphs, families (of
    confirmed paragraphs, sorted), unconfirmed (families predicted only), found (all with spans).

    Null and empty texts have no paragraphs; repeated rows are judged alike.
    """
    confirmed = F.filter("s.found", lambda f: f["confirmed"])
    doubtful = F.filter("s.found", lambda f: ~f["confirmed"])
    names = lambda part: F.array_sort(F.array_distinct(F.transform(part, lambda f: f["family"])))
    return docs.select("doc_id", scan(F.col("text"), model).alias("s")).select(
        "doc_id", F.col("s.n_paragraphs").alias("n_paragraphs"), names(confirmed).alias("families"),
        names(doubtful).alias("unconfirmed"), F.col("s.found").alias("found"),
    )
