"""Licence statements in texts: a trained paragraph classifier, confirmed by templates.

A paragraph lies between blank lines; its lines are joined, so a notice may be wrapped anywhere.
Paragraphs go in overlapping windows of words, each a sparse bag of hashed word n-grams, to a
multinomial logistic regression over licence families and one class for text that is no
licence. It is trained in numpy on edited copies of the families' templates and on lines of the
corpus. A temperature fitted on held-back copies calibrates it. What it predicts with too
little confidence, or what shares too little wording with the family's templates, is
``unknown``. Every window that is taken for a licence counts; those of one family that touch
are one statement.

Only windows with a word that licence notices are known by are classified: of the templates
all have one, and a statement without any is not found.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.sampling import smallest_hashes

NONE, UNKNOWN = "none", "unknown"
NGRAMS = (1, 2, 3)
BUCKETS = 1 << 14
WINDOW, STRIDE = 40, 20  # words
COPIES = 60  # edited copies of each template
MOST_LINES = 4_000  # corpus lines that train the class of other text
MIN_PROBABILITY = 0.5
SURE = 0.8  # both, for parts of windows
MIN_SHARED = 0.5  # of the template's or the window's word pairs

# The wording of common licence notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License as published by the Free Software Foundation, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}
# words that make a window a candidate; a statement without any of them is not looked for
CUES = re.compile(
    r"licen[sc]|copyright|spdx|public domain|creative commons|\bcc[ -]by|\bcc0\b|all rights reserved|"
    r"permission is hereby|redistribution|free software|warrant(?:y|ies)|proprietary|\bgnu\b",
    re.I,
)
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def _pairs(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:])) or {tuple(words)}


def _grams(words: list[str]) -> np.ndarray:
    found = {" ".join(words[i : i + n]) for n in NGRAMS for i in range(len(words) - n + 1)}
    return np.fromiter((xxhash.xxh3_64_intdigest(g.encode()) % BUCKETS for g in sorted(found)), np.int64, len(found))


def _bags(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and weights of unit-length n-gram bags."""
    grams = [_grams(t) for t in texts]
    sizes = np.array([len(g) for g in grams])
    rows = np.repeat(np.arange(len(grams)), sizes)
    weights = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    return rows, np.concatenate(grams) if grams else np.zeros(0, np.int64), weights


def _scores(bags, n: int, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    rows, columns, values = bags
    out = np.zeros((n, len(bias)))
    for k in range(len(bias)):
        out[:, k] = np.bincount(rows, values * weights[columns, k], n)
    return out + bias


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class LicenseModel:
    families: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, windows: list[list[str]]) -> np.ndarray:
        return _softmax(_scores(_bags(windows), len(windows), self.weights, self.bias) / self.temperature)


def _edited(words: list[str], filler: list[str], rng) -> list[str]:
    """A copy with words left out, replaced and put around it, as texts have them."""
    kept = [w for w in words if rng.random() > 0.08] or words
    kept = [filler[rng.integers(len(filler))] if rng.random() < 0.05 else w for w in kept]
    before, after = (
        [filler[rng.integers(len(filler))] for _ in range(rng.integers(0, 13))] if rng.random() < 0.6 else []
        for _ in range(2)
    )
    return (before + kept + after)[:WINDOW]


def fit_licenses(lines: list[str], rounds: int = 300, rate: float = 2.0, decay: float = 1e-5, seed: int = 7) -> LicenseModel:
    """Train on edited templates and on ``lines`` of the corpus, which are no licences."""
    rng = np.random.default_rng(seed)
    families = (*TEMPLATES, NONE)
    others = [w for w in (words_of(line) for line in lines) if w] or [["text"]]
    filler = sorted({w for line in others for w in line})
    texts, labels = [], []
    for k, templates in enumerate(TEMPLATES.values()):
        for template in templates:
            words = words_of(template)
            texts += [words] + [_edited(words, filler, rng) for _ in range(COPIES)]
            labels += [k] * (COPIES + 1)
    # text that is no licence, whole and with single words of licences put in
    vocabulary = sorted({w for t in TEMPLATES.values() for x in t for w in words_of(x)})
    for words in others:
        window = words[:WINDOW]
        texts.append(window)
        extra = [vocabulary[rng.integers(len(vocabulary))] for _ in range(rng.integers(1, 4))]
        texts.append([*window[: WINDOW - len(extra)], *extra])
        labels += [len(TEMPLATES)] * 2
    labels = np.array(labels)
    order = rng.permutation(len(texts))
    held = np.zeros(len(texts), bool)
    held[order[::5]] = True
    bags = _bags(texts)
    # families have far fewer texts than the rest of the corpus: equal weight to each class
    share = (~held) / np.bincount(labels[~held], minlength=len(families))[labels] / len(families)
    weights, bias = np.zeros((BUCKETS, len(families))), np.zeros(len(families))
    target = np.eye(len(families))[labels]
    speed = [np.zeros_like(weights), np.zeros_like(bias)]
    rows, columns, values = bags
    for _ in range(rounds):
        miss = (_softmax(_scores(bags, len(texts), weights, bias)) - target) * share[:, None]
        slope = np.stack(
            [np.bincount(columns, values * miss[rows, k], BUCKETS) for k in range(len(families))], axis=1
        )
        speed[0] = 0.9 * speed[0] - rate * (slope + decay * weights)
        speed[1] = 0.9 * speed[1] - rate * miss.sum(axis=0)
        weights += speed[0]
        bias += speed[1]
    scores = _scores(bags, len(texts), weights, bias)[held]
    picked = np.arange(len(scores)), labels[held]
    losses = {t: -np.log(_softmax(scores / t)[picked] + 1e-12).mean() for t in np.geomspace(0.2, 5, 41)}
    return LicenseModel(families, weights, bias, float(min(losses, key=losses.get)))


def paragraphs(text: str) -> list[tuple[int, str]]:
    """(first line, text) of the parts between blank lines, lines joined by spaces."""
    found, lines, first = [], [], 0
    for at, line in enumerate(text.split("\n")):
        if line.strip():
            first = first if lines else at
            lines.append(line)
        elif lines:
            found.append((first, " ".join(lines)))
            lines = []
    return [*found, (first, " ".join(lines))] if lines else found


def cued_windows(paragraph: str) -> list[tuple[int, list[str]]]:
    """(first word, words) of the paragraph's windows that have a cue."""
    cues = [m.span() for m in CUES.finditer(paragraph)]
    if not cues:
        return []
    spans = [m.span() for m in WORD.finditer(paragraph)]
    found = []
    for i in range(0, max(1, len(spans) - STRIDE), STRIDE):
        window = spans[i : i + WINDOW]
        if window and any(a < window[-1][1] and b > window[0][0] for a, b in cues):
            found.append((i, [paragraph[a:b].lower() for a, b in window]))
    return found


def scan_licenses(
    docs: DataFrame, min_probability: float = MIN_PROBABILITY, min_shared: float = MIN_SHARED, most: int = MOST_LINES
) -> DataFrame:
    """(doc_id, line, word, words, family, predicted, probability, shared, confirmed) of every
    statement of ``docs(doc_id, text)`` that the classifier takes for a licence's.

    ``line``, from 0, is the first of the statement's paragraph, ``word`` and ``words`` tell
    where in the paragraph's words it lies. ``predicted`` is its likeliest family, ``shared``
    the share of word pairs in common with the family's nearest template; both and the
    probability are those of its best window. ``family`` is ``predicted`` where probability and
    shared wording are enough, else ``unknown``. Null and empty texts have no statements; a
    document given twice is returned twice; rows without doc_id are scanned too; an empty table
    gives none.
    """
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split("text", "\n")).alias("body"))
    # bounded by ``most``: lines of the corpus, those of smallest hash, of them those without a cue
    sample = smallest_hashes(lines.where("body rlike '[^ ]'"), ["body"], most).collect()
    model = fit_licenses([r.body for r in sample if not CUES.search(r.body)])
    shared_model = spark.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        m = LicenseModel(*shared_model.value)
        pairs = {f: [_pairs(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}
        kinds = {
            "doc_id": pa.int64(), "line": pa.int32(), "word": pa.int32(), "words": pa.int32(), "family": pa.string(),
            "predicted": pa.string(), "probability": pa.float64(), "shared": pa.float64(), "confirmed": pa.bool_(),
        }
        for batch in batches:
            out = {k: [] for k in kinds}
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                for line, paragraph in paragraphs(text):
                    for found in _statements(cued_windows(paragraph), m, pairs):
                        word, words, family, probability, common = found
                        sure = probability >= min_probability and common >= min_shared
                        row = (doc_id.as_py(), line, word, words, family if sure else UNKNOWN, family, probability, common, sure)
                        for name, value in zip(kinds, row):
                            out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in kinds.items()], list(kinds))

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, line int, word int, words int, family string, predicted string, probability double, "
        "shared double, confirmed boolean",
    )


def _statements(windows, m: LicenseModel, pairs) -> list[tuple[int, int, str, float, float]]:
    """(first word, words, family, probability, shared) of runs of touching windows of one family.

    A window may hold notices of several families: where it is a licence's, its parts of half and
    a quarter of the length are classified as well, and count if they are sure of their family.
    """
    none = len(m.families) - 1

    def licences(some, least: float):
        found = []
        for start in range(0, len(some), 256):
            part = some[start : start + 256]
            for (at, words), p in zip(part, m.predict([w for _, w in part])):
                k = int(p[:none].argmax())
                if p.argmax() != none and p[k] >= least:
                    own = _pairs(words)
                    shared = max(len(own & t) / min(len(own), len(t)) for t in pairs[m.families[k]])
                    found.append((at, len(words), m.families[k], float(p[k]), shared))
        return found

    whole = licences(windows, 0.0)
    texts = dict(windows)
    smaller = {
        (at + i, size): texts[at][i : i + size]
        for at, n, *_ in whole for size in (WINDOW // 2, WINDOW // 4) for i in range(0, max(1, n - size // 2), size // 2)
    }
    sure = [f for f in licences([(at, w) for (at, _), w in smaller.items()], SURE) if f[4] >= SURE]
    runs: dict[str, list] = {}
    for new in sorted(whole + sure):
        at, n, family, p, shared = new
        own = runs.setdefault(family, [])
        if own and at <= own[-1][0] + own[-1][1]:
            first, length, _, before_p, before_shared = own[-1]
            best = max((before_shared, before_p), (shared, p))
            own[-1] = (first, max(length, at + n - first), family, best[1], best[0])
        else:
            own.append(new)
    return sorted(f for own in runs.values() for f in own)
