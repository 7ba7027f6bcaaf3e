"""Licence scans by a trained paragraph classifier (operator 5).

Every paragraph (line) of every document is scored by a multinomial logistic
regression over hashed word one- and two-grams, whose classes are the licence
families of ``TEMPLATES`` and ``none``. It is trained here: on paragraphs made
from the templates (words dropped, cut and embedded in other words), and on at
most ``NEGATIVES`` distinct paragraphs of the corpus of up to ``SAMPLE_CHARS``
characters, those with the smallest hash; this bound is the only thing that does
not cover all data. Probabilities are scaled by a temperature fitted on paragraphs
that were kept back. A paragraph is licence-like if a family is more probable than
``none`` and it shares a word pair with a notice. A prediction is named if two tests pass, and ``unknown``
otherwise: the family's templates confirm it (shared word pairs, at least one of
them a pair that no other family and none of ``NEIGHBOURS``, notices of other
licences, has, and no neighbour nearer), and the share of the best family among the
families reaches a level. The level is calibrated by leaving out one house of families at a time:
at most ``UNKNOWN_RISK`` of the paragraphs of families that the model never
saw pass both tests.

Scoring is a map over documents in numpy: no shuffle, a task holds the weights
(a table of fixed size) and some megabytes of text.

Defined cases: a null text is empty and has no paragraphs; paragraphs are lines
with a letter or digit; very long lines are one paragraph; repeated rows and
repeated or null ids are scored each by itself; an empty table gives an empty
result, and a model trained without corpus paragraphs; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .minhash import _STEP, hashed_runs, mix, text_ranges
from .storage import ship_package

#: fixed values: common notices of each family
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This software is confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "Copyright 2020 The Company. All rights reserved.",
    ],
}
#: fixed values: notices of licences that are none of the families
NEIGHBOURS = [
    "Released under the Unlicense.",
    "Licensed under the GNU Lesser General Public License.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "You should have received a copy of the GNU Lesser General Public License along with this program.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Licensed under the Eclipse Public License, Version 2.0.",
    "This work is licensed under the European Union Public License, version 1.2.",
    "Distributed under the Boost Software License, Version 1.0.",
    "This project is licensed under the terms of the ISC license.",
    "Use of this source code is governed by a license that can be found in the LICENSE file.",
]
#: fixed values: sentences with words of licences that grant nothing
TALK = [
    "You need a driving licence to rent a car in this country.",
    "The permission of the owner is needed before you enter the garden.",
    "The public library has a copy of the general catalogue.",
    "A free copy of the version for children was distributed at the school.",
    "The apache people lived in the south of the region.",
    "He studied at MIT and published software for work under water.",
    "All rights and duties of members are listed in the second part.",
    "The commons of the village are open to the public.",
]

#: families of one house share their wording, and are left out together
HOUSES = {"cc-by": "cc", "cc-by-nc": "cc", "cc0": "cc"}
NONE = "none"
BITS = 15
NEGATIVES = 3000
#: characters up to which a corpus paragraph may enter the training sample
SAMPLE_CHARS = 2000
VARIANTS = 80
UNKNOWN_RISK = 0.1
CONFIRMED = 0.6
SEED = 11

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One- and two-grams of all paragraphs that have any.

    Returns text and line of each paragraph, number and hashes of its grams (all
    words, then all pairs of neighbours), and the number of words.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin, words = hashed_runs(data, _SEPARATOR)
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, begin)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    lines = line[first]
    count = np.diff(np.append(first, len(words)))
    pair = mix(words[:-1] * _STEP + words[1:]) if len(words) else words
    inside = np.ones(len(words), bool)
    inside[first + count - 1] = False
    size = np.maximum(2 * count - 1, 0)
    start = np.cumsum(size) - size
    grams = np.empty(int(size.sum()), np.uint64)
    rank = np.arange(len(words)) - np.repeat(first, count)
    own = np.repeat(start, count) + rank
    grams[own] = words
    at = np.flatnonzero(inside)
    grams[(own + np.repeat(count, count))[at]] = pair[at]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    text = np.searchsorted(ends, breaks[lines], "left") if len(lines) else lines
    first_line = np.searchsorted(breaks, np.concatenate(([0], ends[:-1])) if len(ends) else ends)
    return text, lines - first_line[text] if len(lines) else lines, size, grams, count


def buckets(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def _logits(weights: np.ndarray, bias: np.ndarray, size: np.ndarray, grams: np.ndarray) -> np.ndarray:
    if not len(size):
        return np.empty((0, len(bias)))
    total = np.add.reduceat(weights[buckets(grams)], np.cumsum(size) - size)
    return total / np.sqrt(size)[:, None] + bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(size: np.ndarray, grams: np.ndarray, label: np.ndarray, classes: int, rounds: int = 120,
        rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by gradient descent with adapted steps (AdaGrad)."""
    used, column = np.unique(buckets(grams), return_inverse=True)
    row = np.repeat(np.arange(len(size)), size)
    order = np.argsort(column, kind="stable")
    first = np.flatnonzero(np.diff(column[order], prepend=-1))
    scale = 1 / np.sqrt(size)
    weights, bias = np.zeros((len(used), classes)), np.zeros(classes)
    seen, seen_bias = np.full_like(weights, 1e-8), np.full(classes, 1e-8)
    start = np.cumsum(size) - size
    wanted = np.eye(classes)[label]
    balance = (1 / np.bincount(label, minlength=classes).clip(1))[label][:, None] / classes
    for _ in range(rounds):
        z = np.add.reduceat(weights[column], start) * scale[:, None] + bias
        error = (_softmax(z) - wanted) * balance
        slope = np.add.reduceat((error * scale[:, None])[row[order]], first) + decay * weights
        seen += slope ** 2
        weights -= rate * slope / np.sqrt(seen)
        slope = error.sum(axis=0)
        seen_bias += slope ** 2
        bias -= rate * slope / np.sqrt(seen_bias)
    out = np.zeros((1 << BITS, classes), np.float32)
    out[used] = weights
    return out, bias


def without_evidence_none(bias: np.ndarray, temperature: float) -> np.ndarray:
    """The bias with that of ``none`` raised until a paragraph of unseen words is none."""
    rest = bias[:-1] / temperature
    even = temperature * (rest.max() + np.log(np.exp(rest - rest.max()).sum()))
    return np.append(bias[:-1], max(bias[-1], np.nextafter(even, np.inf) + 1e-9))


def variants(template: str, filler: list[str], rng: np.random.Generator, n: int) -> list[str]:
    """Paragraphs made from a notice: the notice itself, then with words
    dropped, cut at one end, in other letters, or with words around it."""
    out = [template]
    words = template.split()
    while len(out) < n:
        w = [x for x in words if rng.random() > 0.08] or words
        if len(w) > 12 and rng.random() < 0.3:
            cut = int(rng.integers(8, len(w)))
            w = w[:cut] if rng.random() < 0.5 else w[-cut:]
        if rng.random() < 0.3 and filler:
            around = rng.choice(filler).split()
            k = int(rng.integers(1, 6))
            w = around[:k] + w if rng.random() < 0.5 else w + around[:k]
        text = " ".join(w)
        out.append(text.upper() if rng.random() < 0.1 else text.lower() if rng.random() < 0.2 else text)
    return out


def _pairs(notices: list[str]) -> list[np.ndarray]:
    out = []
    for t in notices:
        _, _, _, grams, count = features([t.encode()])
        out.append(np.unique(grams[count[0]:]))
    return out


def _template_pairs() -> list[list[np.ndarray]]:
    return [_pairs(notices) for notices in TEMPLATES.values()]


def telling(pairs: list[list[np.ndarray]], others: list[np.ndarray], without: tuple[int, ...] = ()) -> list[np.ndarray]:
    """The word pairs that only the notices of one family have: no other family
    (but those in ``without``) and no notice in ``others``."""
    own = [np.unique(np.concatenate(sets)) for sets in pairs]
    out = []
    for f, mine in enumerate(own):
        rest = [o for g, o in enumerate(own) if g != f and g not in without] + others
        out.append(np.setdiff1d(mine, np.concatenate(rest)))
    return out


def _containment(templates: list[np.ndarray], pairs: np.ndarray) -> float:
    own, best = np.unique(pairs), 0.0
    for template in templates:
        common = len(np.intersect1d(own, template, assume_unique=True))
        best = max(best, common / max(1, min(len(own), len(template))))
    return best


@dataclass
class Model:
    """A trained scanner; ``families`` are the classes, ``none`` comes last."""

    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    level: float
    pairs: list[list[np.ndarray]]
    others: list[np.ndarray]
    only: list[np.ndarray]

    def __post_init__(self) -> None:
        self.noticed = np.unique(np.concatenate([p for sets in [*self.pairs, self.others] for p in sets]))

    def probabilities(self, size: np.ndarray, grams: np.ndarray) -> np.ndarray:
        return _softmax(_logits(self.weights, self.bias, size, grams) / self.temperature)

    def containment(self, family: int, pairs: np.ndarray) -> float:
        """Largest share of word pairs, of the smaller side, that the paragraph
        shares with a template of the family."""
        return _containment(self.pairs[family], pairs)

    def confirms(self, family: int, pairs: np.ndarray, only: list[np.ndarray] | None = None) -> tuple[bool, float]:
        """Whether the family's templates confirm a paragraph, and its containment:
        the containment reaches ``CONFIRMED`` and that in the other notices, and
        the paragraph has a pair that only this family's notices have."""
        share = self.containment(family, pairs)
        only = self.only if only is None else only
        sure = share >= CONFIRMED and share >= _containment(self.others, pairs) and np.isin(pairs, only[family]).any()
        return bool(sure), share

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int, str, str, float, float]]]:
        """Paragraphs of every text, and of licence-like ones: text, line,
        family (or unknown), predicted family, probability, containment."""
        text, line, size, grams, count = features(texts)
        p = self.probabilities(size, grams)
        start = np.cumsum(size) - size
        out = []
        for k in np.flatnonzero(p[:, :-1].max(axis=1) > p[:, -1]).tolist() if len(size) else []:
            family = int(p[k, :-1].argmax())
            sure = p[k, family] / (1 - p[k, -1]) >= self.level
            own = grams[start[k] + count[k]:start[k] + size[k]]
            if not np.isin(own, self.noticed).any():
                continue
            confirmed, shared = self.confirms(family, own)
            name = self.families[family]
            out.append((int(text[k]), int(line[k]), name if sure and confirmed else "unknown", name, float(p[k, family]), shared))
        return np.bincount(text, minlength=len(texts)), out


def train(negatives: list[str], seed: int = SEED) -> Model:
    """A model from the templates and (unlabelled) paragraphs of the corpus.

    Corpus paragraphs that contain a template's word pairs are not taken as
    negative. A quarter of all paragraphs is kept back for calibration.
    """
    rng = np.random.default_rng(seed)
    families = list(TEMPLATES)
    pairs = _template_pairs()
    others = _pairs(NEIGHBOURS)
    only = telling(pairs, others)
    blank = Model(families, np.empty(0), np.empty(0), 1.0, 0.0, pairs, others, only)

    def clean(text: str) -> bool:
        _, _, size, grams, count = features([text.replace("\n", " ").encode()])
        own = grams[count[0]:]
        return len(size) > 0 and _containment(others, own) < 0.3 and all(blank.containment(f, own) < 0.3 for f in range(len(families)))

    negatives = [t for t in negatives if clean(t)]
    texts, label = [], []
    for f, notices in enumerate(TEMPLATES.values()):
        for t in notices:
            made = variants(t, negatives + TALK, rng, VARIANTS)
            texts += made
            label += [f] * len(made)
    for t in TALK:
        made = variants(t, negatives, rng, VARIANTS // 4)
        texts += made
        label += [len(families)] * len(made)
    texts += negatives
    label += [len(families)] * len(negatives)
    label = np.array(label)
    parts = [features([t.replace("\n", " ").encode()]) for t in texts]
    size = np.array([p[2][0] for p in parts])
    grams = [p[3] for p in parts]
    held = rng.random(len(label)) < 0.25
    of = lambda mask: (size[mask], np.concatenate([grams[i] for i in np.flatnonzero(mask)]))
    none = len(families)
    weights, bias = fit(*of(~held), label[~held], none + 1)
    z = _logits(weights, bias, *of(held))
    grid = np.geomspace(0.2, 5, 25)
    loss = [-np.log(_softmax(z / t)[np.arange(len(z)), label[held]].clip(1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    bias = without_evidence_none(bias, temperature)
    # how sure the model is of paragraphs of a family that it never saw, where the
    # templates confirm its mistake; the others cannot pass for a family
    strange = []
    few = (label < none) | (rng.random(len(label)) < 0.2)
    houses: dict[str, list[int]] = {}
    for f, name in enumerate(families):
        houses.setdefault(HOUSES.get(name, name), []).append(f)
    for left_out in houses.values():
        unseen = np.isin(label, left_out)
        here = np.flatnonzero(held & unseen)
        if not len(here):
            continue
        rest = np.setdiff1d(np.arange(none + 1), left_out)
        keep = few & ~held & ~unseen
        w, b = fit(*of(keep), np.searchsorted(rest, label[keep]), len(rest), rounds=60)
        p = _softmax(_logits(w, without_evidence_none(b, temperature), *of(held & unseen)) / temperature)
        without = telling(pairs, others, tuple(left_out))
        for i, row in zip(here.tolist(), p):
            own = grams[i][(size[i] + 1) // 2:]
            sure = row[:-1].max() > row[-1] and blank.confirms(int(rest[row[:-1].argmax()]), own, without)[0]
            strange.append(row[:-1].max() / (1 - row[-1]) if sure else 0.0)
    level = float(np.quantile(strange, 1 - UNKNOWN_RISK, method="higher")) if strange else 0.5
    return Model(families, weights, bias, temperature, max(0.5, np.nextafter(level, 1)), pairs, others, only)


def corpus_paragraphs(docs: DataFrame, most: int = NEGATIVES, chars: int = SAMPLE_CHARS) -> list[str]:
    """The ``most`` distinct paragraphs of up to ``chars`` characters with the
    smallest hash.

    The number of distinct hashes gives a hash below which there are somewhat more
    than ``most``, so tasks give out that many rows at most; copies are one row per
    task before they meet, so a frequent paragraph counts once.
    """
    rows = docs.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("p")).where(
        F.col("p").rlike("[0-9A-Za-z]") & (F.length("p") <= chars)).select(F.xxhash64("p").alias("h"), "p")
    distinct = rows.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    if distinct > 1.3 * most:
        rows = rows.where(F.col("h") <= int(-2 ** 63 + 1.3 * most / distinct * 2 ** 64))
    best = rows.groupBy("h").agg(F.min("p").alias("p")).orderBy("h").limit(most)
    return [r["p"] for r in best.collect()]


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_paragraphs, hits`` of every document; a hit has the number of
    its line, the family (or ``unknown``), the predicted family, its probability,
    the containment in a template, and the paragraph."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hit = pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("predicted", pa.string()),
                     ("probability", pa.float64()), ("containment", pa.float64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            body = batch.column(1).to_pylist()
            for lo, hi in text_ranges([len(b) for b in body], 1 << 20):
                part = body[lo:hi]
                paragraphs, found = model.hits(part)
                out: list[list] = [[] for _ in part]
                for text, line, family, predicted, p, shared_pairs in found:
                    out[text].append({"paragraph": line, "family": family, "predicted": predicted, "probability": p,
                                      "containment": shared_pairs, "text": part[text].split(b"\n")[line].decode()})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(paragraphs, pa.int64()),
                                                  pa.array(out, pa.list_(hit))], ["doc_id", "n_paragraphs", "hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"))
    return rows.mapInArrow(run, "doc_id long, n_paragraphs long, hits array<struct<paragraph: long, family: string, "
                                "predicted: string, probability: double, containment: double, text: string>>")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, train(corpus_paragraphs(docs)))
    named = F.filter("hits", lambda x: x["family"] != "unknown")
    return found.select(
        "doc_id", "n_paragraphs", F.size(named).cast("long").alias("n_licences"),
        (F.size("hits") - F.size(named)).cast("long").alias("n_unknown"),
        F.array_join(F.sort_array(F.array_distinct(F.transform(named, lambda x: x["family"]))), ",").alias("families"),
        F.array_max(F.transform(named, lambda x: x["probability"])).alias("probability"))
