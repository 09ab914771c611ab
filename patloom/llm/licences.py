"""Licence notices in documents.

Notices are looked for in the word stream of a whole text, across lines and without words that are punctuation only
(comment marks). A look at a bitmap leaves the three-word runs that licence notices have; a text in which no notice
has enough of its runs is out. In the others, a place is a window of at most `REACH` words that holds enough of a notice's runs.
A softmax regression over word n-grams (one to three words) that licence notices have names its family, or
unknown. It is trained here: on the notices below, with words left out and among words of the corpus, against
paragraphs of a bounded sample of documents; a part that was held back sets its temperature, so that probabilities,
that of unknown too, mean what they say. The place must hold enough of a notice of that family, and of those of its runs that tell it from
other families.

A paragraph is a line, cut into runs of at most `WORDS` words; it only says where in its text a notice stands.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patloom.llm.registry import query, table
from patloom.llm.words import Powers, Words, byte_values, filled, gram_hashes, slices, words_of

WORDS = 48
REACH = 2 * WORDS  # words of the widest place of a notice; the longest notice has 46
GRAMS = (1, 2, 3)
SAMPLE_DOCS = 200  # documents for the unknown class
SAMPLE_BYTES = 20_000  # longest document of the sample
SAMPLE_PARAGRAPHS = 4000  # of these documents, for the unknown class
FILLER = (500, 40)  # lines of the sample, and words of each, that stand around notices in training
VARIANTS = 12  # training paragraphs made of each notice
STEPS = 150
PROBABLE = 0.5
CONFIRMED = 0.6  # share of a notice's three-word runs
OWN = 0.5  # share of those of its runs that no other family's notice has

# ---- Fixed values: notices of public licences ---------------------------------------------
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Licensed under MIT.",
        "available under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Distributed under the GNU General Public License v2.0 or later.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
}
# -------------------------------------------------------------------------------------------

UNKNOWN = "unknown"
FAMILIES = (*NOTICES, UNKNOWN)


@dataclass
class Paragraphs:
    """Paragraphs of the texts of a slice: owner text, number in it, words; and their features (paragraph, hash)."""

    text: np.ndarray
    number: np.ndarray
    words: np.ndarray
    at: dict[int, tuple[np.ndarray, np.ndarray]]  # by n-gram size


def blocks(words: Words) -> np.ndarray:
    """The first word of each paragraph."""
    n = len(words.hashes)
    lines = np.concatenate([[0], np.cumsum(words.data == 10)])
    new = np.ones(n, bool)
    new[1:] = lines[words.starts[1:]] > lines[words.ends[: n - 1]] if n else False
    new[words.first[:-1][np.diff(words.first) > 0]] = True
    begins = np.flatnonzero(new)
    within = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
    return np.flatnonzero(within % WORDS == 0)


def paragraphs(texts: pa.Array, values: np.ndarray, powers: Powers) -> Paragraphs:
    words = words_of(texts, values, powers)
    starts = blocks(words)
    size = np.diff(np.append(starts, len(words.hashes)))
    text = np.searchsorted(words.first, starts, "right") - 1
    first_of = np.searchsorted(text, np.arange(len(texts)))
    owner = np.repeat(np.arange(len(starts)), size)
    at = {}
    for k in GRAMS:
        grams = gram_hashes(words.hashes, k) ^ np.uint64(k)
        same = owner[: len(grams)] == owner[k - 1 :][: len(grams)]
        at[k] = owner[: len(grams)][same], grams[same]
    return Paragraphs(text, np.arange(len(starts)) - first_of[text], size, at)


@dataclass
class Model:
    """Sorted n-gram hashes, weights per family, and the three-word runs of every notice."""

    grams: np.ndarray
    weights: np.ndarray  # (n-grams + 1, families); the last row is the intercept
    notices: list[tuple[int, str, np.ndarray]]  # family, notice, three-word runs

    def features(self, found: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (paragraph, n-gram number) pairs."""
        slots = np.zeros(1 << 16, bool)
        slots[(self.grams >> np.uint64(48)).astype(np.int64)] = True
        parts = []
        for owner, grams in found.at.values():
            some = slots[(grams >> np.uint64(48)).astype(np.int64)]
            owner, grams = owner[some], grams[some]
            place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            hit = self.grams[place] == grams
            parts.append(owner[hit].astype(np.int64) * len(self.grams) + place[hit])
        pairs = np.unique(np.concatenate(parts))
        return pairs // len(self.grams), pairs % len(self.grams)

    def logits(self, hashes: np.ndarray) -> np.ndarray:
        """By family, for a place with these word hashes."""
        grams = np.unique(np.concatenate([gram_hashes(hashes, k) ^ np.uint64(k) for k in GRAMS]))
        there = self.weights[:-1][np.isin(self.grams, grams)]
        return there.sum(axis=0) / np.sqrt(len(hashes)) + self.weights[-1]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[str], seed: int = 0) -> Model:
    """The model, from the notices and a bounded list of sample texts of the corpus."""
    values, powers, rng = byte_values(), Powers(), np.random.default_rng(seed)
    notices = [(i, text) for i, family in enumerate(NOTICES) for text in NOTICES[family]]
    told = paragraphs(pa.array([text for _, text in notices]), values, powers)
    grams = np.unique(np.concatenate([grams for _, grams in told.at.values()]))
    owners, runs = told.at[3]
    of_notice = told.text[owners]
    kept = [(family, text[:60], np.unique(runs[of_notice == i])) for i, (family, text) in enumerate(notices)]
    model = Model(grams, np.zeros((len(grams) + 1, len(FAMILIES))), kept)

    lines = [line for text in samples for line in text.split("\n") if line.strip()]
    other = paragraphs(pa.array(lines, pa.string()), values, powers)
    licensed = np.unique(other.at[3][0][np.isin(other.at[3][1], runs)])
    filler = [word for line in lines[: FILLER[0]] for word in line.split()[: FILLER[1]]] or ["text"]
    texts, labels = [], []
    for family, text in notices:
        for variant in range(VARIANTS):
            words = [word for word in text.split() if variant < 2 or rng.random() > 0.08]
            around = [filler[i] for i in rng.integers(len(filler), size=int(rng.integers(0, 5 * variant + 1)))]
            cut = int(rng.integers(0, len(around) + 1))
            room = max(0, WORDS - len(words))
            texts.append(" ".join([*(around[:cut][-room:] if room else []), *words, *around[cut:]]))
            labels.append(family)
    made = paragraphs(pa.array(texts), values, powers)
    clean = ~np.isin(np.arange(len(other.words)), licensed)
    parts = []
    for found, of in ((made, np.array(labels)[made.text]), (other, np.full(len(other.words), len(FAMILIES) - 1))):
        owner, gram = model.features(found)
        parts.append((found, of, owner, gram))
    rows = []
    for found, of, owner, gram in parts:
        for p in np.unique(owner):
            if found is other and not clean[p]:
                continue
            if found is made and (owner == p).sum() < 4:  # the rest of a cut notice
                continue
            rows.append((gram[owner == p], found.words[p], of[p]))
            if found is other and len(rows) > SAMPLE_PARAGRAPHS:
                break
    rows.append((np.zeros(0, np.int64), 1, len(FAMILIES) - 1))
    x = np.zeros((len(rows), len(grams) + 1), np.float32)
    for i, (gram, words, _) in enumerate(rows):
        x[i, gram] = 1 / np.sqrt(words)
    x[:, -1] = 1
    y = np.eye(len(FAMILIES), dtype=np.float32)[[label for _, _, label in rows]]
    weight = (1 / np.maximum(y.sum(axis=0), 1))[y.argmax(axis=1)]
    held = np.arange(len(rows)) % 5 == 0
    model.weights = _fit(x[~held], y[~held], weight[~held])
    logits = x[held] @ model.weights
    loss = lambda t: -(weight[held] * np.log((_softmax(logits * t) * y[held]).sum(axis=1) + 1e-12)).sum()
    model.weights *= min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    return model


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float = 0.1, decay: float = 1e-5) -> np.ndarray:
    """Softmax regression by gradient steps of adapted size."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = (weight / weight.sum())[:, None].astype(np.float32)
    for step in range(1, STEPS + 1):
        slope = x.T @ (weight * (_softmax(x @ w) - y)) + decay * w
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w.astype(np.float64)


RESULT = "paragraph int, n_words int, family string, notice string, probability double, matched double"


class Scanner:
    """Looks for places of notices in the word streams of texts."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.runs = np.unique(np.concatenate([own for _, _, own in model.notices]))
        self.has = np.array([np.isin(self.runs, own) for _, _, own in model.notices]).T  # (runs, notices)
        self.size = self.has.sum(axis=0)
        self.least = np.ceil(CONFIRMED * self.size - 1e-9).astype(int)
        family = np.array([of for of, _, _ in model.notices])
        others = np.array([self.has[:, family != of].any(axis=1) for of in family]).T
        self.own = self.has & ~others  # what tells a notice from those of other families
        self.slots = np.zeros(1 << 16, bool)
        self.slots[(self.runs >> np.uint64(48)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Text, places and numbers of known runs, for each text that has enough of the runs of some notice."""
        runs = gram_hashes(hashes, 3) ^ np.uint64(3)
        at = np.flatnonzero(self.slots[(runs >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.runs, runs[at]), len(self.runs) - 1)
        known = self.runs[place] == runs[at]
        at, place = at[known], place[known]
        text = np.searchsorted(first, at, "right") - 1
        whole = at + 3 <= first[text + 1]
        at, place, text = at[whole], place[whole], text[whole]
        for a, b in zip(begins := np.flatnonzero(np.diff(text, prepend=-1)), np.append(begins[1:], len(text))):
            if (self.has[np.unique(place[a:b])].sum(axis=0) >= self.least).any():
                yield int(text[a]), at[a:b], place[a:b]

    def window(self, at: list[int], run: list[int], i: int, end: int) -> tuple[int, int]:
        """Distinct runs and end of the shortest window of most runs that begins with hit i and ends by `end`."""
        seen, stop = set(), 0
        for j in range(i, len(at)):
            if at[j] + 3 > end:
                break
            if run[j] not in seen:
                seen.add(run[j])
                stop = at[j] + 3
        return len(seen), stop

    def named(self, hashes: np.ndarray, there: np.ndarray) -> tuple[int, int, float, float] | None:
        """(family, notice, probability, share) of a place with these words and known runs; None for no licence.

        The classifier names a family and a notice of it has to be there. Where the runs that tell this notice from those of other
        families are missing, the family is out, and the classifier chooses among the rest.
        """
        logits, shares = self.model.logits(hashes), self.has[there].sum(axis=0) / self.size
        while True:
            chances = _softmax(logits[None])[0]
            family = int(chances.argmax())
            if family == len(NOTICES) or chances[family] < PROBABLE:
                return None
            share, best = max((shares[k], -k) for k, (of, _, _) in enumerate(self.model.notices) if of == family)
            if share < CONFIRMED:
                return None
            own = self.own[:, -best]
            if own[there].sum() >= OWN * own.sum():
                return family, -best, float(chances[family]), float(share)
            logits[family] = -np.inf

    def places(self, hashes: np.ndarray, at: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, int, int, float, float]]:
        """(first word, end, family, notice, probability, share) of one text: apart from each other, those of most runs first."""
        own = {}
        heap: list[tuple[int, int, int, int, int]] = []
        taken = np.zeros(int(at[-1] - at[0]) + 3, bool)
        base = int(at[0])

        def offer(notice: int, i: int) -> None:
            starts, runs = own[notice]
            begin = starts[i] - base
            busy = taken[begin : begin + REACH]
            n, stop = self.window(starts, runs, i, starts[i] + (int(busy.argmax()) if busy.any() else REACH))
            if n >= self.least[notice]:
                heapq.heappush(heap, (-n, stop - starts[i], starts[i], notice, i))

        for notice in np.flatnonzero(self.has[np.unique(place)].sum(axis=0) >= self.least).tolist():
            of = self.has[place, notice]
            own[notice] = at[of].tolist(), place[of].tolist()
            for i in range(len(own[notice][0])):
                offer(notice, i)
        while heap:
            _, length, begin, notice, i = heapq.heappop(heap)
            if taken[begin - base : begin - base + length].any():
                if not taken[begin - base]:
                    offer(notice, i)
                continue
            a, b = np.searchsorted(at, [begin, begin + length - 2])
            there = np.unique(place[a:b])
            named = self.named(hashes[begin : begin + length], there)
            if named is None:
                continue
            family, best, chance, share = named
            of = np.flatnonzero(self.has[place[a:b], best]) + a
            starts, runs = at[of].tolist(), place[of].tolist()
            # Of all windows with these runs, the shortest.
            found = [(-n, stop - starts[k], starts[k]) for k in range(len(of)) for n, stop in [self.window(starts, runs, k, begin + length)]]
            _, length, begin = min(found)
            taken[begin - base : begin - base + length] = True
            yield begin, begin + length, family, best, chance, share


PUNCTUATION = bytes(x for x in range(33, 127) if not chr(x).isalnum())


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, powers, model = byte_values(), Powers(), Model(*shared.value)
        scanner = Scanner(model)
        telling = np.ones(256, bool)
        telling[list(PUNCTUATION)] = False
        for batch in batches:
            texts = filled(batch.column(1))
            for begin, end in slices(texts):
                words = words_of(texts.slice(begin, end - begin), values, powers)
                told = np.concatenate([[0], np.cumsum(telling[words.data])])
                kept = np.flatnonzero(told[words.ends] > told[words.starts])
                hashes, first = words.hashes[kept], np.searchsorted(kept, words.first)
                starts, out = None, []
                for text, at, place in scanner.hits(hashes, first):
                    starts = blocks(words) if starts is None else starts
                    edges = np.append(starts, len(words.hashes))
                    top = int(np.searchsorted(starts, words.first[text]))
                    for a, b, family, notice, chance, share in sorted(scanner.places(hashes, at, place)):
                        one, last = np.searchsorted(starts, kept[[a, b - 1]], "right") - 1
                        out.append((text, one - top, edges[last + 1] - edges[one], FAMILIES[family], model.notices[notice][1], chance, share))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.array([x[0] for x in out], np.int64) + begin)),
                        *(pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64()), 1)),
                    ],
                    ["doc_id", *(part.split()[0] for part in RESULT.split(", "))],
                )

    return run


def sample_texts(docs: DataFrame, key: str, text: str, most: int = SAMPLE_DOCS) -> list[str]:
    """Texts of at most `most` documents, none longer than `SAMPLE_BYTES`, the same ones each time.

    Those of least hash. Only rows below a bound on the hash that a few times as many have can be among them, so
    tasks send next to nothing, however many there are.
    """
    some = docs.filter(F.octet_length(text).between(1, SAMPLE_BYTES)).select(F.col(text).alias("text"), F.xxhash64(key, text).alias("at"))
    share = min(1.0, 4 * most / max(1, some.count()))
    below = some.filter(F.col("at") <= int(-(2**63) + share * (2**64 - 1) - 1) if share < 1 else F.lit(True))
    return [row["text"] for row in below.orderBy("at").limit(most).collect()]


def licence_notices(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, paragraph, n_words, family, notice, probability, matched): places that hold a licence notice.

    `paragraph` is that in which the notice begins, numbered from 0 in each text; `n_words` are the words of all
    paragraphs that it touches. Every whole text is looked at, across its lines; null and
    empty texts have none. Places of one text do not overlap. Repeated rows are looked at each on its own, rows without an id too. A table without usable
    texts trains against no sample.
    """
    model = train(sample_texts(docs, key, text))
    shared = docs.sparkSession.sparkContext.broadcast((model.grams, model.weights, model.notices))  # sized by the notices
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(_scan(shared), f"doc_id {dict(given.dtypes)['doc_id']}, {RESULT}").withColumnRenamed("doc_id", key)


@query("op8_licences")
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All licence notices in all documents."""
    return licence_notices(table(spark, sf_dir, "documents"))
