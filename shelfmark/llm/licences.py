"""Licence scans: a trained paragraph classifier names the family, a template comparison confirms it."""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# bound of the labelled sample: paragraphs of the corpus, by the smallest hashes, and variants of each template
SAMPLED_PARAGRAPHS = 1500
# longer lines are not sampled, though they are scanned
SAMPLED_CHARS = 4000
VARIANTS = 24
SEED = 11
MAX_NGRAM = 3
# n-grams in fewer labelled rows are no features: it bounds the model that tasks hold
MIN_FEATURE_ROWS = 6
# units of text: lines, and neighbouring lines joined; longer ones in windows that overlap by half
UNIT_WORDS = 80
# share of a template's word trigrams that confirms a prediction
MIN_SIMILARITY = 0.5
# held-out predictions above the confidence threshold are right at least this often
PRECISION = 0.995

NONE, UNKNOWN = "none", "unknown"

# Notices of licence families as they are commonly written.
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
    ],
}
# Notices of licences that share most of their words with a family above, and are none of it.
NEIGHBOURS = [
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    "You should have received a copy of the GNU Affero General Public License along with this program.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under CC BY-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "Licensed under CC BY-NC-SA 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "Licensed under CC BY-NC-ND 4.0.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "Licensed under the Eclipse Public License, version 2.0.",
    "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Released under the ISC License.",
    "Licensed under the ISC License.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    "Released under the zlib License.",
    "Licensed under the European Union Public License, version 1.2.",
]
# Notices of no known family, and sentences that only sound like notices.
UNKNOWN_NOTICES = [
    "Licensed under the Foo Bar License, Version 7.",
    "This work is licensed under the Example Community License.",
    "Released under a custom license, see the LICENSE file.",
    "Use of this software is subject to the license agreement of the vendor.",
    "Distributed under the terms of the Sample Source License.",
    "Copyright 2020 Somebody. See the license for the terms.",
]
ORDINARY = [
    "She renewed her driving license before the trip to the coast.",
    "The museum is free to the public on the first day of the month.",
    "Version 2.0 of the printer software adds support for paper of any size.",
    "The general public was asked to stay away from the works.",
    "He is right, and the rights of others are reserved for another chapter.",
    "Students from the institute released the results under pressure.",
]

_WORD = re.compile(r"[^\W_]+")
_SPACES = " \t\x0b\x0c\r"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _windows(n_words: int) -> range:
    """Where windows begin; the last one reaches the end."""
    half = UNIT_WORDS // 2
    return range(0, max(1, n_words - half), half)


def lines_of(text: str | None) -> list[tuple[int, list[str]]]:
    """``(line, words)`` of every line with words."""
    return [(n, own) for n, line in enumerate((text or "").split("\n")) if (own := words(line))]


def line_units(lines: list[tuple[int, list[str]]]) -> list[tuple[int, list[str]]]:
    return [(n, own[at : at + UNIT_WORDS]) for n, own in lines for at in _windows(len(own))]


def units(text: str | None) -> list[tuple[int, list[str]]]:
    """``(line, words)`` of every line with words, in windows where it is long."""
    return line_units(lines_of(text))


def paragraph_units(lines: list[tuple[int, list[str]]], settled: set[int]) -> list[tuple[list[int], list[str]]]:
    """``(line of each word, words)`` of runs of two and more lines, in windows where they are long.

    A line without words ends a run, and so does one of ``settled``.
    """
    runs: list[list[tuple[int, list[str]]]] = []
    last = None
    for n, own in lines:
        if n in settled:
            continue
        if last is None or n != last + 1:
            runs.append([])
        runs[-1].append((n, own))
        last = n
    out = []
    for run in runs:
        if len(run) > 1:
            where = [n for n, own in run for _ in own]
            joined = [word for _, own in run for word in own]
            for at in _windows(len(joined)):
                part = slice(at, at + UNIT_WORDS)
                # within one line it is a unit already
                if where[part][0] != where[part][-1]:
                    out.append((where[part], joined[part]))
    return out


def ngrams(own: list[str]) -> list[tuple[str, ...]]:
    return [tuple(own[i : i + k]) for k in range(1, MAX_NGRAM + 1) for i in range(len(own) - k + 1)]


def similarity(own: list[str], template: list[str]) -> float:
    """Share of the template's trigrams that stand in the text."""
    k = min(MAX_NGRAM, len(template))
    wanted = {tuple(template[i : i + k]) for i in range(len(template) - k + 1)}
    have = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
    return len(wanted & have) / len(wanted)


_TEMPLATE_WORDS = {family: [words(t) for t in texts] for family, texts in TEMPLATES.items()}
_NEIGHBOUR_WORDS = [words(t) for t in NEIGHBOURS]


def closest(own: list[str], family: str) -> float:
    return max(similarity(own, template) for template in _TEMPLATE_WORDS[family])


def beside(own: list[str]) -> float:
    """Similarity to the closest neighbour of the families."""
    return max(similarity(own, template) for template in _NEIGHBOUR_WORDS)


_FAMILY_GRAMS = {f: {gram for t in texts for gram in zip(t, t[1:], t[2:], strict=False)} for f, texts in _TEMPLATE_WORDS.items()}
_GRAMS = set().union(*_FAMILY_GRAMS.values())


def place(own: list[str], families: Iterable[str]) -> tuple[int, int]:
    """First word of the closest template of these families, and the one after its last; ``(0, 0)`` if none is close enough."""
    grams = list(zip(own, own[1:], own[2:], strict=False))
    if _GRAMS.isdisjoint(grams):
        return 0, 0
    like, template = max(((similarity(own, t), t) for f in families for t in _TEMPLATE_WORDS[f]), key=lambda x: x[0])
    if like < MIN_SIMILARITY:
        return 0, 0
    wanted, reach = set(zip(template, template[1:], template[2:], strict=False)), 2 * len(template)
    hits = [(at, gram) for at, gram in enumerate(grams) if gram in wanted]
    # words of the template may also stand elsewhere
    _, low = max((len({gram for at, gram in hits if low <= at < low + reach}), -low) for low, _ in hits)
    return -low, max(at for at, _ in hits if at < reach - low) + MAX_NGRAM


def _fragment(own: list[str]) -> bool:
    """Whether most of the words come from one template: a piece of a notice that is cut by line feeds."""
    grams = set(zip(own, own[1:], own[2:], strict=False))
    if not grams:
        return False
    return any(2 * len(grams.intersection(zip(t, t[1:], t[2:], strict=False))) >= len(grams) for texts in _TEMPLATE_WORDS.values() for t in texts)


def _variants(notice: str, prose: list[list[str]], draw: random.Random) -> Iterator[list[str]]:
    """The notice with words lost, doubled or exchanged, years and names around it, prose beside it."""
    own = words(notice)
    yield own
    for n in range(VARIANTS - 1):
        text = [w for w in own if draw.random() > 0.04]
        if draw.random() < 0.3:
            text = draw.choice([["copyright", "c", str(draw.randint(1990, 2030)), "the", "authors"], ["this", "file", "is"], ["notice"]]) + text
        if prose and draw.random() < 0.3:
            beside = draw.choice(prose)[: draw.randint(1, 15)]
            text = beside + text if n % 2 else text + beside
        yield text


def _taken(own: list[str], family: str) -> bool:
    """Whether another family's template, or a neighbour of the families, is closer than any of this one."""
    if family not in TEMPLATES:
        return False
    like = closest(own, family)
    return beside(own) > like or any(closest(own, other) > like for other in TEMPLATES if other != family)


def _lost(own: list[str]) -> bool:
    """Whether a neighbour's variant has lost what tells it from a family."""
    like = beside(own)
    return any(closest(own, family) >= like for family in TEMPLATES)


def labelled_rows(paragraphs: list[str]) -> list[tuple[str, list[str]]]:
    """``(label, words)``: variants of the templates, and sampled paragraphs by their closest template.

    A sampled line that is a piece of a notice, but too little of it, is no example of anything.
    """
    draw = random.Random(SEED)
    sample = [own for text in paragraphs for _, own in units(text)]
    rows: list[tuple[str, list[str]]] = []
    for own in sample:
        family, score = max(((f, closest(own, f)) for f in TEMPLATES), key=lambda x: x[1])
        if max(MIN_SIMILARITY, score) < beside(own):
            rows.append((UNKNOWN, own))
        elif score >= MIN_SIMILARITY or not _fragment(own):
            rows.append((family if score >= MIN_SIMILARITY else NONE, own))
    prose = [own for label, own in rows if label == NONE]
    for label, notices in [*TEMPLATES.items(), (UNKNOWN, UNKNOWN_NOTICES), (NONE, ORDINARY)]:
        for notice in notices:
            # without the words that tell them apart, a variant of one family is a notice of another
            rows += [(label, own) for own in _variants(notice, prose, draw) if not _taken(own, label)]
    for notice in NEIGHBOURS:
        rows += [(UNKNOWN, own) for own in _variants(notice, prose, draw) if not _lost(own)]
    return [(label, own) for label, own in rows if own]


@dataclass
class Model:
    """Weights by n-gram, in arrays a task can look up; logits are scaled by ``temperature``."""

    classes: list[str]
    features: dict[tuple[str, ...], int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def __post_init__(self):
        self.ids = {word: n for n, word in enumerate(sorted({word for gram in self.features for word in gram}))}
        # for each length, the n-grams as numbers in order, and the features they stand for
        self.grams = []
        for size in range(1, MAX_NGRAM + 1):
            rows = sorted((self._number(gram), n) for gram, n in self.features.items() if len(gram) == size)
            self.grams.append((np.array([k for k, _ in rows], np.int64), np.array([n for _, n in rows], np.int64)))

    def _number(self, gram: tuple[str, ...]) -> int:
        number = 0
        for word in gram:
            number = number * len(self.ids) + self.ids[word]
        return number

    def probabilities(self, texts: list[list[str]]) -> np.ndarray:
        """Of every class for every text, by the distinct features in it."""
        get, n = self.ids.get, len(texts)
        flat = np.fromiter((get(word, -1) for own in texts for word in own), np.int64)
        text = np.repeat(np.arange(n), [len(own) for own in texts])
        found = []
        number, whole = flat, flat >= 0
        for size, (keys, features) in enumerate(self.grams, 1):
            if size > 1:
                last = size - 1
                whole = whole[:-1] & (flat[last:] >= 0) & (text[last:] == text[: len(text) - last])
                number = number[:-1] * len(self.ids) + flat[last:]
            if len(keys):
                own = np.flatnonzero(whole)
                at = np.searchsorted(keys, number[own]).clip(max=len(keys) - 1)
                hit = keys[at] == number[own]
                found.append(text[own[hit]] * len(self.features) + features[at[hit]])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        text, feature = pairs // max(1, len(self.features)), pairs % max(1, len(self.features))
        sums = np.zeros((n, len(self.classes)))
        if len(pairs):
            starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            sums[text[starts]] = np.add.reduceat(self.weights[feature], starts, axis=0)
        counts = np.bincount(text, minlength=n).clip(min=1)
        logits = (self.bias + sums / np.sqrt(counts)[:, None]) / self.temperature
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def classify(self, texts: list[list[str]]) -> list[tuple[str, float, float]]:
        """Family, its probability and the similarity to its closest template, for every text.

        A notice that is not confident enough, or that no template of the family confirms, is unknown, and so is
        one that is closer to a neighbour of the families than to any of the family's templates.
        """
        if not texts:
            return []
        chances = self.probabilities(texts)
        out = []
        for own, top, chance in zip(texts, chances.argmax(axis=1).tolist(), chances.max(axis=1).tolist(), strict=True):
            label, like = self.classes[top], 0.0
            if label not in (NONE, UNKNOWN):
                like = closest(own, label)
                if chance < self.threshold or like < MIN_SIMILARITY or beside(own) > like:
                    label = UNKNOWN
            out.append((label, chance, like))
        return out


def sampled_paragraphs(docs: DataFrame, n: int = SAMPLED_PARAGRAPHS) -> list[str]:
    """``n`` distinct lines of all documents, those with the smallest hashes: a bounded sample for training.

    Hashes alone are compared first, each task gives its ``n`` smallest; only the lines chosen are moved.
    """

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            held = np.unique(np.concatenate([held, batch.column(0).to_numpy()]))[:n]
        yield pa.RecordBatch.from_arrays([pa.array(held)], ["h"])

    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    lines = lines.filter((F.trim("line", F.lit(_SPACES)) != "") & (F.length("line") <= SAMPLED_CHARS))
    hashed = lines.withColumn("h", F.xxhash64(F.lit(SEED), "line"))
    least = [row.h for row in hashed.select("h").mapInArrow(smallest, "h long").distinct().orderBy("h").limit(n).collect()]
    if not least:
        return []
    chosen = hashed.filter(F.col("h") <= least[-1]).distinct().orderBy("h", "line").limit(n)
    return [row.line for row in chosen.collect()]


def train(spark: SparkSession, paragraphs: list[str]) -> tuple[Model, float]:
    """The classifier, and its accuracy on a quarter of the labelled rows held out from training.

    Spark fits the regression; temperature and confidence threshold come from the held-out rows.
    """
    # of no use to the tasks that scan
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector

    rows = labelled_rows(paragraphs)
    random.Random(SEED).shuffle(rows)
    held, fitted = rows[: len(rows) // 4], rows[len(rows) // 4 :]
    counts = Counter(gram for _, own in fitted for gram in set(ngrams(own)))
    features = {gram: n for n, gram in enumerate(sorted(g for g, c in counts.items() if c >= MIN_FEATURE_ROWS))}
    classes = sorted({label for label, _ in rows})
    data = []
    for label, own in fitted:
        found = sorted({features[gram] for gram in ngrams(own) if gram in features})
        value = 1 / np.sqrt(max(1, len(found)))
        data.append((float(classes.index(label)), SparseVector(len(features), found, [value] * len(found))))
    frame = spark.createDataFrame(data, ["label", "features"]).coalesce(1)
    fit = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, standardization=False).fit(frame)
    weights, bias = fit.coefficientMatrix.toArray().T.copy(), fit.interceptVector.toArray()
    model = Model(classes, features, weights, bias, 1.0, 0.0)
    wanted = np.array([classes.index(label) for label, _ in held])
    texts = [own for _, own in held]

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(model.probabilities(texts)[np.arange(len(held)), wanted].clip(min=1e-12)).sum()

    model.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    chances = model.probabilities(texts)
    judged = [
        (chance, classes[top], label)
        for chance, top, (label, _) in zip(chances.max(axis=1).tolist(), chances.argmax(axis=1).tolist(), held, strict=True)
    ]
    notices = sorted((x for x in judged if x[1] not in (NONE, UNKNOWN)), reverse=True)
    right, threshold = 0, 1.0
    for n, (chance, got, label) in enumerate(notices, 1):
        right += got == label
        if right >= PRECISION * n:
            threshold = chance
    model.threshold = threshold
    accuracy = sum(got == label for _, got, label in judged) / max(1, len(judged))
    return model, accuracy


Label = tuple[str, float, float]


def _rank(label: Label) -> tuple[bool, float]:
    return label[0] != UNKNOWN, label[1]


def _piece(before: list[str], own: list[str], after: list[str], family: str) -> bool:
    """Whether a line beside a notice goes on with it: most of it is the family's, joined to the notice's words."""
    joined = before[-2:] + own + after[:2]
    grams = list(zip(joined, joined[1:], joined[2:], strict=False))
    return 2 * sum(gram in _FAMILY_GRAMS[family] for gram in grams) >= max(1, len(grams))


def notices(model: Model, texts: list[list[tuple[int, list[str]]]]) -> list[dict[int, Label]]:
    """Findings of each text, by the line where they begin.

    Lines and the paragraphs they make are judged alike, and the closest to its template comes first,
    lines before paragraphs. What is found takes its lines, with what goes on with it beside them. The
    rest is joined and judged again until nothing more is found: a window has one label, but may hold
    several notices. A window that is not confirmed is judged by the words of its closest template.
    A notice that runs over lines counts once; one of no known family only where its lines hold
    nothing else.
    """
    lines: list[dict[int, Label]] = [{} for _ in texts]
    parts = [(n, line, own) for n, text in enumerate(texts) for line, own in line_units(text)]
    for (n, line, _), label in zip(parts, model.classify([own for *_, own in parts]), strict=True):
        if label[0] != NONE and (line not in lines[n] or _rank(label) > _rank(lines[n][line])):
            lines[n][line] = label
    found: list[dict[int, Label]] = [{} for _ in texts]
    settled: list[set[int]] = [set() for _ in texts]
    active = list(range(len(texts)))
    while active:
        # text, first and last line, label
        known = [
            (n, line, line, label) for n in active for line, label in lines[n].items() if label[0] != UNKNOWN and line not in settled[n]
        ]
        unknown: list[tuple[int, int, int, Label]] = []
        wide = [(n, where, own) for n in active for where, own in paragraph_units(texts[n], settled[n])]
        narrow = []
        for (n, where, own), label in zip(wide, model.classify([own for *_, own in wide]), strict=True):
            if label[0] == UNKNOWN:
                unknown.append((n, where[0], where[-1], label))
            low, high = place(own, TEMPLATES if label[0] in (NONE, UNKNOWN) else [label[0]])
            if label[0] not in (NONE, UNKNOWN):
                known.append((n, where[low], where[high - 1], label))
            elif high:
                narrow.append((n, where[low], where[high - 1], own[low:high]))
        for (n, first, last, _), label in zip(narrow, model.classify([own for *_, own in narrow]), strict=True):
            if label[0] not in (NONE, UNKNOWN):
                known.append((n, first, last, label))
        again = set()
        for n, first, last, label in sorted(known, key=lambda x: (x[0], -x[3][2], x[2] - x[1], -x[3][1], x[1])):
            if settled[n].isdisjoint(range(first, last + 1)):
                again.add(n)
                found[n][first] = label
                settled[n].update(range(first, last + 1))
                own = dict(texts[n])
                for step, at in ((1, last), (-1, first)):
                    beside = at + step
                    while beside in own and beside not in settled[n] and lines[n].get(beside, (UNKNOWN,))[0] == UNKNOWN:
                        if not _piece(own[at] if step > 0 else [], own[beside], own[at] if step < 0 else [], label[0]):
                            break
                        settled[n].add(beside)
                        at, beside = beside, beside + step
        # once no notice is left that is known
        unknown += [(n, line, line, label) for n in active for line, label in lines[n].items() if label[0] == UNKNOWN]
        for n, first, last, label in sorted(unknown, key=lambda x: (x[0], x[2] - x[1], -x[3][1], x[1])):
            if n not in again and settled[n].isdisjoint(range(first, last + 1)):
                found[n][first] = label
                settled[n].update(range(first, last + 1))
        active = sorted(again)
    return found


def _together(column: pa.Array, chars: int = 1 << 17) -> Iterator[list[str]]:
    """The texts of a column, null ones empty, in lists of about so many characters."""
    texts, size = [], 0
    for text in column:
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_paragraphs, n_licence, n_unknown, families, findings)`` per row of ``docs``.

    Every line with words is classified; long ones in overlapping windows, whose finding with the
    highest probability counts. Then paragraphs are, so that notices wrapped over lines are found, see
    ``notices``. ``n_paragraphs`` are the lines with words, ``families`` the distinct confirmed ones,
    ``findings`` hold first line, family, probability and similarity of every notice, unknown ones included.

    Null and empty texts have no paragraphs. Null ids stay null, repeated rows are scanned each,
    other columns are not read, an empty table gives no rows. Rows are judged on their own: nothing
    is shuffled. The model that tasks hold is bounded by the training sample.
    """
    schema = (
        "doc_id long, n_paragraphs long, n_licence long, n_unknown long, families string,"
        " findings array<struct<line:int,family:string,probability:double,similarity:double>>"
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())]))
        for batch in batches:
            out = []
            for texts in _together(batch.column(1)):
                lines = [lines_of(text) for text in texts]
                for own, best in zip(lines, notices(model, lines), strict=True):
                    known = [f for f, *_ in best.values() if f != UNKNOWN]
                    rows = [{"line": n, "family": f, "probability": round(p, 6), "similarity": round(s, 6)} for n, (f, p, s) in sorted(best.items())]
                    out.append((len(own), len(known), len(best) - len(known), ",".join(sorted(set(known))), rows))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), kind]
            names = ["doc_id", "n_paragraphs", "n_licence", "n_unknown", "families", "findings"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(scanned, schema)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, _ = train(spark, sampled_paragraphs(docs))
    return scan(docs, model)
