"""Licence notices in documents: a trained paragraph classifier with template confirmation.

Every paragraph (line) is classified by multinomial logistic regression over hashed word one-, two-
and three-grams. It learns from the notices below, from damaged versions of them, from the names of
licences in :data:`WORDINGS`, from general legal sentences (class ``unknown``), from :data:`MENTIONS`
of licences that grant nothing and from a bounded sample of the corpus (both no licence). A temperature
and the least confidence of a family are calibrated on lines kept out of the fit. The prediction decides
the family; it is confirmed when the paragraph holds enough of the word three-grams of one of that
family's templates or one of its names, and counts as ``unknown`` otherwise.

Notices that are wrapped over lines or stand inside longer ones are proposed by their templates: the
words of the whole text, without those of punctuation only, are searched for windows that hold enough of
the three-grams of a template. The classifier decides such a window like a line, and drops it or takes
it in place of the unconfirmed lines it meets.

Defined results: null or empty texts have no notice; words are split at white space, A-Z as a-z;
repeated rows are scanned one by one; spans are in code points.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.llm.hashing import mix, row_slices, text_bytes, word_hashes
from xylemflow.llm.postings import bounded_sample, contained, mapper

# Notices as their licences and common practice word them.
TEMPLATES: dict[str, list[str]] = {
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "unknown": [
        "All rights reserved.",
        "Use of this material is subject to the license agreement of the publisher.",
        "No part of this publication may be reproduced without the prior written permission of the author.",
        "This software is proprietary and confidential; licensed users only.",
        "Released under a custom license, see the terms of use.",
    ],
}
# Names of the licences as they are written in short notices.
NAMES: dict[str, list[str]] = {
    "AGPL": ["GNU Affero General Public License", "GNU AGPL", "AGPL v3", "AGPL-3.0", "AGPL-3.0-or-later"],
    "Apache": ["Apache License", "Apache 2.0", "Apache-2.0"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause"],
    "CC-BY": ["Creative Commons Attribution 4.0", "CC BY 4.0", "CC-BY-4.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0", "CC BY-NC 4.0", "CC-BY-NC-4.0"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike 4.0", "CC BY-SA 4.0", "CC-BY-SA-4.0"],
    "CC0": ["CC0 1.0 Universal", "CC0 1.0", "CC0-1.0"],
    "GPL": ["GNU General Public License", "GNU GPL", "GPL v2", "GPL v3", "GPL-2.0", "GPL-3.0", "GPL-3.0-or-later"],
    "ISC": ["ISC License", "SPDX-License-Identifier: ISC"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "LGPL v3", "LGPL-2.1", "LGPL-3.0"],
    "MIT": ["MIT License", "SPDX-License-Identifier: MIT"],
    "MPL": ["Mozilla Public License", "MPL 2.0", "MPL-2.0"],
}
#: Short notices that name a licence, and sentences that only mention one.
WORDINGS = (
    "{}", "{}.", "Licensed under the {}.", "Licensed under {}", "This software is released under the {}.", "License: {}", "{} or later",
    "Distributed under the terms of the {}.", "The code is available under the {}, see the file LICENSE.", "SPDX-License-Identifier: {}",
    "You can redistribute this work under the {}.", "Made available under {}.", "This file is subject to the {}.",
)
MENTIONS = (
    "The history of the {} is told in the second chapter.", "We compared the {} with other licenses in our survey.",
    "Many projects moved away from the {} in recent years.", "She explained what the {} asks of companies that use it.",
    "What is the difference between the {} and its older versions?", "The {} was written by a group of lawyers.",
    "An article on the {} appeared last year.", "They discussed the {} for hours.", "The judge quoted the {} at length.",
    "Students learn about the {} in this course.", "Our lawyer does not like the {}.", "Some versions of the {} are listed in a table.",
)
NONE, UNKNOWN = "none", "unknown"
CLASSES = [NONE, *sorted(TEMPLATES)]
FEATURES, GRAMS = 1 << 18, 3
DAMAGED, DAMAGED_NAMES, SAMPLE_DOCUMENTS, SAMPLE_LINES, EPOCHS, RATE = 40, 4, 1000, 20_000, 12, 0.5
#: Share of a template's three-grams that confirms it, and share of kept-out corpus lines that may pass.
COVER, FALSE_SHARE = 0.6, 0.001
#: Longest window of a notice, in three-grams of its template.
STRETCHED = 1.5
#: Words of the shortest notice that no template confirms.
LEAST_WORDS = 3

FOUND = "doc_id long, n_paragraphs long, n_notices long, families string, score double, spans string"


def line_offsets(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the lines of all rows (n+1), and each row's first line (rows+1)."""
    cuts = np.flatnonzero(flat == 10) + 1
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], cuts[cuts < len(flat)]]))
    return np.append(starts, len(flat)).astype(np.int64), np.searchsorted(starts, offsets)


def features(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word 1- to 3-grams of each line, in line order, and n+1 bounds."""
    words, bounds = word_hashes(flat, offsets)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    all_grams, owners = [words], [owner]
    for n in range(2, GRAMS + 1):
        count = max(0, len(words) - n + 1)
        inside = owner[:count] == owner[n - 1 : n - 1 + count]
        gram = mix(all_grams[-1][:count] * np.uint64(3) + words[n - 1 : n - 1 + count]) if n == 2 else None
        if gram is None:
            gram = mix((words[:count] * np.uint64(3) + words[1 : 1 + count]) * np.uint64(5) + words[2 : 2 + count])
        all_grams.append(gram[inside])
        owners.append(owner[:count][inside])
    grams, owner = np.concatenate(all_grams), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (grams[order] % np.uint64(FEATURES)).astype(np.int64), np.append(0, np.cumsum(np.bincount(owner, minlength=len(bounds) - 1)))


def _of_lines(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    flat, offsets = text_bytes(pa.array(lines, pa.string()))
    parts = [features(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in row_slices(offsets)]
    sizes = np.concatenate([np.diff(b) for _, b in parts]) if parts else np.zeros(0, np.int64)
    return np.concatenate([f for f, _ in parts]) if parts else np.zeros(0, np.int64), np.append(0, np.cumsum(sizes))


def class_scores(ids: np.ndarray, bounds: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logits of each line; a line's features weigh one over the root of their number."""
    total = np.zeros((len(bounds) - 1, len(bias)), np.float32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        total[full] = np.add.reduceat(weights[ids], bounds[:-1][full], axis=0)
    return total / np.sqrt(np.maximum(np.diff(bounds), 1))[:, None] + bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _training_lines(corpus: list[str], random: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Notices, their damaged versions, named and mentioned licences and corpus lines, with their classes."""
    vocabulary = np.array(sorted({w for line in corpus[:2000] for w in line.split()}) or ["word"], object)
    lines, labels = [], []
    for k, name in enumerate(CLASSES[1:], 1):
        for notice in TEMPLATES[name]:
            words = notice.split()
            for i in range(DAMAGED):
                kept = [w if random.random() > 0.12 * (i > 0) else str(random.choice(vocabulary)) for w in words]
                before = [str(w) for w in random.choice(vocabulary, random.integers(0, 6) if i % 2 else 0)]
                lines.append(" ".join(before + kept))
                labels.append(k)
        for text in (w.format(licence) for licence in NAMES.get(name, ()) for w in WORDINGS):
            for i in range(DAMAGED_NAMES):
                around = [" ".join(str(w) for w in random.choice(vocabulary, random.integers(0, 4) if i else 0)) for _ in range(2)]
                lines.append(f"{around[0]} {text} {around[1]}".strip())
                labels.append(k)
        mentioned = [m.format(licence) for licence in NAMES.get(name, ()) for m in MENTIONS]
        lines += mentioned
        labels += [0] * len(mentioned)
    return lines + corpus, np.array(labels + [0] * len(corpus))


def fit(corpus: list[str], seed: int = 5) -> dict:
    """Weights, bias, temperature and least confidence from notices and ordinary lines."""
    random = np.random.default_rng(seed)
    lines, labels = _training_lines(corpus, random)
    ids, bounds = _of_lines(lines)
    held = random.random(len(lines)) < 0.25
    count = len(CLASSES)
    weights, bias = np.zeros((FEATURES, count), np.float32), np.zeros(count, np.float32)
    square, bias_square = np.full((FEATURES, count), 1e-4, np.float32), np.full(count, 1e-4, np.float32)
    balance = np.where(labels == 0, 1.0, 2.0)
    train = np.flatnonzero(~held)
    for _ in range(EPOCHS):
        for at in np.array_split(random.permutation(train), max(1, len(train) // 256)):
            widths = np.diff(bounds)[at]
            part = np.concatenate([ids[bounds[i] : bounds[i + 1]] for i in at]) if len(at) else ids[:0]
            edges = np.append(0, np.cumsum(widths))
            error = -_softmax(class_scores(part, edges, weights, bias))
            error[np.arange(len(at)), labels[at]] += 1
            error = (error * balance[at][:, None]).astype(np.float32)
            used, inverse = np.unique(part, return_inverse=True)
            share = np.repeat(error / np.sqrt(np.maximum(widths, 1))[:, None], widths, axis=0)
            step = np.stack([np.bincount(inverse, share[:, k], len(used)) for k in range(count)], 1).astype(np.float32)
            square[used] += step**2
            weights[used] += RATE * step / np.sqrt(square[used])
            step = error.sum(0)
            bias_square += step**2
            bias += RATE * step / np.sqrt(bias_square)
    out = np.flatnonzero(held)
    logits = np.concatenate([class_scores(ids[bounds[i] : bounds[i + 1]], np.array([0, bounds[i + 1] - bounds[i]]), weights, bias) for i in out])
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(out)), labels[out]] + 1e-12).mean()
    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0), key=loss)
    licensed = 1 - _softmax(logits / temperature)[:, 0]
    ordinary = licensed[labels[out] == 0]
    least = max(0.5, float(np.quantile(ordinary, 1 - FALSE_SHARE))) if len(ordinary) else 0.5
    grams = {name: [np.sort(_three_grams(t)) for t in notices] for name, notices in TEMPLATES.items() if name != UNKNOWN}
    return {"weights": weights, "bias": bias, "temperature": temperature, "least": min(least, 0.95), "grams": grams}


def _three_grams(line: str) -> np.ndarray:
    flat, offsets = text_bytes(pa.array([line], pa.string()))
    words, _ = word_hashes(flat, offsets)
    count = max(1, len(words) - 2)
    padded = np.append(words, np.zeros(2, np.uint64))
    return np.unique(mix(padded[:count] * np.uint64(7) + padded[1 : 1 + count] * np.uint64(11) + padded[2 : 2 + count]))


def _plain_words(text: str) -> str:
    """The words of a text in lower case, without the punctuation around them, each between two blanks."""
    return f" {' '.join(w for w in (_EDGE.sub('', m) for m in text.translate(_LOW).split()) if w)} "


def confirmed(text: str, family: str, grams: dict[str, list[np.ndarray]]) -> str:
    """The predicted family, where a template or a name of it is found in the text, else unknown."""
    if family == UNKNOWN:
        return UNKNOWN
    words = _plain_words(text)
    if any(_plain_words(name) in words for name in NAMES[family]):
        return family
    own = _three_grams(text)
    return family if any(float(contained(t, own).mean()) >= COVER for t in grams[family]) else UNKNOWN


_WORD, _SIGN = re.compile(r"[^ \t-\r]+"), re.compile(r"[^\W_]")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_LOW = str.maketrans({c: c + 32 for c in range(65, 91)})


def _word_grams(words: list[str]) -> list[tuple[str, ...]]:
    return [tuple(words[i : i + GRAMS]) for i in range(len(words) - GRAMS + 1)]


_NOTICES = [(name, set(_word_grams(t.translate(_LOW).split()))) for name, notices in TEMPLATES.items() for t in notices]
_HOLDERS = {gram: [k for k, (_, own) in enumerate(_NOTICES) if gram in own] for _, grams in _NOTICES for gram in grams}
_ALL_GRAMS = np.unique(np.concatenate([_three_grams(t) for notices in TEMPLATES.values() for t in notices]))


def _with_grams(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row holds a three-gram of some template."""
    out = np.zeros(len(offsets) - 1, bool)
    for a, b in row_slices(offsets):
        words, bounds = word_hashes(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        count = max(0, len(words) - 2)
        grams = mix(words[:count] * np.uint64(7) + words[1 : 1 + count] * np.uint64(11) + words[2 : 2 + count])
        at = np.flatnonzero(contained(grams, _ALL_GRAMS))
        out[a + np.searchsorted(bounds, at, "right") - 1] = True
    return out


def windows(text: str) -> list[tuple[int, int, str]]:
    """``start, end, family`` of the windows of a text that hold enough of a template, in order."""
    words = [m for m in _WORD.finditer(text) if _SIGN.search(m.group())]
    grams = _word_grams([m.group().translate(_LOW) for m in words])
    hits = defaultdict(list)
    for i, gram in enumerate(grams):
        for k in _HOLDERS.get(gram, ()):
            hits[k].append(i)
    found = []
    for k, at in hits.items():
        family, own = _NOTICES[k]
        for n, first in enumerate(at):
            seen, last = set(), first
            for i in at[n:]:
                if i - first >= STRETCHED * len(own):
                    break
                if grams[i] not in seen:
                    seen.add(grams[i])
                    last = i
            if len(seen) >= COVER * len(own):
                found.append((-len(seen) / len(own), -len(seen), first, last + GRAMS, family))
    owner, kept = [-1] * len(words), []
    for _, _, first, end, family in sorted(found):
        met = set(owner[first:end]) - {-1}
        if not met:
            kept.append([first, end, family])
            met = {len(kept) - 1}
        if len(met) == 1 and kept[k := met.pop()][2] == family:
            kept[k][:2] = min(first, kept[k][0]), max(end, kept[k][1])
            owner[first:end] = [k] * (end - first)
    return sorted((words[first].start(), words[end - 1].end(), family) for first, end, family in kept)


def judged(text: str, proposed: list[tuple[int, int, str]], model: dict) -> tuple[list[tuple[int, int, str]], float]:
    """The proposed windows that the classifier takes for notices, with its confirmed families, and the best score."""
    if not proposed:
        return [], 0.0
    ids, bounds = _of_lines([text[a:b] for a, b, _ in proposed])
    shares = _softmax(class_scores(ids, bounds, model["weights"], model["bias"]) / model["temperature"])
    kept = [k for k in range(len(proposed)) if 1 - shares[k, 0] >= model["least"]]
    found = [(*proposed[k][:2], confirmed(text[slice(*proposed[k][:2])], CLASSES[1 + int(shares[k, 1:].argmax())], model["grams"])) for k in kept]
    return found, max((float(1 - shares[k, 0]) for k in kept), default=0.0)


def _merged(lines: list[tuple[int, int, str]], blocks: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Notices of lines and of windows, both in order; a confirmed line holds the windows of its family."""
    kept, low = [], 0
    taken: set[int] = set()
    for a, b, family in lines:
        while low < len(blocks) and blocks[low][1] <= a:
            low += 1
        near = low
        replaced = False
        while near < len(blocks) and blocks[near][0] < b:
            start, end, other = blocks[near]
            if other == family and a <= start and end <= b:
                taken.add(near)
            elif family == UNKNOWN or (other == family and start <= a and b <= end):
                replaced = True
            near += 1
        if not replaced:
            kept.append((a, b, family))
    return sorted(kept + [block for k, block in enumerate(blocks) if k not in taken])


def _scanned(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offsets = text_bytes(batch.column(1))
        lines, firsts = line_offsets(flat, offsets)
        licensed = np.zeros(len(lines) - 1, np.float64)
        likely = np.zeros(len(lines) - 1, np.int64)
        for a, b in row_slices(lines, 1 << 18):
            ids, bounds = features(flat[lines[a] : lines[b]], lines[a : b + 1] - lines[a])
            shares = _softmax(class_scores(ids, bounds, model["weights"], model["bias"]) / model["temperature"])
            licensed[a:b], likely[a:b] = np.where(np.diff(bounds) > 0, 1 - shares[:, 0], 0.0), 1 + shares[:, 1:].argmax(1)
        rows = []
        hits = np.flatnonzero(licensed >= model["least"])
        owner = np.searchsorted(firsts, hits, "right") - 1
        candidates = _with_grams(flat, offsets)
        for row, doc_id in enumerate(batch.column(0).to_pylist()):
            found, score = [], 0.0
            for line in hits[np.searchsorted(owner, row) : np.searchsorted(owner, row, "right")]:
                a, b = int(lines[line]), int(lines[line + 1])
                text = flat[a:b].tobytes().decode().rstrip("\n")
                start = len(flat[offsets[row] : a].tobytes().decode())
                family = confirmed(text, CLASSES[likely[line]], model["grams"])
                if family == UNKNOWN and len(text.split()) < LEAST_WORDS:
                    continue
                score = max(score, float(licensed[line]))
                found.append((start, start + len(text), family))
            if candidates[row]:
                text = flat[offsets[row] : offsets[row + 1]].tobytes().decode()
                blocks, best = judged(text, windows(text), model)
                found, score = _merged(found, blocks), max(score, best)
            families = {family for _, _, family in found}
            spans = [f"{family}:{a}:{b}" for a, b, family in found]
            rows.append((doc_id, int(firsts[row + 1] - firsts[row]), len(spans), ",".join(sorted(families)), score, ",".join(spans)))
        columns = list(zip(*rows)) if rows else [[]] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in FOUND.split(", ")])


def scan_licenses(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """:data:`FOUND` of every row of ``docs`` (``doc_id``, ``text``); fits a model where none is given."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        sample = bounded_sample(source, SAMPLE_DOCUMENTS).select(F.explode(F.split("text", "\n")).alias("line")).where(F.length(F.trim("line")) > 0)
        usual = sample.where(~F.lower("line").rlike("licen[sc]e|copyright|licensed|all rights|warrant")).orderBy(F.xxhash64("line")).limit(SAMPLE_LINES)
        model = fit(sorted(r["line"] for r in usual.collect()))
    return source.mapInArrow(mapper(_scanned, model), FOUND)
