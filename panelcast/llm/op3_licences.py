"""License scans: a paragraph classifier over word n-grams.

Paragraphs (lines) are classified by softmax regression over hashed word
1- to 3-grams into licence families or none. It is trained here, on the
templates below and variants of them (words lost, doubled or replaced, stretches
cut out, words of the corpus around them) against a bounded sample of the
corpus's paragraphs (``SAMPLE``). A temperature fitted on held-out variants
calibrates the probabilities. The unknown class is calibrated on families that a
model has never seen: the regression is fitted again without each group of kin
families (``KIN``), and what these models say of the variants left out, beside
held-out variants of known families and paragraphs of the corpus, sets how unlikely
none must be for a licence and how likely a family for a name. A predicted family is
confirmed by comparing the paragraph with the family's templates (share of a template's
word pairs that the paragraph has, or the other way round for a part of a
template); a licence without a sure and confirmed family is ``unknown``.

Defined results: a null or empty text has one empty paragraph, which is none;
repeated rows are scanned each; with an empty table the model is trained on the
templates alone and there are no rows; other columns are ignored. Texts are
scanned whole, in one Arrow pass without a shuffle; the model has a fixed size.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.anchors import mixed, span_hashes
from panelcast.llm.common import slices, utf8
from panelcast.llm.op1_quality import lines_of

#: What licence notices of each family say.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Released under the BSD 3-Clause License.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "The accompanying program is provided under the terms of this Eclipse Public License (\"Agreement\"). Any use, reproduction or distribution of the program constitutes recipient's acceptance of this Agreement.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
        "You may copy and distribute verbatim copies of the Program's source code as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice and disclaimer of warranty.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}
#: Families whose texts have much in common; a model that knows one of them does know the others.
KIN = [("agpl", "gpl", "lgpl"), ("cc-by", "cc-by-nc", "cc-by-sa"), ("boost", "isc", "mit", "unlicense"), ("apache", "bsd"), ("epl", "mpl")]
FAMILIES = sorted(TEMPLATES)
NONE = len(FAMILIES)
UNKNOWN = "unknown"
#: Hash buckets of the n-grams; paragraphs of the corpus trained on (about); variants of each template.
BUCKETS, SAMPLE, VARIANTS = 1 << 16, 6_000, 60
EPOCHS, RATE, PENALTY = 12, 0.5, 1e-5
#: Share of a template's word pairs that confirms a family.
CONFIRMED = 0.6
#: Share of the corpus's paragraphs that may pass for a licence; the most that none may have then.
FALSE, MOST_NONE = 0.001, 0.98
#: Lines of licence words in no order, which are none.
LOOSE = 100

_WORD = np.zeros(256, np.uint8)
for _members in (range(48, 58), range(97, 123), range(128, 256)):
    _WORD[list(_members)] = list(_members)
_WORD[65:91] = np.arange(97, 123)


def ngrams(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Bucket and line of every word 1- to 3-gram, the number of lines, and the first line of each text."""
    starts, first = lines_of(at, data)
    n = len(starts) - 1
    folded = _WORD[data]
    inside = np.concatenate([[False], folded > 0, [False]])
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True
    begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n, first
    line = np.searchsorted(starts, begin, "right") - 1
    h = span_hashes(folded, begin, end)
    buckets, lines = [h], [line]
    gram = h
    for k in (1, 2):
        gram = mixed(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k:])
        same = line[k:] == line[:-k]
        buckets.append(gram[same])
        lines.append(line[k:][same])
    return (np.concatenate(buckets) >> np.uint64(48)).astype(np.int64), np.concatenate(lines), n, first


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def word_pairs(text: str) -> set[tuple]:
    w = words(text)
    return set(zip(w, w[1:])) or {tuple(w)}


def softmax(scores: np.ndarray, temperature: float) -> np.ndarray:
    z = scores / temperature
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


class Model:
    """``weights`` (buckets x classes), ``bias``; the temperature; a paragraph is a licence when none has less than ``none``,
    and of a family when that has ``bound`` or more."""

    def __init__(self, weights, bias, temperature=1.0, bound=0.5, none=0.5):
        self.weights, self.bias, self.temperature, self.bound, self.none = weights, bias, temperature, bound, none
        self.templates = [[word_pairs(t) for t in TEMPLATES[f]] for f in FAMILIES]

    def scores(self, bucket, line, n) -> np.ndarray:
        out = np.zeros((n, NONE + 1), np.float32)
        if len(bucket):
            known = np.abs(self.weights).any(1)[bucket]  # most n-grams of a corpus bear no weight
            bucket, line = bucket[known], line[known]
            for c in range(NONE + 1):
                out[:, c] = np.bincount(line, self.weights[bucket, c], n)
            length = np.maximum(1, np.bincount(line, minlength=n))
            out /= np.sqrt(length)[:, None]
        return out + self.bias

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return softmax(scores, self.temperature)

    def confirm(self, family: int, paragraph: str) -> bool:
        mine = word_pairs(paragraph)
        return any(len(t & mine) >= CONFIRMED * len(t) or len(mine) > 5 and len(t & mine) >= CONFIRMED * len(mine) for t in self.templates[family])

    def scan(self, at: np.ndarray, data: np.ndarray):
        """(text, line, label, probability) of every paragraph that is not none."""
        bucket, line, n, first = ngrams(at, data)
        p = self.probabilities(self.scores(bucket, line, n))
        hits = np.flatnonzero(p[:, NONE] < self.none)
        if not len(hits):
            return []
        starts, _ = lines_of(at, data)
        out = []
        for k in hits.tolist():
            text = int(np.searchsorted(first, k, "right")) - 1
            family = int(p[k, :NONE].argmax())
            chance = float(p[k, family])
            paragraph = data[starts[k] : starts[k + 1]].tobytes().decode("utf-8", "replace")
            sure = p[k, NONE] < 0.5 and chance >= self.bound and self.confirm(family, paragraph)
            out.append((text, k - int(first[text]), FAMILIES[family] if sure else UNKNOWN, chance if sure else 1 - float(p[k, NONE])))
        return out


def variants(rng: np.random.Generator, around: list[str]) -> tuple[list[str], list[int]]:
    """Training paragraphs of every family: each template as it is, and changed at random."""
    texts, labels = [], []
    vocabulary = [w for p in around for w in p.split()] or ["lorem"]
    for family, name in enumerate(FAMILIES):
        for template in TEMPLATES[name]:
            base = template.split()
            texts.append(template)
            labels.append(family)
            for _ in range(VARIANTS):
                w = list(base)
                for k in np.flatnonzero(rng.random(len(w)) < 0.08)[::-1].tolist():
                    kind = rng.integers(3)
                    w[k : k + 1] = [[], [w[k], w[k]], [vocabulary[rng.integers(len(vocabulary))]]][kind]
                if len(w) > 14 and rng.random() < 0.3:  # a part
                    a = int(rng.integers(len(w) - 12))
                    w = w[a : a + int(rng.integers(12, len(w) - a + 1))]
                if rng.random() < 0.3:  # inside other words
                    add = [vocabulary[i] for i in rng.integers(len(vocabulary), size=int(rng.integers(1, 12)))]
                    w = add + w if rng.random() < 0.5 else w + add
                texts.append(" ".join(w))
                labels.append(family)
    return texts, labels


def fit(corpus: list[str], seed: int = 7) -> Model:
    """Softmax regression by mini-batch gradient descent, then the temperature on a held-out tenth and the bounds
    of the unknown class on families left out."""
    rng = np.random.default_rng(seed)
    licence = [word_pairs(t) for f in FAMILIES for t in TEMPLATES[f]]
    clean = [p for p in corpus if not any(len(t & word_pairs(p)) >= CONFIRMED * len(t) for t in licence)]
    texts, labels = variants(rng, clean)
    # the words of licences in no licence's order are none, as the corpus is
    soup = [w for f in FAMILIES for t in TEMPLATES[f] for w in t.split()]
    loose = [" ".join(rng.choice(soup, size=int(rng.integers(1, 12)))) for _ in range(LOOSE)]
    texts += clean + loose + [""]
    y = np.array(labels + [NONE] * (len(clean) + len(loose) + 1))
    raw = [" ".join(t.split("\n")).encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    bucket, line, n, _ = ngrams(at, np.frombuffer(b"".join(raw), np.uint8))
    order = np.argsort(line, kind="stable")
    bucket, line = bucket[order], line[order]
    cut = np.searchsorted(line, np.arange(n + 1))
    test = rng.random(n) < 0.1
    corpus = np.arange(n) >= len(labels)
    corpus[len(labels) + len(clean) :] = False
    group = np.array([next(i for i, kin in enumerate(KIN) if f in kin) for f in FAMILIES] + [-1])[y]
    model = _trained(bucket, cut, y, np.flatnonzero(~test), rng)
    held = np.flatnonzero(test)
    scores = model.scores(bucket, line, n)[held]
    truth = y[held]

    def loss(temperature: float) -> float:
        return -float(np.mean(np.log(np.maximum(1e-12, softmax(scores, temperature)[np.arange(len(held)), truth]))))

    model.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    # what models that never saw a group of families say of it, of held-out variants of the others and of the corpus
    unseen, known, clean_none = [], [], []
    for g in range(len(KIN)):
        other = _trained(bucket, cut, y, np.flatnonzero(~test & (group != g)), rng)
        p = softmax(other.scores(bucket, line, n), model.temperature)
        best = p[:, :NONE].max(1)
        unseen.append(best[group == g])
        known.append(best[test & (group >= 0) & (group != g) & (p.argmax(1) == y)])
        clean_none.append(p[corpus & test, NONE])
    unseen, known, clean_none = map(np.concatenate, (unseen, known, clean_none))
    model.none = float(np.clip(np.quantile(clean_none, FALSE), 0.5, MOST_NONE)) if len(clean_none) else 0.5
    steps = np.linspace(0.3, 0.95, 66)
    model.bound = float(max(steps, key=lambda b: (known >= b).mean() + (unseen < b).mean())) if len(known) else 0.5
    return model


def _trained(bucket: np.ndarray, cut: np.ndarray, y: np.ndarray, train: np.ndarray, rng: np.random.Generator) -> Model:
    """Weights from the rows ``train``, whose n-grams are ``bucket[cut[row]:cut[row + 1]]``."""
    model = Model(np.zeros((BUCKETS, NONE + 1), np.float32), np.zeros(NONE + 1, np.float32))
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch / 10)
        shuffled = rng.permutation(train)
        for a in range(0, len(shuffled), 64):
            rows = shuffled[a : a + 64]
            count = cut[rows + 1] - cut[rows]
            pick = np.repeat(cut[rows] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            own = np.repeat(np.arange(len(rows)), count)
            b, scale = bucket[pick], 1 / np.sqrt(np.maximum(1, count))
            z = np.zeros((len(rows), NONE + 1), np.float32)
            some = count > 0
            if len(b):
                z[some] = np.add.reduceat(model.weights[b], (np.cumsum(count) - count)[some]) * scale[some, None]
            z += model.bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            if len(b):
                order = np.argsort(b, kind="stable")
                each, at = np.unique(b[order], return_index=True)
                step = np.add.reduceat((p * scale[:, None])[own[order]], at) + PENALTY * model.weights[each] * np.diff(np.append(at, len(b)))[:, None]
                model.weights[each] -= rate * step
            model.bias -= rate * p.mean(0)
    model.weights[np.abs(model.weights).max(1) < 1e-3] = 0
    return model


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit against about ``sample`` paragraphs of the corpus, one of each of as many texts, chosen by hashes."""
    n = docs.count()
    if not n:
        return fit([])
    draw = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / n))
    lines = F.split("text", "\n")
    line = F.element_at(lines, F.pmod(F.xxhash64("text"), F.size(lines).cast("long")).cast("int") + 1)
    # the whole paragraph counts; only the sample is bounded
    rows = docs.where(F.col("text").isNotNull() & draw).select(line.alias("line")).limit(2 * sample).collect()
    return fit(sorted(r["line"] for r in rows))


def paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """One row per licence paragraph: ``doc_id, line, family, probability``."""
    return _scan(docs, model, per_text=False)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, families`` (confirmed, ascending, joined by commas), ``n_licence``, ``n_unknown``, ``score``."""
    return _scan(docs, model, per_text=True)


def _scan(docs: DataFrame, model: Model, per_text: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            at, data = utf8(batch.column("text"))
            found = []
            for a, b in slices(at, 1 << 20):
                found += [(a + t, *rest) for t, *rest in m.scan(at[a : b + 1] - at[a], data[at[a] : at[b]])]
            if not per_text:
                text, line, family, chance = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(text, pa.int64())), pa.array(line, pa.int64()), pa.array(family, pa.string()), pa.array(chance, pa.float64())],
                    ["doc_id", "line", "family", "probability"],
                )
                continue
            n = batch.num_rows
            names, licence, unknown, best = [set() for _ in range(n)], [0] * n, [0] * n, [0.0] * n
            for text, _, family, chance in found:
                if family == UNKNOWN:
                    unknown[text] += 1
                else:
                    licence[text] += 1
                    names[text].add(family)
                best[text] = max(best[text], chance)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([",".join(sorted(x)) for x in names], pa.string()), pa.array(licence, pa.int64()), pa.array(unknown, pa.int64()), pa.array(best, pa.float64())],
                ["doc_id", "families", "n_licence", "n_unknown", "score"],
            )

    columns = "families string, n_licence long, n_unknown long, score double" if per_text else "line long, family string, probability double"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {columns}")
