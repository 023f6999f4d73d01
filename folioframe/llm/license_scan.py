"""License scans: a paragraph classifier trained on licence texts, confirmed by comparison with them.

A paragraph is a line with a word. Its features are its words and word pairs (runs of letters, digits, dots and
hyphens, lower-cased) hashed to BUCKETS and counted, divided by the root of their number; features that no template has count as one,
OTHER. A multinomial logistic regression over the licence families
and `unknown` is fitted on variants of the templates (windows, words dropped, holders and years added) and on
paragraphs that no template resembles, up to PER_DOCUMENT (chosen by a hash from the whole text) of up to about BACKGROUND documents; only lines
of 10 to 1,500 characters are taken for that. Its probabilities are calibrated by a
temperature: of FOLDS fits each leaves out a part of the templates, with all their variants, and of the background, and is asked about
that part; the model itself is then fitted on all. Below LEAST a paragraph is unknown.

A prediction is confirmed if the paragraph's word pairs are contained in one of the family's templates, or such a template's in the paragraph, by SIMILAR
or more, each pair weighted by how few families have it, and no other family's template is closer. So `the terms of the` says little, and
the name of a licence that isn't known here says that it is none of these. A paragraph of up to three words is compared with identifiers word by word.

The model (families x features, under 1 MB) and the templates are broadcast; both are independent of the corpus. Every
paragraph of every text is scored whole, one-word paragraphs and those without a template's word included.

Edge cases: null and blank texts have no paragraphs; repeated lines are paragraphs of their own; rows with equal ids are scanned each; without background the unknown class
is learnt from shuffled template words alone; empty tables give no rows; other columns are ignored; long texts and lines are scanned whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm import kernels

BUCKETS = 1 << 16
BACKGROUND, PER_DOCUMENT = 400, 10
LEAST, SIMILAR = 0.5, 0.6
FOLDS = 4
UNKNOWN = "unknown"

#: Identifiers, notices and sentences by which these licences are stated or known.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "apache": ("Apache-2.0", "Apache License 2.0"),
    "mit": ("MIT", "MIT License"),
    "gpl": ("GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-3.0-or-later", "GPLv2", "GPLv3", "GNU GPL"),
    "lgpl": ("LGPL-2.1", "LGPL-3.0", "LGPLv2.1", "LGPLv3", "GNU LGPL"),
    "agpl": ("AGPL-3.0", "AGPL-3.0-or-later", "AGPLv3", "GNU AGPL"),
    "bsd": ("BSD-2-Clause", "BSD-3-Clause", "BSD License"),
    "isc": ("ISC", "ISC License"),
    "zlib": ("Zlib", "zlib License"),
    "boost": ("BSL-1.0", "Boost Software License"),
    "mpl": ("MPL-2.0", "Mozilla Public License 2.0"),
    "epl": ("EPL-2.0", "Eclipse Public License 2.0"),
    "artistic": ("Artistic-2.0", "Artistic License 2.0"),
    "unlicense": ("Unlicense", "The Unlicense"),
    "cc0": ("CC0-1.0", "CC0", "CC0 1.0 Universal"),
    "cc-by": ("CC-BY-4.0", "CC BY 4.0", "CC BY 3.0"),
    "cc-by-sa": ("CC-BY-SA-4.0", "CC BY-SA 4.0", "CC BY-SA 3.0"),
    "cc-by-nd": ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    "cc-by-nc": ("CC-BY-NC-4.0", "CC BY-NC 4.0", "CC BY-NC 3.0"),
    "cc-by-nc-sa": ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    "cc-by-nc-nd": ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
}
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "zlib": (
        "Released under the zlib License.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Released under the Mozilla Public License 2.0.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Released under the Eclipse Public License 2.0.",
    ),
    "artistic": (
        "This library is free software; you may redistribute it and/or modify it under the terms of the Artistic License 2.0.",
        "Licensed under the terms of the Artistic License.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nc-sa": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "cc-by-nc-nd": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
}
#: How an identifier is stated; a template for each.
STATEMENTS = ("SPDX-License-Identifier: {}", "Licensed under {}", "License: {}")
TEMPLATES = {f: (*SENTENCES[f], *(s.format(i) for i in ids for s in STATEMENTS)) for f, ids in IDENTIFIERS.items()}
FAMILIES = (*TEMPLATES, UNKNOWN)
#: Bytes between words: ASCII that is no letter, digit, dot or hyphen.
_GAPS = np.array([b < 128 and not (chr(b).isalnum() or chr(b) in ".-") for b in range(256)])


def paragraphs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each paragraph, its line number, first feature, feature hashes, whether a feature is a pair)."""
    words = kernels.Words(texts, lower=True, gaps=_GAPS)
    ends = words.ends.copy()
    # A dot or hyphen that ends a word is punctuation.
    for _ in range(2):
        trim = (ends - words.starts > 1) & np.isin(words.data[np.maximum(ends - 1, 0)], (ord("."), ord("-")))
        ends[trim] -= 1
    h = kernels.span_hashes(words.data, words.starts, ends)
    newlines = np.concatenate([[0], np.cumsum(words.data == 10)])
    line = newlines[words.starts] - newlines[words.offsets[words.doc]]
    new = np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, len(h)))
    which = np.cumsum(new) - 1
    pair_at = np.flatnonzero(~new)
    pairs = kernels.grams(h, 2)[pair_at - 1] if len(pair_at) else np.zeros(0, np.uint64)
    value = np.concatenate([h, pairs])
    owner = np.concatenate([which, which[pair_at]])
    is_pair = np.concatenate([np.zeros(len(h), bool), np.ones(len(pairs), bool)])
    order = np.argsort(owner, kind="stable")
    return words.doc[start], line[start], np.concatenate([[0], np.cumsum(2 * n - 1)]), value[order], is_pair[order]


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that are a paragraph each: first feature, hashes, whether a pair."""
    _, _, first, value, is_pair = paragraphs(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()))
    return first, value, is_pair


class Templates:
    """The pairs of each template, and how much each pair counts."""

    def __init__(self):
        texts, families = zip(*((t, k) for k, ts in enumerate(TEMPLATES.values()) for t in ts), strict=True)
        first, value, is_pair = _features(list(texts))
        self.families = np.array(families)
        self.pairs = [np.unique(value[a:b][is_pair[a:b]]) for a, b in zip(first[:-1], first[1:], strict=True)]
        names, owners = zip(*((i, k) for k, ids in enumerate(IDENTIFIERS.values()) for i in ids), strict=True)
        first, value, is_pair = _features(list(names))
        self.names = {(value[a:b][~is_pair[a:b]].tobytes()): k for a, b, k in zip(first[:-1], first[1:], owners, strict=True)}
        n = len(TEMPLATES)
        known = [(p, f) for pairs, f in zip(self.pairs, families, strict=True) for p in pairs.tolist()]
        holders: dict[int, set[int]] = {}
        for p, f in known:
            holders.setdefault(p, set()).add(f)
        self.weight = {p: np.log(n / len(fs)) + 0.1 for p, fs in holders.items()}
        self.unseen = np.log(n / 0.5) + 0.1
        self.totals = [sum(self.weight[p] for p in pairs.tolist()) for pairs in self.pairs]

    def similarities(self, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """How much of a paragraph stands in the closest template of each family, or of it in the paragraph, by weight."""
        out = np.zeros(len(TEMPLATES))
        if len(words) <= 3:
            # A name alone, or behind a word such as `license`.
            for k in range(len(words)):
                family = self.names.get(words[k:].tobytes())
                if family is not None:
                    out[family] = 1.0
                    return out
        mine = {p: self.weight.get(p, self.unseen) for p in pairs.tolist()}
        total = sum(mine.values())
        for f, template, whole in zip(self.families.tolist(), self.pairs, self.totals, strict=True):
            both = sum(mine[p] for p in template.tolist() if p in mine)
            if both:
                out[f] = max(out[f], both / min(total, whole))
        return out


class Scanner:
    """weights: families x features; feature: the number of each bucket's feature (0: OTHER)."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float, feature: np.ndarray | None = None):
        self.weights, self.bias, self.temperature = weights.astype(np.float32), bias, temperature
        self.feature = np.arange(BUCKETS) if feature is None else feature
        self.templates = Templates()

    def probabilities(self, first: np.ndarray, value: np.ndarray) -> np.ndarray:
        at = self.feature[(value >> np.uint64(48)).astype(np.int64)]
        scale = 1 / np.sqrt(np.maximum(np.diff(first), 1))
        logits = np.stack([kernels.sums(w[at], first) * scale for w in self.weights], 1) + self.bias
        return _softmax(logits / self.temperature)

    def scan(self, texts: pa.Array) -> list[tuple[int, int, str, float, float, bool]]:
        """(text, line, family, probability, similarity, confirmed) of each paragraph that isn't unknown."""
        doc, line, first, value, is_pair = paragraphs(texts)
        if not len(doc):
            return []
        p = self.probabilities(first, value)
        out = []
        for k in np.flatnonzero((p.argmax(axis=1) < len(FAMILIES) - 1) & (p.max(axis=1) >= LEAST)).tolist():
            family, span = int(p[k].argmax()), slice(first[k], first[k + 1])
            alike = self.templates.similarities(value[span][~is_pair[span]], np.unique(value[span][is_pair[span]]))
            sure = alike[family] >= SIMILAR and alike[family] >= alike.max() - 1e-9
            out.append((int(doc[k]), int(line[k]), FAMILIES[family], float(p[k, family]), float(alike[family]), bool(sure)))
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _variants(rng: np.random.Generator) -> tuple[list[str], list[int], list[int]]:
    """Texts, their families, and the template that each is of (-1: none)."""
    texts, labels, groups = [], [], []
    everything = " ".join(t for ts in TEMPLATES.values() for t in ts).split()
    number = 0
    for k, (family, ts) in enumerate(TEMPLATES.items()):
        for text in (*IDENTIFIERS[family], *ts):
            words = text.split()
            for copy in range(12 if len(words) > 6 else 4):
                w = list(words)
                if copy and len(w) > 8 and rng.random() < 0.5:
                    n = int(rng.integers(6, len(w) + 1))
                    a = int(rng.integers(0, len(w) - n + 1))
                    w = w[a : a + n]
                w = [x for x in w if not copy or len(w) < 7 or rng.random() > 0.08]
                if copy and rng.random() < 0.3:
                    w = ["Copyright", str(rng.integers(1995, 2026)), f"Holder{rng.integers(1000)}.", *w]
                texts.append(" ".join(w))
                labels.append(k)
                groups.append(number)
            number += 1
    for _ in range(300):
        texts.append(" ".join(rng.choice(everything, int(rng.integers(4, 20)))))
        labels.append(len(TEMPLATES))
        groups.append(-1)
    return texts, labels, groups


def _optimum(x: np.ndarray, y: np.ndarray, k: int, steps: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Full-batch Adam, every class weighted alike; deterministic."""
    weight = 1 / np.maximum(np.bincount(y, minlength=k), 1)[y] / k
    target = np.eye(k, dtype=np.float32)[y]
    w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for t in range(1, steps + 1):
        g = ((_softmax(x @ w + b) - target) * weight[:, None]).astype(np.float32)
        for i, (p, grad) in enumerate(((w, x.T @ g + l2 * w), (b, g.sum(axis=0)))):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
    return w, b


def fit(texts: list[str], labels: list[int], groups: list[int], steps: int = 120, l2: float = 1e-4) -> Scanner:
    """The temperature from fits that each leave out a part of the templates, with all their variants, and of the other rows; the model from all rows."""
    first, value, _ = _features(texts)
    y, k = np.array(labels), len(FAMILIES)
    bucket = (value >> np.uint64(48)).astype(np.int64)
    row = np.repeat(np.arange(len(y)), np.diff(first))
    feature = np.zeros(BUCKETS, np.int64)
    known = np.unique(bucket[(y < k - 1)[row]])
    feature[known] = np.arange(1, len(known) + 1)
    x = np.zeros((len(y), len(known) + 1), np.float32)
    np.add.at(x, (row, feature[bucket]), (1 / np.sqrt(np.diff(first)))[row])
    group = np.array(groups)
    fold = np.where(group >= 0, group, np.arange(len(y))) % FOLDS
    z = np.zeros((len(y), k))
    for f in range(FOLDS):
        aside = fold == f
        w, b = _optimum(x[~aside], y[~aside], k, steps, l2)
        z[aside] = x[aside] @ w + b
    # Every class weighs alike here too, or the many rows of background, which are easy, would set it.
    share = 1 / np.bincount(y, minlength=k)[y]
    cost = {s: -(share * np.log(np.maximum(_softmax(z / s)[np.arange(len(z)), y], 1e-9))).sum() for s in np.linspace(0.5, 6, 56)}
    temperature = float(min(cost, key=cost.get))
    w, b = _optimum(x, y, k, steps, l2)
    return Scanner(w.T, b, temperature, feature)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", background: int = BACKGROUND) -> Scanner:
    """A scanner whose unknown class is learnt from about `background` documents, chosen by a hash of the id."""
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    n = rows.count()
    share = min(1.0, background / max(1, n))
    chosen = rows.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    # Only lines of up to 1,500 characters reach the driver, PER_DOCUMENT of a document at most, by a hash of their place and text: a bounded training sample.
    keyed = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.xxhash64(F.lit(13), i, x).alias("h"), x.alias("line")))
    some = F.slice(F.array_sort(F.filter(keyed, lambda x: F.length(x["line"]).between(10, 1500))), 1, PER_DOCUMENT)
    lines = chosen.select("id", F.posexplode(some).alias("at", "x")).select("id", "at", "x.line")
    got = [r["line"] for r in lines.orderBy("id", "at", "line").select("line").limit(PER_DOCUMENT * background).collect()]
    templates = Templates()
    texts, labels, groups = _variants(np.random.default_rng(5))
    for line in got:
        first, value, is_pair = _features([line])
        if len(value) and templates.similarities(value[~is_pair], np.unique(value[is_pair])).max() < 0.3:
            texts.append(line)
            labels.append(len(TEMPLATES))
            groups.append(-1)
    return fit(texts, labels, groups)


def _scan(scanner_of):
    names = ("line", "family", "probability", "similarity", "confirmed")
    kinds = (pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in kernels.chunks(batch.column(1)):
                got = scanner_of.value.scan(texts)
                ids = batch.column(0).take(pa.array([at + r[0] for r in got], pa.int64()))
                columns = [pa.array([r[k + 1] for r in got], kind) for k, kind in enumerate(kinds)]
                yield pa.record_batch([ids, *columns], ["id", *names])

    return run


def scan(docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, family, probability, similarity, confirmed) of each paragraph that states a licence."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(scanner)
    kind = f"id {rows.schema['id'].dataType.simpleString()}, line bigint, family string, probability double, similarity double, confirmed boolean"
    return rows.mapInArrow(_scan(held), kind).withColumnRenamed("id", id_col)
