"""License scans: a trained paragraph classifier.

A paragraph is a line of the text that holds a word.  One of more than WIDE
words is judged by windows of WIDE words, each half over the next, one of
several sentences by these too.  All windows that confirm a family and do not
overlap are findings; of windows that overlap the best is one.  Features are the
hashes of its 1-, 2- and 3-word runs (ASCII lower case, marks around a word
removed); multinomial logistic regression, trained in numpy, gives each licence
family and the class of no licence a probability.  It learns from the
templates below, in variations (runs cut off, words before and after, words
lost), and from at most ``SAMPLE`` paragraphs of the corpus (lowest hashes)
that share no run with any template, a window out of the first ``line_chars``
characters of each.  For every family the probability that
a paragraph must reach is calibrated on variations that training leaves out;
below it the family is unknown.  A prediction is confirmed only if enough of
the window is the text of a template of the family, some of it in words that
tell the family from other licences, and no template of another family fits it
better.

A paragraph without a confirmed family is still a finding, of the family
``unknown``, if it is a licence statement: a second regression tells licence
from no licence.  It learns from the same paragraphs and from STATEMENTS with
any name; its threshold is calibrated in the same way, and the paragraph has to
hold a licence word or TOLD 3-word runs of statements or templates, or agree
with a template.  The score of such a finding is the probability of a licence.

Defined results: a null or empty text has no paragraph and no finding;
repeated rows each have theirs; a null id stays null; a paragraph may be as
long as it likes; an empty table gives an empty result and still trains on
the templates.  Only the id and the text column are read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from huddle.llm.shared import written
from huddle.llm.text import _LOWER, U64, Words, slices, texts_of

SAMPLE = 3_000
#: Characters of a sampled paragraph out of which training takes a window.
LINE_CHARS = 2_000
BUCKETS = 1 << 16
RUNS = (1, 2, 3)
COPIES = 120
#: Share of a template's 3-word runs, or of the paragraph's, that must agree.
CONFIRM = 0.5
#: Share of a template's runs that no other licence has, or of the paragraph's, that they must have in common.
TELLING = 0.5

# Statements by which texts name their licence.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Released under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 1.0.",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "cc0": ["Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "proprietary": ["All rights reserved.", "Copyright, all rights reserved. No part may be reproduced without permission.", "Unauthorized copying of this file, via any medium, is strictly prohibited."],
}
FAMILIES = ["", *TEMPLATES]
UNKNOWN = "unknown"
WIDE = 24
TOLD = 3
# How licences state themselves, whatever their NAME, and the words that make a line one to look at.
STATEMENTS = [
    "Licensed under the NAME License.",
    "Licensed under the NAME License, Version 2.0; see the file LICENSE for details.",
    "Released under the NAME License.",
    "Distributed under the NAME Public License, version 2.0.",
    "Distributed under the terms of the NAME licence.",
    "This work is licensed under a NAME License.",
    "This Source Code Form is subject to the terms of the NAME Public License, v. 2.0.",
    "If a copy of the NAME was not distributed with this file, you can obtain one at NAME.",
    "This program and the accompanying materials are made available under the terms of the NAME License which accompanies this distribution.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions.",
    "The software is provided as is, without warranty of any kind, express or implied.",
    "You should have received a copy of the NAME License along with this program.",
    "Use of this software is governed by the NAME license agreement.",
    "SPDX-License-Identifier: NAME",
    "NAME License, Version 1.0",
    "License: NAME",
    "Dieses Werk ist lizenziert unter der NAME Lizenz.",
    "Veröffentlicht unter der NAME Lizenz.",
    "Ce document est distribué sous licence NAME.",
    "Publicado bajo la licencia NAME.",
]
LICENCE_WORDS = "license licence licenses licences licensed licenced licensing spdx-license-identifier copyright copyrighted lizenz lizenziert licencia licenciado licenza".split()
_EDGE = np.ones(256, bool)
_EDGE[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = False
_CLOSES, _STOPS, _CAPITAL = (np.zeros(256, bool) for _ in range(3))
_CLOSES[list(b"\"')]")], _STOPS[list(b".!?")] = True, True
_CAPITAL[list(range(65, 91)) + list(range(128, 256))] = True

OUT = "id long, n_paragraphs long, hits array<struct<paragraph:long,family:string,score:double,agreement:double,word:long>>"


class Paragraphs:
    """Runs of the paragraphs of a slice: hash and paragraph of each, words of each paragraph."""

    def __init__(self, column: pa.Array):
        w = Words(column, hashes=False)
        data = _LOWER[w.data]
        start, end = w.start.copy(), w.end.copy()
        opens = np.zeros(len(start), bool)
        if len(start):
            last = np.where(_CLOSES[w.data[end - 1]] & (end - start > 1), end - 2, end - 1)
            for _ in range(3):
                start[(end - start > 1) & _EDGE[data[start]]] += 1
                end[(end - start > 1) & _EDGE[data[end - 1]]] -= 1
            opens[1:] = _STOPS[w.data[last[:-1]]] & _CAPITAL[w.data[start[1:]]]
        size = 1 << 17
        parts = [Words._hash(data, start[i : i + size], end[i : i + size]) for i in range(0, len(start), size)]
        w.hash = np.concatenate(parts) if parts else np.zeros(0, U64)
        breaks = np.flatnonzero(data == 10)
        line = np.searchsorted(breaks, w.start) + w.doc
        new = np.concatenate([[True], (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])]) if len(line) else np.zeros(0, bool)
        self.first = np.flatnonzero(new)
        self.doc = w.doc[self.first]
        # the number of the line in its text
        self.number = np.searchsorted(breaks, w.start[self.first]) - np.searchsorted(breaks, w.offsets[self.doc])
        self.of_word = np.cumsum(new) - 1
        self.sentence = new | opens  # whether a word begins a sentence
        self.words = np.diff(np.append(self.first, len(line)))
        self.n_docs, self.hash = w.n_docs, w.hash
        w.doc = self.of_word  # runs stay inside a paragraph
        self.at = [w.windows(n) for n in RUNS]
        runs = [(w.window_hash(at, n), self.of_word[at]) for n, at in zip(RUNS, self.at, strict=True)]
        self.runs, self.of = (np.concatenate(x) for x in zip(*runs, strict=True))
        self.three = w.window_hash(w.windows(3), 3), self.of_word[w.windows(3)]


class Windows:
    """Windows of the paragraphs, as Paragraphs has its paragraphs: two layers of WIDE words, and the
    sentences of paragraphs that have several, at most WIDE words of each; a paragraph of at most WIDE
    words is its own window.

    ``owner``  the window's paragraph
    ``start``  its first word in the paragraph
    """

    def __init__(self, p: Paragraphs):
        half, n_words = WIDE // 2, len(p.hash)
        place = np.arange(n_words) - np.repeat(p.first, p.words)
        wide = p.words[p.of_word] > WIDE
        several = np.bincount(p.of_word[p.sentence], minlength=len(p.words))[p.of_word] > 1
        in_sentence = np.arange(n_words) - np.maximum.accumulate(np.where(p.sentence, np.arange(n_words), 0))
        # for each layer the words that it covers, and those that begin a window
        layers = [
            (np.ones(n_words, bool), place % WIDE == 0),
            (wide & (place >= half), (place - half) % WIDE == 0),
            (several, in_sentence % WIDE == 0),
        ]
        of, owner, start, base = [], [], [], 0
        for covered, begins in layers:
            begins = covered & begins
            of.append(np.where(covered, base + np.cumsum(begins) - 1, -1))
            owner.append(p.of_word[begins])
            start.append(place[begins])
            base += int(begins.sum())
        self.owner, self.start = np.concatenate(owner), np.concatenate(start)
        self.of_word, self.hash = np.concatenate([x[x >= 0] for x in of]), np.concatenate([p.hash[x >= 0] for x in of])
        self.words = np.bincount(self.of_word, minlength=base)
        runs, done = [], 0
        for n, at in zip(RUNS, p.at, strict=True):
            own = p.runs[done : done + len(at)]
            done += len(at)
            inside = [(x[at] >= 0) & (x[at] == x[at + n - 1]) for x in of]
            runs.append((np.concatenate([own[k] for k in inside]), np.concatenate([x[at][k] for k, x in zip(inside, of, strict=True)])))
        self.runs, self.of = (np.concatenate(x) for x in zip(*runs, strict=True))
        self.three = runs[RUNS.index(3)]


def findings(v: Windows, family: np.ndarray, score: np.ndarray, agreement: np.ndarray, licence: np.ndarray, least: float) -> list[tuple[int, str, float, float, int]]:
    """(paragraph, family, score, agreement, first word), in the order of the text: the windows of a family
    that overlap no better one (by agreement, then the shorter, then by score), then the unknown licences
    that overlap none of them.  Windows of one family that touch are one finding, of the best of them."""
    at = np.flatnonzero((family > 0) | (licence >= least))
    known = family[at] > 0
    sure = np.where(known, score[at], licence[at])
    at = at[np.lexsort((v.start[at], -sure, v.words[at], -np.where(known, agreement[at], sure), ~known, v.owner[at]))]
    taken: dict[int, list[int]] = {}
    for i in at:
        mine, stop = taken.setdefault(int(v.owner[i]), []), v.start[i] + v.words[i]
        if not any(v.start[j] < stop and v.start[i] < v.start[j] + v.words[j] for j in mine):
            mine.append(i)
    out = []
    for own, mine in sorted(taken.items()):
        rank = {i: n for n, i in enumerate(mine)}
        before = None
        for i in sorted(mine, key=lambda i: v.start[i]):
            name = FAMILIES[family[i]] if family[i] else UNKNOWN
            found = (own, name, float(score[i] if family[i] else licence[i]), float(agreement[i]), int(v.start[i]))
            if before is not None and family[before] == family[i] and v.start[before] + v.words[before] == v.start[i]:
                if rank[i] < best:
                    out[-1], best = (*found[:4], out[-1][4]), rank[i]
            else:
                out.append(found)
                best = rank[i]
            before = i
    return out


def features(p: Paragraphs, table: np.ndarray) -> np.ndarray:
    """Sum of the runs' rows of a table, divided by the root of their number."""
    out = np.zeros((len(p.words), table.shape[1]), np.float32)
    rows = (p.runs & U64(BUCKETS - 1)).astype(np.int64)
    count = np.bincount(p.of, minlength=len(out))
    at = 0
    for n in RUNS:  # runs of one length lie in paragraph order
        k = int(np.maximum(p.words - n + 1, 0).sum())
        of, values = p.of[at : at + k], table[rows[at : at + k]]
        if k:
            begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            out[of[begin]] += np.add.reduceat(values, begin, axis=0)
        at += k
    return out / np.sqrt(np.maximum(count, 1))[:, None]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _paragraphs(texts: list[str]) -> Paragraphs:
    return Paragraphs(texts_of(pa.array([" ".join(t.split()) or "." for t in texts], pa.string())))


class Classifier:
    def __init__(self, classes: int = len(FAMILIES)):
        self.weight = np.zeros((BUCKETS, classes), np.float32)
        self.offset = np.zeros(classes, np.float32)
        self.least = np.full(classes, 0.5)
        known = _paragraphs([t for ts in TEMPLATES.values() for t in ts])
        family = np.repeat(np.arange(1, len(FAMILIES)), [len(ts) for ts in TEMPLATES.values()])
        self.template_runs, self.template_of = known.three
        self.family_of = family
        # whether a paragraph is a licence at all: the weights of a classifier of two classes
        self.any_weight, self.any_offset, self.any_least = np.zeros((BUCKETS, 2), np.float32), np.zeros(2, np.float32), 0.5
        stated = _paragraphs(STATEMENTS)
        # by family the runs of its templates that neither another family's nor the statements of any licence have
        others = [np.union1d(self.template_runs[family[self.template_of] != f], stated.three[0]) for f in range(len(FAMILIES))]
        self.telling = [np.setdiff1d(self.template_runs[family[self.template_of] == f], others[f]) for f in range(len(FAMILIES))]
        self.stated_runs = np.union1d(stated.three[0], self.template_runs)
        self.licence_words = np.sort(_paragraphs(LICENCE_WORDS).hash)

    def probability(self, p: Paragraphs) -> np.ndarray:
        return _softmax((features(p, self.weight) + self.offset).astype(float))

    def speaks(self, p: Paragraphs) -> np.ndarray:
        """Whether a paragraph holds a licence word or TOLD 3-word runs of statements and templates."""
        runs, of = p.three
        known = np.bincount(of[np.isin(runs, self.stated_runs)], minlength=len(p.words))
        return (known >= TOLD) | (np.bincount(p.of_word[np.isin(p.hash, self.licence_words)], minlength=len(p.words)) > 0)

    def licence(self, p: Paragraphs, agrees: np.ndarray | bool = False) -> np.ndarray:
        """The probability that a paragraph is a licence statement; 0 if it neither speaks like one nor agrees with a template."""
        return np.where(self.speaks(p) | agrees, _softmax((features(p, self.any_weight) + self.any_offset).astype(float))[:, 1], 0.0)

    def shares(self, p: Paragraphs, some: np.ndarray) -> np.ndarray:
        """For ``some`` paragraphs (whether or not) and each family, the largest share of a template of the
        family, or of the paragraph, that their common 3-word runs make up; 0 for the others, and for
        templates of whose runs that tell the family from other licences too few are there."""
        out = np.zeros((len(p.words), len(FAMILIES)))
        runs, of = p.three
        keep = some[of]
        runs, of = runs[keep], of[keep]
        order = np.lexsort((runs, of))
        runs, of = runs[order], of[order]
        once = np.concatenate([[True], (runs[1:] != runs[:-1]) | (of[1:] != of[:-1])]) if len(runs) else np.zeros(0, bool)
        runs, of = runs[once], of[once]
        own = np.bincount(of, minlength=len(out))
        known = np.isin(runs, self.template_runs)
        runs, of = runs[known], of[known]
        for t, f in enumerate(self.family_of):
            mine = np.unique(self.template_runs[self.template_of == t])
            common = np.bincount(of[np.isin(runs, mine)], minlength=len(out))
            telling = mine[np.isin(mine, self.telling[f])]
            told = np.bincount(of[np.isin(runs, telling)], minlength=len(out))
            told = np.maximum(told / max(1, len(telling)), told / np.maximum(own, 1)) >= TELLING
            out[:, f] = np.maximum(out[:, f], told * np.maximum(common / max(1, len(mine)), common / np.maximum(own, 1)))
        return out

    def fit(self, texts: list[str], label: np.ndarray, epochs: int = 25, rate: float = 0.5, batch: int = 64, seed: int = 3):
        rng = np.random.default_rng(seed)
        p = _paragraphs(texts)
        order = np.argsort(p.of, kind="stable")
        rows, of = (p.runs[order] & U64(BUCKETS - 1)).astype(np.int64), p.of[order]
        ends = np.searchsorted(of, np.arange(len(texts) + 1))
        speed = np.full(self.weight.shape, 1e-4, np.float32)
        one = np.eye(len(self.offset), dtype=np.float32)
        for _ in range(epochs):
            turn = rng.permutation(len(texts))
            for lo in range(0, len(turn), batch):
                some = turn[lo : lo + batch]
                idx = np.concatenate([rows[ends[i] : ends[i + 1]] for i in some])
                n = np.array([ends[i + 1] - ends[i] for i in some])
                doc = np.repeat(np.arange(len(some)), n)
                scale = (1 / np.sqrt(np.maximum(n, 1))).astype(np.float32)
                z = np.zeros((len(some), len(self.offset)), np.float32)
                np.add.at(z, doc, self.weight[idx])
                error = (_softmax(z * scale[:, None] + self.offset) - one[label[some]]) / len(some)
                u, inverse = np.unique(idx, return_inverse=True)
                grad = np.zeros((len(u), len(self.offset)), np.float32)
                np.add.at(grad, inverse, (error * scale[:, None])[doc])
                grad += 1e-5 * self.weight[u]
                speed[u] += grad**2
                self.weight[u] -= rate * grad / np.sqrt(speed[u])
                self.offset -= 0.05 * error.sum(axis=0)

    def calibrate(self, texts: list[str], label: np.ndarray):
        """The least probability of each family above which at most 1 in 100 is another class."""
        prob = self.probability(_paragraphs(texts))
        predicted = prob.argmax(axis=1)
        for f in range(1, len(FAMILIES)):
            own = np.flatnonzero(predicted == f)
            wrong = np.sort(prob[own, f][label[own] != f])
            allowed = len(own) // 100
            self.least[f] = max(0.5, float(wrong[-1 - allowed]) + 1e-9 if len(wrong) > allowed else 0.5)


def variations(corpus: list[str], copies: int = COPIES, seed: int = 3) -> tuple[list[str], np.ndarray]:
    """Training paragraphs and their class."""
    rng = np.random.default_rng(seed)
    fill = [w for t in corpus for w in t.split()[:12]] or ["some", "other", "words"]
    texts, label = [], []
    for f, statements in enumerate(TEMPLATES.values(), 1):
        for statement in statements:
            words = statement.split()
            for c in range(copies):
                own = list(words)
                if c % 4 == 1 and len(own) > 8:
                    cut = int(rng.integers(0, len(own) // 3 + 1))
                    own = own[cut:] if rng.random() < 0.5 else own[: len(own) - cut]
                if c % 4 == 2 and len(own) > 6:
                    own.pop(int(rng.integers(0, len(own))))
                if c % 4 == 3:  # somewhere in a window of a long line
                    room = int(rng.integers(0, max(0, WIDE - len(own)) + 1))
                    lead, around = int(rng.integers(0, room + 1)), [fill[i] for i in rng.integers(0, len(fill), room)]
                    own = around[:lead] + own + around[lead:]
                elif c % 2:
                    pick = lambda most: [fill[i] for i in rng.integers(0, len(fill), int(rng.integers(0, most)))]
                    own = pick(8) + own + pick(8)
                texts.append(" ".join(own))
                label.append(f)
    texts += corpus
    label += [0] * len(corpus)
    for _ in range(copies * 4):  # ordinary words in the templates' manner
        texts.append(" ".join(fill[i] for i in rng.integers(0, len(fill), int(rng.integers(2, WIDE + 1)))))
        label.append(0)
    return texts, np.array(label)


def statements(corpus: list[str], copies: int = COPIES, seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Training paragraphs of licence (1) or none (0): STATEMENTS under many names, and ordinary words with one licence word."""
    rng = np.random.default_rng(seed)
    fill = [w for t in corpus for w in t.split()[:12]] or ["some", "other", "words"]
    some = lambda least, most: [fill[i] for i in rng.integers(0, len(fill), int(rng.integers(least, most)))]
    texts, label = [], []
    for statement in STATEMENTS:
        for c in range(copies):
            name = "".join(chr(65 + i) for i in rng.integers(0, 26, int(rng.integers(2, 5)))) + ("-2.0" if c % 4 == 1 else "") if c % 2 else " ".join(some(1, 4))
            own = statement.replace("NAME", name).split()
            if c % 3 == 1 and len(own) > 8:
                cut = int(rng.integers(0, len(own) // 3 + 1))
                own = own[cut:] if rng.random() < 0.5 else own[: len(own) - cut]
            if c % 3 == 2:
                lead, around = int(rng.integers(0, WIDE)), some(0, max(0, WIDE - len(own)) + 1) if c % 2 else some(0, 16)
                own = around[:lead] + own + around[lead:]
            texts.append(" ".join(own))
            label.append(1)
    for _ in range(copies * 8):
        texts.append(" ".join([*some(1, 12), LICENCE_WORDS[int(rng.integers(0, len(LICENCE_WORDS)))], *some(1, 12)]))
        label.append(0)
    return texts, np.array(label)


def train_classifier(corpus: list[str]) -> Classifier:
    model = Classifier()
    rng = np.random.default_rng(7)
    lines = [t.split() for t in corpus if t.split()]
    at = [int(rng.integers(0, max(0, len(w) - WIDE) + 1)) for w in lines]
    corpus = [" ".join(w[i : i + WIDE]) for w, i in zip(lines, at, strict=True)]
    if corpus:
        p = _paragraphs(corpus)
        runs, of = p.three
        near = np.bincount(of[np.isin(runs, model.template_runs)], minlength=len(corpus))
        corpus = [t for t, n in zip(corpus, near, strict=True) if not n]
    texts, label = variations(corpus)
    # what a variation has lost may leave another family's words, or any licence's: no example of either
    share = model.shares(_paragraphs(texts), label > 0)
    own = (label == 0) | ((share[np.arange(len(label)), label] > 0) & (share[np.arange(len(label)), label] >= share.max(axis=1)))
    texts, label = [t for t, k in zip(texts, own, strict=True) if k], label[own]
    aside = np.arange(len(texts)) % 5 == 0
    learn = np.flatnonzero(~aside)
    model.fit([texts[i] for i in learn], label[learn])
    model.calibrate([texts[i] for i in np.flatnonzero(aside)], label[aside])
    # Licence or none.  A paragraph of the corpus that speaks like a licence without a template is no example of none.
    more, of_more = statements(corpus)
    keep = np.flatnonzero((label > 0) | ~model.speaks(_paragraphs(texts)))
    texts, label = [texts[i] for i in keep] + more, np.concatenate([label[keep] > 0, of_more]).astype(int)
    aside = np.arange(len(texts)) % 5 == 0
    learn = np.flatnonzero(~aside)
    two = Classifier(2)
    two.fit([texts[i] for i in learn], label[learn])
    model.any_weight, model.any_offset = two.weight, two.offset
    prob, truth = model.licence(_paragraphs([texts[i] for i in np.flatnonzero(aside)])), label[aside]
    wrong = np.sort(prob[(truth == 0) & (prob >= 0.5)])
    allowed = int((prob >= 0.5).sum()) // 100
    model.any_least = max(0.5, float(wrong[-1 - allowed]) + 1e-9 if len(wrong) > allowed else 0.5)
    return model


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, confirm: float = CONFIRM, line_chars: int = LINE_CHARS) -> DataFrame:
    """id, n_paragraphs, hits (paragraph, family or ``unknown``, score, agreement, first word) of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # a bounded sample of paragraphs: one line, chosen by hash, of the documents with the lowest hashes
    chosen = docs.where("text is not null and id is not null").select("id", F.xxhash64(F.lit(3), "id").alias("h"), F.split("text", "\n").alias("l"))
    chosen = chosen.select("id", "h", F.element_at("l", (F.pmod("h", F.size("l")) + 1).cast("int")).alias("line")).select("id", "h", F.substring("line", 1, line_chars).alias("line"))
    chosen = written(chosen.orderBy("h", "id", "line").limit(sample).withColumn("all", F.lit(0)), "licences-sample")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "line"])
        return pd.DataFrame({"model": [pickle.dumps(vars(train_classifier(list(rows["line"]))))]})

    bare = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("h"), F.lit("").alias("line"), F.lit(0).alias("all"))
    state = written(chosen.unionByName(bare).groupBy("all").applyInPandas(train, "model binary"), "licences-model").first()["model"]
    state = bytes(state)

    def run(batches):
        model = Classifier.__new__(Classifier)
        vars(model).update(pickle.loads(state))
        kind = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("score", pa.float64()), ("agreement", pa.float64()), ("word", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                p = Paragraphs(texts_of(part.column("text")))
                hits = [[] for _ in range(p.n_docs)]
                if len(p.words):
                    v = Windows(p)
                    prob = model.probability(v)
                    licence, speaks = model.licence(v, True), model.speaks(v)
                    # where the other regression tells a licence, the likeliest family among licences
                    among = (prob[:, 0] >= prob[:, 1:].max(axis=1)) & speaks & (licence >= model.any_least)
                    prob[among, 0] = 0
                    prob[among] /= prob[among].sum(axis=1, keepdims=True)
                    predicted = prob.argmax(axis=1)
                    score = prob[np.arange(len(prob)), predicted]
                    share = model.shares(v, predicted > 0)
                    agreement = share[np.arange(len(prob)), predicted]
                    # confirmed by a template of the family that no other family's fits better
                    agrees = (predicted > 0) & (agreement >= confirm) & (agreement >= share.max(axis=1))
                    family = np.where(agrees & (score >= model.least[predicted]), predicted, 0)
                    for i, name, sure, agreed, word in findings(v, family, score, agreement, np.where(speaks | agrees, licence, 0.0), model.any_least):
                        hits[p.doc[i]].append({"paragraph": int(p.number[i]), "family": name, "score": sure, "agreement": agreed, "word": word})
                count = np.bincount(p.doc, minlength=p.n_docs).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(count), pa.array(hits, kind)], names=["id", "n_paragraphs", "hits"])

    return docs.mapInArrow(run, OUT)
