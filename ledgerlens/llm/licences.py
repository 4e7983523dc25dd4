"""Licence scan: a trained paragraph classifier whose predictions a comparison with templates confirms.

Lines are read alone, and the sentences of each paragraph, lines up to the next
blank one without their comment marks. Their word n-grams go into a multinomial logistic
regression over licence families and one class for everything else. It is
trained here, on notices put together from the names and sentences below and on
lines of the corpus at hand; a held-out part of the notices sets the temperature
that makes its probabilities honest.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, bounded_sample, column

UNKNOWN = "unknown"
#: Documents, and most characters of each, whose lines stand for the class of everything else in training.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LINES = 200, 20_000, 1500
LEAST_PROBABILITY = 0.5
#: Part of a sentence's n-grams that a paragraph must have to be confirmed by it.
LEAST_OVERLAP = 0.6
GRAM = 3

# How the licences call themselves, and the sentences they are known by.
NAMES = {
    "apache": ("the apache license, version 2.0", "apache license 2.0", "apache-2.0", "the apache software license"),
    "mit": ("the mit license", "mit license", "the mit licence", "the x11 license", "mit-style license", "spdx-license-identifier: mit"),
    "bsd": ("the bsd license", "bsd 3-clause license", "bsd-2-clause license", "the new bsd license", "bsd-3-clause", "bsd-2-clause"),
    "gpl": ("the gnu general public license, version 3", "gnu general public license version 2", "the gnu gpl", "gpl-3.0-or-later", "gplv2",
            "gpl-3.0", "gpl-2.0", "gplv3", "gnu general public license v3.0", "gnu general public license v2.0", "gnu general public license version 3"),
    "lgpl": ("the gnu lesser general public license", "lgpl-2.1", "the gnu lgpl", "the gnu library general public license", "lgplv3", "lgpl-3.0", "lgpl-2.0"),
    "agpl": ("the gnu affero general public license", "agpl-3.0", "the gnu agpl", "agplv3"),
    "mpl": ("the mozilla public license, version 2.0", "mpl-2.0", "mozilla public license"),
    "isc": ("the isc license", "isc license", "spdx-license-identifier: isc"),
    "epl": ("the eclipse public license", "epl-2.0", "eclipse public license v1.0", "epl-1.0"),
    "cc-by": ("cc by 4.0", "creative commons attribution 4.0 international", "cc-by-4.0", "the creative commons attribution license"),
    "cc-by-sa": ("cc by-sa 4.0", "creative commons attribution-sharealike 4.0", "cc-by-sa-3.0", "cc-by-sa-4.0"),
    "cc-by-nc": ("cc by-nc 4.0", "creative commons attribution-noncommercial 4.0", "cc-by-nc-4.0", "cc by-nc-sa 4.0"),
    "cc0": ("cc0 1.0", "cc0 1.0 universal", "creative commons zero", "cc0-1.0"),
    "unlicense": ("the unlicense", "unlicense"),
}
SENTENCES = {
    "apache": ("you may not use this file except in compliance with the license",
               "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "gpl": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",),
    "lgpl": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",),
    "agpl": ("you can redistribute it and or modify it under the terms of the gnu affero general public license",),
    "mpl": ("this source code form is subject to the terms of the mozilla public license",),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "cc0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}
FRAMES = (
    "licensed under {}", "released under {}", "this work is licensed under {}", "this file is distributed under the terms of {}",
    "{}", "license: {}", "this project is available under {} see the license file", "all code here is covered by {}",
    "spdx-license-identifier: {}", "published under {} by its authors", "this software may be used under {}", "copyright the authors {}",
    "dual licensed under {} and a commercial license", "source code made available to you under {}", "subject to {}", "the text of {} applies",
)
OTHER = (
    "{} is valid for one year", "renew your {} at the office", "a copy of {} was sent", "please read {} before you sign", "{} expired last month",
    "the parties agree on {}", "no {} is needed to enter", "he lost {} on the way", "contact us about {}", "{}",
    "licensed under {}", "released under {}", "distributed under the terms of {}", "this software may be used under {}", "subject to {}", "license: {}",
)
OTHER_NAMES = ("a driver license", "the fishing license", "your software license agreement", "a commercial license", "the business licence",
               "our own license", "the company license version 2.0", "the general terms and conditions", "public transport permits", "the end user agreement")
#: A line without any of these cannot be confirmed: each name and sentence above has one.
ANCHORS = (b"licen", b"copyright", b"gpl", b"apache-", b"mpl-", b"epl-", b"bsd-", b"cc by", b"cc-by", b"cc0", b"creative commons", b"permission",
           b"redistribut", b"public domain")

#: White space and a comment mark in front of a line.
MARKS = re.compile(r"[ \t]*(?:(?:/\*+!?|//+!?|\*+/?|#+|;+|--+|<!--|%+|dnl\b|REM\b)[ \t]*)?")
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)?")


def grams(line: str) -> set[str]:
    """Word n-grams of one to GRAM words; punctuation parts words, a version number is one."""
    words = WORD.findall(line.lower())
    return {" ".join(words[i:i + n]) for n in range(1, GRAM + 1) for i in range(len(words) - n + 1)}


@dataclass
class Classifier:
    families: list[str]
    index: dict[str, int]
    weights: np.ndarray  # a row for each n-gram, a last one for the bias
    temperature: float

    def probabilities(self, line: str) -> np.ndarray:
        rows = [self.index[g] for g in grams(line) if g in self.index]
        z = (self.weights[rows].sum(0) / max(1.0, len(rows) ** 0.5) + self.weights[-1]) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def predict(self, line: str) -> tuple[str, float]:
        p = self.probabilities(line)
        k = int(p.argmax())
        return self.families[k], float(p[k])


def examples(lines: list[str]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Training and held-out (line, family) pairs; every fourth frame is held out."""
    known, held = [], []
    for family, names in NAMES.items():
        for i, frame in enumerate(FRAMES):
            for name in names:
                (held if i % 4 == 3 else known).append((frame.format(name), family))
        for sentence in SENTENCES.get(family, ()):
            words = sentence.split()
            known += [(sentence, family)] * 4 + [(" ".join(words[k:]), family) for k in (1, 2, 3)] + [(" ".join(words[:-k]), family) for k in (1, 2, 3)]
    for i, frame in enumerate(OTHER):
        for name in OTHER_NAMES:
            (held if i % 4 == 3 else known).append((frame.format(name), UNKNOWN))
    for i, line in enumerate(lines):
        (held if i % 4 == 3 else known).append((line, UNKNOWN))
    return known, held


def train(lines: list[str], steps: int = 300, rate: float = 8.0, decay: float = 1e-4) -> Classifier:
    """Full-batch descent on the log loss of all classes, each weighing the same; deterministic."""
    known, held = examples(lines)
    families = [*NAMES, UNKNOWN]
    index: dict[str, int] = {}
    for line, family in known:
        if family != UNKNOWN or any(a in line.lower().encode() for a in ANCHORS):
            for g in sorted(grams(line)):
                index.setdefault(g, len(index))
    rows, cols, values = [], [], []
    for r, (line, _) in enumerate(known):
        own = [index[g] for g in grams(line) if g in index]
        rows += [r] * (len(own) + 1)
        cols += [*own, len(index)]
        values += [1 / max(1.0, len(own) ** 0.5)] * len(own) + [1.0]
    rows, cols, values = np.array(rows), np.array(cols), np.array(values)
    y = np.array([families.index(f) for _, f in known])
    share = 1 / (len(families) * np.bincount(y, minlength=len(families))[y])
    w = np.zeros((len(index) + 1, len(families)))
    speed = np.zeros_like(w)
    for _ in range(steps):
        z = np.zeros((len(known), len(families)))
        np.add.at(z, rows, w[cols] * values[:, None])
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= share[:, None]
        gradient = decay * w
        np.add.at(gradient, cols, p[rows] * values[:, None])
        speed = 0.9 * speed - rate * gradient
        w += speed
    return calibrated(Classifier(families, index, w, 1.0), held)


def calibrated(model: Classifier, held: list[tuple[str, str]]) -> Classifier:
    """The temperature with the least log loss on the held-out pairs."""
    losses = []
    for t in np.geomspace(0.25, 4.0, 17):
        model.temperature = float(t)
        losses.append((-sum(np.log(max(1e-12, model.probabilities(x)[model.families.index(f)])) for x, f in held), float(t)))
    model.temperature = min(losses)[1]
    return model


TEMPLATES = {f: [grams(n) for n in names] for f, names in NAMES.items()}
LONG_TEMPLATES = {f: [grams(s) for s in sentences] for f, sentences in SENTENCES.items()}


def confirmed(line: str, family: str) -> bool:
    """Whether the line holds one of the family's names whole, or most of one of its sentences."""
    own = grams(line)
    return any(t <= own for t in TEMPLATES[family]) or any(len(t & own) >= LEAST_OVERLAP * len(t) for t in LONG_TEMPLATES.get(family, ()))


def scan(model: Classifier, raw: bytes | None) -> list[tuple[str, int, int, float]]:
    """Family, start, end (code points) and probability of each confirmed notice, and of likely ones as unknown.

    Lines are read alone first. Then the sentences of each paragraph of several
    lines are read; a confirmed one takes the place of what its lines gave,
    unless one of them was confirmed as its family by itself.
    """
    if not raw or not any(a in lower for lower in (raw.lower(),) for a in ANCHORS):
        return []
    found: list[tuple[str, int, int, float]] = []
    at, text = 0, raw.decode("utf-8", "replace")
    paragraph: list[tuple[int, str]] = []
    for line in [*text.split("\n"), ""]:
        inner = MARKS.match(line)
        content = line[inner.end():].rstrip()
        if content.endswith(("*/", "-->")):
            content = content.rstrip("*/->").rstrip()
        if content:
            paragraph.append((at + inner.end(), content))
            if anchored(line):
                found += notices(model, windows(line), at)
        else:
            if len(paragraph) > 1:
                found = merged(found, joined(model, paragraph), paragraph[0][0])
            paragraph = []
        at += len(line) + 1
    return found


def anchored(line: str) -> bool:
    low = line.lower().encode()
    return any(a in low for a in ANCHORS)


def notices(model: Classifier, parts: Iterable[tuple[int, str]], at: int) -> Iterator[tuple[str, int, int, float]]:
    for start, part in parts:
        family, p = model.predict(part)
        if family != UNKNOWN and p >= LEAST_PROBABILITY:
            yield family if confirmed(part, family) else UNKNOWN, at + start, at + start + len(part), p


def joined(model: Classifier, lines: list[tuple[int, str]]) -> list[tuple[str, int, int, float]]:
    """Notices in the sentences of a paragraph that reach over several of its lines, at their places in the text."""
    if not any(anchored(x) for _, x in lines):
        return []
    starts = list(accumulate((len(x) + 1 for _, x in lines[:-1]), initial=0))

    def place(k: int) -> int:
        i = bisect_right(starts, k) - 1
        return lines[i][0] + min(k - starts[i], len(lines[i][1]))

    out = []
    for start, part in windows(" ".join(x for _, x in lines), 0):
        lead = len(part) - len(part.lstrip())
        a, b = start + lead, start + len(part.rstrip())
        if bisect_right(starts, a) != bisect_right(starts, b - 1):
            out += [(f, place(a), place(b - 1) + 1, p) for f, _, _, p in notices(model, [(0, part)], 0)]
    return out


def merged(found: list[tuple[str, int, int, float]], more: list[tuple[str, int, int, float]], begin: int) -> list[tuple[str, int, int, float]]:
    """``found`` with the notices of its last paragraph, which starts at ``begin``, put together from lines and sentences."""
    k = len(found)
    while k and found[k - 1][2] > begin:
        k -= 1
    own = found[k:]
    for f, a, b, p in more:
        inside = [r for r in own if r[1] < b and a < r[2]]
        if f == UNKNOWN and inside or any(r[0] == f for r in inside):
            continue
        own = [r for r in own if r not in inside or r[0] != UNKNOWN] + [(f, a, b, p)]
    return found[:k] + sorted(own, key=lambda r: (r[1], r[2]))


def windows(line: str, size: int = 40):
    """The line, or its sentences if it has more than ``size`` words: a notice inside a long line stands out in its sentence."""
    if len(line.split()) <= size:
        yield 0, line
        return
    for m in re.finditer(r"[^.!?]+(?:[.!?]+(?!\s)[^.!?]+)*[.!?]*", line):
        if any(a in m[0].lower().encode() for a in ANCHORS):
            yield m.start(), m[0]


FIELDS = T.StructType([T.StructField("n_licences", T.LongType()), T.StructField("n_unknown", T.LongType()),
                       T.StructField("families", T.StringType()), T.StructField("spans", T.StringType())])


def scanner(model: Classifier):
    def scanned(text: pa.Array) -> pa.Array:
        out = []
        for raw in text.cast(pa.binary()).to_pylist():
            rows = scan(model, raw)
            sure = [r for r in rows if r[0] != UNKNOWN]
            out.append((len(sure), len(rows) - len(sure), ",".join(sorted({r[0] for r in sure})), ",".join(f"{f}:{a}:{b}" for f, a, b, _ in rows)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.StructArray.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], FIELDS.names)

    scanned.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(scanned, FIELDS)


def sampled_lines(df: DataFrame, id_column: str, text_column: str) -> list[str]:
    """Lines without anchors of a bounded sample of documents, by a hash of their id."""
    text = column(text_column)
    short = df.select(column(id_column).alias("id"), text.alias("text")).filter(F.length("text").between(1, SAMPLE_CHARS))
    docs = bounded_sample(short, "id", SAMPLE_DOCS).select("text").collect()
    lines = [x for r in docs for x in r["text"].split("\n") if x.strip() and not any(a in x.lower().encode() for a in ANCHORS)]
    return lines[:SAMPLE_LINES]


def find_licences(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_licences, n_unknown, families, spans as family:start:end.

    ``n_unknown`` counts lines and sentences that read like a notice and match no template.
    Null and empty texts have none. Repeated rows give repeated rows, a null id
    stays null, an empty table gives no rows (and trains on the notices alone);
    further columns are not read.
    """
    bounded_batches(df.sparkSession)
    model = train(sampled_lines(df, id_column, text_column))
    found = df.select(column(id_column).alias("id"), scanner(model)(column(text_column)).alias("f"))
    return found.select(F.col("id").alias(id_column), "f.*")
