"""Licence scan: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of non-blank lines. It is judged by its lines and, since
notices are wrapped and broken off anywhere, by its runs of ``WINDOW`` lines
(each begins in the middle of the one before): what is found in any of them is
found in the paragraph. The features are word one- to three-grams, present or
not. A multinomial logistic regression (Spark ML) tells the licence families
and the class ``unknown`` apart. It is trained on licence notices (phrases x
names, standard notices and whole short licences, below), worn by a fixed
generator: words dropped, replaced and surrounded by words of the corpus; and,
as unknown, on at most ``MAX_UNKNOWN`` whole paragraphs of the corpus (by the
smallest hash) and on broken notices. All copies of a fifth of the templates
are held back, so that one temperature calibrates the probabilities on notices
that the fit has not seen. A family stands if its calibrated probability is at
least one half, and if at least ``MIN_TEMPLATE`` of the word pairs of one of the
family's templates stand in the lines.

N-grams that no notice has carry no weight, so the model that travels to the
executors is as large as the notices. Texts are judged where they are, whole.

Defined results: null, empty and blank texts have no paragraphs and no
licence; a text with several families lists each once, in the order of the
alphabet, the most probable one being its licence (ties: the first in order);
equal texts get equal results; an empty table gives an empty table, and the
model is then trained without corpus paragraphs.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, packed, table

UNKNOWN = "unknown"
MAX_UNKNOWN = 2_000
MAX_UNKNOWN_CHARS = 4_000_000
MIN_TEMPLATE = 0.6
WORN_COPIES = 6
#: Lines of a paragraph that are judged together.
WINDOW = 8

#: Names of the licence families.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License version 3", "AGPL-3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution license"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero license"],
    "EPL": ["Eclipse Public License", "Eclipse Public License 2.0", "EPL-2.0"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License v2.0", "GPL-3.0", "GPLv2"],
    "ISC": ["ISC License"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "LGPL-2.1"],
    "MIT": ["MIT License", "MIT license terms", "Expat License"],
    "MPL": ["Mozilla Public License, version 2.0", "Mozilla Public License", "MPL-2.0"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "Zlib": ["zlib License", "zlib/libpng license"],
}
#: Phrases that name a licence.
PHRASES = ["licensed under the {}", "licensed under {}", "released under the {}", "this work is licensed under the {}",
           "distributed under the terms of the {}", "this software is available under the {}", "license {}",
           "spdx license identifier {}", "published under a {}"]
#: Beginnings of standard notices.
NOTICES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
            "in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
            "from this software without specific prior written permission."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
                  "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
             "and redistribute it freely, subject to the following restrictions",
             "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "AGPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work"],
}
#: Sentences near the subject that name no licence.
NEAR_MISSES = ["all rights reserved", "the license was lost", "a driving license is required", "terms and conditions apply",
               "the apache helicopter landed", "she studied at MIT", "public school version 3", "the general public was informed",
               "released in version 2.0", "this work is under review", "copyright notice", "under the terms of the contract",
               "the commons are open to the public", "creative work for everyone", "version 3 of the document",
               "this software is available for download", "distributed to the members"]

_WORD = re.compile(r"[^\W_]+(?:[.+][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngrams(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)}


def templates() -> list[tuple[str, list[str]]]:
    out = [(family, words_of(p.format(n))) for family, names in NAMES.items() for n in names for p in PHRASES]
    return out + [(family, words_of(t)) for family, ts in NOTICES.items() for t in ts]


def held_back(seed: int) -> set[int]:
    """The numbers of a fifth of the templates, with all that hold or are held
    by one of them; every family keeps some to fit."""
    split, known = random.Random(seed), templates()
    texts = [f" {' '.join(w)} " for _, w in known]
    group = list(range(len(known)))
    for i, (family, _) in enumerate(known):
        for j in range(i):
            if known[j][0] == family and (texts[i] in texts[j] or texts[j] in texts[i]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    held: set[int] = set()
    for family in sorted(NAMES):
        own = sorted({group[i] for i, (f, _) in enumerate(known) if f == family})
        split.shuffle(own)
        held.update(i for i, g in enumerate(group) if g in own[:max(1, len(own) // 5)] and len(own) > 1)
    return held


def training_rows(corpus: list[str], seed: int = 5) -> list[tuple[str, list[str], bool]]:
    """(class, n-grams, held back) from the notices and corpus paragraphs."""
    rng = random.Random(seed)
    pool = [w for p in corpus for w in words_of(p)] or ["text"]
    pick = lambda n: [rng.choice(pool) for _ in range(n)]
    rows, of = [], []                                # of: the template a row is a copy of
    for no, (family, words) in enumerate(templates()):
        name = {w for n in NAMES[family] for w in words_of(n)}
        for _ in range(WORN_COPIES):
            worn = [w for w in words if w in name or rng.random() > 0.1]
            worn = [w if w in name or rng.random() > 0.05 else pick(1)[0] for w in worn]
            around = rng.choice((0, 0, 3, 30))
            rows.append((family, pick(around) + worn + pick(around)))
            of.append(no)
        broken = list(words)
        rng.shuffle(broken)
        rows.append((UNKNOWN, broken[:max(1, len(words) // 3)] + pick(5)))
        of.append(no)
    rows += [(UNKNOWN, words_of(s) + pick(rng.choice((0, 5, 20)))) for s in NEAR_MISSES for _ in range(10)]
    known = [set(zip(t, t[1:], strict=False)) for _, t in templates()]
    for p in corpus:
        words = words_of(p)
        pairs = set(zip(words, words[1:], strict=False))
        if not any(k and len(k & pairs) >= 0.4 * len(k) for k in known):      # a licence notice is no example of unknown
            rows.append((UNKNOWN, words))
    split, held = random.Random(seed + 1), held_back(seed)
    return [(c, sorted(ngrams(w)), of[i] in held if i < len(of) else split.random() < 0.2) for i, (c, w) in enumerate(rows)]


class LicenseModel:
    """Weights of the notices' n-grams per class, and the temperature."""

    def __init__(self, classes, vocabulary, weights, bias):
        self.classes, self.vocabulary, self.weights, self.bias = classes, vocabulary, weights, bias
        self.temperature = 1.0
        self.templates: dict[str, list[set]] = {}
        for family, words in templates():
            self.templates.setdefault(family, []).append(set(zip(words, words[1:], strict=False)) or {(words[0], "")})

    def margins(self, grams) -> np.ndarray:
        at = [i for g in grams if (i := self.vocabulary.get(g)) is not None]
        return self.bias + (self.weights[at].sum(axis=0) if at else 0.0)

    def probabilities(self, grams) -> np.ndarray:
        z = self.margins(grams) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def calibrate(self, held) -> None:
        """The temperature of least log loss on the rows held back."""
        z = np.array([self.margins(g) for _, g in held])
        y = np.array([self.classes.index(c) for c, _ in held])

        def loss(t):
            s = z / t
            s = s - s.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

        self.temperature = min(np.geomspace(0.2, 10, 60), key=loss)

    def _known(self, words: list[str]) -> set[str]:
        """The n-grams that a notice has; all words of such a one are known."""
        known, last, out = self.vocabulary, len(words), set()
        for i, w in enumerate(words):
            if w in known:
                out.add(w)
                if i + 1 < last and (pair := f"{w} {words[i + 1]}") in known:
                    out.add(pair)
                    if i + 2 < last and (three := f"{pair} {words[i + 2]}") in known:
                        out.add(three)
        return out

    def paragraph(self, line: str) -> tuple[str, float, float] | None:
        """(family, probability, template share) of a confirmed paragraph."""
        words = words_of(line)
        grams = self._known(words)
        if not grams:
            return None
        p = self.probabilities(grams)
        best = int(p.argmax())
        family = self.classes[best]
        if family == UNKNOWN or p[best] < 0.5:
            return None
        pairs = set(zip(words, words[1:], strict=False)) | {(w, "") for w in words}
        share = max(len(t & pairs) / len(t) for t in self.templates[family])
        return (family, float(p[best]), share) if share >= MIN_TEMPLATE else None


def paragraphs_of(text: str) -> list[list[str]]:
    """The runs of non-blank lines of a text."""
    out: list[list[str]] = [[]]
    for line in text.split("\n"):
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def judge_paragraph(model: LicenseModel, lines: list[str]) -> list[tuple[str, float, float]]:
    """The best finding per family of a paragraph's lines and runs of lines."""
    found: dict[str, tuple[str, float, float]] = {}
    step = WINDOW // 2
    runs = [" ".join(lines[i:i + WINDOW]) for i in range(0, max(1, len(lines) - step), step)] if len(lines) > 1 else []
    for hit in map(model.paragraph, [*lines, *runs]):
        if hit and (hit[0] not in found or hit[1:] > found[hit[0]][1:]):
            found[hit[0]] = hit
    return list(found.values())


def train(spark: SparkSession, corpus: list[str]) -> LicenseModel:
    rows = training_rows(corpus)
    classes = [UNKNOWN, *sorted(NAMES)]
    data = spark.createDataFrame([(float(classes.index(c)), g) for c, g, held in rows if not held and g],
                                 "label double, grams array<string>").coalesce(1)
    of_notices = sorted({g for c, gs, held in rows if c != UNKNOWN and not held for g in gs}
                        & {g for _, w in templates() for g in ngrams(w)})
    counted = CountVectorizerModel.from_vocabulary(of_notices, inputCol="grams", outputCol="features").setBinary(True)
    fitted = LogisticRegression(family="multinomial", regParam=2e-4, maxIter=60).fit(counted.transform(data))
    model = LicenseModel(classes, {g: i for i, g in enumerate(of_notices)},
                         fitted.coefficientMatrix.toArray().T.copy(), fitted.interceptVector.toArray())
    model.calibrate([(c, g) for c, g, held in rows if held])
    return model


def corpus_paragraphs(docs: DataFrame, text_col: str = "text", most: int = MAX_UNKNOWN) -> list[str]:
    """At most ``most`` different whole paragraphs of at most MAX_UNKNOWN_CHARS
    characters in all, by the smallest hash (one that does not fit is passed
    over); the different texts with the smallest hashes are enough to choose from."""
    hashed = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    # the limit sorts different hashes alone; no text goes to its one task
    last = hashed.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if last is None:
        return []
    lines = materialize(hashed.where(F.col("h") <= last).dropDuplicates(["h"])
                        .select(F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> ''").distinct()
                        .select("line", F.xxhash64("line").alias("k")), "license-lines")
    chosen, left = [], MAX_UNKNOWN_CHARS
    for r in lines.select("k", F.length("line").alias("n")).orderBy("k").limit(most).collect():
        if r["n"] <= left:
            chosen.append(r["k"])
            left -= r["n"]
    return [r["line"] for r in lines.where(F.col("k").isin(chosen)).orderBy("k", "line").collect()]


FOUND = "n_paragraphs long, n_license_paragraphs long, licenses array<string>, license string, probability double, template_share double"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, fields of FOUND) of every row."""
    spark = docs.sparkSession
    rows = packed(docs, id_col, text_col)
    model = spark.sparkContext.broadcast(train(spark, corpus_paragraphs(rows)))
    names = [c.split()[0] for c in FOUND.split(", ")]

    @F.pandas_udf(f"struct<{FOUND.replace(' ', ':').replace(',:', ',')}>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        own = model.value
        out = []
        for text in texts:
            found = [judge_paragraph(own, lines) for lines in paragraphs_of(text or "")]
            hits = [h for hs in found for h in hs]
            best = max(hits, key=lambda h: (h[1], [-ord(c) for c in h[0]]), default=(None, None, None))
            out.append((len(found), sum(map(bool, found)), sorted({h[0] for h in hits}), best[0], best[1], best[2]))
        return pd.DataFrame(out, columns=names)

    return rows.select("row", "id", scan(F.col("text")).alias("v")).select("row", "id", "v.*")


def op2_license(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("row").withColumnRenamed("id", "doc_id")
