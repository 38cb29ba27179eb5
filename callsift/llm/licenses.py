"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are the lines of a text; long ones are cut into overlapping windows of words. A window is
known by the word uni- and bigrams that it shares with the templates, and a multinomial logistic
regression weighs each licence family against ``unknown``, so that a line may hold several. All windows
of the corpus are the unknown class, those alike as one weighted row. A family counts only above its
threshold, set on all windows of the corpus, and a finding is confirmed when it shares enough bigrams
with one of the family's templates, and with none of a sibling more.
The main path is DataFrame functions and Spark ML stages throughout.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from callsift.session import written

UNKNOWN = "unknown"

# Names, notices and paragraphs of the licences as their publishers word them.

#: How a licence is named; a name of three words or more also confirms a finding.
NAMES: Mapping[str, tuple[str, ...]] = {
    "agpl": ("GNU Affero General Public License", "Affero GPL", "AGPL 3.0"),
    "apache": ("the Apache License", "Apache License, Version 2.0", "Apache 2.0 license"),
    "bsd": ("the BSD License", "BSD 3-Clause License", "BSD 2-Clause License"),
    "cc_by": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "cc_by_nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "cc_by_sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "epl": ("Eclipse Public License", "EPL 2.0"),
    "gpl": ("GNU General Public License", "GNU GPL", "GPL 3.0"),
    "isc": ("the ISC License", "ISC licence"),
    "lgpl": ("GNU Lesser General Public License", "GNU Library General Public License", "LGPL 2.1"),
    "mit": ("the MIT License", "MIT licence", "MIT/X11 License"),
    "mpl": ("Mozilla Public License", "MPL 2.0"),
    "unlicense": ("the Unlicense", "Unlicense terms"),
}

#: Sentences that a name stands in.
FRAMES = (
    "Licensed under {}.", "Released under {}.", "This project is distributed under {}.",
    "The code is available under the terms of {}.", "License: {}", "See the file LICENSE, {}.",
    "You may use this work under {} or any later version.", "Dual-licensed under {} or {}.",
)

#: Notices and paragraphs of each family.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc_by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc_by_nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc_by_sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "SPDX-License-Identifier: ISC",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ),
    "public_domain": (
        "Released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
}

#: Families whose notices differ by a word or two: of these only the closest is confirmed.
SIBLINGS = (
    ("agpl", "gpl", "lgpl"), ("cc_by", "cc_by_nc", "cc_by_sa"), ("bsd", "isc", "mit"), ("public_domain", "unlicense"),
)


@dataclass(frozen=True)
class Shape:
    """Windows of ``window`` words start every ``stride`` words. All unknown windows together weigh as
    much as ``negatives`` / 2 of them, and a template set into corpus windows as much as ``mixed``."""

    window: int = 60
    stride: int = 40
    negatives: int = 4000
    mixed: int = 50
    min_overlap: float = 0.6
    error: float = 0.001


def words_of(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits; a run of others parts them."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def bigrams(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)
    )


def paragraphs(docs: DataFrame, shape: Shape, text: str = "text") -> DataFrame:
    """``docs`` without its text, one row per window: ``line, start, words``; runs in the row."""
    rest = [c for c in docs.columns if c not in (text, "line", "start", "words", "_line", "_words", "_k")]
    lines = docs.select(*rest, F.posexplode(F.split(text, "\n")).alias("line", "_line"))
    lines = lines.select(*rest, "line", words_of(F.col("_line")).alias("_words"))
    last = F.ceil((F.greatest(F.size("_words") - shape.window, F.lit(0))) / shape.stride).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last), lambda k: F.slice("_words", k * shape.stride + 1, F.lit(shape.window))
    )
    # No filter on the size: it would be moved below, and the words be cut out twice.
    some = F.posexplode(F.when(F.size("_words") > 0, cut)).alias("_k", "words")
    return lines.select(*rest, "line", some).select(
        *rest, "line", (F.col("_k") * shape.stride).alias("start"), "words"
    )


def overlap(pairs: Column, own: Column, template: str) -> Column:
    """Shared bigrams as a share of the template's or of the window's ``own``, whichever is more; 0 below two.

    ``pairs`` are the window's distinct bigrams that any template has; a null ``own`` is left out."""
    from_template = _bigrams(template)
    both = F.size(F.filter(pairs, lambda g: g.isin(from_template)))
    share = F.greatest(both / F.lit(max(len(from_template), 1)), both / own)
    return F.when(both >= 2, share).otherwise(F.lit(0.0))


def _words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _bigrams(text: str) -> list[str]:
    words = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def vocabulary(templates: Mapping[str, Sequence[str]], names: Mapping[str, Sequence[str]]) -> list[str]:
    """All bigrams of the templates and of the names in sentences, and their words but for stop words."""
    stated = [frame.format(n, n) for f in templates for n in names.get(f, ()) for frame in FRAMES]
    grams = {g for t in (*(t for ts in templates.values() for t in ts), *stated) for g in _grams(_words(t))}
    return sorted(grams - set(StopWordsRemover.loadDefaultStopWords("english")))


def _grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def marked(docs: DataFrame, grams: Sequence[str], shape: Shape, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, line, key, own)`` for each window: the ``grams`` in it, sorted and joined, and, if two or
    more are bigrams, how many distinct bigrams it has."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    single, double = [g for g in grams if " " not in g], [g for g in grams if " " in g]
    parts = sorted({w for g in double for w in g.split()})
    windows = paragraphs(rows, shape).withColumn("_known", F.transform("words", lambda w: F.when(w.isin(parts), w)))
    pairs = F.transform(
        "_known", lambda w, k: F.when(w.isNotNull(), F.concat(w, F.lit(" "), F.get("_known", k + 1)))
    )
    found = F.concat(F.filter("words", lambda w: w.isin(single)), F.filter(pairs, lambda g: g.isin(double)))
    windows = windows.withColumn("key", F.array_join(F.sort_array(F.array_distinct(found)), ","))
    own = F.when(_n_pairs(F.col("key")) >= 2, F.size(F.array_distinct(bigrams(F.col("words")))))
    return windows.select("doc_id", "line", "key", own.alias("own"))


def _n_pairs(key: Column) -> Column:
    """Bigrams in a key: each has one space."""
    return F.length(key) - F.length(F.translate(key, " ", ""))


def _pairs(key: Column) -> Column:
    return F.filter(F.split(key, ","), lambda g: g.contains(" "))


@dataclass(frozen=True)
class Model:
    """``thresholds`` has one for each family, of its odds against the unknown class."""

    families: tuple[str, ...]
    counting: CountVectorizerModel
    regression: LogisticRegressionModel
    thresholds: tuple[float, ...]
    templates: Mapping[str, Sequence[str]]


def _scored(
    windows: DataFrame, counting: CountVectorizerModel, regression: LogisticRegressionModel, n: int
) -> DataFrame:
    """``windows`` with ``_odds``: of each family its probability against that of the unknown class, the
    last one, alone. So two families in one window do not take from each other."""
    grams = windows.withColumn("_grams", F.split("key", ","))
    out = regression.transform(counting.transform(grams)).withColumn("_all", vector_to_array("_probability"))
    none = F.element_at("_all", n + 1)
    odds = F.transform(F.slice("_all", 1, n), lambda p: p / F.greatest(p + none, F.lit(1e-300)))
    kept = out.withColumn("_odds", odds)
    return kept.drop("_grams", "_features", "_raw", "_probability", "_predicted", "_all")


def examples(
    templates: Mapping[str, Sequence[str]], names: Mapping[str, Sequence[str]], shape: Shape, rng: random.Random
) -> list[tuple[list[list[str]], float, int]]:
    """For each template and each name, alone and in a sentence, its training windows, the first one whole,
    its class, and how many windows it weighs when set into corpus paragraphs."""
    out = []
    for k, family in enumerate(sorted(templates)):
        stated = []
        for name in names.get(family, ()):
            stated.append(name)  # the words around it may be any
            for frame in FRAMES:
                other = rng.choice([n for f, ns in names.items() if f != family for n in ns])
                pair = [name, other] if rng.random() < 0.5 else [other, name]
                stated.append(frame.format(*(pair if frame.count("{}") == 2 else [name])))
        for template in (*templates[family], *stated):
            whole = _words(template)
            copies = 10 if template in templates[family] else 3
            parts = [whole] * copies
            for _ in range(copies if template in templates[family] else 0):
                size = min(rng.randint(max(3, len(whole) * 2 // 3), max(3, len(whole))), shape.window)
                at = rng.randint(0, max(len(whole) - size, 0))
                parts.append(whole[at : at + size])
            mixed = shape.mixed if template in templates[family] else shape.mixed // 16
            out.append(([p[: shape.window] for p in parts], float(k), mixed))
    return out


def _training(
    plain: DataFrame, n: int, made: Sequence[tuple[list[list[str]], float, int]], shape: Shape
) -> DataFrame:
    """``(_grams, label, weight)``: all of ``plain``, windows alike as one row, as the unknown class ``n``;
    the examples; and each example set into its part of ``plain``. Every row of ``plain`` is dealt to one
    example by its hash, as often as that one weighs."""
    spark = plain.sparkSession
    slots = [e for e, (_, _, mixed) in enumerate(made) for _ in range(mixed)]
    slot = F.pmod(F.xxhash64("key"), F.lit(max(len(slots), 1)))
    dealt = spark.createDataFrame(list(enumerate(slots)), "slot long, example int")
    hosts = plain.withColumn("slot", slot).join(F.broadcast(dealt), "slot")
    held = {r["example"]: r["n"] for r in hosts.groupBy("example").agg(F.sum("n").alias("n")).collect()}
    total = plain.agg(F.sum("n")).first()[0]

    bare: Counter[tuple[tuple[str, ...], float]] = Counter()
    into = []
    for e, (parts, label, mixed) in enumerate(made):
        grams = [tuple(sorted(_grams(p))) for p in parts]
        bare.update((g, label) for g in grams)
        if e in held:
            into.append((e, list(grams[0]), label, mixed / held[e]))
        else:
            bare[grams[0], label] += mixed
    if total is None:
        bare[(), float(n)] = 1
    schema = "_grams array<string>, label double, weight double"
    rows = spark.createDataFrame([(list(g), label, float(w)) for (g, label), w in bare.items()], schema)
    if total is None:
        return rows
    guests = spark.createDataFrame(into, "example int, guest array<string>, label double, share double")
    mixed_in = hosts.join(F.broadcast(guests), "example").select(
        F.array_union(F.split("key", ","), "guest").alias("_grams"),
        "label",
        (F.col("n") * F.col("share")).alias("weight"),
    )
    unknown = plain.select(
        F.split("key", ",").alias("_grams"),
        F.lit(float(n)).alias("label"),
        (F.col("n") * (shape.negatives / 2 / total)).alias("weight"),
    )
    return unknown.unionByName(mixed_in).unionByName(rows)


def _thresholds(plain: DataFrame, model: tuple, n: int, error: float) -> tuple[float, ...]:
    """From 0.5 to 0.99, for each family, such that at most ``error`` of all windows is taken for one.
    Odds are counted by their first four decimals, rounded up, so 4,901 counts a family are all there are."""
    odds = _scored(plain, *model, n).select("n", F.posexplode("_odds").alias("k", "p"))
    seen = odds.groupBy("k", (F.ceil(F.greatest("p", F.lit(0.5)) * 10000) / 10000).alias("p")).agg(F.sum("n").alias("n"))
    limits = seen.groupBy("k").agg(F.percentile("p", F.lit(1 - error / n), F.col("n")).alias("least")).collect()
    least = {r["k"]: r["least"] for r in limits}
    return tuple(min(max(least.get(k, 0.5), 0.5), 0.99) for k in range(n))


def fit(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    shape: Shape = Shape(),
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 3,
    names: Mapping[str, Sequence[str]] = NAMES,
) -> Model:
    """Trained on the templates, on parts of them, on names in sentences, on those set into corpus
    paragraphs, and on all corpus paragraphs that resemble no template as the unknown class. All of
    these set the thresholds too: at most ``error`` of them would be taken for a family.
    """
    windows = marked(docs, vocabulary(templates, names), shape, doc_id, text)
    return _fitted(windows, templates, shape, seed, names)


def _fitted(
    windows: DataFrame, templates: Mapping[str, Sequence[str]], shape: Shape, seed: int, names: Mapping[str, Sequence[str]]
) -> Model:
    families = tuple(sorted(templates))
    n = len(families)
    least = shape.min_overlap / 2
    # Of a window too long for its bigrams to be that share of it, the length does not matter.
    short = F.when(_n_pairs(F.col("key")) >= F.col("own") * least, F.col("own"))
    alike = windows.groupBy("key", short.alias("own")).agg(F.count("*").alias("n"))
    alike = alike.withColumn("_pairs", _pairs(F.col("key")))
    likest = F.greatest(*(overlap(F.col("_pairs"), F.col("own"), t) for f in families for t in templates[f]), F.lit(0.0))
    plain = alike.where((F.size("_pairs") < 2) | (likest < least)).groupBy("key").agg(F.sum("n").alias("n"))
    # Cut from its plan: each step of the regression is a job, whose tasks would carry all of it.
    plain = written(plain, "unknown-windows")
    counting = CountVectorizerModel.from_vocabulary(vocabulary(templates, names), "_grams", "_features", binary=True)
    rows = _training(plain, n, examples(templates, names, shape, random.Random(seed)), shape)
    rows = rows.coalesce(windows.sparkSession.sparkContext.defaultParallelism)
    regression = LogisticRegression(
        family="multinomial", maxIter=60, regParam=1e-3, standardization=False, featuresCol="_features",
        labelCol="label", weightCol="weight", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_predicted",
    ).fit(counting.transform(rows).select("_features", "label", "weight"))
    thresholds = _thresholds(plain, (counting, regression), n, shape.error)
    confirming = {f: (*templates[f], *(n for n in names.get(f, ()) if len(_words(n)) > 2)) for f in families}
    return Model(families, counting, regression, thresholds, confirming)


def find(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    shape: Shape = Shape(),
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 3,
    names: Mapping[str, Sequence[str]] = NAMES,
) -> DataFrame:
    """``scan`` of ``docs`` with the model that ``fit`` makes of them; their windows are cut once and kept
    on the executors' disks."""
    windows = marked(docs, vocabulary(templates, names), shape, doc_id, text).persist(StorageLevel.DISK_ONLY)
    return _found(windows, _fitted(windows, templates, shape, seed, names), shape)


def scan(
    docs: DataFrame, model: Model, shape: Shape = Shape(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, line, family, probability, overlap, confirmed)``: a row for each line and family found.

    ``probability`` is the family's against the unknown class. ``confirmed`` tells that the line shares
    enough bigrams with a template, and, of families that are worded alike, that none is closer; ones
    equally close are all confirmed. Lines count from 0. Whole texts are read; a line without ASCII
    letters or digits, and so a null or empty text, gives no row. Repeated rows and rows of one id are
    scanned as one, as are null ids. Only ids and texts are read.
    """
    return _found(marked(docs, model.counting.vocabulary, shape, doc_id, text), model, shape)


def _found(windows: DataFrame, model: Model, shape: Shape) -> DataFrame:
    scored = _scored(windows, model.counting, model.regression, len(model.families))
    parts = [
        F.struct(F.lit(f).alias("family"), F.get("_odds", F.lit(k)).alias("probability"), F.lit(t).alias("least"))
        for k, (f, t) in enumerate(zip(model.families, model.thresholds, strict=True))
    ]
    hits = F.filter(F.array(*parts), lambda x: x["probability"] >= x["least"])
    found = scored.select("doc_id", "line", "key", "own", F.inline(hits)).withColumn("_pairs", _pairs(F.col("key")))
    like, rival = F.lit(0.0), F.lit(0.0)
    shared = {
        f: F.greatest(*(overlap(F.col("_pairs"), F.col("own"), t) for t in model.templates[f]), F.lit(0.0))
        for f in model.families
    }
    for family in model.families:
        group = next((g for g in SIBLINGS if family in g), (family,))
        others = [shared[f] for f in group if f != family and f in shared]
        like = F.when(F.col("family") == family, shared[family]).otherwise(like)
        rival = F.when(F.col("family") == family, F.greatest(*others, F.lit(0.0), F.lit(0.0))).otherwise(rival)
    return (
        found.withColumns({"_like": like, "_rival": rival})
        .groupBy("doc_id", "line", "family")
        .agg(
            F.max("probability").alias("probability"),
            F.max("_like").alias("overlap"),
            F.max((F.col("_like") >= shape.min_overlap) & (F.col("_like") >= F.col("_rival"))).alias("confirmed"),
        )
    )
