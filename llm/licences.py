"""Licence notices by a trained paragraph classifier, confirmed against templates.

Paragraphs are the lines of a text, and neighbouring lines up to the next line without a word,
joined as far as they have at most WINDOW words. Those of their words and word pairs that some
notice has go to a multinomial logistic regression over licence families, one class for licences of
no family, and one for everything else. The last is learned from lines of the corpus and from
notices that name no licence or deny one. A class is predicted where its probability reaches a
level that is calibrated on other lines of the corpus. It holds if the paragraph has most word pairs
of one of the class's templates, and no template of another class fits better: so a licence that
differs from a relative by one word, as AGPL from GPL, is never given as that. Such a paragraph,
like one of a licence of no family, is given as UNKNOWN. Of paragraphs that overlap, the one with
the most of these pairs is given, the shortest of equals.

Only texts that have most pairs of some template are cut into paragraphs: no other can hold one
that is confirmed.

Training takes all templates, each with WORN worn copies, and the lines of all documents: those of
half the texts are learned from, those of the others calibrate. Lines with the same terms are
counted and go into the fit once, with their number as weight. Only DataFrame operations and Spark's
own estimators are used.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from llm.tables import store

TOKEN = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
WORN = 20
STEPS = 10000  # of a probability, to calibrate
ALARMS = 0.001  # share of other paragraphs that may reach the level
LEAST_LEVEL = 0.5
CONFIRM = 0.6  # share of a template's word pairs
WINDOW = 96  # words of joined lines, about twice the longest template's

# fixed values: notices of licences, as their authors ask to give them
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal, public domain dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
UNKNOWN = "unknown"
# fixed values: notices of licences that are none of the families
STRANGERS = [
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: AGPL-3.0-only",
    "SPDX-License-Identifier: AGPL-3.0-or-later",
    "This work is licensed under the GNU General Public License, version 2.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: GPL-2.0-only",
    "SPDX-License-Identifier: GPL-2.0-or-later",
    "Licensed under the GNU Lesser General Public License, version 3.",
    "SPDX-License-Identifier: LGPL-3.0-only",
    "Licensed under CC BY-SA 4.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "SPDX-License-Identifier: CC-BY-SA-4.0",
    "Licensed under CC BY-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "SPDX-License-Identifier: CC-BY-ND-4.0",
    "Licensed under CC BY-NC-SA 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    "Licensed under CC BY-NC-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "Licensed under the Eclipse Public License, version 2.0.",
    "SPDX-License-Identifier: EPL-2.0",
    "Licensed under the ISC License.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "SPDX-License-Identifier: ISC",
    "Licensed under the BSD 2-Clause License.",
    "SPDX-License-Identifier: BSD-2-Clause",
    "This is free and unencumbered software released into the public domain.",
    "SPDX-License-Identifier: Unlicense",
]
# fixed values: notices that give no licence
OTHER = [
    "This work is not licensed under the MIT License.",
    "This work is not licensed under the GNU General Public License, version 3.",
    "This file was not released under the MIT License.",
    "It is no longer licensed under the Apache License, Version 2.0.",
    "All rights reserved.",
    "Copyright 2020 by the authors. All rights reserved.",
    "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    "See the license file in the root directory for details.",
    "A driver license is required to operate this vehicle under the law.",
    "The software license agreement is between you and the company.",
    "Released under the supervision of the general public, version of the author.",
    "You may obtain a copy of the report at the office.",
]
FAMILIES = sorted(TEMPLATES)
NOTICES = TEMPLATES | {UNKNOWN: STRANGERS}
CLASSES = [*FAMILIES, UNKNOWN]


def _split(text: str) -> tuple[list[str], list[str]]:
    """The words and the distinct word pairs of a notice, as ``tokens`` and ``pairs`` give them."""
    words = re.findall(TOKEN, text.lower())
    return words, list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def _key(own: list[str]) -> list[str]:
    """The longest of a template's pairs, so many that a text with none of them hasn't a share of CONFIRM."""
    least = next(n for n in range(len(own) + 1) if n / len(own) >= CONFIRM)
    return sorted(own, key=lambda p: (-len(p), p))[: len(own) - least + 1]


OWN = [_split(t)[1] for c in CLASSES for t in NOTICES[c]]  # pairs of the templates, by class
KNOWN = sorted({p for own in OWN for p in own})
KEYS = sorted({p for own in OWN for p in _key(own)})
_NOTED = [_split(t) for t in [*(t for c in CLASSES for t in NOTICES[c]), *OTHER]]
WORDS = sorted({w for words, _ in _NOTED for w in words})
PAIRS = sorted({p for _, own in _NOTED for p in own})


def tokens(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(TOKEN), 0)


def pairs(words: Column) -> Column:
    """Neighbouring words, joined."""
    rest = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    first = F.slice(words, 1, F.size(rest))
    return F.zip_with(first, rest, lambda a, b: F.concat_ws(" ", a, b))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, text), a row per line with a word in it; paragraphs count from 0."""
    text = F.col("text").cast("string")
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("paragraph", "text"))
    return lines.filter(F.col("text").rlike("[A-Za-z0-9]"))


def once(value: Column) -> Column:
    """A value that later expressions don't repeat: filters and projections stay above a generator."""
    return F.explode(F.array(value))


def terms(words: Column) -> Column:
    """The distinct words and pairs that some notice has, in order."""
    first, rest = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    noted = lambda a, b: F.when(a.isin(WORDS) & b.isin(WORDS), F.concat_ws(" ", a, b))
    both = F.filter(F.zip_with(first, rest, noted), lambda p: p.isin(PAIRS))
    return F.array_sort(F.array_distinct(F.concat(F.filter(words, lambda w: w.isin(WORDS)), both)))


def _notices(docs: DataFrame) -> DataFrame:
    """(label, words): templates and worn copies, which lack a tenth of the words."""
    named = [(float(i + 1), t) for i, c in enumerate(CLASSES) for t in NOTICES[c]] + [(0.0, t) for t in OTHER]
    values = F.array(*(F.struct(F.lit(y).alias("label"), F.lit(t).alias("text")) for y, t in named))
    rows = docs.sparkSession.range(0, 1, 1, 1).select(F.explode(values).alias("n")).select("n.label", tokens(F.col("n.text")).alias("words"))
    copies = rows.select("label", "words", F.explode(F.sequence(F.lit(0), F.lit(WORN))).alias("copy"))
    keep = lambda w, i: (F.col("copy") == 0) | (F.pmod(F.xxhash64(w, i, F.col("copy")), F.lit(10)) != 0)
    return copies.select("label", F.filter("words", keep).alias("words"))


@dataclass
class Scanner:
    model: PipelineModel
    level: float


def _probabilities(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with ``terms``; adds ``chances``, the probabilities of the classes in order."""
    chances = F.slice(vector_to_array("probability"), 2, len(CLASSES))
    return model.transform(rows).select("*", once(chances).alias("chances")).drop("terms", "vector", "probability")


def lines(docs: DataFrame) -> DataFrame:
    """(half, terms, n): how many lines of docs, of either half of the texts, have these terms. Lines about licences aren't counted."""
    text = F.col("text").cast("string")
    half = F.pmod(F.xxhash64(F.lit(1), text), F.lit(2)).alias("half")
    rows = docs.select(half, F.explode(F.split(F.lower(text), "\n")).alias("text"))
    rows = rows.filter(F.col("text").rlike("[a-z0-9]") & ~F.col("text").rlike("licen[cs]|creative commons|copyright"))
    # Counts combine before the shuffle.
    return rows.select("half", once(tokens(F.col("text"))).alias("words")).groupBy("half", terms(F.col("words")).alias("terms")).agg(F.count("*").alias("n"))


def train(docs: DataFrame) -> Scanner:
    """A scanner from the templates and all lines of docs."""
    plain = store(lines(docs), "lines")
    notices = _notices(docs).select("label", terms(F.col("words")).alias("terms"), F.lit(1.0).alias("weight"))
    fitted = plain.filter("half = 0")
    # Together the corpus' lines weigh no more than the notices.
    weight = min(1.0, notices.count() / max(fitted.agg(F.sum("n")).first()[0] or 0, 1))
    rows = store(notices.union(fitted.select(F.lit(0.0).alias("label"), "terms", F.col("n") * weight)), "rows")
    vectors = CountVectorizerModel.from_vocabulary(WORDS + PAIRS, inputCol="terms", outputCol="vector", binary=True)
    learner = LogisticRegression(
        featuresCol="vector", labelCol="label", probabilityCol="probability", rawPredictionCol="raw", predictionCol="predicted",
        family="multinomial", regParam=0.0005, maxIter=100, standardization=False, weightCol="weight",
    )
    fit: LogisticRegressionModel = learner.fit(vectors.transform(rows))
    model = PipelineModel([vectors, fit.setRawPredictionCol("").setPredictionCol("")])
    # Steps of a probability are few values, whatever the number of lines.
    reached = F.ceil(F.array_max("chances") * STEPS) / STEPS
    level = _probabilities(plain.filter("half = 1"), model).agg(F.percentile(reached, 1 - ALARMS, F.col("n"))).first()[0]
    return Scanner(model, max(LEAST_LEVEL, level or 0.0))


def _fits(hits: Column) -> Column:
    """Of every template, the number ``matched`` of its pairs that are among the hits, and their ``share``."""
    every = F.from_json(F.lit(json.dumps(OWN)), "array<array<string>>")
    counted = F.transform(every, lambda own: F.struct(F.size(F.array_intersect(own, hits)).alias("matched"), F.size(own).alias("size")))
    return F.transform(counted, lambda t: F.struct(t["matched"].alias("matched"), (t["matched"] / t["size"]).alias("share")))


def _of_class(fits: Column, place: Column) -> Column:
    """The part of ``_fits`` that belongs to the templates of a class, counted from 1."""
    numbers = [len(NOTICES[c]) for c in CLASSES]
    starts = [sum(numbers[:i]) + 1 for i in range(len(numbers))]
    return F.slice(fits, F.element_at(F.lit(starts), place), F.element_at(F.lit(numbers), place))


def _likely(rows: DataFrame) -> DataFrame:
    """Rows with most word pairs of any template; adds ``hits``, the template pairs among the words."""
    rows = rows.select("*", once(F.filter(pairs(F.col("words")), lambda p: p.isin(KNOWN))).alias("hits"))
    rows = rows.filter(F.exists("hits", lambda p: p.isin(KEYS))).withColumn("hits", F.array_distinct("hits"))
    return rows.filter(F.exists(_fits(F.col("hits")), lambda t: t["share"] >= CONFIRM))


def _words(text: Column) -> Column:
    """Tokens of joined lines; a word that is parted behind its hyphen is one."""
    return tokens(F.regexp_replace(text, "(?<=[A-Za-z0-9])-[^A-Za-z0-9\n]*\n[^A-Za-z0-9\n]*", "-"))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, paragraph, n_lines, text, words, hits) of lines and joined lines that have most pairs of a template.

    Spans begin at a line that has, or begins, a template's pair.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = _likely(rows.select("*", once(_words(F.col("text"))).alias("words")))
    rows = rows.select("doc_id", F.sha2("text", 256).alias("digest"), "hits", once(F.split("text", "\n")).alias("lines"))
    rows = rows.select("*", once(F.transform("lines", tokens)).alias("words"))
    rows = rows.select("*", once(F.transform("words", F.size)).alias("sizes"))

    def reach(i: Column) -> Column:
        """The number of lines from i on that are joined at most."""
        start = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words"), F.lit(True).alias("on"))

        def add(a, n):
            on = a["on"] & (n > 0) & (a["words"] + n <= WINDOW)
            return F.struct((a["lines"] + on.cast("int")).alias("lines"), (a["words"] + n).alias("words"), on.alias("on"))

        return F.greatest(F.aggregate(F.slice("sizes", i + 1, WINDOW), start, add)["lines"], F.lit(1))

    def marked(i: Column) -> Column:
        after = F.coalesce(F.slice(F.get("words", i + 1), 1, 1), F.array().cast("array<string>"))
        own = F.arrays_overlap(pairs(F.concat(F.get("words", i), after)), "hits")
        return (F.get("sizes", i) > 0) & (own | F.get("lines", i).rlike("[A-Za-z0-9]-[^A-Za-z0-9]*$"))

    firsts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), marked)
    cut = F.transform(firsts, lambda i: F.struct(i.alias("first"), F.slice("lines", i + 1, reach(i)).alias("lines")))
    rows = rows.select("doc_id", "digest", F.explode(cut).alias("at")).select("doc_id", "digest", "at.first", "at.lines")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.size("lines"))).alias("n_lines"))
    joined = F.array_join(F.slice("lines", F.lit(1), F.col("n_lines")), "\n")
    rows = rows.select("doc_id", "digest", F.col("first").alias("paragraph"), "n_lines", once(joined).alias("text"))
    return _likely(rows.select("*", once(_words(F.col("text"))).alias("words")))


def _apart(found: DataFrame) -> DataFrame:
    """Of each document's spans that overlap, the one that has most; as often as the document is there."""
    fields = ("matched", "n_lines", "paragraph", "family", "probability", "similarity", "text")
    # Repeats of a document are counted first, and combine before the shuffle.
    each = found.groupBy("doc_id", "digest", "paragraph", "n_lines").agg(F.count("*").alias("copies"), F.max(F.struct(*(c for c in fields))).alias("s"))
    rank = F.struct((-F.col("s.matched")).alias("rank"), *(F.col(f"s.{c}").alias(c) for c in fields[1:]))
    each = each.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(rank)).alias("ranked"), F.max("copies").alias("copies"))

    def add(kept, x):
        meets = F.exists(kept, lambda k: (k["paragraph"] < x["paragraph"] + x["n_lines"]) & (x["paragraph"] < k["paragraph"] + k["n_lines"]))
        return F.when(meets, kept).otherwise(F.concat(kept, F.array(x)))

    none = F.filter("ranked", lambda _: F.lit(False))
    kept = each.select("doc_id", "copies", F.explode(F.aggregate("ranked", none, add)).alias("s"))
    return kept.select("doc_id", "s.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, text) of each notice in docs (doc_id, text, ...).

    ``family`` is one of FAMILIES, or UNKNOWN for a licence that is none of them. ``paragraph`` is
    the notice's first line, counted from 0, and ``text`` its lines. A null or empty text has no paragraphs. Rows that repeat a document give its notices again, and rows
    without a doc_id give theirs with none. Other columns are not read.
    """
    found = _probabilities(spans(docs).withColumn("terms", terms(F.col("words"))), scanner.model)
    found = found.withColumn("probability", F.array_max("chances")).filter(F.col("probability") >= scanner.level)
    place = F.array_position("chances", F.col("probability")).cast("int")
    named = found.select("*", place.alias("place"), once(_fits(F.col("hits"))).alias("fits"))
    own = _of_class(F.col("fits"), F.col("place"))
    named = named.withColumn("similarity", F.array_max(F.transform(own, lambda t: t["share"]))).filter(F.col("similarity") >= CONFIRM)
    other = F.array_max(F.transform("fits", lambda t: t["share"])) > F.col("similarity")
    matched = F.array_max(F.transform(own, lambda t: F.when(t["share"] >= CONFIRM, t["matched"]).otherwise(0)))
    family = F.when(other, UNKNOWN).otherwise(F.element_at(F.lit(CLASSES), F.col("place")))
    held = named.withColumn("matched", matched).withColumn("family", family)
    return _apart(held).select("doc_id", "paragraph", "family", "probability", "similarity", "text")
