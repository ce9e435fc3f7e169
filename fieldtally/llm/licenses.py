"""License scan: a trained paragraph classifier whose findings are confirmed against templates.

Paragraphs end at blank lines; line breaks inside one don't matter, and long
ones are read in sections that overlap by the longest template. Word pairs
feed a multinomial logistic regression over licence families and
``unknown``. It learns from the templates below, alone and inside sections of
the corpus, against those sections and against sentences that only speak of
licences. A temperature calibrates its probabilities on templates and sections
that the scoring fit has not seen: two halves score each other. What is not
likely enough, or not borne out by a template of the family, is unknown.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.session import settle

# Wording that licences prescribe or that notices commonly use, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
        "Licensed under the MIT license. See the LICENSE file for details.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "This project is released under the Apache 2.0 license.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed to the Apache Software Foundation under one or more contributor license agreements.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL version 2 or later.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the GNU Lesser General Public License v3.0.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Licensed under the LGPL version 2.1 or later.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "This project is released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This article is available under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "distributed under the terms of the Creative Commons Attribution License, which permits unrestricted use",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This article is available under CC BY-SA 3.0.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This article is available under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "distributed under the Creative Commons Attribution-NonCommercial License",
    ),
    "public domain": (
        "This is free and unencumbered software released into the public domain.",
        "This work has been released into the public domain by its author.",
        "This work is dedicated to the public domain under the CC0 1.0 Universal license.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "reserved": (
        "Copyright 2020. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without written permission of the publisher.",
        "Copyright (c) 2019 the authors. All rights reserved.",
        "Unauthorized copying of this file is strictly prohibited. All rights reserved.",
    ),
}
# Sentences that speak of licences, copyright or public things and grant none.
SPEAKS_OF = (
    "A valid driver's license is required for this job.",
    "the licence of a driver is renewed every ten years at the office",
    "The fishing license costs twenty dollars and can be bought at the shop.",
    "The company settled the copyright infringement lawsuit out of court.",
    "Copyright law protects the authors of books and songs.",
    "Please read the license agreement before you install the product.",
    "He lost his license to practice medicine after the trial.",
    "The general public is invited to the free concert in the park.",
    "The firm sells software licenses to schools under a yearly contract.",
    "It was published by the university press and distributed free of charge.",
    "Permission to enter the building is granted by the front desk.",
    "The redistribution of income was the subject of the debate.",
)
UNKNOWN = "unknown"
#: Sections of the corpus that training uses at most: those first by hash.
NEGATIVES = 1_000
#: Words of a section.
SECTION = 96
#: Training rows that must hold a word pair for it to be a feature; a section meets a template in one of two rows.
MIN_ROWS = 3
#: Least share of a template's word pairs that confirms it.
CONFIRMED = 0.6


def _words(paragraph: Column) -> Column:
    """Lower-case words; numbers are one word."""
    found = F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(found, lambda w: F.when(w.rlike("[0-9]"), F.lit("#")).otherwise(w))


def _pairs(words: Column) -> Column:
    n = F.size(words)
    return F.when(n >= 2, F.array_distinct(F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b)))).otherwise(
        F.array().cast("array<string>")
    )


def template_table(spark: SparkSession) -> DataFrame:
    """label (number of the class), half and t (number within the half, from 0), words: templates and ``SPEAKS_OF``."""
    rows, at = [], [0, 0]
    for label, texts in enumerate([*TEMPLATES.values(), SPEAKS_OF]):
        for i, text in enumerate(texts):
            rows.append(F.struct(F.lit(float(label)).alias("label"), F.lit(i % 2).alias("half"), F.lit(at[i % 2]).alias("t"), F.lit(text).alias("template")))
            at[i % 2] += 1
    return spark.range(1).select(F.inline(F.array(*rows))).select("label", "half", "t", _words(F.col("template")).alias("words"))


def sections(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, paragraph (number from 0), start (number of the first word in it) and words of every section with words."""
    stride = SECTION - max(len(words) for family in TEMPLATES for words in _template_words(family))
    found = docs.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(F.split(F.col(text), r"\n[ \t\r]*\n")).alias("paragraph", "content")
    ).select("doc_id", "paragraph", _words(F.col("content")).alias("all"))
    last = F.greatest(F.lit(0), F.ceil((F.size("all") - SECTION) / stride).cast("int")) * stride
    cut = F.transform(F.sequence(F.lit(0), last, F.lit(stride)), lambda at: F.struct(at.alias("start"), F.slice("all", at + 1, SECTION).alias("words")))
    return found.select("doc_id", "paragraph", F.inline(F.when(F.size("all") > 0, cut)))


def _grams(rows: DataFrame) -> DataFrame:
    """Adds ``grams`` from ``words``."""
    return NGram(n=2, inputCol="words", outputCol="grams").transform(rows)


def training_rows(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """label, half and words: every template alone and inside sections of the corpus, and those sections alone as unknown.

    The sections come from about twice as many documents as are wanted, drawn
    by hash, so that no task orders more than some thousands. Those in which
    any template is confirmed are left out. Templates only meet sections of
    their own half, so that the halves share neither.
    """
    share = min(1.0, 2 * NEGATIVES / max(1, docs.count()))
    drawn = docs.where(F.pmod(F.xxhash64(doc_id, text), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    plain = sections(drawn, doc_id, text).select(F.xxhash64("words").alias("h"), F.col("words").alias("around")).distinct()
    some = settle(plain.orderBy("h", "around").limit(2 * NEGATIVES), "sections")
    free = some.where(_held(F.concat(*[_template_sets(f) for f in TEMPLATES]), _pairs(F.col("around"))) < CONFIRMED)
    half = F.pmod(F.shiftright("h", 40), F.lit(2)).cast("int")
    other = settle(free.orderBy("h", "around").limit(NEGATIVES).withColumn("half", half), "around")
    templates = template_table(spark)
    # Each section meets the templates of its half in turn: a fixed number of rows.
    count = [0, 0]
    for texts in [*TEMPLATES.values(), SPEAKS_OF]:
        count[0], count[1] = count[0] + (len(texts) + 1) // 2, count[1] + len(texts) // 2
    turn = F.pmod("h", F.when(F.col("half") == 0, F.lit(count[0])).otherwise(F.lit(count[1]))).cast("int")
    met = other.withColumn("t", turn).join(F.broadcast(templates), ["half", "t"]).withColumn("at", F.pmod(F.shiftright("h", 20), F.size("around") + 1).cast("int"))
    inside = F.concat(F.slice("around", F.lit(1), F.col("at")), F.col("words"), F.slice("around", F.col("at") + 1, F.size("around")))
    unknown = other.select(F.lit(float(len(TEMPLATES))).alias("label"), "half", F.col("around").alias("words"))
    alone = templates.select("label", "half", "words", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("copy")).drop("copy")
    return met.select("label", "half", inside.alias("words")).union(unknown).union(alone)


class LicenseModel:
    """The regression with its temperature, the least probability at which a family is named, and the probability of
    ``unknown`` from which a section is passed over."""

    def __init__(self, vocabulary, model, temperature: float, least: float = 0.5, sure: float = 0.5):
        self.vocabulary, self.model, self.temperature, self.least, self.sure = vocabulary, model, temperature, least, sure

    @classmethod
    def fit(cls, spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LicenseModel:
        """Fitted on all training rows; the temperature on the rows of each half, scored by a fit on the other one."""
        grams = settle(_grams(training_rows(spark, docs, doc_id, text)).select("label", "half", "grams"), "licence-rows")
        vocabulary = CountVectorizer(inputCol="grams", outputCol="features", minDF=MIN_ROWS, binary=True).fit(grams)
        # A pair that one half lacks is 0 in all its rows, and so is its weight there.
        rows = vocabulary.transform(grams).drop("grams")
        fit = LogisticRegression(maxIter=40, regParam=1e-3, family="multinomial", probabilityCol="", predictionCol="")
        # At most a few thousand rows, whatever the corpus.
        scored = [fit.fit(rows.where(F.col("half") == 1 - k).coalesce(1)).transform(rows.where(F.col("half") == k)) for k in (0, 1)]
        raw = scored[0].union(scored[1]).select("label", vector_to_array("rawPrediction").alias("z"))
        temperatures = [0.25 * 1.25**k for k in range(20)]
        loss = lambda t: F.avg(F.log(F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp((z - F.get("z", F.col("label").cast("int"))) / t))))
        losses = raw.agg(*[loss(t).alias(str(i)) for i, t in enumerate(temperatures)]).first()
        best = min((i for i in range(len(temperatures)) if losses[i] is not None), key=lambda i: losses[i], default=6)
        return cls(vocabulary, fit.fit(rows.coalesce(1)), temperatures[best])

    def classify(self, rows: DataFrame) -> DataFrame:
        """Adds guess (a family or unknown) and its class's probability to rows with ``words``; rows that are surely unknown go."""
        scored = self.model.transform(self.vocabulary.transform(_grams(rows)))
        # A generator is computed once; the filter below would otherwise be pushed down with the scores inside its lambda.
        once = F.inline(F.array(F.struct(vector_to_array("rawPrediction").alias("z"))))
        scored = scored.select(*rows.columns, once)
        names = F.array(*[F.lit(f) for f in [*TEMPLATES, UNKNOWN]])
        whole = lambda z, top: F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp((x - top) / self.temperature))
        shares = scored.withColumn("nothing", 1 / whole(F.col("z"), F.element_at("z", -1))).where(F.col("nothing") < self.sure)
        top = F.array_max("z")
        guess = F.get(names, (F.array_position("z", top) - 1).cast("int"))
        return shares.withColumn("probability", 1 / whole(F.col("z"), top)).withColumn(
            "guess", F.when(F.col("probability") >= self.least, guess).otherwise(F.lit(UNKNOWN))
        ).drop("z", "nothing")


def _template_sets(family: str) -> Column:
    """The distinct word pairs of each template of a family."""
    sets = [list(dict.fromkeys(" ".join(pair) for pair in zip(words, words[1:]))) for words in _template_words(family)]
    return F.array(*[F.array(*map(F.lit, s)) for s in sets])


def _held(families: Column, own: Column) -> Column:
    """The largest share of a template's word pairs that ``own`` has."""
    share = lambda s: F.size(F.array_intersect(s, own)) / F.size(s)
    return F.coalesce(F.array_max(F.transform(families, share)), F.lit(0.0))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", overlap: float = CONFIRMED) -> DataFrame:
    """doc_id, paragraph, start, family, probability and overlap of every section in which the classifier sees a licence.

    All sections of all paragraphs are classified. ``overlap`` is the largest
    share of a template's word pairs that the section holds, over the
    templates of the guessed family; below the limit the family is
    ``unknown``, as it is where no family is likely enough but ``unknown``
    itself is not sure either. A notice that lies where two sections overlap
    is found in both. NULL and empty texts have no paragraphs; a paragraph may
    have any length; repeated rows and NULL ids are reported as they are;
    without rows, only templates are learnt; further columns play no part.
    """
    spark = docs.sparkSession
    model = LicenseModel.fit(spark, docs, doc_id, text)
    guessed = model.classify(sections(docs, doc_id, text)).withColumn("own", _pairs(F.col("words")))
    found = F.lit(0.0)
    for family in TEMPLATES:
        found = F.when(F.col("guess") == family, _held(_template_sets(family), F.col("own"))).otherwise(found)
    return guessed.withColumn("overlap", found).select(
        "doc_id", "paragraph", "start", F.when(F.col("overlap") >= overlap, F.col("guess")).otherwise(F.lit(UNKNOWN)).alias("family"), "probability", "overlap"
    )


def _template_words(family: str) -> list[list[str]]:
    return [["#" if re.search(r"\d", w) else w for w in re.findall(r"[^\W_]+", t.lower())] for t in TEMPLATES[family]]


@query("op9_licenses")
def op9_licenses(spark, sf_dir):
    """Every section of the whole table in which a licence is seen, with its family."""
    return license_scan(table(spark, sf_dir, "documents"))
