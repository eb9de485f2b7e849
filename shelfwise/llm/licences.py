"""Licence scan of paragraphs by a trained classifier, in DataFrame functions only.

Every line is a unit, and so is every passage of a wrapped paragraph: its lines (blank lines end it, comment marks go) are
joined and cut into overlapping runs of ``PASSAGE`` words, so a notice is whole in one of them however it is wrapped.
Units are classified by a sparse multinomial logistic regression over words and word pairs into licence families,
*unknown* (worded like a licence, of a name that is in no template) or none. It is trained here
on variants of the template notices below, the same wordings with invented names, sentences that only sound alike, and a
bounded sample of the corpus's own lines.

**Gate.** The weights say which words and word pairs a unit needs before its sum can turn from none: of the positive
weights the smallest are left out as long as all of them together cannot make up for the intercept. A unit
without any of the others is none, whatever else it holds, so only units that the gate's pattern finds are scored, in the scan
of the texts and by the fitted model itself. Only those that are not none leave the scan.

**Unknown.** The weights' sharpness and the least score of a family are taken from fits that leave families out in
``FOLDS`` turns: notices of a family that a fit has not seen must not pass as another one. A unit that denies a
licence, names marks (such as ND, Affero) that its family has not, or a licence name that is in no template, is unknown too.

A family counts as confirmed where a template of it is contained in the unit to at least ``CONFIRM`` of the template's
words and word pairs, with all of its marks.

Equal units are classified once, so a notice on a third of all documents is one row. Edge cases: null and empty texts
have no lines; repeated rows are each reported; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

NONE, UNKNOWN = "none", "unknown"
#: Notices as their publishers word them.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache-2.0",
        "Apache License 2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under the terms of the GNU GPL v3",
        "GNU General Public License v3.0",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Distributed under the terms of the GNU LGPL v2.1",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Distributed under the terms of the GNU AGPL v3",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Available under CC BY 4.0.",
        "Creative Commons Attribution 4.0 International",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Available under CC BY-SA 4.0.",
        "Creative Commons Attribution-ShareAlike 4.0 International",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Available under CC BY-NC 4.0.",
        "Creative Commons Attribution-NonCommercial 4.0 International",
    ],
    "cc-by-nd": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
        "Available under CC BY-ND 4.0.",
        "Creative Commons Attribution-NoDerivatives 4.0 International",
    ],
    "public-domain": [
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0.",
        "CC0 1.0 Universal",
        "Released into the public domain under CC0 1.0.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose",
        "Released under the Unlicense.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
        "Released under the zlib License.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
        "Licensed under the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "cddl": [
        "The contents of this file are subject to the terms of the Common Development and Distribution License",
        "Licensed under the Common Development and Distribution License, version 1.0.",
        "SPDX-License-Identifier: CDDL-1.0",
    ],
    "eupl": [
        "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission subsequent versions of the EUPL",
        "Licensed under the European Union Public Licence, version 1.2.",
        "SPDX-License-Identifier: EUPL-1.2",
    ],
    "gfdl": [
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3",
        "Licensed under the GNU Free Documentation License.",
        "SPDX-License-Identifier: GFDL-1.3-or-later",
    ],
    "artistic": [
        "Licensed under the Artistic License 2.0.",
        "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License",
        "SPDX-License-Identifier: Artistic-2.0",
    ],
}
#: Words that tell licences apart; a unit may only hold those of its own family.
MARKS = (
    "affero agpl apache artistic boost bsd bsl cc0 cddl eclipse epl eupl gfdl gnu gpl isc lesser lgpl mit mozilla mpl nc nd "
    "noderivatives noderivs noncommercial sa sharealike unlicense zlib"
).split()
#: Wordings of licences of any name, and names that no template has: together the class of unknown licences.
UNNAMED = [
    "Licensed under the {} License.",
    "Licensed under the {} Public License, version 2.",
    "Released under the {} License 1.0.",
    "Released under the {} License.",
    "Published under the {} Licence.",
    "Available under the {} Licence.",
    "This work is licensed under the {} License, version 3.",
    "Distributed under the terms of the {} Software License, Version 1.1.",
    "SPDX-License-Identifier: {}-1.0",
    "You may use this software under the terms of the {} License only.",
    "The contents of this file are subject to the {} Public License.",
    "Permission to use this material is granted under the {} Community License.",
]
INVENTED = ["Frobnitz", "Quuxia", "Norwegian Lakes", "Zanzibar", "Xylem", "Plover"]
ALIKE = [
    "All rights reserved.",
    "Copyright 2020 the authors.",
    "She renewed her driving licence at the office in the city.",
    "He asked for permission to leave the room before the end.",
    "The warranty covers parts for two years from the date of purchase.",
    "A licence is required to fish in this lake.",
    "The version of the story released in public was shorter.",
    "They had to redistribute the seats in the hall among the guests.",
    "Please read the license agreement before you use the product.",
    "This page is subject to copyright and may not be copied.",
    "You may obtain a copy of the form at the desk.",
    "The general public was admitted free of charge.",
    "The general public of the town read about it.",
    "The Apache people lived in the south of the country.",
    "Das Haus mit dem roten Dach steht am Fluss.",
    "Er kam mit dem Zug und ging mit ihr nach Hause.",
    "Sie sprach mit den Nachbarn und mit mir.",
]
#: Comment marks before a line, and the words of a passage: twice those of the longest template, so each stands whole in one.
MARKS_BEFORE = r"(?m)^[ \t]*(?:(?:[/*#;%>!|]+|--+)(?=[ \t]|$)[ \t]*)?"
PASSAGE = 2 * max(len(text.split()) for notices in TEMPLATES.values() for text in notices)
#: Documents whose lines are no examples of none.
SOUNDS_LIKE = r"(?i)licen[sc]|copyright|permission|warrant|redistribut|public domain|spdx|creative commons|\bcc[ -]by|" + "|".join(
    rf"\b{mark}\b" for mark in MARKS if mark != "mit"  # also a German word
)
CONFIRM = 0.6
#: Sums this near to that of none are added up again.
NEARLY = 1e-6
N_SAMPLE = 500
#: Lines of a sampled document that are examples of none.
N_LINES = 3
TEMPERATURES = (0.25, 0.5, 1.0, 2.0)
#: Families are left out in so many turns; at most so large a share of left-out notices may pass as another family.
FOLDS = 3
#: Steps of the fits; those that leave families out only rank scores.
STEPS, FOLD_STEPS = 60, 20
PASS_AS_OTHER = 0.05
LEAST_SCORES = (0.5, 0.6, 0.7)
#: Words before and after which a licence is denied, and a licence's name.
DENIED = r"(?i)\b(?:not|never|no longer|isn't|neither|nor)\s+(?:[\p{L}']+\s+){0,3}?(?:licen[sc]ed|released|distributed|available|covered|governed|published|under)\b"
NAMED = r"(\p{Lu}[\p{L}\p{N}.+]*)(?:[ -]\p{Lu}[\p{L}\p{N}.+]*)*,? (?:(?:Public|Software|Community) )?Licen[sc]e\b"


def grams(text: Column) -> Column:
    """Distinct words and word pairs of a line, lower-cased."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def of(words: Column) -> Column:
        pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_distinct(F.concat(words, F.filter(pairs, lambda p: p.isNotNull())))

    # Bound, so that a text is split once and not for each place where its words are named.
    return F.transform(F.array(words), of)[0]


def variants() -> list[tuple[str, str, bool, int]]:
    """(class, text, kept out of training, fold) of every template: whole, in parts, and inside other words; fold -1 is never left out."""
    out = []
    for number, (family, notices) in enumerate(TEMPLATES.items()):
        for text in notices:
            words = text.split()
            third = max(4, len(words) * 2 // 3)
            for i, variant in enumerate(
                [text, text.upper(), " ".join(words[:third]), " ".join(words[-third:]), f"This file: {text} See NOTICE.", f"* {text} *", f"// {text} and more"]
            ):
                out.append((family, variant, i in (4, 6), number % FOLDS))
    for text in UNNAMED:
        for i, name in enumerate(INVENTED):
            out.append((UNKNOWN, text.format(name), i == 3, -1))
            out.append((UNKNOWN, f"This file: {text.format(name)} See NOTICE.", i == 4, -1))
    for text in ALIKE:
        words = text.split()
        for i, variant in enumerate([text, " ".join(words[: len(words) * 2 // 3]), f"- {text}", f"So: {text} Then more."]):
            out.append((NONE, variant, i == 3, -1))
    return out


def units(text: Column, gate: str) -> Column:
    """The lines of a text and the passages of its wrapped paragraphs, those that pass the gate."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), MARKS_BEFORE, "")
    wrapped = F.filter(F.split(F.regexp_replace(plain, r"\A\n+|\n+\z", ""), r"\n{2,}"), lambda p: p.contains("\n") & p.rlike(gate))

    def passages(words: Column) -> Column:
        last = F.greatest(F.size(words) - PASSAGE // 2 - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last, F.lit(PASSAGE // 2)), lambda i: F.array_join(F.slice(words, i + 1, PASSAGE), " "))

    # A paragraph's words are bound before its passages are cut; spelled out in each passage, they would be split anew for each.
    in_words = F.transform(wrapped, lambda p: F.split(F.trim(F.regexp_replace(p, r"\s+", " ")), " "))
    every = F.concat(F.split(text, r"[\r\n]+"), F.flatten(F.transform(in_words, passages)))
    return F.filter(every, lambda u: u.rlike(gate))


class Classifier:
    """weights (gram, family, weight; one row without gram is the intercept), templates (gram, family, template, size, marks),
    the gate's pattern, the least score of a family, and the fitted model with the words and word pairs that it knows."""

    def __init__(
        self, weights: DataFrame, templates: DataFrame, families: list[str], gate: str, sure: float, vocabulary: list[str], model: LogisticRegressionModel
    ):
        self.weights, self.templates, self.families, self.gate, self.sure = weights, templates, families, gate, sure
        self.vocabulary, self.model = vocabulary, model

    def possible(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``line`` null where the model finds it to be none; equal sums, but for rounding, are left to ``classify``."""
        known = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="grams", outputCol="features", binary=True)
        model = self.model.copy().setFeaturesCol("features").setRawPredictionCol("raw").setProbabilityCol("").setPredictionCol("")
        scored = model.transform(known.transform(rows.withColumn("grams", F.coalesce(grams(F.col("line")), F.array().cast("array<string>")))))
        # Bound once: the vector's expression is the model's work.
        best = F.transform(F.array(vector_to_array("raw")), lambda raw: F.array_max(F.slice(raw, 2, len(self.families))) > raw[0] - NEARLY)[0]
        return scored.withColumn("line", F.when(best, F.col("line"))).drop("grams", "features", "raw")


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(f, f"{f}-{i}", text) for f, notices in TEMPLATES.items() for i, text in enumerate(notices)]
    found = spark.createDataFrame(rows, "family string, template string, text string").select("family", "template", grams(F.col("text")).alias("grams"))
    marks = F.size(F.array_intersect("grams", F.array(*[F.lit(m) for m in MARKS])))
    return found.select("family", "template", F.size("grams").alias("size"), marks.alias("marks"), F.explode("grams").alias("gram"))


def gate_pattern(margins: dict[str, float], intercept: float) -> str:
    """A pattern that finds every text whose margins (of distinct words and pairs) and intercept can add up above 0.

    ``margins``: for each gram the most that it adds to any class over none. Those that are left out add up to less than
    the intercept takes away."""
    room = -intercept
    kept = []
    for gram, margin in sorted(margins.items(), key=lambda x: (x[1], x[0])):
        if margin <= 0:
            continue
        if margin < room:
            room -= margin
        else:
            room = 0.0
            kept.append(gram)
    if intercept > 0:
        return ""  # anything may pass
    # By first letter, so that few alternatives are tried at a place; words stand between what splits words.
    by_first: dict[str, list[str]] = {}
    for gram in sorted(kept):
        rest = r"[^\p{L}\p{N}]+".join(map(re.escape, gram.split(" ")))
        by_first.setdefault(rest[0], []).append(rest[1:])
    if not by_first:
        return r"\A\z(?!)"
    choices = "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in by_first.items())
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{choices})(?![\p{{L}}\p{{N}}])"


def _fitted(rows: DataFrame, steps: int = STEPS) -> LogisticRegressionModel:
    return LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.2, maxIter=steps).fit(rows)


def _chances(raw: list[float], sharpness: float) -> list[float]:
    top = max(raw)
    powers = [math.exp((x - top) * sharpness) for x in raw]
    return [p / sum(powers) for p in powers]


def calibrated(held: list[tuple[int, list[float]]], unseen: list[list[float]], first_family: int) -> tuple[float, float]:
    """Sharpness with the least loss on variants that were kept out, and the least score of a family at which few notices of
    families that a fit has not seen pass as another."""

    def loss(sharpness: float) -> float:
        return -sum(math.log(_chances(raw, sharpness)[label] + 1e-12) for label, raw in held)

    sharpness = min(TEMPERATURES, key=loss)

    def passing(least: float) -> float:
        wrong = 0
        for raw in unseen:
            chances = _chances(raw, sharpness)
            best = max(range(len(chances)), key=chances.__getitem__)
            wrong += best >= first_family and chances[best] >= least
        return wrong / max(1, len(unseen))

    sure = next((t for t in LEAST_SCORES if passing(t) <= PASS_AS_OTHER), LEAST_SCORES[-1])
    return sharpness, sure


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_sample: int = N_SAMPLE) -> Classifier:
    """Trains on the variants and the first ``N_LINES`` lines of about ``n_sample`` documents chosen by a hash of the id."""
    spark = docs.sparkSession
    made = spark.createDataFrame(variants(), "family string, text string, out boolean, fold int")
    n = docs.count()
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2**30)) / 2**30 < n_sample / max(n, 1)
    plain = docs.where(draw & ~F.col(text_col).rlike(SOUNDS_LIKE)).limit(2 * n_sample).select(
        F.lit(NONE).alias("family"), F.explode(F.slice(F.split(text_col, r"[\r\n]+"), 1, N_LINES)).alias("text"), F.lit(False).alias("out"), F.lit(-1).alias("fold")
    )
    rows = stored(made.unionByName(plain).withColumn("grams", grams(F.col("text"))).coalesce(1), "licence-rows")
    found = [r["gram"] for r in rows.where("family <> 'none'").select(F.explode("grams").alias("gram")).distinct().orderBy("gram").collect()]
    # Numbers and words of one or two letters say nothing on their own.
    vocabulary = [g for g in found if g in MARKS or len(max(re.split(r"[0-9\s]+", g), key=len)) > 2 or re.search(r"[^\d\s]\S* \S", g)]
    families = [NONE, UNKNOWN, *TEMPLATES]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    known = F.transform(F.array(*[F.lit(g) for g in vocabulary]), lambda g: F.array_contains(F.col("grams"), g).cast("double"))
    ready = stored(rows.select("out", "fold", label.alias("label"), array_to_vector(known).alias("features")), "licence-features").persist()

    def without(fold: int) -> list[list[float]]:
        # Class numbers stay as they are: a class without rows has no chance.
        model = _fitted(ready.where(F.col("fold") != fold), FOLD_STEPS)
        missing = {i for i, f in enumerate(families) if i > 1 and (i - 2) % FOLDS == fold}
        scored = model.transform(ready.where(F.col("fold") == fold)).select("rawPrediction").collect()
        return [[-1e9 if i in missing else x for i, x in enumerate([*r[0], *[-1e9] * (len(families) - len(r[0]))])] for r in scored]

    with ThreadPoolExecutor(FOLDS) as pool:
        unseen = [raw for some in pool.map(inheritable_thread_target(spark)(without), range(FOLDS)) for raw in some]
    model = _fitted(ready.where(~F.col("out")))
    held = [(int(r["label"]), list(r["rawPrediction"])) for r in model.transform(ready.where("out")).select("label", "rawPrediction").collect()]
    ready.unpersist()
    sharpness, sure = calibrated(held, unseen, 2)

    matrix = model.coefficientMatrix.toArray()
    bias = [float(x) for x in model.interceptVector]
    margins = {g: float(max(matrix[1:, j] - matrix[0, j])) for j, g in enumerate(vocabulary)}
    gate = gate_pattern(margins, max(bias[1:]) - bias[0])
    weights = [(None, f, bias[i] * sharpness) for i, f in enumerate(families)]
    weights += [(g, f, float(matrix[i, j]) * sharpness) for j, g in enumerate(vocabulary) for i, f in enumerate(families) if matrix[i, j]]
    table = stored(spark.createDataFrame(weights, "gram string, family string, weight double").coalesce(1), "licence-weights")
    return Classifier(table, _templates(spark), families, gate, sure, vocabulary, model)


def _strange(line: Column) -> Column:
    """Whether a line denies a licence or names one that is in no template."""
    words = {w for notices in [*TEMPLATES.values(), ALIKE] for text in notices for w in re.split(r"[^\w]+", text.lower())}
    words |= {"a", "an", "its", "our", "your", "their", "driver", "driving", "standard", "open", "source", "copyright", "spdx"}
    names = F.transform(F.regexp_extract_all(line, F.lit(NAMED), F.lit(1)), lambda n: F.lower(F.regexp_extract(n, r"[\p{L}\p{N}]+", 0)))
    return line.rlike(DENIED) | (F.size(F.array_except(names, F.array(*[F.lit(w) for w in sorted(words)]))) > 0)


def classify(texts: DataFrame, classifier: Classifier) -> DataFrame:
    """key, line, family (or none, unknown), score, template_share, confirmed of every distinct line (column line)."""
    key = F.md5("line").alias("key")
    each = stored(texts.select(key, "line").groupBy("key").agg(F.any_value("line").alias("line")), "licence-lines")
    each = each.withColumn("grams", grams(F.col("line"))).withColumn("strange", _strange(F.col("line")))
    each = each.withColumn("marks", F.array_intersect("grams", F.array(*[F.lit(m) for m in MARKS])))
    words = each.select("key", F.explode("grams").alias("gram"))
    # Both tables have a row or so for each word of the templates above.
    added = words.join(F.broadcast(classifier.weights), "gram").groupBy("key").pivot("family", classifier.families).agg(F.sum("weight"))
    bias = {r["family"]: r["weight"] for r in classifier.weights.where("gram IS NULL").collect()}
    raw = {f: F.coalesce(F.col(f"`{f}`"), F.lit(0.0)) + bias[f] for f in classifier.families}
    scored = each.select("key", "strange", "marks").join(added, "key", "left").select(
        "key", "strange", "marks", F.array(*[F.struct(x.alias("raw"), F.lit(f).alias("family")) for f, x in raw.items()]).alias("all")
    )
    top = F.array_max("all")
    odds = F.aggregate("all", F.lit(0.0), lambda s, x: s + F.exp(x["raw"] - F.array_max(F.col("all"))["raw"]))
    judged = scored.select("key", "strange", "marks", top["family"].alias("likely"), (1 / odds).alias("score"))
    is_mark = F.col("gram").isin(*MARKS)
    shares = words.join(F.broadcast(classifier.templates), "gram").groupBy("key", "family", "template").agg(
        (F.count("*") / F.first("size")).alias("share"), (F.count_if(is_mark) == F.first("marks")).alias("marked")
    )
    shares = shares.groupBy("key", F.col("family").alias("likely")).agg(F.max(F.when(F.col("marked"), F.col("share"))).alias("template_share"))
    own = F.create_map(*[x for f in classifier.families for x in (F.lit(f), F.array(*[F.lit(m) for m in _marks_of(f)]).cast("array<string>"))])
    foreign = F.size(F.array_except("marks", own[F.col("likely")])) > 0
    doubtful = (F.col("score") < classifier.sure) | F.col("strange") | foreign
    family = F.when((F.col("likely") != NONE) & doubtful, UNKNOWN).otherwise(F.col("likely"))
    share = F.coalesce("template_share", F.lit(0.0))
    return judged.join(shares, ["key", "likely"], "left").select(
        "key", family.alias("family"), "score", share.alias("template_share"),
        (~family.isin(NONE, UNKNOWN) & (share >= CONFIRM)).alias("confirmed"),
    )


def _marks_of(family: str) -> list[str]:
    words = {w for text in TEMPLATES.get(family, []) for w in re.split(r"[^a-z0-9]+", text.lower())}
    return sorted(words.intersection(MARKS))


def scan(docs: DataFrame, classifier: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (units that are not none), n_confirmed, n_unknown, families, score: one row per document."""
    classifier = classifier or learn(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    gate = classifier.gate
    # One row for each unit and at least one for each document; only what may be a licence keeps its line.
    every = rows.select("row", "doc_id", F.posexplode_outer(F.when(F.col("text").rlike(gate), units(F.col("text"), gate))).alias("place", "line"))
    found = stored(classifier.possible(every), "licence-found")
    each = found.where(F.col("line").isNotNull()).select("row", "line")
    verdicts = each.groupBy("row", F.md5("line").alias("key")).agg(F.count("*").alias("times")).join(classify(each, classifier), "key")
    yes, no = F.col("confirmed"), ~F.col("confirmed") & (F.col("family") != NONE)
    per = verdicts.groupBy("row").agg(
        F.sum(F.when(F.col("family") != NONE, F.col("times")).otherwise(0)).alias("n_lines"),
        F.sum(F.when(yes, F.col("times")).otherwise(0)).alias("n_confirmed"),
        F.sum(F.when(no, F.col("times")).otherwise(0)).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(yes, F.col("family")))), ",").alias("families"),
        F.max(F.when(yes, F.col("score"))).alias("score"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return found.where(F.coalesce("place", F.lit(0)) == 0).select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", zero("n_lines"), zero("n_confirmed"), zero("n_unknown"), F.coalesce("families", F.lit("")).alias("families"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
