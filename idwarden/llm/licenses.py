"""Licence statements in texts: a sparse n-gram model over paragraphs, confirmed by templates.

Blank lines part a text into paragraphs. The model sees each line and each run of lines of a paragraph that can hold a wrapped
statement: one with no more than ``LONGEST`` words between its first and last line. The model is a multinomial logistic regression with elastic-net penalty over the distinct
word 1-, 2- and 3-grams of a paragraph, with one class per licence family and one for unknown. It is trained on the statements
below, in all their forms, against ``UNKNOWN_DOCS`` documents' lines (those of the lowest hash of the id) and phrases that only
resemble statements. A fifth of these rows sets the temperature of the probabilities and the probability from which a
family is believed, so that unknown paragraphs stay unknown. A believed family is confirmed if the line or run holds
``CONFIRMED`` of the grams of one of the family's templates. Of findings that overlap, confirmed ones come first, then short ones.

What the model cannot believe is passed over before it is scored, which loses nothing: each word has a bound on how far the grams it
stands for raise a family over unknown (as grams count once), in parts of what belief needs. Bounds of the words of a line or run
that add up to less than 1 leave it unknown, and so does a text without any of the ``cues``, as all other bounds add up to less than 1.

Only DataFrame functions and pyspark.ml: scoring is one projection without shuffle. NULL and empty texts have no paragraphs; a
text without statements has families ''.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.llm.store import save

UNKNOWN_DOCS, UNKNOWN_LINES, CONFIRMED, LEAST_PROBABILITY = 200, 1500, 0.6, 0.5
UNKNOWN, FOUND = "unknown", "array<struct<line:int,family:string,probability:double,similarity:double>>"

# Names of licences and sentences of their texts.
NAMES = {
    "mit": ("MIT License", "MIT licence", "Expat License"),
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license"),
    "gpl-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0", "GNU General Public License v3.0 or later"),
    "gpl-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0", "GNU General Public License v2.0 only"),
    "lgpl": ("GNU Lesser General Public License", "LGPL v2.1", "LGPL-3.0", "GNU LGPL"),
    "agpl-3.0": ("GNU Affero General Public License", "AGPL v3", "AGPL-3.0"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "BSD license", "New BSD License"),
    "mpl-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"),
    "isc": ("ISC License", "ISC licence"),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY 3.0"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 3.0"),
    "cc-by-nd": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "cc0": ("CC0 1.0", "Creative Commons Zero", "CC0 public domain dedication"),
}
SENTENCES = {
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",),
    "apache-2.0": ("you may not use this file except in compliance with the License",),
    "gpl-3.0": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",),
    "gpl-2.0": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "all-rights-reserved": ("All rights reserved",),
}
FORMS = (
    "{}", "{}.", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Released under {}.", "This work is licensed under the {}.",
    "This work is licensed under a {}.", "Distributed under the terms of the {}.", "This project is made available under the {}, see LICENSE.",
    "SPDX-License-Identifier: {}", "License: {}", "Copyright (c) 2021 the authors. Licensed under the {}.", "The text is available under {}; additional terms may apply.",
)
SENTENCE_FORMS = ("{}", "{}.", "Copyright (c) 2020 the authors. {}.", "Copyright 2023, the publisher. {}.", "(c) 1999-2024 {}.")
NOT_LICENCES = (
    "She holds a driving license.", "The license plate of the car was stolen.", "Licensed premises close at eleven.", "An apache helicopter landed.",
    "Students at MIT build robots.", "All human beings are equal in dignity and rights.", "The rights of the child are reserved for the next chapter.",
    "Released under pressure, the gas expands.", "The creative commons of the town", "This work is under way.", "version 3 of the report", "All rights of way",
    "He was granted permission to leave free of charge.", "The general public may visit.", "Mozilla is a company.", "The seat is reserved.",
)
#: A word of a gram.
WORD = r"([a-z0-9]+(?:[.-][a-z0-9]+)*)"
#: Words of the longest statement that the model learns.
LONGEST = max(len(form.format(text).split()) for table, forms in ((NAMES, FORMS), (SENTENCES, SENTENCE_FORMS)) for some in table.values() for text in some for form in forms)


def lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")


def grams(text: Column) -> Column:
    """The distinct word 1-, 2- and 3-grams."""
    return _grams(_words(text))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1))


def _grams(words: Column) -> Column:
    def of(n):
        return F.transform(words, lambda _, i: F.concat_ws(" ", F.slice(words, i + 1, n)))

    many = F.array_distinct(F.concat(of(1), of(2), of(3)))
    return F.when(F.size(words) > 0, many).otherwise(F.array().cast("array<string>"))


def statements() -> list[tuple[str, str]]:
    """(family, text) of all forms of all names and sentences, and of phrases that are no statements."""
    out = [(f, form.format(n)) for f, names in NAMES.items() for n in names for form in FORMS]
    out += [(f, form.format(s)) for f, some in SENTENCES.items() for s in some for form in SENTENCE_FORMS]
    return out + [(UNKNOWN, t) for t in NOT_LICENCES]


def literal(value, kind: str) -> Column:
    """A constant of a nested type."""
    return F.from_json(F.lit(json.dumps(value)), kind)


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]
    weights: dict[str, list[float]]  # by gram, one for each family; divided by the temperature
    intercepts: tuple[float, ...]
    believed_from: float
    bounds: dict[str, float]  # by word
    cues: tuple[str, ...]

    def has_cue(self, text: Column) -> Column:
        if not self.cues:
            return text.isNotNull()
        return F.lower(text).rlike("(?<![a-z0-9])(?:" + "|".join(cue.replace(".", "[.]") for cue in self.cues) + ")(?![a-z0-9])")

    def probabilities(self, some_grams: Column) -> Column:
        """One probability for each family, of a paragraph's grams."""
        table = literal(self.weights, "map<string,array<double>>")
        logits = F.aggregate(
            some_grams, literal(list(self.intercepts), "array<double>"),
            lambda acc, g: F.zip_with(acc, F.coalesce(F.try_element_at(table, g), literal([0.0] * len(self.families), "array<double>")), lambda x, y: x + y),
        )
        # Each step as its own projection over an array of one, so that nothing is computed twice.
        raised = F.transform(F.array(logits), lambda x: F.transform(x, lambda v: F.exp(v - F.array_max(x))))
        return F.transform(raised, lambda x: F.transform(x, lambda v: v / F.aggregate(x, F.lit(0.0), lambda s, y: s + y)))[0]

    def findings(self, docs: DataFrame) -> DataFrame:
        """doc_id and an array of (line, family, probability, similarity) of the lines and runs that hold a statement, by their first line.

        Each step is a column of its own, so that nothing is computed twice.
        """
        names = literal(list(self.families), "array<string>")
        templates = literal(_templates(), "map<string,array<array<string>>>")

        bounds = literal(self.bounds, "map<string,double>")

        def bound(words: Column) -> Column:
            if not self.bounds:
                return F.lit(1.0)
            return F.aggregate(F.array_distinct(words), F.lit(0.0), lambda n, w: n + F.coalesce(F.try_element_at(bounds, w), F.lit(0.0)))

        def marked(x: Column) -> Column:
            before = F.slice("words", 1, x["line"])
            return F.struct(
                x["line"].alias("line"), x["bound"].alias("bound"), F.aggregate(before, F.lit(0), lambda n, y: n + F.size(y)).alias("before"),
                F.size(F.element_at("words", x["line"] + 1)).alias("n"), F.size(F.filter(F.slice("lines", 1, x["line"]), lambda y: F.trim(y) == "")).alias("paragraph"),
            )

        def run(first: Column, last: Column) -> Column:
            text = F.array_join(F.slice("lines", first["line"] + 1, last["line"] - first["line"] + 1), " ")
            return F.struct(first["line"].alias("line"), last["line"].alias("last"), text.alias("text"))

        def runs_from(first: Column) -> Column:
            def can(last: Column) -> Column:
                inside = F.filter("marked", lambda x: x["line"].between(first["line"], last["line"]))
                return (
                    (last["line"] >= first["line"]) & (last["paragraph"] == first["paragraph"]) & (last["before"] - first["before"] - first["n"] <= LONGEST)
                    & (F.aggregate(inside, F.lit(0.0), lambda n, x: n + x["bound"]) >= 1))

            return F.transform(F.filter("marked", can), lambda last: run(first, last))

        def named(x: Column) -> Column:
            best = F.array_max(x["p"])
            return F.struct(
                x["line"].alias("line"), x["last"].alias("last"), x["grams"].alias("grams"), best.alias("probability"),
                names[F.array_position(x["p"], best).cast("int") - 1].alias("family"))

        def ranked(x: Column) -> Column:
            alike = F.transform(F.try_element_at(templates, x["family"]), lambda t: F.size(F.array_intersect(t, x["grams"])) / F.size(t))
            similarity = F.coalesce(F.array_max(alike), F.lit(0.0))
            # In this order they are taken.
            return F.struct(
                (similarity < CONFIRMED).alias("unconfirmed"), (x["last"] - x["line"]).alias("more"), x["line"].alias("line"),
                x["family"].alias("family"), x["probability"].alias("probability"), similarity.alias("similarity"))

        def apart(x: Column, y: Column) -> Column:
            return (x["line"] + x["more"] < y["line"]) | (y["line"] + y["more"] < x["line"])

        def taken(acc: Column, x: Column) -> Column:
            return F.when(F.forall(acc, lambda y: apart(x, y)), F.array_append(acc, x)).otherwise(acc)

        kind = "array<struct<unconfirmed:boolean,more:int,line:int,family:string,probability:double,similarity:double>>"
        steps = {
            "lines": F.split("text", "\n"),
            "words": F.transform("lines", _words),
            "bounds": F.transform("words", lambda x, i: F.struct(i.alias("line"), bound(x).alias("bound"))),
            "marked": F.transform(F.filter("bounds", lambda x: x["bound"] > 0), marked),
            "units": F.flatten(F.transform("marked", runs_from)),
            "grams": F.transform("units", lambda x: F.struct(x["line"].alias("line"), x["last"].alias("last"), grams(x["text"]).alias("grams"))),
            "scored": F.transform("grams", lambda x: F.struct(
                x["line"].alias("line"), x["last"].alias("last"), x["grams"].alias("grams"), self.probabilities(x["grams"]).alias("p"))),
            "named": F.filter(F.transform("scored", named), lambda x: (x["family"] != UNKNOWN) & (x["probability"] >= self.believed_from)),
            "ranked": F.array_sort(F.transform("named", ranked)),
            "found": F.array_sort(F.transform(F.aggregate("ranked", F.array().cast(kind), taken), lambda x: F.struct(
                x["line"].alias("line"), x["family"].alias("family"), x["probability"].alias("probability"), x["similarity"].alias("similarity")))),
        }
        for name, column in steps.items():
            docs = docs.withColumn(name, F.when(F.col("cued"), column))
        return docs.select("doc_id", F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def _templates() -> dict[str, list[list[str]]]:
    """The grams of each family's names and sentences."""
    import re

    out: dict[str, list[list[str]]] = {}
    for table in (NAMES, SENTENCES):
        for family, texts in table.items():
            for text in texts:
                words = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())
                out.setdefault(family, []).append(sorted({" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}))
    return out


def fit(docs: DataFrame) -> Model:
    """Train on the statements and on lines of a bounded number of ``docs`` (doc_id, text)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    spark: SparkSession = docs.sparkSession
    known = spark.range(1).select(F.inline(literal([{"family": f, "text": t} for f, t in statements()], "array<struct<family:string,text:string>>")))
    some = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(UNKNOWN_DOCS)
    resembling = "(?i)licen[sc]|copyright|rights reserved|public domain|\\bgpl\\b"
    # At most UNKNOWN_DOCS ids: safe to broadcast.
    corpus = (
        docs.join(F.broadcast(some), "doc_id").select(F.explode(lines(F.col("text"))).alias("text"))
        .where(~F.col("text").rlike(resembling)).distinct().orderBy(F.xxhash64("text"), "text").limit(UNKNOWN_LINES)
        .select(F.lit(UNKNOWN).alias("family"), "text")
    )
    families = (UNKNOWN, *sorted({f for f, _ in statements()} - {UNKNOWN}))
    number = F.array_position(literal(list(families), "array<string>"), F.col("family")) - 1
    rows = save(
        known.unionByName(corpus).select(number.cast("double").alias("label"), grams(F.col("text")).alias("grams"), (F.pmod(F.xxhash64("text", "family"), F.lit(5)) == 0).alias("calibrates")),
        "licence-sample",
    ).coalesce(1).cache()
    vocabulary = CountVectorizer(inputCol="grams", outputCol="x", binary=True, minDF=2, vocabSize=6000).fit(rows.where("label > 0"))
    marked = vocabulary.transform(rows).cache()
    regression = LogisticRegression(labelCol="label", featuresCol="x", family="multinomial", regParam=5e-4, elasticNetParam=0.5, maxIter=100)
    fitted = regression.fit(marked.where("NOT calibrates"))

    calibrating = [(int(r["label"]), r["rawPrediction"].toArray().tolist()) for r in fitted.transform(marked.where("calibrates")).select("label", "rawPrediction").collect()]

    def chances(logits, t):
        top = max(logits)
        e = [math.exp((v - top) / t) for v in logits]
        return [v / sum(e) for v in e]

    def loss(t):
        return -sum(math.log(max(chances(x, t)[y], 1e-12)) for y, x in calibrating)

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss) if calibrating else 1.0
    mistaken = max((max(chances(x, temperature)[1:]) for y, x in calibrating if y == 0), default=0.0)
    coefficients = fitted.coefficientMatrix.toArray() / temperature
    weights = {g: [float(v) for v in coefficients[:, k]] for k, g in enumerate(vocabulary.vocabulary) if coefficients[:, k].any()}
    intercepts = tuple(float(v) / temperature for v in fitted.interceptVector.toArray())
    believed_from = max(LEAST_PROBABILITY, min(mistaken, 0.9))
    bounds, cues = _bounds(weights, intercepts, believed_from, rows)
    rows.unpersist()
    marked.unpersist()
    return Model(families, weights, intercepts, believed_from, bounds, cues)


def _bounds(weights: dict[str, list[float]], intercepts: tuple[float, ...], believed_from: float, rows: DataFrame) -> tuple[dict[str, float], tuple[str, ...]]:
    """A bound for each word, such that a family is believed only where the bounds of the words add up to 1; and the cues.

    A family is believed with p >= b only if the weights of the grams present raise it over unknown by at least the difference of the
    intercepts plus log(b / (1 - b)). A gram counts for the least common of its words. Words that are no cues are the most common
    ones, as many as add up to less than 1.
    """
    common: dict[str, int] = {}
    for r in rows.where("label = 0").select(F.filter("grams", lambda g: ~g.contains(" ")).alias("grams")).collect():
        for word in r["grams"]:
            common[word] = common.get(word, 0) + 1
    needed = [intercepts[0] - v + math.log(believed_from / (1 - believed_from)) - 1e-6 for v in intercepts[1:]]
    if min(needed) <= 0:  # a family may be believed without any gram: all is scored
        return {}, ()
    of_word: dict[str, list[float]] = {}
    for gram, w in weights.items():
        owner = of_word.setdefault(min(gram.split(" "), key=lambda x: (common.get(x, 0), x)), [0.0] * len(needed))
        for f, v in enumerate(w[1:]):
            owner[f] += max(0.0, v - w[0])
    bounds = {word: max(v / need for v, need in zip(raised, needed)) for word, raised in of_word.items()}
    bounds = {word: v for word, v in bounds.items() if v > 0}
    cues, rest = [], 0.0
    for word in sorted(bounds, key=lambda x: (-common.get(x, 0) / bounds[x], bounds[x], x)):
        if rest + bounds[word] < 1 - 1e-6:
            rest += bounds[word]
        else:
            cues.append(word)
    return bounds, tuple(cues)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the findings of each row of ``docs`` (doc_id, text)."""
    return model.findings(docs.select("doc_id", "text", F.coalesce(model.has_cue(F.col("text")), F.lit(False)).alias("cued")))


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, families, confirmed families, statements, confirmed statements and the first statement's line of each row."""
    def listed(test):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(F.filter("found", test), lambda x: x["family"]))))

    confirmed = lambda x: x["similarity"] >= CONFIRMED
    return scan(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", listed(lambda x: F.lit(True)).alias("families"), listed(confirmed).alias("confirmed_families"),
        F.size("found").cast("long").alias("n_statements"), F.size(F.filter("found", confirmed)).cast("long").alias("n_confirmed"),
        F.try_element_at("found", F.lit(1))["line"].cast("long").alias("first_line"),
    )
