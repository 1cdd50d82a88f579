"""Licence scans: a trained paragraph classifier over sparse word n-grams, its verdicts confirmed by comparison with templates.

The scan is DataFrame functions throughout. Only the fit, on the templates and a bounded sample of paragraphs, is done on the driver.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

#: Sentences by which each family of licences is known; fixed values, a few per family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This software is available under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 license.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GPL version 2 or later.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}
#: Paragraphs that speak of licences and name none; fixed values.
OTHERS = (
    "a driving license is required to rent a car",
    "the license plate of the vehicle was not found",
    "the version of the story that was released under the old name",
    "the public library is open and free of charge to any person",
    "terms and conditions of the general agreement are available",
    "this work is part of the series and may be used with this program",
    "the source of the river is in the north of the county",
    "under the law of the state the company was licensed to sell wine",
    "the university of california is a public university",
    "the foundation released its annual report, version 2.0 of which is available",
)
#: See paragraphs().
RUN = 1 << 32
UNKNOWN, NONE = "unknown", "none"
#: Words that say nothing of licences. Fixed values.
COMMON = frozenset(
    """
    the a an of to in and or for on with as at by from is are was were be been it its that this these those
    you your we our they their may can will shall has have had not no any all such under which who more less
    """.split()
)


@dataclass(frozen=True)
class Limits:
    """Bounds of the fit and thresholds of the verdict."""

    sample_rows: int = 2_000  # paragraphs of the corpus taken for the unknown class
    most_chars: int = 2_000  # of a sampled paragraph, in the fit alone
    steps: int = 300
    probability: float = 0.5  # of a family, calibrated, or the paragraph is of no family
    shared: float = 0.6  # of a template's word triples, or the verdict isn't confirmed


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]  # of an n-gram, by family and last the unknown class
    bias: tuple[float, ...]
    temperature: float


def grams(words: list[str]) -> set[str]:
    """Word bigrams and trigrams, and the words that hold a digit or hyphen-free short code such as gpl."""
    return {" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def fit(negatives: list[str], limits: Limits = Limits()) -> Model:
    """Softmax regression on the templates, whole and in the midst of other words, against OTHERS and the sampled paragraphs.

    A temperature is then set on noisy copies of the templates held back from the fit, so that probabilities, that of the
    unknown class among them, are as sure as they are right.
    """
    import random

    import numpy as np

    rnd = random.Random(11)
    families = tuple(TEMPLATES)
    plain = [words_of(t[: limits.most_chars]) for t in negatives if not re.search(r"(?i)licen[sc]|copyright", t)]
    filler = [w for t in plain[:200] for w in t[:20]] or ["the", "of", "and"]

    def noisy(words: list[str]) -> list[str]:
        around = [rnd.choice(filler) for _ in range(rnd.randint(0, 30))]
        at = rnd.randint(0, len(around))
        inner = [w for w in words if rnd.random() > 0.08]
        return around[:at] + inner + around[at:]

    train, held = [], []
    for k, name in enumerate(families):
        for t in TEMPLATES[name]:
            w = words_of(t)
            train += [(w, k)] * 4 + [(noisy(w), k) for _ in range(8)]
            held += [(noisy(w), k) for _ in range(4)]
    other = [words_of(t) for t in OTHERS] + plain
    train += [(w, len(families)) for i, w in enumerate(other) if i % 5]
    held += [(w, len(families)) for i, w in enumerate(other) if not i % 5]
    vocabulary = sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(words_of(t))})
    at = {g: i for i, g in enumerate(vocabulary)}

    def matrix(rows):
        x = np.zeros((len(rows), len(vocabulary) + 1), dtype=np.float32)
        for r, (words, _) in enumerate(rows):
            x[r, [at[g] for g in grams(words) if g in at]] = 1
        x[:, -1] = 1
        return x, np.array([k for _, k in rows])

    x, y = matrix(train)
    target = np.eye(len(families) + 1, dtype=np.float32)[y]
    share = (1 / np.bincount(y, minlength=len(families) + 1).clip(1))[y][:, None]  # each class has the same say
    w = np.zeros((x.shape[1], len(families) + 1), dtype=np.float32)
    for _ in range(limits.steps):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        w -= 2.0 * (x.T @ (share * (z / z.sum(axis=1, keepdims=True) - target)) / len(families) + 1e-4 * w)
    hx, hy = matrix(held)

    def loss(temperature: float) -> float:
        z = hx @ w / temperature
        z -= z.max(axis=1, keepdims=True)
        return float(-(z[np.arange(len(hy)), hy] - np.log(np.exp(z).sum(axis=1))).mean())

    temperature = min((0.1 * k for k in range(2, 41)), key=loss)
    return Model(families, {g: tuple(map(float, w[i])) for g, i in at.items()}, tuple(map(float, w[-1])), temperature)


def inline(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from rows, as a literal in the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (a struct of v, so that null ids are equal, and a hash of the text), para and words of each line, and of each run of several
    lines, of two words or more.

    Runs end at lines without letters or digits of ASCII; comment marks fall away with other signs. para is RUN times the run's
    number, both from 0, and for a line its number in the run, from 1, on top.
    """
    runs = docs.select(F.struct(F.col(id_col).alias("v"), F.xxhash64(text_col).alias("h")).alias("id"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), r"\n[^A-Za-z0-9\n]*+(?=\n)")).alias("run", "body"))
    split = F.split("body", "\n")
    worded = F.size(F.filter(split, lambda x: x.rlike("[A-Za-z0-9]")))
    lines = runs.select("id", "run", F.posexplode(F.concat(F.array(F.when(worded > 1, F.col("body")).otherwise("")), split)).alias("at", "line"))
    return lines.select("id", (F.col("run") * F.lit(RUN) + F.col("at")).alias("para"), F.filter(F.split(F.lower("line"), "[^a-z0-9]+"), lambda w: w != "").alias("words")).where(F.size("words") > 1)


def sampled_paragraphs(docs: DataFrame, limits: Limits, text_col: str) -> list[str]:
    """About limits.sample_rows lines, one of each text that a hash picks."""
    n = max(docs.count(), 1)
    share = F.pmod(F.xxhash64(text_col, F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    lines = F.split(F.coalesce(text_col, F.lit("")), "\n")
    picked = F.substring(lines[F.pmod(F.xxhash64(text_col), F.size(lines)).cast("int")], 1, limits.most_chars)
    return sorted(r[0] for r in docs.where(share < limits.sample_rows / n).select(picked).distinct().limit(2 * limits.sample_rows).collect())


def telling_words() -> list[str]:
    """The words of the templates that aren't common ones: a line without any has too few triples of any template to be confirmed."""
    return sorted({w for ts in TEMPLATES.values() for t in ts for w in words_of(t)} - COMMON)


def _ngrams(words: str, n: int) -> Column:
    return F.expr(f"if(size({words}) >= {n}, transform(sequence(0, size({words}) - {n}), i -> array_join(slice({words}, i + 1, {n}), ' ')), array())")


def scan(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """Per distinct id: id_col, family, probability, shared and n_paragraphs.

    family is that of the surest confirmed paragraph (ties: the first family by name), `unknown` if paragraphs look licensed
    but no template confirms it, `none` otherwise. probability is the classifier's, calibrated; shared is the share of the
    template's word triples that the paragraph has; n_paragraphs counts the confirmed ones. A paragraph is a line, or a
    run of lines if as a whole it is confirmed (counted if none of its lines is), as texts may be wrapped. Null and empty texts are `none`; null ids are one id; rows with the same id are scanned as one document, of which equal texts are there once. Other columns are not
    returned. An empty table gives no rows.
    """
    spark = docs.sparkSession
    model = model or fit(sampled_paragraphs(docs, limits, text_col), limits)
    classes = len(model.families) + 1
    weights = inline(spark, [{"gram": g, "w": list(w)} for g, w in model.weights.items()], "gram string, w array<double>")

    paras = paragraphs(docs, id_col, text_col)
    telling = paras.where(F.exists("words", lambda w: w.isin(*telling_words())))  # no other line can be confirmed, so none is counted
    # a line without any n-gram that lifts a family over the unknown class is of none; texts are read once, the few lines left are written
    listed = F.array_distinct(F.filter(F.concat(_ngrams("words", 2), _ngrams("words", 3)), lambda g: g.isin(*model.weights)))
    lifting = [g for g, w in model.weights.items() if max(w[:-1]) > w[-1]]
    lines = telling.select("id", "para", "words", F.explode(F.array(listed)).alias("grams"))  # of one, else Spark would work words out for each n-gram
    lines = written(lines.where(F.exists("grams", lambda g: g.isin(*lifting))).dropDuplicates(["id", "para"]))  # rows that are equal are one
    hits = lines.select("id", "para", F.explode("grams").alias("gram")).join(F.broadcast(weights), "gram")
    sums = hits.groupBy("id", "para").agg(*[F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(classes)])
    logits = [(F.col(f"w{k}") + model.bias[k]) / model.temperature for k in range(classes)]
    top = F.greatest(*logits)
    scored = sums.select("id", "para", F.array(*[F.exp(z - top) for z in logits]).alias("e"))
    scored = scored.withColumn("best", F.array_max(F.slice("e", 1, classes - 1))).withColumn("k", F.array_position("e", F.col("best")).cast("int"))
    scored = scored.withColumn("probability", F.col("best") / F.aggregate("e", F.lit(0.0), lambda a, b: a + b))
    names = F.array(*map(F.lit, model.families))
    likely = scored.where((F.col("probability") >= limits.probability) & (F.col("k") < classes)).select("id", "para", names[F.col("k") - 1].alias("family"), "probability")

    triples = inline(spark, [{"family": f, "template": i, "triples": sorted({" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))})} for f, ts in TEMPLATES.items() for i, t in enumerate(ts) if (w := words_of(t))], "family string, template int, triples array<string>")
    compared = likely.join(lines, ["id", "para"]).join(F.broadcast(triples), "family")  # a handful of templates a family
    share = F.size(F.array_intersect("triples", F.array_union(_ngrams("words", 3), F.array(F.array_join("words", " "))))) / F.size("triples")
    best = compared.withColumn("shared", share).groupBy("id", "para", "family").agg(F.max("shared").alias("shared"), F.first("probability").alias("probability"))
    confirmed = F.col("shared") >= limits.shared
    is_line = F.col("para") % RUN > 0
    rank = F.struct(confirmed, "probability", F.negative("para"))
    verdict = F.struct(F.when(confirmed, F.col("family")).otherwise(UNKNOWN).alias("family"), "probability", "shared")
    of_run = best.where(is_line | confirmed).groupBy("id", F.expr(f"para div {RUN}").alias("run")).agg(
        F.max_by(verdict, rank).alias("x"), F.max(rank).alias("rank"), F.count_if(confirmed & is_line).alias("lines"), F.count_if(confirmed).alias("all")
    )
    found = of_run.groupBy(F.struct("id.v").alias("id")).agg(F.max_by("x", "rank").alias("x"), F.sum(F.when(F.col("lines") > 0, F.col("lines")).otherwise(F.col("all"))).alias("n_paragraphs"))
    joined = docs.select(F.struct(F.col(id_col).alias("v")).alias("id")).distinct().join(found, "id", "left")
    return joined.select(
        F.col("id.v").alias(id_col),
        F.coalesce("x.family", F.lit(NONE)).alias("family"),
        F.coalesce("x.probability", F.lit(0.0)).alias("probability"),
        F.coalesce("x.shared", F.lit(0.0)).alias("shared"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
    )
