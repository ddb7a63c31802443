"""Licence scans: a trained paragraph classifier, in DataFrame operations only.

Paragraphs are lines. A multinomial logistic regression over sparse word 1- and 2-grams tells licence families and
'unknown' apart. It is trained on the families' templates, on templates with words left out or inside other words, and on a bounded sample
of the corpus's own paragraphs as unknown; the share of n-grams that no template has is a feature. The level that a
family's probability must reach is set on sampled paragraphs held out from training: what one in a thousand of the
unknown passes, but 0.5 at least and 0.95 at most. A prediction stands only if a template of that family confirms it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import discard, let, written

# Short public licence notices, by family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "all-rights-reserved": ["All rights reserved."],
}
FAMILIES = sorted(TEMPLATES)
SAMPLE, INSIDE, ROUNDS, STEP, CONFIRM = 4000, 60, 25, 4.0, 0.8


def words_of(text: Column) -> Column:
    """Words [a-z0-9]+ of lower-cased text."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), "")


def grams_of(words: Column) -> Column:
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)


def _py_words(text: str) -> list[str]:
    import re

    return re.findall(r"[a-z0-9]+", text.lower())


def _py_grams(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


class Model:
    """vocabulary, weights[gram, class] (the last row: the share of other grams), bias and the level to reach. The last class is unknown."""

    def __init__(self, vocabulary, weights, bias, level):
        self.vocabulary, self.weights, self.bias, self.level = vocabulary, weights, bias, level


def _numbers(values) -> Column:
    """An array literal made from one string."""
    return F.split(F.lit(",".join(repr(float(x)) for x in values)), ",").cast("array<double>")


def _vectors(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """rows (y, grams, held) with own (places of known grams, from 1), other (the share of unknown ones) and scale."""
    table = F.split(F.lit(",".join(vocabulary)), ",")
    own = F.filter(F.transform("grams", lambda g: F.array_position(table, g).cast("int")), lambda i: i > 0)
    n = F.greatest(F.size("grams"), F.lit(1)).cast("double")
    return rows.select("y", "held", own.alias("own"), n.alias("n")).select("y", "held", "own", (1 - F.size("own") / F.col("n")).alias("other"), (1 / F.sqrt("n")).alias("scale"))


def _probabilities(weights: np.ndarray, bias: np.ndarray) -> Column:
    """The classes' probabilities, as an array."""

    def score(c: int) -> Column:
        return F.aggregate("own", F.lit(0.0), lambda s, i: s + F.element_at(_numbers(weights[:-1, c]), i)) * F.col("scale") + F.col("other") * float(weights[-1, c]) + float(bias[c])

    e = let(F.array(*[score(c) for c in range(weights.shape[1])]), lambda z: F.transform(z, lambda x: F.exp(x - F.array_max(z))))
    return let(e, lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda s, y: s + y)))


def train_scanner(docs: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Learns from the templates and from `sample` paragraphs of docs at most, taken in the order of a hash; sampled
    paragraphs that hold CONFIRM of a template's words are left out, as they may be licences."""
    spark = docs.sparkSession
    known, vocabulary = [], sorted({g for f in FAMILIES for t in TEMPLATES[f] for g in _py_grams(_py_words(t))})
    for c, f in enumerate(FAMILIES):
        for t in TEMPLATES[f]:
            w = _py_words(t)
            short = [w[:i] + w[i + 1 :] for i in range(len(w))] if len(w) > 4 else []
            known += [(c, _py_grams(x)) for x in [w, w, w, *short]]
    lines = docs.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line")).where("trim(line) <> ''")
    n = docs.agg(F.sum(F.size(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")))).first()[0] or 1
    near = F.pmod(F.xxhash64("line", F.lit(2)), F.lit(1 << 30)) < min(1 << 30, (1 << 30) * 4 * sample // n)  # only those come to be sorted
    drawn = lines.where(near).dropDuplicates(["line"]).orderBy(F.xxhash64("line"), "line").limit(sample).select(words_of(F.col("line")).alias("w"), (F.pmod(F.xxhash64("line", F.lit(1)), F.lit(4)) == 0).alias("held"))
    maybe = F.lit(False)
    for f in FAMILIES:
        for t in TEMPLATES[f]:
            w = sorted(set(_py_words(t)))
            maybe = maybe | (F.size(F.array_intersect("w", F.array(*[F.lit(x) for x in w]))) >= math.ceil(CONFIRM * len(w)))
    unknown = drawn.where(~maybe).select(F.lit(len(FAMILIES)).alias("y"), let(F.col("w"), grams_of).alias("grams"), "held")
    # Templates within other words: each inside some sampled paragraphs' first words.
    short = drawn.where(~maybe & (F.size("w") > 3)).limit(INSIDE).select(F.slice("w", 1, 16).alias("w"))
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("y"), F.array(*[F.lit(x) for x in _py_words(t)]).alias("t")) for c, f in enumerate(FAMILIES) for t in TEMPLATES[f]]))
    half = F.floor(F.size("w") / 2).cast("int")
    inside = short.select("w", parts.alias("p")).select("p.y", F.concat(F.slice("w", 1, half), F.col("p.t"), F.slice("w", half + 1, F.lit(16))).alias("w"))
    inside = inside.select("y", let(F.col("w"), grams_of).alias("grams"), F.lit(False).alias("held"))
    rows = spark.createDataFrame(known, "y int, grams array<string>").withColumn("held", F.lit(False)).unionByName(unknown).unionByName(inside)
    data = written(_vectors(rows, vocabulary).coalesce(4), "paragraphs")
    k, v = len(FAMILIES) + 1, len(vocabulary)
    n = {r["y"]: r["n"] for r in data.where("not held").groupBy("y").agg(F.count("*").alias("n")).collect()}
    weight = F.lit(0.0)
    for c, m in n.items():
        weight = F.when(F.col("y") == c, 1.0 / (m * len(n))).otherwise(weight)
    weights, bias, seen_w, seen_b = np.zeros((v + 1, k)), np.zeros(k), np.full((v + 1, k), 1e-8), np.full(k, 1e-8)
    cells = F.concat(F.transform("own", lambda i: F.struct((i - 1).alias("i"), F.col("scale").alias("x"))), F.array(F.struct(F.lit(v).alias("i"), F.col("other").alias("x")), F.struct(F.lit(v + 1).alias("i"), F.lit(1.0).alias("x"))))
    for _ in range(rounds):
        each = data.where("not held").select("y", weight.alias("weight"), _probabilities(weights, bias).alias("p"), "own", "scale", "other").select("y", "weight", "p", F.explode(cells).alias("c"))
        error = [F.sum((F.col("p")[c] - (F.col("y") == c).cast("double")) * F.col("weight") * F.col("c.x")).alias(f"g{c}") for c in range(k)]
        sums = each.groupBy("c.i").agg(*error).collect()
        g = np.zeros((v + 2, k))
        for r in sums:
            g[r["i"]] = [r[f"g{c}"] for c in range(k)]
        gw, gb = g[: v + 1] + 1e-4 * weights, g[v + 1]
        seen_w += gw**2
        seen_b += gb**2
        weights -= STEP * 0.25 * gw / np.sqrt(seen_w)
        bias -= STEP * 0.25 * gb / np.sqrt(seen_b)
    best = F.array_max(F.slice(_probabilities(weights, bias), 1, k - 1))
    level = data.where("held").agg(F.percentile(best, 0.999)).first()[0]
    discard(data)
    return Model(vocabulary, weights, bias, min(0.95, max(0.5, level or 0.5)))


def scan_licenses(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_paragraphs, n_license (confirmed paragraphs), n_unconfirmed
    (predicted as a family, but no template agrees), licenses (families, sorted), license_lines (places from 0, sorted).

    Null texts have no paragraph, empty texts one. Null ids are told apart by their texts; repeated rows are each
    returned, all alike. An empty table: no rows. Other columns are ignored; columns of docs may have any names."""
    spark = docs.sparkSession
    k = len(FAMILIES) + 1
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    lines = rows.where("text is not null").select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line", "par"))
    grams = lines.select("doc_id", "th", "line", let(words_of(F.col("par")), grams_of).alias("grams"))
    grams = grams.select("doc_id", "th", "line", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    table = spark.createDataFrame([(g, i if " " not in g else None, *map(float, model.weights[i])) for i, g in enumerate(model.vocabulary)], "gram string, word int, " + ", ".join(f"w{c} double" for c in range(k)))
    hits = grams.join(F.broadcast(table), "gram")  # as many rows as the templates have n-grams
    # A repeated row adds its grams again: counts of a gram are divided by how often the row comes.
    times = rows.groupBy("doc_id", "th").agg(F.count("*").alias("times"), F.first(F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))).alias("n_paragraphs"))
    found = hits.groupBy("doc_id", "th", "line", "n").agg(F.count("*").alias("m"), F.collect_set("word").alias("own"), *[F.sum(f"w{c}").alias(f"s{c}") for c in range(k)])
    found = found.join(times.where("times > 1").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "times"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left").withColumn("r", F.coalesce("times", F.lit(1)))
    z = [F.col(f"s{c}") / F.col("r") / F.sqrt(F.col("n").cast("double")) + (1 - F.col("m") / F.col("r") / F.col("n")) * float(model.weights[-1, c]) + float(model.bias[c]) for c in range(k)]
    found = found.select("doc_id", "th", "line", "own", *[z[c].alias(f"z{c}") for c in range(k)])
    top = F.greatest(*[f"z{c}" for c in range(k)])
    total = sum((F.exp(F.col(f"z{c}") - top) for c in range(1, k)), F.exp(F.col("z0") - top))
    family = F.element_at(F.array(*[F.lit(f) for f in FAMILIES], F.lit(None).cast("string")), F.array_position(F.array(*[F.col(f"z{c}") for c in range(k)]), top).cast("int"))
    found = found.withColumn("family", F.when(F.exp(F.greatest(*[f"z{c}" for c in range(k - 1)]) - top) / total >= model.level, family)).where("family is not null")
    place = {g: i for i, g in enumerate(model.vocabulary)}
    agrees = F.lit(False)
    for f in FAMILIES:
        for t in TEMPLATES[f]:
            w = sorted({place[x] for x in _py_words(t)})
            agrees = agrees | ((F.col("family") == f) & (F.size(F.array_intersect("own", F.array(*[F.lit(x) for x in w]))) >= math.ceil(CONFIRM * len(w))))
    found = found.withColumn("sure", agrees).groupBy("doc_id", "th").agg(
        F.count(F.when(F.col("sure"), 1)).alias("n_license"), F.count(F.when(~F.col("sure"), 1)).alias("n_unconfirmed"),
        F.sort_array(F.collect_set(F.when(F.col("sure"), F.col("family")))).alias("licenses"), F.sort_array(F.collect_list(F.when(F.col("sure"), F.col("line")))).alias("license_lines"),
    ).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "n_license", "n_unconfirmed", "licenses", "license_lines")
    out = times.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    return out.select(
        "doc_id", F.col("n_paragraphs").cast("long").alias("n_paragraphs"), F.coalesce("n_license", F.lit(0)).alias("n_license"), F.coalesce("n_unconfirmed", F.lit(0)).alias("n_unconfirmed"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"), F.coalesce("license_lines", F.array().cast("array<int>")).alias("license_lines"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_copy"),
    ).drop("_copy")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs, train_scanner(docs))
