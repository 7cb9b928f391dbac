"""Licence notices in whole texts: a trained paragraph classifier, confirmed by templates.

A sparse softmax regression over word 1- to 3-grams is trained on labelled notices (below) and on
sentences that use the same words otherwise, in variants with other words around them. A held-out
part of the variants calibrates its temperature. Paragraphs (lines) that hold a stem which every
notice holds are scored; if no family reaches ``LEAST_PROBABILITY`` the paragraph is ``unknown``.
Comparison with the family's templates confirms a prediction. Scoring is one narrow pass of SQL
functions; only the small, fixed training set passes the driver.
"""

from __future__ import annotations

import json
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted

# Customary notices of each family.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Released under the GNU GPL v3 license",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
OTHERWISE = (
    "A driving license is required for this job", "The poet took some licence with the facts",
    "The restaurant lost its liquor license last year", "He asked for permission to leave the room",
    "The fishing licence expires in May", "All copyright questions go to the publisher",
    "The warranty covers parts and labour for two years", "She wrote her thesis at MIT about apache helicopters",
    "The public was licensed to enter the general store", "The wealth was redistributed among the poor",
    "No permission is granted to copy this page", "The version of the story in the file is free",
)
STEMS = ("licens", "licenc", "copyright", "warrant", "permission", "redistribut", "public license", "source code form")
UNKNOWN = "unknown"
LEAST_PROBABILITY = 0.5
LEAST_TEMPLATE = 0.8  # share of a template's words that a confirmed paragraph holds
WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
_VARIANTS, _ROUNDS = 12, 400


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def _variants(rng: random.Random) -> list[tuple[str, set[str]]]:
    """Each labelled text as it is, and with other words before and after it."""
    noise = [w for text in OTHERWISE for w in words_of(text) if not any(s in w for s in STEMS)]
    out = []
    for label, texts in [*NOTICES.items(), (UNKNOWN, OTHERWISE)]:
        for text in texts:
            for k in range(_VARIANTS):
                around = [rng.choices(noise, k=rng.randint(0, 12)) if k else [] for _ in range(2)]
                out.append((label, grams_of([*around[0], *words_of(text), *around[1]])))
        if label == UNKNOWN:
            out += [(label, grams_of(rng.choices(noise, k=rng.randint(1, 40)))) for _ in range(8 * _VARIANTS)]
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(seed: int = 7) -> tuple[list[str], dict[str, list[float]], list[float]]:
    """Labels, weights by gram and biases, already divided by the calibrated temperature."""
    rng = random.Random(seed)
    rows = _variants(rng)
    rng.shuffle(rows)
    labels = [*NOTICES, UNKNOWN]
    notices = {gram for texts in NOTICES.values() for text in texts for gram in grams_of(words_of(text))}
    others = {gram for text in OTHERWISE for gram in grams_of(words_of(text))}
    column = {gram: k for k, gram in enumerate(sorted(notices | others))}
    x = np.zeros((len(rows), len(column) + 1))
    x[:, -1] = 1.0
    for i, (_, grams) in enumerate(rows):
        x[i, [column[g] for g in grams if g in column]] = 1.0
    y = np.eye(len(labels))[[labels.index(label) for label, _ in rows]]
    fitted = len(rows) * 4 // 5
    weights = np.zeros((x.shape[1], len(labels)))
    for _ in range(_ROUNDS):
        slope = x[:fitted].T @ (_softmax(x[:fitted] @ weights) - y[:fitted]) / fitted
        weights -= 0.5 * (slope + 1e-4 * weights)
    scores = x[fitted:] @ weights
    loss = {t: -np.log(np.maximum((_softmax(scores / t) * y[fitted:]).sum(axis=1), 1e-12)).mean()
            for t in (0.5, 0.7, 1.0, 1.5, 2.0, 3.0)}
    weights = np.round(weights / min(loss, key=loss.get), 6)
    return labels, {gram: weights[k].tolist() for gram, k in column.items()}, weights[-1].tolist()


def _constant(value, kind: str) -> Column:
    """A literal that the optimizer folds while planning."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _has_stem(text: Column) -> Column:
    lowered = F.lower(text)
    found = F.contains(lowered, F.lit(STEMS[0]))
    for stem in STEMS[1:]:
        found = found | F.contains(lowered, F.lit(stem))
    return found


def licenses(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per paragraph with a licence stem: ``doc_id``, ``paragraph_no`` (from 0), ``family``,
    ``probability``, ``template_share`` and ``confirmed``.

    Texts are read whole; null and empty ones have no paragraphs. A null ``doc_id`` stays null,
    repeated rows give repeated rows, of families that tie the first listed wins, and other columns
    are not read. An empty table gives an empty result. No shuffle, no Python worker.
    """
    labels, weights, bias = train()
    n = len(labels)
    table = _constant(weights, "map<string,array<double>>")
    templates = _constant([{"family": f, "words": sorted(set(words_of(t)))} for f, texts in NOTICES.items() for t in texts],
                          "array<struct<family:string,words:array<string>>>")
    lines = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).cast("string").alias("text")).where(
        _has_stem(F.col("text"))).select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph_no", "paragraph"))
    found = lines.where(_has_stem(F.col("paragraph"))).withColumn(
        "words", F.regexp_extract_all(F.lower("paragraph"), F.lit(f"({WORD})"), F.lit(1)))
    grams = "array_distinct(concat(words, " + ", ".join(
        f"transform(slice(sequence(1, greatest(size(words), 1)), 1, greatest(size(words) - {k - 1}, 0)), "
        f"i -> array_join(slice(words, i, {k}), ' '))" for k in (2, 3)) + "))"
    zero = F.array(*[F.lit(float(b)) for b in bias])
    scored = found.withColumn("grams", F.expr(grams)).withColumn("scores", F.aggregate(
        "grams", zero, lambda held, gram: F.zip_with(
            held, F.coalesce(F.element_at(table, gram), F.array(*[F.lit(0.0)] * n)), lambda a, b: a + b)))
    odds = scored.withColumn("top", F.array_max("scores")).withColumn(
        "best", F.array_position("scores", F.col("top")).cast("int")).withColumn(
        "probability", F.round(1.0 / F.aggregate(
            "scores", F.lit(0.0), lambda held, s: held + F.exp(s - F.col("top"))), 6))
    named = odds.withColumn("family", F.when(F.col("probability") >= LEAST_PROBABILITY, F.element_at(
        F.array(*[F.lit(x) for x in labels]), F.col("best"))).otherwise(F.lit(UNKNOWN)))
    share = F.array_max(F.transform(
        F.filter(templates, lambda t: t["family"] == F.col("family")),
        lambda t: F.size(F.array_intersect("words", t["words"])) / F.size(t["words"])))
    return named.withColumn("template_share", F.round(F.coalesce(share, F.lit(0.0)), 6)).select(
        "doc_id", "paragraph_no", "family", "probability", "template_share",
        (F.col("template_share") >= LEAST_TEMPLATE).alias("confirmed"))
