"""Licence notices in text: a trained paragraph classifier, in Spark's own expressions.

A text's passages are its lines and, for notices that were wrapped, its paragraphs, their lines joined, up to
a line without letters or digits (so one with comment marks alone ends a paragraph, and marks before words fall
away); long paragraphs are read in windows that overlap by half. Passages are described by the word n-grams that
occur in licence texts; one logistic regression per family, trained on template passages against ordinary text
and against lines that use licences' words otherwise, weighs them. A family's probability is calibrated on
held-out passages; where none is likely enough the passage is unknown. A prediction counts only if the passage
also holds enough of one of the family's templates.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts, written

# Fixed wording of the licences' own notices, per family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
# A licence n-gram holds one of these words: pairs such as "of the" say nothing about licences.
KEYS = ("license", "licenses", "licensed", "gnu", "apache", "mit", "bsd", "mozilla", "mpl", "creative", "commons",
        "cc", "spdx", "copyright", "redistribution", "redistributions", "redistribute", "permission",
        "permitted", "warranties", "software", "foundation", "disclaimer", "distributed", "restriction")
UNKNOWN = "unknown"
_WORD = re.compile(r"[a-z0-9]+")
# Sentences of n-grams up to this width.
WIDTH = 3
# Words of one window of a paragraph. Windows overlap by half: a notice of up to half as many words is whole in one.
WINDOW = 128
# Parts that the weights are dealt into.
BUCKETS = 256
# Letters kept of a word that is only trained against.
WORD_CHARS = 40
# Words before and after a notice in its paragraph, in training: a paragraph may hold more than it.
_FILLER = ("this", "file", "see", "the", "project", "page", "and", "for", "more", "details", "of", "all")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams_of(words: list[str]) -> set[str]:
    """Pairs and triples of neighbouring words with a key word among them."""
    return {" ".join(words[i:i + w]) for w in range(2, WIDTH + 1) for i in range(len(words) - w + 1)
            if any(word in KEYS for word in words[i:i + w])}


def training_passages() -> list[tuple[list[str], str]]:
    """Passages with their family: each template whole, its halves and its tail, bare and in filler."""
    out = []
    for family, templates in TEMPLATES.items():
        for template in templates:
            words = words_of(template)
            parts = [words]
            if len(words) >= 12:
                parts += [words[:len(words) * 2 // 3], words[len(words) // 3:]]
            for k, part in enumerate(parts):
                out += [(part, family), ([*_FILLER[k:k + 4], *part, *_FILLER[-4 - k:]], family)]
    return out


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


class Classifier:
    """Weights of n-grams per family, intercepts, and the calibration: probability = sigmoid(a * margin + b)."""

    def __init__(self, weights: dict[str, dict[str, float]], intercepts: dict[str, float],
                 scale: tuple[float, float]):
        self.weights, self.intercepts, self.scale = weights, intercepts, scale

    def margin(self, words: list[str], family: str) -> float:
        own = self.weights[family]
        return self.intercepts[family] + sum(own.get(g, 0.0) for g in grams_of(words))


def _fit_family(rows: list[tuple[set[str], bool]], rounds: int = 60, rate: float = 0.5,
                shrink: float = 0.002) -> tuple[dict[str, float], float]:
    """Logistic regression by AdaGrad over the passages, with soft thresholding for sparse weights."""
    weights: dict[str, float] = {}
    square: dict[str, float] = {}
    bias = -1.0
    for _ in range(rounds):
        for grams, positive in rows:
            error = _sigmoid(bias + sum(weights.get(g, 0.0) for g in grams)) - positive
            bias -= 0.05 * error
            for g in grams:
                square[g] = square.get(g, 1e-3) + error * error
                step = rate / math.sqrt(square[g])
                w = weights.get(g, 0.0) - step * error
                weights[g] = math.copysign(max(0.0, abs(w) - step * shrink), w)
    return {g: w for g, w in weights.items() if w}, bias


def fit(negatives: list[list[str]]) -> Classifier:
    """From the template passages and ordinary paragraphs. Every third passage is held out to calibrate
    the margins, then all are used."""
    passages = training_passages()
    plain = [grams_of(w) for w in negatives]
    # Most ordinary paragraphs have no such n-gram: they tell the intercept alone.

    def train(own: list[tuple[list[str], str]]) -> tuple[dict, dict]:
        weights, intercepts = {}, {}
        for family in TEMPLATES:
            rows = [(grams_of(w), f == family) for w, f in own] + [(g, False) for g in plain[::2]]
            weights[family], intercepts[family] = _fit_family(rows)
        return weights, intercepts

    first = Classifier(*train([p for i, p in enumerate(passages) if i % 3]), (1.0, 0.0))
    held = [(max(first.margin(w, f) for f in TEMPLATES), max(
        TEMPLATES, key=lambda f: first.margin(w, f)) == family)
        for i, (w, family) in enumerate(passages) if i % 3 == 0]
    held += [(max(first.margin(w, f) for f in TEMPLATES), False) for w in negatives[1::2]]
    a, b = 1.0, 0.0
    for _ in range(300):
        da = db = 0.0
        for margin, right in held:
            error = _sigmoid(a * margin + b) - right
            da += error * margin
            db += error
        a = max(0.1, a - 0.05 * da / max(1, len(held)))
        b -= 0.05 * db / max(1, len(held))
    return Classifier(*train(passages), (a, b))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _has_key(words: Column) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, KEYS)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grams(words: Column) -> Column:
    """As ``grams_of``: only the n-grams around key words are put together."""
    n = F.size(words)
    spans = [(back, width) for width in range(2, WIDTH + 1) for back in range(width)]

    def around(i: Column) -> Column:
        return F.array_compact(F.array(*(
            F.when((i >= back) & (i - back + width <= n), F.concat_ws(" ", *(F.get(words, i - back + k) for k in range(width))))
            for back, width in spans)))

    places = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(*KEYS), i)))
    return F.array_distinct(F.flatten(F.transform(places, around)))


def speaking_passages(docs: DataFrame) -> DataFrame:
    """Lines, and windows of paragraphs that have several lines or are long, with a key word: doc_id, digest (a hash
    of the document's text), paragraph (from 0), whole (a window, not a line), passage (from 0 among either), text,
    words, grams."""
    text = F.coalesce("text", F.lit(""))
    # Most documents are told by a search for the key words' letters, without being cut up.
    speaks = _let(F.lower(text), lambda low: F.exists(F.array(*map(F.lit, KEYS)), lambda key: F.contains(low, key)))
    blank = F.regexp_replace(text, r"(?md)^[^\p{L}\p{N}\n]++$", "")
    paragraphs = texts(docs).where(speaks).select(
        "doc_id", F.xxhash64(text).alias("digest"), F.posexplode(F.split(blank, r"\n\n+"))
    ).toDF("doc_id", "digest", "paragraph", "text")

    def told(whole: bool, place: Column, own: Column, words: Column) -> Column:
        return F.struct(F.lit(whole).alias("whole"), place.alias("passage"), own.alias("text"), words.alias("words"))

    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - WINDOW // 2), F.lit(WINDOW // 2))
        return F.transform(starts, lambda at, i: _let(
            F.slice(words, at, F.lit(WINDOW)), lambda own: told(True, i, F.array_join(own, " "), own)))

    def of(words: Column) -> Column:
        lines = F.transform(F.split("text", "\n"), lambda line, i: told(False, i, line, _words(line)))
        joined = F.when(F.contains("text", F.lit("\n")) | (F.size(words) > WINDOW), windows(words))
        both = F.concat(lines, F.coalesce(joined, F.filter(lines, lambda p: F.lit(False))))
        return F.when(_has_key(words), F.filter(both, lambda p: _has_key(p["words"])))

    return paragraphs.select("doc_id", "digest", "paragraph", F.explode(_let(_words(F.col("text")), of)).alias("p")).select(
        "doc_id", "digest", "paragraph", "p.*", _grams(F.col("p.words")).alias("grams"))


def _lowest(df: DataFrame, mark: str, rows: int, most: int) -> list[list[str]]:
    """The words of the ``most`` rows with the lowest marks, of about ``rows`` distinct ones. Rows are cut by a bound on
    the mark first, so about twice as many reach the driver however many tasks send theirs."""
    share = min(1.0, 2 * most / max(1, rows))
    return [r["words"] for r in df.where((F.col(mark) / 2.0 ** 64 + 0.5) <= share).dropDuplicates([mark]).orderBy(
        mark).limit(most).select("words").collect()]


def ordinary_paragraphs(docs: DataFrame, passages: DataFrame, most: int) -> list[list[str]]:
    """The words of passages to train against, those with the lowest hashes: of at most ``most`` documents a
    window anywhere in the text, and at most ``most`` different lines with a key word. Those that resemble a
    template are left out."""
    text = F.coalesce("text", F.lit(""))
    marked = texts(docs).select(F.xxhash64("doc_id", text).alias("mark"), text.alias("text"))
    short = lambda words: F.transform(words, lambda w: F.left(w, F.lit(WORD_CHARS)))
    anywhere = marked.withColumn("words", _let(_words(F.col("text")), lambda words: short(F.slice(
        words, F.pmod("mark", F.greatest(F.size(words) - WINDOW, F.lit(0)) + 1).cast("int") + 1, F.lit(WINDOW)))))
    lines = passages.where("not whole").select(
        F.xxhash64("words").alias("mark"), short(F.slice("words", 1, WINDOW)).alias("words"))
    distinct = lines.agg(F.approx_count_distinct("mark")).first()[0]
    templates = [grams_of(words_of(t)) for ts in TEMPLATES.values() for t in ts]

    def resembles(words: list[str]) -> bool:
        own = grams_of(words)
        return any(2 * len(own & t) >= min(len(own), 0.7 * len(t)) for t in templates) if own else False

    found = _lowest(anywhere, "mark", docs.count(), most) + _lowest(lines, "mark", distinct, most)
    return [words for words in found if not resembles(words)]


def classify_passages(passages: DataFrame, classifier: Classifier, least_probability: float = 0.5,
                      least_template: float = 0.7) -> DataFrame:
    """Those of ``speaking_passages`` that have an n-gram the model or a template knows: doc_id, digest,
    paragraph, whole, passage, text, family, probability, template share, and confirmed."""
    known = sorted({g for own in classifier.weights.values() for g in own}.union(
        *(grams_of(words_of(t)) for ts in TEMPLATES.values() for t in ts)))
    families = list(classifier.weights)
    # Passages without a known n-gram have the intercepts' probability, that of the unknown class.
    # N-grams are letters, digits and spaces. As SQL text, thousands of literals are one call to the JVM.
    candidates = passages.withColumn("grams", F.expr(
        f"filter(grams, g -> g IN ({', '.join(map(repr, known))}))")).where(F.size("grams") > 0)
    # Maps are searched from end to end: the n-grams' weights are dealt into many small ones by checksum.
    dealt: list[list[str]] = [[] for _ in range(BUCKETS)]
    for g in known:
        own = ", ".join(f"{float(classifier.weights[f].get(g, 0.0))!r}D" for f in families)
        dealt[zlib.crc32(g.encode()) % BUCKETS].append(f"{g!r}, array({own})")
    empty = "map('', cast(array() as array<double>))"
    weights = F.expr(f"array({', '.join(f'map({", ".join(own)})' if own else empty for own in dealt)})")
    hits = F.transform("grams", lambda g: F.try_element_at(F.get(weights, F.crc32(g) % BUCKETS), g))
    margins = _let(hits, lambda found: F.array(*(F.struct(F.aggregate(
        found, F.lit(float(classifier.intercepts[f])), lambda total, w: total + F.get(w, F.lit(k))
    ).alias("margin"), F.lit(f).alias("family")) for k, f in enumerate(families))))
    a, b = classifier.scale
    best = candidates.withColumn("best", F.array_max(margins))
    probability = 1 / (1 + F.exp(-(F.col("best.margin") * a + b)))
    # A template's share is sought for the likeliest family alone.
    share = F.coalesce(*(F.when(F.col("best.family") == f, F.greatest(F.lit(0.0), *(
        F.size(F.array_intersect("grams", F.array(*map(F.lit, sorted(grams_of(words_of(t))))))) / len(
            grams_of(words_of(t))) for t in TEMPLATES[f]))) for f in families))
    place = ["doc_id", "digest", "paragraph", "whole", "passage", "text"]
    scored = best.select(
        *place, F.col("best.family").alias("likeliest"), probability.alias("probability"),
        share.alias("template_share"))
    confirmed = (F.col("probability") >= least_probability) & (F.col("template_share") >= least_template)
    return scored.select(
        *place, F.when(F.col("probability") >= least_probability, F.col("likeliest")).otherwise(UNKNOWN).alias("family"),
        "probability", "template_share", confirmed.alias("confirmed"))


def per_document(found: DataFrame) -> DataFrame:
    """The findings per doc_id and digest. Passages are a set per paragraph: copies of a row count once."""
    passage = F.struct("whole", "passage", "family", "probability", "confirmed")
    families = lambda of: F.array_distinct(F.transform(F.filter("found", of), lambda p: p["family"]))
    by_paragraph = found.groupBy("doc_id", "digest", "paragraph").agg(F.collect_set(passage).alias("found")).select(
        "doc_id", "digest", "found", families(lambda p: ~p["whole"] & p["confirmed"]).alias("own"),
        families(lambda p: p["whole"] & p["confirmed"]).alias("joined"),
        F.size(F.filter("found", lambda p: ~p["whole"] & p["confirmed"])).alias("n_own"),
        F.size(F.filter("found", lambda p: ~p["whole"] & ~p["confirmed"])).alias("n_rest"),
    ).withColumn("wrapped", F.array_except("joined", "own"))
    return by_paragraph.groupBy("doc_id", "digest").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(
            F.concat("own", "wrapped"))))), ",").alias("families"),
        F.sum(F.col("n_own") + F.size("wrapped")).alias("n_confirmed"),
        F.sum(F.when(F.size("wrapped") == 0, F.col("n_rest")).otherwise(0)).alias("n_unknown"),
        F.max(F.array_max(F.transform("found", lambda p: p["probability"]))).alias("best_probability"))


def scan_licenses(docs: DataFrame, most_rows: int = 400) -> DataFrame:
    """Every row of docs: doc_id, families (confirmed ones, in order, comma-joined), n_confirmed (lines, and
    families that only a paragraph's joined lines show), n_unknown (other lines that hold licence n-grams, in
    paragraphs without such a family), best_probability.

    Trained against windows of at most ``most_rows`` documents and at most as many different lines with licences'
    words. Null and empty texts have no paragraphs. Rows are known by id and text: of a null or repeated id each has
    its own findings, and copies have equal ones. Very long lines and paragraphs are read in windows too. Other
    columns are ignored; an empty table gives an empty result.
    """
    passages = written(speaking_passages(docs), "licence-passages")
    found = classify_passages(passages, fit(ordinary_paragraphs(docs, passages, most_rows)))
    findings = per_document(found).withColumnsRenamed({"doc_id": "found_id", "digest": "found_digest"})
    own = texts(docs).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"))
    return own.join(findings, (own["digest"] == findings["found_digest"]) & own["doc_id"].eqNullSafe(
        findings["found_id"]), "left").select(
        "doc_id", F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("n_confirmed", F.lit(0)).cast("bigint").alias("n_confirmed"),
        F.coalesce("n_unknown", F.lit(0)).cast("bigint").alias("n_unknown"), "best_probability")
