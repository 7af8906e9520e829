"""Licence scan: a trained paragraph classifier, confirmed by templates.

A paragraph is a line, or a stretch of 24, 40 or 64 words (``STRETCHES`` chunks of
``CHUNK``), one from every eighth word of the text on: notices are wrapped, or stand
behind other words of their line. Stretches run over line ends, with the comment signs
before lines removed, so a notice of up to 57 words is whole in one of them wherever it
stands and however it is wrapped. Stretches are reported when they are confirmed and no
better or shorter confirmed paragraph of the family, and no better one of a family with
much the same template (``kin``), overlaps them; ``line`` is the first.
A paragraph's features are its words and word pairs, hashed. A
multinomial logistic regression with sparse features tells licence families and
"none" apart. It is trained on the templates below (each whole, with each word
left out in turn, and between words of real text) and on the paragraphs of all
documents that hold less than ``UNLIKE`` of the word pairs of any template and are
not mostly made of such pairs, as parts of wrapped notices are. They weigh as much
as those of ``SAMPLE`` documents, so that templates count for as much in a table of
any size. Half of those are kept back: the
least probability that names a family is the one that all but ``CAUTION`` of
them stay below, and ``LEAST_PROBABILITY`` at least; under it a paragraph is
unknown.

A prediction is confirmed when the paragraph holds at least ``CONFIRM`` of the
word pairs of a template of the family.

Before classification a paragraph must contain a word of some template that is
rare in the negatives. Nothing is lost by that: a confirmed paragraph holds
``CONFIRM`` of the pairs of a template, and ``gate`` sees to it that more than the
rest of every template's pairs have such a word, with its next rarest words if need be.

Only built-in functions and Spark's own learning library are used. NULL counts
as empty. Repeated rows are reported each. Documents without a licence have an
empty list. Without negatives (an empty table) the result is empty.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import clean_text, materialize
from millrace.operators.quantiles import quantiles

HASHED = 1 << 13
SAMPLE = 2000  # documents whose weight the negatives have
NEAR = 40
LEAST_PROBABILITY = 0.5
CONFIRM = 0.7
UNLIKE = 0.3
CAUTION = 0.002  # share of the negatives kept back that may pass
RARE = 0.001  # share of negatives that may contain a rare word
CHUNK = 8  # words from one stretch's start to the next one's
STRETCHES = (3, 5, 8)  # chunks; the longest template has about 40 words

# Usual notices and key sentences of licence families.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Licensed under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal Public Domain Dedication",
    ],
}
_CHUNK_TYPE = "array<struct<line:int,last:int,text:string,hit:boolean>>"
_PARAGRAPH_TYPE = "array<struct<line:int,last:int,start:int,size:int,wrapped:boolean,paragraph:string>>"
NONE = "none"
FAMILIES = [NONE, *TEMPLATES]


def words_of(text: Column) -> Column:
    """Words in lower case; points and hyphens within a word stay."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.\-]+|[.\-]+(?![\p{L}\p{N}])", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def pairs_of(words: Column) -> Column:
    following = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def _features(words: Column) -> Column:
    return F.concat(words, pairs_of(words))


def _numbered_words(lines: Column) -> Column:
    """All words of ``lines`` in order, with their line and the blank or line end before them."""
    plain = F.transform(lines, lambda x: F.regexp_replace(x, r"^(?:[^\p{L}\p{N}]|(?i:rem|dnl)\s)+", ""))
    words = F.transform(
        plain,
        lambda x, i: F.transform(
            F.filter(F.split(x, r"\s+"), lambda w: w != ""),
            lambda w, j: F.struct(i.alias("line"), F.concat(F.when(j == 0, "\n").otherwise(" "), w).alias("word")),
        ),
    )
    return F.flatten(words)


def candidates(df: DataFrame, gate: str, text: str = "text") -> DataFrame:
    """Lines that match ``gate``, and stretches of words in which a chunk does.

    ``line`` and ``last`` are a paragraph's first and last line, ``start`` and ``size`` the
    chunks a stretch (``wrapped``) covers.
    """
    split = F.split(clean_text(f"`{text}`"), r"\r\n|\r|\n")
    names = [F.col(f"`{c}`") for c in df.columns]
    # Most texts have no such word at all.
    texts = df.where(clean_text(f"`{text}`").rlike(gate)).select(*names, split.alias("__lines"))
    texts = texts.select("*", _numbered_words(F.col("__lines")).alias("__words"))

    def chunk(k: Column) -> Column:
        own = F.slice("__words", k * CHUNK + 1, F.lit(CHUNK))
        joined = F.array_join(F.transform(own, lambda w: w["word"]), "")
        lines = (F.get(own, F.lit(0))["line"], F.element_at(own, -1)["line"])
        return F.struct(lines[0].alias("line"), lines[1].alias("last"), joined.alias("text"), joined.rlike(gate).alias("hit"))

    count = F.ceil(F.size("__words") / CHUNK).cast("int")
    chunks = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), chunk))
    texts = texts.select("*", F.coalesce(chunks, F.array().cast(_CHUNK_TYPE)).alias("__chunks")).drop("__words")

    def line(x: Column, i: Column) -> Column:
        return F.struct(
            i.alias("line"), i.alias("last"), F.lit(-1).alias("start"), F.lit(0).alias("size"),
            F.lit(False).alias("wrapped"), F.when(x.rlike(gate), x).alias("paragraph"),
        )

    def stretch(n: int):
        def of(k: Column) -> Column:
            own = F.slice("__chunks", k + 1, F.lit(n))
            joined = F.substring(F.array_join(F.transform(own, lambda c: c["text"]), ""), 2, 2**31 - 1)
            return F.struct(
                F.get(own, F.lit(0))["line"].alias("line"), F.element_at(own, -1)["last"].alias("last"),
                k.alias("start"), F.size(own).alias("size"), F.lit(True).alias("wrapped"),
                F.when(F.exists(own, lambda c: c["hit"]), joined).alias("paragraph"),
            )

        # One that reaches the end holds all that begin behind it.
        numbers = F.sequence(F.lit(0), F.greatest(F.size("__chunks") - n, F.lit(0)))
        return F.when(F.size("__chunks") > 0, F.transform(numbers, of))

    made = F.concat(F.transform("__lines", line), *[F.coalesce(stretch(n), F.array().cast(_PARAGRAPH_TYPE)) for n in STRETCHES])
    found = F.filter(made, lambda x: F.coalesce(x["paragraph"].rlike(r"\p{L}"), F.lit(False)))
    return texts.select(*names, F.inline(F.array_distinct(found)))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    frame = spark.createDataFrame(rows, "family string, template string")
    words = words_of(F.col("template"))
    return frame.select("family", words.alias("words"), F.array_distinct(pairs_of(words)).alias("pairs"))


class LicenceModel:
    """What ``fit`` learns: classifier, threshold and words to look for; the templates' word pairs."""

    def __init__(
        self,
        model: LogisticRegressionModel | None,
        least: float,
        rare: list[str],
        pairs: dict[str, list[list[str]]],
    ) -> None:
        self.model, self.least, self.rare, self.pairs = model, least, rare, pairs


def _likeness(pairs: Column, known: list[list[str]]) -> Column:
    """Share of the word pairs of the nearest of some templates that are among ``pairs``."""
    shares = [F.size(F.array_intersect(F.lit(k), pairs)) / F.lit(len(k)) for k in known]
    return F.greatest(*shares, F.lit(0.0))


def gate(counts: dict[str, int], most: float, templates: list[list[str]]) -> list[str]:
    """Words in at most ``most`` negatives, and the rarest others that templates need.

    More than ``1 - CONFIRM`` of each template's pairs have one of the words.
    """
    words = {w for w, n in counts.items() if n <= most}
    for pairs in templates:
        rest = sorted({w for p in pairs for w in p.split(" ")} - words, key=lambda w: (counts[w], w))
        while sum(not words.isdisjoint(p.split(" ")) for p in pairs) <= (1 - CONFIRM) * len(pairs):
            words.add(rest.pop(0))
    return sorted(words)


def _trie(words: list[str]) -> str:
    """A pattern of just ``words``, in which those with one beginning share it."""
    if not any(words):
        return ""
    by_first = {}
    for word in words:
        by_first.setdefault(word[:1], []).append(word[1:])
    ends = by_first.pop("", None) is not None
    made = "|".join(re.escape(c) + _trie(rest) for c, rest in sorted(by_first.items()))
    return made if len(by_first) == 1 and not ends else f"(?:{made}){'?' if ends else ''}"


def negatives(df: DataFrame, pairs: list[list[str]], words: list[str], text: str = "text") -> DataFrame:
    """Paragraphs unlike all templates: hashed features, first words, words of templates, kept back or not.

    ``pairs`` and ``words`` are those of the templates.
    """
    every = sorted({p for of_template in pairs for p in of_template})
    lines = F.split(clean_text(f"`{text}`"), r"\r\n|\r|\n")
    lines = F.filter(lines, lambda x: x.rlike(r"\p{L}"))

    # In steps, so that words and pairs are made once for each line.
    made = F.transform(lines, lambda x: F.struct(x.alias("paragraph"), words_of(x).alias("words")))
    made = F.filter(made, lambda s: F.size(s["words"]) > 0)
    made = F.transform(made, lambda s: s.withField("pairs", pairs_of(s["words"])))
    among = lambda s: F.array_distinct(F.filter(s["pairs"], lambda p: p.isin(every)))
    made = F.transform(made, lambda s: s.withField("shared", among(s)))

    def unlike(s: Column) -> Column:
        like = (_likeness(s["shared"], pairs) < UNLIKE) & (F.size(s["shared"]) <= F.size(F.array_distinct(s["pairs"])) / 2)
        return (F.size(s["shared"]) == 0) | like

    made = F.transform(
        F.filter(made, unlike),
        lambda s: F.struct(
            F.concat(s["words"], s["pairs"]).alias("terms"),
            F.slice(s["words"], 1, 12).alias("near"),
            F.filter(F.array_distinct(s["words"]), lambda w: w.isin(words)).alias("own"),
            (F.pmod(F.xxhash64(s["paragraph"], F.lit("held")), F.lit(2)) == 0).alias("kept_back"),
        ),
    )
    return _hashing().transform(df.select(F.inline(made))).drop("terms")


def fit(df: DataFrame, text: str = "text", sample_size: int = SAMPLE) -> LicenceModel:
    """Train on templates and on the paragraphs of all documents, which weigh as ``sample_size`` of them."""
    known = templates(df.sparkSession)
    pairs = {family: [] for family in TEMPLATES}
    for row in known.collect():
        pairs[row["family"]].append(row["pairs"])
    share = min(1.0, sample_size / max(df.count(), 1))
    every = [p for of_family in pairs.values() for p in of_family]
    names = sorted(r["word"] for r in known.select(F.explode("words").alias("word")).distinct().collect())
    negative = materialize(negatives(df, every, names, text), "licence-negatives")
    total = negative.count()
    if not total:
        return LicenceModel(None, 1.0, [], pairs)
    seen = negative.select(F.explode("own").alias("word")).groupBy("word").count()
    counts = dict.fromkeys(names, 0) | {r["word"]: r["count"] for r in seen.collect()}
    rare = gate(counts, RARE * total, every)
    whole = F.col("words")
    left_out = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.filter(whole, lambda w, j: j != i),
    )
    variants = F.concat(F.array(whole), F.when(F.size("words") > 3, left_out).otherwise(F.array(whole)))
    alone = known.select("family", F.explode(variants).alias("words"))
    near = negative.where(~F.col("kept_back")).select("near").limit(NEAR).collect()
    around = F.array(*[F.array(*[F.lit(w) for w in r["near"]]) for r in near or [{"near": [""]}]])
    beside = known.select("family", "words", F.explode(around).alias("near")).select(
        "family", F.concat("near", "words", "near").alias("words")
    )
    label = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")) - 1
    rows = alone.unionByName(beside).select(
        label.cast("double").alias("label"), F.lit(1.0).alias("weight"), _features(F.col("words")).alias("terms")
    )
    templated = _hashing().transform(rows.coalesce(1)).drop("terms")
    none = negative.where(~F.col("kept_back")).select(
        F.lit(float(FAMILIES.index(NONE))).alias("label"), F.lit(share).alias("weight"), "features"
    )
    learner = LogisticRegression(
        family="multinomial", regParam=1e-4, maxIter=40, featuresCol="features", labelCol="label", weightCol="weight"
    )
    model = learner.fit(templated.unionByName(none))
    held = _classes(model, negative.where(F.col("kept_back")).select("features"))
    reached = held.select(F.array_max(F.slice("p", 2, len(FAMILIES))).alias("p"))
    bound = quantiles(materialize(reached, "licence-held"), "p", [1 - CAUTION])[0]
    return LicenceModel(model, max(LEAST_PROBABILITY, bound or 0.0), rare, pairs)


def _hashing() -> HashingTF:
    return HashingTF(inputCol="terms", outputCol="features", numFeatures=HASHED, binary=True)


def _probabilities(model: LogisticRegressionModel, df: DataFrame) -> DataFrame:
    return _classes(model, _hashing().transform(df))


def _classes(model: LogisticRegressionModel, hashed: DataFrame) -> DataFrame:
    made = model.transform(hashed)
    return made.withColumn("p", vector_to_array("probability")).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def classified(df: DataFrame, model: LicenceModel, text: str = "text") -> DataFrame:
    """Paragraphs a family is named for: probability, likeness to a template, confirmed or not."""
    lines = candidates(df, rf"(?iu)(?<![\p{{L}}\p{{N}}]){_trie(model.rare)}(?![\p{{L}}\p{{N}}])", text)
    words = words_of(F.col("paragraph"))
    lines = lines.withColumn("terms", _features(words))
    scored = _probabilities(model.model, lines)
    families = F.slice("p", 2, len(FAMILIES))
    best = F.array_max(families)
    named = F.element_at(
        F.array(*[F.lit(f) for f in FAMILIES[1:]]), F.array_position(families, best).cast("int")
    )
    named = scored.select(
        "*", best.alias("probability"), F.when(best >= model.least, named).alias("family")
    ).where(F.col("family").isNotNull())
    likeness = F.coalesce(
        *[
            F.when(F.col("family") == family, _likeness(F.col("terms"), pairs))
            for family, pairs in model.pairs.items()
        ]
    )
    return named.select(
        *[F.col(f"`{c}`") for c in df.columns],
        "line",
        "last",
        "start",
        "size",
        "paragraph",
        "family",
        "probability",
        likeness.alias("likeness"),
        (likeness >= CONFIRM).alias("confirmed"),
        "wrapped",
    ).where(~F.col("wrapped") | F.col("confirmed"))


def kin(pairs: dict[str, list[list[str]]]) -> list[str]:
    """Families of which one has a template that confirms another's, as ``one|another``."""

    def confirms(one, other):
        return any(len(set(t).intersection(u)) >= CONFIRM * len(u) for t in pairs[one] for u in pairs[other])

    names = [(a, b) for a in pairs for b in pairs if a != b]
    return [f"{a}|{b}" for a, b in names if confirms(a, b) or confirms(b, a)]


def _without_overlaps(findings: Column, kin: list[str]) -> Column:
    """Of confirmed paragraphs that overlap, stretches give way to better, shorter or earlier ones of the family.

    To one of a family of ``kin`` they give way when it is more like its template: a
    part of one family's notice can confirm the other.
    """
    of_kin = F.lit(kin) if kin else F.array().cast("array<string>")

    def better(y, x):
        lines = (y["line"] <= x["last"]) & (x["line"] <= y["last"])
        words = (y["start"] < x["start"] + x["size"]) & (x["start"] < y["start"] + y["size"])
        meets = F.when(y["wrapped"], words).otherwise(lines)
        rank = [
            F.struct(-z["likeness"], z["last"] - z["line"], z["wrapped"], z["size"], z["start"]) for z in (y, x)
        ]
        akin = F.array_contains(of_kin, F.concat(y["family"], F.lit("|"), x["family"]))
        closer = (y["family"] == x["family"]) & (rank[0] < rank[1]) | akin & (y["likeness"] > x["likeness"])
        return y["confirmed"] & meets & closer

    return F.filter(findings, lambda x: ~x["wrapped"] | ~F.exists(findings, lambda y: better(y, x)))


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, licences, findings`` of every row: confirmed families, and all named paragraphs."""
    number = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.sha2(F.concat(number, F.lit(":"), clean_text(f"`{text}`")), 256).alias("row"),
        F.col(f"`{text}`").alias("text"),
    )
    fields = ["line", "family", "probability", "likeness", "confirmed", "paragraph"]
    places = ["last", "start", "size", "wrapped"]
    none = F.array().cast(
        "array<struct<line:int,family:string,probability:double,likeness:double,"
        "confirmed:boolean,paragraph:string>>"
    )
    model = fit(df, text)
    if model.model is None:
        return rows.select("doc_id", F.array().cast("array<string>").alias("licences"), none.alias("findings"))
    found = classified(rows.select("row", "text"), model).select("row", F.struct(*fields, *places).alias("finding"))
    grouped = found.groupBy("row").agg(F.array_sort(F.collect_set("finding")).alias("findings"))
    joined = rows.select("doc_id", "row").join(grouped, "row", "left")
    kept = F.transform(_without_overlaps(F.col("findings"), kin(model.pairs)), lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    joined = joined.withColumn("findings", F.coalesce(kept, none))
    findings = F.col("findings")
    confirmed = F.filter(findings, lambda x: x["confirmed"])
    return joined.select(
        "doc_id",
        F.array_sort(F.array_distinct(F.transform(confirmed, lambda x: x["family"]))).alias("licences"),
        findings.alias("findings"),
    )
