"""Licence scans: a paragraph classifier trained from notices, in DataFrame operations only.

A paragraph is a line with words. Its features are the word n-grams that the notices of the licence families are
made of. Multinomial logistic regression over them, trained on passages of the notices and on
paragraphs of the corpus, gives a paragraph's family or none. Below a confidence that corpus paragraphs
hardly ever reach, the family is unknown. A family stands only if the paragraph holds enough of
one of its notices, or is a passage of one, and names no other version or variant: the comparison with the template.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import saved

# Short notices by which texts name their licence.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
    ],
}

NONE, UNKNOWN = "none", "unknown"
ORDERS = (2,)


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(key, carried columns, at, paragraph): lines that have a letter or digit, with the place of each in its text."""
    lines = docs.select(F.col(key).alias(key), *(carry or []), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("at", "paragraph"))
    return lines.filter(F.col("paragraph").rlike("[A-Za-z0-9]"))


def words_of(paragraph: Column) -> Column:
    """Words: runs of letters, digits and non-ASCII characters, in lower case."""
    return F.filter(F.split(F.lower(paragraph), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """Distinct n-grams of ORDERS."""

    def of(n: int) -> Column:
        parts = [F.slice(words, i + 1, F.greatest(F.size(words) - (n - 1), F.lit(0))) for i in range(n)]
        joined = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat_ws(" ", x, y)), parts)
        return joined

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in ORDERS])))


#: What tells licences of nearly the same words apart: a number after one of these words or before clause, and names of variants.
VERSION = r"\b(?:version|v|apache|licen[cs]e|a?gpl|lgpl|mpl|by|sa|nc|nd|attribution|noncommercial|sharealike|noderivatives|noderivs) ?v?([0-9]{1,2})(?![0-9a-z])"
CLAUSES = r"\b([0-9] clause)"
VARIANT = r"\b((?:lesser|library|affero) general|[la]gpl|sharealike|share alike|noderivatives|noderivs|no derivatives|noncommercial|non commercial|by sa|nc sa|by nd|nc nd|by nc)"


#: A line without any of these has no match of VARIANT, which is found out sooner so.
PARTS_OF_VARIANTS = [" general", "gpl", "alike", "deriv", "commercial", "by s", "by n", "nc s", "nc n"]


def versions_of(line: Column) -> Column:
    """Versions named in a line, words joined by one space. One without a digit has none."""
    found = F.concat(F.regexp_extract_all(line, F.lit(VERSION), F.lit(1)), F.regexp_extract_all(line, F.lit(CLAUSES), F.lit(1)))
    return F.when(line.rlike("[0-9]"), found).otherwise(F.array().cast("array<string>"))


def variants_of(line: Column) -> Column:
    may = reduce(Column.__or__, [F.contains(line, F.lit(x)) for x in PARTS_OF_VARIANTS])
    return F.when(may, F.regexp_extract_all(line, F.lit(VARIANT), F.lit(1))).otherwise(F.array().cast("array<string>"))


def names_of(key: str, text: str) -> list[Column]:
    """Two hashes that name a row by its key and text, null keys too. A null text is empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(key, whole).alias("name_0"), F.xxhash64(whole, key, F.lit(1)).alias("name_1")]


NAME = ["name_0", "name_1"]


def _literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table as a literal of the plan."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.explode(F.from_json(F.lit(text), f"array<struct<{', '.join(c.replace(' ', ': ', 1) for c in schema.split(', '))}>>")).alias("x")).select("x.*")


def passages(spark: SparkSession, notices: dict[str, list[str]]) -> DataFrame:
    """(family, words): every notice, and its passages of four words or more that leave out words at its ends."""
    rows = [(family, notice) for family, listed in notices.items() for notice in listed]
    table = _literal(spark, rows, "family string, notice string").withColumn("words", words_of(F.col("notice")))
    table = table.withColumn("n", F.size("words")).withColumn("a", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - 4, F.lit(0)))))
    table = table.withColumn("b", F.explode(F.sequence(F.least(F.col("a") + 4, F.col("n")), F.col("n"))))
    return table.select("family", F.slice("words", F.col("a") + 1, F.col("b") - F.col("a")).alias("words"))


def matches(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name_0, name_1, row, at, n, versions, variants, hit) of every paragraph that has an n-gram of a notice: n n-grams in
    all, and hit those of notices. Written once; `fit` and `scan` both read it.
    """
    own = _grams_of_notices(docs.sparkSession, notices).select("gram")
    named = docs.select(F.col(key).alias(key), F.col(text).alias(text), *names_of(key, text), F.monotonically_increasing_id().alias("row"))
    same = [key, *NAME, "row"]
    rows = paragraphs(named, key, text, [*NAME, "row"]).withColumn("words", words_of(F.col("paragraph")))
    rows = rows.select(*same, "at", "words", F.concat_ws(" ", "words").alias("line"))
    rows = rows.select(*same, "at", grams_of(F.col("words")).alias("grams"), versions_of(F.col("line")).alias("versions"), variants_of(F.col("line")).alias("variants"))
    hits = rows.select(*same, "at", "versions", "variants", F.size("grams").alias("n"), F.explode("grams").alias("gram")).join(F.broadcast(own), "gram")
    # Equal rows are told apart while hits are gathered.
    return saved(hits.groupBy(*same, "at", "n", "versions", "variants").agg(F.collect_list("gram").alias("hit")))


def _grams_of_notices(spark: SparkSession, notices: dict[str, list[str]]) -> DataFrame:
    """(gram, of): every n-gram of a notice, and the families that have it."""
    positive = passages(spark, notices).select("family", F.explode(grams_of(F.col("words"))).alias("gram"))
    return positive.groupBy("gram").agg(F.sort_array(F.collect_set("family")).alias("of"))


def fit(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, key: str = "doc_id", text: str = "text", wrong: float = 0.001, matched: DataFrame | None = None) -> tuple[DataFrame, list[str], dict[str, float], float]:
    """Weights of n-grams (gram, weights, families that have it), families, what each family's score starts with, and the threshold.

    Negative examples are all paragraphs of all texts but those that share half of their n-grams with notices; half train and
    half calibrate. To the model a paragraph is the n-grams it has of notices, so equal ones are one example with their number as
    weight, and those that have none are one. ``matched`` is the result of `matches`, if there is one.
    What reaches the driver are the model's weights, as many as notices have n-grams, and the number of paragraphs.
    """
    spark = docs.sparkSession
    # Passages are cut at random-looking lengths; notices are few, so all of this is small.
    positive = passages(spark, notices).select("family", grams_of(F.col("words")).alias("grams")).filter(F.size("grams") > 0)
    own = _grams_of_notices(spark, notices)
    matched = matches(docs, notices, key, text) if matched is None else matched
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike("[A-Za-z0-9]"))
    plain = (docs.agg(F.sum(F.size(lines).cast("long"))).first()[0] or 0) - matched.count()
    judge = F.pmod(F.xxhash64("name_0", "at"), F.lit(2)) == 0
    negative = matched.filter("2 * size(hit) < n").select("name_0", "row", "at", F.array_sort("hit").alias("grams"), judge.alias("judge"))
    taught = negative.filter("NOT judge").groupBy("grams").agg(F.count(F.lit(1)).alias("times"))
    none = F.array().cast("array<string>").alias("grams")
    taught = taught.unionByName(spark.range(1).select(none, F.lit((plain + 1) // 2).cast("long").alias("times"))).filter("times > 0")
    families = [NONE, *sorted(notices)]
    labelled = positive.withColumn("times", F.lit(1).cast("long")).unionByName(taught.withColumn("family", F.lit(NONE)))
    labelled = saved(labelled.withColumn("label", F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1))
    counts = labelled.groupBy("family").agg(F.sum("times").alias("n"))
    weighted = labelled.join(F.broadcast(counts), "family").withColumn("weight", 1000.0 * F.col("times") / F.col("n"))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=1 << 14).fit(weighted)
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, weightCol="weight", standardization=False).fit(vectors.transform(weighted))
    matrix = model.coefficientMatrix.toArray()
    # Families are there in the order of labels; one without examples has no row.
    rows = [(gram, [float(x) for x in matrix[:, j]]) for j, gram in enumerate(vectors.vocabulary)]
    weights = _literal(spark, rows, "gram string, weights array<double>").join(F.broadcast(own), "gram", "left")
    start = dict(zip(families, (float(x) for x in model.interceptVector)))
    hits = negative.filter("judge").select("name_0", "row", "at", F.explode("grams").alias("gram")).join(F.broadcast(weights), "gram")
    judged = probabilities(hits.groupBy("name_0", "row", "at").agg(*sums(families)), families, start)
    # Most paragraphs have no n-gram of any notice: their score is the start's. Those that do set the threshold.
    at = judged.agg(F.percentile_approx("probability", 1 - wrong, 10_000)).first()[0]
    return weights, families, start, max(0.5, at if at is not None else 0.5)


def sums(families: list[str]) -> list[Column]:
    return [F.sum(F.col("weights")[i]).alias(f"sum_{i}") for i in range(len(families))]


def probabilities(rows: DataFrame, families: list[str], start: dict[str, float]) -> DataFrame:
    """rows with the most probable family besides none, and its probability."""
    odds = [F.col(f"sum_{i}") + F.lit(start[f]) for i, f in enumerate(families)]
    top = F.greatest(*odds)
    total = sum((F.exp(o - top) for o in odds), F.lit(0.0))
    best = F.array_max(F.array(*[F.struct((F.exp(o - top) / total).alias("p"), F.lit(f).alias("f")) for o, f in zip(odds[1:], families[1:])]))
    return rows.withColumn("probability", best["p"]).withColumn("family", best["f"])


def scan(docs: DataFrame, model: tuple[DataFrame, list[str], dict[str, float], float], key: str = "doc_id", text: str = "text", notices: dict[str, list[str]] = NOTICES, held: float = 0.6, matched: DataFrame | None = None) -> DataFrame:
    """(key, name_0, name_1, at, family, probability, holds) of paragraphs that have an n-gram of a notice and are more probably a notice than
    not: family is unknown where the probability is under the threshold or the templates don't confirm it. A template
    doesn't confirm a paragraph that has versions but none of the family's, or a variant that isn't the family's. holds: the
    larger of what share of the paragraph's n-grams is in the family's notices, and of a notice's n-grams in the paragraph.
    name_0 and name_1 tell texts of one key apart, null keys too; a row that occurs twice gives its paragraphs once.
    ``matched`` is the result of `matches`, if there is one.
    """
    weights, families, start, threshold = model
    same = [key, *NAME, "row"]
    matched = matches(docs, notices, key, text) if matched is None else matched
    hits = matched.select(*same, "at", "n", "versions", "variants", F.explode("hit").alias("gram")).join(F.broadcast(weights), "gram")
    found = hits.groupBy(*same, "at", "n", "versions", "variants").agg(*sums(families), F.collect_list("gram").alias("hit"), F.flatten(F.collect_list("of")).alias("of"))
    found = probabilities(found, families, start).filter("probability >= 0.5")
    # The notices, as one literal array: there are a few.
    listed = _literal(docs.sparkSession, [(f, x) for f, xs in notices.items() for x in xs], "family string, notice string")
    words = words_of(F.col("notice"))
    line = F.concat_ws(" ", words)
    listed = listed.select("family", grams_of(words).alias("notice"), versions_of(line).alias("versions"), variants_of(line).alias("variants"))
    listed = listed.groupBy("family").agg(F.collect_list("notice").alias("notices"), *[F.flatten(F.collect_list(c)).alias(f"own_{c}") for c in ("versions", "variants")])
    found = found.join(F.broadcast(listed), "family", "left")
    inside = F.size(F.filter("of", lambda f: f == F.col("family"))) / F.col("n")
    whole = F.array_max(F.transform("notices", lambda x: F.size(F.array_intersect(x, F.col("hit"))) / F.size(x)))
    found = found.withColumn("holds", F.greatest(inside, F.coalesce(whole, F.lit(0.0))))
    other = (F.size("versions") > 0) & (F.size("own_versions") > 0) & ~F.arrays_overlap("versions", "own_versions")
    other = other | (F.size(F.array_except("variants", "own_variants")) > 0)
    sure = (F.col("probability") >= threshold) & (F.col("holds") >= held) & ~F.coalesce(other, F.lit(False))
    found = found.select(key, *NAME, "at", F.when(sure, F.col("family")).otherwise(F.lit(UNKNOWN)).alias("family"), "probability", "holds")
    return found.dropDuplicates([*NAME, "at"])


def of_documents(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, families, n_notices, probability) of every row: sorted distinct families, with unknown among them; empty if none.

    found is the result of `scan` over docs. A row gets what its own text gave, whether its key is null or repeats.
    """
    each = found.groupBy(*NAME).agg(F.sort_array(F.collect_set("family")).alias("families"), F.count(F.lit(1)).alias("n_notices"), F.max("probability").alias("probability"))
    out = docs.select(F.col(key).alias(key), *names_of(key, text)).join(each, NAME, "left")
    return out.select(key, F.coalesce("families", F.array().cast("array<string>")).alias("families"), F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
