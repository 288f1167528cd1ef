"""License scans: TF-IDF cosines of files to licence templates, and inheritance along directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.lookup import lookup
from tidewire.session import settle

THRESHOLD = 0.6
# Lines of a passage: a notice may be spread over this many, and each line starts a passage.
PASSAGE_LINES = 6
# Windows inside lines hold at least this share of a template's number of terms.
WINDOW_SHARE = 0.75
SLASH = "/"
# Names of files that state the licence of their folder.
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|notice)\b"

# Short notices and opening passages of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ "
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
}


def _terms(text: str) -> list[str]:
    return re.findall(r"[a-z0-9.]*[a-z0-9]", text.lower())


def _template_weights(templates: Mapping[str, Sequence[str]], frequency: Mapping[str, int], lines: int) -> list[tuple]:
    """Unit vectors of the templates: template number, licence, term, weight; and the IDF of each term."""
    rows = []
    for number, (licence, text) in enumerate((k, t) for k, texts in templates.items() for t in texts):
        weight = {t: n * _idf(frequency.get(t, 0), lines) for t, n in Counter(_terms(text)).items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        rows += [(number, licence, t, w / norm) for t, w in weight.items()]
    return rows


def _idf(frequency: int, lines: int) -> float:
    return 1.0 + math.log((1.0 + lines) / (1.0 + frequency))


def _anchors(weights: list[tuple], threshold: float) -> dict[int, set[str]]:
    """By template, terms of which every passage that reaches the threshold holds one.

    A passage without the heaviest terms of a template has at most the norm of the others as its cosine.
    """
    found: dict[int, set[str]] = {}
    for number in {w[0] for w in weights}:
        own = sorted((w for w in weights if w[0] == number), key=lambda w: (-w[3], w[2]))
        rest = 1.0
        for _, _, term, weight in own:
            if math.sqrt(max(rest, 0.0)) < threshold:
                break
            found.setdefault(number, set()).add(term)
            rest -= weight * weight
    return found


def _term_list(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9.]*[a-z0-9]"), F.lit(0))


def term_frequencies(texts: DataFrame, terms: Sequence[str]) -> tuple[dict[str, int], int]:
    """In how many of all texts each term of the templates occurs, and the number of texts. One row per term."""
    present = F.array_intersect(_term_list(F.col("text")), F.array(*[F.lit(t) for t in terms]))
    counted = texts.select(F.explode(F.concat(F.array(F.lit("")), present)).alias("term")).groupBy("term").count().collect()
    found = {row["term"]: row["count"] for row in counted}
    return {t: found.get(t, 0) for t in terms}, found.get("", 0)


def _split(files: DataFrame, anchors: Sequence[str]) -> DataFrame:
    """``key, lines``: the terms of each line, for texts that hold an anchor as a term."""
    lowered = files.select("key", F.lower("text").alias("text"))
    some = lowered.filter(reduce(Column.__or__, [F.contains("text", F.lit(t)) for t in anchors]))
    split = some.select("key", F.transform(F.split("text", "\n", -1), lambda x: F.regexp_extract_all(
        x, F.lit("[a-z0-9.]*[a-z0-9]"), F.lit(0))).alias("lines"))
    return split.filter(F.exists("lines", lambda x: F.arrays_overlap(x, F.array(*[F.lit(t) for t in anchors]))))


def _passages(split: DataFrame, anchors: Sequence[str], lines: int) -> DataFrame:
    """``key, line, passage``: 1 to ``lines`` lines from each line on that holds an anchor; terms as arrays."""
    placed = split.select("key", "lines", F.posexplode("lines").alias("line", "terms")).filter(
        F.arrays_overlap("terms", F.array(*[F.lit(t) for t in anchors])))
    stretches = F.explode(F.transform(F.sequence(F.lit(1), F.lit(lines)), lambda n: F.flatten(
        F.slice("lines", F.col("line") + 1, n))))
    return placed.select("key", "line", stretches.alias("passage"))


def _windows(split: DataFrame, templates: Mapping[str, Sequence[str]], weights: list[tuple],
             anchors: Mapping[int, set[str]], threshold: float) -> DataFrame:
    """``key, line, passage``: stretches of terms where a template may lie, wherever lines break.

    An anchor in the text is laid on each of its places in a template. That gives a window of the template's
    length, and one with a quarter more (at least two terms) on either side for words between. Both are cut
    to the first and last term of the template if ``WINDOW_SHARE`` of its length is left, so that a few words that licences
    have in common (licensed under the) don't count alone. Windows whose shared terms can't reach the threshold are left out:
    the cosine is at most the norm of the template's weights of these terms.
    """
    rows = []
    for number, text in enumerate(x for texts in templates.values() for x in texts):
        terms, places = _terms(text), {}
        for k, t in enumerate(terms):
            if t in anchors.get(number, ()):
                places.setdefault(t, []).append(k)
        mass = {t: w * w for n, _, t, w in weights if n == number}
        rows.append((len(terms), max(2, len(terms) // 4), list(places), places, mass))
    # The templates bound this table.
    of_templates = F.broadcast(split.sparkSession.createDataFrame(
        rows, "length int, slack int, own array<string>, places map<string,array<int>>, mass map<string,double>"))
    every = F.array(*[F.lit(t) for t in sorted(set().union(*anchors.values()))])
    terms = split.select("key", F.flatten("lines").alias("terms"), F.flatten(F.transform(
        "lines", lambda x, k: F.array_repeat(k, F.size(x)))).alias("line_of"))
    hits = terms.withColumn("hits", F.filter(F.transform("terms", lambda t, k: F.struct(
        t.alias("term"), k.alias("at"))), lambda x: F.array_contains(every, x["term"])))
    met = hits.join(of_templates, F.arrays_overlap("hits.term", "own"))
    starts = F.array_distinct(F.flatten(F.transform(
        F.filter("hits", lambda x: F.array_contains("own", x["term"])),
        lambda x: F.transform(F.col("places")[x["term"]], lambda k: x["at"] - k))))

    def window(start: Column, slack: Column) -> Column:
        first, end = F.greatest(start - slack, F.lit(0)), F.least(start + F.col("length") + slack, F.size("terms"))
        inside = F.transform(F.slice("terms", first + 1, end - first), lambda t, k: F.struct(
            t.alias("term"), (first + k).alias("at")))
        return F.struct(first.alias("first"), (end - 1).alias("last"), F.filter(
            inside, lambda x: F.map_contains_key("mass", x["term"])).alias("own"))

    shared = met.select("key", "terms", "line_of", "length", "mass", F.flatten(F.transform(starts, lambda s: F.array(
        window(s, F.lit(0)), window(s, F.col("slack"))))).alias("windows"))
    likely = F.filter("windows", lambda w: F.aggregate(
        F.array_distinct(w["own"]["term"]), F.lit(0.0), lambda sum, t: sum + F.col("mass")[t]) >= threshold * threshold - 1e-9)

    def cut(w: Column) -> Column:
        first, last = w["own"][0]["at"], F.element_at(w["own"], -1)["at"]
        enough = last - first + 1 >= F.col("length") * WINDOW_SHARE
        return F.struct(F.when(enough, first).otherwise(w["first"]).alias("first"),
                        F.when(enough, last).otherwise(w["last"]).alias("last"))

    found = F.transform(F.array_distinct(F.transform(likely, cut)), lambda w: F.struct(
        F.get("line_of", w["first"]).alias("line"),
        F.slice("terms", w["first"] + 1, w["last"] - w["first"] + 1).alias("passage")))
    return shared.select("key", F.explode(found).alias("found")).select("key", "found.line", "found.passage")


def detect_licenses(files: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, threshold: float = THRESHOLD,
                    lines: int = PASSAGE_LINES) -> DataFrame:
    """The licence that a passage of a text states best: ``key, licence, score, line``, for texts that reach ``threshold``.

    ``files`` has ``key, text``. A passage is 1 to ``lines`` lines, from a line on that holds an anchor: a
    term of which every passage that reaches the threshold has one. Stretches of terms of about a template's length
    around its anchors are passages too, also inside a line or over line breaks; their line is that of their first term. Weights are term counts times IDF; the
    document frequencies of the templates' terms are counted over all texts, and a term that no template has
    weighs as if no text had it. The cosine is summed over the terms that passage and template share. Ties go
    to the earlier line, then to the licence by name.
    """
    spark, rows = files.sparkSession, files.filter("text is not null").select("key", "text")
    terms = sorted({t for texts in templates.values() for x in texts for t in _terms(x)})
    frequency, n = term_frequencies(rows, terms)
    weights = _template_weights(templates, frequency, n)
    # The templates bound both tables.
    of_terms = F.broadcast(spark.createDataFrame([(t, _idf(frequency[t], n)) for t in terms], "term string, idf double"))
    of_templates = F.broadcast(spark.createDataFrame(weights, "template int, licence string, term string, weight double"))
    anchors = _anchors(weights, threshold)
    every = sorted(set().union(*anchors.values()))
    split = settle(_split(rows, every))
    passages = _passages(split, every, lines).unionByName(
        _windows(split, templates, weights, anchors, threshold)).distinct()
    counted = passages.select("key", "line", "passage", F.explode("passage").alias("term")).groupBy(
        "key", "line", F.xxhash64("passage").alias("passage"), "term").agg(F.count("*").alias("n"))
    weighed = settle(counted.join(of_terms, "term", "left").withColumn(
        "w", F.col("n") * F.coalesce("idf", F.lit(_idf(0, n)))).select("key", "line", "passage", "term", "w"))
    passage = ["key", "line", "passage"]
    norms = weighed.groupBy(*passage).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(of_templates, "term").groupBy(*passage, "template", "licence").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, passage).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).filter(
        F.col("score") >= threshold)
    # The least of these structs is the best passage.
    best = scored.groupBy("key").agg(F.min(F.struct(
        (-F.col("score")).alias("order"), "line", "licence", "score")).alias("best"))
    return best.select("key", "best.licence", "best.score", "best.line")


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def license_scan(files: DataFrame, path: str = "path", text: str = "text", licence_name: str = LICENCE_NAME,
                 templates: Mapping[str, Sequence[str]] = TEMPLATES, threshold: float = THRESHOLD,
                 lines: int = PASSAGE_LINES) -> DataFrame:
    """The licence of each file: its own or that of the nearest folder above it.

    Returns ``path, licence, origin, score, line, folder``, one row per row of ``files``. ``origin`` is ``file`` if a
    passage of the text, lines or part of a line, states the licence (``score`` and ``line``, from 0), ``folder`` if it is inherited
    (``folder`` names the folder), and null if there is none. A folder has the licence that the files in it whose name
    matches ``licence_name`` state with the highest score, ties by name of the licence. A file inherits
    from its own folder or the nearest one above, up to the root ``''``.

    Folders are joined, not files: each distinct folder meets its ancestors once, and files look up the
    result. Both lookups are broadcast up to a measured size and otherwise have hot keys split. Everything
    is a built-in function.

    A null or empty text states nothing; a null path inherits nothing; repeated rows get the same result.
    An empty table gives an empty one. Other columns are ignored.
    """
    rows = files.select(F.col(path).cast("string").alias("path"), F.col(text).alias("text")).withColumn(
        "key", F.md5(F.concat_ws("\n", F.coalesce("path", F.lit("")), F.md5(F.coalesce("text", F.lit(""))))))
    found = settle(detect_licenses(rows.select("key", "text"), templates, threshold, lines))
    own = settle(lookup(rows.select("path", "key"), found, "key", "path"))
    named = own.filter(F.col("licence").isNotNull() & F.regexp_extract("path", r"[^/]*$", 0).rlike(licence_name))
    folders = settle(named.groupBy(_folder(F.col("path")).alias("above")).agg(
        F.min(F.struct((-F.col("score")).alias("order"), "licence")).alias("best")).select(
            "above", F.col("best.licence").alias("inherited")))
    wanting = own.filter(F.col("licence").isNull() & F.col("path").isNotNull()).select(
        _folder(F.col("path")).alias("at")).distinct()
    parts = F.split("at", SLASH)
    chain = wanting.select("at", F.explode(F.transform(
        F.sequence(F.lit(0), F.when(F.col("at") == "", 0).otherwise(F.size(parts))),
        lambda n: F.array_join(F.slice(parts, 1, n), SLASH))).alias("above"))
    nearest = settle(lookup(chain, folders, "above", "at", "inner").groupBy("at").agg(
        F.max(F.struct(F.length("above").alias("length"), "above", "inherited")).alias("nearest")).select(
            "at", "nearest.above", "nearest.inherited"))
    told = lookup(own.withColumn("at", _folder(F.col("path"))), nearest, "at", "key")
    stated = F.col("licence").isNotNull()
    return told.select(
        "path", F.coalesce("licence", "inherited").alias("licence"),
        F.when(stated, "file").when(F.col("inherited").isNotNull(), "folder").alias("origin"),
        "score", "line", F.when(~stated, F.col("above")).alias("folder"))
