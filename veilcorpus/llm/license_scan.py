"""Licence scans: notices and licence files by TF-IDF cosine to templates, then inheritance by directory.

Lines and paragraphs are compared as sparse vectors with every template: short notices, titles, and the
paragraphs of whole licence texts (folder `licences`). Only those are
left out that can't reach the least score: without a template's rarer terms, or with too many others. An SPDX line names its licence itself. A document whose words are mostly a licence is a licence file for its directory;
a document without a licence of its own takes that of the nearest directory above it. Every
step is a DataFrame operation.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame, functions as F

# Short public notices and opening sentences of common licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met under this license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0, no license conditions, public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain under the Unlicense license."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("Proprietary", "All rights reserved. No license is granted."),
    ("Proprietary", "All rights reserved."),
)
#: Titles and standard headers that are no paragraph of the texts, or a short one.
TITLES = (
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License."),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("AGPL-3.0", "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
#: The texts of the folder; of equal evidence the first wins.
TEXTS = ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC0-1.0", "Unlicense")
SHARED = {"AGPL-3.0": "GPL-3.0"}  # its other paragraphs are those of the second
PARAGRAPH_TERMS = 12  # shorter paragraphs of the texts ("1. Definitions.") tell no licence
RESERVED = ("all", "rights", "reserved")  # stands beside many licences: counts where there is no other
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*\(?([a-z0-9.+-]+(?:[ \t]+(?:or|and|with)[ \t]+[a-z0-9.+-]+)*+)"
PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"  # comment signs may stand on the line between
#: Words of which every short notice holds one.
TRIGGER = r"(?i)licen[sc]e|permission is hereby|all rights reserved|public domain|spdx"
TERM = r"[a-z0-9]++(?:[.+-][a-z0-9]++)*+"  # possessive, so that long chains need no stack
LEAST = 0.7
FILE_SHARE = 0.5
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicense)[^/]*$"


def terms_of_text(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


@cache
def all_templates() -> tuple[tuple[str, str], ...]:
    """Notices, titles, and the longer paragraphs of the whole texts."""
    texts = {name: files("veilcorpus.llm").joinpath("licences", f"{name}.txt").read_text(encoding="utf-8") for name in TEXTS}
    whole = [*texts.items(), *[(name, texts[like]) for name, like in SHARED.items()]]
    long = [(name, p) for name, text in whole for p in re.split(r"\n(?:[^\w\n]*\n)+", text) if len(terms_of_text(p)) >= PARAGRAPH_TERMS]
    return (*TEMPLATES, *TITLES, *long)


def grouped_templates(templates) -> list[tuple[tuple[str, ...], list[str]]]:
    """Templates of equal terms are one, with all their licences."""
    names: dict[tuple[str, ...], list[str]] = {}
    for name, text in templates:
        held = names.setdefault(tuple(terms_of_text(text)), [])
        if name not in held:
            held.append(name)
    return list(names.items())


def document_frequency(docs: DataFrame, vocabulary: list[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of documents with each term of the templates, over all texts."""
    listed = F.array_distinct(F.filter(terms(F.coalesce(F.col(text), F.lit(""))), lambda t: t.isin(vocabulary)))
    counted = docs.select(F.explode(listed).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return docs.count(), {r["term"]: r["n"] for r in counted.collect()}  # one row a term of the templates


def template_rows(total: int, frequency: dict[str, int], templates: list[tuple[str, ...]]) -> list[tuple[str, float, list[tuple[int, float]]]]:
    """For each term its idf, and its unit weights in the templates that hold it."""
    idf = lambda t: math.log((1 + total) / (1 + frequency.get(t, 0))) + 1
    holders: dict[str, list[tuple[int, float]]] = {}
    for number, listed in enumerate(templates):
        weights = {t: n * idf(t) for t, n in Counter(listed).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        for term, w in weights.items():
            holders.setdefault(term, []).append((number, w / norm))
    return [(t, idf(t), held) for t, held in sorted(holders.items())]


def needed_terms(rows: list[tuple[str, float, list[tuple[int, float]]]], least: float) -> dict[str, set[int]]:
    """For each rarer term the templates that need one of theirs.

    The other terms of a template have a length below `least`, and so has any unit vector's product with them.
    """
    by_template: dict[int, list[tuple[float, str, float]]] = {}
    for term, idf, held in rows:
        for number, weight in held:
            by_template.setdefault(number, []).append((-idf, term, weight))
    needed: dict[str, set[int]] = {}
    for number, weighted in by_template.items():
        rest = sum(w * w for _, _, w in weighted)
        for _, term, w in sorted(weighted):
            if rest < max(0.0, least - 1e-4) ** 2:
                break
            needed.setdefault(term, set()).add(number)
            rest -= w * w
    return needed


def best_notices(docs: DataFrame, *, text: str = "text", templates=None, least: float = LEAST) -> DataFrame:
    """`row, license, score, words, all_words`: for each row of `docs` (its own number is `row`) with a notice, the best one.

    `words` counts the terms in all lines and paragraphs of the row that match some licence, those
    of a line in such a paragraph once, and `all_words` all terms of the row. The licence with the best
    score wins, of equal scores the one that more words match, then the one listed first.
    """
    templates = all_templates() if templates is None else templates
    grouped = grouped_templates(templates)
    listed = [t for t, _ in grouped]
    vocabulary = sorted({t for own in listed for t in own})
    total, frequency = document_frequency(docs, vocabulary, text)
    rows = template_rows(total, frequency, listed)
    needed = needed_terms(rows, least)
    spark = docs.sparkSession
    # One row a term of the fixed templates.
    postings = spark.createDataFrame(
        [(t, idf, [(n, w, n in needed.get(t, ())) for n, w in held]) for t, idf, held in rows],
        "term string, idf double, held array<struct<template:int,weight:double,needed:boolean>>",
    )
    names = spark.createDataFrame(
        [(n, [(name, t != RESERVED, -len(templates) * n - i) for i, name in enumerate(own)]) for n, (t, own) in enumerate(grouped)],
        "template int, of array<struct<license:string,strong:boolean,first:int>>",
    )
    rare = math.log(1 + total) + 1
    part = lambda block, line, x: F.struct(block.alias("block"), F.lit(line).alias("line"), x.alias("part"))
    may_match = lambda found: F.exists(found, lambda t: t.isin(sorted(needed)))

    edge = [1 + (rare - 1) * i / 8 for i in range(1, 8)]  # idf in eight bands, each taken at its upper end
    bands = [(top, [t for t, idf, _ in rows if idf <= top and (i == 0 or idf > edge[i - 1])]) for i, top in enumerate(edge)]

    def can_reach(found: Column) -> Column:
        """False only where the terms outside all templates alone hold the part below `least`.

        No product is longer than the part's share in the templates' terms; each outside term adds `rare` squared at least.
        """
        most = max(0.0, least - 1e-4) ** 2

        def upper(x: Column) -> Column:
            out = F.lit(rare)
            for top, held in reversed(bands):
                out = F.when(x.isin(held), top).otherwise(out) if held else out
            return out

        def held_against_rest(known: Column) -> Column:
            inside = F.aggregate(
                F.array_distinct(known), F.lit(0.0), lambda total, x: total + F.pow(F.size(F.filter(known, lambda y: y == x)) * upper(x), F.lit(2.0))
            )
            return inside * (1 - most) >= most * rare * rare * (F.size(found) - F.size(known))

        return F.transform(F.array(F.filter(found, lambda t: t.isin(vocabulary))), held_against_rest)[0]

    def parts_of(block: Column, at: Column) -> Column:
        """The lines of a paragraph, and itself if it has several."""
        whole = F.filter(F.array(block), lambda x: x.contains("\n"))
        return F.concat(F.transform(F.split(block, r"\n"), lambda x: part(at, True, x)), F.transform(whole, lambda x: part(at, False, x)))

    kinds = F.flatten(F.transform(F.split("text", PARAGRAPH), parts_of))
    # The terms are a column first: beside `explode` their number would be found again for each of them.
    some = docs.select("row", F.col(text).alias("text"), terms(F.col(text)).alias("terms")).filter(may_match(F.col("terms")) | F.col("text").rlike(SPDX))
    parts = some.select("row", F.size("terms").alias("all_words"), F.posexplode(kinds).alias("at", "p"))
    spdx = F.when(F.col("p.line"), F.regexp_extract("p.part", SPDX, 1)).otherwise("")
    found = parts.select("row", "all_words", "at", "p.block", "p.line", spdx.alias("spdx"), terms(F.col("p.part")).alias("terms"))
    key = ["row", "all_words", "at", "block", "line", "spdx", "words"]
    counted = found.filter((may_match(F.col("terms")) & can_reach(F.col("terms"))) | (F.col("spdx") != "")).withColumn("words", F.size("terms")).select(*key, F.explode("terms").alias("term"))
    counted = counted.groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = counted.join(F.broadcast(postings), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(rare)))
    # Template -1 gathers the squared length of the part itself.
    each = F.concat(
        F.array(F.struct(F.lit(-1).alias("template"), F.col("w").alias("weight"), F.lit(True).alias("needed"))),
        F.coalesce("held", F.array().cast("array<struct<template:int,weight:double,needed:boolean>>")),
    )
    products = weighed.select(*key, "w", F.inline(each)).groupBy(*key, "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.bool_or("needed").alias("needed"))
    scored = products.filter("needed").groupBy(*key).agg(
        F.max(F.when(F.col("template") == -1, F.sqrt("dot"))).alias("norm"),
        F.collect_list(F.when(F.col("template") >= 0, F.struct("template", F.round("dot", 9).alias("dot")))).alias("near"),
    )
    near = F.transform("near", lambda x: F.struct(x["template"].alias("template"), F.round(x["dot"] / F.col("norm"), 6).alias("score")))
    by_text = scored.select(*key, F.inline(F.filter(near, lambda x: x["score"] >= least))).join(F.broadcast(names), "template")
    by_text = by_text.select(*key, "score", F.inline("of"))
    # A trailing "only", "or later" or "+" is no part of the licence's name here.
    named = F.regexp_replace("spdx", r"(?i)(-only|-or-later|\+)(?=[ \t]|$)", "")
    by_spdx = scored.filter("spdx <> ''").select(*key, F.lit(1.0).alias("score"), named.alias("license"), F.lit(True).alias("strong"), F.lit(0).alias("first"))
    # The null licence gathers what matches any.
    matched = by_text.unionByName(by_spdx).withColumn("license", F.explode(F.array("license", F.lit(None))))
    best, top = F.struct("score", "first"), F.max("best").alias("best")
    strong = F.max("strong").alias("strong")
    by_part = matched.groupBy("row", "all_words", "block", "license", "at", "line", "words").agg(strong, F.max(best).alias("best"))
    by_block = by_part.groupBy("row", "all_words", "block", "license").agg(
        strong,
        top,
        # A matching paragraph holds its lines.
        F.coalesce(F.max(F.when(~F.col("line"), F.col("words"))), F.sum("words")).alias("words"),
    )
    by_license = by_block.groupBy("row", "all_words", "license").agg(strong, top, F.sum("words").alias("words"))
    rank = F.struct("strong", F.col("best.score").alias("score"), "words", F.col("best.first").alias("first"), "license")
    own = by_license.groupBy("row", "all_words").agg(
        F.max(F.when(F.col("license").isNotNull(), rank)).alias("top"), F.max(F.when(F.col("license").isNull(), F.col("words"))).alias("words")
    )
    return own.select("row", F.col("top.license").alias("license"), F.col("top.score").alias("score"), "words", "all_words")


def directory_of(path: Column) -> Column:
    """All before the last slash; of a path without one, the empty text."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def ancestors(folder: Column) -> Column:
    """The directory and all above it, nearest first; the last is the empty root."""
    steps = F.split(folder, "/")
    levels = F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(levels, F.array(F.lit(""))))


def license_scan(docs: DataFrame, path: Column, *, doc_id: str = "doc_id", text: str = "text", templates=None, least: float = LEAST, file_share: float = FILE_SHARE) -> DataFrame:
    """Per row `doc_id, path, license, how, score, from_directory`.

    `how`: `own` for a notice in the text, `inherited` from the nearest directory with a
    licence file, or `none`. A licence file is named like one, or matches in at least
    `file_share` of its words; of several in one directory that of the best score counts,
    ties by the licence's name. A null path is in no directory and inherits nothing; null and
    empty texts have no notice of their own. Repeated rows each have a row. Extra columns are
    not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), path.alias("path"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = best_notices(rows.select("row", "text"), templates=templates, least=least)
    own = rows.select("row", "doc_id", "path", directory_of(F.col("path")).alias("folder"))
    own = own.join(found, "row", "left")
    is_file = F.col("path").rlike(FILE_NAME) | (F.col("words") >= F.lit(file_share) * F.col("all_words"))
    files = own.filter(F.col("license").isNotNull() & F.col("path").isNotNull() & is_file)
    by_folder = files.groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("best"))
    by_folder = by_folder.select(F.col("folder").alias("holder"), F.col("best.license").alias("inherited"), (-F.col("best.s")).alias("file_score"))
    # Directories are far fewer than files: their ancestors are looked up once each.
    folders = own.filter(F.col("path").isNotNull()).select("folder").distinct()
    above = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("steps", "holder"))
    near = above.join(by_folder, "holder").groupBy("folder").agg(F.min(F.struct("steps", "holder", "inherited", "file_score")).alias("n"))
    held = own.join(near, "folder", "left")
    mine = F.col("license").isNotNull()
    there = F.col("path").isNotNull() & F.col("n").isNotNull()
    return held.select(
        "doc_id",
        "path",
        F.when(mine, F.col("license")).when(there, F.col("n.inherited")).alias("license"),
        F.when(mine, "own").when(there, "inherited").otherwise("none").alias("how"),
        F.when(mine, F.col("score")).when(there, F.col("n.file_score")).alias("score"),
        F.when(~mine & there, F.col("n.holder")).alias("from_directory"),
    )
