"""Licence scans: TF-IDF cosine of headers to templates, then inheritance by directory.

Lines that speak of a licence are compared with notices of known licences as sparse TF-IDF
vectors: terms are joined with the template's weights and products summed per line and
template. A file without a licence of its own takes that of the licence file in its nearest
ancestor directory. DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.sources.durable import durable

#: Notices by which the licences' own texts ask to be named.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without"
        " restriction.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or any later version.",
    ),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Least cosine of a match.
MIN_SCORE = 0.6
#: A line that may be a notice.
NOTICE = r"(?i)licen[sc]e|permission is hereby granted|redistribution and use"
_TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def template_weights() -> list[tuple[int, str, str, float]]:
    """``(template, licence, term, weight)`` with unit length per template, and each term's
    inverse document frequency under the template -1."""
    terms = [Counter(re.findall(_TERM, text.lower())) for _, text in TEMPLATES]
    frequency = Counter(term for counts in terms for term in counts)
    inverse = {t: math.log((1 + len(terms)) / (1 + n)) + 1 for t, n in frequency.items()}
    rows = [(-1, "", term, weight) for term, weight in inverse.items()]
    for number, counts in enumerate(terms):
        raw = {term: n * inverse[term] for term, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        rows += [(number, TEMPLATES[number][0], term, w / norm) for term, w in raw.items()]
    return rows


def notice_lines(files: DataFrame) -> DataFrame:
    """``(path, line_no, terms)`` of the lines that may be notices."""
    return (
        files.filter(F.rlike("text", F.lit(NOTICE)))
        .select("path", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .filter(F.rlike("line", F.lit(NOTICE)))
        .select(
            "path",
            "line_no",
            F.regexp_extract_all(F.lower("line"), F.lit(f"({_TERM})"), 1).alias("terms"),
        )
    )


def header_licences(
    spark: SparkSession, files: DataFrame, min_score: float = MIN_SCORE
) -> DataFrame:
    """``(path, licence, score)``: the best template of each file's lines, if near enough.

    Ties go to the first licence by name.
    """
    weights = spark.createDataFrame(
        template_weights(), "template int, licence string, term string, weight double"
    )
    unseen = math.log(1 + len(TEMPLATES)) + 1
    inverse = F.broadcast(weights.filter("template < 0").select("term", F.col("weight").alias("idf")))
    known = F.broadcast(weights.filter("template >= 0"))
    line = ["path", "line_no"]
    terms = (
        notice_lines(files)
        .distinct()
        .select(*line, F.explode("terms").alias("term"))
        .groupBy(*line, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
        .join(inverse, "term", "left")
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    )
    terms = durable(terms.select(*line, "term", "w"), "terms")
    norms = terms.groupBy(*line).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scores = (
        terms.join(known, "term")
        .groupBy(*line, "template", "licence")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
        .join(norms, line)
        .withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
        .filter(F.col("score") >= min_score)
    )
    best = F.min(F.struct((-F.col("score")).alias("s"), "licence"))
    return scores.groupBy("path").agg(best.alias("best")).select(
        "path", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score")
    )


def directory(path: Column) -> Column:
    """All before the last slash; empty for a file at the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def inherited(own: DataFrame, folders: DataFrame) -> DataFrame:
    """``(folder, inherited, from_folder)`` for ``folders (folder)`` below a licence file.

    ``own`` has ``(path, licence, score)`` of the licence files. Folders meet the licence of
    each ancestor by a join on the ancestor's path; the deepest wins. Of several licence
    files in one folder the best match counts, then the first by name.
    """
    best = F.min(F.struct((-F.col("score")).alias("s"), "licence"))
    covered = (
        own.groupBy(directory(F.col("path")).alias("ancestor"))
        .agg(best.alias("best"))
        .select("ancestor", F.col("best.licence").alias("inherited"))
    )
    parts = F.split("folder", "/", -1)
    depth = F.sequence(F.lit(0), F.when(F.col("folder") == "", 0).otherwise(F.size(parts)))
    chain = folders.select("folder", F.explode(depth).alias("depth")).withColumn(
        "ancestor", F.array_join(F.slice(parts, 1, F.col("depth")), "/")
    )
    return (
        chain.join(covered, "ancestor")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "inherited", "ancestor")).alias("deepest"))
        .select("folder", "deepest.inherited", F.col("deepest.ancestor").alias("from_folder"))
    )


def scan(files: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``files`` with ``licence``, ``score`` and ``origin`` (header, directory or none).

    ``files`` has ``path, text, is_licence_file``. Null texts have no header, null paths
    neither header nor directory. Rows that repeat a path get the same result. An empty table
    gives an empty result; columns named like a result give way to it.
    """
    plain = files.drop("licence", "score", "origin")
    own = durable(header_licences(files.sparkSession, plain, min_score), "headers")
    named = plain.filter("is_licence_file and path is not null").select("path").distinct()
    folder = directory(F.col("path"))
    folders = plain.filter("path is not null").select(folder.alias("folder")).distinct()
    above = durable(inherited(own.join(named, "path"), folders), "folders")
    joined = (
        plain.join(own, "path", "left")
        .withColumn("folder", folder)
        .join(above.select("folder", "inherited"), "folder", "left")
    )
    origin = (
        F.when(F.col("licence").isNotNull(), "header")
        .when(F.col("inherited").isNotNull(), "directory")
        .otherwise("none")
    )
    return joined.withColumn("origin", origin).select(
        *plain.columns, F.coalesce("licence", "inherited").alias("licence"), "score", "origin"
    )
