"""Licence scan: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance.

Method (DataFrame functions only): every line of every whole text, and every run of two to
``WRAP`` lines (a notice may be wrapped), is compared with one-notice templates. Term
frequencies are weighted by smoothed inverse frequencies counted over the lines that speak
of a licence; terms no template has weigh like the rarest. Every line is cut into terms and
measured once; runs are judged by sums over their lines (see ``near_runs``), and only those
that may reach ``MIN_COSINE`` are put together and scored: no line or run of that cosine is
left out. The best cosine picks the licence; at least
``MIN_COSINE`` counts. Files with a licence file's name are compared as a whole with the
full texts in ``licence_texts`` too (at least ``WHOLE_COSINE``), which goes before lines. Such
a file gives its licence to its directory; files without one of their own take the licence
of the nearest ancestor directory that has one, found by joins of path prefixes.

Only the template vectors (fixed; the full texts' come from files beside this module) and the frequencies of their terms (as many rows as the
templates have terms) are broadcast.

Defined cases: null or empty text has no candidate line; ties of cosine go to the smaller
licence name, of files in one directory to the smaller path; repeated rows are scanned each;
a null path has no directory and inherits nothing.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayguard.llm.common import spool

MIN_COSINE, WHOLE_COSINE, WRAP = 0.6, 0.8, 4
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying)s?([-_][a-z0-9+-]+(\.[0-9]+)*|\.lesser|\.lib)?(\.(txt|md|markdown|rst|adoc|html?))?$"
TERM = "[a-z0-9](?:[a-z0-9.]*[a-z0-9])?"  # letters, digits and dots, none of these at either end
SPEAKS = "(?i)licen[sc]e|copyright|spdx|warranty|permission is hereby"
# fixed values: common notice lines of public licences
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
# more notices: a list of their own, as the frequencies above are counted over the terms of TEMPLATES
MORE_TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty."),
)
TEXTS = Path(__file__).parent / "licence_texts"


def terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TERM), 0)


def template_terms(spark: SparkSession, templates) -> DataFrame:
    rows = [(i, name, line) for i, (name, line) in enumerate(templates)]
    t = spark.createDataFrame(rows, "template int, licence string, line string")
    return (t.select("template", "licence", F.explode(terms(F.col("line"))).alias("term"))
            .groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf")))


def spoken_lines(texts: DataFrame) -> DataFrame:
    """The terms of every line that speaks of a licence."""
    return spool(texts.where(F.col("text").rlike(SPEAKS))
                 .select(F.explode(F.filter(F.split("text", "\n"), lambda x: x.rlike(SPEAKS))).alias("words"))
                 .select(terms(F.col("words")).alias("terms")))


def weighted(t: DataFrame, idf: DataFrame) -> DataFrame:
    """(template, licence, term, tw, tn): the template vectors and their norms."""
    tv = t.join(F.broadcast(idf), "term").select("template", "licence", "term", (F.col("tf") * F.col("idf")).alias("tw"))
    norm = tv.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    return spool(tv.join(F.broadcast(norm), "template"))


def cosines(lines: DataFrame, tv: DataFrame, idf: DataFrame, rarest: Column, least: float) -> DataFrame:
    """(key, licence, cosine) of the best of every key's candidates (key, line, terms) with ``least`` or more."""
    w = (lines.select("key", "line", F.explode("terms").alias("term")).groupBy("key", "line", "term")
         .agg(F.count(F.lit(1)).alias("tf")).join(F.broadcast(idf), "term", "left")
         .withColumn("w", F.col("tf") * F.coalesce("idf", rarest)))
    ln = w.groupBy("key", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("ln"))
    dots = (w.join(F.broadcast(tv), "term").groupBy("key", "line", "template", "licence", "tn")
            .agg(F.sum(F.col("w") * F.col("tw")).alias("dot")))
    cos = dots.join(ln, ["key", "line"]).withColumn("cosine", F.round(F.col("dot") / (F.col("tn") * F.col("ln")), 6))
    best = cos.where(F.col("cosine") >= least).groupBy("key").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    return best.select("key", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))


def measured(lines: Column, tv: DataFrame, idf: DataFrame, rarest: float) -> Column:
    """What a run of lines needs of each of its lines: ``dots``, its products with every template over the
    template's norm, ``most``, the largest of them, and ``square``, a lower bound of its squared norm (a term that no template has counts as often as it occurs).

    Products of lines add up to the run's and squared norms to no more than the run's.
    """
    rows = tv.collect()  # bounded by the templates
    weight = {r["term"]: r["idf"] for r in idf.collect()}
    vocab = sorted(weight)
    place = F.array(*map(F.lit, vocab))
    squares = F.array(*[F.lit(weight[t] ** 2) for t in vocab])
    share = {(r["template"], r["term"]): weight[r["term"]] * r["tw"] / r["tn"] for r in rows}
    shares = F.array(*[F.array(*[F.lit(share.get((i, t), 0.0)) for t in vocab]) for i in sorted({r["template"] for r in rows})])
    number = F.transform(lines, lambda x: terms(x))
    number = F.transform(number, lambda t: F.struct(
        F.array_sort(F.transform(F.filter(t, lambda x: x.isin(vocab)), lambda x: F.array_position(place, x).cast("int"))).alias("v"),
        F.size(t).alias("n")))
    same = lambda a, x: F.when(a["last"] == x, a["times"] + 1).otherwise(F.lit(1))
    start = F.struct(F.lit(0).alias("last"), F.lit(0).alias("times"), F.lit(0.0).alias("sum"))
    # a term's k-th occurrence adds 2 k - 1 to its squared frequency
    known = lambda v: F.aggregate(v, start, lambda a, x: F.struct(
        x.alias("last"), same(a, x).alias("times"), (a["sum"] + F.element_at(squares, x) * (2 * same(a, x) - 1)).alias("sum")), lambda a: a["sum"])
    number = F.transform(number, lambda t: F.struct(
        F.transform(shares, lambda q: F.aggregate(t["v"], F.lit(0.0), lambda a, x: a + F.element_at(q, x))).alias("dots"),
        (known(t["v"]) + (t["n"] - F.size(t["v"])) * F.lit(rarest * rarest)).alias("square")))
    return F.transform(number, lambda t: F.struct(t["dots"].alias("dots"), F.array_max(t["dots"]).alias("most"), t["square"].alias("square")))


def near_runs(lines: Column, measures: Column, templates: int) -> Column:
    """Every different line and run of 2 to WRAP lines that may have MIN_COSINE to a template: none of that cosine is left out."""
    least = F.lit(MIN_COSINE - 1e-4)
    total = lambda run, f: F.aggregate(run, F.lit(0.0), lambda a, x: a + f(x))

    def near(run: Column) -> Column:
        enough = lambda dot: dot >= F.greatest(F.lit(1e-9), least * F.sqrt(total(run, lambda x: x["square"])))
        return enough(total(run, lambda x: x["most"])) & F.exists(
            F.sequence(F.lit(1), F.lit(templates)), lambda i: enough(total(run, lambda x: F.element_at(x["dots"], i))))

    found = []
    for k in range(1, WRAP + 1):
        starts = F.when(F.size(lines) >= k, F.sequence(F.lit(1), F.size(lines) - (k - 1))).otherwise(F.array().cast("array<int>"))
        found.append(F.transform(F.filter(starts, lambda i: near(F.slice(measures, i, F.lit(k)))), lambda i: F.concat_ws(" ", F.slice(lines, i, F.lit(k)))))
    return F.array_distinct(F.concat(*found))  # equal lines have equal cosines


def best_lines(texts: DataFrame, spoken: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(key, licence, cosine) of the best line or run of lines of every text (key, text) that has one."""
    n = spoken.count()
    # the fixed template table and its term counts: bounded by the templates
    t = template_terms(texts.sparkSession, templates)
    vocab = t.select("term").distinct()
    seen = (spoken.select(F.explode(F.array_distinct("terms")).alias("term")).join(F.broadcast(vocab), "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    idf = spool(vocab.join(seen, "term", "left").select(
        "term", (F.log(F.lit(n + 1.0) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf")))
    tv = weighted(t, idf)
    measures = measured(F.col("lines"), tv, idf, math.log(n + 1.0) + 1)
    split = texts.where("text IS NOT NULL").select("key", F.split("text", "\n").alias("lines"))
    runs = split.select("key", "lines", measures.alias("measures")).select(
        "key", F.posexplode(near_runs(F.col("lines"), F.col("measures"), len(templates))).alias("line", "run"))
    lines = spool(runs.select("key", "line", terms(F.col("run")).alias("terms")))
    return cosines(lines, tv, idf, F.log(F.lit(n + 1.0)) + 1, MIN_COSINE)


def whole_texts(files: DataFrame) -> DataFrame:
    """(key, licence, cosine) of the files (key, path, text) that are a whole licence."""
    full = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    t = template_terms(files.sparkSession, full)
    idf = spool(t.groupBy("term").agg((F.log(F.lit(len(full) + 1.0) / (F.count(F.lit(1)) + 1)) + 1).alias("idf")))
    texts = files.where(F.col("path").rlike(LICENCE_FILE)).select("key", F.lit(0).alias("line"), terms(F.col("text")).alias("terms"))
    return cosines(texts, weighted(t, idf), idf, F.log(F.lit(len(full) + 1.0)) + 1, WHOLE_COSINE)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(files: DataFrame) -> DataFrame:
    """(key, path, licence, cosine, how, from_dir) of every file (key, path, text); ``key``
    tells rows apart, ``how`` is own, inherited or none."""
    texts = files.select("key", "text")
    spoken = spoken_lines(texts)
    found = (whole_texts(files).withColumn("rank", F.lit(0))
             .union(best_lines(texts, spoken).union(best_lines(texts, spoken, MORE_TEMPLATES)).withColumn("rank", F.lit(1))))
    best = found.groupBy("key").agg(F.min(F.struct("rank", (-F.col("cosine")).alias("c"), "licence")).alias("b")).select(
        "key", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))
    own = spool(files.select("key", "path", parent(F.col("path")).alias("dir")).join(best, "key", "left"))
    given = (own.where(F.col("licence").isNotNull() & F.col("path").rlike(LICENCE_FILE)).groupBy("dir")
             .agg(F.min(F.struct("path", "licence")).alias("b")).select("dir", F.col("b.licence").alias("licence")))
    part = F.split("dir", "/")
    ups = (own.where("licence IS NULL AND path IS NOT NULL").select("dir").distinct()
           .withColumn("n", F.explode(F.sequence(F.lit(1), F.size(part))))
           .select("dir", "n", F.array_join(F.slice(part, F.lit(1), F.col("n")), "/").alias("up")))
    found = (ups.join(given.withColumnRenamed("dir", "up"), "up").groupBy("dir")
             .agg(F.max(F.struct("n", "up", "licence")).alias("b"))
             .select("dir", F.col("b.up").alias("from_dir"), F.col("b.licence").alias("inherited")))
    how = F.when(F.col("licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return own.join(found, "dir", "left").select(
        "key", "path", F.coalesce("licence", "inherited").alias("licence"), "cosine", how.alias("how"),
        F.when(F.col("licence").isNull(), F.col("from_dir")).alias("from_dir"))
