"""License scan: MinHash bands over overlapping windows find templates, exact containment checks them.

Everything is DataFrame expressions. A text without any of a few long words of the templates lacks too
many word pairs of each to hold one (``telling_words``); the others are cut into lower-case words, and windows as long as a
template, an eighth of it apart, are compared with it. Only windows that hold a word pair of some
template are formed, since a window without one can't contain any. A window's signature has
``BANDS`` bands of one minimum each: a window that holds the template in full shares at least
60 % of its word pairs with it and collides in some band with a probability of 1 - 0.4 ** 16, over
0.9999995; at a Jaccard similarity of 0.4 still over 0.9997. What collides is checked by the share of the template's
word pairs that the window, with the eighth around it, contains.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import with_row_id

BANDS = 16
#: Share of a template's word pairs that a text has to contain.
CONTAINED = 0.8

# License notices as published.
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "proprietary": "All rights reserved.",
}


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def telling_words(templates: dict[str, str], contained: float) -> list[str]:
    """Words, the longest of each template, so many that a text without any of them misses more of each
    template's distinct word pairs than ``contained`` allows."""
    out: set[str] = set()
    for notice in templates.values():
        w = words(notice)
        pairs = set(zip(w, w[1:]))
        allowed = max((m for m in range(len(pairs)) if (len(pairs) - m) / len(pairs) >= contained), default=0)
        own: list[str] = []
        for word in sorted({x for p in pairs for x in p}, key=lambda x: (-len(x), x)):
            if sum(not set(own).isdisjoint(p) for p in pairs) <= allowed:
                own.append(word)
        out.update(own)
    return sorted(out)


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, n_words, pairs, bands) of the templates; templates of one word can't be found."""
    rows = [(k, len(w), sorted({f"{a} {b}" for a, b in zip(w, w[1:])})) for k, t in templates.items() if len(w := words(t)) > 1]
    literal = F.array(*(F.struct(F.lit(k).alias("license"), F.lit(n).alias("n_words"), F.array(*map(F.lit, p)).alias("t_pairs"))
                        for k, n, p in rows))
    return spark.range(1).select(F.inline(literal)).withColumn("bands", _bands(F.col("t_pairs")))


def _bands(pairs: Column) -> Column:
    """The least hash of the pairs under each of BANDS hash functions, with the band's number."""

    def least(i: int) -> Column:
        return F.array_min(F.transform(pairs, lambda p: F.xxhash64(p, F.lit(i))))

    return F.array(*(F.struct(F.lit(i).alias("band"), least(i).alias("least")) for i in range(BANDS)))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, contained: float = CONTAINED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, license, first_word, containment, n_windows): the templates that a row's text
    contains to at least ``contained`` of their distinct word pairs.

    ``first_word`` is where the first of the best windows starts (words from 0), ``n_windows`` how
    many windows reach the bound. Rows with null, empty or one-word texts have no result. Repeated
    rows and null ids are reported for each row. Extra columns are not read. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates or TEMPLATES)
    known = templates or TEMPLATES
    all_pairs = sorted({f"{a} {b}" for t in known.values() for w in [words(t)] for a, b in zip(w, w[1:])})
    sizes = sorted({len(w) for t in known.values() if len(w := words(t)) > 1})
    rows = with_row_id(docs, id_col, "rows", text_col)
    # the lower-case text as the element of an array, so that it is made once and not for each word
    telling = [F.lit(w) for w in telling_words(known, contained)]
    may = rows.where(F.exists(F.array(F.lower(text_col)), lambda low: reduce(Column.__or__, [F.contains(low, w) for w in telling], F.lit(False))))
    tokens = may.select("rid", F.split(F.lower(F.translate(F.regexp_replace(text_col, r"[^A-Za-z0-9]+", " "), "\x00", " ")), " ").alias("w"))
    tokens = tokens.select("rid", F.filter("w", lambda x: x != "").alias("w")).where(F.size("w") > 1)
    # word pairs of the text, null where no template has them
    pairs = tokens.select("rid", F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1),
                                            lambda a, b: F.concat_ws(" ", a, b)).alias("p"))
    marked = pairs.select("rid", "p", F.transform("p", lambda x: x.isin(all_pairs)).alias("known"))
    at = F.filter(F.transform("known", lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    marked = marked.where(F.exists("known", lambda x: x)).select("rid", "p", "known", at.alias("at"))

    def step_of(n: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(n / 8)).cast("int")

    def numbers(n: Column) -> Column:
        """Numbers of the windows that hold a hit: those that start up to n - 2 words before it."""
        return F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(
            F.ceil(F.greatest(F.lit(0), i - n + 2) / step_of(n)).cast("int"), F.floor(i / step_of(n)).cast("int")))))

    # a window that is to contain enough of a template can't hold fewer of the templates' word pairs
    def enough(k: Column, n: Column) -> Column:
        start = k * step_of(n)
        own = F.sequence(start, F.least(start + n - 2, F.size("p") - 1))
        return F.size(F.filter(own, lambda j: F.get("known", j))) >= F.floor((contained - 0.3) * (n - 1))

    # before the sizes are unfolded, each of which copies the text's pairs
    by_size = F.filter(F.transform(F.array(*map(F.lit, sizes)), lambda n: F.struct(
        n.alias("n"), step_of(n).alias("step"), F.filter(numbers(n), lambda k: enough(k, n)).alias("numbers"))),
        lambda x: F.size(x["numbers"]) > 0)
    chosen = marked.select("rid", "p", F.explode(by_size).alias("s")).select("rid", "p", "s.n", "s.step", "s.numbers")

    def window(k: Column) -> Column:
        """By position: cutting slices would copy the whole text's array for each window."""
        start, n, step = k * F.col("step"), F.col("n"), F.col("step")
        own = F.sequence(start, F.least(start + n - 2, F.size("p") - 1))
        around = F.sequence(F.greatest(F.lit(0), start - step), F.least(start + n - 2 + step, F.size("p") - 1))
        return F.struct(start.alias("start"), F.array_distinct(F.transform(own, lambda j: F.get("p", j))).alias("own"),
                        F.array_distinct(F.transform(around, lambda j: F.get("p", j))).alias("around"))

    windows = chosen.select("rid", "n", F.inline(F.transform("numbers", window)))
    probes = windows.where(F.size("own") > 0).withColumn("b", F.explode(_bands(F.col("own"))))
    bands = table.select("license", F.col("n_words").alias("n"), "t_pairs", F.explode("bands").alias("b"))
    bands = bands.select("license", "n", "t_pairs", "b.band", "b.least")
    met = (probes.select("rid", "n", "start", "around", "b.band", "b.least")
           .join(F.broadcast(bands), ["n", "band", "least"])  # BANDS rows for each template given
           .withColumn("containment", F.size(F.array_intersect("t_pairs", "around")) / F.size("t_pairs"))
           .where(F.col("containment") >= contained))
    windows_found = met.groupBy("rid", "license", "start").agg(F.max("containment").alias("containment"))
    best = (windows_found.groupBy("rid", "license").agg(
        F.max(F.struct("containment", (-F.col("start")).alias("first"))).alias("best"), F.count("*").alias("n_windows")))
    return (best.join(rows.select("rid", id_col), "rid")
            .select(id_col, "license", (-F.col("best.first")).alias("first_word"), F.col("best.containment").alias("containment"), "n_windows"))
