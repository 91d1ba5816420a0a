"""License scans: MinHash bands over overlapping word windows, then exact containment (DataFrame functions
only).

For every template length there are windows of that length plus a stride (a quarter of it), a stride apart,
so every occurrence of a template lies inside a window of its length.  Windows and templates are sets of
five-word shingles.  ``bands`` bands of ``rows`` min-hashes are compared; their number follows from the
smallest Jaccard similarity a window can have that holds ``containment`` of its template, so that such a
window collides with at least the probability ``certain``.  The min-hashes of a shingle hash are its
exclusive-ors with fixed constants.

A window can share a minimum with a template only if it holds the shingle at that minimum.  So the scan of
the texts keeps only windows around such shingles, and only those are sketched.  Collisions are verified:
the share of the template's distinct shingles that occur in the window must reach ``containment``.

Defined cases: NULL texts and texts under five words match nothing; equal rows count once; a template with
under five words is an error; templates with equal texts all match; a template with a NULL id or text, and
empty tables, give no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.common import written
from leadscope.llm.op04_decontaminate import id_of, identity, words_of
from leadscope.plans.sizing import bounded_broadcast

SHINGLE = 5

# Short grant lines and the opening or core of common notices, as published.  What their words do not
# cover is not reported: tag lines of under five words (SPDX-License-Identifier: MIT) among them.
TEMPLATES = [
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("mit-line", "Released under the MIT License."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
             "License as published by the Free Software Foundation"),
    ("agpl", "free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
             "License as published by the Free Software Foundation"),
    ("gpl-2.0-version", "Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("lgpl-2.1-version", "Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("gpl-3.0-version", "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("boost-1.0-line", "Distributed under the Boost Software License, Version 1.0."),
    ("mit-line-distributed", "Distributed under the MIT License."),
    ("mit-line-licensed", "Licensed under the MIT License."),
    ("cc-by-4.0-line", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0-line", "CC BY-SA 4.0"),
    ("cc-by-nd-4.0-line", "CC BY-ND 4.0"),
    ("cc-by-nc-sa-4.0-line", "CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd-4.0-line", "CC BY-NC-ND 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd-4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa-4.0", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd-4.0", "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
]
# Identifiers whose tag line has at least five words.
SPDX = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-2.0", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "CC-BY-NC-4.0", "CC-BY-ND-4.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later")
TEMPLATES += [(f"spdx-{name.lower()}", f"SPDX-License-Identifier: {name}") for name in SPDX]


def default_templates(spark) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license_id string, text string")


def stride_of(length: int) -> int:
    return max(1, length // 4)


def band_count(length: int, shingles: int, rows: int, containment: float, certain: float) -> int:
    """Bands that collide with probability ``certain`` for a window just reaching ``containment`` of a
    template of ``length`` words with ``shingles`` distinct shingles."""
    window = length + stride_of(length) - SHINGLE + 1
    held = math.ceil(containment * shingles)
    jaccard = held / (window + shingles - held)
    return max(1, math.ceil(math.log(1 - certain) / math.log1p(-min(jaccard ** rows, 1 - 1e-12))))


def _shingle_hash(words, at):
    return F.xxhash64(*[F.get(words, at + k) for k in range(SHINGLE)])


def _constants(count: int) -> list[int]:
    return np.random.default_rng(13).integers(-(1 << 63), (1 << 63) - 1, count).tolist()


def _minima(shingles: DataFrame, keys: list[str], count: int) -> DataFrame:
    """Min-hashes m0, m1, ... of the column ``h`` per group."""
    return shingles.groupBy(*keys).agg(*[F.min(F.col("h").bitwiseXOR(F.lit(c).cast("long"))).alias(f"m{i}")
                                         for i, c in enumerate(_constants(count))])


def _bands(minima: DataFrame, keys: list[str], bands: int, rows: int) -> DataFrame:
    values = F.array(*[F.xxhash64(*[F.col(f"m{b * rows + r}") for r in range(rows)]) for b in range(bands)])
    return minima.select(*keys, F.posexplode(values).alias("band", "value"))


def _shingled(frame: DataFrame, keys: list[str]) -> DataFrame:
    return (frame.select(*keys, "w", F.explode(F.sequence(F.lit(0), F.size("w") - SHINGLE)).alias("p"))
            .select(*keys, _shingle_hash(F.col("w"), F.col("p")).alias("h")))


def _shingle_set(words):
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)),
                                        lambda i: F.concat_ws(" ", F.slice(words, i, SHINGLE))))


def scan(docs: DataFrame, templates: DataFrame, containment: float = 0.8, rows: int = 2, certain: float = 0.9999,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license_id, containment (the largest of any window), first_word (of the first matching
    window), n_windows, for every template found in a text.  ``templates`` has license_id and text."""
    known = written(templates.where("license_id is not null and text is not null")
                    .select(F.col("license_id").cast("string").alias("license_id"), words_of(F.col("text")).alias("w"))
                    .withColumn("length", F.size("w")), "templates")
    if known.where(F.col("length") < SHINGLE).limit(1).count():
        raise ValueError(f"a template has under {SHINGLE} words")
    lengths = known.groupBy("length").agg(F.min(F.size(_shingle_set(F.col("w")))).alias("shingles")).collect()
    bands = max([band_count(r["length"], r["shingles"], rows, containment, certain) for r in lengths], default=1)
    own = _shingled(known, ["license_id", "length"])
    minima = written(_minima(own, ["license_id", "length"], bands * rows), "minima")
    at_minimum = F.explode(F.array(*[F.col(f"m{i}").bitwiseXOR(F.lit(c).cast("long"))
                                     for i, c in enumerate(_constants(bands * rows))]))
    marks = bounded_broadcast(minima.select("length", at_minimum.alias("h")).distinct())
    template_bands = bounded_broadcast(_bands(minima, ["license_id", "length"], bands, rows))

    doc, version = identity(F.col(id_col), F.col(text_col))
    texts = (docs.select(doc.alias("doc"), version.alias("version"), words_of(F.col(text_col)).alias("w"))
             .where(F.size("w") >= SHINGLE))
    key = ["doc", "version", "length", "window"]
    stride = F.greatest(F.lit(1), F.floor(F.col("length") / 4)).cast("int")
    first = F.greatest(F.lit(0), F.ceil((F.col("p") - F.col("length") - stride + SHINGLE) / stride)).cast("int")
    around = F.explode(F.sequence(first, F.floor(F.col("p") / stride).cast("int")))
    windows = written(
        texts.select("doc", "version", "w", F.explode(F.sequence(F.lit(0), F.size("w") - SHINGLE)).alias("p"))
        .withColumn("h", _shingle_hash(F.col("w"), F.col("p"))).join(marks, "h")
        .select("doc", "version", "length", "w", around.alias("window"))
        .select(*key, F.slice("w", F.col("window") * stride + 1, F.col("length") + stride).alias("w"))
        .dropDuplicates(key), "windows")

    sketched = _bands(_minima(_shingled(windows, key), key, bands * rows), key, bands, rows)
    met = sketched.join(template_bands, ["length", "band", "value"]).select(*key, "license_id").distinct()
    theirs = bounded_broadcast(known.select("license_id", "length", _shingle_set(F.col("w")).alias("template")))
    checked = (met.join(windows, key).join(theirs, ["license_id", "length"])
               .withColumn("held", F.size(F.array_intersect("template", _shingle_set(F.col("w")))) / F.size("template"))
               .where(F.col("held") >= containment))
    return (checked.groupBy("doc", "version", "license_id")
            .agg(F.max("held").alias("containment"), F.min(F.col("window") * stride).cast("long").alias("first_word"),
                 F.count("*").alias("n_windows"))
            .select(id_of(F.col("doc"), F.col("version")).alias("doc_id"), "license_id", "containment", "first_word",
                    "n_windows"))
