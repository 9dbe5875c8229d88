"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

All DataFrame and SQL functions. A shingle is the hash of five consecutive
words (lower-cased runs of letters and digits). Templates are put into classes by
their number m of shingles: class c holds those with m <= c, for c = 1, 2, 4 and so on. For each class a text is cut into windows of three
blocks of c / 2 shingles (one shingle for c = 1), starting at every block, so a
run of c shingles lies within a window whatever its place. A window that holds
0.8 of a template has a Jaccard similarity above 0.23 with it, and all of it
above 0.28. Each of ``BANDS`` bands is one MinHash value, so such a window meets the template in some band with
a probability above 1 - 0.77**32 = 0.9997 (1 - 0.72**32 = 0.99997 for all of it).

Only windows that hold an anchor word are cut. That loses nothing: anchors are
chosen so that the shingles of a template without any anchor are fewer
than the share a match needs, which is checked when the templates are read.
"""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 32
# A match holds at least 4/5 of the template's shingles.
SHARE = (4, 5)
# Templates are handed to every task, so their number is bounded; more raise an error and need several scans.
MAX_TEMPLATES = 2000

# License notices as their publishers word them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                         "You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                      "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
                 "to deal in the Software without restriction",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}
ANCHORS = ("license", "permission", "redistribut", "software", "binary", "modification", "permitted", "conditions")


def template_words(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def template_shingles(text: str) -> list[str]:
    """Distinct five-word shingles, a shorter text being one shingle of what it has."""
    w = template_words(text)
    return list(dict.fromkeys(" ".join(w[i:i + SHINGLE]) for i in range(max(len(w) - SHINGLE + 1, 1)))) if w else []


def needed(m: int) -> int:
    return math.ceil(m * SHARE[0] / SHARE[1])


def template_class(m: int) -> int:
    return 1 << (m - 1).bit_length()


def check_anchors(templates: dict[str, str], anchors: tuple[str, ...]) -> None:
    """Raise unless every possible match holds an anchor word."""
    for name, text in templates.items():
        sh = template_shingles(text)
        free = [s for s in sh if not any(a in s for a in anchors)]
        if not sh or len(free) >= needed(len(sh)):
            raise ValueError(f"template {name!r} can be matched by a text without any of the anchor words {anchors}")


def _shingle_hashes(words: Column) -> Column:
    """Hashes of all five-word shingles in order; a text of one to four words has one shingle."""
    n = F.size(words)
    at = F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1)))
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " "))))


def _min_hash(shingles: Column, band: Column) -> Column:
    return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, band)))


def _template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, m, cls, shingles): one row a template; built from the parameter, so its size is that of the parameter."""
    rows = [(name, template_class(len(sh)), sh) for name, text in templates.items() for sh in (template_shingles(text),)]
    t = spark.createDataFrame(rows, "license string, cls int, words array<string>")
    return t.select("license", "cls", F.size("words").alias("m"), F.transform("words", lambda s: F.xxhash64(s)).alias("t_shingles"))


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, anchors: tuple[str, ...] = ANCHORS) -> DataFrame:
    """``docs`` without the text, with ``licenses`` (sorted names of the templates found) and ``n_licenses``.

    Whole texts are scanned, without Python on the way. A null or empty text, or one without letters and digits,
    holds no license. Repeated rows are scanned alike and all kept; columns named like a new one are replaced.
    """
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates; scan in parts")
    check_anchors(templates, anchors)
    spark = docs.sparkSession
    known = _template_table(spark, templates)
    classes = sorted({template_class(len(template_shingles(t))) for t in templates.values()})
    names = [c for c in docs.columns if c != text and c.lower() not in ("licenses", "n_licenses")]

    low = F.lower(F.col(text))

    def anchored(x: Column) -> Column:
        return functools.reduce(operator.or_, (F.contains(x, F.lit(a)) for a in anchors))

    words = F.when(anchored(low), F.filter(F.split(low, "[^0-9a-z]+"), lambda w: w != "")).otherwise(F.array().cast("array<string>"))
    base = docs.select(*names, F.monotonically_increasing_id().alias("_row"), words.alias("_words"))
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size("_words") - 1, F.lit(0))), lambda i: anchored(F.get("_words", i)))
    base = base.withColumn("_at", F.when(F.size("_words") > 0, places).otherwise(F.array().cast("array<int>"))).withColumn("_h", _shingle_hashes(F.col("_words")))

    def windows(c: int) -> Column:
        """The windows of class c with an anchor word; the last ones hold what is left of the text."""
        block, count = max(c // 2, 1), 1 if c == 1 else 3
        last = F.floor((F.size("_h") - 1) / block).cast("int")

        def starts(i: Column) -> Column:
            low_end = F.greatest(F.floor((i - (SHINGLE - 1)) / block).cast("int") - (count - 1), F.lit(0))
            return F.sequence(F.least(low_end, last), F.least(F.floor(i / block).cast("int"), last))

        blocks = F.array_distinct(F.flatten(F.transform("_at", starts)))
        return F.transform(blocks, lambda i: F.struct(F.lit(c).alias("cls"), F.slice("_h", i * block + 1, block * count).alias("s")))

    cut = base.select(*names, "_row", F.explode_outer(F.concat(*(windows(c) for c in classes))).alias("_w"))
    # A window of class 1 is one shingle, for which a single band is certain.
    n_bands = F.when(F.col("_w").isNull(), 0).when(F.col("_w.cls") == 1, 1).otherwise(BANDS)
    bands = F.filter(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: b < n_bands)
    keyed = cut.select(*names, "_row", "_w", F.explode_outer(bands).alias("_band"))
    keyed = keyed.withColumn("_key", F.xxhash64("_band", _min_hash(F.col("_w.s"), F.col("_band"))))
    t_bands = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("t_band"))
    t_bands = t_bands.select("license", "m", F.col("cls").alias("t_cls"), "t_shingles", F.xxhash64("t_band", _min_hash(F.col("t_shingles"), F.col("t_band"))).alias("t_key"))
    met = keyed.join(F.broadcast(t_bands), (F.col("_band").isNotNull()) & (F.col("_key") == F.col("t_key")) & (F.col("_w.cls") == F.col("t_cls")), "left")
    held = F.size(F.array_intersect(F.col("_w.s"), F.col("t_shingles"))) * SHARE[1] >= F.col("m") * SHARE[0]
    found = F.array_sort(F.collect_set(F.when(held, F.col("license"))))
    out = met.groupBy("_row").agg(*(F.first(c).alias(c) for c in names), found.alias("licenses"))
    return out.drop("_row").withColumn("n_licenses", F.size("licenses").cast("long"))
