"""Scans of texts for license notices and whole licenses, in built-in functions only.

Words are shingled by five. A template of up to ``WHOLE`` shingles is one passage, a
longer one is cut into overlapping passages of ``PASSAGE`` shingles. Over a document slide
windows as long as each passage, one shingle apart; ``BANDS`` minimum hashes of a window
are its bands, and templates are retrieved by equal bands of a passage. A window that
contains three quarters of a passage of its own length has a similarity of 0.6 at least,
so one of twelve bands agrees with a probability of 1 - 0.4^12 > 0.99998, and an
unchanged passage always agrees. Retrieved templates are verified by exact containment of
all their shingles: a join on shingles says where the template's are, each counts for a
run of window starts, and sums along the starts give the best window. That is linear in
the shingles found, however long the template.

A window without any shingle of any template cannot agree on a band, so only the
others are hashed. The templates are a fixed table, so what is sent to all tasks does
not grow with the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftgraph.llm.exact_dedup import ascii_lower

SHINGLE = 5
BANDS = 12
# Shingles of the longest template that is one passage, of a passage of a longer one, and from one such to the next.
WHOLE = 16
PASSAGE = 8
STEP = 4
# Templates that may be held as constants of a plan.
MOST_TEMPLATES = 2000

TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "lgpl": "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def shingles_of(text: Column) -> Column:
    """Hashes of all runs of SHINGLE words; words are letters and digits, A-Z lower-cased, and all non-ASCII characters."""
    words = F.filter(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")

    def cut(hashed: Column) -> Column:
        places = F.when(F.size(hashed) >= SHINGLE, F.sequence(F.lit(1), F.size(hashed) - (SHINGLE - 1)))
        none = F.array().cast("array<int>")
        return F.transform(F.coalesce(places, none), lambda i: F.xxhash64(F.slice(hashed, i, SHINGLE)))

    return _once(F.transform(words, lambda w: F.xxhash64(w)), cut)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, and not again for each element of an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bands(window: Column, size: int) -> Column:
    def key(band: int) -> Column:
        return F.xxhash64(F.array_min(F.transform(window, lambda s: F.xxhash64(s, F.lit(band)))), F.lit(band), F.lit(size))

    return F.array(*[key(band) for band in range(BANDS)])


def _passages(wanted: list[int]) -> list[list[int]]:
    if len(wanted) <= WHOLE:
        return [wanted]
    last = len(wanted) - PASSAGE
    return [wanted[at : at + PASSAGE] for at in [*range(0, last, STEP), last]]


def license_scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    percent: int = 75,
    short_texts: bool = True,
) -> DataFrame:
    """One row per document and template found in it: id, template, n_shingles, n_found, word.

    A template is found where a window of as many shingles as it has contains
    ``percent`` of its shingles; ``n_found`` is the most in any window and ``word`` the
    first place (from 0) of a window with so many. Templates need five words. A text
    with fewer shingles than the template is one window, unless ``short_texts`` is off.

    A null or empty text, or one without a template, gives no row; documents are
    judged row by row, so ids may repeat or be null. Other columns are ignored.
    """
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates; scan for them in lots")
    spark = docs.sparkSession
    table = spark.createDataFrame(sorted(templates.items()), "template string, notice string").coalesce(1)
    table = table.select("template", F.array_distinct(shingles_of(F.col("notice"))).alias("wanted"))
    known = [(r["template"], r["wanted"]) for r in table.collect()]
    if short := [name for name, wanted in known if not wanted]:
        raise ValueError(f"templates of less than {SHINGLE} words: {short}")
    passages = [(name, len(p), p) for name, wanted in known for p in _passages(wanted)]
    sizes = sorted({size for _, size, _ in passages})
    keys = F.coalesce(*[F.when(F.col("size") == n, _bands(F.col("passage"), n)) for n in sizes])
    cut = spark.createDataFrame(passages, "template string, size int, passage array<bigint>").coalesce(1)
    keyed = {(r["template"], key) for r in cut.select("template", keys.alias("keys")).collect() for key in r["keys"]}
    # What a document's shingles and bands are joined to: a band's key retrieves a template, a shingle is one of it.
    parts = [(name, len(wanted), False, s) for name, wanted in known for s in wanted]
    parts += [(name, len(dict(known)[name]), True, key) for name, key in sorted(keyed)]
    wanted = spark.createDataFrame(parts, "template string, size int, is_band boolean, value bigint").coalesce(1)
    every = sorted({s for _, own in known for s in own})

    shingled = docs.select(
        F.col(f"`{id_column}`").alias("id"), shingles_of(F.col(f"`{text_column}`").cast("string")).alias("shingles")
    )
    shingled = shingled.withColumn("near", F.transform("shingles", lambda s: s.isin(every)))
    some = shingled.where(F.array_contains("near", True)).withColumn("row", F.monotonically_increasing_id())

    def bands_of(size: int) -> Column:
        last = F.size("shingles") - (size - 1)
        places = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))
        if not short_texts:
            places = F.when(last > 0, places).otherwise(F.array().cast("array<int>"))
        windows = F.filter(places, lambda i: F.array_contains(F.slice("near", i, size), True))
        return F.flatten(F.transform(windows, lambda i: _bands(F.slice("shingles", i, size), size)))

    bands = F.transform(
        F.array_distinct(F.concat(*[bands_of(n) for n in sizes])),
        lambda key: F.struct(F.lit(True).alias("is_band"), key.alias("value"), F.lit(0).alias("at")),
    )
    places = F.filter(F.sequence(F.lit(1), F.size("shingles")), lambda i: F.get("near", i - 1))
    hits = F.transform(
        places,
        lambda i: F.struct(F.lit(False).alias("is_band"), F.get("shingles", i - 1).alias("value"), (i - 1).alias("at")),
    )
    found = some.select("row", "id", F.size("shingles").alias("count"), F.inline(F.concat(hits, bands)))
    found = found.join(F.broadcast(wanted), ["is_band", "value"])

    # A shingle is counted in the windows that start after its last place before and reach its place.
    whole = Window.partitionBy("row", "template")
    before = F.lag("at").over(Window.partitionBy("row", "template", "is_band", "value").orderBy("at"))
    held = found.withColumn("before", before).withColumn("retrieved", F.max("is_band").over(whole))
    held = held.where("retrieved AND NOT is_band")
    first = F.greatest(F.col("before") + 1, F.col("at") - F.col("size") + 1, F.lit(0))
    last = F.least(F.col("at"), F.greatest(F.col("count") - F.col("size"), F.lit(0)))
    runs = held.withColumns({"first": first, "last": last}).where("first <= last")
    if not short_texts:
        runs = runs.where("count >= size")
    ends = F.array(
        F.struct(F.col("first").alias("word"), F.lit(1).alias("more")),
        F.struct((F.col("last") + 1).alias("word"), F.lit(-1).alias("more")),
    )
    steps = runs.select("row", "id", "template", "size", F.inline(ends))
    # All changes at one start are summed together, since rows equal in the order are in one range.
    n = F.sum("more").over(whole.orderBy("word").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    counted = steps.withColumn("n", n)
    best = counted.groupBy("row", "id", "template", "size").agg(F.max(F.struct("n", (-F.col("word")).alias("at"))).alias("best"))
    best = best.where(F.col("best.n") * 100 >= F.col("size") * percent)
    return best.select(
        F.col("id").alias(id_column),
        "template",
        F.col("size").cast("bigint").alias("n_shingles"),
        F.col("best.n").cast("bigint").alias("n_found"),
        (-F.col("best.at")).cast("bigint").alias("word"),
    )
