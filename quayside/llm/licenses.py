"""Licence texts in documents: phrases word by word, and template notices by an exact set-similarity join. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.plans.session import Scratch, hinted

# Anything but ASCII digits, lower-cased letters and non-ASCII characters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Share of a template's words that a text block must hold.
CONTAINMENT = 0.8

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label and notice, from the public texts of the licences.
TEMPLATES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related rights to the public domain worldwide"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "copyright all rights reserved no part of this publication may be reproduced without permission"),
]


def words_of(text: Column) -> Column:
    """The words of a lower-cased text, in order."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def _needed(size: int, containment: float) -> int:
    return math.ceil(round(containment * size, 9))


def window_words(text: str, containment: float) -> int:
    """Words of a text block for a template: as many as the template has, with room for others between them."""
    return math.ceil(round(len(text.split()) / containment, 9))


class Templates:
    """Template word sets in the global order: rarest in the corpus first, ties by the word."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[str, int], containment: float) -> None:
        self.order = sorted({w for _, text in templates for w in text.split()}, key=lambda w: (frequency.get(w, 0), w))
        rank = {w: i for i, w in enumerate(self.order)}
        self.sets = [sorted(set(text.split()), key=rank.get) for _, text in templates]
        self.needed = [_needed(len(s), containment) for s in self.sets]
        self.windows = [window_words(text, containment) for _, text in templates]
        # a block that shares `needed` words shares one of the first size - needed + 1
        self.postings = [(w, t, place, len(s), need) for t, (s, need) in enumerate(zip(self.sets, self.needed, strict=True)) for place, w in enumerate(s[: len(s) - need + 1])]


def _literals(items: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in items])


def _near(words: Column, at: Column, back: int, ahead: int) -> Column:
    """The words from ``back`` before place ``at`` to ``ahead`` after it, as far as the text goes; only these are read."""
    last = F.least(at + ahead, F.size(words) - 1)
    return F.transform(F.sequence(F.greatest(at - back, F.lit(0)), last), lambda i: F.get(words, i))


def notices(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT
) -> DataFrame:
    """``(id, h, block, label, containment)``: every text block that holds the share ``containment`` of a template's words.

    ``h`` is the hash of the text. A block is a window of ``window_words`` consecutive words, as many as the template has over
    ``containment`` (fewer at the end of a text), that starts with one of the template's words; ``block`` is the number of that word
    in the text. Line ends do not matter, so a wrapped notice counts, and words scattered over a long line do not.

    Words are in the global order of how many texts hold them, rarest first. Blocks meet templates over the words of the
    template's prefix: such words are looked up with what stands around them, whatever the length of the text. The length filter asks for
    enough template words in the block, the positional filter for enough after the shared one; the shared words are then
    counted exactly. A block counts once per template it meets.
    """
    templates = TEMPLATES if templates is None else templates
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    counted = rows.select(F.explode(F.array_intersect("words", _literals(vocabulary))).alias("word")).groupBy("word").count().collect()  # a row per template word
    known = Templates(templates, {r["word"]: r["count"] for r in counted}, containment)
    spark = docs.sparkSession

    prefixes = _literals(sorted({w for w, *_ in known.postings}))
    reach = max(known.windows)
    anchors = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(prefixes, w), i)), lambda i: i.isNotNull())
    met = F.transform(anchors, lambda i: F.struct(i.alias("at"), F.get("words", i).alias("word"), _near(F.col("words"), i, reach - 1, reach - 1).alias("near")))
    each = rows.where(F.arrays_overlap("words", prefixes)).select("id", "h", F.explode(met).alias("met")).select("id", "h", "met.*")

    postings = spark.createDataFrame(known.postings, "word string, template int, place int, size int, needed int")
    sets = spark.createDataFrame(
        [(t, label, window, own) for t, ((label, _), window, own) in enumerate(zip(templates, known.windows, known.sets, strict=True))], "template int, label string, window int, own array<string>"
    )
    # `first` is the number of the first word of `near`
    first = F.greatest(F.col("at") - (reach - 1), F.lit(0))
    pairs = each.withColumn("first", first).join(F.broadcast(postings.join(sets, "template")), "word").where(F.size(F.array_intersect("own", "near")) >= F.col("needed"))
    starts = F.sequence(F.greatest(F.col("at") - F.col("window") + 1, F.lit(0)), F.col("at"))
    starts = F.filter(starts, lambda j: F.array_contains("own", F.get("near", j - F.col("first"))))
    windows = pairs.select("*", F.explode(starts).alias("block"))
    # the block's words in the global order: words of the ordered vocabulary that it has
    inside = F.slice("near", F.col("block") - F.col("first") + 1, F.col("window"))
    windows = windows.withColumn("inside", F.array_intersect(_literals(known.order), inside))
    place = F.array_position("inside", F.col("word")) - 1
    after = F.least(F.col("size") - F.col("place"), F.size("inside") - place)
    hopeful = windows.where((F.size("inside") >= F.col("needed")) & (after >= F.col("needed")))
    verified = hopeful.withColumn("overlap", F.size(F.array_intersect("inside", "own"))).where(F.col("overlap") >= F.col("needed"))
    found = verified.select("id", "h", "block", "template", "label", (F.col("overlap") / F.col("size")).alias("containment"))
    return found.distinct().drop("template")


def _places(words: Column, phrase: list[str]) -> Column:
    """Where a phrase's words stand one after the other."""
    fits = lambda i: [F.get(words, i + k) == w for k, w in enumerate(phrase)]

    def here(_, i):
        test = None
        for one in fits(i):
            test = one if test is None else test & one
        return F.when(test, i)

    return F.filter(F.transform(words, here), lambda i: i.isNotNull())


def scan(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """``(<id_col>, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for every row of ``docs``.

    ``n_base`` counts the places of ``PHRASES`` with their first and last starting word; ``base_labels`` are theirs and
    ``labels`` also those of ``notices``, both sorted and joined by commas, empty for none. ``score`` is 1 with a phrase,
    else the largest containment of a notice, else 0. Null texts count as empty; repeated rows come out alike; a null id
    stays null. Other columns are ignored.
    """
    hits = notices(docs, scratch, id_col, text_col, None, containment).groupBy("id", "h").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    hits = scratch.keep(hits, "notices")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__h"), words_of(text).alias("words"), F.lower(text).alias("low"))
    # only texts that may hold a phrase are looked at word by word
    gap = SEPARATORS
    may = F.col("low").rlike("|".join(gap.join(p.split()) for p in PHRASES))
    none = F.array().cast("array<int>")
    places = [F.when(may, _places(F.col("words"), p.split())).otherwise(none) for p in PHRASES]
    rows = rows.select("__id", "__h", F.size("words").cast("long").alias("n_words"), *[p.alias(f"__p{k}") for k, p in enumerate(places)])
    columns = [F.col(f"__p{k}") for k in range(len(PHRASES))]
    every = F.concat(*columns)
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, label) for c, label in zip(columns, PHRASES.values(), strict=True)]))
    rows = rows.select("__id", "__h", "n_words", every.alias("__all"), base.alias("__base"))
    hits = hinted(hits, hits.count())
    joined = rows.join(hits, rows["__id"].eqNullSafe(hits["id"]) & (rows["__h"] == hits["h"]), "left")
    labels = F.array_union("__base", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        F.col("__id").alias(id_col), "n_words", F.size("__all").cast("long").alias("n_base"), F.array_min("__all").cast("long").alias("first_word"),
        F.array_max("__all").cast("long").alias("last_word"), F.array_join(F.array_sort(F.array_distinct("__base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"), F.when(F.size("__all") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
