"""Operator 1, license scans: diagonal voting, in DataFrame functions only.

Every text is lower-cased and split into words, and every rolling word 2-gram is hashed and
joined to the 2-grams of the license templates (a fixed, small table).  A match votes for the
diagonal ``position in the text - position in the template``.  Votes are verified word by
word and counted per (text, template, diagonal); neighbouring diagonals, where words were
left out or added, are merged; a template is found where enough of its 2-grams voted within a
span of about its length.

A *base* phrase is found where all its 2-grams vote for one diagonal, which is then the place
of its first word.  Longer templates add labels of their own.  Their 2-grams of two common
words do not vote, because every text is full of them.

One scan finds all votes: each text ends with one more 2-gram that a sentinel row of the template
table answers, so texts without a license keep a row, and the templates are broadcast (their
number is fixed).  Only matches and sentinels are shuffled.

Defined results: null and empty texts have no words, no places and score 0; null doc_ids
keep their row; repeated rows are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickpath.storage import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed phrases of the contract and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Public notices and their labels.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication"),
)
COMMON = frozenset("a an and any are as at be by can for from in is it its may not of on or other that the this to use was with you 0 1 2 3 4 v".split())
#: Share of a template's 2-grams that must vote, words that neighbouring diagonals may differ by.
LEAST_SHARE, SLACK = 0.75, 2
_SENTINEL = " "
#: A-Z alone are folded, whatever the script.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def template_rows() -> list[tuple[int, str, bool, int, int, int, str, str]]:
    """(template, label, is base, words, voting 2-grams, place, first word, second word) of every voting 2-gram."""
    rows = [(0, "", False, 0, 0, 0, _SENTINEL, "")]
    known = [(label, phrase, True) for phrase, label in BASE.items()] + [(label, text, False) for label, text in TEMPLATES]
    for number, (label, text, base) in enumerate(known, 1):
        words = _words(text)
        grams = [(k, a, b) for k, (a, b) in enumerate(zip(words, words[1:], strict=False)) if base or not {a, b} <= COMMON]
        rows += [(number, label, base, len(words), len(grams), k, a, b) for k, a, b in grams]
    return rows


def _templates(spark: SparkSession) -> DataFrame:
    schema = "template int, label string, base boolean, t_words int, t_grams int, place int, t_first string, t_second string"
    return spark.createDataFrame(template_rows(), schema).withColumn("gram", F.xxhash64("t_first", "t_second"))


def matches(docs: DataFrame) -> DataFrame:
    """Matched 2-grams: (row, doc_id, at, template columns, verified), and a sentinel for every text."""
    folded = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    words = F.regexp_extract_all(folded, F.lit(f"({WORD})"), F.lit(1))
    ended = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.array_append(words, F.lit(_SENTINEL)).alias("words"))
    pairs = F.arrays_zip(F.col("words").alias("first"), F.expr("slice(words, 2, size(words))").alias("second"))
    grams = ended.select("row", "doc_id", F.posexplode(pairs).alias("at", "pair")).select("row", "doc_id", "at", F.col("pair.first").alias("first"), F.coalesce("pair.second", F.lit("")).alias("second"))
    met = grams.withColumn("gram", F.xxhash64("first", "second")).join(F.broadcast(_templates(docs.sparkSession)), "gram")
    return met.withColumn("verified", (F.col("first") == F.col("t_first")) & (F.col("second") == F.col("t_second")))


def diagonals(docs: DataFrame) -> DataFrame:
    """Verified votes per (row, template, diagonal); template 0 carries the number of words."""
    own = ("row", "doc_id", "template", "label", "base", "t_words", "t_grams")
    return (matches(docs).groupBy(*own, F.when(F.col("template") > 0, F.col("at") - F.col("place")).alias("diagonal"))
            .agg(F.count_if("verified").alias("votes"), F.min("at").alias("first_at"), F.max("at").alias("last_at")))


def spans(found: DataFrame) -> DataFrame:
    """Template spans of the diagonals: (row, ..., start, end, share); base phrases, then merged neighbours."""
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    exact = found.filter(F.col("base") & (F.col("votes") == F.col("t_grams")))
    exact = exact.select("row", "doc_id", "label", "base", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("t_words")).alias("end"), F.lit(1.0).alias("share"))
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > SLACK, F.lit(False))
    loose = found.filter(~F.col("base") & (F.col("template") > 0) & (F.col("votes") > 0)).withColumn("far", far.cast("int"))
    merged = (loose.withColumn("band", F.sum("far").over(by)).groupBy("row", "doc_id", "template", "label", "base", "t_words", "t_grams", "band")
              .agg(F.sum("votes").alias("votes"), F.min("first_at").alias("start"), (F.max("last_at") + 2).alias("end")))
    share = F.least(F.lit(1.0), F.col("votes") / F.col("t_grams"))
    near = (F.col("end") - F.col("start") <= F.col("t_words") + SLACK * 2) & (share >= LEAST_SHARE)
    return exact.unionAll(merged.filter(near).select("row", "doc_id", "label", "base", "start", "end", share.alias("share")))


def _joined_labels(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(labels)), ",")


def licenses(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for every row."""
    found = stored(diagonals(docs), "license-diagonals")       # matches and one row per text; read three times
    texts = found.filter("template = 0").select("row", "doc_id", F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"), F.lit(None).cast("int").alias("start"),
                                                F.lit(None).cast("int").alias("end"), F.lit(0.0).alias("share"), F.col("last_at").alias("n_words"))
    rows = texts.unionAll(spans(found).withColumn("n_words", F.lit(None).cast("int")))
    place = F.when(F.col("base"), F.col("start"))
    return (rows.groupBy("row", "doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count(place).alias("n_base"), F.min(place).cast("long").alias("first_word"), F.max(place).cast("long").alias("last_word"),
        _joined_labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"), _joined_labels(F.col("label")).alias("labels"), F.max("share").alias("score"))
        .drop("row"))
