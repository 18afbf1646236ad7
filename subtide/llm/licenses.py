"""License passages in documents, found by diagonal voting.

Templates are phrases and notices of known licenses. All rolling grams of a document's words are
hashed and joined with the hashed grams of the templates; a hit is a gram at word p of the document
and word t of the template, and votes for the diagonal p - t, the word at which the whole template
would start. Words in between that were added or left out move the rest of a passage to a neighbouring
diagonal, so the diagonals within ``SHIFT`` words of one are merged with it. A span is verified by its
words: a hit counts only if its words equal the template's, and a merged span only if the words that
were hit are at least ``share`` of the template's. A diagonal with a vote for every gram of the
template is a place where the whole template stands, word for word.

Grams have ``GRAM`` words, or the whole of a shorter template, so phrases of two words are found the same
way and long notices are not hit by every pair of common words. The templates are a parameter of fixed size;
their grams are measured before they are broadcast. The words of a document never leave its task: only
hits are shuffled, counted per text, template, place and diagonal, which reduces copies of a text
map-side to one. Texts are told apart by their MD5 digest, and results come back to the documents by a join on
it, which adaptive execution splits where one text is a third of all rows (the results are written first).

Defined cases: a NULL or empty text has no words and no labels. Equal texts get equal results, one row per
document row; NULL or repeated ids make no difference. A template without words is ignored; with no
templates nothing is found. An empty table gives no row. Extra columns are ignored by ``scan`` and
play no part in ``spans``. One text is split into words at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from subtide.operators.core import BROADCAST_BYTES, sized_broadcast
from subtide.sources import written

GRAM = 5
SHIFT = 4
SHARE = 0.8

# The phrases whose places are counted, and their labels.
BASE_PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Further phrases and the openings of well-known license notices.
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
               "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software"),
    ("mpl", "mozilla public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

TEMPLATE = "label string, text string, base boolean"

# What separates words: every ASCII character but digits and letters.
_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def known_licenses(spark: SparkSession) -> DataFrame:
    """The templates of this module: (label, text, base)."""
    rows = [(*r, True) for r in BASE_PHRASES] + [(*r, False) for r in NOTICES]
    return spark.createDataFrame(rows, TEMPLATE)


def license_words(text: str | Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, with A-Z in lower case."""
    plain = F.translate(F.coalesce(text, F.lit("")), _BREAKS + _UPPER, " " * len(_BREAKS) + _LOWER)
    return F.array_remove(F.split(plain, " "), "")


def _gram(words: str, place: str, size: str) -> Column:
    return F.array_join(F.slice(words, F.col(place) + 1, F.col(size)), " ")


def _exploded(named: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per rolling gram of the sizes: the columns of ``named`` and place, size, hash.

    Places are exploded and hashed in generated code, where ``words`` stays one array by reference.
    """

    def hashed(size: int) -> Column:
        words = [F.get("words", F.col("place") + j) for j in range(size)]
        whole = F.col("place") + size <= F.size("words")
        return F.struct(F.lit(size).alias("size"), F.when(whole, F.xxhash64(*words)).alias("hash"))

    # The outer form: for the other Spark filters by the size of the array first, and computes it twice.
    places = named.select("*", F.posexplode_outer("words").alias("place", "word")).drop("word")
    rows = places.withColumn("g", F.explode(F.array(*map(hashed, sizes))))
    return rows.select(*named.columns, "place", "g.size", "g.hash").filter("hash IS NOT NULL")


def _hits(docs: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of (key, template, diagonal, at): a gram of the text equals the template's at ``at``."""
    sizes = sorted(r[0] for r in named.select("gram_size").distinct().collect())
    texts = docs.select(_key("text").alias("key"), license_words("text").alias("words"))
    if not sizes:
        return texts.sparkSession.createDataFrame([], "key string, template long, diagonal int, at int")
    rows = _exploded(named, sizes).filter("size = gram_size")
    grams = written(rows.select("template", "hash", F.col("place").alias("at"), _gram("words", "place", "size").alias("gram")))
    weight = grams.agg(F.sum(F.octet_length("gram") + 32)).first()[0]
    found = _exploded(texts, sizes)
    if weight <= BROADCAST_BYTES:
        # Joined in the task that split the text, so a gram is only spelled out where its hash is found.
        # (Two inequalities, as an equality would become a part of the join's key, spelled out for every gram.)
        gram = _gram("words", "place", "size")
        met = found.join(F.broadcast(grams), "hash").filter((gram <= F.col("gram")) & (gram >= F.col("gram")))
    else:
        spelled = found.select("key", "place", "hash", _gram("words", "place", "size").alias("gram"))
        met = spelled.join(grams, ["hash", "gram"])
    return met.select("key", "template", (F.col("place") - F.col("at")).alias("diagonal"), "at")


def _key(text: str) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def spans(docs: DataFrame, templates: DataFrame, gram: int = GRAM, shift: int = SHIFT, share: float = SHARE) -> DataFrame:
    """Verified spans per text: (key, label, base, first, last, whole, share), ``key`` its MD5 digest.

    ``whole`` spans hold the template word for word; of merged ones the best of their neighbourhood is given.
    """
    words = license_words("text")
    named = templates.select("label", "base", words.alias("words")).distinct().filter(F.size("words") > 0)
    named = named.withColumn("gram_size", F.least(F.size("words"), F.lit(gram)))
    named = written(named.withColumn("template", F.xxhash64("label", "base", "words")))
    voted = _hits(docs, named).groupBy("key", "template", "diagonal").agg(F.collect_set("at").alias("ats"))
    sized = named.select("template", "label", "base", "gram_size", F.size("words").alias("n"))
    voted = voted.join(sized_broadcast(sized), "template")

    covered = F.flatten(F.transform("near", lambda at: F.sequence(at, at + F.col("gram_size") - 1)))
    place = W.partitionBy("key", "template").orderBy("diagonal").rangeBetween(-shift, shift)
    merged = (
        voted.withColumn("near", F.array_distinct(F.flatten(F.collect_list("ats").over(place))))
        .withColumn("covered", F.size(F.array_distinct(covered)))
        .withColumn("first", F.min(F.col("diagonal") + F.array_min("ats")).over(place))
        .withColumn("last", F.max(F.col("diagonal") + F.array_max("ats") + F.col("gram_size") - 1).over(place))
    )
    whole = F.size("ats") == F.col("n") - F.col("gram_size") + 1
    rank = F.struct((-F.col("covered")).alias("c"), F.col("diagonal").alias("d"))
    merged = (
        merged.withColumn("whole", whole)
        .withColumn("best", F.min(rank).over(place)["d"] == F.col("diagonal"))
        .withColumn("share", F.when(F.col("whole"), 1.0).otherwise(F.col("covered") / F.col("n")))
        .filter(F.col("whole") | (F.col("best") & (F.col("share") >= share)))
    )
    first = F.when(F.col("whole"), F.col("diagonal")).otherwise(F.col("first"))
    last = F.when(F.col("whole"), F.col("diagonal") + F.col("n") - 1).otherwise(F.col("last"))
    return merged.select(
        "key", "label", "base", first.cast("long").alias("first"), last.cast("long").alias("last"), "whole", "share"
    )


def scan(docs: DataFrame, templates: DataFrame, **options) -> DataFrame:
    """Rows of (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one per document.

    Places are those of whole base templates, counted in words from 0; ``score`` is the largest share of a
    template's words in a span, 0 without any. ``options`` are those of ``spans``.
    """
    place = F.col("base") & F.col("whole")

    def names(of: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(of)), ",")

    found = (
        spans(docs, templates, **options)
        .groupBy("key")
        .agg(
            F.count_if(place).alias("n_base"),
            F.min(F.when(place, F.col("first"))).alias("first_word"),
            F.max(F.when(place, F.col("first"))).alias("last_word"),
            names(F.when(place, F.col("label"))).alias("base_labels"),
            names(F.col("label")).alias("labels"),
            F.max("share").alias("score"),
        )
    )
    rows = docs.select("doc_id", _key("text").alias("key"), F.size(license_words("text")).cast("long").alias("n_words"))
    return rows.join(written(found), "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
