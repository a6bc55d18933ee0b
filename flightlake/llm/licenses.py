"""License scan by diagonal voting, in DataFrame operations.

All rolling word k-gram hashes of a text are joined with the template positions of the same hash (the words of a hit
are compared at once, so a hit is exact). A hit at text word p and template word t votes for the diagonal p - t: where a
template stands in the text, its hits share one diagonal, and words put in or left out move the rest to a neighbouring one.
Votes are collected per diagonal, diagonals at most ``slack`` apart are merged to a span, and a span is verified by
the share of the template's words that its hits cover, key words of near-equal templates among them.

The templates are a parameter of bounded size and are broadcast; texts are never shuffled. What is shuffled is one row per
text and diagonal, combined in the scan's tasks first, so a line that stands in every document costs a row for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from flightlake.session import materialize

# What separates words, once A-Z are lower-case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Template positions that may be broadcast; with more the join is shuffled.
MAX_POSITIONS = 100_000
# Words of a text whose grams are laid out at once.
BLOCK_WORDS = 1_024
# Share of a template's words a span must cover, of the larger of the template's and the span's length.
SIMILARITY = 0.8


@dataclass(frozen=True)
class Template:
    """Words of a license; ``base`` ones are phrases that count wherever they stand word for word.

    ``key`` holds the words that tell the template from one with nearly the same text: one hit of a span must hold them all.
    """

    label: str
    text: str
    base: bool = False
    key: str = ""

    @property
    def words(self) -> list[str]:
        """As in the texts (templates are ASCII)."""
        return "".join(c if c.isalnum() else " " for c in self.text.lower()).split()

    @property
    def key_range(self) -> tuple[int, int] | tuple[None, None]:
        """First template position of the key's words and the position behind them."""
        own, key = self.words, Template("", self.key).words
        first = next((i for i in range(len(own)) if key and own[i:i + len(key)] == key), None)
        return (None, None) if first is None else (first, first + len(key))

    @property
    def k(self) -> int:
        return 4 if len(self.words) >= 12 else 2

    @property
    def slack(self) -> int:
        """Distance of diagonals that are merged: none for phrases, which stand word for word or not at all."""
        return 8 if self.k == 4 else 0

    @property
    def share(self) -> float:
        return SIMILARITY if self.k == 4 else 1.0


# The phrases of the base labels, then names and notices of public licenses.
TEMPLATES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("gpl-2.0", "GNU General Public License, version 2"),
    Template("gpl-3.0", "GNU General Public License, version 3"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("apache-2.0", "Apache License, Version 2.0"),
    Template("cc-by-4.0", "CC BY 4.0"),
    Template("cc-by-sa", "CC BY-SA"),
    Template("cc-by-nc", "CC BY-NC"),
    Template("cc-by-nd", "CC BY-ND"),
    Template("cc0", "CC0 1.0"),
    Template("cc-by", "Creative Commons Attribution"),
    Template("mpl-2.0", "Mozilla Public License, version 2.0"),
    Template("bsd", "BSD License"),
    Template("isc", "ISC License"),
    Template("epl", "Eclipse Public License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
             "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
             "whom the Software is furnished to do so"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
             "http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation", key="GNU General"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation", key="GNU Lesser"),
    Template("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation", key="GNU Affero"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
             "not distributed with this file, You can obtain one at"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
             "publish, use, compile, sell, or distribute this software"),
)


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, all other code points beyond ASCII as they are."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def template_rows(templates: Sequence[Template]) -> list[tuple[int, int, str]]:
    """``template, t, gram`` of every position of every template."""
    out = []
    for number, template in enumerate(templates):
        own, k = template.words, template.k
        if len(own) < k:
            raise ValueError(f"a template needs two words or more: {template.text!r}")
        out += [(number, t, " ".join(own[t:t + k])) for t in range(len(own) - k + 1)]
    return out


def diagonals(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Votes, written: ``id, text_hash, n_words, template, diagonal, at`` (the template positions hit) and ``votes``.

    A text's words are cut into blocks that overlap by a gram, and only a block's grams are laid out at once. The
    hash and the words of a gram are the join's keys. Each text has one gram without words, the hit of template -1, so that every
    row of ``docs`` is found and rows with equal id and text are counted.
    """
    rows = template_rows(templates) + [(-1, 0, "")]
    table = docs.sparkSession.createDataFrame(rows, "template int, t int, gram string").withColumn("h", F.xxhash64("gram"))
    table = F.broadcast(table) if len(rows) <= MAX_POSITIONS else table
    lengths = sorted({template.k for template in templates})

    texts = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))
             .select("id", F.sha2("txt", 256).alias("text_hash"), words(F.col("txt")).alias("tokens"))
             .withColumn("n_words", F.size("tokens")))
    last = F.floor(F.greatest(F.col("n_words") - 1, F.lit(0)) / BLOCK_WORDS).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(
        F.col("tokens"), b * BLOCK_WORDS + 1, BLOCK_WORDS + lengths[-1] - 1))
    opened = texts.select("id", "text_hash", "n_words", F.posexplode(blocks).alias("block", "tokens"))

    def grams(k: int) -> Column:
        n = F.least(F.lit(BLOCK_WORDS), F.size("tokens") - (k - 1))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            i.alias("i"), F.concat_ws(" ", *[F.get(F.col("tokens"), i + j) for j in range(k)]).alias("gram")))).otherwise(none)

    none = F.array().cast("array<struct<i:int,gram:string>>")
    end = F.when(F.col("block") == 0, F.array(F.struct(F.lit(0).alias("i"), F.lit("").alias("gram")))).otherwise(none)
    opened = opened.select("id", "text_hash", "n_words", "block", F.inline(F.concat(*[grams(k) for k in lengths], end)))
    opened = opened.select("id", "text_hash", "n_words", (F.col("block") * BLOCK_WORDS + F.col("i")).alias("p"),
                           F.xxhash64("gram").alias("h"), "gram")
    hits = opened.join(table, ["h", "gram"])
    return materialize(hits.groupBy("id", "text_hash", "n_words", "template", (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("at"), F.count(F.lit(1)).alias("votes")), "license-votes")


def verified_spans(votes: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Spans of ``diagonals``: ``id, text_hash, template, label, base, first_word, span_words, covered, similarity``.

    ``similarity`` is the share of words covered, of the larger of the template's and the span's length.
    """
    spark = votes.sparkSession
    rows = [(i, t.label, t.base, t.k, t.slack, t.share, len(t.words), *t.key_range) for i, t in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, label string, base boolean, k int, slack int, share double, size int, key_first int, key_end int")
    found = votes.where("template >= 0").join(F.broadcast(table) if len(rows) <= MAX_POSITIONS else table, "template")
    own = Window.partitionBy("id", "text_hash", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(own)
    grouped = (found.withColumn("new", F.when(gap.isNull() | (gap > F.col("slack")), 1).otherwise(0))
               .withColumn("span", F.sum("new").over(own)))
    merged = grouped.groupBy("id", "text_hash", "template", "span", "label", "base", "k", "share", "size", "key_first", "key_end").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("first_word"),
        (F.max(F.col("diagonal") + F.array_max("at")) + F.col("k")).alias("end"))
    places = F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + F.col("k") - 1))))
    key_hit = F.exists("at", lambda t: (t <= F.col("key_first")) & (t + F.col("k") >= F.col("key_end")))
    return (merged.where(F.col("key_first").isNull() | key_hit).withColumn("covered", F.size(places)).withColumn("span_words", F.col("end") - F.col("first_word"))
            .withColumn("similarity", F.col("covered") / F.greatest("size", "span_words"))
            .where(F.col("similarity") >= F.col("share"))
            .select("id", "text_hash", "template", "label", "base", "first_word", "span_words", "covered", "similarity"))


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per place of a license: id, ``text_hash`` (SHA-256), template number, label, words and similarity.

    Rows of ``docs`` with equal id and text give one row per place. Nulls, empty texts and tables as in ``scan``.
    """
    return verified_spans(diagonals(docs, templates, id_col, text_col), templates).withColumnRenamed("id", id_col)


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    The score is the largest similarity of a verified span, 0 without one. Null, empty and word-less texts have no words
    and no labels (empty strings). Null ids are ids like any other, repeated rows give a row each, and an empty table
    gives no rows. Other columns are not read.
    """
    votes = diagonals(docs, templates, id_col, text_col)
    ends = votes.where("template < 0").select("id", "text_hash", "n_words", F.col("votes").alias("copies"), *[
        F.lit(None).cast(kind).alias(c) for c, kind in (("label", "string"), ("base", "boolean"), ("first_word", "int"), ("similarity", "double"))])
    spans = verified_spans(votes, templates).select("id", "text_hash", F.lit(None).cast("int").alias("n_words"), F.lit(None).cast(
        "long").alias("copies"), "label", "base", "first_word", "similarity")
    start = F.when(F.col("base"), F.col("first_word"))

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    return (ends.unionByName(spans).groupBy("id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"), F.max("copies").alias("copies"),
        F.count_if(F.col("base")).alias("n_base"), F.min(start).cast("long").alias("first_word"), F.max(start).cast("long").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("similarity"), F.lit(0.0)).alias("score"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
