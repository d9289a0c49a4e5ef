"""License texts found in blocks of words, by an exact set-similarity join with templates.

A block is a window of words twice as long as a template can be, begun at every half of it, so that any
run of words of a template's length lies whole in one block. Template and block are sets of words; a
block holds a template if it has at least a given share of the template's words. Words are ordered by
their frequency in the corpus, rare ones first. A block that holds ``need`` of a template's ``size``
words has one of its first ``size - need + 1`` words (prefix filter), has ``need`` of all template words
(length filter), and at the first word they share, both have ``need`` words from there on (positional
filter). What passes is compared in full, so nothing is lost. Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, read, with_small
from corpuslens.llm.registry import query

#: Label and words that stand consecutively.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# Fixed values.
#: Label and wording of public license notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "licensed under a Creative Commons Attribution License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike License"),
    ("cc-by-sa", "Licensed under CC BY-SA"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial License"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)

#: Share of a template's distinct words that a block must hold, as a fraction.
SHARE = (9, 10)
#: Words that the shortest blocks advance by.
LEAST_STEP = 8

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> list[str]:
    if not text.isascii():
        raise ValueError("phrases and templates are of ASCII words")
    return re.findall("[0-9a-z]+", text.lower())


class _Template:
    def __init__(self, number: int, label: str, text: str, share: tuple[int, int]):
        words = _words(text)
        if not words:
            raise ValueError("a template needs words")
        self.number, self.label, self.words = number, label, sorted(set(words))
        self.need = max(1, -(-len(self.words) * share[0] // share[1]))
        self.step = LEAST_STEP
        while self.step < len(words):
            self.step *= 2

    def ordered(self, rank: dict[str, int]) -> list[int]:
        return sorted(rank[w] for w in self.words)


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other capitals may be lowered too, but none becomes an ASCII letter."""
    kelvin = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138"))  # the lower case of the first is an ASCII k
    even = F.regexp_replace(kelvin, r"[\x00-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", " ")
    return F.array_remove(F.split(F.lower(even), " "), "")


def _places(words: Column, phrase: Sequence[str]) -> Column:
    """Where the phrase begins, in words from 0."""
    here = lambda i: reduce(and_, [F.get(words, i + k) == w for k, w in enumerate(phrase)])
    last = F.size(words) - len(phrase)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def _base(df: DataFrame, phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """``n_words, n_base, first_word, last_word, base_labels`` from the array ``__words``."""
    words = F.col("__words")
    split = [(label, _words(text)) for label, text in phrases]
    if not all(w for _, w in split):
        raise ValueError("a phrase needs words")
    empty = F.array().cast("array<int>")
    # places are sought only in texts that hold all words of the phrase
    found = [F.when(reduce(and_, [F.array_contains(words, w) for w in set(phrase)]), _places(words, phrase)).otherwise(empty) for _, phrase in split]
    df = df.withColumns({f"__p{i}": c for i, c in enumerate(found)})
    places = F.concat(*[F.col(f"__p{i}") for i in range(len(split))]) if split else empty
    labels = [F.when(F.size(f"__p{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(split)]
    df = df.withColumns({"__at": places, "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))) if labels else F.array().cast("array<string>")})
    return df.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "n_base": F.size("__at").cast("long"),
            "first_word": F.array_min("__at").cast("long"),
            "last_word": F.array_max("__at").cast("long"),
        }
    ).drop("__at", *[f"__p{i}" for i in range(len(split))])


def word_ranks(docs: DataFrame, templates: Sequence[_Template]) -> dict[str, int]:
    """Place of every template word in the order of frequency over all documents; equal ones by the word.

    Comes to the driver: as many values as the templates have words.
    """
    known = sorted({w for t in templates for w in t.words})
    if not known:
        return {}
    # the words are used twice, so that they are made once
    words = docs.select(words_of(F.col("text")).alias("w"))
    hits = words.select(F.explode(F.when(F.size("w") > 0, F.filter("w", lambda w: w.isin(known)))).alias("word"))
    count = {r["word"]: r["count"] for r in hits.groupBy("word").count().collect()}
    return {w: i for i, w in enumerate(sorted(known, key=lambda w: (count.get(w, 0), w)))}


def _prefix_words(templates: Sequence[_Template], ranks: dict[str, int]) -> list[str]:
    """The words of which a block must have one: of each template, the rarest ``size - need + 1``."""
    return sorted({w for t in templates for w in sorted(t.words, key=ranks.get)[: len(t.words) - t.need + 1]})


def _blocks(words: Column, rare_at: Column, templates: Sequence[_Template], ranks: dict[str, int], step: int) -> Column:
    """The blocks of one width that pass a prefix and a length filter of its templates: ``step, start, words``.

    ``rare_at`` are the places of prefix words; blocks without one are not made.
    """
    known = sorted({w for t in templates for w in t.words})
    rare, least = _prefix_words(templates, ranks), min(t.need for t in templates)
    last = F.greatest(F.ceil(F.size(words) / F.lit(step)).cast("int") - 2, F.lit(0))
    place = lambda i: F.floor(i / F.lit(step)).cast("int")
    numbers = F.array_distinct(F.concat(F.transform(rare_at, lambda i: F.greatest(place(i) - 1, F.lit(0))), F.transform(rare_at, lambda i: F.least(place(i), last))))
    inside = lambda b: F.array_distinct(F.filter(F.slice(words, b * step + 1, F.lit(2 * step)), lambda w: w.isin(known)))
    blocks = F.transform(numbers, lambda b: F.struct(F.lit(step).alias("step"), (b * step).alias("start"), inside(b).alias("words")))
    return F.filter(blocks, lambda x: (F.size(x["words"]) >= least) & F.exists(x["words"], lambda w: w.isin(rare)))


def _template_table(spark: SparkSession, templates: Sequence[_Template], ranks: dict[str, int]) -> DataFrame:
    """One row per template and word of its prefix; part of the plan, its size is that of the templates."""
    rows = [
        F.struct(
            F.lit(t.step).alias("step"), F.lit(t.number).alias("template"), F.lit(t.label).alias("label"), F.lit(t.need).alias("need"),
            F.array(*[F.lit(r) for r in t.ordered(ranks)]).alias("of"), F.lit(i).alias("place"), F.lit(r).alias("rank"),
        )
        for t in templates
        for i, r in enumerate(t.ordered(ranks)[: len(t.words) - t.need + 1])
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def matched_blocks(blocks: DataFrame, templates: Sequence[_Template], ranks: dict[str, int]) -> DataFrame:
    """``uid, template, label, start, width, containment`` of every block that holds a template.

    ``blocks (uid, step, start, words)`` are sets of template words. A block and a template meet once, at
    the first word they share.
    """
    order = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    sets = blocks.withColumn("has", F.array_sort(F.transform("words", lambda w: F.element_at(order, w)))).drop("words")
    table = _template_table(blocks.sparkSession, templates, ranks)
    at = sets.select("*", F.posexplode("has").alias("at", "rank"))
    left = F.least(F.size("has") - F.col("at"), F.size("of") - F.col("place"))
    pairs = at.join(F.broadcast(table), ["step", "rank"]).filter(left >= F.col("need"))
    shared = pairs.withColumn("shared", F.array_intersect("has", "of")).filter(F.array_min("shared") == F.col("rank"))
    held = shared.filter(F.size("shared") >= F.col("need"))
    return held.select("uid", "template", "label", "start", (F.col("step") * 2).alias("width"), (F.size("shared") / F.size("of")).alias("containment"))


def scan_licenses(
    docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, share: tuple[int, int] = SHARE
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks``.

    Words are ``WORD`` with A-Z in lower case, over the whole text. ``n_base`` counts the places where a
    phrase's words stand consecutively, all phrases together, ``first_word`` and ``last_word`` are the
    first and last of their starts (null without any) and ``base_labels`` their labels. ``blocks`` are
    the blocks that hold a template, as ``template`` (its number), ``label, start`` (first word), ``width``
    and ``containment`` (share of the template's distinct words in the block); ``score`` is the highest
    containment, 0 without a block, and ``labels`` joins the base labels and those of the blocks. Label
    columns are sorted arrays without repeats. A null text counts as empty: no words, no labels, score 0.
    Rows that share an id, or have none, are judged each by its own text; equal rows get equal results.
    Other columns are not read.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "licenses")
    made = [_Template(i, label, text, share) for i, (label, text) in enumerate(templates)]
    texts = docs.select("doc_id", "text")
    ranks = word_ranks(texts, made)
    df = _base(texts.select("doc_id", words_of(F.col("text")).alias("__words")), phrases)
    kind = "array<struct<step:int,start:int,words:array<string>>>"
    found = F.array().cast(kind)
    if made:
        rare = _prefix_words(made, ranks)
        df = df.withColumn("__rare", F.array_compact(F.transform("__words", lambda w, i: F.when(w.isin(rare), i))))
        sets = [_blocks(F.col("__words"), F.col("__rare"), [t for t in made if t.step == s], ranks, s) for s in sorted({t.step for t in made})]
        found = F.when(F.size("__rare") > 0, F.concat(*sets)).otherwise(F.array()).cast(kind)
    base = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    # the ids are written with the rows, so they stay what they are
    kept = scratch.keep(df.select(*base, found.alias("found")).withColumn("uid", F.monotonically_increasing_id()))
    if not made:
        return kept.select(*base, F.col("base_labels").alias("labels"), F.lit(0.0).alias("score"), F.array().cast("array<struct<template:int,label:string,start:int,width:int,containment:double>>").alias("blocks"))
    blocks = kept.select("uid", F.explode("found").alias("b")).select("uid", "b.*")
    matches = matched_blocks(blocks, made, ranks)
    row = F.struct("template", "label", "start", "width", "containment")
    by_doc = matches.groupBy("uid").agg(F.array_sort(F.collect_list(row)).alias("blocks"))
    df = with_small(kept.drop("found"), scratch.keep(by_doc), ["uid"])
    df = df.withColumn("blocks", F.coalesce("blocks", F.array().cast(by_doc.schema["blocks"].dataType)))
    labels = F.array_sort(F.array_union("base_labels", F.transform("blocks", lambda b: b["label"])))
    score = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    return df.select(*base, labels.alias("labels"), score.alias("score"), "blocks")


def _sql() -> str:
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    made = [_Template(i, label, text, SHARE) for i, (label, text) in enumerate(TEMPLATES)]
    phrases = [(label, _words(text)) for label, text in PHRASES]
    values = ", ".join(f"({t.step}, '{t.label}', {t.need}, {quoted(t.words)})" for t in made)
    known = quoted(sorted({w for t in made for w in t.words}))
    place = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, i FROM spot WHERE " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words)) for label, words in phrases
    )
    return rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), spot AS (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM doc
), place AS ({place}
), base AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi FROM place GROUP BY doc_id
), template(step, label, need, words) AS (VALUES {values}
), block AS (
  SELECT doc_id, step, unnest([list_filter(list_distinct(w[b * step + 1 : b * step + 2 * step]), lambda x: list_contains({known}, x))
    for b in range(0, greatest(ceil(len(w) / step)::BIGINT - 1, 1))]) AS has
  FROM doc, (SELECT DISTINCT step FROM template)
), held AS (
  SELECT doc_id, label, len(list_intersect(has, words)) / len(words) AS containment
  FROM block b JOIN template t ON b.step = t.step AND len(has) >= need AND len(list_intersect(has, words)) >= need
), label AS (
  SELECT doc_id, label, true AS base FROM place UNION SELECT doc_id, label, false FROM held
), labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels
  FROM label GROUP BY doc_id
), score AS (SELECT doc_id, max(containment) AS score FROM held GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN score USING (doc_id)
"""


@query(_sql())
def op13_license_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(joined).drop("blocks")
