"""License scan: exact set-similarity join of text blocks and templates.

The blocks of a template are the runs of consecutive words of a whole text,
twice as many as the template has, that start at each word (for templates of 64
words or more at each ``run / 64``-th word, so that a notice of the template's
length still lies whole in a block), wrapped over lines or not. A block meets the
template when it holds at least ``threshold`` of its distinct words, all of its
``must`` words and none of its ``without`` words; a template of fewer than
``SHORT`` words must be there whole, since one word tells short notices apart.

One pass over the texts cuts each into words and keeps the number of words, the
distinct template words it holds and, only where these suffice for a template or
a phrase, the text. The join runs on these few rows and is exact:

* the template words are put in the order of how many documents hold them,
  rarest first (words that no template has can't add to an overlap);
* prefix filter: with ``least`` common words demanded, the first common word
  lies in the first ``|T| - least + 1`` words of the template and in the first
  ``|D| - least + 1`` of the document's set, so they join on those; a pair is
  kept at its first common word only and meets once;
* length filter: ``|D| >= least``;
* positional filter: the words after the joined one must suffice on both sides.

A document that passes as a set is verified block by block, around the places
of a ``must`` word. Everything is DataFrame expressions; no Python runs on the
executors. The templates are a parameter of a bounded size, the only data that
is broadcast.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import stage, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
SHORT = 10
MOST_TEMPLATE_WORDS = 20_000

# fixed values: phrase of consecutive words, label
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# (label, notice, words that tell it from others, words of other licenses): the
# usual wording of license notices; full texts may be given the same way
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache"], []),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', ["apache"], []),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
     ["redistribution", "binary", "forms"], []),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative", "commons", "attribution"],
     ["sharealike", "noncommercial", "noderivatives", "noderivs"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["nc", "cc", "by"], ["sa", "nd"]),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ["noncommercial", "creative", "commons", "attribution"],
     ["sharealike", "noderivatives", "noderivs"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["sa", "cc", "by"], ["nc"]),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["sharealike", "creative", "commons", "attribution"],
     ["noncommercial"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["gnu", "general", "public"], ["lesser", "library", "affero"]),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
     ["gnu", "general", "public"], ["lesser", "library", "affero"]),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ["lesser", "gnu", "general", "public"], ["affero"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ["fee", "permission", "granted"], []),
    ("mit", "Released under the MIT License", ["mit"], []),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
     ["charge", "obtaining", "permission"], []),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla"], []),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """Text whose ASCII words are those of ``text`` with A-Z in lower case: the
    only other character with an ASCII lower case, the Kelvin sign, is another
    letter first. (Word borders stay; non-ASCII letters may change.)"""
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u00e5")))


def words_of(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def all_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def template_words(text: str) -> list[str]:
    """Distinct words in the order they stand."""
    return list(dict.fromkeys(all_words(text)))


class Template:
    """A template and what its blocks must hold."""

    def __init__(self, label: str, text: str, must=(), without=(), threshold: float = THRESHOLD):
        self.label, self.words, self.must, self.without = label, template_words(text), list(must), list(without)
        n = len(self.words)
        self.least = n if n < SHORT else math.ceil(threshold * n - 1e-9)
        self.run = 2 * len(all_words(text))
        self.stride = max(1, self.run // 64)


def parsed(templates, threshold: float = THRESHOLD) -> list[Template]:
    """Templates given as (label, text[, must[, without]]); those without a word meet nothing."""
    out = [Template(*t, threshold=threshold) for t in templates]
    if sum(len(t.words) + len(t.without) for t in out) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words are not broadcast")
    return [t for t in out if t.words]


def _array(words) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def _holds(own: str, words) -> Column:
    cond = F.lit(True)
    for w in words:
        cond = cond & F.array_contains(own, w)
    return cond


def word_sets(docs: DataFrame, templates: list[Template], phrases=PHRASES) -> DataFrame:
    """The pass over all texts: doc_id, text_key, n_words, own (template and
    phrase words) and text, null unless the words suffice for a template or a
    phrase."""
    vocabulary = sorted({w for t in templates for w in t.words + t.must} | {w for p, _ in phrases for w in p.split()})
    cut = docs.select("doc_id", "text_key", "text", words_of(lowered(F.col("text"))).alias("w"))
    sets = cut.select("doc_id", "text_key", "text", F.size("w").cast("long").alias("n_words"), F.array_intersect(_array(vocabulary), "w").alias("own"))
    maybe = F.lit(False)
    for t in templates:
        maybe = maybe | (_holds("own", t.must) & (F.size("own") >= t.least) & (F.size(F.array_intersect("own", _array(t.words))) >= t.least))
    for p, _ in phrases:
        maybe = maybe | _holds("own", p.split())
    return sets.select("doc_id", "text_key", "n_words", "own", F.when(maybe, F.col("text")).alias("text"))


def base_places(words: Column, phrases=PHRASES) -> Column:
    """Array of (label, start) of every place where a phrase's words stand
    consecutively in an array of words."""
    n = F.greatest(F.size(words), F.lit(1))
    longest = max(len(p.split()) for p, _ in phrases)
    runs = F.arrays_zip(*[(words if k == 0 else F.slice(words, k + 1, n)).alias(f"w{k}") for k in range(longest)])

    def found(run: Column, i: Column) -> Column:
        def is_at(phrase):
            hit = F.lit(True)
            for k, word in enumerate(phrase.split()):
                hit = hit & F.coalesce(run[f"w{k}"] == word, F.lit(False))
            return hit
        return F.array(*[F.when(is_at(p), F.struct(F.lit(label).alias("label"), i.cast("long").alias("start"))) for p, label in phrases])

    return F.filter(F.flatten(F.transform(runs, found)), lambda x: x.isNotNull())


def similar_blocks(sets: DataFrame, templates: list[Template]) -> DataFrame:
    """(doc_id, text_key, template, label, containment): the largest containment
    of a document's blocks that meet a template, of rows of ``word_sets``."""
    spark = sets.sparkSession
    vocabulary = sorted({w for t in templates for w in t.words})
    count = {r["w"]: r["count"] for r in sets.select(F.explode("own").alias("w")).groupBy("w").count().collect()}
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index, facts = [], []
    for k, t in enumerate(templates):
        ordered = sorted(t.words, key=rank.get)
        index += [(w, k, i) for i, w in enumerate(ordered[:len(ordered) - t.least + 1])]
        facts.append((k, t.label, t.least, len(ordered), ordered, t.must, t.without, t.run, t.stride))
    index_df = spark.createDataFrame(index, "word string, template int, i int")
    facts_df = spark.createDataFrame(facts, "template int, label string, least int, size int, words array<string>, must array<string>, without array<string>, run int, stride int")

    # array_intersect keeps the order of its first argument: the global order
    own = sets.where("text is not null").select("doc_id", "text_key", "text", F.array_intersect(_array(order), "own").alias("own"))
    pairs = (own.select("*", F.size("own").alias("n"), F.posexplode("own").alias("j", "word"))
             .join(F.broadcast(index_df), "word").join(F.broadcast(facts_df), "template")
             .where("n >= least and j < n - least + 1 and 1 + least(size - i - 1, n - j - 1) >= least")
             .withColumn("common", F.array_intersect("own", "words"))
             .where("size(common) >= least and common[0] = word and size(array_except(must, own)) = 0"))
    w = words_of(lowered(F.col("text")))
    pairs = pairs.select("doc_id", "text_key", "template", "label", "least", "size", "words", "must", "without", "run", "stride", w.alias("w"))
    # a block holds the template's first must word, so it starts within a run before one
    anchored = F.filter(F.transform("w", lambda x, i: F.when(x == F.col("must")[0], i)), lambda i: i.isNotNull())
    near = F.array_distinct(F.flatten(F.transform(anchored, lambda p: F.sequence(F.greatest(p - F.col("run") + 1, F.lit(0)), p))))
    anywhere = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)))
    starts = F.filter(F.when(F.size("must") > 0, near).otherwise(anywhere), lambda i: i % F.col("stride") == 0)

    def common(i: Column) -> Column:
        block = F.slice("w", i + 1, F.col("run"))
        meets = (F.size(F.array_except("must", block)) == 0) & ~F.arrays_overlap("without", block)
        return F.when(meets, F.size(F.array_intersect("words", block))).otherwise(0)

    best = pairs.select("doc_id", "text_key", "template", "label", "least", "size", F.array_max(F.transform(starts, common)).alias("common"))
    return best.where("common >= least").select("doc_id", "text_key", "template", "label", (F.col("common") / F.col("size")).alias("containment"))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> DataFrame:
    """Labels of every document.

    Returns doc_id, n_words, n_base (places of base phrases), first_word and
    last_word (smallest and largest start of a place, else null), base_labels,
    labels (base phrases' and templates'), score (1 with a base phrase, else
    the largest containment that meets a template, else 0). A null text is
    empty: no words, no label. Rows with equal or null ids keep a row each,
    rows are told apart by id and text; other columns are ignored. An empty
    table gives no row.
    """
    templates = parsed(templates, threshold)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    sets = stage(word_sets(docs, templates, phrases), "license-sets")
    found = similar_blocks(sets, templates).groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    found = found.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "found", "best")
    none = F.array().cast("array<struct<label:string,start:bigint>>")
    may_hold = F.lit(False)
    for p, _ in phrases:
        may_hold = may_hold | _holds("own", p.split())
    base = sets.select("doc_id", "text_key", "n_words", F.when(may_hold, base_places(words_of(lowered(F.col("text"))), phrases)).otherwise(none).alias("places"))
    rows = base.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    own = F.array_distinct(F.col("places.label"))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(own).alias("base_labels"),
        joined(F.array_union(own, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    ls = lambda ws: f"CAST([{', '.join(map(q, ws))}] AS VARCHAR[])"
    rows = ", ".join(f"({i}, {q(t.label)}, {len(t.words)}, {t.least}, {ls(t.words)}, {ls(t.must)}, {ls(t.without)}, {t.run}, {t.stride})" for i, t in enumerate(parsed(TEMPLATES)))
    at = " UNION ALL ".join(
        f"SELECT doc_id, {q(label)} AS label, i - 1 AS start FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t) WHERE "
        + " AND ".join(f"w[i + {k}] = {q(x)}" for k, x in enumerate(phrase.split())) for phrase, label in PHRASES)
    word = WORD.replace("'", "''")
    return f"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}') AS w FROM documents),
base AS ({at}),
b AS (SELECT doc_id, count(*) AS n, min(start) AS lo, max(start) AS hi, list_sort(list(DISTINCT label)) AS ls FROM base GROUP BY doc_id),
tpl(id, label, size, least, words, must, without, run, stride) AS (VALUES {rows}),
may AS (SELECT t.*, tpl.* FROM t, tpl WHERE len(list_intersect(list_distinct(w), words)) >= least AND len(list_intersect(list_distinct(w), must)) = len(must)),
run AS (SELECT doc_id, label, size, least, words, must, without, list_distinct(list_slice(w, s + 1, s + run)) AS own
        FROM (SELECT *, unnest(range(0, len(w), stride)) AS s FROM may)),
hit AS (SELECT doc_id, label, len(list_intersect(own, words)) / size AS c FROM run
        WHERE len(list_intersect(own, words)) >= least AND len(list_intersect(own, must)) = len(must) AND NOT list_has_any(own, without)),
h AS (SELECT doc_id, list(DISTINCT label) AS ls, max(c) AS best FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word,
       CAST(hi AS BIGINT) AS last_word, coalesce(array_to_string(b.ls, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(h.ls, [])))), ','), '') AS labels,
       CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM t LEFT JOIN b USING (doc_id) LEFT JOIN h USING (doc_id)
"""


ORACLE_SQL = _oracle()
