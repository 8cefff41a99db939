"""License scans by an exact set-similarity join.

The words of a text are cut into blocks of 2 * stride words, a block every `stride`
words, so every run of at most `stride` words lies within one block. A template is a
set of words, and a block meets it if it holds at least `containment` of the set.
Block and template words are ordered by how many blocks hold them, rarest first.
A pair that meets shares its rarest common word within the first
n - least + 1 words of both (prefix filter); blocks with fewer words of any template
than the least template needs are left out (length filter); and what is left of both
sets behind the shared word must suffice (positional filter). Pairs that pass are
counted on whole sets. Templates of fixed phrases must be held whole, and their
block is then searched for places where the words stand one after another.

A result depends on the text alone. Null and empty texts, and texts without words,
have no places, no labels and score 0. Rows are scanned by themselves: rows that are
repeated, or that share an id, or have none, each give a row. Other columns than
doc_id and text aren't read. Only built-in expressions are used.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents

#: Words of the contract, in text whose A-Z are lowered; and the same by what they hold, which Java matches ten times as fast.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HELD, GAP = r"[0-9a-z\x80-\x{10FFFF}]+", r"[^0-9a-z\x80-\x{10FFFF}]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


@dataclass(frozen=True)
class Template:
    """phrase: its words must stand one after another; else a block must hold that share of its different words."""

    label: str
    text: str
    phrase: bool = False
    containment: float = 0.85

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(str.maketrans(UPPER, LOWER)))

    @property
    def least(self) -> int:
        n = len(set(self.words))
        return n if self.phrase else -(-n * round(100 * self.containment) // 100)


#: Phrases of the contract, and the opening words of public license notices.
TEMPLATES = (
    Template("mit", "under the mit license", phrase=True),
    Template("apache-2", "apache license version 2", phrase=True),
    Template("cc-by-nc", "cc by nc", phrase=True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl-3", "licensed under the GNU General Public License, version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher"),
)
#: Words of all templates at most: they and the templates are sent to all tasks.
MOST_WORDS = 20_000


@dataclass(frozen=True)
class LicenseScan:
    """stride: words from one block to the next; a template of more words makes it longer."""

    templates: tuple[Template, ...] = TEMPLATES
    stride: int = 48

    @property
    def step(self) -> int:
        return max([self.stride, *(len(t.words) for t in self.templates)])

    @property
    def vocabulary(self) -> list[str]:
        found = sorted({w for t in self.templates for w in t.words})
        if not 0 < len(found) <= MOST_WORDS or not all(t.words for t in self.templates):
            raise ValueError(f"templates must have words, and no more than {MOST_WORDS} different ones together")
        return found


def lowered(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def identity() -> list[Column]:
    """What tells rows of different results apart: the id and two numbers of the text."""
    text = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").alias("id"), F.xxhash64(text).alias("mark"), F.hash(text, F.lit(1)).alias("check")]


def word_blocks(docs: DataFrame, step: int) -> DataFrame:
    """id, mark, check, k, words: the words k * step to (k + 2) * step of each text."""
    chunk = f"{HELD}+(?:{GAP}+{HELD}+){{0,{step - 1}}}"  # no way back: one pass over the text
    chunks = F.regexp_extract_all(lowered(), F.lit(chunk), F.lit(0))
    cut = docs.select(*identity(), chunks.alias("chunks")).where(F.size("chunks") > 0)
    after = F.concat(F.slice("chunks", F.lit(2), F.size("chunks")), F.array(F.lit("")))
    pairs = cut.select("id", "mark", "check", F.posexplode(F.zip_with("chunks", after, lambda a, b: F.concat_ws(" ", a, b))).alias("k", "block"))
    return pairs.select("id", "mark", "check", "k", F.regexp_extract_all("block", F.lit(HELD), F.lit(0)).alias("words"))


def word_order(blocks: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words by how many blocks hold them, rarest first. As many rows as the templates have words come to the driver."""
    held = blocks.select(F.explode(F.array_intersect(F.lit(vocabulary), "words")).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def joined(blocks: DataFrame, order: list[str], settings: LicenseScan) -> DataFrame:
    """id, mark, check, k, words, template (its number) and share of each block and template that meet."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, template in enumerate(settings.templates):
        tokens = sorted(set(template.words), key=rank.get)
        rows += [(token, i, number, tokens, len(tokens), template.least) for i, token in enumerate(tokens[: len(tokens) - template.least + 1])]
    prefixes = blocks.sparkSession.createDataFrame(rows, "token string, i int, template int, tokens array<string>, n int, least int")
    fewest = min((t.least for t in settings.templates), default=1)
    ordered = blocks.withColumn("held", F.array_intersect(F.lit(order), "words")).withColumn("m", F.size("held")).where(F.col("m") >= fewest)
    firsts = ordered.select("*", F.posexplode(F.slice("held", F.lit(1), F.col("m") - (fewest - 1))).alias("j", "token"))
    near = firsts.join(F.broadcast(prefixes), "token").where(F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) >= F.col("least"))
    shared = F.array_intersect("tokens", "held")
    # of the shared words that a pair meets by, the rarest stands for it
    return near.withColumn("shared", shared).where((F.size("shared") >= F.col("least")) & (F.get("shared", F.lit(0)) == F.col("token"))).select("id", "mark", "check", "k", "words", "template", (F.size("shared") / F.col("n")).alias("share"))


def license_hits(docs: DataFrame, settings: LicenseScan = LicenseScan()) -> DataFrame:
    """id, mark, check, k, label, phrase, share, places of each block that meets a template; places: word numbers from 0, phrases only."""
    step = settings.step
    blocks = word_blocks(docs, step)
    met = joined(blocks, word_order(blocks, settings.vocabulary), settings)
    facts = F.lit([t.label for t in settings.templates]), F.lit([t.phrase for t in settings.templates])
    phrases = F.array(*[F.lit(t.words) for t in settings.templates])
    met = met.withColumn("label", F.get(facts[0], F.col("template"))).withColumn("phrase", F.get(facts[1], F.col("template"))).withColumn("sought", F.get(phrases, F.col("template")))
    starts = F.filter(F.sequence(F.lit(0), F.lit(step - 1)), lambda x: F.slice("words", x + 1, F.size("sought")) == F.col("sought"))
    places = F.when(F.col("phrase"), F.transform(starts, lambda x: F.col("k").cast("long") * step + x)).otherwise(F.array().cast("array<bigint>"))
    return met.withColumn("places", places).where(~F.col("phrase") | (F.size("places") > 0)).select("id", "mark", "check", "k", "label", "phrase", "share", "places")


def scan_licenses(docs: DataFrame, settings: LicenseScan = LicenseScan()) -> DataFrame:
    """A row for each of docs: doc_id, n_words, n_base (all places of phrases), first_word and last_word (least and greatest start), base_labels (of phrases), labels, score (the greatest share of a template that a block holds)."""
    # a set, so that repeated rows count once
    hit = F.collect_set(F.struct("label", "phrase", "k", "share", "places"))
    found = license_hits(docs, settings).groupBy("id", "mark", "check").agg(hit.alias("hits"))
    places = F.flatten(F.col("hits.places"))
    joined_labels = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    found = found.select(
        F.col("id").alias("id_"), F.col("mark").alias("mark_"), F.col("check").alias("check_"),
        F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined_labels(F.filter("hits", lambda h: h["phrase"])).alias("base_labels"), joined_labels(F.col("hits")).alias("labels"), F.array_max(F.col("hits.share")).alias("score"),
    )
    rows = docs.select(*identity(), F.size(F.regexp_extract_all(lowered(), F.lit(HELD), F.lit(0))).cast("long").alias("n_words"))
    both = rows.join(found, F.col("id").eqNullSafe(F.col("id_")) & (F.col("mark") == F.col("mark_")) & (F.col("check") == F.col("check_")), "left")
    return both.select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _sql(settings: LicenseScan) -> str:
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(f"('{t.label}', {t.phrase}, {listed(t.words)}, {len(set(t.words))}, {t.least})" for t in settings.templates)
    step = settings.step
    return f"""WITH t(label, phrase, words, n, least) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
b AS (SELECT r, k, w[k * {step} + 1 : (k + 2) * {step}] AS w FROM (SELECT r, w, unnest(range((len(w) + {step - 1}) // {step})) AS k FROM d)),
m AS (SELECT r, k, w, label, phrase, words, len(list_intersect(list_distinct(words), w)) / n AS share FROM b JOIN t ON len(list_intersect(list_distinct(words), w)) >= least),
h AS (SELECT r, label, phrase, share, CASE WHEN phrase THEN list_transform(list_filter(range({step}), lambda x: w[x + 1 : x + len(words)] = words), lambda x: x + k * {step}) ELSE [] END AS places FROM m),
f AS (SELECT r, flatten(list(places)) AS places, list(DISTINCT label) FILTER (phrase) AS base, list(DISTINCT label) AS every, max(share) AS score FROM h WHERE NOT phrase OR len(places) > 0 GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels, coalesce(array_to_string(list_sort(every), ','), '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN f USING (r)"""


ORACLE_SQL = _sql(LicenseScan())
