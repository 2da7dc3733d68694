"""License scans: exact set-similarity join of text blocks with license templates (operator 3, native).

Blocks are windows over the words of the whole text, line breaks being white
space like any other, since notices are wrapped. Templates fall into sizes (8
words or fewer, 16, 32, ...); for templates of size g a block has 2 g words and
begins at every multiple of g, so each stretch of g words lies whole in one and
a short template is not put together from words far apart. Tokens are ordered by their frequency in the whole corpus,
rarest first. A block contains a template when it holds at least
``alpha = ceil(threshold * |T|)`` of its distinct tokens. Filters, all exact:

* prefix: of two sets that share alpha tokens, the first |T| - alpha + 1 tokens
  of the template and the first |B| - alpha + 1 of the block share one; the
  join runs on these prefix tokens, and documents without any template's prefix
  token are left out before they are cut into blocks;
* length: |B| >= alpha;
* position: a first common token at places p and q leaves at most
  1 + min(|T| - p - 1, |B| - q - 1) common tokens, which must reach alpha.

Block tokens outside the template vocabulary can never match and are dropped.
The templates are a parameter of fixed size, so their index is broadcast;
the corpus is never shuffled, only the matches are grouped by document.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices of widely used public licenses.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# runs of separators in text of any case, and in text with ASCII letters lower-cased
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def fold(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Array of words of folded text; empty for empty text."""
    return F.filter(F.split(text, _GAP), lambda w: w != "")


def _tokens(template: str) -> list[str]:
    return sorted({w for w in re.split(r"[^0-9a-z]+", template.lower()) if w})


def _table(df: DataFrame, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A literal table, built in the plan."""
    structs = [F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(n)
                          for n, v in zip(names, row)]) for row in rows]
    return df.sparkSession.range(1).select(F.inline(F.array(*structs)))


def _phrase_places(w: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    starts = F.sequence(F.lit(0), F.size(w) - len(parts))

    def hit(i: Column) -> Column:
        ok = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            ok = ok & (F.get(w, i + k) == p)
        return ok

    return F.when(F.size(w) >= len(parts), F.filter(starts, hit)).otherwise(F.array().cast("array<int>"))


def block_size(template: str) -> int:
    """Size class of a template: the least power of two, 8 or more, that its words fit in."""
    n = len(re.findall(r"[0-9A-Za-z]+", template))
    return max(8, 1 << (n - 1).bit_length())


def token_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Rank of every vocabulary token, rarest in the whole corpus first, ties by token.

    Only counts of the vocabulary (whose size the templates fix) reach the driver."""
    counts = (docs.select(F.explode(F.split(F.lower(text_col), _GAP)).alias("w"))
              .where(F.col("w").isin(vocabulary)).groupBy("w").agg(F.count("*").alias("n")))
    seen = {r["w"]: r["n"] for r in counts.collect()}
    return {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (seen.get(t, 0), t)))}


def template_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, text_hash, size, window, template, label, containment) of every block that contains a template.

    Block ``window`` of ``size`` begins at word ``window * size`` and has twice as many words. Repeated rows give
    repeated matches; null texts have none."""
    rank = token_order(docs, sorted({t for _, text in templates for t in _tokens(text)}), text_col)
    by_rank = {i: t for t, i in rank.items()}
    index, early, least = [], set(), {}
    for no, (label, text) in enumerate(templates):
        order = sorted(rank[t] for t in _tokens(text))
        alpha = math.ceil(threshold * len(order) - 1e-9)
        size = block_size(text)
        least[size] = min(alpha, least.get(size, alpha))
        for p, r in enumerate(order[: len(order) - alpha + 1]):
            index.append((r, size, no, label, p, len(order), alpha, order))
            early.add(by_rank[r])
    ranks_of = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])

    some = F.arrays_overlap(F.split(F.lower(text_col), _GAP), F.array(*[F.lit(t) for t in sorted(early)]))
    ranked = (docs.where(some).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                                      words(fold(F.col(text_col))).alias("w"))
              .select("id", "text_hash", F.transform("w", lambda t: ranks_of[t]).alias("ranks")))
    sized = ranked.select("*", F.explode(F.array(*[F.struct(F.lit(g).alias("size"), F.lit(least[g]).alias("least"))
                                                   for g in sorted(least)])).alias("x")).select("id", "text_hash", "ranks", "x.*")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("ranks") - F.col("size") - 1), F.col("size"))
    blocks = (sized.where(F.size("ranks") > 0).select("*", F.posexplode(starts).alias("window", "at"))
              .select("id", "text_hash", "size", "least", "window", F.array_sort(F.array_distinct(F.filter(
                  F.slice("ranks", F.col("at") + 1, 2 * F.col("size")), lambda r: r.isNotNull()))).alias("own"))
              .where(F.size("own") >= F.col("least")))
    prefix = blocks.select("*", F.posexplode(F.slice("own", F.lit(1), F.size("own") - F.col("least") + 1)).alias("q", "r"))
    table = _table(docs, index, ("r", "size", "template", "label", "p", "n", "alpha", "tokens"))
    size = F.size("own")
    hits = (prefix.join(F.broadcast(table), ["r", "size"])
            .where((size >= F.col("alpha")) & (F.col("q") <= size - F.col("alpha"))
                   & (1 + F.least(F.col("n") - F.col("p") - 1, size - F.col("q") - 1) >= F.col("alpha")))
            .withColumn("common", F.size(F.array_intersect("own", "tokens")))
            .where(F.col("common") >= F.col("alpha")))
    return (hits.select("id", "text_hash", "size", "window", "template", "label",
                        (F.col("common") / F.col("n")).alias("containment"))
            .withColumnsRenamed({"id": id_col}))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: word count, base phrase places and all labels.

    Null text counts as empty (no words, no labels, score 0). ``score`` is the
    best containment among the matched templates, 0 without one. Repeated rows
    and null ids pass through; other columns are not read; an empty table gives
    an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                        F.split(text, _GAP).alias("raw"), text.alias("t"))
    n = (F.size("raw") - F.when(F.get("raw", F.lit(0)) == "", 1).otherwise(0)
         - F.when((F.size("raw") > 1) & (F.element_at("raw", -1) == ""), 1).otherwise(0))
    none = F.array().cast("array<int>")
    named = F.col("t").rlike("(?i)license")
    folded = parts.select("id", "text_hash", n.cast("long").alias("n_words"),
                          F.when(named, words(fold(F.col("t")))).alias("w"))
    places = folded.select("id", "text_hash", "n_words", *[
        F.when(F.col("w").isNotNull(), _phrase_places(F.col("w"), p)).otherwise(none).alias(label)
        for p, label in PHRASES])
    labels = [label for _, label in PHRASES]
    every = F.concat(*[F.col(x) for x in labels])
    base = (places.select("id", "text_hash", "n_words", every.alias("at"),
                          F.filter(F.array(*[F.when(F.size(x) > 0, F.lit(x)) for x in labels]),
                                   lambda x: x.isNotNull()).alias("base"))
            .select("id", "text_hash", "n_words", F.size("at").cast("long").alias("n_base"),
                    F.array_min("at").cast("long").alias("first_word"),
                    F.array_max("at").cast("long").alias("last_word"), "base"))
    found = (template_matches(docs, id_col, text_col, templates, threshold)
             .groupBy(F.col(id_col).alias("id2"), F.col("text_hash").alias("h2"))
             .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")))
    out = base.join(found, base["id"].eqNullSafe(found["id2"]) & (base["text_hash"] == found["h2"]), "left")
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"))
