"""License scans: an exact set-similarity join between license templates and
the text blocks (lines) of documents.

A block meets a template when it holds at least ``threshold`` of the
template's distinct words. Tokens are ordered by how many blocks of the whole
corpus hold them, rarest first. With ``o`` the least overlap a template asks
for: *length* - a block needs ``o`` template words; *prefix* - block and
template share a word among the template's first ``size - o + 1`` and the
block's first ``size - o_min + 1``; *positional* - from the shared word on both
sides must still have ``o`` words left. What passes is compared whole, so the
result is exact. Words in no template can't add to an overlap and are left out
of the blocks at once; the template vocabulary is the only list sent along
with a task and is bounded by the given templates.

Besides, the base phrases are counted in the whole word sequence of a text.

Cases: null or empty text has no words and no labels; a null doc_id and rows
that repeat a doc_id are rows of their own; an empty table gives no rows;
other columns are ignored. ``score`` is the largest containment found, 1.0
where a base phrase stands, else 0.0.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import ascii_lower, let, saved, words_of

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices as they commonly stand in a single block.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
               "except in compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
THRESHOLD = 0.8


def _template_words(text: str) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c.isdigit() or "a" <= c <= "z" or ord(c) > 127 else " " for c in low).split()


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase in ``words``; a text without its rarest (last) word
    is passed over."""
    parts = phrase.split()

    def here(i):
        return reduce(lambda a, b: a & b, [F.get(words, i + k) == p for k, p in enumerate(parts)])

    none = F.expr("cast(array() as array<int>)")
    return F.when(F.array_contains(words, parts[-1]) & (F.size(words) >= len(parts)),
                  F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)).otherwise(none)


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None,
                  threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, and ``matches`` (block number, label,
    containment of every pair found)."""
    phrases = PHRASES if phrases is None else phrases
    sets = [(label, set(_template_words(text)), k)
            for k, (label, text) in enumerate(TEMPLATES if templates is None else templates)]
    sets = [(label, s, math.ceil(round(threshold * len(s), 9)), k) for label, s, k in sets if s]
    vocab = sorted(set().union(*[s for _, s, _, _ in sets])) if sets else []
    least = min((o for *_, o, _ in sets), default=1)
    strings = F.expr("cast(array() as array<string>)")
    as_array = lambda ws: F.array(*map(F.lit, ws)) if ws else strings

    lowered = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("low"))

    def scanned(lines):
        return let(F.flatten(lines), lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.filter(F.array(*[F.struct(F.lit(label).alias("label"), _places(words, p).alias("at"))
                               for p, label in phrases.items()]), lambda b: F.size(b["at"]) > 0).alias("base"),
            F.transform(lines, lambda w: F.array_intersect(as_array(vocab), w)).alias("blocks")))

    read = saved(lowered.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id",
        let(F.transform(F.split("low", "\n"), words_of), scanned).alias("s")
    ).select("rid", "doc_id", "s.*"), "license-blocks")

    counts = read.select(F.explode(F.flatten("blocks")).alias("token")).groupBy("token").count().collect()
    seen = {r["token"]: r["count"] for r in counts}  # at most one row per template word
    order = sorted(vocab, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    index = []
    for label, s, o, k in sets:
        tokens = sorted(s, key=rank.get)
        index += [F.struct(F.lit(w).alias("token"), F.lit(i).alias("t_pos"), F.lit(len(tokens)).alias("t_size"),
                           F.lit(o).alias("o"), F.lit(k).alias("template"), F.lit(label).alias("label"),
                           as_array(tokens).alias("t_tokens"))
                  for i, w in enumerate(tokens[:len(tokens) - o + 1])]
    blocks = read.select("rid", F.posexplode("blocks").alias("block", "b"))
    blocks = blocks.where(F.size("b") >= least).withColumn("b", F.array_intersect(as_array(order), F.col("b")))
    probes = blocks.select("rid", "block", "b", F.posexplode(
        F.slice("b", F.lit(1), F.size("b") - (least - 1))).alias("b_pos", "token"))
    if index:
        small = read.sparkSession.range(1).select(F.inline(F.array(*index)))
        near = probes.join(F.broadcast(small), "token").where(
            (F.size("b") >= F.col("o"))
            & (F.col("t_size") - F.col("t_pos") >= F.col("o"))
            & (F.size("b") - F.col("b_pos") >= F.col("o")))
        pairs = near.withColumn("shared", F.size(F.array_intersect("t_tokens", "b"))).where("shared >= o")
        pairs = pairs.select("rid", F.struct(
            "block", "template", "label", (F.col("shared") / F.col("t_size")).alias("containment")).alias("match"))
        found = pairs.groupBy("rid").agg(F.sort_array(F.collect_set("match")).alias("matches"))
    else:
        found = read.sparkSession.createDataFrame(
            [], "rid bigint, matches array<struct<block:int,template:int,label:string,containment:double>>")
    out = read.drop("blocks").join(found, "rid", "left")
    at = F.flatten(F.transform("base", lambda b: b["at"]))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    own = F.coalesce(F.transform("matches", lambda m: m["label"]), strings)
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return out.select(
        "doc_id", "n_words", F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"), "matches")
