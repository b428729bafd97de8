"""License scan: an exact set-similarity join of text blocks with notice templates.

Blocks are runs of neighbouring words, a quarter longer than the template they are held against (one
word at least), so that words of a notice strewn over a long line are none. A run lies
within a line or, for wrapped notices, over line ends; it is counted by the line where it begins.
Every template is a set of tokens; a block matches when it holds at least ``threshold``
of a template's tokens. Tokens are ordered by
their frequency over the whole corpus, rarest first, and a block meets a template only
through tokens in both prefixes of that order, under the length and positional filters,
before the overlap is counted. The filters never lose a match.

A run can match only if its line, or the whole text, does. So lines and whole texts go
through the join first, and only texts where one matches are searched run by run for
that template. Lines that hold a run by themselves lend a wrapped run no words.

Only template tokens can add to an overlap, so a block is first reduced to those: what
is counted, ordered and broadcast is bounded by the templates, not by the corpus.

Defined results for unusual rows: null text is empty (no words, no labels, score 0);
a null doc_id passes through; equal rows give equal results, one per row; an empty
table gives an empty result; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import lower_ascii, materialise, text_or_empty

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrases that name a license wherever their words stand in a row.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Wording of common public notices, as label and text.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under the creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under the creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under the creative commons attribution 4 0 international license"),
    ("cc0", "dedicated to the public domain under the creative commons cc0 1 0 universal waiver"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "copyright all rights reserved no part may be reproduced without prior written permission"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "licensed under the gnu general public license version"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
)


def need(size: int, threshold: float) -> int:
    """Tokens that a block must share with a template of ``size`` tokens."""
    return max(1, math.ceil(threshold * size - 1e-9))


def run_words(text: str) -> int:
    """Words of a run that is held against a template's text."""
    n = len(text.split())
    return n + max(1, n // 4)


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), NOT_WORD), "")


def phrase_places(words: Column, joined: Column, phrases=PHRASES) -> Column:
    """(place, label) of every place where a phrase's words stand in a row."""

    def at(parts: list[str], i: Column) -> Column:
        hit = F.get(words, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == p)
        return hit

    none = F.array().cast("array<struct<place:int,label:string>>")
    found = []
    for phrase, label in phrases:
        parts = phrase.split()
        places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: at(parts, i))
        labelled = F.transform(places, lambda i: F.struct(i.alias("place"), F.lit(label).alias("label")))
        found.append(F.when(F.contains(joined, F.lit(f" {phrase} ")), labelled).otherwise(none))
    return F.concat(*found)


def template_table(templates=TEMPLATES) -> list[tuple[int, str, list[str]]]:
    return [(k, label, sorted(set(text.split()))) for k, (label, text) in enumerate(templates)]


def candidate_blocks(docs: DataFrame, key: list[str], templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """key columns, block and the block's template tokens, for blocks long enough for
    some template (the length filter). Block 0 is the whole text, if it has several
    lines; the lines are numbered from 1."""
    table = template_table(templates)
    vocabulary = sorted({t for _, _, ts in table for t in ts})
    least = min(need(len(ts), threshold) for _, _, ts in table)
    tokens = lambda line: F.array_distinct(F.filter(F.split(line, NOT_WORD), lambda w: w.isin(vocabulary)))
    per_line = F.transform(F.split(lower_ascii(F.col("_text")), "\n"), tokens)
    # A text is split once: the generator keeps its lines' tokens, of which those of the whole are the union.
    held = docs.select(*key, F.explode(F.array(per_line)).alias("_lines"))
    whole = F.when(F.size("_lines") > 1, F.array_distinct(F.flatten("_lines")))
    return held.select(*key, F.posexplode(F.concat(F.array(whole), F.col("_lines"))).alias("block", "tokens")).filter(F.size("tokens") >= least)


def token_order(blocks: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Global rank of every template token, rarest first. The collected rows are at
    most the distinct tokens of the templates."""
    counts = dict(blocks.select(F.explode("tokens").alias("t")).groupBy("t").count().collect())
    tokens = {t for _, _, ts in template_table(templates) for t in ts}
    return {t: k for k, t in enumerate(sorted(tokens, key=lambda t: (counts.get(t, 0), t)))}


def containment_join(blocks: DataFrame, key: list[str], order: dict[str, int], templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """key, block, template, label, containment for every block that meets a template."""
    spark = blocks.sparkSession
    rows, sets = [], []
    for k, label, tokens in template_table(templates):
        ranks = sorted(order[t] for t in tokens)
        n = need(len(ranks), threshold)
        sets.append((k, label, ranks))
        rows += [(r, k, p, len(ranks), n) for p, r in enumerate(ranks[: len(ranks) - n + 1])]
    index = spark.createDataFrame(rows, "rank int, template int, t_pos int, t_size int, t_need int")
    members = spark.createDataFrame(sets, "template int, label string, t_ranks array<int>")
    rank_of = F.create_map(*[F.lit(x) for t, r in order.items() for x in (t, r)])
    ranked = blocks.select(*key, "block", F.sort_array(F.transform("tokens", lambda t: F.element_at(rank_of, t))).alias("ranks"))
    probes = ranked.select(*key, "block", "ranks", F.posexplode("ranks").alias("b_pos", "rank"))
    # The index and the member sets hold the templates only, a fixed small table.
    met = probes.join(F.broadcast(index), "rank").filter(
        (F.size("ranks") >= F.col("t_need"))
        & (F.col("b_pos") <= F.size("ranks") - F.col("t_need"))
        & (1 + F.least(F.col("t_size") - 1 - F.col("t_pos"), F.size("ranks") - 1 - F.col("b_pos")) >= F.col("t_need"))
    )
    verified = met.join(F.broadcast(members), "template").withColumn("shared", F.size(F.array_intersect("ranks", "t_ranks")))
    return (
        verified.filter(F.col("shared") >= F.col("t_need"))
        .select(*key, "block", "template", "label", (F.col("shared") / F.col("t_size")).alias("containment"))
        .distinct()
    )


def notice_runs(docs: DataFrame, found: DataFrame, key: list[str], templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """key, block, label, containment for every run of words that meets a template, in the
    texts of which a line or the whole does. A run begins with one of the template's tokens."""
    sets = [(k, label, tokens, run_words(templates[k][1]), need(len(tokens), threshold)) for k, label, tokens in template_table(templates)]
    members = docs.sparkSession.createDataFrame(sets, "template int, label string, t_tokens array<string>, t_words int, t_need int")
    met = found.select(*[F.col(k).alias(f"{k}_") for k in key], "template").distinct().join(F.broadcast(members), "template")
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    texts = docs.join(met, same)
    words = F.flatten(F.transform(F.split(F.col("_text"), "\n"), lambda line, k: F.transform(license_words(line), lambda w: F.struct((k + 1).alias("block"), w.alias("word")))))
    placed = F.transform(words, lambda w, i: F.struct(w["block"].alias("block"), w["word"].alias("word"), i.alias("place")))
    hits = F.filter(placed, lambda w: F.array_contains("t_tokens", w["word"]))

    def run(hs: Column, h: Column, i: Column, in_line: bool) -> Column:
        inside = F.filter(F.slice(hs, i + 1, F.col("t_words")), lambda x: x["place"] < h["place"] + F.col("t_words"))
        inside = F.filter(inside, lambda x: x["block"] == h["block"]) if in_line else inside
        return F.struct(
            h["block"].alias("block"),
            F.array_max(F.transform(inside, lambda x: x["block"])).alias("last"),
            F.size(F.array_distinct(F.transform(inside, lambda x: x["word"]))).alias("shared"),
        )

    def runs(hs: Column, in_line: bool) -> Column:
        # The hits stand in an array of one, so that they are computed once a text.
        every = F.flatten(F.transform(F.array(hs), lambda x: F.transform(x, lambda h, i: run(x, h, i, in_line))))
        return F.filter(every, lambda r: (r["shared"] >= F.col("t_need")) & (F.lit(in_line) | (r["last"] > r["block"])))

    # The generators keep what they make from being computed again above.
    held = texts.select(*key, "label", "t_tokens", "t_words", "t_need", F.explode(F.array(hits)).alias("_hits")).filter(F.size("_hits") >= F.col("t_need"))
    held = held.select("*", F.explode(F.array(runs(F.col("_hits"), True))).alias("_lines"))
    whole_lines = F.transform("_lines", lambda r: r["block"])
    rest = F.filter("_hits", lambda h: ~F.array_contains(whole_lines, h["block"]))
    return (
        held.select(*key, "label", F.size("t_tokens").alias("_size"), F.explode(F.concat("_lines", runs(rest, False))).alias("_run"))
        .select(*key, F.col("_run.block").alias("block"), "label", (F.col("_run.shared") / F.col("_size")).alias("containment"))
    )


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = 0.8) -> DataFrame:
    """One row per document: word and phrase counts, labels and the best containment."""
    key = ["doc_id", "_hash"]
    texts = docs.select("doc_id", text_or_empty().alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    words, joined = F.col("_words"), F.col("_joined")
    base = (
        texts.select(*key, F.explode(F.array(license_words(F.col("_text")))).alias("_words"))
        .withColumn("_joined", F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")))
        .select(*key, F.size("_words").cast("long").alias("n_words"), phrase_places(words, joined, phrases).alias("_found"))
        .select(
            *key,
            "n_words",
            F.size("_found").cast("long").alias("n_base"),
            F.array_min(F.transform("_found", lambda x: x["place"])).cast("long").alias("first_word"),
            F.array_max(F.transform("_found", lambda x: x["place"])).cast("long").alias("last_word"),
            F.sort_array(F.array_distinct(F.transform("_found", lambda x: x["label"]))).alias("_base"),
        )
    )
    blocks = materialise(candidate_blocks(texts, key, templates, threshold), "blocks")
    met = materialise(containment_join(blocks, key, token_order(blocks, templates), templates, threshold), "met")
    found = notice_runs(texts, met, key, templates, threshold)
    by_text = found.groupBy(*key).agg(
        F.sort_array(F.collect_set("label")).alias("_method"),  # at most one entry a template
        F.max("containment").alias("_best"),
        F.countDistinct("block").alias("n_blocks"),
    )
    by_text = by_text.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "_method", "_best", "n_blocks")
    out = base.join(by_text, base["doc_id"].eqNullSafe(by_text["_id"]) & (base["_hash"] == by_text["_h"]), "left")
    both = F.array_sort(F.array_union("_base", F.coalesce("_method", F.array().cast("array<string>"))))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )
