"""License scans: exact set-similarity join of text blocks with license templates, in DataFrame functions only.

A block is any run of words a quarter longer than the template, whatever the line breaks; its tokens, and the template's, are the pairs of words
that stand next to each other, so scattered words make no notice.  A block meets a template when it holds at least
`percent` of the template's pairs and, for every template of another label that would itself meet this one (a Creative Commons license with one
more condition, say), a pair that the other lacks.

Documents that cannot hold a template's words are left out first: a block lacks at most as many words as pairs.  Pairs are ordered by how many
of the others hold them, rarest first.  A block that meets a template of m pairs with `need` of them holds one of the
template's first m - need + 1 pairs (prefix filter), holds `need` pairs at all
(length filter), and has enough pairs after its first match (positional filter).  What
passes is counted exactly.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .common import durable

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between lower-cased words
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PERCENT = 80

# Phrase, label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Label, notice.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)


def _lower(text: Column) -> Column:
    """A-Z only: other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def _words(text: str) -> list[str]:
    return [w for w in re.split(BREAKS, text.translate(str.maketrans(UPPER, LOWER))) if w]


def _base(text: Column) -> dict[str, Column]:
    """Counts and places of the phrases, on a text in which a blank stands at both sides of every word."""
    needed = text.rlike("(?i)" + "|".join(p.split()[-1] for p, _ in PHRASES))
    spaced = F.when(needed, F.concat(F.lit(" "), F.regexp_replace(_lower(text), BREAKS, "  "), F.lit(" ")))
    n_words = F.regexp_count(text, F.lit(WORD)).cast("long")
    return {"n_words": n_words, "_spaced": spaced}


def _places() -> tuple[list[Column], list[Column], list[Column]]:
    counts, firsts, lasts = [], [], []
    blank = lambda c: F.regexp_count(c, F.lit("[^ ]+")).cast("long")
    for phrase, _ in PHRASES:
        mark = " " + phrase.replace(" ", "  ") + " "
        n = F.coalesce((F.length("_spaced") - F.length(F.replace("_spaced", F.lit(mark), F.lit("")))) / len(mark), F.lit(0)).cast("long")
        counts.append(n)
        firsts.append(F.when(n > 0, blank(F.substring_index("_spaced", mark, 1))))
        lasts.append(F.when(n > 0, F.col("n_words") - blank(F.substring_index("_spaced", mark, -1)) - len(phrase.split())))
    return counts, firsts, lasts


def _pairs(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _telling(templates, percent: int) -> list[list[set[str]]]:
    """For each template the pairs that tell it from each template of another label whose text would meet it."""
    pairs = [set(_pairs(_words(t))) for _, t in templates]
    return [[own - other for k, other in enumerate(pairs) if templates[k][0] != label and 100 * len(own & other) >= percent * len(own) and own - other]
            for (label, _), own in zip(templates, pairs)]


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Results per row of docs(doc_id, text), and the matches found.

    The first table has doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score: base columns tell of PHRASES standing word by word anywhere in the text; labels
    adds those of the templates (two words at least each) met by a block; score is 1 with a base label, else the best
    containment found, else 0.  The second has doc_id, block (the word, from 0, that it starts at), template (its number), label,
    containment.  Null and empty texts have no words and no labels; rows of equal
    doc_id are scanned each for itself; an empty table gives empty ones.
    """
    if any(len(_words(t)) < 2 for _, t in templates):
        raise ValueError("a template needs two words")
    shapes = []  # number, label, pairs, pairs needed, words of a block
    for i, (label, notice) in enumerate(templates):
        pairs = _pairs(_words(notice))
        shapes.append((i, label, pairs, -(-percent * len(pairs) // 100), -(-5 * len(_words(notice)) // 4)))
    spark = docs.sparkSession
    literal = lambda values: F.array(*[F.lit(v) for v in values])
    known = sorted({w for _, t in templates for w in _words(t)})
    fewest = [(sorted(set(_words(t))), max(1, len(set(_words(t))) - len(x[2]) + x[3])) for (_, t), x in zip(templates, shapes)]
    near = lambda k: reduce(or_, [F.size(F.array_intersect(k, literal(own))) >= least for own, least in fewest], F.lit(False))
    text = F.coalesce("text", F.lit(""))
    # Lambda variables, so that the text is split once whatever asks for its words.
    held = lambda ws: F.transform(F.array(F.array_intersect(ws, literal(known))), lambda k: F.when(near(k), ws))[0]
    words = F.transform(F.array(F.split(_lower(text), BREAKS)), held)[0]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *[c.alias(n) for n, c in _base(text).items()], words.alias("words"))
    counts, firsts, lasts = _places()
    base = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, (_, label) in zip(counts, PHRASES)]))
    rows = durable(rows.select("row", "doc_id", "n_words", sum(counts[1:], counts[0]).alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
                               F.array_sort(F.array_distinct(base)).alias("base"), "words"))

    # Global order: pairs of the templates by the number of documents that hold them.
    pairs = sorted({g for _, _, own, _, _ in shapes for g in own})
    number = F.create_map(*[F.lit(x) for i, g in enumerate(pairs) for x in (g, i)])
    own = F.filter("words", lambda w: w != "")
    spots = lambda ws: F.filter(F.transform(ws, lambda w, i: F.struct(i.alias("at"), number[F.concat(w, F.lit(" "), F.get(ws, i + 1))].alias("pair"))), lambda h: h["pair"].isNotNull())
    hits = durable(rows.filter("words IS NOT NULL").select("row", "doc_id", F.transform(F.array(own), spots)[0].alias("hits")).filter(F.size("hits") > 0))
    found = {r["pair"]: r["n"] for r in hits.select(F.explode(F.array_distinct(F.col("hits.pair"))).alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).collect()}  # template pairs at most
    rank = {pairs[i]: k for k, i in enumerate(sorted(range(len(pairs)), key=lambda i: (found.get(i, 0), pairs[i])))}
    whole = []
    for (i, label, grams, need, reach), telling in zip(shapes, _telling(templates, percent)):
        ordered = sorted(rank[g] for g in grams)
        for at, r in enumerate(ordered[: len(ordered) - need + 1]):
            whole.append((r, at, i, label, ordered, len(ordered), need, reach, [sorted(rank[g] for g in t) for t in telling]))
    # Templates are a parameter of the scan, not data: the table is as small as the list above.
    prefixes = spark.createDataFrame(whole, "rank int, at int, template int, label string, template_ranks array<int>, m int, need int, reach int, telling array<array<int>>")
    by_number = literal([rank[g] for g in pairs])
    ranked = F.transform("hits", lambda h: F.struct(h["at"].alias("at"), F.get(by_number, h["pair"]).alias("rank")))
    widest = max((x[4] for x in shapes), default=1)
    first = literal(sorted({x[0] for x in whole})) if whole else F.array().cast("array<int>")
    # Each hit of a prefix pair with the hits around it: a position has one pair, so `widest` hits reach as far as any block.
    around = lambda hs: F.filter(F.transform(hs, lambda h, j: F.struct(h["at"].alias("at"), h["rank"].alias("rank"), F.slice(hs, F.greatest(F.lit(1), j + 2 - widest), F.lit(2 * widest)).alias("near"))),
                                 lambda s: F.array_contains(first, s["rank"]))
    probes = hits.select("row", "doc_id", F.explode(F.transform(F.array(ranked), around)[0]).alias("p")).select("row", "doc_id", F.col("p.at").alias("spot"), "p.rank", "p.near")
    probes = probes.join(F.broadcast(prefixes), "rank")
    starts = F.transform(F.filter("near", lambda h: (h["at"] <= F.col("spot")) & (h["at"] > F.col("spot") - F.col("reach") + 1)), lambda h: h["at"])
    blocks = probes.withColumn("block", F.explode(starts))
    inside = F.filter("near", lambda h: (h["at"] >= F.col("block")) & (h["at"] < F.col("block") + F.col("reach") - 1))
    blocks = blocks.withColumn("ranks", F.array_sort(F.array_distinct(F.transform(inside, lambda h: h["rank"])))).drop("near")
    size, pos = F.size("ranks"), F.array_position("ranks", F.col("rank")) - 1
    kept = blocks.filter((size >= F.col("need")) & (1 + F.least(F.col("m") - F.col("at") - 1, size - pos - 1) >= F.col("need") - F.least(F.col("at"), pos)))
    shared = F.size(F.array_intersect("ranks", "template_ranks"))
    told = F.forall("telling", lambda t: F.arrays_overlap(t, F.col("ranks")))
    matches = kept.withColumn("shared", shared).filter((F.col("shared") >= F.col("need")) & told)
    matches = matches.select("row", "doc_id", "block", "template", "label", (F.col("shared") / F.col("m")).alias("containment")).distinct()
    own = matches.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    out = rows.drop("words").join(own, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    result = out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
    return result, matches.drop("row")
