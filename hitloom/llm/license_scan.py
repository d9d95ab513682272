"""Licences in texts by a positional index of rare words, in DataFrame functions alone."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh

# A word: a maximal run of digits, letters and all that is not ASCII, with A-Z lower-cased before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# What stands between words. Texts are split at it: regexp_extract_all took ten times as long for the same words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KELVIN = "\u212a"

# Words of a template by which it is looked up, those of the highest IDF.
ANCHORS = 6
# Words that may be missing or added between two anchors.
SLACK = 3
# Part of the anchors' weight that has to stand at its relative position.
COVERAGE = 0.6


@dataclass(frozen=True)
class Template:
    """A licence text and the phrases that must stand in it, word for word."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return words_of(self.text)


@dataclass(frozen=True)
class Anchor:
    word: str
    at: int
    weight: int


# Phrases that give a label wherever they stand.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Opening or notice texts of public licences, with the phrases that tell them apart.
TEMPLATES = (
    Template("mit", "Released under the MIT License", ("the mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software"),
    ),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("distribute this software for any purpose",),
    ),
    Template(
        "gpl-2",
        "This work is licensed under the GNU General Public License, version 2",
        ("gnu general public license version 2",),
    ),
    Template(
        "gpl-3",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License",
        ("gnu general public license as published", "version 3 of the license"),
    ),
    Template(
        "lgpl-3",
        "This library is licensed under the GNU Lesser General Public License, version 3",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-3",
        "This work is licensed under the GNU Affero General Public License, version 3",
        ("gnu affero general public license",),
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2 0",),
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0 international",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
)


def words_of(text: str) -> list[str]:
    if not text.isascii():
        raise ValueError("templates and phrases are ASCII")
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def word_array(text: Column) -> Column:
    """The words of a text in order; null has none. Other letters than A-Z may change their case too, which no
    comparison with ASCII words sees: the one of them whose lower case is ASCII, the Kelvin sign, is left out."""
    text = F.coalesce(text, F.lit(""))
    lower = F.when(text.contains(KELVIN), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lower, GAP), "")


def word_weights(docs: DataFrame, text_col: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """IDF of each word of `vocabulary` in thousandths, floor(1000 ln((2 N + 2) / (2 df + 1))), over all N rows.

    Words are made different within a row before they are counted; the driver gets a row for each word.
    """
    held = F.array_intersect(word_array(F.col(f"`{text_col}`")), F.array(*[F.lit(w) for w in vocabulary]))
    # the empty word, which no text has, counts the rows
    found = docs.select(F.explode(F.array_append(held, F.lit(""))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    frequency = {r["word"]: r["df"] for r in found.collect()}  # at most one row more than `vocabulary` has
    n = frequency.get("", 0)
    return {w: math.floor(1000 * math.log((2 * n + 2) / (2 * frequency.get(w, 0) + 1))) for w in vocabulary}


def anchors_of(template: Template, weights: dict[str, int]) -> tuple[Anchor, list[Anchor]]:
    """The lead, the word of highest IDF among the phrases, and the anchors of the template.

    Every place of the template holds its phrases, so it holds the lead. Equal weights go by the word.
    """
    words = template.words
    first = {w: i for i, w in reversed(list(enumerate(words)))}
    ranked = sorted(first, key=lambda w: (-weights[w], w))
    needed = {w for p in template.phrases for w in words_of(p)}
    made = [Anchor(w, first[w], max(weights[w], 1)) for w in ranked]
    return next(a for a in made if a.word in needed), made[:ANCHORS]


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.get(words, at + j) == w for j, w in enumerate(phrase)])


def _places(words: Column, marks: Column, template: Template, weights: dict[str, int]) -> Column:
    """Places of the template: struct(label, start, end, score) for each mark that is the lead of one."""
    lead, anchors = anchors_of(template, weights)
    total = sum(a.weight for a in anchors)
    size = len(template.words)

    def origin(mark: Column) -> Column:
        return mark - lead.at

    def near(mark: Column, anchor: Anchor) -> Column:
        low = F.greatest(origin(mark) + anchor.at - SLACK, F.lit(0))
        width = F.greatest(origin(mark) + anchor.at + SLACK + 1 - low, F.lit(0))
        return F.array_contains(F.slice(words, low + 1, width), anchor.word)

    def covered(mark: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(near(mark, a), F.lit(a.weight)).otherwise(F.lit(0)) for a in anchors])

    def reach(mark: Column) -> Column:
        return F.sequence(F.greatest(origin(mark) - SLACK, F.lit(0)), origin(mark) + size + SLACK)

    def has_phrases(mark: Column) -> Column:
        def stands(phrase: list[str]) -> Column:
            return F.exists(reach(mark), lambda q: _stands(words, q, phrase))

        return reduce(lambda a, b: a & b, [stands(words_of(p)) for p in template.phrases])

    # words added or missing between a phrase and the lead do not move the phrase: the first one tells the start
    known = [(at, p) for p in map(words_of, template.phrases) for at in range(size) if template.words[at : at + len(p)] == p]

    def start(mark: Column) -> Column:
        if not known:
            return F.greatest(origin(mark), F.lit(0))
        at, phrase = min(known)
        there = F.filter(reach(mark), lambda q: _stands(words, q, phrase))
        nearest = F.array_min(F.transform(there, lambda q: F.struct(F.abs(q - origin(mark) - at).alias("off"), q.alias("q"))))
        return F.greatest(nearest["q"] - at, F.lit(0))

    leads = F.filter(marks, lambda m: F.get(words, m) == lead.word)
    scored = F.transform(leads, lambda m: F.struct(m.alias("mark"), (covered(m) / F.lit(total)).alias("score")))
    kept = F.filter(scored, lambda s: (s["score"] >= COVERAGE) & has_phrases(s["mark"]))
    return F.transform(
        kept,
        lambda s: F.struct(
            F.lit(template.label).alias("label"),
            start(s["mark"]).cast("long").alias("start"),
            F.least(origin(s["mark"]) + size, F.size(words)).cast("long").alias("end"),
            s["score"].alias("score"),
        ),
    )


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    base: dict[str, str] = BASE,
) -> DataFrame:
    """`docs` without the text, with what its words say of licences: ``n_words``, ``n_base`` (places of the
    phrases in `base`), ``first_word`` and ``last_word`` (their smallest and largest start, else null),
    ``base_labels``, ``labels`` (of `base` and `templates` together; both different, sorted, joined by commas),
    ``score`` (1 for a base place, else the best score of a place, else 0) and ``places`` (label, start, end,
    score; the start is told by the template's first key phrase, the end by its lead). Names that `docs` has get
    underscores.

    1. The document frequencies of the templates' words over all rows give their IDF.
    2. A template's positional index holds its `ANCHORS` words of highest IDF. A text's words are looked up
       for the leads, the rarest word of each template's phrases; each gives a place where the template would
       begin.
    3. There the other anchors are intersected by their relative position, give or take `SLACK` words; at
       least `COVERAGE` of their weight has to stand.
    4. Every key phrase has to stand word for word within the place.

    All of it is done within the row, in time proportional to the words: nothing but the counts of step 1 is
    shuffled, at most a row for each word of the templates and task. Null and empty texts have no words and score 0;
    long texts are read whole; repeated rows are kept; an empty table gives an empty table.
    """
    vocabulary = sorted({w for t in templates for w in t.words} | {w for t in templates for p in t.phrases for w in words_of(p)})
    weights = word_weights(docs, text_col, vocabulary) if templates else {}
    phrases = [(words_of(p), label) for p, label in base.items()]
    # the longest word of a phrase marks its places
    keys = [max(range(len(p)), key=lambda i, p=p: (len(p[i]), i)) for p, _ in phrases]
    marked = sorted({p[k] for (p, _), k in zip(phrases, keys, strict=True)} | {anchors_of(t, weights)[0].word for t in templates})
    words, marks, places, starts = fresh(docs, "words_", "marks_", "places_", "base_")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    w, m = F.col(words), F.col(marks)

    def base_places(phrase: list[str], key: int, label: str) -> Column:
        hits = F.filter(m, lambda i: (i >= key) & _stands(w, i - key, phrase))
        return F.transform(hits, lambda i: F.struct(F.lit(label).alias("label"), (i - key).cast("long").alias("start")))

    none = "array<struct<label:string,start:bigint,end:bigint,score:double>>"
    found = docs.select(*rest, word_array(F.col(f"`{text_col}`")).alias(words))
    at = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(marked), i)))
    found = found.select("*", (at if marked else F.array().cast("array<int>")).alias(marks))
    found = found.select(
        "*",
        F.flatten(F.array(F.array().cast(none), *[_places(w, m, t, weights) for t in templates])).alias(places),
        F.flatten(
            F.array(
                F.array().cast("array<struct<label:string,start:bigint>>"),
                *[base_places(p, k, label) for (p, label), k in zip(phrases, keys, strict=True)],
            )
        ).alias(starts),
    )
    names = fresh(docs.drop(text_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")
    b, p = F.col(starts), F.col(places)
    values = [
        F.size(w).cast("long"),
        F.size(b).cast("long"),
        F.array_min(b["start"]),
        F.array_max(b["start"]),
        F.array_join(F.sort_array(F.array_distinct(b["label"])), ","),
        F.array_join(F.sort_array(F.array_union(b["label"], p["label"])), ","),
        F.when(F.size(b) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(p["score"]), F.lit(0.0))),
        p,
    ]
    return found.select(*rest, *[v.alias(n) for v, n in zip(values, names, strict=True)])
