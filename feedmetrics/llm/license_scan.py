"""Licence notices in documents, by the Dice coefficient of word bigrams.

A document is cut into sentences, by line and across lines. The distinct word bigrams of a sentence are
compared with those of every template sentence whose size allows the wanted similarity. Only documents
that hold one of the bigrams that a match cannot do without are cut at all.

All of it is DataFrame code, row by row: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import LOWER, UPPER, WORD_BREAK, words

PERCENT = 80                # Dice coefficient from which a sentence matches, in hundredths

# Notices and opening sentences of common licences.
LICENSES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
}

SENTENCE_END = r"(?<=[.!?:;])[\x20\x09-\x0D]+"
LINE_END = r"[\x0A\x0D]+"


def plain_words(text: str) -> list[str]:
    """The words of a template, as ``words`` gives them for a column."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(WORD_BREAK, lowered) if w]


def plain_bigrams(text: str) -> list[str]:
    w = plain_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def least_shared(n: int, percent: int = PERCENT) -> int:
    """How many of a template's ``n`` bigrams a similar sentence holds at least.

    200 * shared >= percent * (size + n), and a sentence's size is at least what it shares.
    """
    return -(-percent * n // (200 - percent))


def necessary(bigrams: list[str], percent: int = PERCENT) -> list[str]:
    """So many bigrams that a similar sentence has one of them: those of the longest words."""
    return sorted(bigrams, key=lambda b: (-len(b), b))[: len(bigrams) - least_shared(len(bigrams), percent) + 1]


def bigrams(sentence: Column) -> Column:
    """The distinct word bigrams of a sentence."""
    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.array_distinct(F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat_ws(" ", a, b)))

    return _bound(words(sentence), pairs)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def sentences(text: Column) -> Column:
    """Distinct sentences: those within lines, and those of the text read across line ends."""
    lines = F.split(text, f"{SENTENCE_END}|{LINE_END}")
    across = F.split(F.regexp_replace(text, LINE_END, " "), SENTENCE_END)
    return F.array_distinct(F.concat(lines, across))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licenses: dict[str, tuple[str, ...]] | None = None,
    percent: int = PERCENT,
) -> DataFrame:
    """Per document ``id, found``: its sentences that are similar to a template.

    ``found`` holds ``dice, license, sentence`` per such sentence, with the template of the highest
    coefficient, then of most bigrams, then of the last licence by name; the best sentence first. A sentence with fewer than two words matches nothing.

    Null, empty and wordless texts find nothing. Rows that repeat an id, and null ids, are scanned like
    any other. An empty table gives an empty result. Other columns are not read. ``licenses`` is a small
    table in code: name to template sentences.
    """
    templates = [(name, plain_bigrams(t)) for name, texts in sorted((licenses or LICENSES).items()) for t in texts]
    templates = [(name, b) for name, b in templates if b]
    table = F.array(*[
        F.struct(F.lit(name).alias("license"), F.lit(len(b)).alias("n"), F.array(*[F.lit(x) for x in b]).alias("bigrams"))
        for name, b in templates])
    needed = sorted({x for _, b in templates for x in necessary(b, percent)})

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    flat = F.regexp_replace(F.translate("text", UPPER, LOWER), WORD_BREAK, " ")
    holds = F.concat(F.lit(" "), flat, F.lit(" ")).rlike(" (?:" + "|".join(map(re.escape, needed)) + ") ")

    def closest(own: Column) -> Column:
        size = F.size(own)
        fitting = F.filter(
            table, lambda t: (size * (200 - percent) >= percent * t["n"]) & (percent * size <= (200 - percent) * t["n"]))
        shared = F.transform(fitting, lambda t: F.struct(
            F.size(F.array_intersect(own, t["bigrams"])).alias("shared"), t["n"].alias("n"), t["license"].alias("license")))
        alike = F.filter(shared, lambda t: 200 * t["shared"] >= percent * (size + t["n"]))
        return F.array_max(F.transform(alike, lambda t: F.struct(
            (2 * t["shared"] / (size + t["n"])).alias("dice"), t["n"].alias("n"), t["license"].alias("license"))))

    def compare(sentence: Column) -> Column:
        return F.struct(sentence.alias("sentence"), _bound(bigrams(sentence), closest).alias("best"))

    best = F.filter(F.transform(sentences(F.col("text")), compare), lambda s: s["best"].isNotNull())
    found = F.reverse(F.array_sort(F.transform(best, lambda s: F.struct(
        s["best"]["dice"].alias("dice"), s["best"]["license"].alias("license"), s["sentence"].alias("sentence")))))
    nothing = F.array().cast("array<struct<dice:double,license:string,sentence:string>>")
    return rows.select("id", F.when(holds, found).otherwise(nothing).alias("found"))


def report(found: DataFrame) -> DataFrame:
    """``doc_id, licenses, n_licenses, best_license, best_dice``; empty, 0 and null where nothing was found."""
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["license"])))
    top = F.array_max(F.transform("found", lambda f: f["dice"]))
    first = F.array_min(F.transform(F.filter("found", lambda f: f["dice"] == top), lambda f: f["license"]))
    return found.select(
        F.col("id").alias("doc_id"), F.array_join(names, ",").alias("licenses"), F.size(names).cast("bigint").alias("n_licenses"),
        first.alias("best_license"), top.alias("best_dice"))
