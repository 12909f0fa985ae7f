"""Licence scans with a positional index of the rarest template words.

The templates are a table, and so are the postings of their words: template, word, place and weight, the inverse document
frequency in the whole corpus. A file that holds all words of a template's mandatory phrases looks up those of the template's words
that are rarest of the ones it holds. Its own postings of these words are joined with the template's; places are intersected by their
difference, and where enough of the words agree on one, the mandatory phrases must stand at exactly that distance. Base
phrases are found wherever their words are consecutive.

Everything is made of DataFrame functions and joins; a text that has none of the words that every match needs is not looked at closer.
The postings of templates are broadcast: they are bounded by the templates, not by the corpus.
Words are lower-cased (A-Z only) runs of digits, letters and non-ASCII characters. Null and empty texts have no words, places or
labels and score 0. Repeated rows and null doc_ids get a row each. An empty table gives no rows. Texts may be of any length. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import WORD, stored

PROBES = 6
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return _split(self.text)


def _split(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


# Phrases that name a licence, and its label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Opening words of public licence notices.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License', ("apache license version 2 0", "except in compliance with the license")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ("redistribute it and or modify it under the terms", "gnu general public license")),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute", "with or without fee is hereby granted")),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
)


def _words(text: Column) -> Column:
    """All words. The Kelvin sign is the one letter beyond ASCII that `lower` would turn into an ASCII word's letter alone."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ")))
    return F.filter(F.split(F.trim(F.regexp_replace(low, SEPARATORS, " ")), " "), lambda word: word != "")


def _needed(phrases: list[list[str]]) -> list[str]:
    """A longest word of each phrase: without one of them nothing can match."""
    return sorted({max(phrase, key=lambda word: (len(word), word)) for phrase in phrases})


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def read_words(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: dict[str, str] = BASE) -> DataFrame:
    """(row, doc_id, n_words, known, words): known are the text's template words, words are kept if anything can match."""
    vocabulary = sorted({word for t in templates for word in t.words} | {word for phrase in base for word in _split(phrase)})
    needed = _needed([_split(phrase) for phrase in base] + [_split(t.mandatory[0]) for t in templates])
    split = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), _words(F.col("text")).alias("words"))
    known = split.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", _strings(vocabulary)).alias("known"), "words")
    return stored(known.withColumn("words", F.when(F.arrays_overlap("known", _strings(needed)), F.col("words"))), "licence-words")


def frequencies(read: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each template word; one row per template word comes to the driver."""
    found = read.select(F.explode("known").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return read.count(), {row.word: row.n for row in found.collect()}


def _places(words: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand consecutively, as the place of its first word."""
    at = F.sequence(F.lit(0), F.size(words) - len(phrase))

    def here(i: Column) -> Column:
        found = F.get(words, i) == phrase[0]
        for step, word in enumerate(phrase[1:], 1):
            found = found & (F.get(words, i + step) == word)
        return found

    empty = F.array().cast("array<int>")
    return F.when(F.size(words) >= len(phrase), F.filter(at, here)).otherwise(empty)


def template_table(spark: SparkSession, templates: tuple[Template, ...], idf: dict[str, float]) -> DataFrame:
    """(template, label, words, weights, by_rarity, required, mandatory): one row for each template."""
    rows = []
    for number, t in enumerate(templates):
        own, phrases = t.words, [_split(phrase) for phrase in t.mandatory]
        at = [next(i for i in range(len(own)) if own[i : i + len(phrase)] == phrase) for phrase in phrases]
        rarest = sorted(set(own), key=lambda word: (-idf[word], word))
        mandatory = F.array(*[F.struct(F.lit(i).alias("at"), _strings(phrase).alias("words")) for i, phrase in zip(at, phrases)])
        rows.append(F.struct(
            F.lit(number).alias("template"), F.lit(t.label).alias("label"), _strings(own).alias("template_words"),
            F.array(*[F.lit(idf[word]) for word in own]).alias("weights"), _strings(rarest).alias("by_rarity"),
            _strings(sorted({word for phrase in phrases for word in phrase})).alias("required"), mandatory.alias("mandatory"),
        ))
    return spark.range(1).select(F.inline(F.array(*rows)))


def _agreed(read: DataFrame, table: DataFrame) -> DataFrame:
    """(row, template, shift): where enough of a template's rarest words, among those that a text holds, stand as in the template."""
    table = F.broadcast(table)
    # A template is looked up by its rarest required word, and needs all of them.
    entry = table.select("template", "required", "by_rarity", F.get(F.filter("by_rarity", lambda w: F.array_contains("required", w)), 0).alias("word"))
    holds = read.where("words is not null").select("row", "known", F.explode("known").alias("word")).join(F.broadcast(entry), "word")
    holds = holds.where(F.size(F.array_except("required", "known")) == 0)
    probes = F.slice(F.filter("by_rarity", lambda word: F.array_contains("known", word)), 1, PROBES)
    probed = holds.select("row", "template", probes.alias("probes")).select("row", "template", F.size("probes").alias("n"), F.explode("probes").alias("word"))
    postings = table.select("template", F.posexplode("template_words").alias("template_place", "word"))
    placed = read.where("words is not null").select("row", F.posexplode("words").alias("place", "word"))
    both = placed.join(probed, ["row", "word"]).join(F.broadcast(postings), ["template", "word"])
    votes = both.groupBy("row", "template", "n", (F.col("place") - F.col("template_place")).alias("shift")).agg(F.count_distinct("word").alias("votes"))
    return votes.where(F.col("votes") >= F.ceil(2 * F.col("n") / 3)).select("row", "template", "shift")


def _verified(read: DataFrame, agreed: DataFrame, table: DataFrame) -> DataFrame:
    """(row, found_labels, share): the templates whose mandatory phrases stand, and the largest share of a template's weight."""
    shifts = agreed.groupBy("row").agg(F.collect_list(F.struct("template", "shift")).alias("at"))
    each = read.select("row", "words").join(shifts, "row").select("row", "words", F.inline("at")).join(F.broadcast(table), "template")

    def stands(phrase: Column) -> Column:
        first = F.col("shift") + phrase["at"]
        return F.when(first >= 0, F.slice("words", first + 1, F.size(phrase["words"])) == phrase["words"]).otherwise(False)

    # A text may hold a template without its first words: places before its start count as missing.
    def found(total: Column, i: Column) -> Column:
        place = F.col("shift") + i
        here = F.when(place >= 0, F.get("words", place)) == F.get("template_words", i)
        return total + F.when(here, F.get("weights", i)).otherwise(0.0)

    places = F.sequence(F.lit(0), F.size("template_words") - 1)
    whole = F.aggregate("weights", F.lit(0.0), lambda total, weight: total + weight)
    share = F.aggregate(places, F.lit(0.0), found) / whole
    good = each.where(F.forall("mandatory", stands)).select("row", "label", share.alias("share"))
    return good.groupBy("row").agg(F.collect_set("label").alias("found_labels"), F.max("share").alias("share"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: dict[str, str] = BASE) -> DataFrame:
    """Per document: doc_id, n_words, places (of base phrases, ascending), base_labels, labels (arrays) and score.

    score: 1 with a base phrase, else the largest share of a template's weight found where it matches, else 0.
    """
    read = read_words(docs, templates, base)
    n, frequency = frequencies(read)
    idf = {word: math.log((n + 1) / (frequency.get(word, 0) + 1)) + 1e-9 for t in templates for word in t.words}
    table = template_table(docs.sparkSession, templates, idf)
    by_template = _verified(read, _agreed(read, table), table)
    words, no_text, no_place = F.col("words"), F.array().cast("array<string>"), F.array().cast("array<int>")
    found = read.join(by_template, "row", "left").select(
        "doc_id", "n_words", "share", F.coalesce("found_labels", no_text).alias("found_labels"),
        *[F.when(words.isNull(), no_place).otherwise(_places(words, _split(phrase))).alias(f"base{i}") for i, phrase in enumerate(base)],
    )
    named = [F.when(F.size(f"base{i}") > 0, _strings([label])).otherwise(no_text) for i, label in enumerate(base.values())]
    base_labels = F.array_sort(F.array_distinct(F.concat(*named)))
    return found.select(
        "doc_id", "n_words",
        F.array_sort(F.concat(*[F.col(f"base{i}") for i in range(len(base))])).alias("places"),
        base_labels.alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(base_labels, "found_labels"))).alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0)))).alias("score"),
    )
