"""License scan: named licenses, and license notices by an exact set-similarity join.

A text is cut into blocks of ``2 * step`` words that begin every ``step`` words, so any run of
``step`` words lies in a block, however its lines are broken. A block matches a notice (template)
when it holds at least a share of the notice's distinct words. The tokens of the notices are ordered by
the number of documents that hold them, the rarest first. A block that matches
holds one of the first |T| - needed + 1 tokens of the notice T (prefix), has as many of the notices' tokens as
needed (length), and a shared token must leave enough tokens behind it in both (position). Only pairs
that pass are counted in full. Notices are few, so their index is broadcast and no text is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

#: Fixed value: words of lower-cased text.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose words stand one after the other, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Usual wordings of notices, in lower case, and their labels.
NOTICES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "copyright all rights reserved no part of this publication may be reproduced without prior written permission"),
]
NEW = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


@dataclass(frozen=True)
class Notice:
    """A template: its distinct tokens, the rarest first, and how many of them a block needs."""

    label: str
    tokens: tuple[str, ...]
    needed: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.tokens[: len(self.tokens) - self.needed + 1]


def lowered(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(LICENSE_WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def order_tokens(docs: DataFrame, notices: list[tuple[str, str]]) -> list[str]:
    """The notices' tokens by the number of documents holding them, ties by token: as many counts as tokens come here."""
    tokens = sorted({w for _, text in notices for w in text.split()})
    held = docs.select(F.explode(F.array_intersect(_strings(tokens), words_of(F.col("text")))).alias("token"))
    counts = {r.token: r["count"] for r in held.groupBy("token").count().collect()}
    return sorted(tokens, key=lambda w: (counts.get(w, 0), w))


def indexed(notices: list[tuple[str, str]], order: list[str], num: int, den: int) -> list[Notice]:
    place = {w: i for i, w in enumerate(order)}
    out = []
    for label, text in notices:
        tokens = tuple(sorted(set(text.split()), key=place.__getitem__))
        out.append(Notice(label, tokens, math.ceil(num * len(tokens) / den)))
    return out


def _phrase_places(words: Column, marked: Column, phrases: dict[str, str]) -> list[tuple[str, Column]]:
    """(label, word positions at which the phrase stands) for each phrase; ``marked`` holds the positions worth a look."""

    def stands(parts: list[str]):
        def at(i):
            hit = F.get(words, i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                hit &= F.coalesce(F.get(words, i + k) == part, F.lit(False))
            return hit

        return at

    return [(label, F.filter(marked, stands(phrase.split()))) for phrase, label in phrases.items()]


def scan(docs: DataFrame, notices: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, num: int = 8, den: int = 10, step: int = 32) -> DataFrame:
    """All columns of ``docs`` but ``text``, and those of NEW.

    n_words; n_base: places of all phrases; first_word and last_word: their smallest and
    largest start (null without any); base_labels: labels of the phrases found; labels: these and the labels of
    the notices of which some block holds at least ``num / den`` of the distinct words; score: 1 with a phrase, else the largest
    share of a notice found, 0 without any. Labels are distinct, sorted and joined by commas.

    ``step`` is raised to the longest notice's words. Null and empty text have no word; a text is read whole
    and each row judged by itself, so repeated rows have a result each and a null doc_id stays.
    Input columns with the new names are replaced; no other name clashes. An empty table gives no rows.
    """
    notices, phrases = NOTICES if notices is None else notices, PHRASES if phrases is None else phrases
    order = order_tokens(docs, notices)
    index = indexed(notices, order, num, den)
    step = max([step, *(len(text.split()) for _, text in notices)])
    anchors = sorted({p.split()[0] for p in phrases})
    rare = sorted({w for n in index for w in n.prefix})

    # the input's columns travel in one struct, so that none can clash with the working ones
    kept = [c for c in docs.columns if c != "text" and c.lower() not in NEW]
    rows = docs.select(F.struct(*kept, F.lit(0).alias(free_names(docs, 1)[0])).alias("row"), words_of(F.col("text")).alias("w"))
    at = lambda of: F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(of), i))) if of else F.array().cast("array<int>")
    rows = rows.select("row", "w", at(anchors).alias("anchors"), at(rare).alias("rare"))
    places = _phrase_places(F.col("w"), F.col("anchors"), phrases)
    found = F.flatten(F.array(*(p for _, p in places))) if places else F.array().cast("array<int>")
    labels = F.filter(F.array(*(F.when(F.size(p) > 0, label) for label, p in places)), lambda x: x.isNotNull()) if places else _strings([])
    blocks = F.array_distinct(F.filter(F.flatten(F.transform("rare", lambda i: F.array((i / step).cast("int"), (i / step).cast("int") - 1))), lambda b: b >= 0))
    rows = rows.select(
        F.monotonically_increasing_id().alias("uid"), "row", F.size("w").cast("long").alias("n_words"), found.alias("found"), labels.alias("base"),
        F.transform(blocks, lambda b: F.array_intersect(_strings(order), F.slice(F.col("w"), b * step + 1, F.lit(2 * step)))).alias("blocks"),
    )

    # each block's tokens come in the global order, which array_intersect takes from its first list
    pairs = rows.select("uid", "row", "n_words", "found", "base", F.explode_outer("blocks").alias("block"))
    pairs = pairs.select("*", F.posexplode_outer("block").alias("j", "token"))
    entries = [(n, i, w) for n in index for i, w in enumerate(n.prefix)]
    kind = "key string, i int, needed int, tokens array<string>, label string"
    prefixes = docs.sparkSession.createDataFrame([(w, i, n.needed, list(n.tokens), n.label) for n, i, w in entries], kind)
    length = F.size("block") >= F.col("needed")
    position = 1 + F.least(F.size("tokens") - 1 - F.col("i"), F.size("block") - 1 - F.col("j")) >= F.col("needed")
    pairs = pairs.join(F.broadcast(prefixes), (F.col("token") == F.col("key")) & length & position, "left")  # as many rows as the notices have words
    shared = F.size(F.array_intersect("tokens", "block"))
    hit = shared >= F.col("needed")
    pairs = pairs.select("uid", "row", "n_words", "found", "base", F.when(hit, F.col("label")).alias("label"), F.when(hit, shared / F.size("tokens")).alias("share"))

    # the rows of one text come from one task: nothing but a row for each text is shuffled
    one = pairs.groupBy("uid").agg(*(F.first(c).alias(c) for c in ("row", "n_words", "found", "base")), F.collect_set("label").alias("more"), F.max("share").alias("share"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return one.select(
        *(F.col("row")[c].alias(c) for c in kept), "n_words", F.size("found").cast("long").alias("n_base"), F.array_min("found").cast("long").alias("first_word"),
        F.array_max("found").cast("long").alias("last_word"), joined(F.col("base")).alias("base_labels"), joined(F.concat("base", "more")).alias("labels"),
        F.when(F.size("found") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
