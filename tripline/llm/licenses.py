"""License scan: an exact set-similarity join of text blocks with licence notices.

A block is a line, or what lies around a line break of a paragraph: as many words before and after
it as the longest notice has, so that a notice wrapped over lines lies whole in a block. A block's
words are matched with a notice's as sets, and the notice is found where the block holds at least
``CONTAINMENT`` of its words. Words are ordered by their frequency in
the whole corpus, rarest first. A block that holds enough of a notice must share a word with
the notice's prefix, the rarest few, and within its own prefix: only such pairs are joined.
The number of the block's words and the positions of the shared word bound the overlap that is
still possible and drop pairs that cannot reach the threshold; the rest are verified.

Everything is built from DataFrame functions. The notices are a parameter of a few hundred
words; nothing else is broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import lower_ascii, staged

#: Phrases to find word by word, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Usual notices of public licences, and their labels.
NOTICES = (
    ("mit", "released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the Software), to deal in the Software without restriction",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the"
        " GNU General Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "licensed under the BSD 3-Clause License"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
CONTAINMENT = 0.8
#: Whatever is no word character, before and after lower-casing A-Z.
BETWEEN_RAW = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Lines without words between two paragraphs.
GAP = "\\n[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*\\n"
WORD_RAW = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """The lower-cased words of a text, in order."""
    return F.filter(F.split(lower_ascii(text), BETWEEN), lambda w: w != "")


def _words_of(notice: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in notice.lower()).split()


def _set_of(notice: str) -> list[str]:
    return list(dict.fromkeys(_words_of(notice)))


def _starts(each: Column, phrase: list[str], label: str) -> Column:
    """Structs of the places where one phrase starts among the words ``each``."""

    def start(word: Column, place: Column) -> Column:
        whole = F.concat_ws(" ", F.slice(each, place + 1, len(phrase))) == " ".join(phrase)
        return F.when((word == phrase[0]) & whole, place)

    found = F.filter(F.transform(each, start), lambda place: place.isNotNull())
    return F.transform(found, lambda place: F.struct(place.cast("long").alias("place"), F.lit(label).alias("label")))


def phrase_places(text: Column) -> Column:
    """Structs ``(place, label)`` of every place where a phrase's words stand together.

    Words are only split where a pattern has found the phrase.
    """
    empty = F.array().cast("array<struct<place:bigint,label:string>>")
    places = []
    for phrase, label in PHRASES.items():
        own = phrase.split()
        pattern = f"(?i){BETWEEN_RAW.join(own)}"  # may start or end within a word
        places.append(F.when(text.rlike(pattern), _starts(words(text), own, label)).otherwise(empty))
    return F.concat(*places)


def _frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the notices occurs in all texts: at most a row per such word."""
    each = docs.select(F.explode(F.split(lower_ascii(F.col(text)), BETWEEN)).alias("word"))
    rows = each.where(F.col("word").isin(vocabulary)).groupBy("word").count().collect()
    return {r["word"]: r["count"] for r in rows}


def _around_breaks(texts: DataFrame, text: str, longest: int, may_match) -> DataFrame:
    """``(id, number, words)`` of the blocks around line breaks within paragraphs.

    A line of a paragraph has a word, so ``longest`` lines on either side are enough. Numbers are
    negative, unlike those of lines.
    """
    parts = texts.where(F.instr(text, "\n") > 0)
    parts = parts.select("id", F.posexplode(F.split(F.col(text), GAP)).alias("part", "block"))
    parts = parts.where((F.instr("block", "\n") > 0) & may_match("block"))
    lines = F.transform(F.split("block", "\n"), words)
    ends = F.transform(lines, lambda w: F.slice(w, F.greatest(F.size(w) - longest + 1, F.lit(1)), longest))
    heads = F.transform(lines, lambda w: F.slice(w, 1, longest))
    parts = parts.select("id", "part", ends.alias("ends"), heads.alias("heads"))
    each = parts.select("*", F.explode(F.sequence(F.lit(1), F.size("ends") - 1)).alias("line"))
    low = F.greatest(F.col("line") - longest + 1, F.lit(1))
    before = F.flatten(F.slice("ends", low, F.col("line") - low + 1))
    before = F.slice(before, F.greatest(F.size(before) - longest + 1, F.lit(1)), longest)
    after = F.slice(F.flatten(F.slice("heads", F.col("line") + 1, F.lit(longest))), 1, longest)
    number = -(F.shiftleft(F.col("part").cast("long"), 32) + F.col("line"))
    return each.select("id", number.alias("number"), F.concat(before, after).alias("words"))


def matches(
    docs: DataFrame, text: str, containment: float, notices: tuple[tuple[str, str], ...]
) -> DataFrame:
    """``(id, number, label, contained, matched)`` for every block, notice pair at the threshold.

    ``docs`` has a column ``id``; ``number`` tells its blocks apart, ``contained`` is the share of
    the notice's words and ``matched`` are these. A pair may come once for each prefix word it shares.
    """
    spark = docs.sparkSession
    sets = [(label, _set_of(notice)) for label, notice in notices]
    vocabulary = sorted({w for _, own in sets for w in own})
    counts = _frequencies(docs, text, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index, prefix_words = [], set()
    for number, (label, own) in enumerate(sets):
        ranks = sorted(rank[w] for w in own)
        needed = math.ceil(containment * len(ranks) - 1e-9)
        for position, r in enumerate(ranks[: len(ranks) - needed + 1], 1):
            index.append((r, number, label, position, needed, ranks))
            prefix_words.add(order[r])
    kinds = "token int, notice int, label string, at int, needed int, ranks array<int>"
    index = F.broadcast(spark.createDataFrame(index, kinds))  # a row per prefix word of a notice

    prefixes = F.array(*map(F.lit, sorted(prefix_words)))

    def may_match(column: str) -> Column:
        return F.arrays_overlap(F.split(lower_ascii(F.col(column)), BETWEEN), prefixes)

    texts = docs.where(may_match(text))
    blocks = texts.select("id", F.posexplode(F.split(F.col(text), "\n")).alias("number", "block"))
    blocks = blocks.where(may_match("block"))
    blocks = blocks.select("id", F.col("number").cast("long").alias("number"), words(F.col("block")).alias("words"))
    longest = max((len(_words_of(notice)) for _, notice in notices), default=1)
    blocks = blocks.union(_around_breaks(texts, text, longest, may_match))
    known = F.array_intersect("words", F.array(*map(F.lit, vocabulary)))
    place = F.create_map(*(F.lit(x) for pair in rank.items() for x in pair))
    blocks = blocks.select(
        "id", "number", F.array_sort(F.transform(known, lambda w: F.element_at(place, w))).alias("tokens")
    )
    size = F.size("tokens")
    blocks = blocks.withColumn("size", size).select(
        "id", "number", "tokens", "size", F.posexplode("tokens").alias("before", "token")
    )
    position = F.col("before") + 1
    possible = F.least(F.size("ranks") - F.col("at"), F.col("size") - position) + 1
    pairs = (
        blocks.join(index, "token")
        .where(F.col("size") >= F.col("needed"))  # length filter
        .where(position <= F.col("size") - F.col("needed") + 1)  # the block's own prefix
        .where(possible >= F.col("needed"))  # positional filter
    )
    overlap = F.size("matched")
    verified = pairs.withColumn("matched", F.array_intersect("tokens", "ranks")).where(overlap >= F.col("needed"))
    return verified.select("id", "number", "label", (overlap / F.size("ranks")).alias("contained"), "matched")


def scan(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    containment: float = CONTAINMENT,
    notices: tuple[tuple[str, str], ...] = NOTICES,
) -> DataFrame:
    """``(key, n_words, places, labels, score)`` for every row of ``docs``.

    ``places`` are the word positions of the phrases with their labels; ``labels``, sorted and
    distinct, are those of phrases and of all notices that a block contains to the threshold, but
    for a notice whose words found there are all words of another that the block contains more of;
    ``score`` is the largest share of a notice's words found so, 1 where a phrase stands, 0 for
    neither. Blocks are lines of whole texts, and what lies around the line breaks of paragraphs.

    Null and empty texts have no words, labels or places and score 0. Repeated rows are each
    answered; a null key is a key like any other. Other columns are not read; an empty table
    gives no rows.
    """
    own = F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))
    narrow = docs.select(own.alias("id"), F.col(text).alias("text"))
    found = matches(narrow, "text", containment, notices)
    match = F.struct("label", "contained", "matched")
    found = found.groupBy("id", "number").agg(F.collect_set(match).alias("all"))  # at most one per notice

    def fuller(m: Column) -> Column:
        def holds(o: Column) -> Column:
            return (o["contained"] > m["contained"]) & (F.size(F.array_except(m["matched"], o["matched"])) == 0)

        return F.exists("all", holds)

    found = found.select("id", F.explode(F.filter("all", lambda m: ~fuller(m))).alias("m")).select("id", "m.*")
    found = found.groupBy("id").agg(F.collect_set("label").alias("more"), F.max("contained").alias("most"))
    found = found.select(F.col("id.key").alias("k"), F.col("id.hash").alias("h"), "more", "most")
    local = narrow.select(
        F.col("id.key").alias("key"),
        F.col("id.hash").alias("hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_RAW)), F.lit(0)).cast("long").alias("n_words"),
        phrase_places(F.coalesce("text", F.lit(""))).alias("places"),
    )
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h"))
    joined = local.join(staged(found, "licenses"), same, "left")
    base = F.transform("places", lambda p: p["label"])
    labels = F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0)))
    return joined.select(
        F.col("key").alias(key), "n_words", "places", labels.alias("labels"), score.alias("score")
    )
