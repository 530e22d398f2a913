"""Operator 4: license scans by diagonal voting.

Every two consecutive words of a text are hashed and joined to the places of
the same two words in license templates.  A match votes for the diagonal text
place less template place, so a template standing in the text gathers its votes
on one diagonal, or on neighbouring ones where words were put in or left out.
Votes are summed per diagonal, each diagonal is merged with its neighbours, and
the span is verified: of the matches, compared word by word, the longest
run that goes forward both in the text and in the template must hold enough of the
template's word pairs.  A place of the template counts once, however often the text has it.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 2
#: A span is a diagonal with those of its template this far from it or less.
SLACK = 6
#: Share of a template's word pairs that its span must hold in order.
COVERAGE = 0.7

# Phrases that name a license, and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# The opening terms of common licenses.
TEXTS = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
     "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
     "under the license is distributed on an as is basis without warranties or conditions of any kind either express "
     "or implied", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your option any later "
     "version", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
     "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
     "commercial or non commercial and by any means", "unlicense"),
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
     "transmit the software and to prepare derivative works of the software", "boost"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
     "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
     "restrictions", "zlib"),
]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The one letter outside A-Z that lower-casing turns into one of a-z: put aside before, by another that
#: stands in no template, so that only A-Z is folded where a template can tell.
KELVIN, OTHER = "\u212A", "\uFFFD"
#: Places of a template held by one long.
BITS = 62
#: Stands after the last word of every text and in no word: brings each row, and its count, to the end.
_END = "\u0001"


def template_pairs() -> list[tuple]:
    """(template, label, phrase?, pairs, place, word, next word); a few hundred rows, fixed by the lists above."""
    rows = [(0, None, False, 1, 0, _END, None)]
    for n, (text, label, phrase) in enumerate([(t, k, True) for t, k in PHRASES] + [(t, k, False) for t, k in TEXTS], 1):
        words = re.findall(WORD, text.lower())
        rows += [(n, label, phrase, len(words) - 1, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return rows


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: int = SLACK,
          coverage: float = COVERAGE) -> DataFrame:
    """Verified license spans of every text: (row, doc_id, template, label,
    phrase boolean, first_word, last_word, coverage), and for each row of
    ``docs`` one line with template 0 whose ``first_word`` is the text's number
    of words.  ``row`` tells repeated rows apart.

    A phrase is found where all its words stand consecutively; a longer text
    where ``coverage`` of its distinct word pairs stand in order on a diagonal of two
    votes or more and its neighbours, at most ``slack`` away.  Of spans that share
    diagonals the one that holds most is kept.  The pairs of a text are joined where they
    are scanned: the template side is a broadcast of a few hundred rows, and what is
    shuffled are votes already summed per text and diagonal, with the places they stand
    for as bits.
    """
    spark = docs.sparkSession
    rows = template_pairs()
    masks = [f"m{i}" for i in range(max(r[3] for r in rows) // BITS + 1)]
    templates = spark.createDataFrame(
        [(*r, *((1 << r[4] % BITS) * (r[4] // BITS == i) for i in range(len(masks)))) for r in rows],
        "template int, label string, phrase boolean, pairs int, place int, t1 string, t2 string, " + ", ".join(f"{m} long" for m in masks)
    ).withColumn("pair", F.xxhash64("t1", "t2"))
    words = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                         F.lower(F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(KELVIN), F.lit(OTHER))).alias("text"))
             .select("row", "doc_id", F.array_append(F.regexp_extract_all("text", F.lit(WORD), 0), _END).alias("words")))
    pairs = (words.select("row", "doc_id", "words", F.posexplode("words").alias("at", "w1"))
             .withColumn("w2", F.get("words", F.col("at") + 1)).drop("words")
             .withColumn("pair", F.xxhash64("w1", "w2")))
    whole = F.col("phrase") | (F.col("template") == 0)
    votes = (pairs.join(F.broadcast(templates), "pair")
             .filter((F.col("w1") == F.col("t1")) & F.col("w2").eqNullSafe(F.col("t2")))
             .groupBy("row", "doc_id", "template", "label", "phrase", "pairs", (F.col("at") - F.col("place")).alias("diagonal"))
             .agg(F.count("*").cast("int").alias("votes"), *[F.bit_or(m).alias(m) for m in masks], F.min("at").alias("first"))
             .filter(F.when(whole, F.col("votes") == F.col("pairs")).otherwise(F.col("votes") >= 2)))
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-slack, slack)
    enough = F.col("pairs") * F.lit(float(coverage))
    distinct = reduce(lambda a, b: a + b, [F.bit_count(F.bit_or(m).over(near)) for m in masks])
    return (votes.withColumn("distinct", distinct).withColumn("near", F.collect_list(F.struct("diagonal", *masks)).over(near))
            .filter(whole | (F.col("distinct") >= enough))
            .withColumn("run", F.when(whole, F.struct(F.col("pairs").alias("held"), "first", (-F.col("first") - F.col("pairs") + 1).alias("back")))
                        .otherwise(_longest_run(F.col("near"), F.col("pairs"), masks)))
            .filter(F.col("run.held") >= enough)
            .withColumn("rank", F.struct("run.held", "votes", (-F.col("diagonal")).alias("early")))
            .withColumn("best", F.max("rank").over(near)).filter(whole | (F.col("rank") == F.col("best")))
            .select("row", "doc_id", "template", "label", "phrase", F.col("run.first").cast("long").alias("first_word"),
                    (F.lit(1) - F.col("run.back")).cast("long").alias("last_word"), (F.col("run.held") / F.col("pairs")).alias("coverage")))


def _longest_run(near: Column, pairs: Column, masks: list[str]) -> Column:
    """Of the matches on diagonals ``near`` (each with the places matched on it, as bits), the most that go forward in text and template
    both: struct(held, first, back), ``first`` the first match's word and ``back`` the last one's, negated.

    ``best[i]`` is the longest run over template places below i.  Matches come in the
    order of the text, those at one word from the template's end on, so none follows another at its own word."""
    def on(diagonal: Column, p: Column) -> Column:
        return F.getbit(F.get(F.array(*[diagonal[m] for m in masks]), (p / BITS).cast("int")), p % BITS) == 1

    matches = F.array_sort(F.flatten(F.transform(near, lambda d: F.transform(
        F.filter(F.sequence(F.lit(0), pairs - 1), lambda p: on(d, p)),
        lambda p: F.struct((d["diagonal"] + p).alias("at"), (-p).alias("back"))))))

    def take(best: Column, match: Column) -> Column:
        before = F.get(best, -match["back"])
        longer = F.struct((before["held"] + 1).alias("held"), F.when(before["held"] == 0, match["at"]).otherwise(before["first"]).alias("first"),
                          (-match["at"]).alias("back"))
        return F.transform(best, lambda run, i: F.when(i > -match["back"], F.greatest(run, longer)).otherwise(run))

    none = F.struct(F.lit(0).alias("held"), F.lit(0).alias("first"), F.lit(0).alias("back"))
    return F.aggregate(matches, F.array_repeat(none, pairs + 1), take, lambda best: F.get(best, pairs))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base (places of the
    phrases), first_word and last_word (their smallest and largest start; null
    if none), base_labels, labels (with those of the longer texts; both
    distinct, sorted, comma-joined, empty if none), score (the largest coverage
    of a span, 0 if none).

    Null and empty texts have no words.  Repeated rows and null ids give a row
    each.  An empty table gives an empty result; extra columns are not read.
    """
    found = spans(docs, id_col, text_col)
    base = F.col("phrase")
    return (found.groupBy("row", "doc_id")
            .agg(F.max(F.when(F.col("template") == 0, F.col("first_word"))).alias("n_words"),
                 F.count_if(base).alias("n_base"),
                 F.min(F.when(base, F.col("first_word"))).alias("first_word"),
                 F.max(F.when(base, F.col("first_word"))).alias("last_word"),
                 F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
                 F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
                 F.coalesce(F.max(F.when(F.col("template") > 0, F.col("coverage"))), F.lit(0.0)).alias("score"))
            .drop("row").withColumnRenamed("doc_id", id_col))
