"""License scans by diagonal voting.

A license template is a sequence of words. Every rolling k-gram of a text's
words that is also a template's k-gram votes for a diagonal, its place in the
text minus its place in the template: an occurrence of the template is many
votes for one diagonal, and an inserted or dropped word moves the rest to a
neighbouring one. All of it is DataFrame operations.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qlens.llm.common import text_or_empty

# Phrases whose every verbatim occurrence counts, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Public license notices, which may occur with changes, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under a creative commons attribution": "cc-by",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    # whole license texts, without headings and names
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc",
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASE_GRAM, NOTICE_GRAM = 2, 4
SENT_GRAMS = 100_000
# Diagonals this near are merged; a notice is found if this share of its k-grams is, within a span that isn't stretched more.
SHIFT = 3
SHARE = 0.6
STRETCH = 1.5


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def templates(spark: SparkSession, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """One row for each k-gram of each template: template, label, phrase, k, grams (of the template), at, gram, pair (hash of its first two words).

    Templates are any texts and their labels; they are read as ``words`` reads
    a text. Those with too few words for a k-gram can't occur. Few k-grams are
    marked for broadcast; more than ``SENT_GRAMS`` join as Spark finds best.
    """
    rows = []
    for n, (text, label, phrase) in enumerate([*((t, v, True) for t, v in phrases.items()), *((t, v, False) for t, v in notices.items())]):
        own, k = re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER))), PHRASE_GRAM if phrase else NOTICE_GRAM
        for at in range(len(own) - k + 1):
            gram = " ".join(own[at : at + k])
            rows.append(f"({n}, '{label}', {str(phrase).lower()}, {k}, {len(own) - k + 1}, {at}, '{gram}', '{own[at]}', '{own[at + 1]}')")
    listed = f"VALUES {', '.join(rows)}" if rows else "VALUES (0, '', true, 2, 1, 0, '', '', '') LIMIT 0"
    frame = spark.sql(f"SELECT * FROM ({listed}) AS t(template, label, phrase, k, grams, at, gram, first, second)")
    frame = frame.withColumn("pair", F.xxhash64("first", "second")).drop("first", "second")
    return F.broadcast(frame) if len(rows) <= SENT_GRAMS else frame


def grams(docs: DataFrame) -> DataFrame:
    """(doc_id, body, n_words, pos, w1..w4): each word of a text with the three that follow.

    ``body`` is a hash of the text, to tell rows of one id apart. The first row of
    a text also has its number of words, so that it is taken apart only once; a text without words is that row alone.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("body"), words(text_or_empty()).alias("w"))
    size = F.greatest(F.size("w"), F.lit(1))
    beside = F.arrays_zip(
        F.col("w").alias("w1"), *[F.slice("w", F.lit(k), size).alias(f"w{k}") for k in range(2, NOTICE_GRAM + 1)]
    )
    exploded = rows.select("doc_id", "body", F.size("w").cast("bigint").alias("n_words"), F.posexplode_outer(beside).alias("pos", "g"))
    first = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("n_words")).alias("n_words")
    return exploded.select("doc_id", "body", first, "pos", *[F.col(f"g.w{k}").alias(f"w{k}") for k in range(1, NOTICE_GRAM + 1)])


def votes(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """(doc_id, body, template, label, phrase, k, grams, diagonal, found, first, last, n_words): votes of each diagonal.

    ``found`` lists the template's k-grams seen on it, at most as many as the
    template has. The k-grams of texts are never shuffled with broadcast templates; only
    hits are, and the one row of each text that has its ``n_words``.
    """
    rolling = grams(docs).withColumn("pair", F.xxhash64("w1", "w2"))
    same = F.col("gram") == F.when(F.col("k") == PHRASE_GRAM, F.concat_ws(" ", "w1", "w2")).otherwise(F.concat_ws(" ", "w1", "w2", "w3", "w4"))
    hits = rolling.join(listed.withColumnRenamed("pair", "own"), (F.col("pair") == F.col("own")) & same, "left")
    hits = hits.filter(F.col("template").isNotNull() | F.col("n_words").isNotNull())
    return (
        hits.withColumn("diagonal", F.col("pos") - F.col("at"))
        .groupBy("doc_id", "body", "template", "label", "phrase", "k", "grams", "diagonal")
        .agg(F.collect_set("at").alias("found"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("n_words").alias("n_words"))
    )


def bands(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """(doc_id, body, label, phrase, start, end, score, n_words, verified): neighbouring diagonals together.

    A phrase needs every k-gram on one diagonal, so its words stand there in
    a row. A notice needs ``SHARE`` of its k-grams on neighbouring diagonals,
    close enough together; ``score`` is that share.
    """
    by_template = Window.partitionBy("doc_id", "body", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_template)
    score, length = F.col("n") / F.col("grams"), F.col("end") - F.col("start")
    close = length <= STRETCH * (F.col("grams") + F.col("k") - 1)
    verified = F.when(F.col("phrase"), F.col("n") == F.col("grams")).otherwise((score >= SHARE) & close)
    return (
        votes(docs, listed)
        .withColumn("band", (F.col("phrase") | gap.isNull() | (gap > SHIFT)).cast("int"))
        .withColumn("band", F.sum("band").over(by_template))
        .groupBy("doc_id", "body", "template", "label", "phrase", "k", "grams", "band")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n"),
            F.min("first").alias("start"),
            (F.max("last") + F.first("k")).alias("end"),
            F.max("n_words").alias("n_words"),
        )
        .select("doc_id", "body", "label", "phrase", "start", "end", score.alias("score"), "n_words", F.coalesce(verified, F.lit(False)).alias("verified"))
    )


def spans(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """(doc_id, body, label, phrase, start, end, score): verified occurrences, in words from 0, end exclusive."""
    found = bands(docs, templates(docs.sparkSession, phrases, notices)).filter("verified")
    return found.select("doc_id", "body", "label", "phrase", "start", "end", "score")


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``phrases`` count wherever they stand word for word, ``notices`` may be
    changed; both map texts to labels. Null texts count as empty; without an
    occurrence the places are null, the labels empty and the score 0. Repeated
    rows stay, each with the same result; an empty table stays empty.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("body"))
    base, ok = F.col("phrase") & F.col("verified"), F.col("verified")
    found = bands(docs, templates(docs.sparkSession, phrases, notices))
    sums = found.groupBy(F.col("doc_id").alias("id"), F.col("body").alias("b")).agg(
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(ok, F.col("score"))), F.lit(0.0)).alias("score"),
    )
    joined = rows.join(sums, rows["doc_id"].eqNullSafe(sums["id"]) & (rows["body"] == sums["b"]))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
