"""License scans by diagonal voting.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Templates are word
sequences with a label: short phrases that must stand whole, and notices that may differ a little.
Every rolling word k-gram of a text meets the template positions that hold it (a Spark join on the
gram's hash and words); the hits vote for (text, template, diagonal), where the diagonal is word
position minus template position. Diagonals at most ``GAP`` apart are merged, so that a few added
or missing words don't split a notice, and a merged band is verified: the share of the template's
words that its hits cover must reach ``min_cover``.

Tasks drop at once the grams that no template holds, by a hash set of all template grams; its size
is that of the templates. What is shuffled are hits only, first joined within the text's task and
then grouped by text, so a notice found in a third of all texts spreads over all tasks.

The score of a text is the largest verified share, 1 if a base phrase stands in it.

Defined cases: null or empty texts have no words, no labels and score 0. Every row is a text of
its own, whatever its doc_id; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.phrases import Phrases, item_windows
from waybill.llm.storage import kept
from waybill.llm.texts import ALNUM, groups, utf8, words

K = 4
GAP = 3
MIN_COVER = 0.7
GROUP = 4 << 20

# Phrases that count wherever their words stand consecutively.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public license notices, in their own words.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies"),
]


def template_positions(notices: list[tuple[str, str]], k: int) -> list[tuple]:
    """(template, label, words of the template, words of the gram, position, gram)."""
    out = []
    sizes = [len(w[0].split(b" ")) if w else 0
             for w in item_windows(pa.array([t for _, t in notices]), 1 << 30)]
    for i, grams in enumerate(item_windows(pa.array([t for _, t in notices]), k)):
        for at, gram in enumerate(grams):
            out.append((i, notices[i][0], sizes[i], min(k, sizes[i]), at, bytearray(gram)))
    return out


def scan(docs: DataFrame, notices: list[tuple[str, str]], base: dict[str, str], k: int
         ) -> DataFrame:
    """A row a text: its id, number of words, the base phrases' places and the gram hits."""
    phrases = [w[0] for w in item_windows(pa.array(list(base)), 1 << 30)]
    wanted = [bytes(x[5]) for x in template_positions(notices, k)]
    labels = {p: label for p, label in zip(phrases, base.values(), strict=True)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basic, noted = Phrases(phrases), Phrases(wanted)
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            rows, counts, firsts, lasts, names, sizes, at_all, gram_all = ([] for _ in range(8))
            hit_offsets = [0]
            for lo, hi in groups(offsets, GROUP):
                part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                h, begin, end, ranges = words(part, at, ALNUM)
                text, first, _, entry = basic.find(h, ranges, part, begin, end)
                cut = np.searchsorted(text, np.arange(hi - lo + 1))
                t2, first2, _, entry2 = noted.find(h, ranges, part, begin, end)
                cut2 = np.searchsorted(t2, np.arange(hi - lo + 1))
                for t in range(hi - lo):
                    own = first[cut[t]:cut[t + 1]]
                    rows.append((task << 40) + row)
                    row += 1
                    counts.append(len(own))
                    firsts.append(int(own.min()) if len(own) else None)
                    lasts.append(int(own.max()) if len(own) else None)
                    names.append(sorted({labels[basic.entries[e]]
                                         for e in entry[cut[t]:cut[t + 1]].tolist()}))
                    sizes.append(int(ranges[t + 1] - ranges[t]))
                    at_all += first2[cut2[t]:cut2[t + 1]].tolist()
                    gram_all += [noted.entries[e] for e in entry2[cut2[t]:cut2[t + 1]]]
                    hit_offsets.append(len(at_all))
            hits = pa.ListArray.from_arrays(
                pa.array(hit_offsets, pa.int32()),
                pa.StructArray.from_arrays([pa.array(at_all, pa.int64()),
                                            pa.array(gram_all, pa.binary())], ["at", "gram"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(firsts, pa.int64()),
                 pa.array(lasts, pa.int64()), pa.array(names, pa.list_(pa.string())), hits],
                ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base", "hits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, "
              "base array<string>, hits array<struct<at: long, gram: binary>>")


def spans(spark: SparkSession, scanned: DataFrame, notices: list[tuple[str, str]],
          k: int = K, gap: int = GAP, min_cover: float = MIN_COVER) -> DataFrame:
    """Verified notices: row, label, first and last word, share of the template's words."""
    templates = spark.createDataFrame(
        template_positions(notices, k),
        "template int, label string, size int, k int, at long, gram binary").select(
        "template", "label", "size", "k", F.col("at").alias("t_at"), F.xxhash64("gram").alias("h"),
        F.col("gram").alias("t_gram"))
    grams = (scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("x"))
             .select("row", "x.at", "x.gram", F.xxhash64("x.gram").alias("h")))
    votes = (grams.join(templates, "h").where(F.col("gram") == F.col("t_gram"))
             .groupBy("row", "template", "label", "size", "k",
                      (F.col("at") - F.col("t_at")).alias("diagonal"))
             .agg(F.min("at").alias("first"), F.max(F.col("at") + F.col("k") - 1).alias("last"),
                  F.collect_set("t_at").alias("places")))
    line = Window.partitionBy("row", "template").orderBy("diagonal", "first")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > gap, F.lit(True))
    bands = votes.withColumn("new", far.cast("long")).withColumn("band", F.sum("new").over(line))
    return (bands.groupBy("row", "template", "label", "size", "band")
            .agg(F.min("first").alias("first_word"), F.max("last").alias("last_word"),
                 F.flatten(F.collect_list("places")).alias("places"), F.first("k").alias("k"))
            .withColumn("cover", F.size(F.array_distinct(F.flatten(F.transform(
                "places", lambda t: F.sequence(t, t + F.col("k") - 1))))) / F.col("size"))
            .where(F.col("cover") >= min_cover)
            .select("row", "label", "first_word", "last_word", "cover"))


def license_scan(docs: DataFrame, notices: list[tuple[str, str]] | None = None,
                 base: dict[str, str] | None = None, k: int = K, gap: int = GAP,
                 min_cover: float = MIN_COVER) -> tuple[DataFrame, DataFrame]:
    """A row a text, with its labels and score, and the verified spans behind the labels."""
    notices = NOTICES if notices is None else notices
    base = BASE if base is None else base
    scanned = kept(scan(docs, notices, base, k), "license-hits")
    found = spans(docs.sparkSession, scanned, notices, k, gap, min_cover)
    by_row = found.groupBy("row").agg(F.collect_set("label").alias("found"),
                                      F.max("cover").alias("cover"))
    nothing = F.array().cast("array<string>")
    texts = scanned.drop("hits").join(by_row, "row", "left").select(
        "row", "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_sort("base").alias("base"),
        F.array_sort(F.array_union("base", F.coalesce("found", nothing))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0)))
        .cast("double").alias("score"))
    return texts, found


def digest(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")

