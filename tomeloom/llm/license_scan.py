"""License scans by diagonal voting, with DataFrame functions only.

Rolling hashes of three words of all documents are joined with those of the notice templates (broadcast up to
BROADCAST_GRAMS of them); the three words themselves are compared too. Each hit votes for a diagonal, word place
minus template place, of its document and template. Neighbouring diagonals (a word put in or left out) are
merged to spans, and a span counts if it covers enough of the template and isn't stretched too far. Base
phrases are looked for at every word at the same time.

Defined cases: a null or empty text has 0 words and no labels; null places are null; rows that agree in doc_id and text
get the same result, each its own row; labels are distinct, sorted and joined by commas (empty if none);
score is 1 with a base label, else the largest share of a template that a span covers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, text_key, word_array

PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Notices as words, and the label that the method gives.
TEMPLATES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("you can redistribute it and or modify it under the terms of the gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "epl"),
    ("distributed under the boost software license version 1 0", "bsl-1.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("all rights reserved", "all-rights-reserved"),
]
GRAM, BROADCAST_GRAMS = 3, 200_000


def scan(docs: DataFrame, phrases=None, templates=None, cover: float = 0.75, stretch: float = 1.5, gap: int = 2) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans (label, first, last, cover) of each row."""
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    spark = docs.sparkSession
    grams = [(w[i], w[i + 1], w[i + 2], t, i) for t, (text, _) in enumerate(templates) for w in [text.split()] for i in range(len(w) - GRAM + 1)]
    table = spark.createDataFrame(grams, "g0 string, g1 string, g2 string, tid int, tpos int")
    at = table.groupBy(F.xxhash64("g0", "g1", "g2").alias("h"), "g0", "g1", "g2").agg(F.collect_list(F.struct("tid", "tpos")).alias("votes"))
    named = spark.createDataFrame([(t, label, len(text.split())) for t, (text, label) in enumerate(templates)], "tid int, label string, size int")

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    each = rows.select("doc_id", text_key(F.col("text")).alias("key"), word_array(F.col("text")).alias("words"))
    each = each.select("doc_id", "key", "words", F.posexplode_outer("words").alias("pos", "w0"))  # a plain explode would build words twice
    word = lambda i: F.get("words", F.col("pos") + i)
    starts = [(label, F.col("w0") == p[0], [word(i) == x for i, x in enumerate(p) if i]) for text, label in phrases for p in [text.split()]]
    base = F.lit(0).cast("long")  # a bit for each phrase: no function here leaves generated code, so rows share their document's array
    for i, (_, first, rest) in enumerate(starts):
        base = base.bitwiseOR(F.when(first & _all(rest), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    each = each.select("doc_id", "key", "pos", base.alias("base"), "w0", word(1).alias("w1"), word(2).alias("w2"))
    same = (F.xxhash64("w0", "w1", "w2") == F.col("h")) & (F.col("w0") == F.col("g0")) & (F.col("w1") == F.col("g1")) & (F.col("w2") == F.col("g2"))
    small = F.broadcast if len(grams) <= BROADCAST_GRAMS else lambda df: df
    hits = each.join(small(at), same, "left").where("base > 0 or votes is not null")
    hits = stored(hits.select("doc_id", "key", F.col("pos").cast("long").alias("pos"), "base", "votes").distinct(), "license-hits")

    key = ["doc_id", "key"]
    labels = F.array_compact(F.array(*[F.when(F.col("base").bitwiseAND(F.lit(1 << i).cast("long")) > 0, F.lit(label)) for i, (label, _, _) in enumerate(starts)]))
    base = hits.where("base > 0").select(*key, "pos", F.explode(labels).alias("label"))
    base = base.groupBy(*key).agg(F.count("*").alias("n_base"), F.min("pos").alias("first_word"), F.max("pos").alias("last_word"), F.collect_set("label").alias("base"))

    votes = hits.where("votes is not null").select(*key, "pos", F.inline("votes")).withColumn("diag", F.col("pos") - F.col("tpos"))
    diag = votes.groupBy(*key, "tid", "diag").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("tpos").alias("tposes"))
    by = Window.partitionBy(*key, "tid").orderBy("diag")
    new = F.coalesce(F.col("diag") - F.lag("diag").over(by) > gap, F.lit(True)).cast("int")
    diag = diag.withColumn("new", new).withColumn("span", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    spans = diag.groupBy(*key, "tid", "span").agg(F.min("first").alias("first"), (F.max("last") + GRAM - 1).alias("last"), F.array_distinct(F.flatten(F.collect_list("tposes"))).alias("tposes"))
    spans = spans.join(small(named), "tid")
    covered = F.size(F.array_distinct(F.flatten(F.transform("tposes", lambda t: F.sequence(t, t + GRAM - 1)))))
    spans = spans.withColumn("cover", F.round(covered / F.col("size"), 6)).withColumn("good", (F.col("cover") >= cover) & (F.col("last") - F.col("first") + 1 <= F.col("size") * stretch))
    method = spans.groupBy(*key).agg(F.max("cover").alias("best"), F.collect_set(F.when(F.col("good"), F.col("label"))).alias("more"), F.collect_list(F.when(F.col("good"), F.struct("label", "first", "last", "cover"))).alias("spans"))

    other = method.withColumnsRenamed({"doc_id": "other_id", "key": "other_key"})
    result = base.join(other, (F.col("key") == F.col("other_key")) & F.col("doc_id").eqNullSafe(F.col("other_id")), "full")
    result = result.select(F.coalesce("doc_id", "other_id").alias("d"), F.coalesce("key", "other_key").alias("k"), "n_base", "first_word", "last_word", "base", "more", "best", "spans")
    out = rows.select("doc_id", text_key(F.col("text")).alias("key"), n_words(F.col("text")).alias("n_words"))
    out = out.join(result, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    none = F.array().cast("array<string>")
    base, more = F.coalesce("base", none), F.coalesce("more", none)
    score = F.when(F.coalesce("n_base", F.lit(0)) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word", F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"), score.alias("score"), "spans")


def _all(conditions):
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out
