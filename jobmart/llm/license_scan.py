"""Licence texts and licence names in documents by diagonal voting.

All rolling word k-gram hashes of a text are joined to the positions they have in licence templates. A
hit votes for its diagonal, the offset between text and template; neighbouring diagonals are merged, so
that a few inserted or dropped words do not split a span, and spans are verified by how much of the
template they cover. Names are short templates of pairs of words that must be covered whole.

Everything is DataFrame expressions. The templates are fixed, so their table may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import row_hash, same, written
from jobmart.llm.grams import ascii_words, complete, rolled, word_hashes

# Names and labels that count wherever they stand.
NAMES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Openings and notices of public licences, as their publishers word them.
TEXTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: Words in a gram of a name and of a text.
NAME_WIDTH, TEXT_WIDTH = 2, 4

#: Diagonals at most this far apart are one span.
DRIFT = 3

#: Share of a text's grams that a span must cover, and of a span's length that must be grams of the text.
COVERED, DENSE = 0.5, 0.5


def templates(spark: SparkSession) -> DataFrame:
    """(gram, template, label, is_name, at, n_grams) of the names and texts above."""
    rows = [(i, label, text, width) for i, (label, text, width) in enumerate(
        [(v, k, NAME_WIDTH) for k, v in NAMES.items()] + [(v, k, TEXT_WIDTH) for v, k in TEXTS])]
    literal = F.array([F.struct(F.lit(i).alias("template"), F.lit(a).alias("label"), F.lit(t).alias("text"),
                                F.lit(w).alias("width")) for i, a, t, w in rows])
    words = spark.range(1).select(F.inline(literal)).withColumn("words", ascii_words(F.col("text")))
    parts = []
    for width in (NAME_WIDTH, TEXT_WIDTH):
        some = words.where(F.col("width") == width).withColumn("grams", word_hashes(F.col("words")))
        some = rolled(some, "grams", width).withColumn("grams", complete(F.col("grams"), F.size("words"), width))
        parts.append(some.select(
            "template", "label", (F.col("width") == NAME_WIDTH).alias("is_name"), F.size("grams").alias("n_grams"),
            F.posexplode("grams").alias("at", "gram"),
        ))
    return parts[0].unionByName(parts[1])


def votes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, template, label, is_name, n_grams, place, at): one row per gram that meets a template."""
    hashes = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"),
        word_hashes(ascii_words(F.col(text))).alias("pairs"),
    )
    pairs = rolled(hashes, "pairs", NAME_WIDTH)
    both = rolled(pairs.withColumn("grams", F.col("pairs")), "grams", TEXT_WIDTH, NAME_WIDTH)
    # Both widths in one array: a pair and a gram of four words never have the same hash input.
    every = both.select(
        "doc_id", "row", F.size("pairs").alias("n"), F.posexplode(F.concat("pairs", "grams")).alias("k", "gram")
    )
    hits = every.join(F.broadcast(templates(docs.sparkSession)), "gram")
    place = F.when(F.col("k") < F.col("n"), F.col("k")).otherwise(F.col("k") - F.col("n"))
    return hits.where(F.col("is_name") == (F.col("k") < F.col("n"))) \
        .select("doc_id", "row", "template", "label", "is_name", "n_grams", place.alias("place"), "at").distinct()


def spans(found: DataFrame) -> DataFrame:
    """(doc_id, row, template, label, is_name, first, last, covered, verified) from the votes."""
    key = ["doc_id", "row", "template", "label", "is_name", "n_grams"]
    diagonals = found.withColumn("diagonal", F.col("place") - F.col("at")).groupBy(*key, "diagonal").agg(
        F.collect_set("at").alias("at"),  # positions in one template
        F.min("place").alias("first"), F.max("place").alias("last"),
    )
    names = diagonals.where("is_name").where(F.size("at") == F.col("n_grams"))
    names = names.select(*key, "first", "last", F.lit(1.0).alias("covered"), F.lit(True).alias("verified"))
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order), F.lit(DRIFT + 1)) > DRIFT
    merged = diagonals.where("not is_name").withColumn("new", apart.cast("int")) \
        .withColumn("span", F.sum("new").over(order)).groupBy(*key, "span").agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("at")))).alias("hits"),
            F.min("first").alias("first"), F.max("last").alias("last"))
    covered = F.col("hits") / F.col("n_grams")
    dense = F.col("hits") / (F.col("last") - F.col("first") + 1)
    texts = merged.select(*key, "first", "last", covered.alias("covered"), ((covered >= COVERED) & (dense >= DENSE)).alias("verified"))
    return names.unionByName(texts)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Names count at every place; ``labels`` adds those of verified texts. ``score`` is the largest share
    of a template that one span covers. A NULL or empty text has no words, labels '' and score 0. Rows
    with one id are told apart by their text; rows repeated in full get the same result each.
    """
    is_name = F.col("is_name")
    found = spans(written(votes(docs, doc_id, text), "license-votes")).groupBy("doc_id", "row").agg(
        F.count(F.when(is_name, 1)).alias("n_base"),
        F.min(F.when(is_name, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(is_name, F.col("first"))).cast("long").alias("last_word"),
        F.collect_set(F.when(is_name, F.col("label"))).alias("base"),
        F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("all"),
        F.max("covered").alias("score"),
    ).withColumnsRenamed({"doc_id": "found_id", "row": "found_row"})
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"),
        F.size(ascii_words(F.col(text))).cast("long").alias("n_words"),
    )
    on = same(rows["doc_id"], found["found_id"]) & (rows["row"] == found["found_row"])
    return rows.join(found, on, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce(_joined(F.col("base")), F.lit("")).alias("base_labels"),
        F.coalesce(_joined(F.col("all")), F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
