"""Licence scans over a positional rare-token index, in DataFrame functions only.

Licence templates are word sequences, each with a mandatory key phrase in it. Their words make an
index: word -> (template, position). One scan of the texts gives every document's words and counts
in how many documents each licence word occurs. Of each key phrase the word of highest inverse
document frequency is the one looked up: where it stands in a file, its postings propose
(template, start). The template's other words are intersected at the same relative position, and a
proposal holds if every word of the key phrase is in its place. No occurrence of a key phrase is
missed, as each contains its rarest word. A template's share of words in place is its score.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. NULL and empty
texts have no words and get empty labels and score 0. Repeated rows give repeated results, a NULL
doc_id stays NULL, other columns are not looked at, and an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flowlake.llm.common import lower_ascii, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A label's word sequence; ``key`` is the mandatory part of it, ``probe`` a word of the key."""

    label: str
    words: str
    key: str
    probe: str
    base: bool = False


# The base phrases with their labels.
BASE = (
    Template("mit", "mit license", "mit license", "license", True),
    Template("apache", "apache license", "apache license", "license", True),
    Template("gpl", "general public license", "general public license", "license", True),
)
# Wording of public licences.
TEMPLATES = BASE + (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "granted free of charge to any person obtaining a copy of this software", "obtaining"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0", "license"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license", "compliance"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2", "license"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3", "license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the", "free software you can redistribute it and or modify it", "redistribute"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license", "license"),
    Template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license", "license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    Template("bsd", "released under the bsd license", "bsd license", "license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted", "hereby"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license", "license"),
    Template("cc-by", "licensed under cc by 4 0", "licensed under cc by 4 0", "licensed"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "licensed under cc by sa 4 0", "licensed"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "licensed under cc by nc 4 0", "licensed"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "licensed under cc by nd 4 0", "licensed"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial", "commons"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights", "has waived all copyright and related or neighboring rights", "waived"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain", "unencumbered"),
    Template("proprietary", "all rights reserved", "all rights reserved", "reserved"),
)


def _index(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(word, template, at, size, label, base, key_at, key_size): a row per template word."""
    rows = []
    for number, t in enumerate(templates):
        words, key = t.words.split(), t.key.split()
        begin = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        if t.probe not in key:
            raise ValueError(f"the probe {t.probe!r} is not in the key phrase")
        rows += [(w, number, i, len(words), t.label, t.base, begin, len(key)) for i, w in enumerate(words)]
    return spark.createDataFrame(
        rows, "word string, template int, at int, size int, label string, base boolean, key_at int, key_size int"
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spark = docs.sparkSession
    index = _index(spark, templates)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for t in templates for w in t.words.split()})])
    probes = F.array(*[F.lit(w) for w in sorted({t.probe for t in templates})])
    text = lower_ascii(F.coalesce(docs["text"], F.lit("")))
    words = F.array_remove(F.split(text, SEPARATORS), "")
    # Word arrays are kept of files that may hold a key phrase; of the others, counts only.
    files = written(
        docs.select(docs["doc_id"].alias("doc_id"), words.alias("words")).select(
            F.monotonically_increasing_id().alias("file"), "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.array_intersect("words", vocabulary).alias("present"),
            F.when(F.arrays_overlap("words", probes), F.col("words")).alias("words"),
        ),
        "licence-files",
    )
    rarest = _rarest(files, index)
    places = files.filter("words IS NOT NULL").select("file", F.posexplode("words").alias("place", "word"))
    # Template tables have a row per template word: their size does not depend on the corpus.
    proposed = places.join(F.broadcast(rarest), "word").select(
        "file", "template", (F.col("place") - F.col("at")).alias("start")
    )
    in_key = (F.col("at") >= F.col("key_at")) & (F.col("at") < F.col("key_at") + F.col("key_size"))
    aligned = (
        places.join(F.broadcast(index), "word")
        .select("file", "template", (F.col("place") - F.col("at")).alias("start"), "size", "label", "base", "key_size", in_key.alias("in_key"))
        .join(proposed, ["file", "template", "start"], "left_semi")
        .groupBy("file", "template", "start", "size", "label", "base", "key_size")
        .agg(F.count("*").alias("matched"), F.count_if("in_key").alias("key_matched"))
        .filter("key_matched = key_size")
    )
    base = F.col("base")
    found = aligned.groupBy("file").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        _joined(F.when(base, F.col("label"))).alias("base_labels"),
        _joined(F.col("label")).alias("labels"),
        F.max(F.col("matched") / F.col("size")).alias("score"),
    )
    return files.select("file", "doc_id", "n_words").join(found, "file", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _joined(label):
    """Distinct labels, of which there are no more than templates, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(label)), ",")


def _rarest(files: DataFrame, index: DataFrame) -> DataFrame:
    """(word, template, at): of each key phrase the word that the fewest files hold."""
    held = files.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("files"))
    total = files.agg(F.count("*").alias("total"))
    idf = F.log((F.col("total") + 1) / (F.coalesce("files", F.lit(0)) + 1))
    in_key = (F.col("at") >= F.col("key_at")) & (F.col("at") < F.col("key_at") + F.col("key_size"))
    first = Window.partitionBy("template").orderBy(F.desc("idf"), "word", "at")
    return written(
        index.filter(in_key).join(held, "word", "left").crossJoin(F.broadcast(total))
        .withColumn("idf", idf).withColumn("nth", F.row_number().over(first))
        .filter("nth = 1").select("word", "template", "at"),
        "licence-rarest",
    )
