"""License scans: fixed phrases by their words, and an exact set-similarity join of text blocks with license notices.

Words of the notices are ordered by their frequency in the blocks of the corpus, the rarest first. A block and a notice
can only share the required number of words if they meet in their prefixes; prefix, length and position decide which pairs
are compared, and the comparison is exact. All on DataFrame functions.
"""

import re

from pyspark.sql import functions as F

from freshet.operators.joins import left_join

THRESHOLD = 90  # per cent of a notice's distinct words that a block must hold

# Phrases and their labels.
PHRASES = [
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("gnu general public license", "gpl"),
    ("mit license", "mit"),
]

# License notices as their publishers word them.
NOTICES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
            " License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files, to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # between words, after lower case
BLOCK_END = "(?<=[.;:!?])[\\x20\\x09-\\x0D]+|\\n[\\x20\\x09\\x0B-\\x0D]*\\n"  # a sentence mark before whitespace, or an empty line


def _spaced(text):
    """The words of a text in lower case, each with a space on both sides; without words one space.

    The Kelvin sign is the one letter outside A-Z whose lower case is a letter of a-z; it is kept apart.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Ꝁ")))
    words = F.trim(F.regexp_replace(low, GAP, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _spaces(text):
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrase_places(docs, phrases=None):
    """Documents (any columns, with `__text`) with n_words and, over all places where a phrase's words stand one after the
    other, n_base, first_word, last_word (starts, from 0; null without a place) and base_labels.
    """
    phrases = sorted(phrases or PHRASES, key=lambda p: p[1])
    df = docs.withColumn("__words", _spaced(F.col("__text"))).withColumn("n_words", _spaces(F.col("__words")) - 1)
    starts, counts, labels = [], [], []
    for k, (phrase, label) in enumerate(phrases):
        around = F.when(F.contains("__words", F.lit(f" {phrase} ")), F.split("__words", f" {phrase}(?= )"))
        df = df.withColumn(f"__p{k}", around)
        parts = F.col(f"__p{k}")
        starts.append((_spaces(F.get(parts, F.lit(0))),
                       F.col("n_words") - (_spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())))
        counts.append(F.coalesce(F.size(parts) - 1, F.lit(0)))
        labels.append(F.when(parts.isNotNull(), F.lit(label)))
    first, last = ([s[i] for s in starts] for i in (0, 1))
    pick = lambda how, xs: how(*xs) if len(xs) > 1 else xs[0]
    found = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    return df.select(
        *docs.columns, "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"), pick(F.least, first).alias("first_word"),
        pick(F.greatest, last).alias("last_word"), found.alias("base_labels"))


def notice_words(text):
    return sorted(set(re.sub(GAP, " ", text.lower()).split()))


def _least(size, threshold):
    """Words that a block must share with a notice of so many."""
    return -(-size * threshold // 100)


def _token_blocks(docs, words):
    """Blocks of `__text` as own columns, block_no, block, and the given words they hold, in the given order."""
    blocks = docs.select(*[c for c in docs.columns if c != "__text"],
                         F.posexplode(F.split(F.coalesce("__text", F.lit("")), BLOCK_END)).alias("block_no", "block"))
    held = F.array_intersect(F.array(*[F.lit(w) for w in words]), F.split(_spaced(F.col("block")), " "))
    return blocks.withColumn("__held", held)


def _rows(spark, rows, schema):
    """A small constant table."""
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names, strict=True)]) for r in rows])))


def frequency_order(docs, notices):
    """The words of the notices, those in fewer blocks first (ties by word): one count per word, whatever the corpus."""
    words = sorted({w for _, text in notices for w in notice_words(text)})
    counts = _token_blocks(docs, words).select(F.explode("__held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    seen = {r["word"]: r["n"] for r in counts.collect()}  # at most one row per word of the notices
    return sorted(words, key=lambda w: (seen.get(w, 0), w))


def find_blocks(docs, notices=None, threshold=THRESHOLD):
    """Every pair of a text block and a notice of whose distinct words the block holds at least `threshold` per cent.

    `docs` has `__text` and any other columns; returns those others, block_no, block, notice (number), label, shared,
    size. A block ends at a sentence mark before whitespace or at an empty line. A pair that meets on several
    prefix words is returned once.
    """
    notices = NOTICES if notices is None else notices
    order = frequency_order(docs, notices)
    rank = {w: k for k, w in enumerate(order)}
    index, whole = [], []
    for k, (label, text) in enumerate(notices):
        words = sorted(notice_words(text), key=rank.get)
        least = _least(len(words), threshold)
        index += [(w, i, k, label, len(words), least) for i, w in enumerate(words[:len(words) - least + 1])]
        whole.append(words)
    fewest = min(row[-1] for row in index)
    spark = docs.sparkSession
    # Bounded by the list of notices: one row per prefix word.
    index = F.broadcast(_rows(spark, index, "__word string, __i int, notice int, label string, size int, __least int"))
    own = [c for c in docs.columns if c != "__text"]
    blocks = _token_blocks(docs, order).where(F.size("__held") >= fewest)
    prefix = blocks.select(*own, "block_no", "block", "__held", F.posexplode(
        F.slice("__held", F.lit(1), F.size("__held") - (fewest - 1))).alias("__j", "__word"))
    met = prefix.join(index, "__word").where(
        (F.size("__held") >= F.col("__least"))                                           # length
        & (F.least(F.size("__held") - F.col("__j"), F.col("size") - F.col("__i")) >= F.col("__least")))  # position
    words = F.element_at(F.array(*[F.array(*[F.lit(w) for w in ws]) for ws in whole]), F.col("notice") + 1)
    common = F.array_intersect(words, F.col("__held"))
    met = met.withColumn("__common", common).where(F.size("__common") >= F.col("__least"))
    # Of the shared words the rarest is in both prefixes, so the row of that word stands for the pair.
    met = met.where(F.element_at("__common", 1) == F.col("__word"))
    return met.select(*own, "block_no", "block", "notice", "label", F.size("__common").alias("shared"), "size")


def license_scan(docs, key="doc_id", text="text", phrases=None, notices=None, threshold=THRESHOLD):
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Labels are those of the phrases and of the notices found in a block, each once, sorted, joined by commas (empty
    without any); score is the highest share of a notice's words in one block, 0 without a found notice. Blocks are
    compared as sets, so words between and their order do not matter. A null text is an empty one. Null ids and ids
    shared by different texts stay apart, as rows are known by id and two hashes of the text; equal rows get one result
    each. Other columns are left out.
    """
    rows = docs.select(F.col(key).alias("__id"), F.xxhash64(F.col(text)).alias("__h1"), F.xxhash64(F.lit(1), F.col(text)).alias("__h2"),
                       F.col(text).alias("__text"))
    own = ["__id", "__h1", "__h2"]
    found = find_blocks(rows, notices, threshold).groupBy(*own).agg(
        F.collect_set("label").alias("__labels"), F.max(F.col("shared") / F.col("size")).alias("__score"))
    joined = left_join(phrase_places(rows, phrases).drop("__text"), found, own)
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("__labels", F.array().cast("array<string>"))))
    return joined.select(
        F.col("__id").alias(key), "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.coalesce("__score", F.lit(0.0)).alias("score"))


def _sql_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def oracle_sql(phrases=None, notices=None, threshold=THRESHOLD):
    """The scan in SQL, without order or prefixes: words as rows for the phrases, every block beside every notice."""
    phrases, notices = phrases or PHRASES, NOTICES if notices is None else notices
    lower = "regexp_extract_all(lower(replace(coalesce({}, ''), chr(8490), chr(42816))), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    tests = [(" AND ".join(f"lead(w, {i}) OVER p = '{w}'" for i, w in enumerate(phrase.split())), label) for phrase, label in phrases]
    places = ", ".join(f"CASE WHEN {t} THEN '{label}' END AS l{k}" for k, (t, label) in enumerate(tests))
    each = " UNION ALL ".join(f"SELECT doc_id, i, l{k} AS label FROM places WHERE l{k} IS NOT NULL" for k in range(len(tests)))
    known = ", ".join(f"('{label}', {_sql_list(ws)}, {len(ws)}, {_least(len(ws), threshold)})"
                      for label, ws in ((label, notice_words(t)) for label, t in notices))
    return f"""
WITH docs AS (SELECT doc_id, text, {lower.format('text')} AS ws FROM documents),
  words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM docs),
  places AS (SELECT doc_id, i, {places} FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
  base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS b FROM ({each}) GROUP BY doc_id),
  blocks AS (SELECT doc_id, list_distinct({lower.format('block')}) AS ws FROM (SELECT doc_id, unnest(string_split(regexp_replace(
    coalesce(text, ''), '([.;:!?])[\\x20\\x09-\\x0D]+|\\n[\\x20\\x09\\x0B-\\x0D]*\\n', '\\1' || chr(1), 'g'), chr(1))) AS block FROM documents)),
  notices(label, words, size, least) AS (VALUES {known}),
  found AS (SELECT doc_id, list(DISTINCT label) AS l, max(shared / size) AS score FROM (SELECT doc_id, label, size, least,
    len(list_intersect(ws, words)) AS shared FROM blocks, notices) WHERE shared >= least GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b, []), coalesce(l, [])))), ','), '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""
