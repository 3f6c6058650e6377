"""License scanning: an exact set-similarity join of text blocks with license notices, in DataFrame expressions.

A block matches a template when it holds at least ``CONTAINMENT`` of the template's distinct words. Words are
ordered by how many documents hold them, rarest first. Three filters leave few pairs to compare, and lose none:

* prefix: a match shares one of the template's rarest words, enough of them that the rest cannot reach the threshold;
* length: a block with fewer template words than the threshold asks for cannot match;
* position: the words before and after a shared word bound the overlap that is still possible.

Phrases that name a license by themselves are found word by word as well.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.text import NOT_WORD, ascii_lower, let, pieces, table

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Wording of common license notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is licensed under the gnu lesser general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "copyright all rights reserved no part may be reproduced without written permission"),
)

CONTAINMENT = 0.8
#: Sentences end after their mark or at an empty line. A block is a sentence with those that follow it, RUN in all:
#: as many as the wording of a template runs over.
SENTENCE = r"[.!?][\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n"
RUN = 3


def needed(words: int, containment: float) -> int:
    """Words that a block must share with a template of so many."""
    return max(1, ceil(round(containment * words, 9)))


def _text_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _starts(words: Column, phrase: str) -> Column:
    """Positions where the phrase's words stand one after another."""
    parts = phrase.split()

    def here(w: Column, i: Column) -> Column:
        same = w == parts[0]
        for k, p in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + k) == p)
        return F.when(same, i)

    return F.array_compact(F.transform(words, here))


def _phrases(words: Column, phrases: dict[str, str]) -> Column:
    """n_words and, for the phrases, places, first and last start and labels."""
    all_starts = F.concat(F.array().cast("array<int>"), *[_starts(words, p) for p in phrases])
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(
        *[F.when(F.size(_starts(words, p)) > 0, F.lit(label)) for p, label in phrases.items()]))))
    some = F.struct(
        let(all_starts, lambda s: F.struct(F.size(s).alias("n"), F.array_min(s).alias("first"), F.array_max(s).alias("last"))).alias("places"),
        labels.alias("labels"),
    )
    none = F.struct(
        F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last")).alias("places"),
        _text_array([]).alias("labels"),
    )
    maybe = F.lit(False)
    for p in phrases:
        maybe = maybe | F.array_contains(words, p.split()[-1])
    return F.struct(F.size(words).alias("n_words"), F.when(maybe, some).otherwise(none).alias("found"))


def _frequencies(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each template word: as many rows as the templates have words."""
    held = F.array_intersect(_text_array(vocabulary), pieces(ascii_lower(F.col("text")), NOT_WORD))
    rows = texts.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    return {r.word: r.n for r in rows}


def template_matches(
    texts: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, run: int = RUN
) -> DataFrame:
    """(doc_id, print, block, label, containment) of every block of ``run`` neighbouring sentences that matches a
    template; ``block`` is the number of its first sentence.

    ``texts`` has doc_id, print and text without nulls.
    """
    spark = texts.sparkSession
    sets = [(label, sorted(set(words.split()))) for label, words in templates]
    vocabulary = sorted({w for _, words in sets for w in words})
    count = _frequencies(texts, vocabulary)
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for t, (label, words) in enumerate(sets):
        words = sorted(words, key=rank.get)
        need = needed(len(words), containment)
        for i, w in enumerate(words[: len(words) - need + 1]):
            index.append(F.struct(F.lit(w).alias("word"), F.lit(i).alias("i"), F.lit(t).alias("template"), F.lit(label).alias("label"),
                                  F.lit(need).alias("need"), _text_array(words).alias("wanted")))
    least = min(needed(len(words), containment) for _, words in sets)
    prefixes = spark.range(1).select(F.inline(F.array(*index)))

    c = F.col
    # Each sentence is looked through once; a block joins the few template words that its sentences hold.
    sentences = F.transform(F.split(ascii_lower(c("text")), SENTENCE), lambda s: F.array_intersect(_text_array(order), F.split(s, NOT_WORD)))
    blocks = let(sentences, lambda all_: F.transform(all_, lambda _, i: F.flatten(F.slice(all_, i + 1, run))))
    held = texts.select("doc_id", "print", F.posexplode(blocks).alias("block", "held")).filter(F.size("held") >= least)
    held = held.select("doc_id", "print", "block", F.array_intersect(_text_array(order), "held").alias("held")).filter(F.size("held") >= least)
    tokens = held.select("doc_id", "print", "block", "held", F.posexplode("held").alias("j", "word"))
    possible = F.least("i", "j") + 1 + F.least(F.size("wanted") - c("i") - 1, F.size("held") - c("j") - 1)
    pairs = tokens.join(F.broadcast(prefixes), "word").filter((F.size("held") >= c("need")) & (possible >= c("need")))
    overlap = F.size(F.array_intersect("wanted", "held"))
    return pairs.filter(overlap >= c("need")).select(
        "doc_id", "print", "block", "template", "label", (overlap / F.size("wanted")).alias("containment")
    ).dropDuplicates(["doc_id", "print", "block", "template"])


def license_scan(
    df: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, containment: float = CONTAINMENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base columns tell where the phrases stand; ``labels`` adds those of matching templates; ``score`` is the
    best containment, 1 where a phrase stands, else 0. Null texts count as empty. Rows that share id and text get
    the same labels and stay as many as they are. An empty table gives no rows.
    """
    c = F.col
    texts = df.select(c(id_col).alias("doc_id"), F.coalesce(c(text_col), F.lit("")).alias("text")).withColumn("print", F.xxhash64("text"))
    found = template_matches(texts, templates, containment).groupBy("doc_id", "print").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    words = pieces(ascii_lower(c("text")), NOT_WORD)
    base = texts.select("doc_id", "print", let(words, lambda w: _phrases(w, phrases)).alias("b"))
    base = base.select("doc_id", "print", "b.n_words", "b.found.places", "b.found.labels")
    same_row = c("b.doc_id").eqNullSafe(c("m.doc_id")) & (c("b.print") == c("m.print"))
    every = F.array_sort(F.array_union("b.labels", F.coalesce("more", _text_array([]))))
    return base.alias("b").join(found.alias("m"), same_row, "left").select(
        "b.doc_id", c("n_words").cast("bigint").alias("n_words"), c("places.n").cast("bigint").alias("n_base"),
        c("places.first").cast("bigint").alias("first_word"), c("places.last").cast("bigint").alias("last_word"),
        F.concat_ws(",", "b.labels").alias("base_labels"), F.concat_ws(",", every).alias("labels"),
        F.when(c("places.n") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op1_license_scans(spark, sf_dir: str) -> DataFrame:
    """Licence notices in all ``documents``; see :func:`license_scan`."""
    return license_scan(table(spark, sf_dir, "documents"))


_VALUES = ", ".join(f"({i}, '{label}', '{words}')" for i, (label, words) in enumerate(TEMPLATES))
_BASE = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP1_SQL = rf"""
WITH t AS (
  SELECT i, label, list_distinct(string_split(words, ' ')) AS wanted FROM (VALUES {_VALUES}) AS v(i, label, words)
), p AS (
  SELECT * FROM (VALUES {_BASE}) AS v(phrase, label, n)
), d AS (
  SELECT row_number() OVER () AS k, doc_id, {_LOWER} AS lower_text,
         list_filter(regexp_split_to_array({_LOWER}, '{_SEP}'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT k, list_distinct(regexp_split_to_array(array_to_string(s[i:i + {RUN - 1}], ' '), '{_SEP}')) AS held
  FROM (SELECT k, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT k, regexp_split_to_array(lower_text, '{SENTENCE}') AS s FROM d))
), m AS (
  SELECT k, label, len(list_intersect(wanted, held)) / len(wanted) AS containment
  FROM b, t WHERE len(list_intersect(wanted, held)) >= {CONTAINMENT} * len(wanted) - 1e-9
), f AS (
  SELECT k, label, i - 1 AS pos
  FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d), p
  WHERE array_to_string(w[i:i + p.n - 1], ' ') = p.phrase
), base AS (
  SELECT k, count(*) AS n, min(pos) AS a, max(pos) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM f GROUP BY k
), every AS (
  SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT k, label FROM f UNION SELECT k, label FROM m) GROUP BY k
), best AS (
  SELECT k, max(containment) AS c FROM m GROUP BY k
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base,
       base.a::BIGINT AS first_word, base.z::BIGINT AS last_word, coalesce(base.labels, '') AS base_labels,
       coalesce(every.labels, '') AS labels, CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(best.c, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (k) LEFT JOIN every USING (k) LEFT JOIN best USING (k)
"""
