"""License scan by exact set-similarity join (operator 6, native).

A text block is a window of consecutive words of the whole text, line breaks ignored, that begins with a word of the
template; a template is a set of words, and its windows are a quarter longer than its text (``span``), so that a
wrapped or lightly edited notice is found and words scattered over a long text are not.  A block matches when it
holds at least ``THRESHOLD`` of the template's words (containment).  The join is exact:

* tokens are ordered by how many texts of the whole corpus hold them, rarest first;
* prefix filter: a template of ``m`` words that needs ``k = ceil(THRESHOLD * m)`` of them is indexed under its
  ``m - k + 1`` rarest words; a matching block holds at least one of these, so only the places of such words
  (anchors) are looked at, with the ``span - 1`` words on either side;
* length filter: the words around an anchor are ``k`` or more;
* position filter: an anchor whose surroundings hold fewer than ``k`` of the template's words is dropped, and a
  block counts under the anchor that is the rarest of the words it shares, at place ``i`` of the template, which
  leaves at most ``m - i`` words in common;
* the containment itself is computed for the blocks of the anchors that are left.

A text also carries the four base phrases, whose words must stand consecutively.

Only texts that hold a prefix word are cut into words for the join; an anchor carries at most ``2 * span - 1`` words,
however long its text; the template index is bounded by the template list (a parameter), so it is broadcast.

Edge cases: null text counts as empty; ties in token frequency are ordered by the word; repeated rows give repeated
results; an empty table or an empty template list gives no block; extra columns, whatever their names, are ignored;
very long texts are scanned whole, the words of one text at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

# fixed values: what separates words, the base phrases and their labels
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NON_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"      # the same before A-Z are lower-cased
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# templates (label, text); containment is over distinct words
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published "
            "by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("all-rights-reserved", "all rights reserved"),
]
THRESHOLD = 0.8


def span(text: str) -> int:
    """Words of a block for a template of this text."""
    return math.ceil(1.25 * len(text.split()))


def word_array(text: Column) -> Column:
    """Words of a text after lower-casing A-Z (the split leaves an empty piece at either end)."""
    return F.filter(F.split(C.lower_az(text), NON_WORD), lambda w: w != F.lit(""))


def template_table(spark, templates) -> DataFrame:
    rows = []
    for i, (label, text) in enumerate(templates):
        tokens = sorted(set(text.split()))
        rows.append((i, label, tokens, len(tokens), math.ceil(round(THRESHOLD * len(tokens), 9)), span(text)))
    return spark.createDataFrame(rows, "template int, label string, tokens array<string>, m int, need int, span int")


def token_order(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(token, n): in how many texts of the whole corpus each template word occurs."""
    known = F.filter(F.array_distinct(word_array(C.text_of())), lambda w: w.isin(vocabulary))
    return docs.select(F.explode(known).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def _in_order(tokens: DataFrame, order: DataFrame) -> DataFrame:
    """Add ``ranked``: the template's words, rarest in the corpus first."""
    return (tokens.select("template", F.explode("tokens").alias("token"))
            .join(order, "token", "left")
            .groupBy("template")
            .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("r"))
            .select("template", F.transform("r", lambda x: x["token"]).alias("ranked")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every (row id, template, block) with containment of at least ``THRESHOLD``.

    ``docs`` has ``_id`` and ``text``.  Columns: _id, start (of the block, in words from 0), label, template, shared, m.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    order = C.staged(token_order(docs, vocabulary).coalesce(1), "tokens")
    table = template_table(spark, templates)
    index = C.staged(table.join(_in_order(table, order), "template").coalesce(1), "templates")
    prefix = (index.select("template", "label", "ranked", "m", "need", "span", F.posexplode("ranked").alias("i", "token"))
              .filter("i <= m - need").drop("i"))
    rare = sorted(r[0] for r in prefix.select("token").distinct().collect())   # bounded by the template list
    if not rare:
        rare = [""]
    reach = max((span(t) for _, t in templates), default=1) - 1
    # a text is cut into words only if a rare word occurs in it
    probe = "(?i)(?:" + "|".join(rare) + ")"
    first = F.greatest(F.col("at") - F.lit(reach), F.lit(0))                   # of the words around the anchor
    anchors = (docs.select("_id", C.text_of().alias("_t")).filter(F.rlike("_t", F.lit(probe)))
               .withColumn("_w", word_array(F.col("_t")))
               .withColumn("_a", F.filter(F.transform("_w", lambda w, i: F.when(w.isin(rare), i)), lambda i: i.isNotNull()))
               .filter(F.size("_a") > 0)
               .select("_id", F.explode(F.transform("_a", lambda i: F.struct(
                   i.alias("at"), F.get("_w", i).alias("token"),
                   F.slice("_w", F.greatest(i - F.lit(reach), F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("around")))).alias("_a"))
               .select("_id", "_a.*").withColumn("first", first))
    # the template's own reach within the words around
    left = F.greatest(F.col("at") - F.col("span") + 1, F.col("first"))
    near = (anchors.join(F.broadcast(prefix), "token")                       # size bounded by the template list
            .withColumn("left", left)
            .withColumn("around", F.slice("around", F.col("left") - F.col("first") + 1, 2 * F.col("span") - 1))
            .filter(F.size("around") >= F.col("need"))                         # length
            .filter(F.size(F.array_intersect("ranked", "around")) >= F.col("need")))   # position
    blocks = F.filter(
        F.transform(F.sequence(F.lit(1), F.col("at") - F.col("left") + 1), lambda s: F.struct(
            (F.col("left") + s - 1).alias("start"), F.get("around", s - 1).alias("head"),
            F.array_intersect("ranked", F.slice("around", s, F.col("span"))).alias("common"))),
        lambda x: (F.size(x["common"]) >= F.col("need")) & (F.get(x["common"], F.lit(0)) == F.col("token"))
        & F.array_contains("ranked", x["head"]))
    found = near.select("_id", "template", "label", "m", F.explode(blocks).alias("b"))
    # a block that holds its rarest word twice has two anchors
    return (found.groupBy("_id", "template", F.col("b.start").alias("start"))
            .agg(F.first("label").alias("label"), F.first(F.size("b.common")).alias("shared"), F.first("m").alias("m"))
            .select("_id", "start", "label", "template", "shared", "m"))


def _starts(w: Column, phrase: list[str]) -> Column:
    """Places (from 0) where the phrase's words stand consecutively."""
    wanted = F.array(*[F.lit(x) for x in phrase])
    return F.filter(F.transform(w, lambda _, i: i), lambda i: F.slice(w, i + 1, len(phrase)) == wanted)


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): base places, labels and best containment."""
    digest = F.struct(F.xxhash64("_t").alias("a"), F.xxhash64(F.lit(1), "_t").alias("b"), F.length("_t").alias("n"))
    rows = docs.select("doc_id", C.text_of().alias("_t"))
    # equal texts have equal results, so results are keyed by the text
    hits = scan(rows.select(digest.alias("_id"), F.col("_t").alias("text")), templates)
    best = C.staged(hits.groupBy("_id").agg(
        F.array_sort(F.collect_set("label")).alias("found"),      # labels: bounded by the template list
        F.max(F.col("shared") / F.col("m")).alias("score")), "licenses")
    near = "(?i)(?:" + "|".join(p.replace(" ", NON_WORD_ANY_CASE) for p in PHRASES) + ")"
    w = word_array(F.col("_t"))
    places = (rows
              .withColumn("_id", digest)
              .withColumn("n_words", F.size(F.filter(F.split("_t", NON_WORD_ANY_CASE), lambda x: x != F.lit(""))).cast("long"))
              .withColumn("_w", F.when(F.rlike("_t", F.lit(near)), w))
              .drop("_t"))
    for k, phrase in enumerate(PHRASES):
        places = places.withColumn(f"_p{k}", F.coalesce(_starts(F.col("_w"), phrase.split()), F.array().cast("array<int>")))
    every = F.concat(*[F.col(f"_p{k}") for k in range(len(PHRASES))])
    base = F.array_sort(F.array_compact(F.array(*[
        F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())])))
    return (places
            .withColumn("_all", every)
            .withColumn("_base", base)
            .drop("_w", *[f"_p{k}" for k in range(len(PHRASES))])
            .join(best, "_id", "left")
            .select("doc_id", "n_words",
                    F.size("_all").cast("long").alias("n_base"),
                    F.array_min("_all").cast("long").alias("first_word"),
                    F.array_max("_all").cast("long").alias("last_word"),
                    F.array_join("_base", ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("found", F.array().cast("array<string>"))))), ",").alias("labels"),
                    F.greatest(F.coalesce("score", F.lit(0.0)), F.when(F.size("_base") > 0, 1.0).otherwise(0.0)).alias("score")))


def _sql() -> str:
    values = ", ".join(f"({i}, '{label}', [{', '.join(repr(w) for w in sorted(set(t.split())))}], {span(t)})" for i, (label, t) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{label}', [{', '.join(repr(w) for w in p.split())}])" for p, label in PHRASES.items())
    non = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{C.UPPER}', '{C.LOWER}') AS x FROM documents),
w AS (SELECT r, doc_id, x, list_filter(regexp_split_to_array(x, '{non}'), lambda v: v <> '') AS w FROM d),
t(id, label, tokens, span) AS (VALUES {values}),
ph(label, p) AS (VALUES {phrases}),
st AS (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM w),
bl AS (SELECT r, label, len(list_intersect(tokens, w[i:i + span - 1])) AS shared, len(tokens) AS m
       FROM st, t WHERE list_contains(tokens, w[i])),
m AS (SELECT * FROM bl WHERE shared >= ceil(round({THRESHOLD} * m, 9))),
mm AS (SELECT r, list(DISTINCT label) AS found, max(shared * 1.0::DOUBLE / m) AS score FROM m GROUP BY r),
s AS (SELECT r, label, unnest(generate_series(1, len(w) - len(p) + 1)) AS i, w, p FROM w, ph WHERE len(w) >= len(p)),
a AS (SELECT r, label, i - 1 AS i FROM s WHERE w[i:i + len(p) - 1] = p),
aa AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS base FROM a GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') AS labels,
       greatest(coalesce(score, 0.0), CASE WHEN base IS NULL THEN 0.0 ELSE 1.0 END)::DOUBLE AS score
FROM w LEFT JOIN mm USING (r) LEFT JOIN aa USING (r)
"""


ORACLE = _sql()
