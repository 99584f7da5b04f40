"""Quality rules with adaptive thresholds (operator 5, native).

Every text is measured in one narrow pass: words, word characters, symbols, repeated lines, words
inside repeated 8-word windows.  Three ratios per text (symbols to word characters, repeated lines
to lines, repeated words to words) go on a grid of 1/1000, and a fourth beside them: marks (ASCII
characters other than letters) to word characters, what a source's ordinary writing has of them.
The non-zero values of the texts that pass the base rules are counted per (lang, source): a
quantile sketch of at most 1000 counters a ratio, whose value error is 0.001 at any input size.
Sketches merge by adding counters, so the result does not depend on partitioning or on reruns.

Limits, each from a group's own writing:

* a sketch's fence is q75 + 1.5 * (q75 - q25); symbols are held against the fence of marks, as good
  texts have too few symbols to tell a usual amount, repeated lines and words against their own;
* a group takes its own fence if its sketch counts ``MIN_VALUES`` texts, else its language's: the lower
  median of the fences of its sources that do; a language with fewer than ``MIN_PEERS`` of them takes the
  median of all groups, and a corpus with fewer the fence of its merged sketch;
* no limit exceeds 5/4 of that median, so a source full of junk, however large, can't lift its own:
  the median counts sources, not texts.  Nor is it below a floor, a safety minimum for spotless groups.

The limits are joined back on (lang, source); a text over any limit is not kept.

Edge cases: null text counts as empty (0 words, ``base_failed``); null lang or source is a group of
its own; a group without a counted value takes the limits of its language; without any value in the corpus
the floors hold; ties in a sketch are one counter; repeated rows are judged one by one and alike; very long
texts are measured whole; an empty table gives an empty result; extra columns are ignored (operator) or
carried (stage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

# fixed values of the base rules
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"

# all ASCII characters but letters and white space
MARKS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"

# the adaptive part: grid, texts that a sketch must count, sources that make a median, floors in grid steps (1/1000)
GRID = 1000
MIN_VALUES = 30
MIN_PEERS = 3
FLOORS = {"symbols": 20, "lines": 100, "repeats": 100}
# the ratio whose sketch limits each measure
SKETCHED = {"symbols": "marks", "lines": "lines", "repeats": "repeats"}


def _measures(df: DataFrame) -> DataFrame:
    """Add the base columns and the grid values; needs ``text``."""
    return (
        df.withColumn("_t", C.text_of())
        .withColumn("_w", C.words(F.col("_t")))
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("word_chars", F.length(F.translate("_t", " \t\n\x0b\x0c\r", "")).cast("long"))
        .withColumn("n_symbols", (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"))
        .withColumn("_m", F.length("_t") - F.length(F.translate("_t", MARKS, "")))
        .withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
        # one 64-bit hash for each window of 8 words
        .withColumn("_h", F.when(F.col("n_words") > WINDOW, F.transform(
            F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice("_w", i, WINDOW)))))
        # starts of windows found twice or more, in order; most texts have none
        .withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                                 F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_p", F.sort_array(F.transform(
            F.filter("_s", lambda x, j: (x["h"] == F.get(F.col("_s"), j - 1)["h"])
                     | (x["h"] == F.get(F.col("_s"), j + 1)["h"])), lambda x: x["i"])))
        # words covered by those windows: each start adds its distance to the one before, 8 at most
        .withColumn("n_repeat_words", F.coalesce(F.aggregate(
            F.transform("_p", lambda p, j: F.when(j == 0, WINDOW).otherwise(
                F.least(F.lit(WINDOW), p - F.get(F.col("_p"), j - 1)))),
            F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
        .withColumn("_g", F.struct(
            F.expr(f"coalesce({GRID} * n_symbols div nullif(word_chars, 0), 0L)").alias("symbols"),
            F.expr(f"coalesce({GRID} * n_dup_lines div nullif(size(_l), 0), 0L)").alias("lines"),
            F.expr(f"coalesce({GRID} * n_repeat_words div nullif(n_words, 0), 0L)").alias("repeats"),
            F.expr(f"coalesce({GRID} * _m div nullif(word_chars, 0), 0L)").alias("marks")))
        .drop("_t", "_w", "_m", "_l", "_h", "_s", "_p")
    )


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the counters of every group's three sketches; a group without values has one row of nulls."""
    return (measured
            .select("lang", "source", F.explode(F.array(*[
                F.struct(F.lit(m).alias("measure"),
                         F.when(~F.col("base_failed") & (F.col(f"_g.{r}") > 0), F.col(f"_g.{r}")).alias("bucket"))
                for m, r in SKETCHED.items()])).alias("x"))
            .groupBy("lang", "source", "x.measure", "x.bucket").agg(F.count("x.bucket").alias("n")))


def _fences(sketch: DataFrame, *group: str) -> DataFrame:
    """(group, measure, values, fence) of the sketches merged by ``group``."""
    merged = sketch.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    every = Window.partitionBy(*group, "measure")
    upto, total = F.sum("n").over(every.orderBy("bucket")), F.sum("n").over(every)
    at = lambda p: F.min(F.when(F.col("upto") * 4 >= F.col("total") * p, F.col("bucket")))
    return (merged.select("*", upto.alias("upto"), total.alias("total")).groupBy(*group, "measure")
            .agg(F.max("total").alias("values"), at(1).alias("q25"), at(3).alias("q75"))
            .withColumn("fence", F.expr("q75 + 3 * (q75 - q25) div 2")))


def limits(sketch: DataFrame) -> DataFrame:
    """(lang, source, one limit for each measure) from the merged sketches."""
    def median(*group):
        """(lower median of the groups' own fences, how many there are)"""
        w = Window.partitionBy(*group, "measure")
        rank = F.row_number().over(w.orderBy(F.col("own").asc_nulls_last(), "lang", "source"))
        return rank, F.count("own").over(w)

    own = _fences(sketch, "lang", "source").withColumn("own", F.when(F.col("values") >= MIN_VALUES, F.col("fence")))
    for name, group in (("lang", ["lang"]), ("all", [])):
        rank, n = median(*group)
        own = own.withColumn("_r", rank).withColumn("_n", n)
        middle = F.max(F.when(F.col("_r") == F.floor((F.col("_n") + 1) / 2), F.col("own"))).over(Window.partitionBy(*group, "measure"))
        own = own.withColumn(f"of_{name}", F.when(F.col("_n") >= MIN_PEERS, middle))
    whole = _fences(sketch).select(F.col("measure").alias("_measure"), F.col("fence").alias("of_corpus"))
    peers = F.coalesce("of_lang", "of_all")
    floor = F.coalesce(*[F.when(F.col("measure") == m, f) for m, f in FLOORS.items()])
    q = (own.join(whole, F.col("measure") == F.col("_measure"))
         .withColumn("limit", F.greatest(floor, F.least(F.coalesce("own", peers, "of_corpus"), F.floor(peers * 5 / 4)))))
    return (q.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source"))
            .agg(*[F.max(F.when(F.col("measure") == m, F.col("limit"))).cast("long").alias(f"limit_{m}") for m in FLOORS]))


def judged(measured: DataFrame, limit: DataFrame) -> DataFrame:
    """Join each row with its group's limits and add ``kept``."""
    over = F.lit(False)
    for m in FLOORS:
        over = over | (F.col(f"_g.{m}") > F.col(f"limit_{m}"))
    return (measured.join(limit, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures, limits and verdict of every row of ``docs`` (doc_id, text, lang, source)."""
    measured = C.staged(_measures(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality")
    limit = C.staged(limits(sketches(measured)), "limits")
    return judged(measured, limit).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[f"limit_{m}" for m in FLOORS])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that the rules keep, with all their columns.

    Rows and measures are written once, side by side, so texts are measured once and never shuffled: the
    limits, one row for each language and source, join the written table.
    """
    measured = C.staged(_measures(C.packed(docs, "text", "lang", "source")).drop("text"), "quality")
    limit = C.staged(limits(sketches(measured)), "limits")
    return C.unpacked(judged(measured, limit).filter("kept"))


ORACLE = rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, row_number() OVER () AS r,
             list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w,
             list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT r, unnest(generate_series(1, len(w) - 7)) AS i, w FROM w WHERE len(w) >= 8),
s AS (SELECT r, i, w[i:i + 7] AS v FROM g),
d AS (SELECT r, i FROM s QUALIFY count(*) OVER (PARTITION BY r, v) > 1),
p AS (SELECT r, sum(least(8, i - prev)) AS n FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 8) AS prev FROM d) GROUP BY r),
m AS (SELECT w.doc_id, w.lang, w.source, len(w.w) AS n_words, len(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             len(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(regexp_replace(x, '[^!-@\[-`{{-~]', '', 'g')) AS n_marks, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines FROM w LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS b1, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS b2,
             coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS b3,
             coalesce(1000 * n_marks // nullif(word_chars, 0), 0) AS b4 FROM m),
k AS (SELECT lang, source, unnest([{{'measure': 'symbols', 'v': b4}}, {{'measure': 'lines', 'v': b2}}, {{'measure': 'repeats', 'v': b3}}], recursive := true), base_failed FROM b),
v AS (SELECT lang, source, measure, CASE WHEN v > 0 AND NOT base_failed THEN v END AS v FROM k),
f0 AS (SELECT lang, source, measure, count(v) AS n, quantile_disc(v, 0.25) AS q25, quantile_disc(v, 0.75) AS q75 FROM v GROUP BY ALL),
f1 AS (SELECT lang, source, measure, CASE WHEN n >= {MIN_VALUES} THEN q75 + 3 * (q75 - q25) // 2 END AS own FROM f0),
fl AS (SELECT lang, measure, CASE WHEN count(own) >= {MIN_PEERS} THEN quantile_disc(own, 0.5) END AS m FROM f1 GROUP BY ALL),
fa AS (SELECT measure, CASE WHEN count(own) >= {MIN_PEERS} THEN quantile_disc(own, 0.5) END AS m FROM f1 GROUP BY ALL),
fc AS (SELECT measure, quantile_disc(v, 0.75) + 3 * (quantile_disc(v, 0.75) - quantile_disc(v, 0.25)) // 2 AS m FROM v GROUP BY ALL),
q AS (SELECT f1.lang, f1.source, f1.measure, least(coalesce(own, fl.m, fa.m, fc.m), 5 * coalesce(fl.m, fa.m) // 4) AS lim
      FROM f1 JOIN fl ON f1.lang IS NOT DISTINCT FROM fl.lang AND f1.measure = fl.measure JOIN fa ON f1.measure = fa.measure JOIN fc ON f1.measure = fc.measure),
z AS (SELECT lang, source, greatest({FLOORS['symbols']}, max(lim) FILTER (measure = 'symbols')) AS limit_symbols,
             greatest({FLOORS['lines']}, max(lim) FILTER (measure = 'lines')) AS limit_lines,
             greatest({FLOORS['repeats']}, max(lim) FILTER (measure = 'repeats')) AS limit_repeats FROM q GROUP BY ALL)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND b1 <= limit_symbols AND b2 <= limit_lines AND b3 <= limit_repeats AS kept,
       limit_symbols, limit_lines, limit_repeats
FROM b JOIN z ON b.lang IS NOT DISTINCT FROM z.lang AND b.source IS NOT DISTINCT FROM z.source
"""
