"""Language mixture inference by expectation-maximisation (operator 1).

Model.  A text's letters (lower-cased, anything else read as a space) give one trigram around each letter,
hashed into ``BUCKETS`` buckets.  A language is a distribution over buckets, learnt with add-``SMOOTH``
smoothing from all labelled texts that are not held out: every partition sums its counts and emits at most
languages x buckets rows, Spark adds them, and the driver gets languages x buckets numbers.

Inference.  A text is a mixture of languages; EM estimates its proportions from its bucket counts.  The
set of languages grows from the best single one.  The candidate is the language with the steepest
ascent of the likelihood; EM on the larger set must raise the log-likelihood by more than
``PENALTY * ln(trigrams)``, else the set stays.  The prediction is the language with the largest proportion, and
the score is that proportion.  ``BATCH`` texts are worked on at once as matrices.

Edge cases: a null text, or one with no letter, is ``und`` with score 0; so is every text if there is
nothing to learn from; a null doc_id counts as empty text in the split; ties go to the language that sorts
first; repeated rows get equal results; an empty table gives an empty result; long texts are counted in
blocks of ``BLOCK`` characters; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 4096
SMOOTH = 0.5
PENALTY = 3.0
MAX_STEPS = 30
TOLERANCE = 1e-4
BATCH = 64
BLOCK = 1 << 20
FOLDS, HELD_OUT = 4, 2

RESULT = "doc_id long, held_out boolean, lang_pred string, score double, mixture array<struct<lang:string,share:double>>"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(texts: list[str]) -> np.ndarray:
    """texts x BUCKETS trigram counts; a text without letters has none."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    row = " " + " ".join(lowered) + " "
    out = np.zeros(len(texts) * BUCKETS, np.int64)
    letters = _letters()
    for a in range(0, len(row) - 2, BLOCK):
        c = np.frombuffer(row[a:a + BLOCK + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        known = letters[c]
        c = np.where(known, c, np.uint32(32))
        mid = np.flatnonzero(known[1:-1])
        h = (c[mid] * np.uint32(0x9E3779B1)) ^ (c[mid + 1] * np.uint32(0x85EBCA6B)) ^ (c[mid + 2] * np.uint32(0xC2B2AE35))
        bucket = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
        text = np.searchsorted(ends, mid + a, side="right")
        out += np.bincount(text * BUCKETS + bucket, minlength=len(out))
    return out.reshape(len(texts), BUCKETS)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, languages x BUCKETS probabilities) from all rows with a text and a lang."""
    C.for_python(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for k in range(0, len(batch), BATCH):
                part = batch.iloc[k:k + BATCH]
                n = counts(part["text"].tolist())
                for lang, rows in part.reset_index(drop=True).groupby("lang").groups.items():
                    total[lang] = total.get(lang, 0) + n[rows].sum(axis=0)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    rows = (docs.filter("text is not null and lang is not null").select("text", "lang")
            .mapInPandas(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    table = np.full((len(languages), BUCKETS), SMOOTH)
    if len(rows):
        table[np.searchsorted(languages, rows["lang"]), rows["bucket"]] += rows["n"]
    return languages, table / table.sum(axis=1, keepdims=True)


def em(n: np.ndarray, start: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihoods) of each row of counts; a zero in ``start`` stays zero."""
    pi, total, going = start.copy(), n.sum(axis=1, keepdims=True), np.arange(len(n))
    for _ in range(MAX_STEPS):
        now = pi[going]
        pi[going] = now * ((n[going] / (now @ p)) @ p.T) / total[going]
        # each row stops on its own change, whatever the others do
        going = going[np.abs(pi[going] - now).max(axis=1) >= TOLERANCE]
        if not len(going):
            break
    return pi, (n * np.log(pi @ p)).sum(axis=1)


def mixtures(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """texts x languages proportions; every text has a trigram."""
    n = n.astype(np.float64)
    total = n.sum(axis=1)
    single = n @ np.log(p).T
    best = single.argmax(axis=1)
    pi = np.eye(len(p))[best]
    likelihood, active = single.max(axis=1), np.arange(len(n))
    for _ in range(1, len(p)):
        # slope of the likelihood towards each language outside the set; above 1 it rises
        ascent = ((n[active] / (pi[active] @ p)) @ p.T) / total[active, None]
        ascent[pi[active] > 0] = 0
        rises = ascent.max(axis=1) > 1
        active, ascent = active[rises], ascent[rises]
        if not len(active):
            break
        start = pi[active] * 0.9
        start[np.arange(len(active)), ascent.argmax(axis=1)] = 0.1
        larger, gained = em(n[active], start, p)
        better = gained - likelihood[active] > PENALTY * np.log(total[active])
        active = active[better]
        pi[active], likelihood[active] = larger[better], gained[better]
    return pi


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """Prediction for every row of ``docs`` (doc_id, held_out, text); only ``text`` is looked at."""
    C.for_python(docs.sparkSession)
    languages, p = model

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k in range(0, len(batch), BATCH):
                n = counts([t or "" for t in batch["text"].iloc[k:k + BATCH]])
                some = n.any(axis=1) & bool(languages)
                pi = np.zeros((len(n), max(1, len(languages))))
                if some.any():
                    pi[some] = mixtures(n[some], p)
                for row, known in zip(pi, some, strict=True):
                    share = [{"lang": languages[i], "share": float(row[i])} for i in np.argsort(-row, kind="stable") if row[i] > 0]
                    out.append((languages[row.argmax()] if known else "und", min(1.0, float(row.max())), share))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"],
                                "lang_pred": [x[0] for x in out], "score": [x[1] for x in out], "mixture": [x[2] for x in out]})

    return docs.select("doc_id", "held_out", "text").mapInPandas(predict, RESULT)


def language_mixture(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, predict every row."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    return identify(rows, train(rows.filter(~F.col("held_out"))))
