"""Periodic run detection by multi-scale minimizers (operator 11).

A run is a stretch of consecutive words with smallest period q and at least ``max(least, EXPONENT * q)`` words
that no neighbouring word extends.  A word is dropped if a run contains it after that run's first q words.

1. Words become numbers, with a number of its own behind every text, so that no equality spans two texts.
2. Periods up to ``SHORT`` are scanned directly: stretches where a word equals the one q places on.
3. Longer periods are dealt to scales K with q <= K <= 3q/2.  In every window of K consecutive K-grams the least
   hash, the leftmost of equals, is a minimizer.  A window holds all rotations of a period, so inside a run the
   same K-gram is the minimizer one period on, and nothing between equals it.  A run has 4q words or more and a
   pair of windows q apart has at most 4q, so every run has such a pair: neighbouring minimizers of equal hash.
4. Pairs whose distance belongs to the scale are seeds.  Each is extended both ways on the words themselves, so
   that every run returned is exact; stretches whose period has a smaller divisor are left to that divisor.

Hashes of K-grams come from doubling (two overlapping power-of-two grams).  A run could be missed only if
different K-grams of one text collide in 64 bits, or in the 64 bits less the place's that order a window.
Texts that are too short for a scale leave it, so the work is near linear.  There is no shuffle: a text is
whole in one task, in slices of about ``SLICE_BYTES``.

Edge cases: null or empty text has no words, no run and the empty text as its result; a very long text is a slice
of its own; equal rows get equal results; overlapping runs all count; an empty table gives an empty result;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .memory import give_back

LEAST = 6                  # words in a run, at least
EXPONENT = 4               # periods in a run, at least; the scales of step 3 need 4 or more
SHORT = 8                  # periods scanned directly
SLICE_BYTES = 4 << 20      # text that is worked on at once

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 on 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _joined(h: np.ndarray, step: int, salt: np.uint64) -> np.ndarray:
    """Hashes of the grams made of ``h[i]`` and ``h[i + step]``; at the end, of what is left."""
    out = h * _M3 + salt
    out[:len(h) - step] += h[step:] * _M2
    return _mix(out)


def _window_min(x: np.ndarray, k: int) -> np.ndarray:
    """Least value of every k in a row, by prefix and suffix minima of blocks of k."""
    n = len(x)
    blocks = np.full(-(-n // k) * k, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, k)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - k + 1], ahead[k - 1:n])


def _minimizers(h: np.ndarray, k: int) -> np.ndarray:
    """Places that are the least of some window of k hashes, the leftmost of equals."""
    bits = len(h).bit_length()
    place = np.uint64((1 << bits) - 1)
    least = _window_min((h & ~place) | np.arange(len(h), dtype=np.uint64), k) & place
    return least[np.append(True, least[1:] != least[:-1])].astype(np.int64)


def _reach(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on (``step`` 1) or back (-1) equal the word ``lag`` places on."""
    n, chunk = 0, 64
    while True:
        if step > 0:
            a = at + n
            same = ids[a:max(a, min(a + chunk, len(ids) - lag))] == ids[a + lag:a + lag + chunk]
        else:
            b = at - n + 1
            a = max(0, b - chunk)
            same = (ids[a:b] == ids[a + lag:b + lag])[::-1]
        if not len(same):
            return n
        if not same.all():
            return n + int(same.argmin())
        n += len(same)
        chunk = min(2 * chunk, 1 << 16)


def _primes(q: int) -> list[int]:
    out, f = [], 2
    while f * f <= q:
        if q % f == 0:
            out.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return out + ([q] if q > 1 else [])


def _smallest(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of period q that starts here has no smaller period: no divisor of q is one."""
    own = ids[start:start + q]
    return not any((own == ids[start + q // f:start + q // f + q]).all() for f in _primes(q))


def _scales(longest: int, exponent: int) -> Iterator[tuple[int, int]]:
    """(least period, K) of each scale: K is the greatest period, at most 3/2 of the least."""
    low = SHORT + 1
    while exponent * low <= longest:
        yield low, 3 * low // 2
        low = 3 * low // 2 + 1


def find_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in ``ids``, by start and period.

    Text t has the places from ``bounds[t]`` to ``bounds[t + 1] - 1``; the last holds a number found nowhere else.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods need other scales")
    found = set()
    for q in range(1, SHORT + 1):
        at = np.flatnonzero(ids[q:] == ids[:-q]) if len(ids) > q else np.zeros(0, np.int64)
        if not len(at):
            continue
        cut = np.flatnonzero(np.diff(at) > 1)
        first, last = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
        long = last - first + 1 + q >= max(least, exponent * q)
        for s, e in zip(first[long].tolist(), last[long].tolist(), strict=True):
            if _smallest(ids, s, q):
                found.add((s, e - s + 1 + q, q))

    sizes = np.diff(bounds) - 1
    place, h, width = np.arange(len(ids)), _mix(ids.astype(np.uint64) + _M3), 1
    for low, k in _scales(int(sizes.max(initial=0)), exponent):
        enough = sizes >= exponent * low
        if not enough.all():           # the others can hold no run of this scale, nor of a later one
            keep = np.repeat(enough, sizes + 1)
            place, h, sizes = place[keep], h[keep], sizes[enough]
        while 2 * width <= k:
            h = _joined(h, width, np.uint64(width))
            width *= 2
        grams = _joined(h, k - width, np.uint64(k)) if k > width else h
        at = _minimizers(grams, k)
        own = grams[at]
        order = np.lexsort((at, own))
        at, own = at[order], own[order]
        lag = at[1:] - at[:-1]
        seed = (own[1:] == own[:-1]) & (lag >= low) & (lag <= k)
        # places of one text follow one another in both numberings, so lags are the same
        seeds = sorted(zip(lag[seed].tolist(), place[at[:-1][seed]].tolist(), strict=True))
        done = (0, 0)                  # lag and end of the stretch that was extended last
        for q, m in seeds:
            if q == done[0] and m < done[1]:
                continue
            start = m + 1 - _reach(ids, m, q, -1)
            stop = m + _reach(ids, m, q, 1)
            done = (q, max(stop, m + 1))
            if stop - start + q >= max(least, exponent * q) and _smallest(ids, start, q):
                found.add((start, stop - start + q, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(texts: pa.Array, least: int, exponent: int) -> list[pa.Array]:
    """n_words, runs and collapsed text of each text of a slice."""
    lists = pc.ascii_split_whitespace(texts)
    bounds, flat = lists.offsets.to_numpy(), lists.flatten()
    word = pc.not_equal(flat, pa.scalar("", flat.type)).to_numpy(zero_copy_only=False)   # a split leaves empty ends
    upto = np.append(0, np.cumsum(word))
    bounds, flat = upto[bounds], flat.filter(pa.array(word))
    n = len(texts)
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64) + n
    ids = np.insert(codes, bounds[1:], np.arange(n))          # below n: the texts' own end marks
    at = bounds + np.arange(n + 1)
    runs = find_runs(ids, at, least, exponent)
    kept = flat
    of = np.searchsorted(at, np.array([r[0] for r in runs], np.int64), side="right") - 1
    kept_at = bounds
    if runs:
        change = np.zeros(len(codes) + 1, np.int64)
        for (start, length, period), t in zip(runs, of.tolist(), strict=True):
            change[start - t + period] += 1
            change[start - t + length] -= 1
        keep = np.cumsum(change[:-1]) == 0
        kept, kept_at = flat.filter(pa.array(keep)), np.append(0, np.cumsum(keep))[bounds]
    rows = np.array(runs, np.int64).reshape(-1, 3)
    struct = pa.StructArray.from_arrays([pa.array(rows[:, 0] - at[of]), pa.array(rows[:, 1]), pa.array(rows[:, 2])],
                                        ["start", "length", "period"])
    runs_at = np.append(0, np.cumsum(np.bincount(of, minlength=n)))
    text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(kept_at, pa.int64()), kept), pa.scalar(" ", kept.type))
    return [pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(runs_at, pa.int32()), struct), text.cast(pa.string())]


def _byte_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, but at least one row."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield a, b
        a = b


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, every run (start, length, period) and the text without repeated periods."""
    C.for_python(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())       # before slicing: kernels misread a cast slice
            for a, b in _byte_slices(texts, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *_collapsed(texts.take(pa.array(np.arange(a, b))), least, exponent)],
                    ["doc_id", "n_words", "runs", "text"])
            batch = texts = None
            give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text")).mapInArrow(scan, RUNS)


def planted(docs: DataFrame) -> DataFrame:
    """The rows' doc_id and text, every tenth text (by checksum of its doc_id) made periodic as the contract says."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, C.words(F.col("text"))).alias("w"))
    rows = rows.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.when(F.col("n") > 0, F.expr("1 + (n - a) div (3 + g % 8)")))
    head = F.slice("w", F.lit(1), F.col("a").cast("int"))
    period = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    again = F.flatten(F.array_repeat(period, F.expr("int((n - a) div p + 1)")))
    made = F.array_join(F.slice(F.concat(head, again), F.lit(1), F.col("n").cast("int")), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def _hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(runs: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest run and checksums of the runs and the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), lines.alias("lines"), "text").select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("(1000 * top.length) div (-top.period)").alias("exponent_milli"), _hex(F.col("lines")).alias("runs_sha256"),
        _hex(F.col("text")).alias("collapsed_sha256"))
