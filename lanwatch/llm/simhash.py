"""SimHash near-duplicates by pigeonring filtering (operator 4).

Fingerprint: A-Z are lower-cased, words ``[^\\x20\\x09-\\x0D]+`` form shingles of ``shingle`` words
(repeats included, joined by a space; a shorter text is one shingle; no words: fingerprint zero).  A bit
is 1 if set in over half of the shingles' XXH64 (seed 42).  Hashing runs on whole texts in Arrow
batches; bits are summed in numpy.

Links (``max_bits`` or fewer differing bits, 2 at most): a fingerprint is a ring of 8 segments of 8
bits.  By the pigeonring principle two fingerprints within distance 2 have a segment from which
every chain of l consecutive segments differs in at most ``l * 2 / 8`` bits: 0 bits in chains of
1 to 3, at most 1 in chains of 4 to 7, at most 2 in all 8.  So, over distinct fingerprints only:

1. each of the 8 starts keys the chain of 3 segments (24 bits, equal); keys of one fingerprint go;
2. what is left is keyed by the chain of 7 segments with one of its last 32 bits masked (equal, or one
   bit differs); this holds for every pair that meets the principle;
3. a key of step 2 fixes 55 bits, so at most 2**9 = 512 distinct fingerprints share it: its members
   are one bounded list, in which the full Hamming distance is checked.  A list returns a
   spanning forest of its links (fewer rows than members), not its pairs.

Groups are the connected components of those links.  Exact copies never make pairs: they are one
fingerprint.  A large group of near copies makes at most 256 keys for each distinct fingerprint.

Edge cases: null and empty texts have fingerprint zero and link like others; a null doc_id is larger
than any other as a group's id; repeated rows are linked; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .graph import components
from .memory import give_back

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENT = 8          # bits of a segment; 8 segments
EQUAL, LOOSE = 24, 32     # bits of the chains with budget 0, and those that follow with budget 1
BLOCK = 1 << 16      # shingles whose bits are summed at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one whole text."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    if len(w) > shingle:
        parts = map(b" ".join, zip(*[w[k:] for k in range(shingle)], strict=False))
    else:
        parts = [b" ".join(w)]
    h = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), BLOCK):
        bits = np.unpackbits(h[k:k + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp): ``h`` is a native hash of the text, with doc_id the key of a row."""
    C.for_python(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        out = pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
        give_back()
        return out

    return docs.select("doc_id", F.xxhash64(C.text_of()).alias("h"), simhash(F.col("text")).alias("fp"))


def _rotated(fp: Column, start: Column) -> Column:
    """The 64 bits as a ring that begins at segment ``start``."""
    left = start * SEGMENT
    # a shift by 64 is a shift by 0 in the JVM: start 0 gives fp | fp
    return F.call_function("shiftleft", fp, left).bitwiseOR(F.call_function("shiftrightunsigned", fp, (64 - left)))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``distinct`` (fp) within ``max_bits``, transitively."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the chains here are for a distance of 2 bits or less")
    C.for_python(distinct.sparkSession)
    rings = (distinct.select("fp", F.explode(F.array(*[F.lit(i) for i in range(64 // SEGMENT)])).alias("start"))
             .select("fp", "start", _rotated(F.col("fp"), F.col("start")).alias("ring"))
             .withColumn("chain", F.shiftrightunsigned("ring", 64 - EQUAL)))
    shared = rings.groupBy("start", "chain").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    loose = (rings.join(shared, ["start", "chain"], "left_semi")
             .select("fp", "start", "ring", F.explode(F.sequence(F.lit(0), F.lit(LOOSE - 1))).alias("masked"))
             .withColumn("key", F.shiftrightunsigned("ring", 64 - EQUAL - LOOSE)
                         .bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("masked"))))))
    # at most 512 members: 55 of 64 bits are fixed and members are distinct
    lists = (loose.groupBy("start", "masked", "key").agg(F.collect_list("fp").alias("members"))
             .filter(F.size("members") > 1).select(F.array_sort("members").alias("members")).distinct())

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [e for m in batch["members"] for e in _spanning(np.asarray(m, np.int64), max_bits)]
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return lists.mapInPandas(forest, "a long, b long").distinct()


def _spanning(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the members' links."""
    left, out = np.arange(len(members)), []
    while len(left):                     # breadth-first from the first member that is left
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            near = np.bitwise_count((members[wave, None] ^ members[None, left]).view(np.uint64)) <= max_bits
            hit = near.any(axis=0)
            out += [(int(members[wave[w]]), int(members[v])) for w, v in zip(near.argmax(axis=0)[hit], left[hit], strict=True)]
            wave, left = left[hit], left[~hit]
    return out


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, h, fp, keeper): keeper is the key (null id last, doc_id, h) of the group's first row."""
    prints = C.staged(fingerprints(docs, shingle), "simhash")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = C.staged(prints.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    roots = C.staged(components(links(first.select("fp"), max_bits)), "components")
    grouped = first.join(roots, first.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    keeper = grouped.groupBy("root").agg(F.min("first").alias("keeper"))
    named = C.staged(grouped.join(keeper, "root").select("fp", "keeper"), "keepers")
    return prints.join(named, "fp").select("doc_id", "h", "fp", "keeper")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the group's smallest doc_id) of every row."""
    return groups(docs, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("keeper.doc_id").alias("component_id"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group stays (smallest doc_id; of equal rows one)."""
    g = groups(docs.select("doc_id", "text"))
    own = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("h") == F.col("keeper.h"))
    seen = C.staged(g.groupBy("doc_id", "h").agg(F.max(own).alias("stays"), F.count("*").alias("n"))
                    .filter("not stays or n > 1"), "gone")
    gone, twice = seen.filter("not stays"), seen.filter("stays")
    rows = C.packed(docs, "doc_id", "text").withColumn("h", F.xxhash64(C.text_of())).drop("text")

    def on(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"))
        return a.join(b, a.doc_id.eqNullSafe(b._d) & (a.h == b._h), how)

    kept = on(rows, gone, "left_anti")
    if not twice.isEmpty():
        one = on(kept, twice, "left_semi").dropDuplicates(["doc_id", "h"])
        kept = on(kept, twice, "left_anti").union(one)
    return C.unpacked(kept)
