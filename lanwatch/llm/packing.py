"""Best-fit decreasing packing of documents into fixed windows (operator 10).

1. Every whole text is tokenised once, its end id added, and cut into full windows and a rest.  A
   piece keeps its place, length and checksum; ids do not travel.  Texts come to Python in Arrow batches bounded in
   bytes and are worked on in slices of a few MB, whose pieces leave before the next slice.
2. Pieces are numbered in the order in which the table was written (number of the part file, row in
   it, place in the text): a prefix sum over the pieces of each ``BLOCK`` rows, then a rank within the
   block.  Consecutive ranges of about ``GROUP`` pieces are the groups, as many as the corpus needs, so a
   task's memory is bounded and no key is hot.
3. A group is packed longest piece first.  A segment tree indexed by remaining capacity counts the open
   windows; its descent finds the least capacity that holds the piece, else a window opens.
4. Windows are numbered by group, then by their earliest piece, so ``sequence_id`` rises in the order of
   the table: after the mixing stage, with training position.  Best fit moves a piece by at most its group.

A window is padded to ``WINDOW`` tokens, except one whose tokens are a power of two.

Edge cases: null text counts as empty (its end id alone); strings of special tokens are these tokens, as the
tokenizer has it; equal lengths are packed in the table's order; repeated rows are packed as often as they
occur; a very long text becomes many full windows; an empty table gives an empty result; extra columns are
ignored; rows of a table that is not read from files are in the order of their partitions, a partition for a file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens
from .memory import give_back

WINDOW = 4096
END = 2
GROUP = 4096
BLOCK = 1024       # rows whose pieces are counted together
# text that a worker tokenises at once, and its word cache: more of either saves time, as words are shared, and takes
# memory; results are the same.  A stage of the pipeline shares its executor with what earlier stages left in the JVM
SLICE, CACHE = 9 << 20, 96 << 20
STAGE_SLICE, STAGE_CACHE = 3 << 20, 64 << 20

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, file long, row long"


def _written_at(docs: DataFrame) -> tuple[Column, Column, Column]:
    """(number of the part file, its name's hash, row in it): sorted by these, rows are in the order in which the table was written."""
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta["row_index"]).schema      # plain tables and some formats have none
    except AnalysisException:
        row = F.monotonically_increasing_id()      # partition number above, place in it in the lower 33 bits
        return F.shiftright(row, 33), F.lit(0).cast("long"), row.bitwiseAND(F.lit((1 << 33) - 1))
    # part numbers have five digits or more, and Spark lists files by size
    number = F.regexp_extract(meta["file_name"], r"^part-(\d+)", 1)
    return F.coalesce(number.try_cast("long"), F.lit(-1).cast("long")), F.xxhash64(meta["file_path"]), meta["row_index"]


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, slice_bytes: int = SLICE, cache_bytes: int = CACHE) -> DataFrame:
    """One row for each piece of each document."""
    C.for_python(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, special=True, cache_bytes=cache_bytes)
        for batch in batches:
            for first, ids, at in encoder.slices(batch.column(1), slice_bytes):
                total = np.diff(at) + 1                          # with the end id
                n = -(-total // window)
                of = np.repeat(np.arange(len(total)), n)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * window
                sums = np.empty(len(of), np.int64)
                k = 0
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = np.append(ids[a:b], np.uint32(end)).astype("<u4")
                    for p in range(0, len(own), window):
                        sums[k] = zlib.crc32(own[p:p + window])
                        k += 1
                rows = pa.array(first + of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(start), pa.array(np.minimum(total[of] - start, window)), pa.array(sums),
                     pa.array(total[of]), *[batch.column(c).take(rows) for c in (2, 3, 4)]],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "file", "row"])
                ids = own = rows = None
                give_back()
            batch = None

    part, file, row = _written_at(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text"),
                       part.alias("part"), file.alias("file"), row.alias("row")).mapInArrow(cut, PIECES)


def _grouped(cut: DataFrame, group: int) -> DataFrame:
    """Add ``at``, the piece's number in the order of the table, and ``group``, its range of about ``group`` of them."""
    block = F.floor(F.col("row") / BLOCK)
    name = ["part", "file"]
    blocks = cut.groupBy(*name, block.alias("block")).agg(F.count("*").alias("n"))
    # prefix sums in two levels: files, one row each, and the blocks of a file
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = blocks.groupBy(*name).agg(F.sum("n").alias("n"))
    every = Window.partitionBy(F.lit(0))
    files = files.select(*name, upto(every.orderBy(*name)).alias("files_before"), F.sum("n").over(every).alias("total"))
    starts = C.staged(blocks.withColumn("blocks_before", upto(Window.partitionBy(*name).orderBy("block"))).drop("n")
                      .join(files, name), "piece-blocks")
    groups = F.greatest(F.lit(1), F.ceil(F.col("total") / group))
    rank = F.row_number().over(Window.partitionBy(*name, "block").orderBy("row", "start")) - 1
    return (cut.withColumn("block", block).withColumn("rank", rank).join(starts, [*name, "block"])
            .withColumn("at", F.col("files_before") + F.col("blocks_before") + F.col("rank"))
            .withColumn("groups", groups).withColumn("group", F.expr("at * groups div total"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at", "group"))


class Capacities:
    """Segment tree over remaining capacities 0 to ``window``: how many open windows have each."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window_id: int) -> None:
        self.open[capacity].append(window_id)
        k = self.leaves + capacity
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove a window of the least capacity that is ``length`` or more; (capacity, window id)."""
        count, k = self.count, self.leaves + length
        while not count[k]:              # up, until a subtree to the right has an open window
            while k & 1:
                k >>= 1
            if not k:
                return None
            k += 1
        while k < self.leaves:           # down, to its least capacity
            k = 2 * k if count[2 * k] else 2 * k + 1
        capacity, window_id = k - self.leaves, self.open[k - self.leaves].pop()
        while k:
            count[k] -= 1
            k >>= 1
        return capacity, window_id


def best_fit(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(window id, offset) of each length; the lengths come in decreasing order."""
    tree, used, out = Capacities(window), 0, []
    for n in lengths:
        found = tree.take(n)
        if found is None:
            found, used = (window, used), used + 1
        capacity, w = found
        out.append((w, window - capacity))
        if capacity > n:
            tree.add(capacity - n, w)
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end: int = END, group: int = GROUP,
         slice_bytes: int = SLICE, cache_bytes: int = CACHE) -> DataFrame:
    """Pieces with their sequence, offset and padded length."""
    with C.arrow_batches(docs.sparkSession, f"{slice_bytes}b"):
        cut = C.staged(pieces(docs, tokenizer or tokens.default_path(), window, end, slice_bytes, cache_bytes), "pieces")

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "at"], ascending=[False, True], kind="stable").reset_index(drop=True)
        at = np.array(best_fit(part["length"].tolist(), window), np.int64).reshape(-1, 2)
        total = np.bincount(at[:, 0], weights=part["length"].to_numpy()).astype(np.int64)[at[:, 0]]
        # windows by their earliest piece
        first = np.full(at[:, 0].max(initial=-1) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, at[:, 0], part["at"].to_numpy())
        part["sequence_id"] = (part["group"].to_numpy() << 32) + first.argsort().argsort()[at[:, 0]]
        part["offset"] = at[:, 1]
        part["padded"] = np.where(total & (total - 1), window, total)
        return part.drop(columns=["at", "group"])

    out = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long, padded long")
    return _grouped(cut, group).groupBy("group").applyInPandas(place, out)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the packed pieces of every row of ``docs``."""
    return pack(docs, slice_bytes=STAGE_SLICE, cache_bytes=STAGE_CACHE)
