"""Token counts by a separator scan of flat token files (operator 9).

``write_flat`` tokenises whole texts and writes bare ids, each text ended by the end-of-document id, to
unindexed files on the shared storage: one for each partition, written aside and moved into place, so a
repeated task leaves the same file.  A side table says which rows went to which file, in order.

``scan`` finds the documents again from the files alone.  Files are cut into blocks of ``BLOCK`` ids; a task
compares a block with the end id in one vector operation and returns the places that match.
Boundaries that cross blocks are stitched by a prefix scan over the block summaries (last end, number of
ends) in two levels: within runs of ``RUN`` blocks and over the runs, so a huge file is many
groups.  The window of an output row is its document: start, tokens, number in the file.

Edge cases: null text counts as empty (0 tokens); the tokenizer can't make the end id from text; ids
after the last end are a document with ``ended`` false; a file without ids has no document; odd bytes at a file's
end raise; repeated rows are documents each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens
from .memory import give_back

END = 49407             # <|endoftext|> of the vocabulary; its ids fit 16 bits
IDS = "<u2"
BLOCK = 1 << 21         # ids in a block
RUN = 1024              # blocks in a run


def _files(uri: str):
    """(file system, path) of a folder or file that Spark names."""
    from pyarrow import fs
    if re.match(r"\w+:/", uri):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return fs.LocalFileSystem(), uri


def write_flat(docs: DataFrame, folder: str, tokenizer: str, end: int = END, ids: str = IDS) -> DataFrame:
    """Write the files; returns (file, doc_no, doc_id), which file and place each row of ``docs`` has."""
    C.for_python(docs.sparkSession)
    make, at = _files(folder)
    make.create_dir(at)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, encode, n = TaskContext.get(), tokens.encoder(tokenizer).batch, 0
        store, path = _files(folder)
        name = f"part-{task.partitionId():06d}"
        aside = f"{path}/.{name}-{task.taskAttemptId()}"
        with store.open_output_stream(aside) as out:
            for batch in batches:
                flat, starts = encode(batch.column(1))
                out.write(np.insert(flat, starts[1:], end).astype(ids).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(batch)), pa.array(np.arange(n, n + len(batch))), batch.column(0)], ["file", "doc_no", "doc_id"])
                n += len(batch)
                batch = flat = starts = None
                give_back()
        store.move(aside, f"{path}/{name}.bin")

    return C.staged(docs.select("doc_id", C.text_of().alias("text")).mapInArrow(write, "file string, doc_no long, doc_id long"), "flat-rows")


def scan(spark: SparkSession, folder: str, end: int = END, ids: str = IDS, block: int = BLOCK) -> DataFrame:
    """(file, doc_no, start, n_tokens, ended) of every document in the ``.bin`` files of ``folder``."""
    C.for_python(spark)
    width = np.dtype(ids).itemsize
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    blocks = (files.filter("length > 0")
              .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("length") - 1) / (block * width)).cast("long"))).alias("block"))
              .repartition(F.col("path"), F.col("block")))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, k in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if length % width:
                    raise ValueError(f"{path}: {length} bytes are no whole number of ids")
                store, at = _files(path)
                with store.open_input_file(at) as f:
                    f.seek(k * block * width)
                    row = np.frombuffer(f.read(min(block * width, length - k * block * width)), ids)
                ends = np.flatnonzero(row == end) + k * block
                name = re.sub(r".*/|\.bin$", "", path)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k]), pa.array([length // width]), pa.array([ends])],
                                                 ["file", "block", "ids", "ends"])

    found = C.staged(blocks.mapInArrow(find, "file string, block long, ids long, ends array<long>")
                     .withColumn("run", F.expr(f"block div {RUN}")), "ends")
    # prefix scan: what lies before each run, then before each block of it
    ahead = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = (found.groupBy("file", "run").agg(F.max(F.array_max("ends")).alias("last"), F.sum(F.size("ends")).alias("n"))
            .select("file", "run", F.max("last").over(ahead).alias("run_last"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("run_n")))
    stitched = (found
                .withColumn("last", F.max(F.array_max("ends")).over(inside))
                .withColumn("n", F.coalesce(F.sum(F.size("ends")).over(inside), F.lit(0)))
                .join(runs, ["file", "run"])
                .withColumn("before", F.coalesce("last", "run_last", F.lit(-1).cast("long")))
                .withColumn("tail", F.col("ids") - 1 == F.coalesce(F.array_max("ends"), "before"))
                .withColumn("final", F.col("block") == F.expr(f"(ids - 1) div {block}")))
    # the file's last block also ends a document that no separator ends
    ends = F.when(F.col("final") & ~F.col("tail"), F.concat("ends", F.array("ids"))).otherwise(F.col("ends"))
    return (stitched.select("file", "before", "ids", (F.col("run_n") + F.col("n")).alias("n"), ends.alias("ends"))
            .select("file", "before", "ids", "n", "ends", F.posexplode("ends").alias("i", "end"))
            .withColumn("start", F.coalesce(F.get("ends", F.col("i") - 1), "before") + 1)
            .select("file", (F.col("n") + F.col("i")).alias("doc_no"), "start", (F.col("end") - F.col("start")).alias("n_tokens"),
                    (F.col("end") < F.col("ids")).alias("ended")))


def token_counts(docs: DataFrame, tokenizer: str | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens (without the end id) and place of every row of ``docs``, by way of flat files."""
    spark = docs.sparkSession
    folder = C.scratch_path(spark, "flat")
    rows = write_flat(docs, folder, tokenizer or tokens.default_path())
    found = scan(spark, folder, block=block)
    return rows.join(found, ["file", "doc_no"]).select("doc_id", "n_tokens", "file", "doc_no", "start")
