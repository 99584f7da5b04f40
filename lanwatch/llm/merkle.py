"""Merkle manifest of a dataset in van Emde Boas layout (operator 12).

Every row is a leaf; the leaves of a source, in order of doc_id, form a tree in which each ``ARITY`` consecutive
nodes become their digest until one, the subroot, is left; the subroots, in order of source, form a tree likewise.

1. Leaf digests are made by DataFrame functions; texts do not travel.
2. Nodes get their place in their tree by a range sort and a prefix sum over the partitions' counts.
3. ``HEIGHT`` levels of a tree are cut into aligned subtrees of at most ``ARITY ** HEIGHT`` leaves.  Such a block is
   one row that holds its digests in van Emde Boas order: the levels are split at half height, first the top half,
   then each subtree of the bottom half, each laid out in the same way.  ``address`` is the arithmetic that finds a
   node there; building a block and reading siblings go by it alone.
4. Block roots are the leaves of the next tier, until every tree has one block.  A tier has about 4096 times fewer
   rows than the one below, so there are few.
5. Down again, each block hands every leaf its path: the siblings inside the block, then the block's own path.
   A row proves itself by folding its digest with these siblings up to the root.

A group is a block, so its size is bounded however many rows a source has.  Blocks are written as tables, which is
the manifest; a lost executor costs a task.

A leaf digest covers doc_id, source, lang, n_chars and text.  Edge cases: null in any column is ``-``, which no value
gives; a null doc_id comes first in its source, the null source first of all; rows of equal doc_id are in the order of
their digests, equal rows are leaves of their own and share digest and subroot; a very long text is hashed whole in
one row; an empty table gives an empty result; a missing column counts as null, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

ARITY = 16
HEIGHT = 3                 # levels of a block above its leaves: at most 16 ** 3 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32                  # bytes of a digest

BLOCK = "tree string, block long, total long, leaves long, height int, nodes binary, members array<struct<doc_id:long,other:binary>>"
PATH = "array<struct<at:int,siblings:string>>"
PATH_TYPE = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.string())]))
MEMBERS = pa.list_(pa.struct([("doc_id", pa.int64()), ("other", pa.binary())]))


# ------------------------------------------------------------------ layout

@lru_cache(maxsize=64)
def size_of(levels: int, arity: int = ARITY) -> int:
    """Nodes of a full subtree of so many levels."""
    return (arity ** levels - 1) // (arity - 1)


@lru_cache(maxsize=256)
def addresses(depth: int, levels: int, arity: int = ARITY) -> np.ndarray:
    """Address of every node of a depth (0 is the root) in a subtree of ``levels`` levels."""
    index = np.arange(arity ** depth)
    base = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = arity ** (depth - top)            # nodes of this depth in one bottom subtree
        base += size_of(top, arity) + index // below * size_of(levels - top, arity)
        index, depth, levels = index % below, depth - top, levels - top
    return base


def digest(*parts: bytes) -> bytes:
    """Digest of digests, which are concatenated as hex text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


class Block:
    """One aligned subtree over its digests in van Emde Boas order; ``leaves`` of the places are taken."""

    def __init__(self, nodes: bytearray, leaves: int, height: int, arity: int = ARITY):
        self.nodes, self.leaves, self.height, self.arity = nodes, leaves, height, arity

    def address(self, depth: int, index: int) -> int:
        return int(addresses(depth, self.height + 1, self.arity)[index])

    def width(self, depth: int) -> int:
        """Nodes there are at a depth."""
        return -(-self.leaves // self.arity ** (self.height - depth))

    def get(self, depth: int, index: int) -> bytes:
        at = self.address(depth, index) * SIZE
        return bytes(self.nodes[at:at + SIZE])

    def put(self, depth: int, index: int, value: bytes) -> None:
        at = self.address(depth, index) * SIZE
        self.nodes[at:at + SIZE] = value

    def run(self, depth: int, index: int) -> list[bytes]:
        """The digests that become one together with this node, itself included."""
        first = index - index % self.arity
        return [self.get(depth, i) for i in range(first, min(first + self.arity, self.width(depth)))]

    @classmethod
    def build(cls, leaves: list[bytes], height: int, arity: int = ARITY) -> Block:
        own = cls(bytearray(size_of(height + 1, arity) * SIZE), len(leaves), height, arity)
        for i, leaf in enumerate(leaves):
            own.put(height, i, leaf)
        for depth in range(height, 0, -1):
            for i in range(own.width(depth - 1)):
                own.put(depth - 1, i, digest(*own.run(depth, i * arity)))
        return own

    def paths(self) -> Iterator[list[tuple[int, str]]]:
        """For each leaf, level by level: its place among its run, and the others' digests as hex text."""
        known: dict[tuple[int, int], list[str]] = {}
        for leaf in range(self.leaves):
            path, index = [], leaf
            for depth in range(self.height, 0, -1):
                key = (depth, index // self.arity)
                if key not in known:
                    known[key] = [d.hex() for d in self.run(depth, index)]
                texts, at = known[key], index % self.arity
                path.append((at, "".join(texts[:at] + texts[at + 1:])))
                index //= self.arity
            yield path


def fold(start: bytes, path: list[tuple[int, str]]) -> bytes:
    """The root that a digest gives with these siblings."""
    now = start
    for at, siblings in path:
        cut = 2 * SIZE * at
        now = hashlib.sha256((siblings[:cut] + now.hex() + siblings[cut:]).encode()).digest()
    return now


# ------------------------------------------------------------------ building

def field(c: Column) -> Column:
    """``-`` if null, else the value's UTF-8 bytes, ``:``, the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, **instead: Column) -> Column:
    """Digest of a row; ``instead`` puts other values in place of columns."""
    of = {c: F.col(f"`{c}`") if c in docs.columns else F.lit(None).cast("string") for c in FIELDS} | instead
    return F.unhex(F.sha2(F.concat(*[field(of[c]) for c in FIELDS]).cast("binary"), 256))


def tree_of(source: Column) -> Column:
    """The key of a source's tree; in order of bytes, the null source comes first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def placed(nodes: DataFrame, name: str) -> DataFrame:
    """Add ``place`` in the tree (by ``by``, then digest, then ``tie``) and ``total``, the tree's number of nodes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part)), pa.array(np.arange(seen, seen + n))],
                                             [*batch.schema.names, "part", "row"])
            seen += n

    kinds = ", ".join(f"{k} {t}" for k, t in nodes.dtypes)
    order = ["tree", F.col("by").asc_nulls_first(), "digest", "tie"]
    rows = C.staged(nodes.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(count, f"{kinds}, part long, row long"), f"{name}-sorted")
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    ahead = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = C.staged(counts.select("tree", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
                                    F.sum("n").over(Window.partitionBy("tree")).alias("total")), f"{name}-counts")
    return rows.join(counts, ["tree", "part"]).select(
        "tree", (F.col("before") + F.col("row") - F.col("first")).alias("place"), "total", "digest", "doc_id", "other")


def _blocks(nodes: DataFrame, height: int, arity: int, name: str) -> DataFrame:
    """One row a block from (tree, place, total, digest, doc_id, other)."""
    most = arity ** height

    def build(part: pa.Table) -> pa.Table:
        part = part.sort_by("place").combine_chunks()
        total, levels = part["total"][0].as_py(), height
        if total <= most:                          # the tree's only block: as high as it needs to be
            levels = next(h for h in range(height + 1) if arity ** h >= total)
        own = Block.build(part["digest"].to_pylist(), levels, arity)
        members = part.select(["doc_id", "other"]).to_pylist()
        first = part.slice(0, 1)
        return pa.table([first["tree"], first["block"], first["total"], pa.array([len(part)]), pa.array([levels], pa.int32()),
                         pa.array([bytes(own.nodes)]), pa.array([members], MEMBERS)],
                        names=["tree", "block", "total", "leaves", "height", "nodes", "members"])

    rows = nodes.withColumn("block", F.expr(f"place div {most}"))
    return C.staged(rows.groupBy("tree", "block").applyInArrow(build, BLOCK), name)


def manifest(nodes: DataFrame, height: int = HEIGHT, arity: int = ARITY, name: str = "merkle") -> list[DataFrame]:
    """Tiers of blocks of the trees over (tree, by, digest, tie, doc_id, other), from the leaves up.

    The last tier has one block for each tree, whose node 0 is the tree's root.
    """
    C.for_python(nodes.sparkSession)
    level = placed(nodes, name)
    tiers = []
    while True:
        tiers.append(_blocks(level, height, arity, f"{name}-{len(tiers)}"))
        if not tiers[-1].agg(F.max("block")).first()[0]:
            return tiers
        # the root of a tree that has one block is a tree of one node on every further tier
        level = tiers[-1].select(
            "tree", F.col("block").alias("place"), F.expr(f"(total + {arity ** height - 1}) div {arity ** height}").alias("total"),
            F.substring("nodes", 1, SIZE).alias("digest"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("other"))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    return tiers[-1].select("tree", F.substring("nodes", 1, SIZE).alias("digest"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):                # a block at a time
            yield batch.slice(i, 1).to_pylist()[0]


def _block_of(row: dict, arity: int) -> tuple[Block, list[tuple[int, str]]]:
    return Block(row["nodes"], row["leaves"], row["height"], arity), [(p["at"], p["siblings"]) for p in row["path"]]


def _as_paths(paths: Iterator[list[tuple[int, str]]], rest: list[tuple[int, str]]) -> pa.Array:
    return pa.array([[{"at": a, "siblings": s} for a, s in [*path, *rest]] for path in paths], PATH_TYPE)


def paths(tiers: list[DataFrame], above: DataFrame, height: int = HEIGHT, arity: int = ARITY) -> DataFrame:
    """Blocks of the lowest tier with ``path``, the siblings from the block's root to the top.

    ``above`` has (tree, path): what follows a tree's root.
    """
    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own, rest = _block_of(row, arity)
            first = row["block"] * arity ** height
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * own.leaves), pa.array(np.arange(first, first + own.leaves)), _as_paths(own.paths(), rest)],
                ["tree", "block", "path"])

    # every tree is block 0 of the highest tier
    known = above.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for k in range(len(tiers) - 1, 0, -1):
        known = C.staged(tiers[k].join(known, ["tree", "block"]).select("tree", "block", "leaves", "height", "nodes", "path")
                         .mapInArrow(hand_down, f"tree string, block long, path {PATH}"), f"merkle-paths-{k}")
    return tiers[0].join(known, ["tree", "block"])


# ------------------------------------------------------------------ the dataset

PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def source_paths(tiers: list[DataFrame], height: int = HEIGHT, arity: int = ARITY) -> DataFrame:
    """(tree, subroot, root, path) of every source: the tree over the subroots and the siblings in it."""
    tops = roots(tiers).select(F.lit("dataset").alias("tree"), F.col("tree").alias("by"), "digest", F.lit(0).cast("long").alias("tie"),
                               F.lit(None).cast("long").alias("doc_id"), F.col("tree").cast("binary").alias("other"))
    dataset = manifest(tops, height, arity, "dataset")

    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own, rest = _block_of(row, arity)
            subroots = [own.get(own.height, i) for i in range(own.leaves)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m["other"].decode() for m in row["members"]]), pa.array(subroots, pa.binary()),
                 pa.array([fold(own.get(0, 0), rest)] * own.leaves, pa.binary()), _as_paths(own.paths(), rest)],
                ["tree", "subroot", "root", "path"])

    end = dataset[-1].select("tree", F.array().cast(PATH).alias("path"))
    return C.staged(paths(dataset, end, height, arity).select("leaves", "height", "nodes", "members", "path")
                    .mapInArrow(hand_down, f"tree string, subroot binary, root binary, path {PATH}"), "source-paths")


def verify(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT, arity: int = ARITY) -> DataFrame:
    """Digests and proof of every row, and whether the row at hand folds to the root.

    ``tampered`` is the text of the row at hand where it is no longer the one that the manifest was built from.
    """
    source = F.col("`source`") if "source" in docs.columns else F.lit(None).cast("string")
    other = F.lit(None).cast("binary") if tampered is None else F.when(tampered.isNotNull(), leaf_digest(docs, text=tampered))
    leaves = C.staged(docs.select(
        tree_of(source).alias("tree"), F.col("doc_id").cast("long").alias("by"), leaf_digest(docs).alias("digest"),
        F.monotonically_increasing_id().alias("tie"), F.col("doc_id").cast("long").alias("doc_id"), other.alias("other")), "leaves")
    tiers = manifest(leaves, height, arity, "sources")
    above = source_paths(tiers, height, arity)
    mine = paths(tiers, above.select("tree", "path"), height, arity).join(above.select("tree", "subroot", "root"), "tree")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        for row in _rows(batches):
            own, up = _block_of(row, arity)
            rest = "".join(s for _, s in up)
            folded: dict[bytes, bytes] = {}        # what a digest in place of the block's root folds to
            cols: list[list] = [[] for _ in kinds]
            for i, (member, path) in enumerate(zip(row["members"], own.paths(), strict=True)):
                leaf = own.get(own.height, i)
                inside = fold(member["other"] or leaf, path)
                if inside not in folded:
                    folded[inside] = fold(inside, up)
                proof = hashlib.sha256(("".join(s for _, s in path) + rest).encode()).hexdigest()
                for c, v in zip(cols, (member["doc_id"], leaf.hex(), row["subroot"].hex(), row["root"].hex(), proof,
                                       folded[inside].hex(), folded[inside] == row["root"]), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return mine.select("leaves", "height", "nodes", "members", "path", "subroot", "root").mapInArrow(prove, PROOF)


def lowered(docs: DataFrame) -> Column:
    """The tampering of the contract: A-Z lower-cased where 5 divides the checksum of doc_id; else null, not tampered."""
    text = F.col("`text`") if "text" in docs.columns else F.lit(None).cast("string")
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, C.lower_az(text))
