import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanwatch.llm import merkle
from lanwatch.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm.util import DOCS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join(map(value, (doc_id, source, lang, n_chars, text))))


def tree(leaves, arity):
    """(root, per leaf the list of (place in the run, siblings)), level by level as lists."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // arity * arity:i // arity * arity + arity]
            paths[k].append((i % arity, run[:i % arity] + run[i % arity + 1:]))
        at = [i // arity for i in at]
        level = [sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)]
    return level[0], paths


def brute(rows, arity=16):
    """rows: (doc_id, text, lang, source, n_chars)"""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(r[0], r[3], r[2], r[4], r[1]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])], arity) for s in order}
    root, tops = tree([trees[s][0] for s in order], arity)
    out = []
    for s, top in zip(order, tops, strict=True):
        subroot, paths = trees[s]
        for (_, _, leaf, r), path in zip(sorted(by[s], key=lambda x: x[:3]), paths, strict=True):
            whole = path + top
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf_of(r[0], r[3], r[2], r[4], text)
            for at, siblings in whole:
                now = sha("".join([*siblings[:at], now, *siblings[at:]]))
            out.append((r[0], leaf, subroot, root, sha("".join("".join(x) for _, x in whole)), now, now == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_layout_is_a_permutation_of_aligned_halves(arity):
    for levels in range(1, 6 if arity < 16 else 4):
        every = np.concatenate([merkle.addresses(d, levels, arity) for d in range(levels)])
        assert sorted(every.tolist()) == list(range(merkle.size_of(levels, arity)))
        top = levels // 2
        if top:
            # the top half comes first; each bottom subtree is contiguous and laid out as a tree of its own
            assert max(merkle.addresses(d, levels, arity).max() for d in range(top)) == merkle.size_of(top, arity) - 1
            size = merkle.size_of(levels - top, arity)
            for which in range(arity ** top):
                for d in range(levels - top):
                    part = merkle.addresses(top + d, levels, arity)[which * arity ** d:(which + 1) * arity ** d]
                    base = merkle.size_of(top, arity) + which * size
                    assert (part - base).tolist() == merkle.addresses(d, levels - top, arity).tolist()


@pytest.mark.parametrize("leaves", [1, 2, 4, 5, 9, 26, 27])
def test_block_paths_fold_to_its_root(leaves):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(leaves)]
    own = merkle.Block.build(digests, 3, 3)
    level = [d.hex() for d in digests]
    for _ in range(3):
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    assert [own.get(0, 0).hex()] == level
    for d, path in zip(digests, own.paths(), strict=True):
        assert merkle.fold(d, path) == own.get(0, 0)
        assert merkle.fold(hashlib.sha256(d).digest(), path) != own.get(0, 0)


def rows_of(n):
    """A hot source, single rows, a null source, empty and null texts, equal rows, large ids."""
    out = []
    for i in range(n):
        source = "hot" if i % 3 else [None, "ä", "z", "", "-", "=", f"s{i % 40}"][i % 7]
        text = None if i % 11 == 0 else "" if i % 13 == 0 else f"Text {i} ÄÖ A:{'B' * (i % 5)}"
        out.append((i if i % 17 else (1 << 60) + i, text, "en" if i % 5 else None, source, i if i % 4 else None))
    return [*out, out[1], out[1], out[5], (None, "No Id", None, "hot", None), (None, "No Id", None, None, 3)]


@pytest.mark.parametrize("height,arity", [(1, 2), (2, 3), (3, 16)])
def test_equals_brute_force(spark, height, arity):
    rows = rows_of(150)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = merkle.verify(docs, merkle.lowered(docs), height, arity)
    assert result(got) == brute(rows, arity)


def test_untampered_rows_verify_and_edges(spark):
    rows = [(7, "x" * 300_000, "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    odd = docs.select("*", F.lit(1).alias("tree"), F.lit("q").alias("digest"), F.lit(None).alias("place"))
    (one,) = merkle.verify(odd).collect()
    assert one.verified and one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("")
    assert merkle.verify(docs.limit(0), merkle.lowered(docs.limit(0))).collect() == []
    (bare,) = merkle.verify(docs.select("doc_id")).collect()
    assert bare.leaf == leaf_of(7, None, None, None, None)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = result(QUERIES["op12_merkle_manifest"](spark, SF001))
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 2
