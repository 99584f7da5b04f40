import random

import numpy as np
import xxhash

from lanwatch.llm import simhash
from tests.llm.util import docs_frame, find


def brute_fingerprint(text):
    out, cur = [], ""
    for ch in (text or ""):
        if ch in " \t\n\x0b\x0c\r":
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += ch.lower() if "A" <= ch <= "Z" else ch
    if cur:
        out.append(cur)
    if not out:
        return 0
    sh = [" ".join(out[i:i + 3]) for i in range(max(1, len(out) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, k=2):
    parent = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= k:
                parent[find(parent, i)] = find(parent, j)
    low = {}
    for i, d in enumerate(ids):
        r = find(parent, i)
        if d is not None and (low.get(r) is None or d < low[r]):
            low[r] = d
        low.setdefault(r, None)
    return [low[find(parent, i)] for i in range(len(fps))]


def test_fingerprint_against_brute_force():
    r = random.Random(1)
    for text in [None, "", " \n", "A", "a B", "É x y z", *[" ".join(r.choice("abcdÉ") for _ in range(n)) for n in (3, 5, 200)]]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_blocks_add_up(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole


def test_links_against_brute_force(spark):
    r = random.Random(5)
    fps = set()
    for _ in range(60):
        f = r.getrandbits(64)
        fps.add(f)
        for _ in range(r.randrange(6)):
            for _ in range(r.randrange(1, 5)):
                f ^= 1 << r.randrange(64)
            fps.add(f)
    hub = r.getrandbits(64)
    fps |= {hub ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a)} | {0, 2**64 - 1}
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for k in (0, 2):
        got = simhash.links(df, k).collect()
        assert len(got) < 200 * len(fps)
        place, parent = {f: i for i, f in enumerate(signed)}, list(range(len(fps)))
        for e in got:
            assert (int(e.a) ^ int(e.b)) & (2**64 - 1) and ((int(e.a) ^ int(e.b)) & (2**64 - 1)).bit_count() <= k
            parent[find(parent, place[e.a])] = find(parent, place[e.b])
        want = brute_components(list(range(len(fps))), fps, k)
        low = {}
        for i in range(len(fps)):
            low.setdefault(find(parent, i), i)
        assert [low[find(parent, i)] for i in range(len(fps))] == want


def test_operator_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "a b c"), (9001, None), (9002, ""), (9003, " \n"), (None, None)]
    rows += rows[:3]
    df = docs_frame(spark, rows)
    got = sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id is None, r.component_id) for r in simhash.near_duplicates(df).collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components([d for d, _ in rows], fps)
    want = sorted((d is None, d, f"{f:016x}", c is None, c) for (d, _), f, c in zip(rows, fps, comp, strict=True))
    assert got == want


def test_stage_keeps_one_of_each_group(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (1, "a b c d"), (3, "x y z w v"), (None, "x y z w v"), (4, None), (5, ""), (None, "lone words here")]
    df = docs_frame(spark, rows).selectExpr("*", "doc_id AS h", "'q' AS keeper", "text AS _h")
    out = simhash.stage(spark, df, "")
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "lone words here"), (1, "a b c d"), (3, "x y z w v"), (4, "")]


def test_empty(spark):
    df = docs_frame(spark, [])
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.stage(spark, df, "").collect() == []
