import math

import numpy as np
from pyspark.sql import functions as F

from lanwatch.llm import topk


def brute(rows, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in ok if i is not None and i % 20 == 0}:
        s = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i is None, i or 0) for i, v in ok if i != q)
        out += [(q, r, None if none else i, -t) for r, (t, none, i) in enumerate(s[:k], 1)]
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def run(df, k=20):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(df, F.col("vec_id") % 20 == 0, k).collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(1)
    centres = r.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.1 * r.normal(size=8)]) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(60)]                # a group of copies: ties
    rows += [(600, None), (620, []), (640, [1.0, None]), (660, [float("nan")] * 8), (680, [float("inf")] * 8), (700, [0.5, -0.5]), (None, rows[3][1])]
    rows += [rows[20], rows[21], (720, [0.0] * 8), (1001, [-40.0] * 8)]
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "CHUNK", 4)
    assert run(table(spark, rows), 5) == brute(rows, 5)


def test_few_rows(spark):
    for rows in ([], [(20, None)], [(20, [1.0])], [(20, [1.0]), (40, [2.0]), (41, [1.0])], [(20, [0.0, 0.0])] * 3 + [(2, [0.0, 0.0])]):
        assert run(table(spark, rows)) == brute(rows, 20)


def test_bounds_eliminate():
    r = np.random.default_rng(2)
    x = np.floor(64 * (r.normal(size=(10, 8))[r.integers(0, 10, 3000)] + 0.02 * r.normal(size=(3000, 8))))
    x = np.floor(x / np.linalg.norm(x, axis=1, keepdims=True) * 640)
    p = x[:16]
    d = np.sqrt(((x[:, None] - p[None]) ** 2).sum(2))
    ids = np.arange(3000)
    for i, best, scores, done in topk.evaluate(x[:40], d[:40], np.full(40, -np.inf), ids[:40], x, d, ids, 5):
        s = x @ x[i]
        s[i] = -np.inf
        want = np.lexsort((ids, -s))[:5]
        assert (best == want).all() and (scores == s[want]).all() and done < 2000


def test_equal_rows_beside_a_second_cell(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    rows = [(1, [1.0, 0.0])] * 60 + [(100 + i, [-5.0 - i / 64, 9.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = topk.search(df, F.col("vec_id") == 101, 29).collect()
    ints = [(i, [int(64 * x // 1) for x in v]) for i, v in rows]
    q = dict(ints)[101]
    want = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in ints if i != 101)[:29]
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]
