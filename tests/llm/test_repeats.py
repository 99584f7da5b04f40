import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lanwatch.llm import repeats
from tests.llm.util import docs_frame


def brute(rows):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + 400] for r in raws for i in range(len(r) - 399))
    out = []
    for (d, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - 399):
            if seen[r[i:i + 400]] > 1:
                gone[i + 1:i + 401] = True
        kept = bytes(b for b, g in zip(r, gone[1:], strict=False) if not g)
        out.append((d, len(r), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(8)
    rand = lambda n, a="abcdé \n": "".join(r.choice(a) for _ in range(n))
    passage, base = rand(430), rand(1500)
    rows = [(1, None), (2, ""), (3, "x" * 399), (4, "y" * 401), (5, "ab" * 700), (6, "q" + "ab" * 300), (7, base), (8, base), (None, rand(700))]
    for i in range(25):
        rows.append((10 + i, rand(r.randrange(300)) + passage[r.randrange(3):430 - r.randrange(30)] + rand(r.randrange(300))))
    for i in range(12):                    # near copies with a few edits
        t = list(base)
        for _ in range(r.randrange(1, 4)):
            t[r.randrange(len(t))] = "#"
        rows.append((50 + i, "".join(t)))
    rows += [(80, rand(900, "a")), (81, base[:450] + base[300:900]), (82, base[200:600]), (83, base[200:599])] + rows[6:7]
    return rows


def run(spark, rows, **kw):
    return sorted((tuple(x) for x in repeats.remove_repeats(docs_frame(spark, rows), **kw).collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_many_contexts_are_counted(spark):
    rows = corpus()
    assert run(spark, rows, limit=3) == brute(rows)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = brute(rows)
    assert run(spark, rows) == want and sum(w[2] for w in want) > 0


def test_empty(spark):
    assert run(spark, []) == []


def test_contexts_hold_every_string_once():
    raw = ("ab" * 500 + "".join(random.Random(1).choices("abc", k=3000))).encode()
    got = repeats.contexts(raw)
    assert [lo for _, _, lo, _, _ in got] == np.cumsum([0] + [n for *_, n in got[:-1]]).tolist() and got[-1][2] + got[-1][4] == len(raw) - 399
    assert all(0 <= left <= 200 and n <= left + 1 for *_, left, n in got)
    shifted = {(c, u, left, n) for c, u, _, left, n in repeats.contexts(b"zz" + raw)}
    assert len([g for g in got if (g[0], g[1], g[3], g[4]) in shifted]) >= len(got) - 2


@pytest.mark.parametrize("seed", range(6))
def test_merge_against_brute_force(seed):
    r = random.Random(seed)
    core = {g: bytes(r.choices(b"ab", k=200)) for g in range(4)}
    rows = []
    for _ in range(60):
        g, left = r.randrange(4), r.randrange(201)
        n = r.randrange(1, left + 2)
        side = lambda k: bytes(97 + (r.random() < 0.01) for _ in range(k))
        rows.append((g, left, n, side(left) + core[g] + side(n + 399 - left - 200)))
    got = repeats.merged_intervals(*[np.array([x[k] for x in rows]) for k in range(3)], [x[3] for x in rows])
    seen = Counter((g, c - left, b[c:c + 400]) for g, left, n, b in rows for c in range(n))
    for (g, left, n, b), parts in zip(rows, got, strict=True):
        assert parts == repeats._covered(np.array([c for c in range(n) if seen[g, c - left, b[c:c + 400]] > 1], int))
