import hashlib
import random
import zlib

import numpy as np
import pytest

from lanwatch.llm import runs
from lanwatch.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm.util import docs_frame


def brute_runs(words, least=6, exponent=4):
    """All lags, each compared over the whole text; a stretch counts if no smaller lag holds all over it."""
    n, out = len(words), []
    of = {}
    ids = np.array([of.setdefault(w, len(of)) for w in words], np.int64)
    for q in range(1, n // exponent + 1):
        same = np.concatenate(([0], (ids[q:] == ids[:-q]).astype(np.int8), [0]))
        edge = np.diff(same)
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            length = j - i + q
            own = ids[i:i + length]
            if length >= max(least, exponent * q) and not any((own[d:] == own[:-d]).all() for d in range(1, q)):
                out.append((i, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words, found):
    gone = set()
    for s, n, q in found:
        gone.update(range(s + q, s + n))
    return [w for i, w in enumerate(words) if i not in gone]


def brute_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute_runs(words)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(brute_collapse(words, found))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4), sha(lines), sha(kept))


def numbered(texts):
    """find_runs over several texts at once, by text."""
    of = {}
    ids, bounds = [], [0]
    for t, words in enumerate(texts):
        ids += [of.setdefault(w, len(of) + len(texts)) for w in words] + [t]
        bounds.append(len(ids))
    out = [[] for _ in texts]
    for s, n, q in runs.find_runs(np.array(ids, np.int64), np.array(bounds)):
        t = int(np.searchsorted(bounds, s, side="right")) - 1
        out[t].append((s - bounds[t], n, q))
    return out


def periodic(rng, letters):
    out = []
    for _ in range(rng.randint(1, 3)):
        out += [rng.choice(letters) for _ in range(rng.randint(0, 12))]
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 60))]
        out += (unit * 7)[:int(len(unit) * rng.uniform(2, 7))]
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", [f"w{i}" for i in range(500)]])
def test_every_run_is_found_exactly(letters):
    rng = random.Random(len(letters))
    texts = [periodic(rng, letters) for _ in range(120)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a"] * 400]
    assert numbered(texts) == [brute_runs(t) for t in texts]


def test_nested_and_touching_runs():
    inner = (["x", "y"] * 5 + ["z"]) * 5                      # runs of period 2 inside one of period 11
    texts = [inner, inner + inner[::-1], ["a"] * 20 + ["b"] * 20, list("abcabcabcabcab") * 3, list("aab" * 40 + "aac" * 40)]
    assert numbered(texts) == [brute_runs(t) for t in texts]


def test_every_period_and_bare_length():
    """Exactly four periods, for all periods over several scales, and one word less."""
    rng = random.Random(5)
    for q in [*range(1, 40), 51, 52, 78, 79, 118, 119, 177, 178]:
        unit = [rng.randint(0, 3) for _ in range(q)]
        for n in (4 * q, 4 * q - 1, 4 * q + 1):
            words = ["<"] + (unit * 5)[:n] + [">"]
            assert numbered([words]) == [brute_runs(words)], (q, n)


def test_long_period_in_a_very_long_text(spark):
    rng = random.Random(2)
    unit = [f"v{rng.randint(0, 9000)}" for _ in range(40_000)]
    words = ["head"] * 3 + unit * 4 + unit[:17] + ["tail"]
    row = runs.periodic_runs(docs_frame(spark, [(1, " ".join(words))])).first()
    assert row.n_words == len(words)
    assert [tuple(r) for r in row.runs] == [(3, 160_017, 40_000)]
    assert row.text.split(" ") == ["head"] * 3 + unit + ["tail"]


def test_fewer_than_four_periods_is_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.arange(3), np.array([0, 3]), exponent=3)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "one"), (5, "a a a a a a"), (5, "a a a a a a"), (None, "b b b b b b b"),
            (6, "é\x1cé é\x1cé é\x1cé\né\x1cé\té\x1cé é\x1cé"), (7, "           "),
            (8, "x " * 30_000), (9, "😀 b " * 9)]
    docs = docs_frame(spark, rows)
    got = runs.digests(runs.periodic_runs(runs.planted(docs.withColumn("runs", docs["text"]).withColumn("w", docs["text"]))))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(brute_row(*r)) for r in rows)
    empty = runs.digests(runs.periodic_runs(runs.planted(docs.limit(0))))
    assert empty.columns == got.columns and not empty.collect()


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: brute_row(d.doc_id, d.text) for d in docs if len((d.text or "").split()) < 1200}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF001).collect()}
    assert len(got) == len(docs) and len(want) > 0.9 * len(docs)
    assert {k: got[k] for k in want} == want
    assert sum(r[1] > 0 for r in got.values()) >= 10
