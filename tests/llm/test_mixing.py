import random
from collections import Counter, defaultdict

import pytest

from lanwatch.llm import mixing
from tests.llm.util import docs_frame


def reshared(sizes):
    """Targets by the contract's words: share, stop at twice the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, budget, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while budget > 1e-6 and open_:
        total, over = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += budget * weight[s] / total
            if target[s] >= 2 * sizes[s]:
                over += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                open_.discard(s)
        budget = over
    return target


def corpus(n=600):
    r = random.Random(4)
    rows = [(i, " ".join("w" * r.randrange(1, 60)), "en", r.choice(["a", "a", "a", "a", "b", "c", "é", None])) for i in range(n)]
    return rows + [(9000, None, "en", "zero"), (9001, "", "en", "zero"), (None, "one two", None, "b")] + rows[:2]


def test_targets_and_takes(spark):
    rows = corpus()
    got = mixing.mix(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len((r[1] or "").split())
    want = reshared(size)
    source = {r[0]: r[3] for r in rows}
    taken, partly = Counter(), Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.position_2 is None) == (r.taken <= r.size)
        assert r.position_2 is None or r.position < r.position_2
        taken[s] += r.taken
        partly[s] += r.size > 0 and r.taken % r.size > 0
    for s in size:
        assert abs(taken[s] - want[s]) < 1 and partly[s] <= 1
    first = [r.position for r in got if r.position is not None]
    assert first == sorted(first)
    again = mixing.mix(docs_frame(spark, rows[::-1])).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.taken, r.position or 0, r.position_2 or 0)
    assert sorted(got, key=key) == sorted(again, key=key)


def test_demand_follows_the_schedule(spark):
    rows = [(i, "w " * 10, None, s) for i, s in enumerate("ab" * 500)]
    got = [(x, "ab"[r.doc_id % 2]) for r in mixing.mix(docs_frame(spark, rows)).collect()
           for x in (r.position, r.position_2) if x is not None]
    # the first source's weight falls from 1.5 to 0.5, the last one's rises
    for s, slope in (("a", -0.5), ("b", 0.5)):
        p = sorted(x for x, t in got if t == s)
        assert sum(x <= 0.5 for x in p) / len(p) == pytest.approx((1 - slope) * 0.5 + slope * 0.25, abs=0.01)
        assert all(0 <= x <= 1 for x in p)


def test_stage_repeats_and_orders(spark):
    rows = corpus(200)
    df = docs_frame(spark, rows).selectExpr("*", "1 AS position", "'x' AS _row", "n_chars AS size")
    out = mixing.stage(spark, df, "")
    assert out.columns == df.columns
    n = Counter((r.doc_id, r.text) for r in out.collect())
    want = Counter()
    for r in mixing.mix(df).collect():
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        want[(r.doc_id, text)] += r.copies
    assert n == +want
    pos = [r.position for r in mixing.ordered(docs_frame(spark, rows)).collect()]
    assert pos == sorted(pos)


def test_repeated_rows(spark):
    """Thousands of equal rows, without an id: each is taken by its own place, and the rows keep their other columns."""
    rows = [(None, "a b c d", str(i), "x") for i in range(3000)] + [(i, "e f g", None, "yz"[i % 2]) for i in range(500)]
    df = docs_frame(spark, rows)
    got = [r for r in mixing.mix(df).collect() if r.doc_id is None]
    assert len(got) == 3000 and abs(sum(r.taken for r in got) - got[0].target) < 1
    out = mixing.ordered(df).select("_row.*", "position").filter("source = 'x'").collect()
    assert len({r.position for r in out}) == len(out) == sum(r.copies for r in got)
    n = Counter(r.lang for r in out)
    assert max(n.values()) - min(n.get(str(i), 0) for i in range(3000)) <= 1


def test_empty(spark):
    assert mixing.mix(docs_frame(spark, [])).collect() == []
    assert mixing.stage(spark, docs_frame(spark, []), "").collect() == []
    assert [r.target for r in mixing.mix(docs_frame(spark, [(1, None), (2, "")])).collect()] == [0.0, 0.0]
