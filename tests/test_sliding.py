import random

import pandas as pd
import pytest

from lanwatch.operators import sliding as SL

W = 20_000
B = 50_000


@pytest.fixture(scope="module")
def data(spark):
    random.seed(7)
    rows = []
    for i in range(1500):
        k = "hot" if random.random() < 0.6 else f"k{random.randint(0, 4)}"   # one key holds most rows
        v = f"v{random.randint(0, 9)}" if random.random() > 0.1 else None
        rows.append((i, random.randint(0, 300) * 1000, k, v))
    pdf = pd.DataFrame(rows, columns=["seq", "ts_us", "key", "val"])
    exp = {}
    for _, g in pdf.groupby("key"):
        for r in g.itertuples():
            m = g[(g.ts_us > r.ts_us - W) & ((g.ts_us < r.ts_us) | ((g.ts_us == r.ts_us) & (g.seq <= r.seq)))]
            exp[r.seq] = (len(m), m.val.dropna().nunique())
    return spark.createDataFrame(pdf), pdf, exp


def test_sliding_count_and_distinct(data):
    df, _, exp = data
    out = SL.sliding_distinct(df, "key", "val", W, "nd", bucket_us=B, count_out="nc").collect()
    assert len(out) == len(exp)
    assert all((r["nc"], r["nd"]) == exp[r["seq"]] for r in out)
    out = SL.sliding_count(df, "key", W, "nc", bucket_us=B).collect()
    assert all(r["nc"] == exp[r["seq"]][0] for r in out)


def test_bucket_size_does_not_change_results(data):
    df, _, _ = data
    a = {r["seq"]: r["nd"] for r in SL.sliding_distinct(df, "key", "val", W, "nd", bucket_us=W).collect()}
    b = {r["seq"]: r["nd"] for r in SL.sliding_distinct(df, "key", "val", W, "nd", bucket_us=10 ** 9).collect()}
    assert a == b


def test_running_prev_lastk(data):
    df, pdf, _ = data
    s = pdf.sort_values(["ts_us", "seq"])
    rc = dict(zip(s.seq, s.groupby("key").cumcount() + 1))
    assert all(r["rc"] == rc[r["seq"]] for r in SL.running_count(df, "key", "rc", bucket_us=B).collect())
    prev = dict(zip(s.seq, s.groupby("key").seq.shift(1)))
    for r in SL.prev_in_key(df, "key", ["val"], bucket_us=B).collect():
        want = prev[r["seq"]]
        assert (r["prev_seq"] is None and pd.isna(want)) or r["prev_seq"] == want
    order = {k: list(g.seq) for k, g in s.groupby("key")}
    pos = {q: (k, i) for k, l in order.items() for i, q in enumerate(l)}
    for r in SL.last_k_before(df, "key", ["val"], 3, "h", bucket_us=B).collect():
        k, i = pos[r["seq"]]
        assert [e["seq"] for e in r["h"]] == order[k][max(0, i - 3):i]


def test_halo_requires_bucket_at_least_window(data):
    df, _, _ = data
    with pytest.raises(ValueError):
        SL.with_halo(df, "key", W, bucket_us=W - 1)


def _window(pdf, key, t, seq):
    g = pdf[(pdf.key == key) & (pdf.ts_us > t - W) & ((pdf.ts_us < t) | ((pdf.ts_us == t) & (pdf.seq <= seq)))]
    return g


def test_window_members_against_brute_force(data):
    from lanwatch.operators import rules as R
    df, pdf, exp = data
    least = 4
    own = {r.seq: r for r in pdf.itertuples()}
    want = {s for s, (_, nd) in exp.items() if nd >= least}
    for k in (None, 3):
        out = R.window_members(df, "key", "val", W, least, bucket_us=B, max_members=k).collect()
        assert {r["seq"] for r in out} == want and len(out) == len(want) > 100
        for r in out:
            g = _window(pdf, own[r["seq"]].key, r["ts_us"], r["seq"])
            counts = g.val.dropna().value_counts().to_dict()
            assert r["key"] == own[r["seq"]].key and r["n_rows"] == len(g) and r["n_distinct"] == len(counts)
            members = [(m["value"], m["n"]) for m in r["members"]]
            assert members == (sorted(counts.items()) if k is None else [(v, None) for v in sorted(counts)[:k]])
