"""Property tests: sliding measures equal brute force on random inputs,
whatever the bucket size."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lanwatch.operators import sliding as SL

ROW = st.tuples(st.integers(0, 40), st.sampled_from(["k1", "k2", "hot", "hot", "hot"]),
                st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=60), w=st.integers(1, 15), bucket_mult=st.integers(1, 4))
def test_sliding_matches_brute_force(spark, rows, w, bucket_mult):
    pdf = pd.DataFrame([(i, t, k, v) for i, (t, k, v) in enumerate(rows)], columns=["seq", "ts_us", "key", "val"])
    df = spark.createDataFrame(pdf, "seq long, ts_us long, key string, val string")
    got = {r["seq"]: (r["nc"], r["nd"]) for r in
           SL.sliding_distinct(df, "key", "val", w, "nd", bucket_us=w * bucket_mult, count_out="nc").collect()}
    for r in pdf.itertuples():
        g = pdf[(pdf.key == r.key) & (pdf.ts_us > r.ts_us - w)
                & ((pdf.ts_us < r.ts_us) | ((pdf.ts_us == r.ts_us) & (pdf.seq <= r.seq)))]
        assert got[r.seq] == (len(g), g.val.dropna().nunique())
