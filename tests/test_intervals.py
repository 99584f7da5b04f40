import random

from pyspark.sql import functions as F

from lanwatch.operators import intervals as I


def test_blocks_partition_each_interval(spark):
    r = random.Random(5)
    spans = [(a, a + r.randrange(1, 3000)) for a in (r.randrange(0, 5000) for _ in range(200))] + [(0, 1), (7, 8), (0, 4096), (3, 4)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i int, _from long, _to long")
    got = {}
    for x in I.blocks_of(df).collect():
        size = I.RADIX ** x["_level"]
        got.setdefault(x["i"], []).extend(range(x["_block"] * size, (x["_block"] + 1) * size))
    assert {i: sorted(v) for i, v in got.items()} == {i: list(range(a, b)) for i, (a, b) in enumerate(spans)}


def _case(spark, seed):
    r = random.Random(seed)
    spans = [(r.choice(["a", "b", None]), i, a, a + r.randrange(1, 90)) for i in range(120) for a in [r.randrange(200)]]
    points = [(r.choice(["a", "b", None]), p, 300, f"p{n}") for n, p in enumerate(r.choices(range(300), k=80))]
    points = list({(g, p): (g, p, s, n) for g, p, s, n in points}.values())
    return spans, points, spark.createDataFrame(spans, "g string, v int, _from long, _to long"), \
        spark.createDataFrame(points, "g string, _pos long, _size long, name string")


def test_covering_against_all_pairs(spark):
    for seed in (1, 2):
        spans, points, iv, pt = _case(spark, seed)
        want = {n: sorted(v for h, v, a, b in spans if h == g and a <= p < b) for g, p, _, n in points}
        want = {n: v for n, v in want.items() if v}
        got = {x["name"]: list(x["_items"]) for x in I.covering(pt, iv, ["g"], F.col("v")).collect()}
        assert got == want
        least = {x["name"]: list(x["_items"]) for x in I.covering(pt, iv, ["g"], F.col("v"), 3).collect()}
        assert least == {n: v[:3] for n, v in want.items()}


def test_no_points_no_intervals(spark):
    _, _, iv, pt = _case(spark, 3)
    assert I.covering(pt.where("false"), iv, ["g"], F.col("v")).count() == 0
    assert I.covering(pt, iv.where("false"), ["g"], F.col("v"), 2).count() == 0
