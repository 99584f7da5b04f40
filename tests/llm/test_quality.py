import random
from collections import Counter, defaultdict

from lanwatch.llm import quality
from tests.llm.util import docs_frame

SPACE = " \t\n\x0b\x0c\r"


def brute_words(t):
    for c in SPACE[1:]:
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w]


def brute(rows):
    out = []
    for d, t, lang, source in rows:
        t = t or ""
        w = brute_words(t)
        wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {i + k for i in range(len(w) - 7) if wins[tuple(w[i:i + 8])] > 1 for k in range(8)}
        lines = [x for x in t.split("\n") if brute_words(x)]
        chars, sym, dup = sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines))
        marks = sum(c in "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~" for c in t)
        grid = [1000 * a // b if b else 0 for a, b in ((sym, chars), (dup, len(lines)), (len(hit), len(w)), (marks, chars))]
        out.append((d, lang, source, len(w), chars, sym, dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w), grid))
    floors, use = list(quality.FLOORS.values()), (3, 1, 2)
    groups = {(r[1], r[2]) for r in out}

    def fence(m, group=None):
        v = sorted(r[-1][use[m]] for r in out if not r[8] and r[-1][use[m]] and group in (None, (r[1], r[2])))
        q = lambda p: next(x for k, x in enumerate(v, 1) if k >= p * len(v))
        return (len(v), q(0.75) + 3 * (q(0.75) - q(0.25)) // 2) if v else (0, None)

    def middle(v):
        v = sorted(v)
        return v[(len(v) - 1) // 2] if len(v) >= quality.MIN_PEERS else None

    lim = {}
    for m in range(3):
        own = {g: f for g in groups for n, f in [fence(m, g)] if n >= quality.MIN_VALUES}
        for g in groups:
            peers = [x for x in (middle([f for h, f in own.items() if h[0] == g[0]]), middle(own.values())) if x is not None]
            x = next((x for x in (own.get(g), *peers, fence(m)[1]) if x is not None), 0)
            lim[g, m] = max(floors[m], min([x, *[5 * p // 4 for p in peers[:1]]]))
    return sorted(((r[0], *r[3:9], not r[8] and all(r[-1][m] <= lim[r[1:3], m] for m in range(3)),
                    *[lim[r[1:3], m] for m in range(3)]) for r in out), key=str)


def corpus():
    r = random.Random(7)
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \n\t", "en", None), (None, "w " * 30, None, "a"),
            (4, "a b c d e f g h " * 2 + " ".join(f"x{i}" for i in range(60)), "en", "a"), (5, "一 二\x0b三 四 " * 9, "zh", "b")]
    for i in range(400):
        lang, source = r.choice(["en", "en", "fr"]), r.choice(["a", "a", "a", "b", "c"])
        n = r.randrange(15, 60)
        words = [r.choice("abcdefgh") * r.randrange(1, 6) + r.choice(["", "", "", "#" * r.randrange(3 if source == "a" else 1)]) for _ in range(n)]
        text = "".join(w + r.choice([" ", " ", "\n"]) for w in words)
        rows.append((10 + i, text + (text[: r.randrange(len(text))] if i % 9 == 0 else ""), lang, source))
    return rows + rows[10:12]


def test_against_brute_force(spark):
    rows = corpus()
    got = sorted((tuple(r) for r in quality.quality_rules(docs_frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    assert 50 < sum(g[7] for g in got) < len(rows)


def test_limits_follow_the_groups(spark):
    """Over 10,000 rows: most groups' limits for symbols are above the floor and not all alike."""
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = quality.quality_rules(df).select("limit_symbols", "limit_lines", "limit_repeats").distinct().collect()
    assert len({g.limit_symbols for g in got}) >= 10
    assert all(g.limit_symbols > quality.FLOORS["symbols"] for g in got)


def test_junk_source_does_not_lift_its_own_limit(spark):
    """One source holds most rows and half of them are junk; its junk goes, as if it were a small source."""
    r = random.Random(3)
    clean = lambda: " ".join("".join(r.choices("abcdefghij", k=5)) + r.choice(["", "", "", "."]) for _ in range(40))
    junk = lambda: " ".join("".join(r.choices("abcdefghij", k=3)) + "#$%" * r.randrange(1, 3) for _ in range(40))
    rows = [(i, clean(), "en", "abcd"[i % 4]) for i in range(400)]
    rows += [(1000 + i, junk() if i % 2 else clean(), "en", "hot") for i in range(1000)]
    got = {g.doc_id: g.kept for g in quality.quality_rules(docs_frame(spark, rows)).collect()}
    assert not any(got[1000 + i] for i in range(1, 1000, 2))
    assert all(k for i, k in got.items() if i < 1000 or i % 2 == 0)


def test_stage_keeps_rows_and_columns(spark):
    rows = corpus()
    df = docs_frame(spark, rows).selectExpr("*", "1 AS n_words", "'x' AS kept", "2 AS a", "text AS _g")
    out = quality.stage(spark, df, "")
    assert out.columns == df.columns
    good = Counter(r[0] for r in brute(rows) if r[7])
    assert Counter(r.doc_id for r in out.collect()) == good


def test_good_labels_are_kept(spark):
    sf = "/root/testdata/sf0.1"
    verdict = quality.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "n_words", "base_failed", "kept")
    seen = verdict.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in seen if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    bad = [r for r in seen if r.quality == 0 and not r.base_failed]
    assert sum(not r.kept for r in bad) >= 0.5 * len(bad)


def test_empty(spark):
    assert quality.quality_rules(docs_frame(spark, [])).collect() == []
    assert quality.stage(spark, docs_frame(spark, []), "").collect() == []
