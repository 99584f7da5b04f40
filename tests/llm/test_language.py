import zlib

import numpy as np

from lanwatch.llm import language
from tests.llm.util import docs_frame


def brute_counts(text):
    n, s = np.zeros(language.BUCKETS, int), " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    for a, b, c in zip(s, s[1:], s[2:], strict=False):
        if b != " ":
            m = 2**32 - 1
            h = (ord(a) * 0x9E3779B1 & m) ^ (ord(b) * 0x85EBCA6B & m) ^ (ord(c) * 0xC2B2AE35 & m)
            n[(((h ^ h >> 15) * 0x2C1B3C6D) & m) >> 20] += 1
    return n


def test_counts_against_brute_force(monkeypatch):
    texts = ["", "a", "Ab c", "12 !", "été à Ünter\nİx", "x" * 50, "\x00z 你好\U0001f600"]
    want = [brute_counts(t) for t in texts]
    for block in (1 << 20, 3):
        monkeypatch.setattr(language, "BLOCK", block)
        assert (language.counts(texts) == want).all()


def test_em_climbs_and_finds_the_shares():
    r = np.random.default_rng(0)
    p = r.dirichlet(np.full(200, 0.1), 4) * 0.999 + 0.001 / 200
    p /= p.sum(axis=1, keepdims=True)
    true = np.array([[1, 0, 0, 0], [0.6, 0, 0.4, 0], [0.2, 0.5, 0, 0.3]])
    n = np.array([r.multinomial(4000, t @ p) for t in true])
    got = language.mixtures(n, p)
    assert np.abs(got - true).max() < 0.05 and ((got > 0) == (true > 0)).all()
    pi = np.full((3, 4), 0.25)
    before = (n * np.log(pi @ p)).sum(axis=1)
    _, after = language.em(n, pi, p)
    # the batch form equals a plain loop over one text
    q = np.full(4, 0.25)
    for _ in range(language.MAX_STEPS):
        q = np.array([sum(n[1][g] * q[k] * p[k][g] / sum(q[j] * p[j][g] for j in range(4)) for g in range(200)) for k in range(4)]) / n[1].sum()
    assert (after > before).all() and np.abs(got[1] - q).max() < 0.05


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.language_mixture(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred == "und" or (abs(sum(m.share for m in r.mixture) - 1) < 1e-6 and r.mixture[0].lang == r.lang_pred)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    # labels of the held-out fold have no part in the result
    other = docs.selectExpr("doc_id", "text", f"if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'xx', lang) AS lang", "'s' AS source")
    again = {r.doc_id: (r.lang_pred, r.score) for r in language.language_mixture(other).collect()}
    assert again == {r.doc_id: (r.lang_pred, r.score) for r in got}


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, None, "en"), (3, " 12 !", "fr"), (None, "le chat et le chien", "fr"), (5, "", None), (1, "the cat and the dog", "en")]
    rows += [(100 + i, t, lang) for i in range(9) for t, lang in (("the dog is in the house", "en"), ("le chien est dans la maison", "fr"))]
    got = language.language_mixture(docs_frame(spark, rows)).collect()
    pred = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == len(rows) and pred[2] == pred[3] == pred[5] == ("und", 0.0)
    assert pred[1][0] == "en" and pred[None][0] == "fr"
    assert language.language_mixture(docs_frame(spark, [])).collect() == []
    assert [r.lang_pred for r in language.language_mixture(docs_frame(spark, [(1, "abc")])).collect()] == ["und"]


def test_a_texts_result_does_not_depend_on_its_batch():
    r = np.random.default_rng(1)
    p = r.dirichlet(np.full(200, 0.5), 4) * 0.99 + 0.01 / 200
    p /= p.sum(axis=1, keepdims=True)
    n = np.array([r.multinomial(r.integers(20, 3000), r.dirichlet(np.full(4, 0.5)) @ p) for _ in range(40)])
    start = np.full((40, 4), 0.25)
    together, _ = language.em(n, start, p)
    alone = np.concatenate([language.em(n[i:i + 1], start[:1], p)[0] for i in range(40)])
    assert np.abs(together - alone).max() < 1e-12 and (start == 0.25).all()
