"""The pipeline against a plain Python version of its stages, on a small table."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lanwatch.llm import common, mixing, quality, surrogates, tokens
from tests.llm.test_simhash import brute_components, brute_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, over the small table."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(common.staged(f(spark, out[-1], sf), f"test-{name}"))
    return out


def test_each_stage_against_its_input(stages):
    docs, good, kept, clean, mixed, packed = stages
    for df in stages[1:5]:
        assert df.columns == docs.columns == COLUMNS and df.dtypes == docs.dtypes
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(docs).collect()}
    assert rows(good) == Counter({r: n for r, n in rows(docs).items() if verdict[r[0]]})
    before = list(rows(good))
    first = brute_components([r[0] for r in before], [brute_fingerprint(r[1]) for r in before])
    assert rows(kept) == Counter(r for r, c in zip(before, first, strict=True) if r[0] == c)
    new = {r.doc_id: r.text for r in surrogates.replace_personal_data(kept).collect()}
    assert rows(clean) == Counter((d, new[d], lang, s, len(new[d])) for d, _, lang, s, _ in rows(kept))
    taken = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert rows(mixed) == +Counter({r: n * taken[r[0]] for r, n in rows(clean).items()})


def test_packing_holds_every_token(stages):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    mixed, packed = stages[4], stages[5].toPandas()
    want = Counter()
    for r in mixed.collect():
        ids = np.array([*t.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        want.update((r.doc_id, k, zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096))
    assert Counter(zip(packed.doc_id, packed.start, packed.ids_crc32, strict=True)) == want
    assert packed.groupby("sequence_id").length.sum().max() <= 4096


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(map(tuple, got.select(key).collect())) == Counter(map(tuple, stages[-1].select(key).collect()))


def test_odd_table(spark, tmp_path):
    """Nulls in every column, repeated rows, clashing names; and an empty table."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    rows = [(1, text, "en", "a", 3, 1, "x"), (1, text, "en", "a", 3, 1, "x"), (None, text + "more words", None, None, None, None, None),
            (2, None, "en", "a", 0, 0, ""), (3, "", None, "b", 0, 0, ""), (None, None, None, None, None, None, None),
            (4, "mail a.b@site.org " + text * 2 + "other", "fr", "b", 9, 2, "y")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, position long, _row string"
    for data in (rows, []):
        folder = str(tmp_path / f"t{len(data)}")
        df = spark.createDataFrame(data, schema)
        df.write.parquet(f"{folder}/documents.parquet")
        d = spark.read.parquet(f"{folder}/documents.parquet")
        for _, f in corpus_pipeline.STAGES[:4]:
            out = common.staged(f(spark, d, folder), "odd")
            assert out.columns == df.columns
            d = out
        assert corpus_pipeline.run(spark, folder).count() >= bool(data)
