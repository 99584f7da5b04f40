import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lanwatch.llm import common, mixing, packing, tokens
from tests.llm.util import docs_frame


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


ODD = ["", " ", "a", "It's fine, isn't it? A.B. ,, .. x,", "H̱ Ǩ ẖ", "İstanbul İ été ÜBER, straße.",
       "你好 world \U0001f600 ok", "a b c d\x1ce", "<|endoftext|> <|startoftext|>x </w> a</w>", "ΣΑΣ Σ.", "12345 1,000.50 a1b2 ²½ªº",
       "ͅ ǅ ŉ ẞﬁ x", "tabs\tand\nlines\r\n\x0b\x0c end", "don't we'll I'd 'S 'RE", "\x00\x01 nul a\x00b"]


def test_ids_are_the_tokenizers(whole, monkeypatch):
    r = random.Random(3)
    texts = ODD + ["".join(r.choice("ab \n.,'éEİQ1-́") for _ in range(r.randrange(60))) for _ in range(400)]
    texts += [" ".join(r.choices(ODD, k=5)) for _ in range(100)]
    for cache, size in ((500_000, 1 << 25), (5, 50)):
        monkeypatch.setattr(tokens, "CACHE", cache)
        monkeypatch.setattr(tokens, "SLICE_BYTES", size)
        ids, at = tokens.WordEncoder(tokens.default_path()).batch(pa.array(texts))
        for k, t in enumerate(texts):
            assert ids[at[k]:at[k + 1]].tolist() == whole(t), repr(t)


def test_best_fit_against_brute_force():
    r = random.Random(2)
    for _ in range(30):
        lengths = sorted((r.randrange(1, 65) for _ in range(r.randrange(80))), reverse=True)
        free, want = [], []
        for n in lengths:
            fit = min((c for c in free if c >= n), default=None)
            if fit is None:
                free.append(64 - n)
                want.append(64)
            else:
                free[free.index(fit)] -= n
                want.append(fit)
        got = packing.best_fit(lengths, 64)
        assert [64 - o for _, o in got] == want


def test_packing_of_documents(spark, whole):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "null id"), (5000, None), (5001, ""), (5002, "word " * 9000)] + rows[:2]
    got = packing.pack(docs_frame(spark, rows)).toPandas()
    want = {}
    for d, t in rows:
        ids = np.array([*whole(t or ""), 2], "<u4")
        want.setdefault(-1 if d is None else d, []).append(ids)
    for d, part in got.fillna({"doc_id": -1}).groupby("doc_id"):
        ids, copies = want.pop(int(d))[0], len(want.get(int(d), [0]))
        assert set(part.doc_tokens) == {len(ids)}
        for p in part.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
        starts = part.drop_duplicates("start").sort_values("start")
        assert starts.length.sum() == len(ids) and (starts.start == starts.length.cumsum() - starts.length).all() and copies
    assert not want
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq.offset == seq.length.cumsum() - seq.length).all() and seq.length.sum() <= 4096
        assert set(seq.padded) == {seq.length.sum() if int(seq.length.sum()).bit_count() == 1 else 4096}
    seqs = got.groupby("sequence_id").agg(n=("length", "sum"), padded=("padded", "max"))
    assert seqs.n.sum() / seqs.padded.sum() > 0.9


def test_groups_and_empty(spark):
    df = docs_frame(spark, [(i, "a b c " * (i % 7)) for i in range(100)])
    got = packing.pack(df, window=16, group=10).toPandas()
    assert got.groupby("doc_id").length.sum().tolist() == [3 * (i % 7) + 1 for i in range(100)]
    assert got.groupby("sequence_id").length.sum().max() <= 16
    assert packing.pack(docs_frame(spark, [])).collect() == []


def test_sequences_follow_the_written_order(spark, tmp_path):
    # part files of falling and rising sizes: Spark lists them by size, not by number
    folder, rows = str(tmp_path / "t"), []
    for k, n in enumerate((5, 60, 1, 90, 30)):
        part = [(len(rows) + i, "word " * (1 + (len(rows) + i) * 7 % 40)) for i in range(n)]
        docs_frame(spark, part).coalesce(1).sort("doc_id").write.parquet(f"{folder}-{k}")
        (tmp_path / "t").mkdir(exist_ok=True)
        made, = (tmp_path / f"t-{k}").glob("part-*")
        (tmp_path / "t" / made.name.replace("part-00000", f"part-{k + 99997:05d}")).write_bytes(made.read_bytes())
        rows += part
    got = packing.pack(spark.read.parquet(folder), window=16, group=20).toPandas().sort_values(["doc_id", "start"])
    n = len(got)
    groups = -(-n // 20)
    assert (got.sequence_id // 2**32).tolist() == [k * groups // n for k in range(n)]
    first = got.assign(at=range(n)).groupby("sequence_id")["at"].min()
    assert first.is_monotonic_increasing


def test_sequences_follow_the_curriculum(spark):
    rows = [(i, f"word{i} " * (5 + i % 30), "en", "abc"[i % 3]) for i in range(600)]
    mixed = common.staged(mixing.ordered(docs_frame(spark, rows)).select("_row.*", "position"), "mixed")
    where = mixed.select("doc_id", "position").toPandas().groupby("doc_id").position.agg(["min", "max"])
    got = packing.pack(mixed, group=40).toPandas().join(where, "doc_id")
    once = got[got["min"] == got["max"]]
    by_group = once.groupby(once.sequence_id // 2**32)["min"].agg(["min", "max"])
    assert len(by_group) > 5 and (by_group["max"].to_numpy()[:-1] <= by_group["min"].to_numpy()[1:]).all()


def test_special_tokens_are_the_unmodified_tokenizers(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    texts = ODD + ["a<|endoftext|>b", "<|startoftext|>", "x <|other|> <|", "<|ENDOFTEXT|> y", "a <|endoftext|>"] + [" ".join(ODD)]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert 49407 in want[len(ODD)]
    ids, at = tokens.WordEncoder(tokens.default_path(), special=True).batch(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    got = packing.pack(docs_frame(spark, list(enumerate(texts)))).toPandas().sort_values("doc_id")
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for x in want]
