import random

import numpy as np
import pytest

from lanwatch.llm import common, flatfiles, tokens
from tests.llm.util import docs_frame


def brute(files, end):
    out = set()
    for name, ids in files.items():
        start, n = 0, 0
        for k, v in enumerate(ids):
            if v == end:
                out.add((name, n, start, k - start, True))
                start, n = k + 1, n + 1
        if start < len(ids):
            out.add((name, n, start, len(ids) - start, False))
    return out


def test_scan_against_brute_force(spark, tmp_path, monkeypatch):
    r = random.Random(6)
    files = {"part-a": [9] * 5, "part-b": [1] * 20, "part-c": [], "part-d": [9], "part-e": [1] * 7 + [9], "part-f": [9] + [2] * 9}
    files |= {f"part-{k}": [r.choice([1, 2, 3, 9]) if k % 2 else r.choice([9] + [1] * 30) for _ in range(r.randrange(200))] for k in range(8)}
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / f"{name}.bin")
    monkeypatch.setattr(flatfiles, "RUN", 3)
    for block in (1, 4, 7, 1000):
        for folder in (str(tmp_path), f"file://{tmp_path}"):
            got = [tuple(x) for x in flatfiles.scan(spark, folder, end=9, block=block).collect()]
            assert len(got) == len(set(got)) and set(got) == brute(files, 9)
            if block != 4:
                break


def test_odd_bytes_raise(spark, tmp_path):
    (tmp_path / "part-x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no whole number"):
        flatfiles.scan(spark, str(tmp_path)).collect()


def test_counts_of_documents(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "<|endoftext|>"), (7000, None), (7001, ""), (7002, "long text " * 5000)] + rows[:2]
    df = docs_frame(spark, rows).selectExpr("*", "'x' AS file", "1 AS ids")
    got = flatfiles.token_counts(df, block=512).collect()
    want = sorted((str(d), len(t.encode(x or "", add_special_tokens=False).ids)) for d, x in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want
    assert flatfiles.token_counts(docs_frame(spark, [])).collect() == []
    assert common.scratch_path(spark, "a") != common.scratch_path(spark, "a")
