"""State snapshots with commits, mergeable mapping state, quantiles of many columns, evidence for the forest."""

import dataclasses
import random

import numpy as np
import pytest
from conftest import SF001, make_packets
from pyspark.sql import functions as F

from lanwatch.functions.quantiles import column_quantiles
from lanwatch.operators import incidents as I
from lanwatch.operators import rules as R
from lanwatch.operators import trust as T
from lanwatch.plans import catalog  # noqa: F401  loads the query modules in order
from lanwatch.plans import q_ml
from lanwatch.sources import sinks as K


def store(spark, *macs):
    rows = [(m, None, "x", "t") for m in macs]
    return spark.createDataFrame(rows, T.TRUST_SCHEMA)


def macs(spark, path, **kw):
    return sorted(r.mac for r in K.load_state(spark, path, T.TRUST_SCHEMA, **kw).collect())


def test_a_save_that_dies_half_way_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "trust")
    assert K.save_state(store(spark, "a"), path) == 0
    bad = store(spark, "b", "c").repartition(2).withColumn("label", F.when(F.col("mac") == "c", F.raise_error(F.lit("power cut")).cast("string")).otherwise("y"))
    with pytest.raises(Exception, match="power cut"):
        K.save_state(bad, path)
    assert macs(spark, path) == ["a"]
    # written in full, but dead before the commit
    store(spark, "z").write.parquet(f"{path}/version=1", mode="overwrite")
    assert macs(spark, path) == ["a"]
    assert K.save_state(store(spark, "b"), path) == 1 and macs(spark, path) == ["b"]


def test_a_first_save_that_dies_leaves_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "trust")
    with pytest.raises(Exception, match="power cut"):
        K.save_state(store(spark, "b").withColumn("label", F.raise_error(F.lit("power cut")).cast("string")), path)
    assert macs(spark, path) == []


def test_a_table_may_be_saved_over_itself_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "trust")
    for k in range(4):
        known = K.load_state(spark, path, T.TRUST_SCHEMA)
        K.save_state(known.unionByName(store(spark, f"m{k}")), path)
    assert macs(spark, path) == ["m0", "m1", "m2", "m3"] and macs(spark, path, version=2) == ["m0", "m1", "m2"]
    assert K.committed_versions(spark, path) == [2, 3]
    assert sorted(p.name for p in (tmp_path / "trust").iterdir()) == ["_commits", "version=2", "version=3"]
    with pytest.raises(K.StateCorruptError):
        K.load_state(spark, path, T.TRUST_SCHEMA, version=0)


def test_two_writers_of_one_version_cannot_both_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "trust")
    K.save_state(store(spark, "a"), path)
    monkeypatch.setattr(K, "committed_versions", lambda *_: [])          # a writer that saw the table before
    with pytest.raises(Exception, match="(?i)exists"):
        K.save_state(store(spark, "b"), path)


def test_a_retried_append_doubles_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([("i1", "t", "s", "k", "LOW", None), ("i2", "t", "s", "k", "LOW", None)], I.INCIDENT_SCHEMA)
    I.append_incidents(rows, log, commit="batch-1")
    I.append_incidents(rows, log, commit="batch-1")
    I.append_incidents(rows.limit(1), log, commit="batch-2")
    assert sorted(r.incident_id for r in I.read_incidents(spark, log).collect()) == ["i1", "i1", "i2"]
    with pytest.raises(ValueError):
        I.append_incidents(rows, log, commit="../x")


def test_mapping_state_from_any_cuts_equals_a_full_run(spark):
    r, t = random.Random(7), 1_700_000_000_000_000
    rows = [(i, t + (i // 3) * 1_000_000, r.choice((1, 2, 2)), r.choice("abc") if i % 2 else "a", None, r.choice(("192.168.1.1", "x", "y")), None)
            for i in range(240)]
    p = make_packets(spark, rows)
    for semantics in R.SEMANTICS:
        want = sorted(map(tuple, R.ip_mapping_state(p, semantics=semantics).collect()))
        for _ in range(2):
            edges = [0, *sorted(r.sample(range(1, 240), 3)), 240]
            parts = [R.mapping_summary(p.where((F.col("seq") >= a) & (F.col("seq") < b))) for a, b in zip(edges, edges[1:], strict=False)]
            left = R.merge_summaries(R.merge_summaries(*parts[:2]), R.merge_summaries(*parts[2:]))
            assert sorted(map(tuple, R.state_from_summary(left, semantics=semantics).collect())) == want
            assert sorted(map(tuple, R.state_from_summary(R.merge_summaries(*parts), semantics=semantics).collect())) == want


def test_quantiles_of_many_columns(spark):
    r = random.Random(3)
    rows = [(r.gauss(0, 1), float(r.randrange(4)), None, 5.0 if k % 3 else None, r.randrange(10 ** 6)) for k in range(700)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e long").repartition(7)
    shares = {"a": [0.05, 0.5], "b": [0.25, 0.5, 0.75], "c": [0.5], "d": [0.0, 1.0], "e": [0.1]}
    got = column_quantiles(df, shares)
    for k, (c, s) in enumerate(shares.items()):
        own = [x[k] for x in rows if x[k] is not None]
        assert got[c] == (pytest.approx(list(np.quantile(own, s))) if own else [None])
    assert column_quantiles(df, {}) == {} and column_quantiles(df.limit(0), {"a": [0.5]}) == {"a": [None]}


def test_a_constant_forest_fails_the_evidence(spark):
    def constant(model):
        leaf = model.nodes[model.nodes["node"] == 0].assign(feature=-1, left=-1, right=-1, depth=0)
        return dataclasses.replace(model, nodes=leaf.reset_index(drop=True), offset=-0.5)

    feats = q_ml._chain(spark, SF001)[0]
    good = q_ml.walk_evidence(feats).first()
    assert good.windows == good.walked_alike and good.share_holds and good.outlier_first
    bad = q_ml.walk_evidence(feats, constant).first()
    assert not bad.outlier_first and not bad.share_holds
