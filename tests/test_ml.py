import random

import pytest
from pyspark.sql import functions as F

from lanwatch.operators import evaluate as E
from lanwatch.operators import forest as M
from lanwatch.operators import prep as P


def test_median_imputation_exact(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert P.fit_medians(df, ["x"]) == {"x": 2.5}
    out = sorted(r["x"] for r in P.median_impute(df, ["x"]).collect())
    assert out == [1.0, 2.0, 2.5, 3.0, 10.0]
    counts = {r["feature"]: r["missing"] for r in P.missing_counts(df, ["x"]).collect()}
    assert counts == {"x": 1, "__total__": 1}


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    p = P.scaler_params(P.fit_scaler(df, ["a", "b"]))
    assert abs(p["a"][1] - 1.247219) < 1e-6 and p["b"][1] == 1.0
    s = P.transform_scaler(df, p)
    chk = {r["feature"]: r for r in P.scaled_check(s, ["a", "b"]).collect()}
    assert abs(chk["a"]["mean"]) < 1e-9 and chk["b"]["std"] == 0.0


@pytest.fixture(scope="module")
def blob(spark):
    rnd = random.Random(3)
    rows = [(float(i), rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(600)]
    rows.append((600.0, 12.0, -11.0, 9.0))                   # planted outlier
    return spark.createDataFrame(rows, "k double, a double, b double, c double")


def test_forest_properties(blob):
    m = M.fit_isolation_forest(blob, ["a", "b", "c"], key="k", n_trees=60, contamination=0.05, seed=42)
    assert m.psi == 256 and len(m.nodes) > 0 and m.nodes["depth"].max() <= 8
    preds = M.predict(m, blob).collect()
    share = sum(r["anomaly_prediction"] == -1 for r in preds) / len(preds)
    assert 0.03 <= share <= 0.07
    worst = min(preds, key=lambda r: r["anomaly_score"])
    assert worst["k"] == 600.0 and worst["is_anomaly"]


def test_forest_independent_of_partitioning(blob):
    a = M.fit_isolation_forest(blob.coalesce(1), ["a", "b", "c"], key="k", n_trees=10, seed=7)
    b = M.fit_isolation_forest(blob.repartition(8), ["a", "b", "c"], key="k", n_trees=10, seed=7)
    assert a.nodes.equals(b.nodes) and a.offset == b.offset


def test_forest_rejects_null_features(spark, blob):
    m = M.fit_isolation_forest(blob, ["a", "b", "c"], key="k", n_trees=5)
    bad = spark.createDataFrame([(1.0, None, 0.0, 0.0)], "k double, a double, b double, c double")
    with pytest.raises(Exception):
        M.predict(m, bad).collect()


def test_model_roundtrip(spark, blob, tmp_path):
    m = M.fit_isolation_forest(blob, ["a", "b", "c"], key="k", n_trees=5)
    M.save_model(m, spark, str(tmp_path / "model"))
    m2 = M.load_model(spark, str(tmp_path / "model"))
    a = [r["anomaly_score"] for r in M.predict(m, blob).orderBy("k").collect()]
    b = [r["anomaly_score"] for r in M.predict(m2, blob).orderBy("k").collect()]
    assert a == b and m2.offset == m.offset


def test_summaries(blob):
    m = M.fit_isolation_forest(blob, ["a", "b", "c"], key="k", n_trees=10)
    preds = M.predict(m, blob).withColumn("window_start", F.col("k"))
    s = M.train_summary(preds).first()
    assert s["samples"] == 601 and s["normal"] + s["anomalous"] == 601 and not s["warn_few_samples"]
    summ, top = M.predict_summary(preds)
    assert top.count() == min(10, s["anomalous"])
    assert summ.first()["more_anomalies"] == max(0, s["anomalous"] - 10)


def test_single_class_evaluation(spark):
    df = spark.createDataFrame([(1, 0.1, 1), (1, 0.2, 1)], "anomaly_prediction int, anomaly_score double, label int")
    c = E.confusion(df).first()
    assert (c["true_negative"], c["false_positive"], c["false_negative"], c["true_positive"]) == (2, 0, 0, 0)
    m = E.prf_metrics(E.confusion(df)).first()
    assert (m["precision"], m["recall"], m["f1_score"], m["false_positive_rate"]) == (0.0, 0.0, 0.0, 0.0)
    assert E.class_score_stats(df).count() == 0              # nothing flagged anomalous
    rep = {r["class"]: r for r in E.classification_report(E.confusion(df)).collect()}
    assert rep["accuracy"]["f1_score"] == 1.0 and rep["Anomaly"]["support"] == 0


def test_histogram_zero_width(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0), (-1, -0.3), (-1, -0.1)],
                               "anomaly_prediction int, anomaly_score double")
    h = {(r["predicted_class"], r["bin"]): r["count"] for r in E.score_histogram(df).collect()}
    assert len(h) == 60 and h[("normal", 15)] == 2
    assert h[("anomaly", 0)] == 1 and h[("anomaly", 29)] == 1


def test_evaluate_modes(spark):
    with_label = spark.createDataFrame([(-1, -0.2, -1), (1, 0.1, 1), (-1, -0.1, 1)],
                                       "anomaly_prediction int, anomaly_score double, label int")
    r = E.evaluate(with_label).first()
    assert r["evaluation_mode"] == "supervised" and r["true_positive"] == 1 and r["false_positive"] == 1
    r = E.evaluate(with_label.drop("label")).first()
    assert r["evaluation_mode"] == "unsupervised" and r["anomaly_count"] == 2
