"""Isolation forest (M1–M6): Liu, Ting & Zhou, "Isolation Forest", ICDM 2008.

MLlib has no isolation forest, so this is our own distributed operator:

* **sample** – tree ``t`` takes the ``psi = min(max_samples, n)`` rows with
  the smallest seeded hash ``u(key, t)`` (a uniform sample without
  replacement).  Rows are pre-filtered with ``u < ~4 psi / n`` inside an
  array expression, so only about ``4 psi`` rows per tree are ever
  materialised, whatever ``n`` is.
* **grow** – ``groupBy(tree).applyInPandas``: one task per tree on at most
  ``psi`` rows; random non-constant feature, uniform cut, depth at most
  ``ceil(log2 psi)``; seeded per tree, so the forest does not depend on the
  partitioning.
* **score** – the node table (at most trees x 511 rows) is collected once,
  broadcast, and every row is scored by a vectorised pandas UDF that walks
  all trees level by level with numpy indexing.
* **threshold** – ``offset`` = exact ``contamination`` percentile of the
  training scores; ``decision = score - offset``; ``-1`` when negative.

Scores follow the paper and the usual defaults but are not bit-equal to any
other implementation (different random streams).
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles
from ..schema import (FOREST_CONTAMINATION, FOREST_MAX_SAMPLES, FOREST_SEED, FOREST_TREES,
                      MODEL_FEATURES, require_columns)

EULER_GAMMA = 0.5772156649
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size long, depth int")


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


@dataclass
class ForestModel:
    features: list[str]
    psi: int
    n_trees: int
    contamination: float
    seed: int
    training_samples: int
    offset: float = 0.0
    nodes: pd.DataFrame = field(default=None, repr=False)

    def meta(self) -> dict:
        d = asdict(self)
        d.pop("nodes")
        d["model_type"] = "IsolationForest"
        return d


# ------------------------------------------------------------------ sampling

def _unit_hash(key: Column, seed: int, t: Column) -> Column:
    h = F.xxhash64(key, F.lit(seed), t)
    return (F.pmod(h, F.lit(1 << 53))).cast("double") / F.lit(float(1 << 53))


def tree_samples(df: DataFrame, features, key: str, n: int, psi: int, n_trees: int, seed: int,
                 oversample: float = 4.0) -> DataFrame:
    """Rows ``(tree, u, *features)``: at most ``psi`` per tree, exact ``psi``
    smallest hashes.  Retries with a looser pre-filter if a tree came short."""
    p = min(1.0, oversample * psi / max(n, 1))
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    while True:
        cand = df.select(*features, F.explode(F.filter(
            F.transform(trees, lambda t: F.struct(t.alias("tree"), _unit_hash(F.col(key), seed, t).alias("u"))),
            lambda x: x["u"] < F.lit(p))).alias("_s"))
        cand = cand.select(F.col("_s.tree").alias("tree"), F.col("_s.u").alias("u"), *features)
        ranked = cand.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("u")))
        kept = ranked.where(F.col("_r") <= psi).drop("_r")
        if p >= 1.0:
            return kept
        short = kept.groupBy("tree").count().where(F.col("count") >= psi).count()
        if short == n_trees:
            return kept
        p = min(1.0, p * 2)


# ------------------------------------------------------------------ growing

def _grower(features, psi: int, seed: int):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values("u", kind="mergesort")
        X = pdf[list(features)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, t])
        rows = []
        next_id = 1
        stack = [(0, np.arange(len(X)), 0)]
        while stack:
            node, idx, depth = stack.pop()
            sub = X[idx]
            if depth >= max_depth or len(idx) <= 1:
                rows.append((t, node, -1, 0.0, -1, -1, len(idx), depth))
                continue
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                rows.append((t, node, -1, 0.0, -1, -1, len(idx), depth))
                continue
            f = int(rng.choice(cand))
            thr = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] <= thr
            left, right = next_id, next_id + 1
            next_id += 2
            rows.append((t, node, f, thr, left, right, len(idx), depth))
            stack.append((right, idx[~go_left], depth + 1))
            stack.append((left, idx[go_left], depth + 1))
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right",
                                           "size", "depth"])
    return grow


# ------------------------------------------------------------------ scoring

def _dense_forest(nodes: pd.DataFrame):
    n_trees = int(nodes["tree"].max()) + 1
    width = int(nodes["node"].max()) + 1
    feat = np.full((n_trees, width), -1, dtype=np.int64)
    thr = np.zeros((n_trees, width))
    left = np.zeros((n_trees, width), dtype=np.int64)
    right = np.zeros((n_trees, width), dtype=np.int64)
    leaf_val = np.zeros((n_trees, width))
    t, nd = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feat[t, nd] = nodes["feature"].to_numpy()
    thr[t, nd] = nodes["threshold"].to_numpy()
    left[t, nd] = np.maximum(nodes["left"].to_numpy(), 0)
    right[t, nd] = np.maximum(nodes["right"].to_numpy(), 0)
    leaf_val[t, nd] = nodes["depth"].to_numpy() + np.array([c_factor(s) for s in nodes["size"].to_numpy()])
    return feat, thr, left, right, leaf_val, int(nodes["depth"].max())


def score_samples(df: DataFrame, model: ForestModel, out: str = "_score") -> DataFrame:
    """Paper score negated (higher = more normal), like ``score_samples``."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(_dense_forest(model.nodes))
    denom = c_factor(model.psi)

    @F.pandas_udf(T.DoubleType())
    def iforest_score(*cols: pd.Series) -> pd.Series:
        feat, thr, left, right, leaf_val, depth = bc.value
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        n = X.shape[0]
        k = feat.shape[0]
        tix = np.arange(k)[:, None]
        rix = np.broadcast_to(np.arange(n)[None, :], (k, n))
        node = np.zeros((k, n), dtype=np.int64)
        for _ in range(depth + 1):
            f = feat[tix, node]
            leaf = f < 0
            x = X[rix, np.where(leaf, 0, f)]
            go = x <= thr[tix, node]
            node = np.where(leaf, node, np.where(go, left[tix, node], right[tix, node]))
        h = leaf_val[tix, node].mean(axis=0)
        return pd.Series(-np.power(2.0, -h / denom) if denom > 0 else -np.ones(n))

    return df.withColumn(out, iforest_score(*[F.col(c).cast("double") for c in model.features]))


def walk_scores(df: DataFrame, model: ForestModel, key: str, out: str = "_walked") -> DataFrame:
    """Scores of (scaled) rows by joins with the node table, a level of the trees at a time; no Python runs.

    Independent of ``score_samples`` in all but the nodes.  A row becomes one small row a tree, which stays in its
    partition, as the node table (at most trees x 511 rows) is broadcast; rows of equal key and values share a score.
    """
    spark = df.sparkSession
    table = model.nodes.assign(length=[d + c_factor(s) for d, s in zip(model.nodes["depth"], model.nodes["size"], strict=True)])
    nodes = spark.createDataFrame(table[["tree", "node", "feature", "threshold", "left", "right", "length"]]).select(
        F.col("tree").cast("int").alias("tree"), F.col("node").cast("int").alias("node"), F.col("feature").cast("int").alias("feature"),
        "threshold", F.col("left").cast("int").alias("left"), F.col("right").cast("int").alias("right"), "length")
    x = F.array(*[F.col(c).cast("double") for c in model.features])
    at = df.select(F.col(key).alias("_key"), x.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(model.n_trees - 1))).alias("tree"),
                   F.lit(0).alias("node"))
    for _ in range(int(model.nodes["depth"].max())):
        on = at.join(F.broadcast(nodes), ["tree", "node"])
        below = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = on.select("_key", "x", "tree", F.when(F.col("feature") < 0, F.col("node")).otherwise(below).alias("node"))
    mean = at.join(F.broadcast(nodes), ["tree", "node"]).groupBy("_key", "x").agg(F.avg("length").alias("h"))
    norm = c_factor(model.psi)
    score = -F.pow(F.lit(2.0), -F.col("h") / F.lit(norm)) if norm > 0 else F.lit(-1.0)
    return mean.select(F.col("_key").alias(key), score.alias(out))


def fit_isolation_forest(df: DataFrame, features=None, key: str = "window_start",
                         n_trees: int = FOREST_TREES, max_samples: int = FOREST_MAX_SAMPLES,
                         contamination: float = FOREST_CONTAMINATION, seed: int = FOREST_SEED) -> ForestModel:
    """M1 + M2: fit the forest and the decision offset on ``df`` (scaled features)."""
    features = list(features or MODEL_FEATURES)
    require_columns(df, features + [key], "training data")
    if not 0.0 < contamination <= 0.5:
        raise ValueError("contamination must be in (0, 0.5]")
    data = df.select(key, *[F.col(c).cast("double").alias(c) for c in features])
    n = data.count()
    if n == 0:
        raise ValueError("no training rows")
    psi = min(max_samples, n)
    samples = tree_samples(data, features, key, n, psi, n_trees, seed)
    nodes = (samples.groupBy("tree").applyInPandas(_grower(features, psi, seed), NODE_SCHEMA)
             .toPandas().sort_values(["tree", "node"]).reset_index(drop=True))
    model = ForestModel(features, psi, n_trees, contamination, seed, n, 0.0, nodes)
    scored = score_samples(data, model)
    model.offset = exact_quantiles(scored, "_score", [contamination])[0]
    return model


def predict(model: ForestModel, df: DataFrame, scaler=None) -> DataFrame:
    """M3 + M4: ``anomaly_score`` (decision value, 6 dp), ``anomaly_prediction``
    (1 / -1) and ``is_anomaly``.  ``scaler`` (fitted parameters) is applied
    first unless the input is already scaled.  A null feature fails the job.
    """
    require_columns(df, model.features, "prediction input")
    x = df
    if scaler is not None:
        from .prep import transform_scaler
        cols = {c: F.col(c) for c in model.features}
        x = transform_scaler(x.withColumns({f"__raw_{c}": v for c, v in cols.items()}), scaler)
    any_null = None
    for c in model.features:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    first = model.features[0]
    x = x.withColumn(first, F.when(any_null, F.raise_error(F.lit(
        "null feature value at prediction time; impute first")).cast("double"))
        .otherwise(F.col(first).cast("double")))
    x = score_samples(x, model)
    decision = F.col("_score") - F.lit(model.offset)
    out = x.withColumns({
        "anomaly_score": F.round(decision, 6),
        "anomaly_prediction": F.when(decision < 0, F.lit(-1)).otherwise(F.lit(1)),
    }).withColumn("is_anomaly", F.col("anomaly_prediction") == -1).drop("_score")
    if scaler is not None:
        out = out.withColumns({c: F.col(f"__raw_{c}") for c in model.features}).drop(
            *[f"__raw_{c}" for c in model.features])
    return out


# ------------------------------------------------------------------ summaries

def train_summary(preds: DataFrame) -> DataFrame:
    """M5: counts and shares per class, score range/mean/population std, warnings."""
    n = F.count(F.lit(1))
    return preds.agg(
        n.alias("samples"),
        F.count_if(F.col("anomaly_prediction") == 1).alias("normal"),
        F.count_if(F.col("anomaly_prediction") == -1).alias("anomalous"),
        F.round(F.count_if(F.col("anomaly_prediction") == 1) * 100.0 / n, 1).alias("normal_pct"),
        F.round(F.count_if(F.col("anomaly_prediction") == -1) * 100.0 / n, 1).alias("anomalous_pct"),
        F.min("anomaly_score").alias("score_min"), F.max("anomaly_score").alias("score_max"),
        F.avg("anomaly_score").alias("score_mean"), F.stddev_pop("anomaly_score").alias("score_std"),
        (n < 10).alias("warn_few_samples"),
        F.count_if(F.isnan("anomaly_score")).alias("nan_scores"),
    )


def predict_summary(preds: DataFrame, order: str = "window_start", first: int = 10) -> tuple[DataFrame, DataFrame]:
    """M6: (summary row, first ``first`` anomalies in input order)."""
    summary = train_summary(preds).withColumn(
        "more_anomalies", F.greatest(F.col("anomalous") - F.lit(first), F.lit(0)))
    top = preds.where("is_anomaly").orderBy(order).limit(first).select(order, "anomaly_score")
    return summary, top


# ------------------------------------------------------------------ persistence

def save_model(model: ForestModel, spark: SparkSession, path: str) -> None:
    spark.createDataFrame(model.nodes).write.mode("overwrite").parquet(f"{path}/forest_nodes")
    spark.createDataFrame([(json.dumps(model.meta()),)], "meta string").write.mode("overwrite") \
        .json(f"{path}/model_meta")


def load_model(spark: SparkSession, path: str) -> ForestModel:
    meta = json.loads(spark.read.json(f"{path}/model_meta").first()["meta"])
    nodes = spark.read.parquet(f"{path}/forest_nodes").toPandas().sort_values(["tree", "node"]) \
        .reset_index(drop=True)
    meta.pop("model_type", None)
    return ForestModel(nodes=nodes, **meta)
