"""Evaluation of anomaly predictions.

Input: rows with ``anomaly_score`` (decision value, lower = more anomalous),
``anomaly_prediction`` (1 normal / -1 anomalous) and optionally ``label``.
Every metric is one aggregation; nothing is collected row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles

LABEL_CODINGS = ("plus_minus", "zero_one")
HIST_BINS = 30


def _r(c: Column, d: int) -> Column:
    return F.round(c, d)


def score_distribution(preds: DataFrame) -> DataFrame:
    """Counts, anomaly rate (4 dp) and score statistics (6 dp, population std)."""
    s = F.col("anomaly_score").cast("double")
    n = F.count(F.lit(1))
    anomalies = F.count_if(F.col("anomaly_prediction") == -1)
    median, q25, q75 = exact_quantiles(preds, "anomaly_score", [0.5, 0.25, 0.75])
    fixed = lambda q: _r(F.lit(q).cast("double"), 6)
    return preds.agg(
        n.alias("total_samples"),
        F.count_if(F.col("anomaly_prediction") == 1).alias("normal_count"),
        anomalies.alias("anomaly_count"),
        _r(anomalies / F.greatest(n, F.lit(1)), 4).alias("anomaly_rate"),
        _r(F.avg(s), 6).alias("mean"), _r(F.stddev_pop(s), 6).alias("std"),
        _r(F.min(s), 6).alias("min"), _r(F.max(s), 6).alias("max"),
    ).select("*", fixed(median).alias("median"), fixed(q25).alias("q25"), fixed(q75).alias("q75"))


def class_score_stats(preds: DataFrame) -> DataFrame:
    """Mean / population std / min / max per predicted class; empty when
    nothing was flagged anomalous."""
    s = F.col("anomaly_score").cast("double")
    stats = preds.groupBy(F.when(F.col("anomaly_prediction") == -1, "anomaly").otherwise("normal")
                          .alias("predicted_class")).agg(
        _r(F.avg(s), 6).alias("mean"), _r(F.stddev_pop(s), 6).alias("std"),
        _r(F.min(s), 6).alias("min"), _r(F.max(s), 6).alias("max"))
    # the stats frame has at most two rows: decide on it, not on a second pass over preds
    has = F.max(F.col("predicted_class") == "anomaly").over(Window.partitionBy(F.lit(0)))
    return stats.withColumn("_has", has).where("_has").drop("_has")


def score_histogram(preds: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram of scores per predicted class over that class's
    own range (last bin closed; a zero-width range becomes ``[x-0.5, x+0.5]``).
    All bins are emitted, empty ones with count 0."""
    s = F.col("anomaly_score").cast("double")
    cls = F.when(F.col("anomaly_prediction") == -1, "anomaly").otherwise("normal")
    x = preds.select(cls.alias("predicted_class"), s.alias("s"))
    rng = x.groupBy("predicted_class").agg(F.min("s").alias("mn"), F.max("s").alias("mx"))
    rng = rng.select("predicted_class",
                     F.when(F.col("mx") > F.col("mn"), F.col("mn")).otherwise(F.col("mn") - 0.5).alias("lo"),
                     F.when(F.col("mx") > F.col("mn"), F.col("mx")).otherwise(F.col("mx") + 0.5).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    b = F.least(F.floor((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(bins)),
                F.lit(bins - 1)).cast("int")
    counts = x.join(rng, "predicted_class").groupBy("predicted_class", b.alias("bin")) \
        .agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select("predicted_class", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, ["predicted_class", "bin"], "left").select(
        "predicted_class", "bin",
        _r(F.col("lo") + F.col("bin") * width, 6).alias("bin_lo"),
        _r(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("bin_hi"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"))


def _truth(label: Column, coding: str) -> Column:
    if coding not in LABEL_CODINGS:
        raise ValueError(f"label_coding must be one of {LABEL_CODINGS}")
    return (label == -1) if coding == "plus_minus" else (label == 1)


def confusion(preds: DataFrame, label_col: str = "label", label_coding: str = "plus_minus") -> DataFrame:
    """Anomaly is the positive class.  Always four numbers (zeros allowed)."""
    t = F.coalesce(_truth(F.col(label_col), label_coding), F.lit(False))
    p = F.col("anomaly_prediction") == -1
    return preds.agg(
        F.count_if(~t & ~p).alias("true_negative"), F.count_if(~t & p).alias("false_positive"),
        F.count_if(t & ~p).alias("false_negative"), F.count_if(t & p).alias("true_positive"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def prf_metrics(conf: DataFrame) -> DataFrame:
    """E5: precision, recall, F1 (zero division -> 0) and FPR = fp / max(fp+tn, 1), 4 dp."""
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    p = _div(tp, tp + fp)
    r = _div(tp, tp + fn)
    f1 = _div(2 * p * r, p + r)
    return conf.select(
        (tp + fp + fn + tn).alias("total_samples"),
        _r(p, 4).alias("precision"), _r(r, 4).alias("recall"), _r(f1, 4).alias("f1_score"),
        _r(fp / F.greatest(fp + tn, F.lit(1)), 4).alias("false_positive_rate"))


def classification_report(conf: DataFrame) -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and
    weighted averages (zero division -> 0), one row each."""
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    n = tp + fp + fn + tn
    # Normal class: positives are the normals.
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    f0, f1 = _div(2 * p0 * r0, p0 + r0), _div(2 * p1 * r1, p1 + r1)
    s0, s1 = tn + fp, tp + fn
    acc = _div(tp + tn, n)
    rows = F.array(
        F.struct(F.lit("Normal").alias("class"), p0.alias("precision"), r0.alias("recall"),
                 f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit("Anomaly").alias("class"), p1.alias("precision"), r1.alias("recall"),
                 f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _div(p0 * s0 + p1 * s1, n).alias("precision"),
                 _div(r0 * s0 + r1 * s1, n).alias("recall"), _div(f0 * s0 + f1 * s1, n).alias("f1_score"),
                 n.alias("support")),
    )
    x = conf.select(F.explode(rows).alias("r"))
    return x.select(F.col("r.class").alias("class"), _r(F.col("r.precision"), 4).alias("precision"),
                    _r(F.col("r.recall"), 4).alias("recall"), _r(F.col("r.f1_score"), 4).alias("f1_score"),
                    F.col("r.support").alias("support"))


def evaluate(preds: DataFrame, label_col: str = "label", label_coding: str = "plus_minus") -> DataFrame:
    """Supervised metrics when ``label`` exists, else the score distribution.
    One row; ``evaluation_mode`` says which."""
    if label_col in preds.columns:
        return _supervised(preds, label_col, label_coding)
    return score_distribution(preds).withColumn("evaluation_mode", F.lit("unsupervised"))


def _supervised(preds: DataFrame, label_col: str, label_coding: str) -> DataFrame:
    conf = confusion(preds, label_col, label_coding)
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    p = _div(tp, tp + fp)
    r = _div(tp, tp + fn)
    f1 = _div(2 * p * r, p + r)
    return conf.select(
        F.lit("supervised").alias("evaluation_mode"), (tp + fp + fn + tn).alias("total_samples"),
        "true_negative", "false_positive", "false_negative", "true_positive",
        _r(p, 4).alias("precision"), _r(r, 4).alias("recall"), _r(f1, 4).alias("f1_score"),
        _r(fp / F.greatest(fp + tn, F.lit(1)), 4).alias("false_positive_rate"))


def rule_predictions(packets: DataFrame, detections: DataFrame, keep=("label",)) -> DataFrame:
    """Per-packet predictions from rule detections: ``-1`` when any rule fired
    on the packet, score ``-(number of detections)``.  Lets the evaluation
    operators measure the rule engine against labels."""
    per = detections.groupBy("seq").agg(F.count(F.lit(1)).alias("_n"))
    x = packets.select("seq", *[c for c in keep if c in packets.columns]).join(per, "seq", "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    return x.select("seq", *[c for c in keep if c in packets.columns],
                    F.when(n > 0, F.lit(-1)).otherwise(F.lit(1)).alias("anomaly_prediction"),
                    (-n).cast("double").alias("anomaly_score"))
