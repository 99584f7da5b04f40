"""Feature preparation (P1–P5): missing counts, exact median imputation,
population-std scaling.

Fitted parameters are tiny (two numbers per feature), so they come back to
the driver once and go out again as literals; the data itself never moves.
``pyspark.ml.feature.StandardScaler`` is not used: it divides by the sample
standard deviation, the scaler here by the population one (std 0 -> 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from ..schema import MODEL_FEATURES, require_columns
from .features import feature_summary


def missing_counts(df: DataFrame, cols=None) -> DataFrame:
    """Nulls per feature plus the total (long format)."""
    cols = cols or MODEL_FEATURES
    require_columns(df, cols, "features")
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, missing)")
    total = wide.select(F.lit("__total__").alias("feature"),
                        sum((F.col(c) for c in cols[1:]), F.col(cols[0])).alias("missing"))
    return long.unionByName(total)


def fit_medians(df: DataFrame, cols=None) -> dict[str, float]:
    """Exact (interpolated) median of every feature that has a gap; the same jobs whatever their number."""
    cols = cols or MODEL_FEATURES
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()
    need = [c for c in cols if gaps[c] > 0]
    if not need:
        return {}
    return {c: q[0] for c, q in column_quantiles(df, {c: [0.5] for c in need}).items()}


def median_impute(df: DataFrame, cols=None, medians: dict[str, float] | None = None) -> DataFrame:
    """Fill gaps with the column median (only columns that have gaps)."""
    medians = fit_medians(df, cols) if medians is None else medians
    if not medians:
        return df
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def fit_scaler(df: DataFrame, cols=None) -> DataFrame:
    """One row per feature: ``feature, mean, scale`` (population std, 0 -> 1)."""
    cols = cols or MODEL_FEATURES
    require_columns(df, cols, "features")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', {i}, `{c}__m`, `{c}__s`" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, position, mean, std)")
    return long.select("feature", "position", "mean",
                       F.when(F.coalesce(F.col("std"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("std"))
                       .alias("scale"))


def scaler_params(params: DataFrame) -> dict[str, tuple[float, float]]:
    """Collect the fitted parameters (one row per feature, fixed size)."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in params.collect()}


def transform_scaler(df: DataFrame, params) -> DataFrame:
    """``(x - mean) / scale`` with the fitted parameters as literals."""
    p = scaler_params(params) if isinstance(params, DataFrame) else params
    require_columns(df, list(p), "features")
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in p.items()})


def scaled_check(scaled: DataFrame, cols=None) -> DataFrame:
    """P5: mean and sample std of the scaled features (expect ~0 and ~1)."""
    return feature_summary(scaled, cols or MODEL_FEATURES).select("feature", "mean", "std")


def scaler_table(spark: SparkSession, params: dict[str, tuple[float, float]]) -> DataFrame:
    rows = [(c, i, m, s) for i, (c, (m, s)) in enumerate(params.items())]
    return spark.createDataFrame(rows, "feature string, position int, mean double, scale double")
