"""Model preprocessing and small ML (ML1-ML6).

The preprocessing chain is one lazy plan: resample (SM6) -> validate and hold
last good (WN6) -> smooth (WN7/WN8) -> predict from coefficients held as data
(ML2) -> bias (ML3) -> long rows (ML4). Model coefficients are a DataFrame,
never a pickled object, and prediction is a join + arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows as wn
from .resample import resample_mean


def predict_linear(df: DataFrame, coefficients: DataFrame, keys: Sequence[str], feature: str, value: str,
                   out: str = "predicted") -> DataFrame:
    """ML2: ``intercept + sum(coef_f * x_f)`` per row key from a long feature
    table ``(keys..., feature, value)`` and coefficients ``(feature, coef)`` plus an
    ``__intercept__`` row. Quadratic models list squared / cross features as
    ``a*b`` names; their values are computed by ``expand_quadratic``."""
    coef = coefficients.filter(F.col(feature) != "__intercept__")
    j = df.join(coef, feature)
    # the intercept is one model number: read it once, use it as a literal
    b0 = [r[0] for r in coefficients.filter(F.col(feature) == "__intercept__").select("coef").collect()]
    pred = j.groupBy(*keys).agg(F.sum(F.col("coef") * F.col(value)).alias("_s"))
    return pred.select(*keys, (F.col("_s") + F.lit(b0[0] if b0 else 0.0)).alias(out))


def predict_wide(df: DataFrame, coefficients: DataFrame, feature: str = "feature", out: str = "predicted"):
    """ML2 for wide rows: the model (one coefficient per feature plus
    ``__intercept__``, a handful of numbers) is read once and becomes one
    ``select`` expression; no join, no per-row Python."""
    coef = {r[feature]: float(r["coef"]) for r in coefficients.select(feature, "coef").collect()}
    expr = F.lit(coef.pop("__intercept__", 0.0))
    for f, c in sorted(coef.items()):
        expr = expr + F.lit(c) * F.col(f).cast("double")
    return df.withColumn(out, expr)


def expand_quadratic(df: DataFrame, keys: Sequence[str], feature: str, value: str) -> DataFrame:
    """ML2 (degree 2): add ``a*b`` features (a <= b by name) to a long feature table:
    a row's features are gathered once (bounded by the model) and paired in place."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(feature).alias("f"), F.col(value).alias("v")))).alias("_l"))
    one = F.transform("_l", lambda a: F.struct(a["f"].alias(feature), a["v"].alias(value)))
    two = F.flatten(F.transform("_l", lambda a: F.transform(
        F.filter("_l", lambda b: b["f"] >= a["f"]),
        lambda b: F.struct(F.concat_ws("*", a["f"], b["f"]).alias(feature), (a["v"] * b["v"]).alias(value)))))
    return rows.select(*keys, F.inline(F.concat(one, two)))


def bias(df: DataFrame, filtered: str = "filtered", predicted: str = "predicted", out: str = "prediction_bias") -> DataFrame:
    """ML3: bias = filtered - predicted."""
    return df.withColumn(out, F.col(filtered) - F.col(predicted))


def to_long(df: DataFrame, keys: Sequence[str], variables: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """ML4: wide (one column per variable and measure, named ``<var>__<measure>``)
    -> long ``keys, variable, <measures>`` in one pass (stack of structs)."""
    rows = [F.struct(F.lit(v).alias("variable"), *[F.col(f"{v}__{m}").alias(m) for m in measures]) for v in variables]
    return df.select(*keys, F.inline(F.array(*rows)))


def preprocess(df: DataFrame, keys: Sequence[str], ts: str, value: str, lo: float, hi: float,
               period: int = 60, max_lag: int = 1800, rows: int = 30, window: int = 5, alpha: float = 0.3) -> DataFrame:
    """ML1 without the model step: resample to ``period`` means, validity range
    with hold-last-good, moving average and exponential smoothing.

    Output ``keys, ts, raw, in_range, modified, moving_avg, filtered``. After
    resampling the series is regular, so the window chunks hold about 1e4
    samples (``period * 1e4`` seconds, at least a day).
    """
    from .chunks import DEFAULT_CHUNK
    chunk = max(DEFAULT_CHUNK, int(period) * 10_000)
    r = resample_mean(df, keys, ts, period, [value]).withColumnRenamed("bucket_start", ts).withColumnRenamed(value, "raw")
    h = wn.hold_last_good(r, keys, ts, "raw", lo, hi, rows=rows, max_lag=max_lag, chunk=chunk)
    m = wn.moving_average(h, keys, ts, "modified", window - 1, chunk=chunk)
    s = wn.exp_smooth(m, keys, ts, "moving_avg", alpha, out="filtered", chunk=chunk)
    return s.withColumn("filtered", F.coalesce("filtered", "modified"))


def linear_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """ML5 (closed form): slope / intercept / r2 per key with ``regr_*`` aggregates."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                                 F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def fit_linear_regression(train: DataFrame, features: Sequence[str], label: str):
    """ML5: Spark ML linear regression (distributed fit)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    va = VectorAssembler(inputCols=list(features), outputCol="features")
    return LinearRegression(featuresCol="features", labelCol=label).fit(va.transform(train)), va


def prepare_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """ML6: mean imputation, label indexing, one-hot encoding, standard scaling."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    imp = Imputer(inputCols=list(numeric), outputCols=[f"{c}_imp" for c in numeric], strategy="mean")
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical])
    va = VectorAssembler(inputCols=[f"{c}_imp" for c in numeric] + [f"{c}_ohe" for c in categorical],
                         outputCol="raw_features")
    sc = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[imp, *idx, ohe, va, sc]).fit(df)


def split(df: DataFrame, train: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train / test split (2/3-1/3 in ML5, 80/20 in ML6), reproducible by seed."""
    a, b = df.randomSplit([train, 1 - train], seed)
    return a, b
