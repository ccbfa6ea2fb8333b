"""One linear model per group, fitted from sums, so a group may have any number of rows."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import as_col, linear

MODEL_FIELDS = T.StructType([
    T.StructField("model_binary", T.BinaryType()),
    T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("cross_validation_metric", T.DoubleType()),
    T.StructField("prediction", T.DoubleType()),
])


def pack_model(coefficients: np.ndarray, intercept: float) -> bytes:
    return json.dumps({"coefficients": list(map(float, coefficients)), "intercept": float(intercept)}).encode()


def unpack_model(data: bytes) -> tuple[np.ndarray, float]:
    model = json.loads(data)
    return np.array(model["coefficients"]), model["intercept"]


def merge_moments(n: np.ndarray, means: np.ndarray, products: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, means and centred products of the union of several parts."""
    total = n.sum()
    mean = (n[:, None] * means).sum(axis=0) / total
    off = means - mean
    return total, mean, products.sum(axis=0) + np.einsum("f,fi,fj->ij", n, off, off)


def solve_moments(mean: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, float]:
    """Least squares with intercept; the shortest solution when it is not unique. Target comes last."""
    coefficients = np.linalg.lstsq(products[:-1, :-1], products[:-1, -1], rcond=1e-12)[0]
    return coefficients, mean[-1] - coefficients @ mean[:-1]


def squared_error(n: float, mean: np.ndarray, products: np.ndarray, model: tuple[np.ndarray, float]) -> float:
    """Sum of squared residuals of a model on rows known by their moments."""
    coefficients, intercept = model
    weights = np.append(-coefficients, 1.0)
    bias = weights @ mean - intercept
    return max(0.0, float(weights @ products @ weights + n * bias * bias))


def fit_from_moments(n: np.ndarray, means: np.ndarray, products: np.ndarray) -> dict:
    """Model, r2, root mean squared error over held-out folds, and mean prediction."""
    total, mean, centred = merge_moments(n, means, products)
    model = solve_moments(mean, centred)
    spread = centred[-1, -1]
    error = squared_error(total, mean, centred, model)
    held_out = None
    if len(n) > 1:
        errors = 0.0
        for fold in range(len(n)):
            rest = np.arange(len(n)) != fold
            _, rest_mean, rest_products = merge_moments(n[rest], means[rest], products[rest])
            errors += squared_error(n[fold], means[fold], products[fold], solve_moments(rest_mean, rest_products))
        held_out = float(np.sqrt(errors / total))
    return {
        "model_binary": pack_model(*model),
        "coefficients": model[0].tolist(),
        "intercept": float(model[1]),
        "r2": float(1 - error / spread) if spread > 0 else None,
        "cross_validation_metric": held_out,
        "prediction": float(model[0] @ mean[:-1] + model[1]),
    }


def fit_linear_groups(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    target: str,
    folds: int = 5,
) -> DataFrame:
    """Least squares per group with its fold-wise error: one row per group.

    Rows are folded by a hash of their values. Each group and fold shrinks to its
    count, means and covariances before the shuffle; only these reach Python.
    """
    columns = [*features, target]
    width = len(columns)
    values = [F.col(c).cast("double") for c in columns]
    rows = df.select(*keys, *[v.alias(f"__{i}") for i, v in enumerate(values)]).dropna(
        subset=[f"__{i}" for i in range(width)]
    )
    fold = F.pmod(F.xxhash64(*[f"__{i}" for i in range(width)]), F.lit(folds))
    moments = rows.withColumn("__fold", fold).groupBy(*keys, "__fold").agg(
        F.count(F.lit(1)).cast("double").alias("__n"),
        F.array(*[F.avg(f"__{i}") for i in range(width)]).alias("__means"),
        F.array(
            *[
                F.covar_pop(f"__{i}", f"__{j}") * F.count(F.lit(1))
                for i in range(width)
                for j in range(i, width)
            ]
        ).alias("__products"),
    )
    # at most ``folds`` entries per group
    per_group = moments.groupBy(*keys).agg(
        F.sum("__n").cast("long").alias("n_rows"),
        F.array_sort(F.collect_list(F.struct("__fold", "__n", "__means", "__products"))).alias("__parts"),
    )
    upper = np.triu_indices(width)

    @F.pandas_udf(MODEL_FIELDS)
    def fit(n: pd.Series, means: pd.Series, products: pd.Series) -> pd.DataFrame:
        models = []
        for group_n, group_means, group_products in zip(n, means, products):
            full = np.zeros((len(group_n), width, width))
            for part, triangle in enumerate(group_products):
                full[part][upper] = triangle
                full[part] = full[part] + np.triu(full[part], 1).T
            models.append(fit_from_moments(np.asarray(group_n), np.stack(list(group_means)), full))
        return pd.DataFrame(models, columns=MODEL_FIELDS.names)

    fitted = per_group.withColumn("__model", fit("__parts.__n", "__parts.__means", "__parts.__products"))
    return fitted.select(
        *keys, "n_rows", "__model.*",
        F.lit("linear").alias("algorithm"), F.current_timestamp().alias("creation_time"),
    )


def simple_regression(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Slope, intercept and r2 of one feature per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def predict_groups(
    df: DataFrame, models: DataFrame, keys: Sequence[str], features: Sequence[str], name: str = "prediction"
) -> DataFrame:
    """Score each row with its group's model; null where the group has none."""
    known = models.select(
        *keys, F.col("coefficients").alias("__coefficients"), F.col("intercept").alias("__intercept")
    )
    score = linear(features, "__coefficients", "__intercept").alias(name)
    return df.join(known, list(keys), "left").select(*df.columns, score)


def score_model_column(models: Column | str, row: Column) -> Column:
    """Score a struct of features with the stored model bytes next to it; null without a model."""

    @F.pandas_udf("double")
    def score(binary: pd.Series, features: pd.DataFrame) -> pd.Series:
        out = np.full(len(binary), np.nan)
        matrix = features.to_numpy(dtype=float)
        codes, stored = pd.factorize(binary)
        for code, data in enumerate(stored):
            coefficients, intercept = unpack_model(data)
            mine = codes == code
            out[mine] = matrix[mine] @ coefficients + intercept
        return pd.Series(out).where(codes >= 0)

    return F.nanvl(score(as_col(models), row), F.lit(None))


def newest_models(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest row of each group in a table that models are appended to."""
    rest = [c for c in models.columns if c not in keys]
    newest = models.groupBy(*keys).agg(F.max_by(F.struct(*rest), "creation_time").alias("__m"))
    return newest.select(*keys, "__m.*")


def map_groups(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str | T.StructType,
) -> DataFrame:
    """Run a pandas function over each group, a batch of rows at a time, for groups of any size.

    ``fn`` takes a group's batches, in no order, and gives batches of results; no more than one batch is held, so what it
    keeps of a group must be small, as for models that are fitted step by step.
    """

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(batches)

    return df.groupBy(*keys).applyInPandas(stream, schema)


def season_columns(ts: Column, periods: Sequence[tuple[float, int]]) -> list[Column]:
    """Days since 1970, and a sine and cosine per wave of each ``(days, waves)``."""
    days = F.unix_seconds(ts.cast("timestamp")) / 86400.0
    columns = [days]
    for period, waves in periods:
        for wave in range(1, waves + 1):
            angle = days * (2 * np.pi * wave / period)
            columns += [F.sin(angle), F.cos(angle)]
    return columns


def with_season(df: DataFrame, periods: Sequence[tuple[float, int]]) -> tuple[DataFrame, list[str]]:
    columns = season_columns(F.col("ds"), periods)
    names = [f"__x{i}" for i in range(len(columns))]
    return df.select(*df.columns, *[c.alias(n) for c, n in zip(columns, names)]), names


def forecast_groups(
    series: DataFrame,
    key: str,
    horizon: int = 14,
    step: str = "1 day",
    periods: Sequence[tuple[float, int]] = ((7.0, 2),),
) -> DataFrame:
    """Trend and seasons per group over ``(key, ds, y)``: history and ``horizon`` further steps.

    Returns key, ds, y, yhat and is_future. Without periods it is the trend alone.
    """
    fitted, names = with_season(series.select(key, F.col("ds").cast("timestamp").alias("ds"), "y"), periods)
    models = fit_linear_groups(fitted, [key], names, "y", folds=1)
    last = fitted.groupBy(key).agg(F.max("ds").alias("last"))
    span = F.expr(f"interval {step}")
    future = last.select(
        key, F.explode(F.sequence(F.col("last") + span, F.col("last") + span * horizon, span)).alias("ds"),
        F.lit(None).cast("double").alias("y"),
    )
    future, _ = with_season(future, periods)
    rows = fitted.withColumn("is_future", F.lit(False)).unionByName(future.withColumn("is_future", F.lit(True)))
    scored = predict_groups(rows, models, [key], names, "yhat")
    return scored.select(key, "ds", F.col("y").cast("double").alias("y"), "yhat", "is_future")
