"""Exploration tables: metric series, per-metric simple regressions, log histograms.

The reference draws scatter and joint plots; here the same numbers come
out as tables (pairs, line fits, marginal log-binned counts), computed with
``unpivot`` + grouped aggregates so nothing but the small result leaves
Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metric_series(df: DataFrame, x: str, ys: list[str]) -> DataFrame:
    """Long (metric, x, y) pairs for log-log plots; rows with a non-positive value dropped."""
    long = df.select(F.col(x).cast("double").alias("x"), *[F.col(y).cast("double").alias(y) for y in ys]).unpivot(
        "x", list(ys), "metric", "y"
    )
    return long.filter((F.col("x") > 0) & (F.col("y") > 0))


def metric_regressions(df: DataFrame, x: str, ys: list[str], log: bool = False) -> DataFrame:
    """(metric, n, slope, intercept, r2): straight-line fit of each metric on ``x``.

    The fit is on the values themselves; ``log`` fits log10 of both axes
    instead, keeping positive pairs only.  One partial aggregate per metric.
    """
    series = metric_series(df, x, ys) if log else df.select(
        F.col(x).cast("double").alias("x"), *[F.col(y).cast("double").alias(y) for y in ys]
    ).unpivot("x", list(ys), "metric", "y").dropna()
    if log:
        series = series.select("metric", F.log10("x").alias("x"), F.log10("y").alias("y"))
    return series.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
    )


def log_histogram(df: DataFrame, cols: list[str]) -> DataFrame:
    """(metric, bucket, n): counts of positive values per decade, bucket = floor(log10 v)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "metric", "v")
    bucket = F.floor(F.log10("v")).cast("long")
    return long.filter(F.col("v") > 0).groupBy("metric", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def summary_stats(df: DataFrame, col: str) -> DataFrame:
    """Row count, min, max and population standard deviation of one column."""
    c = F.col(col).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.stddev_pop(c).alias("stddev_pop"),
    )


def actual_vs_predicted(df: DataFrame, response: str, prediction) -> DataFrame:
    """(actual, predicted) pairs for a residual plot; ``prediction`` is a Column."""
    return df.select(F.col(response).cast("double").alias("actual"), prediction.alias("predicted"))
