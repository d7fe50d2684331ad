import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.functions import stats
from tidewater.operators.regression import durbin_watson, hash_split, ols, significant_terms


def _frame(spark, x, y, names):
    pdf = pd.DataFrame(x, columns=names)
    pdf["y"] = y
    return spark.createDataFrame(pdf).repartition(5)


def test_matches_lstsq_and_closed_forms(spark):
    rng = np.random.default_rng(7)
    n = 500
    x = rng.normal(size=(n, 3)) * [1.0, 10.0, 0.1] + [5.0, -2.0, 100.0]
    y = 1.5 + x @ np.array([2.0, -0.3, 4.0]) + rng.normal(size=n)
    fit = ols(_frame(spark, x, y, ["a", "b", "c"]), "y", ["a", "b", "c"])
    X = np.column_stack([np.ones(n), x])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose(fit.coef, beta, rtol=1e-9, atol=1e-9)
    resid = y - X @ beta
    ssr = float(resid @ resid)
    sigma2 = ssr / (n - 4)
    cov = sigma2 * np.linalg.inv(X.T @ X)
    assert np.allclose(fit.std_err, np.sqrt(np.diag(cov)), rtol=1e-7)
    assert fit.rank == 4 and fit.df_model == 3 and fit.df_resid == n - 4
    r2 = 1 - ssr / float(((y - y.mean()) ** 2).sum())
    assert math.isclose(fit.r2, r2, rel_tol=1e-9)
    assert math.isclose(fit.adj_r2, 1 - (1 - r2) * (n - 1) / (n - 4), rel_tol=1e-9)
    llf = -n / 2 * (math.log(2 * math.pi) + math.log(ssr / n) + 1)
    assert math.isclose(fit.llf, llf, rel_tol=1e-9)
    assert math.isclose(fit.aic, -2 * llf + 8, rel_tol=1e-9)
    assert math.isclose(fit.bic, -2 * llf + 4 * math.log(n), rel_tol=1e-9)
    f = (r2 / 3) / ((1 - r2) / (n - 4))
    assert math.isclose(fit.f_stat, f, rel_tol=1e-9)
    sk, ku = fit.diagnostics["skew"], fit.diagnostics["kurtosis"]
    assert math.isclose(fit.diagnostics["jarque_bera"], n / 6 * (sk ** 2 + (ku - 3) ** 2 / 4), rel_tol=1e-12)
    assert significant_terms(fit) == ["a", "b", "c"]


def test_exact_line(spark):
    x = np.arange(50, dtype=float).reshape(-1, 1)
    y = 3.0 + 2.0 * x[:, 0]
    fit = ols(_frame(spark, x, y, ["a"]), "y", ["a"])
    assert np.allclose(fit.coef, [3.0, 2.0])
    assert math.isclose(fit.r2, 1.0, abs_tol=1e-12)


def test_rank_deficient_min_norm(spark):
    rng = np.random.default_rng(3)
    n = 200
    a = rng.normal(size=n)
    x = np.column_stack([a, a, rng.normal(size=n)])
    y = 1.0 + 2.0 * a + 0.5 * x[:, 2] + rng.normal(size=n) * 0.1
    fit = ols(_frame(spark, x, y, ["a", "a2", "c"]), "y", ["a", "a2", "c"])
    X = np.column_stack([np.ones(n), x])
    beta = np.linalg.pinv(X) @ y
    assert np.allclose(fit.coef, beta, atol=1e-8)
    assert fit.rank == 3 and fit.df_resid == n - 3 and fit.df_model == 2
    assert math.isclose(fit.coef[1], fit.coef[2], rel_tol=1e-8)


def test_durbin_watson_ordered(spark):
    rng = np.random.default_rng(11)
    n = 300
    x = rng.normal(size=(n, 1))
    y = 0.5 + x[:, 0] + rng.normal(size=n)
    pdf = pd.DataFrame({"t": np.arange(n), "a": x[:, 0], "y": y})
    df = spark.createDataFrame(pdf).repartition(7)
    fit = ols(df, "y", ["a"])
    e = y - fit.coef[0] - fit.coef[1] * x[:, 0]
    expected = float(np.sum(np.diff(e) ** 2) / np.sum(e ** 2))
    assert math.isclose(durbin_watson(df, fit, ["t"], partitions=4), expected, rel_tol=1e-9)


def test_durbin_watson_ties_broken_by_residuals(spark):
    # An order key with ties (here 10 groups) gives the same value for any input partitioning.
    rng = np.random.default_rng(12)
    n = 200
    a = rng.normal(size=n)
    y = 1.0 + 2.0 * a + rng.normal(size=n)
    pdf = pd.DataFrame({"g": np.arange(n) % 10, "a": a, "y": y})
    fit = ols(spark.createDataFrame(pdf), "y", ["a"])
    e = y - fit.coef[0] - fit.coef[1] * a
    order = np.lexsort((e, pdf["g"].to_numpy()))
    expected = float(np.sum(np.diff(e[order]) ** 2) / np.sum(e ** 2))
    for parts in (1, 5):
        df = spark.createDataFrame(pdf.sample(frac=1.0, random_state=parts)).repartition(parts)
        assert math.isclose(durbin_watson(df, fit, ["g"], partitions=3), expected, rel_tol=1e-9)


def test_distribution_tails():
    # t with 10 df: two-sided p at 2.228 is 0.05; F(3, 20) upper tail at 3.098 is 0.05
    assert abs(stats.t_sf2(2.228138852, 10) - 0.05) < 1e-6
    assert abs(stats.f_sf(3.098391212, 3, 20) - 0.05) < 1e-6
    assert abs(stats.t_ppf(0.975, 10) - 2.228138852) < 1e-6
    # t with 1 df is Cauchy: P(|T| > 1) = 0.5
    assert abs(stats.t_sf2(1.0, 1) - 0.5) < 1e-12


def test_hash_split_disjoint_complete(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    train, val = hash_split(df, "k", 0.2)
    nt, nv = train.count(), val.count()
    assert nt + nv == 2000
    assert train.join(val, "k").count() == 0
    assert 300 < nv < 500
    # stable across partitionings
    _, val2 = hash_split(df.repartition(3), "k", 0.2)
    assert sorted(r.k for r in val.collect()) == sorted(r.k for r in val2.collect())


def test_staged_regression_matches_numpy(spark):
    from tidewater.plans.staged import staged_regression

    rng = np.random.default_rng(5)
    n = 400
    a = rng.integers(0, 50, n).astype(float)
    b = rng.integers(0, 3, n).astype(float)
    c = rng.normal(size=n)
    y = np.maximum(0, 50 + 8 * a + 30 * b + rng.normal(size=n) * 40).round()
    pdf = pd.DataFrame({"a": a, "b": b, "noise": c, "impression_count": y, "tweet_text": ["t"] * n})
    res = staged_regression(spark.createDataFrame(pdf).repartition(4), threshold=100)

    def pinv_fit(X, yy):
        X = np.column_stack([np.ones(len(yy)), X])
        return np.linalg.pinv(X) @ yy

    terms = ["a", "b", "noise"]
    assert np.allclose(res.fits["raw"].coef, pinv_fit(pdf[terms].to_numpy(), y), atol=1e-8)
    kept = pdf[pdf.impression_count >= 100]
    assert np.allclose(res.fits["threshold"].coef, pinv_fit(kept[terms].to_numpy(), kept.impression_count.to_numpy()), atol=1e-8)
    logged = np.log1p(kept[terms + ["impression_count"]])
    valid = np.isfinite(logged).all(axis=1)
    logged = logged[valid]
    assert np.allclose(res.fits["log"].coef, pinv_fit(logged[terms].to_numpy(), logged.impression_count.to_numpy()), atol=1e-8)
    assert "a" in res.final_terms and "noise" not in res.final_terms
    assert res.discarded == 4 - len(res.final_terms)
    assert res.fits["final"].terms == res.final_terms
    assert res.final_table.columns == res.final_terms + ["impression_count"]
    assert set(res.holdout) == {"n", "mse", "rmse", "rmse_original"}
    fit_df = res.fit_df(spark)
    assert fit_df.filter("stage = 'final' AND stat = 'r_squared'").count() == 1


def test_staged_durbin_watson_and_summaries(spark, tmp_path):
    from tidewater.plans.staged import staged_regression
    from tidewater.sources.sinks import read_summaries, write_summaries

    rng = np.random.default_rng(9)
    n = 300
    a = rng.integers(0, 40, n).astype(float)
    y = (120 + 5 * a + rng.normal(size=n) * 10).round()
    pdf = pd.DataFrame({"a": a, "impression_count": y})
    res = staged_regression(spark.createDataFrame(pdf).repartition(3))
    for stage in ("raw", "threshold", "log", "final"):
        dw = res.fits[stage].diagnostics["durbin_watson"]
        assert 0.0 < dw < 4.0
    path = str(tmp_path / "s")
    assert write_summaries(spark, res, path) == 1
    back = read_summaries(spark, path)
    assert back["fit"].select("stage").distinct().count() == 4
    assert back["fit"].filter("stat = 'durbin_watson'").count() == 4
    assert {r.stat for r in back["holdout"].collect()} == {"n", "mse", "rmse", "rmse_original", "discarded_terms"}
    assert back["final"].count() == int((y >= 100).sum()) and back["coef"].count() == res.coef_df(spark).count()
    (tmp_path / "s" / "data-half").mkdir()  # a writer that failed before its marker
    assert write_summaries(spark, res, path) == 2 and set(read_summaries(spark, path, 1)) == set(back)
    with pytest.raises(FileNotFoundError):
        read_summaries(spark, path, 3)


def test_triangles_give_subsets_unions_and_errors(spark):
    from tidewater.operators.regression import ModelSpec, fit_of, triangles

    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4)) * [1, 100, 1e-3, 5] + [0, 1e4, 0, 3]
    y = x @ [1, 0.5, 200, -2] + rng.normal(size=500)
    pdf = pd.DataFrame(np.column_stack([x, y]), columns=list("abcdy")).assign(one=np.arange(500) < 300, two=np.arange(500) >= 300)
    first, second = triangles(spark.createDataFrame(pdf).repartition(5), [ModelSpec(m, "y", list("abcd"), m) for m in ("one", "two")])
    assert (first.n, second.n) == (300, 200)
    fit = fit_of(ModelSpec("s", "y", ["b", "d"], ""), first.merged(second).of_terms([1, 3]))
    want = np.linalg.lstsq(np.column_stack([np.ones(500), x[:, [1, 3]]]), y, rcond=None)[0]
    assert np.allclose(fit.coef, want) and fit.n == 500
    left = y[300:] - np.column_stack([np.ones(200), x[300:, [1, 3]]]) @ want
    assert np.isclose(second.of_terms([1, 3]).squared_error(fit.coef), left @ left)


def test_durbin_watson_of_a_key_on_a_third_of_the_rows(spark):
    """Rows that tie on key and residual are spread, and the value does not depend on it."""
    from tidewater.operators.regression import in_order, steps

    n = 6000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.sin(F.col("id").cast("double"))).alias("e"),
    )
    sizes = [r["count"] for r in in_order(rows, ["k", "e"], n, 8).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < n / 4
    pdf = rows.toPandas().sort_values(["k", "e"])
    want = float((np.diff(pdf.e) ** 2).sum() / (pdf.e ** 2).sum())
    for parts in (1, 3, 8):
        assert np.isclose(steps(rows.repartition(4), ["e"], ["k"], n, parts)[0], want)


def test_rank_does_not_depend_on_the_number_of_rows():
    """Replicated rows scale R by a square root; an ill-conditioned design keeps its fit."""
    from tidewater.operators.regression import _solve

    rng = np.random.default_rng(3)
    n = 20_000
    x = np.column_stack([np.ones(n), np.exp(rng.normal(12, 2, n)), rng.integers(0, 2, n), rng.normal(0, 1e-2, n)])
    y = x @ np.array([500.0, 0.02, 800.0, 300.0]) + rng.normal(0, 5, n)
    r = np.linalg.qr(np.column_stack([x, y]), mode="r")
    assert np.linalg.cond(x) > 1e6
    first = _solve(r, 4)
    for copies in (1e2, 1e4, 1e6):
        coef, _, _, _, rank = _solve(r * np.sqrt(copies), 4)
        assert rank == 4
        np.testing.assert_allclose(coef, first[0], rtol=1e-9)
    np.testing.assert_allclose(first[0], np.linalg.lstsq(x, y, rcond=None)[0], rtol=1e-6)


def test_collinear_and_constant_columns_have_the_minimum_norm_fit():
    from tidewater.operators.regression import _solve

    rng = np.random.default_rng(4)
    a, b = rng.normal(size=500), rng.normal(size=500)
    x = np.column_stack([np.ones(500), a, 2 * a, b, np.full(500, 7.0), np.zeros(500)])
    y = 1 + 3 * a - b + rng.normal(size=500)
    coef, cov, _, _, rank = _solve(np.linalg.qr(np.column_stack([x, y]), mode="r"), 6)
    assert rank == 3
    pinv = np.linalg.pinv(x)
    np.testing.assert_allclose(coef, pinv @ y, atol=1e-9)
    np.testing.assert_allclose(cov, pinv @ pinv.T, atol=1e-9)


def test_hash_split_takes_small_fractions_and_a_seed(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    sizes = [hash_split(df, "k", f)[1].count() for f in (0.004, 0.006)]
    assert 50 < sizes[0] < 115 and 85 < sizes[1] < 160
    other = hash_split(df, "k", 0.004, seed=1)[1]
    assert other.join(hash_split(df, "k", 0.004)[1], "k").count() < 20


def test_tails_and_moment_tests_at_known_values():
    from tidewater.functions import stats

    assert abs(stats.t_sf2(2.0, 10) - 0.07338803477074049) < 1e-12
    assert abs(stats.t_ppf(0.975, 5) - 2.5705818366147395) < 1e-9
    assert abs(stats.f_sf(3.0, 4, 20) - 0.625**10 * 4.75) < 1e-12  # I_0.625(10, 2)
    assert abs(stats.betainc(0.5, 0.5, 0.25) - 1 / 3) < 1e-13
    assert abs(stats.betainc(2e6, 0.5, 0.999999) - (1 - stats.betainc(0.5, 2e6, 1e-6))) < 1e-12
    assert abs(stats.skew_test_z(0.0, 50)) < 1e-12 and stats.skew_test_z(1.0, 50) > 2.5
    assert stats.skew_test_z(-1.0, 50) == -stats.skew_test_z(1.0, 50)
    assert stats.kurtosis_test_z(6.0, 200) > 3 > -2 > stats.kurtosis_test_z(2.0, 200)


def test_residuals_are_ordered_range_after_range(spark, monkeypatch):
    """Ties, a key on a third of the rows and rows without key: the same statistics as from one sort."""
    from tidewater.operators import regression

    rows = spark.range(3000).repartition(4).select(
        F.when(F.col("id") % 3 == 0, "m").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        F.when(F.col("id") % 7 > 0, F.sin(F.col("id").cast("double"))).alias("a"), F.cos(F.col("id") * 2.0).alias("b"))
    whole = regression.ordered_moments(rows, ["a", "b"], ["k"], 3000)
    monkeypatch.setattr(regression, "ROWS_PER_RANGE", 500)
    ranges = regression.order_ranges(rows, "k", 3000)
    assert len(ranges) > 3 and [n for _, n in ranges] == [some.count() for some, _ in ranges] and sum(n for _, n in ranges) == 3000
    ends = [some.agg(F.min("k").alias("lo"), F.max("k").alias("hi")).first() for some, _ in ranges]
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:]))
    assert ranges[0][0].filter("k is null").count() == rows.filter("k is null").count() > 0
    for one, other in zip(whole, regression.ordered_moments(ranges, ["a", "b"], ["k"])):
        assert one.keys() == other.keys() and all(np.isclose(one[f], other[f], rtol=1e-12) for f in one)


def test_staged_regression_stores_no_residuals(spark, monkeypatch):
    from tidewater.operators import regression
    from tidewater.plans import staged as plans

    rng = np.random.default_rng(5)
    a = rng.integers(0, 40, 400).astype(float)
    rows = spark.createDataFrame(pd.DataFrame({"a": a, "impression_count": (120 + 5 * a + rng.normal(size=400) * 10).round()}))
    first = plans.staged_regression(rows)
    written, sorts, made, order = [], [], plans.staged, regression.in_order
    monkeypatch.setattr(plans, "staged", lambda df, tag: written.append(tag) or made(df, tag))
    monkeypatch.setattr(regression, "in_order", lambda some, keys, n, parts: sorts.append(n) or order(some, keys, n, parts))
    monkeypatch.setattr(regression, "ROWS_PER_RANGE", 100)
    again = plans.staged_regression(rows)
    assert written == ["staged"] and len(sorts) > 2 and sum(sorts) == 400 and max(sorts) < 300
    for stage in plans.STAGES:
        one, other = first.fits[stage].fit_stats(), again.fits[stage].fit_stats()
        assert all(np.isclose(one[k], other[k], rtol=1e-9, equal_nan=True) for k in one)
    assert np.isclose(first.holdout["rmse_original"], again.holdout["rmse_original"])
