"""Ordinary least squares with full inference, on DataFrames of any size.

Fit = two Spark passes, each a map-side reduction to O(k^2) numbers:

1. **TSQR** (tall-skinny QR).  Every task QR-factorises its rows of the
   design ``[1, x_1..x_k, y]`` batch by batch (Arrow batches through
   ``mapInArrow``), keeping only the (k+2)x(k+2) triangle R.  The triangles
   are merged on a bounded tree (``applyInPandas`` over at most
   ``TREE_FANOUT`` groups) and the last few are merged on the driver.  R has
   the singular values of the design, so the pseudo-inverse, the rank and the
   condition number are obtained without squaring the condition number as a
   Gram matrix would.
2. **Residual moments**: one ``agg`` of sum(e^p), p = 1..4, with e = y - Xb
   as a JVM expression (whole-stage codegen).

A triangle also gives the models of fewer columns, of joined row sets and the
errors of other coefficients on its rows, all without reading the data again.

Durbin-Watson needs an order: range partitioning on the order key, the residuals and
the row's place, a sort within partitions and per-partition sums plus edge
residuals; the driver stitches partition edges together (one value pair per
partition and model).  Many rows can be ordered range after range of the key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..session import drop_finished_shuffles

INTERCEPT = "Intercept"
TREE_FANOUT = 64


def _rows_finite(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) != F.lit(float("inf")))
    return df.filter(cond)


def design(df: DataFrame, response: str, terms: list[str] | None = None, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """(numeric frame of response + terms, terms).  Rows with a NULL/NaN/inf value are dropped."""
    if terms is None:
        terms = [c for c in df.columns if c != response and c not in drop]
    cols = [response] + list(terms)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return _rows_finite(data, cols), list(terms)


def _qr_r(a: np.ndarray) -> np.ndarray:
    return np.linalg.qr(a, mode="r")


@dataclass
class ModelSpec:
    """One model of a multi-model fit: response, terms and the row mask column.

    ``log`` fits ``log1p`` of every column; rows with a value of -1 or less leave that fit.
    """

    name: str
    response: str
    terms: list[str]
    mask: str
    log: bool = False


@dataclass
class Triangle:
    """R factor of ``[1, X, y]`` over the rows of one model, and how many they are."""

    r: np.ndarray
    n: int

    def of_terms(self, places: list[int]) -> Triangle:
        """The triangle of the design with only the terms at ``places``: no scan of the data.

        The columns of R have the inner products of the design's columns, so those
        kept are factored again.
        """
        k = self.r.shape[1] - 2
        return Triangle(_qr_r(self.r[:, [0, *[1 + p for p in places], 1 + k]]), self.n)

    def merged(self, other: Triangle) -> Triangle:
        """The triangle of both row sets together."""
        return Triangle(_qr_r(np.vstack([self.r, other.r])), self.n + other.n)

    def squared_error(self, coef: np.ndarray) -> float:
        """Sum of squared residuals of these coefficients (intercept first) over the rows."""
        left = self.r[:, -1] - self.r[:, :-1] @ coef
        return float(left @ left)


def triangles(data: DataFrame, specs: list[ModelSpec]) -> list[Triangle]:
    """The triangle of every model, all from one scan of ``data`` (double columns, boolean masks).

    A model uses the masked rows whose values are all finite (after ``log1p``, if
    it is a log model).  Each task keeps one (k+2)x(k+2) triangle per model;
    they are merged per model on a ``TREE_FANOUT``-way tree, and the driver merges
    what that leaves.
    """
    widths = [len(sp.terms) + 2 for sp in specs]
    columns = list(dict.fromkeys(c for sp in specs for c in [*sp.terms, sp.response]))
    places = [[columns.index(c) for c in [*sp.terms, sp.response]] for sp in specs]
    logs = any(sp.log for sp in specs)
    masks = list(dict.fromkeys(sp.mask for sp in specs))

    def per_task(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        bucket = TaskContext.get().partitionId() % TREE_FANOUT
        rs, ns = [np.zeros((0, w)) for w in widths], [0] * len(specs)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns]).astype(np.float64, copy=False)
            flags = {m: np.asarray(batch.column(m).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool) for m in masks}
            with np.errstate(divide="ignore", invalid="ignore"):
                logged = np.log1p(values) if logs else values
            for i, sp in enumerate(specs):
                block = np.empty((batch.num_rows, widths[i]))
                block[:, 0] = 1.0
                block[:, 1:] = (logged if sp.log else values)[:, places[i]]
                block = block[flags[sp.mask] & np.isfinite(block).all(axis=1)]
                if len(block):
                    rs[i], ns[i] = _qr_r(np.vstack([rs[i], block])), ns[i] + len(block)
        out = [(i, bucket, r.ravel().tolist(), r.shape[0], n) for i, (r, n) in enumerate(zip(rs, ns)) if n]
        if out:
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(out, columns=["model", "b", "r", "m", "n"]).astype({"model": "int32", "b": "int32", "m": "int32"}), preserve_index=False
            )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        i = int(pdf["model"].iloc[0])
        blocks = [np.asarray(v, dtype=np.float64).reshape(m, widths[i]) for v, m in zip(pdf["r"], pdf["m"])]
        r = _qr_r(np.vstack(blocks))
        return pd.DataFrame({"model": [i], "r": [r.ravel().tolist()], "m": [r.shape[0]], "n": [int(pdf["n"].sum())]})

    partial = data.select(*columns, *masks).mapInArrow(per_task, "model int, b int, r array<double>, m int, n long")
    rows = partial.groupBy("model", "b").applyInPandas(merge, "model int, r array<double>, m int, n long").collect()
    out = []
    for i, w in enumerate(widths):
        mine = [r for r in rows if r["model"] == i]
        blocks = [np.asarray(r["r"], dtype=np.float64).reshape(r["m"], w) for r in mine]
        out.append(Triangle(_qr_r(np.vstack(blocks)) if blocks else np.zeros((0, w)), sum(r["n"] for r in mine)))
    return out


@dataclass
class OLSFit:
    """Coefficients, inference and fit statistics of one OLS model."""

    response: str
    terms: list[str]
    coef: np.ndarray
    std_err: np.ndarray
    t: np.ndarray
    p: np.ndarray
    ci_low: np.ndarray
    ci_high: np.ndarray
    n: int
    rank: int
    df_model: float
    df_resid: float
    ssr: float
    centered_tss: float
    r2: float
    adj_r2: float
    f_stat: float
    f_p: float
    llf: float
    aic: float
    bic: float
    cond_no: float
    diagnostics: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [INTERCEPT] + list(self.terms)

    def prediction(self) -> Column:
        """Fitted value as a Column expression over the term columns."""
        expr = F.lit(float(self.coef[0]))
        for name, b in zip(self.terms, self.coef[1:]):
            expr = expr + F.lit(float(b)) * F.col(name).cast("double")
        return expr

    def coef_rows(self) -> list[tuple]:
        return [
            (n, float(b), float(s), float(t), float(p), float(lo), float(hi))
            for n, b, s, t, p, lo, hi in zip(self.names, self.coef, self.std_err, self.t, self.p, self.ci_low, self.ci_high)
        ]

    def coef_df(self, spark: SparkSession) -> DataFrame:
        """(term, coef, std_err, t, p_value, ci_low, ci_high)."""
        return spark.createDataFrame(
            self.coef_rows(),
            "term string, coef double, std_err double, t double, p_value double, ci_low double, ci_high double",
        )

    def fit_stats(self) -> dict[str, float]:
        out = {
            "nobs": float(self.n), "rank": float(self.rank), "df_model": float(self.df_model),
            "df_resid": float(self.df_resid), "ssr": self.ssr, "centered_tss": self.centered_tss,
            "r_squared": self.r2, "adj_r_squared": self.adj_r2, "f_statistic": self.f_stat,
            "f_pvalue": self.f_p, "log_likelihood": self.llf, "aic": self.aic, "bic": self.bic,
            "condition_number": self.cond_no,
        }
        out.update(self.diagnostics)
        return out

    def fit_df(self, spark: SparkSession) -> DataFrame:
        """(stat, value) rows."""
        return spark.createDataFrame([(k, float(v)) for k, v in self.fit_stats().items()], "stat string, value double")


def _linear(coef: np.ndarray, terms: list[str]) -> Column:
    expr = F.lit(float(coef[0]))
    for name, b in zip(terms, coef[1:]):
        expr = expr + F.lit(float(b)) * F.col(name)
    return expr


def _solve(r: np.ndarray, k1: int):
    if r.shape[0] < k1 + 1:
        r = np.vstack([r, np.zeros((k1 + 1 - r.shape[0], k1 + 1))])
    # The design's first column is all ones, so R's first row holds sqrt(n) and
    # sqrt(n) * mean of each column, and the triangle below is that of the
    # centred columns.  The rank is decided on the centred columns scaled to
    # length one: it depends neither on the row count nor on units.
    k, root_n, eps = k1 - 1, r[0, 0], np.finfo(np.float64).eps
    singular = np.linalg.svd(r[:k1, :k1], compute_uv=False)
    ycol = r[1 : k1 + 1, k1]
    tss = float(np.dot(ycol, ycol))
    if root_n == 0:
        return np.zeros(k1), np.zeros((k1, k1)), singular, tss, 0
    means = r[0, 1:k1] / root_n
    centred, target = r[1:k1, 1:k1], r[1:k1, k1]
    length = np.linalg.norm(centred, axis=0)
    varies = length > k1 * eps * np.linalg.norm(r[:k1, 1:k1], axis=0)
    scale = np.where(varies, length, 1.0)
    u, s, vt = np.linalg.svd(np.where(varies, centred / scale, 0.0))
    keep = s > k1 * eps * max(1.0, s.max(initial=0.0))
    inverse = (vt.T * np.where(keep, 1.0 / np.where(keep, s, 1.0), 0.0)) @ u.T / scale[:, None]
    slopes = inverse @ target
    to_all = np.vstack([-means, np.eye(k)])  # slopes to (intercept, slopes) of the centred fit
    coef = to_all @ slopes
    coef[0] += r[0, k1] / root_n
    cov = to_all @ (inverse @ inverse.T) @ to_all.T
    cov[0, 0] += 1.0 / root_n**2
    # What the design cannot tell apart is shared out by minimum norm.
    null = to_all @ (vt[~keep].T / scale[:, None])
    if null.shape[1]:
        q = np.linalg.qr(null / np.linalg.norm(null, axis=0))[0]
        project = np.eye(k1) - q @ q.T
        coef, cov = project @ coef, project @ cov @ project
    return coef, cov, singular, tss, 1 + int(keep.sum())


def _assemble(sp: ModelSpec, coef, cov_unscaled, s, centered_tss, rank: int, mom: dict[str, float], diagnostics: bool) -> OLSFit:
    n = int(mom["n"])
    df_resid = float(n - rank)
    df_model = float(rank - 1)
    ssr = mom["s2"]
    scale = ssr / df_resid if df_resid > 0 else float("nan")
    std_err = np.sqrt(np.maximum(np.diag(cov_unscaled) * scale, 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        tvals = coef / std_err
    pvals = np.array([stats.t_sf2(float(t), df_resid) for t in tvals])
    q = stats.t_ppf(0.975, df_resid) if df_resid > 0 else float("nan")
    r2 = 1.0 - ssr / centered_tss if centered_tss > 0 else float("nan")
    if df_model == 0 and centered_tss > 0:
        r2 = 0.0  # an intercept alone explains nothing
    adj = 1.0 - (1.0 - r2) * (n - 1) / df_resid if df_resid > 0 else float("nan")
    if df_model > 0 and df_resid > 0 and r2 < 1:
        f_stat = (r2 / df_model) / ((1.0 - r2) / df_resid)
        f_p = stats.f_sf(f_stat, df_model, df_resid)
    else:
        f_stat, f_p = float("nan"), float("nan")
    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1.0) if n and ssr > 0 else float("nan")
    aic = -2 * llf + 2 * rank
    bic = -2 * llf + rank * math.log(n) if n else float("nan")
    s_pos = s[s > 0]
    cond_no = float(s_pos.max() / s_pos.min()) if s_pos.size else float("nan")
    fit = OLSFit(
        response=sp.response, terms=list(sp.terms), coef=coef, std_err=std_err, t=tvals, p=pvals,
        ci_low=coef - q * std_err, ci_high=coef + q * std_err, n=n, rank=rank,
        df_model=df_model, df_resid=df_resid, ssr=ssr, centered_tss=centered_tss, r2=r2,
        adj_r2=adj, f_stat=f_stat, f_p=f_p, llf=llf, aic=aic, bic=bic, cond_no=cond_no,
    )
    if diagnostics and n > 0:
        fit.diagnostics.update(_moment_diagnostics(mom))
    return fit


def finite_mask(cols: list[str]) -> Column:
    """True where every column is non-NULL, not NaN and finite."""
    cond = F.lit(True)
    for c in cols:
        v = F.col(c).cast("double")
        cond = cond & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return cond


def fit_of(sp: ModelSpec, triangle: Triangle, moments: dict[str, float] | None = None) -> OLSFit:
    """The model that a triangle gives; residual diagnostics need the moments of a scan."""
    coef, cov, s, tss, rank = _solve(triangle.r, len(sp.terms) + 1)
    mom = moments or {"n": float(triangle.n), "s2": triangle.squared_error(coef)}
    return _assemble(sp, coef, cov, s, tss, rank, mom, moments is not None)


def moment_columns(e: Column, name: str) -> list[Column]:
    """Aggregates of a residual column: its count and the sums of its first four powers."""
    return [F.count(e).alias(f"n_{name}")] + [F.sum(e ** p).alias(f"s{p}_{name}") for p in (1, 2, 3, 4)]


def moments_of(row, name: str) -> dict[str, float]:
    return {"n": float(row[f"n_{name}"] or 0)} | {f"s{p}": float(row[f"s{p}_{name}"] or 0.0) for p in (1, 2, 3, 4)}


def ols_many(df: DataFrame, specs: list[ModelSpec], diagnostics: bool = True) -> dict[str, OLSFit]:
    """Several OLS models from two scans of ``df`` (one TSQR pass, one residual pass).

    ``df`` holds every model's columns (cast to double here) and a boolean
    mask column per model; a model uses the masked rows whose own values
    are all finite.
    """
    value_cols = sorted({c for sp in specs for c in [sp.response, *sp.terms]})
    masks = {sp.mask for sp in specs}
    data = df.select(*[F.col(c).cast("double").alias(c) for c in value_cols], *[F.col(m) for m in masks])
    eff = [ModelSpec(sp.name, sp.response, sp.terms, f"__ok{i}") for i, sp in enumerate(specs)]
    data = data.withColumns({
        e.mask: F.coalesce(F.col(sp.mask), F.lit(False)) & finite_mask([sp.response, *sp.terms])
        for sp, e in zip(specs, eff)
    }).select(*value_cols, *[e.mask for e in eff])
    solved = [_solve(t.r, len(sp.terms) + 1) for t, sp in zip(triangles(data, eff), eff)]
    aggs = []
    for i, (sp, (coef, *_)) in enumerate(zip(eff, solved)):
        e = F.when(F.col(sp.mask), F.col(sp.response) - _linear(coef, sp.terms))
        aggs += moment_columns(e, str(i))
    row = data.agg(*aggs).first()
    fits = {}
    for i, (sp, e, (coef, cov, s, tss, rank)) in enumerate(zip(specs, eff, solved)):
        fits[sp.name] = _assemble(sp, coef, cov, s, tss, rank, moments_of(row, str(i)), diagnostics)
    return fits


def ols(df: DataFrame, response: str, terms: list[str] | None = None, drop: tuple[str, ...] = (), diagnostics: bool = True) -> OLSFit:
    """Least squares of ``response`` on ``terms`` with an intercept.

    Minimum-norm solution, so rank-deficient designs fit.  The rank is that of
    the centred columns scaled to length one (singular values above ``k * eps``),
    so it is the same for any number of rows and any units.  Rows with a
    NULL, NaN or infinite value in any used column are left out.
    """
    if terms is None:
        terms = [c for c in df.columns if c != response and c not in drop]
    spec = ModelSpec("model", response, list(terms), "__all")
    return ols_many(df.withColumn("__all", F.lit(True)), [spec], diagnostics)["model"]


def _moment_diagnostics(mom: dict[str, float]) -> dict[str, float]:
    n = mom["n"]
    m1 = mom["s1"] / n
    m2 = mom["s2"] / n - m1 ** 2
    m3 = mom["s3"] / n - 3 * m1 * mom["s2"] / n + 2 * m1 ** 3
    m4 = mom["s4"] / n - 4 * m1 * mom["s3"] / n + 6 * m1 ** 2 * mom["s2"] / n - 3 * m1 ** 4
    skew = m3 / m2 ** 1.5 if m2 > 0 else float("nan")
    kurt = m4 / m2 ** 2 if m2 > 0 else float("nan")
    omni, omni_p = stats.omnibus(skew, kurt, n) if m2 > 0 else (float("nan"), float("nan"))
    jb, jb_p = stats.jarque_bera(skew, kurt, n) if m2 > 0 else (float("nan"), float("nan"))
    return {"omnibus": omni, "omnibus_pvalue": omni_p, "skew": skew, "kurtosis": kurt, "jarque_bera": jb, "jarque_bera_pvalue": jb_p}


#: Bytes of residuals and keys that one task of an ordered scan should hold.
ORDERED_BYTES = 64 << 20


def in_order(rows: DataFrame, keys: list[str], n_rows: int | None = None, partitions: int | None = None) -> DataFrame:
    """``rows`` range-partitioned and sorted by ``keys``; equal keys may lie in several partitions.

    The place of a row (partition and position) is the last key, so a key that
    a third of all rows hold is cut like any other range.  The number of partitions follows the
    number of rows.  Only for results that do not depend on the order of rows
    whose keys are all equal.
    """
    n = rows.count() if n_rows is None else n_rows
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    need = max(partitions or parallel, -(-n * 16 * (1 + len(rows.columns)) // ORDERED_BYTES))
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    keys = [*keys, "__place"]
    return placed.repartitionByRange(need, *keys).sortWithinPartitions(*keys).drop("__place")


#: Rows whose ordering shuffle is on disk at once, and into how many ranges of its order a table is cut at most.
ROWS_PER_RANGE = 12_000_000
MAX_RANGES = 16
#: Keys per range that choose where the ranges end.
KEYS_PER_RANGE = 256


def order_ranges(rows: DataFrame, key: str, n_rows: int) -> list[tuple[DataFrame, int]]:
    """``rows`` cut by ``key`` into ranges in its order, and the rows of each.

    Every row is in one range, and rows of one key in the same (NULL in the first).
    The ends come from a few keys of the table, as those of Spark's range partitioning do, so
    ranges are of about equal size unless a key is very frequent.
    """
    n = min(MAX_RANGES, max(1, -(-n_rows // ROWS_PER_RANGE)))
    if n == 1:
        return [(rows, n_rows)]
    some = rows.select(key).filter(F.col(key).isNotNull()).sample(min(1.0, 2 * n * KEYS_PER_RANGE / n_rows), seed=0)
    keys = [r[key] for r in some.orderBy(key).collect()]
    ends = list(dict.fromkeys(keys[i * len(keys) // n] for i in range(1, n) if keys))
    at = F.lit(0)
    for end in ends:
        at = at + F.coalesce(F.col(key) >= F.lit(end).cast(rows.schema[key].dataType), F.lit(False)).cast("int")
    sizes = {r["at"]: r["count"] for r in rows.groupBy(at.alias("at")).count().collect()}
    return [(rows.filter(at == i), sizes[i]) for i in sorted(sizes)]


def ordered_moments(
    resid: DataFrame | list[tuple[DataFrame, int]],
    names: list[str],
    order_by: list[str],
    n_rows: int | None = None,
    partitions: int | None = None,
) -> list[dict[str, float]]:
    """Per residual column (null: not a row of that model): ``n``, ``s1``..``s4`` and ``dw``.

    Sums of the first four powers, and Durbin-Watson in ``order_by`` order, from one
    sorted scan.  Ties are broken by the residuals: rows tying on those too are
    interchangeable, so the value does not depend on partitioning.  Each task returns, per
    column, its sums and its first and last residual; the driver adds the
    differences across partition edges.  Residuals given as ranges of the order
    (``order_ranges``) are sorted one range after the other, so the shuffle of one
    is on disk at a time.
    """
    ranges = resid if isinstance(resid, list) else [(resid, n_rows)]
    fields = ["n", "s1", "s2", "s3", "s4", "ssd", "first", "last"]

    def per_part(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        pid, found = TaskContext.get().partitionId(), {}
        for batch in batches:
            for i, c in enumerate(names):
                v = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                if v.size == 0:
                    continue
                sums = np.array([v.size, v.sum(), v @ v, (v**3).sum(), (v**4).sum(), (np.diff(v) ** 2).sum()])
                if i in found:
                    old, first, last = found[i]
                    sums[5] += (v[0] - last) ** 2
                    found[i] = (old + sums, first, v[-1])
                else:
                    found[i] = (sums, v[0], v[-1])
        if found:
            rows = [(pid, i, *sums.tolist(), float(first), float(last)) for i, (sums, first, last) in found.items()]
            frame = pd.DataFrame(rows, columns=["pid", "model", *fields]).astype({"pid": "int32", "model": "int32"})
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    schema = "pid int, model int, " + ", ".join(f"{f} double" for f in fields)
    parts = []
    for some, n in ranges:
        ranged = in_order(some.select(*order_by, *names), [*order_by, *names], n, partitions)
        parts += sorted(ranged.select(*names).mapInArrow(per_part, schema).collect(), key=lambda r: r["pid"])
        if len(ranges) > 1:
            del ranged  # held by nobody: its shuffle can go
            drop_finished_shuffles(some.sparkSession)
    out = []
    for i in range(len(names)):
        mine = [r for r in parts if r["model"] == i]
        sums = {f: math.fsum(r[f] for r in mine) for f in fields[:6]}
        ssd = sums.pop("ssd") + sum((b["first"] - a["last"]) ** 2 for a, b in zip(mine, mine[1:]))
        out.append(sums | {"dw": ssd / sums["s2"] if sums["s2"] > 0 else float("nan")})
    return out


def steps(resid: DataFrame, names: list[str], order_by: list[str], n_rows: int | None = None, partitions: int | None = None) -> list[float]:
    """Durbin-Watson of each residual column in ``order_by`` order."""
    return [m["dw"] for m in ordered_moments(resid, names, order_by, n_rows, partitions)]


def residuals(table: DataFrame, models: list[tuple[str, OLSFit, ModelSpec]], carry: str) -> DataFrame:
    """``carry`` and one residual column per (name, fit, spec), NULL outside the model's rows.

    One scan in which the workers take logarithms and multiply.  Of a log model whose
    name ends in ``!`` the residual is that after ``expm1``, on the original scale.
    """
    columns = list(dict.fromkeys(c for _, _, sp in models for c in [*sp.terms, sp.response]))
    places = [([columns.index(c) for c in sp.terms], columns.index(sp.response)) for _, _, sp in models]
    masks = list(dict.fromkeys(sp.mask for _, _, sp in models))
    needs = [[columns.index(c) for c in [*sp.terms, sp.response]] for _, _, sp in models]
    coefs = [fit.coef for _, fit, _ in models]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            values = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns]).astype(np.float64, copy=False)
            with np.errstate(all="ignore"):
                logged = np.log1p(values)
                made = []
                for (name, _, sp), (xs, y), need, coef in zip(models, places, needs, coefs):
                    use = logged if sp.log else values
                    fitted = coef[0] + use[:, xs] @ coef[1:]
                    e = values[:, y] - np.expm1(fitted) if name.endswith("!") else use[:, y] - fitted
                    ok = np.asarray(batch.column(sp.mask).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
                    ok = ok & np.isfinite(use[:, need]).all(axis=1)
                    made.append(pa.array(e, mask=~ok))
            yield pa.RecordBatch.from_arrays([batch.column(carry), *made], names=[carry, *[m[0] for m in models]])

    kind = table.schema[carry].dataType.simpleString()
    schema = f"`{carry}` {kind}, " + ", ".join(f"`{m[0]}` double" for m in models)
    return table.select(carry, *columns, *masks).mapInArrow(run, schema)


def durbin_watson_many(
    df: DataFrame,
    models: list[tuple[OLSFit, str]],
    order_by: list[str],
    partitions: int | None = None,
) -> list[float]:
    """Durbin-Watson of several models (each with its row-mask column) from one sorted scan."""
    cols = []
    for i, (fit, mask) in enumerate(models):
        ok = F.coalesce(F.col(mask), F.lit(False)) & finite_mask([fit.response, *fit.terms])
        cols.append(F.when(ok, F.col(fit.response).cast("double") - fit.prediction()).alias(f"__e{i}"))
    return steps(df.select(*order_by, *cols), [f"__e{i}" for i in range(len(models))], order_by, max((f.n for f, _ in models), default=0), partitions)


def durbin_watson(df: DataFrame, fit: OLSFit, order_by: list[str] | None = None, partitions: int | None = None) -> float:
    """Durbin-Watson statistic of the residuals in ``order_by`` order.

    Without ``order_by`` the order is a content hash of the row's values.
    """
    if order_by is None:
        df = df.select(*[F.col(c).cast("double").alias(c) for c in [fit.response, *fit.terms]])
        df, order_by = df.withColumn("__h", F.xxhash64(*df.columns)), ["__h"]
    return durbin_watson_many(df.withColumn("__all", F.lit(True)), [(fit, "__all")], list(order_by), partitions)[0]


def significant_terms(fit: OLSFit, alpha: float = 0.05) -> list[str]:
    """Terms with p < alpha, intercept removed."""
    return [n for n, p in zip(fit.names, fit.p) if p < alpha and n != INTERCEPT]


def coef_table(fit: OLSFit, spark: SparkSession) -> DataFrame:
    """Coefficients sorted ascending with star labels and CI half-widths (``error``)."""
    from ..functions.text import star_label

    return (
        fit.coef_df(spark)
        .withColumn("label", star_label(F.col("term"), F.col("p_value")))
        .withColumn("error", F.col("coef") - F.col("ci_low"))
        .orderBy("coef")
    )


def predict(df: DataFrame, fit: OLSFit, name: str = "prediction") -> DataFrame:
    """Adds the fitted value as a column."""
    return df.withColumn(name, fit.prediction())


def score(df: DataFrame, fit: OLSFit) -> dict[str, float]:
    """MSE and RMSE on the model scale and RMSE after ``expm1`` back-transform."""
    pred = fit.prediction()
    y = F.col(fit.response).cast("double")
    row = df.select(((y - pred) ** 2).alias("se"), ((F.expm1(y) - F.expm1(pred)) ** 2).alias("se_orig")).agg(
        F.avg("se").alias("mse"), F.avg("se_orig").alias("mse_orig"), F.count(F.lit(1)).alias("n")
    ).first()
    mse = float(row["mse"]) if row["mse"] is not None else float("nan")
    mse_o = float(row["mse_orig"]) if row["mse_orig"] is not None else float("nan")
    return {"n": float(row["n"]), "mse": mse, "rmse": math.sqrt(mse) if mse == mse else mse, "rmse_original": math.sqrt(mse_o) if mse_o == mse_o else mse_o}


def split_place(key: Column, seed: int = 0) -> Column:
    """Place of a key in [0, 2**32): first 32 bits of md5 of its text form (and the seed, unless 0)."""
    text = key.cast("string") if seed == 0 else F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def split_cut(fraction: float) -> int:
    """Keys below this place are the given fraction of all places."""
    return int(round(fraction * 2**32))


def hash_split(
    df: DataFrame, key: str | Column, validation_fraction: float = 0.2, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Deterministic (train, validation) split by key hash; stable across partitionings."""
    key = F.col(key) if isinstance(key, str) else key
    place, cut = split_place(key, seed), split_cut(validation_fraction)
    return df.filter(place >= cut), df.filter(place < cut)


def discarded(before: OLSFit, after_terms: list[str]) -> int:
    """Terms before (intercept included) minus terms kept (intercept excluded)."""
    return len(before.names) - len(after_terms)
