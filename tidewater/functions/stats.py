"""Distribution tails and normality tests on a handful of driver-side numbers.

Only scalars and k-sized vectors pass through here (the sums come from Spark
aggregations).  Implemented from the published definitions: the regularised
incomplete beta function by its continued fraction (Student t and F
tails), D'Agostino's skewness test, Anscombe-Glynn's kurtosis test, their
K^2 combination and the Jarque-Bera statistic (chi-square, 2 df).
"""

from __future__ import annotations

import math


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b).

    DLMF 8.17.22: the continued fraction 1/(1 + d1/(1 + d2/(1 + ...))), worth
    using below the mean (a+1)/(a+b+2) and mirrored above it.  It is evaluated
    from the far end, with twice as many terms until the value settles.
    """
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - betainc(b, a, 1.0 - x)

    def coefficient(j: int) -> float:
        m = j // 2
        top = m * (b - m) if j % 2 == 0 else -(a + m) * (a + b + m)
        return top * x / ((a + j - 1) * (a + j))

    def fraction(terms: int) -> float:
        tail = 1.0
        for j in range(terms, 0, -1):
            tail = 1.0 + coefficient(j) / tail
        return 1.0 / tail

    terms, value = 32, fraction(32)
    while terms < 1 << 16:
        terms *= 2
        before, value = value, fraction(terms)
        if abs(value - before) <= 1e-15 * abs(value):
            break
    log_factor = a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a + 1.0) - math.lgamma(b)
    return math.exp(log_factor) * value


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value P(|T| > |t|) of Student's t with ``df`` degrees of freedom."""
    if math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_ppf(q: float, df: float) -> float:
    """Quantile of Student's t (bisection on the tail, q in (0.5, 1))."""
    if df <= 0:
        return float("nan")
    target = 2.0 * (1.0 - q)  # two-sided tail at the quantile
    lo, hi = 0.0, 1.0
    while t_sf2(hi, df) > target:
        hi *= 2.0
        if hi > 1e12:
            break
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_sf2(mid, df) > target:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail P(F > f) of the F distribution."""
    if math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def skew_test_z(skew: float, n: float) -> float:
    """D'Agostino (1970): sample skewness as a standard normal, by a Johnson S_U curve.

    The curve has the variance and kurtosis that the skewness has under normality.
    """
    variance = 6.0 * (n - 2) / ((n + 1) * (n + 3))
    kurtosis = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    omega2 = math.sqrt(2.0 * kurtosis - 2.0) - 1.0
    spread = math.sqrt(2.0 / (omega2 - 1.0))
    return math.asinh(skew / math.sqrt(variance) / spread) / math.sqrt(math.log(omega2) / 2.0)


def kurtosis_test_z(kurt: float, n: float) -> float:
    """Anscombe and Glynn (1983): sample kurtosis (not excess) as a standard normal.

    The standardised kurtosis is matched in its third moment by a reciprocal
    chi-square of ``df`` degrees, whose cube root is nearly normal.
    """
    mean = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    third = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    df = 6.0 + 8.0 / third * (2.0 / third + math.sqrt(1.0 + 4.0 / third**2))
    bias = 2.0 / (9.0 * df)
    below = 1.0 + (kurt - mean) / math.sqrt(variance) * math.sqrt(2.0 / (df - 4.0))
    if below == 0:
        return float("nan")
    return (1.0 - bias - math.cbrt((1.0 - 2.0 / df) / below)) / math.sqrt(bias)


def omnibus(skew: float, kurt: float, n: float) -> tuple[float, float]:
    """D'Agostino-Pearson K^2 and its p-value (chi-square, 2 df)."""
    if n < 8:
        return float("nan"), float("nan")
    k2 = skew_test_z(skew, n) ** 2 + kurtosis_test_z(kurt, n) ** 2
    return k2, math.exp(-k2 / 2.0)


def jarque_bera(skew: float, kurt: float, n: float) -> tuple[float, float]:
    """Jarque-Bera statistic and its p-value (chi-square, 2 df)."""
    jb = n / 6.0 * (skew ** 2 + (kurt - 3.0) ** 2 / 4.0)
    return jb, math.exp(-jb / 2.0)
