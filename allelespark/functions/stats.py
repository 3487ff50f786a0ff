"""Distribution functions: NumPy-vectorised tails, and a pure-column normal quantile."""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Coefficients of the AS 241 normal quantile (Wichura 1988), low order first.
PPF_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
PPF_MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
PPF_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)
CHI2_MEDIAN_1DF = 0.4549364  # fixed value: median of chi-square with one degree of freedom


def _ratio(table, r):
    """Rational approximation p(r)/q(r); works for NumPy arrays and Spark columns alike."""
    top, bottom = table
    p, q = top[-1], bottom[-1]
    for a, b in zip(top[-2::-1], bottom[-2::-1]):
        p, q = r * p + a, r * q + b
    return p / q


def norm_ppf(p):
    """Standard normal quantile."""
    p = np.asarray(p, dtype=float)
    q = p - 0.5
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.sqrt(-np.log(np.where(q < 0, p, 1 - p)))
        far = np.where(r <= 5, _ratio(PPF_MIDDLE, r - 1.6), _ratio(PPF_TAIL, r - 5))
        near = q * _ratio(PPF_CENTRE, 0.180625 - q * q)
        out = np.where(np.abs(q) <= 0.425, near, np.where(q < 0, -far, far))
    return np.where(p == 0, -np.inf, np.where(p == 1, np.inf, out))


def norm_ppf_col(p: Column) -> Column:
    """Standard normal quantile as built-in column arithmetic, no Python worker.

    Intermediate values are bound by ``transform`` over one-element arrays, so each is written
    into the plan once instead of once per polynomial term.
    """
    let = lambda value, body: F.get(F.transform(F.array(value), body), 0)
    tail = lambda r: F.when(r <= 5, let(r - 1.6, lambda x: _ratio(PPF_MIDDLE, x))).otherwise(
        let(r - 5, lambda x: _ratio(PPF_TAIL, x))
    )

    def quantile(p: Column) -> Column:
        q = p - 0.5
        far = let(F.sqrt(-F.log(F.least(p, 1 - p))), tail)
        near = q * let(F.lit(0.180625) - q * q, lambda x: _ratio(PPF_CENTRE, x))
        return (
            F.when(p == 0, float("-inf")).when(p == 1, float("inf"))
            .when(F.abs(q) <= 0.425, near).otherwise(F.when(q < 0, -far).otherwise(far))
        )

    return let(p, quantile)


def gammaln(x):
    """Log gamma for positive x: shift to x >= 12, then Stirling's series."""
    x = np.asarray(x, dtype=float).copy()
    shift = np.zeros_like(x)
    while np.any(x < 12):
        low = x < 12
        shift = np.where(low, shift + np.log(np.where(low, x, 1.0)), shift)
        x = np.where(low, x + 1, x)
    inv = 1.0 / x
    series = inv * (1 / 12 - inv**2 * (1 / 360 - inv**2 * (1 / 1260 - inv**2 * (1 / 1680 - inv**2 / 1188))))
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - shift


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta, modified Lentz steps on whole arrays.

    An element stops at its own convergence, so its value does not depend on its neighbours.
    """
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h, live = d.copy(), np.ones(np.shape(x), bool)
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = np.where(live, h * d * c, h)
        live = live & (np.abs(d * c - 1) >= 1e-15)
        if not live.any():
            break
    return h


def log_betainc(a, b, x, y=None):
    """Log of the regularised incomplete beta; pass ``y = 1 - x`` when x is close to one."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    y = 1 - x if y is None else np.broadcast_to(np.asarray(y, dtype=float), x.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = gammaln(a + b) - gammaln(a) - gammaln(b) + a * np.log(x) + b * np.log(y)
        direct = x < (a + 1) / (a + b + 2)
        one = front + np.log(_beta_fraction(np.where(direct, a, b), np.where(direct, b, a), np.where(direct, x, y)))
        one = one - np.log(np.where(direct, a, b))
        out = np.where(direct, one, np.log1p(-np.minimum(np.exp(one), 1.0)))
    return np.where(x <= 0, -np.inf, np.where(y <= 0, 0.0, out))


def betainc(a, b, x):
    return np.exp(log_betainc(a, b, x))


def t_log_p(t, dof):
    """Log of the two-sided t-test p-value (finite far beyond double underflow)."""
    t, dof = np.broadcast_arrays(np.asarray(t, dtype=float), np.asarray(dof, dtype=float))
    good = np.isfinite(t) & (dof > 0)
    tt, nu = np.minimum(np.abs(np.where(good, t, 0.0)), 1e150) ** 2, np.where(good, dof, 1.0)
    return np.where(good, log_betainc(nu / 2, 0.5, nu / (nu + tt), tt / (nu + tt)), np.nan)


def t_p(t, dof):
    return np.exp(t_log_p(t, dof))


def beta_ppf(q, a, b):
    """Beta quantile: Newton steps from a normal start, kept inside a shrinking bracket."""
    q, a, b = (np.array(v, dtype=float).ravel() for v in np.broadcast_arrays(q, a, b))
    mean, sd = a / (a + b), np.sqrt(a * b / (a + b + 1)) / (a + b)
    x = np.clip(mean + norm_ppf(q) * sd, mean * 1e-3, 1 - (1 - mean) * 1e-3)
    lo, hi = np.zeros_like(q), np.ones_like(q)
    norm = gammaln(a + b) - gammaln(a) - gammaln(b)
    live = np.arange(len(q))
    for _ in range(100):
        xa, aa, ba = x[live], a[live], b[live]
        f = betainc(aa, ba, xa) - q[live]
        lo[live], hi[live] = np.where(f < 0, xa, lo[live]), np.where(f >= 0, xa, hi[live])
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = xa - f / np.exp(norm[live] + (aa - 1) * np.log(xa) + (ba - 1) * np.log1p(-xa))
        new = np.where((step > lo[live]) & (step < hi[live]), step, 0.5 * (lo[live] + hi[live]))
        x[live] = new
        live = live[np.abs(new - xa) > 1e-12 * xa]
        if not len(live):
            break
    return x


def r_threshold(p: float, dof: float) -> float:
    """Smallest absolute correlation whose two-sided p-value is at most ``p``."""
    lo, hi = 0.0, 1.0 - 1e-15
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_p(mid * np.sqrt(dof / (1 - mid * mid)), dof) <= p:
            hi = mid
        else:
            lo = mid
    return hi


def _outward(h: np.ndarray, rare: np.ndarray, n: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Sum of the weights from heterozygote count ``h`` on, in a row's steps of +-2 away from the mode, relative to that of ``h``.

    Weights fall from there, so a row is done when a term adds nothing.
    """
    total, term = np.ones(len(h)), np.ones(len(h))
    h, live = h.astype(float).copy(), np.arange(len(h))
    while len(live):
        x, r, m, d = h[live], rare[live], n[live], step[live]
        homr, homc = (r - x) / 2, m - (r + x) / 2
        ratio = np.where(d > 0, 4 * homr * homc / ((x + 2) * (x + 1)), x * (x - 1) / (4 * (homr + 1) * (homc + 1)))
        term[live] *= np.maximum(ratio, 0.0)
        h[live] += d
        total[live] += term[live]
        live = live[term[live] > 1e-17 * total[live]]
    return total


def hwe_exact(hom1, het, hom2, midp: bool = False):
    """Exact Hardy-Weinberg p, or mid-p: the share of heterozygote counts no likelier than the observed one, given the allele counts.

    All distinct count triples of a batch go through together: from the mode for the total, and from the observed count and its
    counterpart on the other side of the mode for the tails, in steps of the recurrence until terms vanish.
    """
    counts = np.stack([np.minimum(hom1, hom2), het, np.maximum(hom1, hom2)], axis=1).astype(np.int64)
    uniq, back = np.unique(counts, axis=0, return_inverse=True)
    a, h, c = uniq.T.astype(float)
    n, rare = a + h + c, 2 * a + h

    def log_weight(x):
        homr = (rare - x) / 2
        return x * np.log(2.0) - gammaln(homr + 1) - gammaln(x + 1) - gammaln(n - homr - x + 1)

    with np.errstate(divide="ignore", invalid="ignore"):
        mode = np.where(n > 0, np.floor(rare * (2 * n - rare) / np.maximum(2 * n, 1)), 0.0)
    mode = np.clip(mode + (mode - rare) % 2, rare % 2, rare)
    for move in (-2, 2):  # rounding may leave it one step off
        to = np.clip(mode + move, rare % 2, rare)
        mode = np.where(log_weight(to) > log_weight(mode), to, mode)
    own, top = log_weight(h), log_weight(mode)
    side = np.where(h < mode, 2.0, -2.0)  # towards the mode and beyond
    total = _outward(mode, rare, n, side) + _outward(mode, rare, n, -side) - 1
    tail = _outward(h, rare, n, -side)
    # the nearest count beyond the mode that is no likelier, by bisection in steps of two
    same = 1e-8 * np.maximum(1.0, np.abs(own) * 1e-7)
    at_top = np.abs(own - top) <= same
    far = np.where(side > 0, rare, rare % 2)
    near = np.where(at_top, far, mode)
    exists = (log_weight(far) <= own + same) & ~at_top
    lo, hi = np.zeros(len(n)), np.abs(far - near) / 2
    while (hi - lo > 1).any():
        mid = np.floor((lo + hi) / 2)
        below = log_weight(near + side * mid) <= own + same
        go = hi - lo > 1
        lo, hi = np.where(go & ~below, mid, lo), np.where(go & below, mid, hi)
    other = near + side * hi
    rest = _outward(other, rare, n, side) * np.exp(np.minimum(log_weight(other) - own, 0.0))
    tails = tail + np.where(exists, rest, 0.0)
    share = np.exp(own - top) / total
    equal = lambda x: (x >= 0) & (x <= rare) & (np.abs(log_weight(np.clip(x, rare % 2, rare)) - own) <= same)
    twin = np.where(at_top, equal(h - 2) | equal(h + 2), exists & (np.abs(log_weight(other) - own) <= same))
    p = np.where(at_top, 1.0, tails * share) - (0.5 * share * (1 + twin) if midp else 0.0)
    return np.where(n > 0, np.clip(p, 0.0, 1.0), 1.0)[back.ravel()]


def hwe_midp(hom1, het, hom2):
    return hwe_exact(hom1, het, hom2, midp=True)


@F.pandas_udf(DoubleType())
def t_p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(t_p(t.to_numpy(float), dof.to_numpy(float)))


@F.pandas_udf(DoubleType())
def t_log10p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    """-log10 of the two-sided p-value, still exact where p itself is zero in double."""
    return pd.Series(-t_log_p(t.to_numpy(float), dof.to_numpy(float)) / np.log(10))


@F.pandas_udf(DoubleType())
def norm_p_udf(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal."""
    return pd.Series([math.erfc(abs(x) / math.sqrt(2)) for x in z.to_numpy(float)])


@F.pandas_udf(DoubleType())
def hwe_midp_udf(hom1: pd.Series, het: pd.Series, hom2: pd.Series) -> pd.Series:
    return pd.Series(hwe_midp(hom1.to_numpy(), het.to_numpy(), hom2.to_numpy()))


@F.pandas_udf(DoubleType())
def hwe_exact_udf(hom1: pd.Series, het: pd.Series, hom2: pd.Series) -> pd.Series:
    return pd.Series(hwe_exact(hom1.to_numpy(), het.to_numpy(), hom2.to_numpy()))


@F.pandas_udf(DoubleType())
def beta_ppf_udf(q: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(beta_ppf(q.to_numpy(float), a.to_numpy(float), b.to_numpy(float)))


@F.pandas_udf(DoubleType())
def beta_cdf_udf(x: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(betainc(a.to_numpy(float), b.to_numpy(float), x.to_numpy(float)))
