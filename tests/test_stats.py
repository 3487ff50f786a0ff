"""Distribution functions against tabulated values and identities."""
import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from allelespark.functions import stats as S


def test_normal_quantile():
    p = np.array([1e-300, 1e-20, 1e-10, 0.001, 0.025, 0.2, 0.5, 0.8, 0.975, 0.999999])
    want = [NormalDist().inv_cdf(x) for x in p]
    assert np.allclose(S.norm_ppf(p), want, rtol=1e-13, atol=1e-14)


def test_normal_quantile_column(spark):
    p = [1e-300, 1e-12, 0.01, 0.3, 0.5, 0.9, 0.99999]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(S.norm_ppf_col(F.col("p"))).collect()]
    assert np.allclose(got, S.norm_ppf(np.array(p)), rtol=1e-12, atol=1e-14)


def test_t_tail():
    # one degree of freedom is the Cauchy distribution, two have a closed form
    t = np.array([0.1, 1.0, 5.0, 300.0])
    assert np.allclose(S.t_p(t, 1), 1 - 2 / np.pi * np.arctan(t), rtol=1e-9)
    assert np.allclose(S.t_p(t, 2), 1 - t / np.sqrt(2 + t * t), rtol=1e-9)
    assert np.isclose(S.t_p(2.228138852, 10), 0.05, rtol=1e-8)
    assert np.isfinite(S.t_log_p(1e200, 500)) and S.t_p(1e200, 500) == 0


def test_beta_quantile_inverts():
    i = np.arange(1, 200.0)
    for q in (0.025, 0.5, 0.975):
        x = S.beta_ppf(q, i, 200 - i)
        assert np.allclose(S.betainc(i, 200 - i, x), q, atol=1e-9)
    assert np.isclose(S.beta_ppf(0.3, 1.0, 1.0)[0], 0.3)


def test_gammaln():
    x = np.array([0.5, 1.0, 2.5, 10.0, 1000.0])
    assert np.allclose(S.gammaln(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-13)


def test_hwe_midp_brute_force():
    def brute(a, h, c):
        n, rare = a + h + c, 2 * min(a, c) + h
        w = {}
        for het in range(rare % 2, rare + 1, 2):
            r = (rare - het) // 2
            w[het] = 2**het * math.factorial(n) / (math.factorial(r) * math.factorial(het) * math.factorial(n - r - het))
        tot = sum(w.values())
        return (sum(v for v in w.values() if v < w[h] * (1 - 1e-9)) + 0.5 * sum(v for v in w.values() if abs(v - w[h]) <= 1e-9 * w[h])) / tot

    trips = [(5, 10, 5), (20, 1, 9), (0, 20, 0), (13, 0, 2), (7, 7, 1)]
    got = S.hwe_midp(*[np.array(x) for x in zip(*trips)])
    assert np.allclose(got, [brute(*t) for t in trips], rtol=1e-9)


def test_r_threshold():
    r = S.r_threshold(1e-5, 36)
    assert np.isclose(S.t_p(r * np.sqrt(36 / (1 - r * r)), 36), 1e-5, rtol=1e-6)
