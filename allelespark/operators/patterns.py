"""Least squares on covariates where features lack samples.

Features that lack the same samples form a class and share the inverse of their normal equations.  A class is named by its sample count and
two order-free 64-bit hashes of its samples, so classes come out of the same partial aggregation as the features' cross-products; one
member of each class stands for it when the covariates are summed.  A feature that has all samples uses the cohort's inverse.  With gaps
everywhere there are as many classes as features, and the work is that of one more pass over the phenotype.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.session import materialize


def matrix_lit(m: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in m])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def solved(s: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, int]:
    """Pseudo-inverse and rank of a centred cross-product matrix, judged with all columns at one scale.

    A column whose sum of squares is rounding beside ``floor`` is constant and has no part.
    """
    diag = np.where(np.diag(s) > 1e-12 * floor, np.diag(s), 0.0)
    scale = np.sqrt(np.where(diag > 0, diag, 1.0))
    some = np.outer(diag > 0, diag > 0)
    values, vectors = np.linalg.eigh(np.where(some, s / np.outer(scale, scale), 0.0))
    use = values > 1e-11 * max(len(s), 1)
    inverse = (vectors[:, use] / values[use]) @ vectors[:, use].T
    return inverse / np.outer(scale, scale), int(use.sum())


class Fits:
    """Fits of every feature in ``cells`` (feature_id, sample_id, value, xc) on the samples it has, over a cohort of ``n`` samples.

    ``features`` has one row per feature: n, dof left after intercept and covariates, its class, sums and slopes.  ``xc`` are ``k``
    covariates centred over the cohort, ``inverse`` that of their cross-products, ``power`` their mean squares.
    """

    def __init__(self, cells: DataFrame, k: int, inverse: np.ndarray, n: int, power: np.ndarray):
        self.k, self.n, self.power = k, n, power
        self.cells = cells.where(F.col("value").isNotNull())
        y, x = F.col("value"), lambda i: F.element_at("xc", i + 1)
        empty = F.array().cast("array<double>")
        sums = lambda by: F.array(*[F.sum(by(i)) for i in range(k)]) if k else empty
        name = F.concat_ws(":", F.count(y), F.bit_xor(F.xxhash64("sample_id")), F.bit_xor(F.xxhash64(F.lit(1), "sample_id")))
        per = self.cells.groupBy("feature_id").agg(
            F.count(y).alias("n"), name.alias("cls"), F.avg(y).alias("ybar"), F.sum(y * y).alias("ss"), (F.min(y) == F.max(y)).alias("constant"),
            sums(lambda i: y * x(i)).alias("_c"), sums(lambda i: x(i)).alias("_sx"),
        )
        per = materialize(per)
        self.gapped = not per.where(F.col("n") < n).isEmpty()
        flat = F.array(*[F.lit(float(v)) for v in np.ravel(inverse)]) if k else empty
        rank = int(np.linalg.matrix_rank(inverse, hermitian=True)) if k else 0
        per = per.withColumns({"inv": F.when(F.col("n") == n, flat), "rank": F.when(F.col("n") == n, F.lit(rank))})
        if self.gapped:
            self.members = per.where(F.col("n") < n).groupBy("cls").agg(F.min("feature_id").alias("feature_id"))
            own = self._classes().withColumnsRenamed({"inv": "_inv", "rank": "_rank"})
            per = per.join(own, "cls", "left").withColumns({"inv": F.coalesce("inv", "_inv"), "rank": F.coalesce("rank", "_rank")})
        centred = F.zip_with("_c", F.col("_sx"), lambda c, s: c - s * F.col("ybar"))
        rows = lambda: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.slice("inv", i * k + 1, F.lit(k)))
        slopes = F.transform(rows(), lambda r: dot(r, F.col("_t"))) if k else empty
        per = per.withColumn("_t", centred).withColumn("slopes", F.when(~F.col("constant"), slopes))
        mean = F.transform("_sx", lambda s: s / F.col("n"))
        self.features = per.select(
            "feature_id", "n", (F.col("n") - 1 - F.col("rank")).alias("dof"), "cls", "ybar", "ss", "inv", "slopes", mean.alias("xbar")
        )

    def _classes(self) -> DataFrame:
        """(cls, inv, rank) of the classes with gaps, from one member each."""
        k, power = self.k, self.power
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        x = lambda i: F.element_at("xc", i + 1)
        array = lambda cols: F.array(*cols) if cols else F.array().cast("array<double>")
        rows = self.cells.join(self.members, "feature_id")
        sums = rows.groupBy("cls").agg(
            F.count(F.lit(1)).alias("n"), array([F.sum(x(i)) for i in range(k)]).alias("s1"), array([F.sum(x(i) * x(j)) for i, j in pairs]).alias("s2")
        )

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = []
                for n, s1, s2 in zip(b["n"], b["s1"], b["s2"]):
                    m, s1 = np.zeros((k, k)), np.asarray(s1, float)
                    for (i, j), v in zip(pairs, s2):
                        m[i, j] = m[j, i] = v
                    inverse, rank = solved(m - np.outer(s1, s1) / n, np.maximum(np.diag(m), n * power)) if k else (m, 0)
                    found.append((inverse.ravel(), rank))
                yield pd.DataFrame({"cls": b["cls"], "inv": [f[0] for f in found], "rank": [f[1] for f in found]})

        return sums.mapInPandas(solve, "cls string, inv array<double>, rank int")

    def residuals(self) -> DataFrame:
        """(feature_id, sample_id, value): what the intercept and the covariates leave, on the cells that are there."""
        per = self.features.select("feature_id", "ybar", "slopes", "xbar")
        effect = dot(F.col("slopes"), F.zip_with("xc", "xbar", lambda a, m: a - m)) if self.k else F.lit(0.0)
        value = F.col("value") - F.col("ybar") - F.coalesce(effect, F.lit(0.0))
        return self.cells.join(per, "feature_id").select("feature_id", "sample_id", value.alias("value"))

    def missing(self, samples: DataFrame) -> DataFrame:
        """(cls, miss, miss_x): the cohort positions that a class lacks and their covariates, flattened."""
        have = self.cells.join(self.members, "feature_id").join(samples.select("sample_id", "idx"), "sample_id")
        gone = have.groupBy("cls").agg(F.array_except(F.sequence(F.lit(0), F.lit(self.n - 1)), F.collect_list("idx")).alias("_miss"))  # one cohort
        rows = gone.select("cls", F.explode("_miss").alias("idx")).join(samples.select("idx", "xc"), "idx")
        out = rows.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("idx", "xc"))).alias("_m"))
        return out.select("cls", F.col("_m.idx").alias("miss"), F.flatten(F.col("_m.xc")).alias("miss_x"))
