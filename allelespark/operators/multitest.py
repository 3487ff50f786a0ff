"""Multiple-testing correction and quantile-quantile tables."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespark.functions.stats import beta_ppf_udf, norm_ppf_col
from allelespark.operators.clean import neg_log10
from allelespark.operators.filters import valid_p
from allelespark.operators.ordered import ordered, scalars
from allelespark.session import materialize

_ALL = "_all_rows"


def bh_fdr(df: DataFrame, keys: Sequence[str] = (), p: str = "p_value", out: str = "fdr") -> DataFrame:
    """Benjamini-Hochberg per group; invalid p-values get 1.

    Rows are range-partitioned on (group, p) and fixed by a reliable checkpoint, so the source is computed before
    anything depends on its values.  Ranks and running minima are taken inside a range and completed from one row per (group,
    range); nothing is joined on a p-value.  A large group, or a run of equal values, is cut like any other range.
    """
    grp = list(keys) or [_ALL]
    value = F.col(p).cast("double")
    valid = F.when((value > 0) & (value <= 1), value)
    last = F.coalesce(valid, F.lit(2.0))  # invalid values lie behind all others
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # only the columns that came are shuffled and written
    cut = materialize(df.repartitionByRange(n, *keys, last, F.xxhash64(*df.columns)).withColumn("_piece", F.spark_partition_id()))
    cut = cut.withColumns({_ALL: F.lit(0), "_v": valid, "_v2": last})
    here = Window.partitionBy("_piece", *grp)
    start = Window.unboundedPreceding
    ranked = cut.withColumn("_rn", F.row_number().over(here.orderBy("_v2")))
    by_piece = Window.partitionBy(*grp).orderBy("_piece")
    sizes = cut.groupBy("_piece", *grp).agg(F.count("_v").alias("_t"))
    sizes = sizes.select("_piece", *grp, F.coalesce(F.sum("_t").over(by_piece.rowsBetween(start, -1)), F.lit(0)).alias("_off"), F.sum("_t").over(Window.partitionBy(*grp)).alias("_n"))
    raw = _join_pieces(ranked, sizes, grp).withColumn("_raw", F.col("_v") * F.col("_n") / (F.col("_off") + F.col("_rn")))
    floor = raw.groupBy("_piece", *grp).agg(F.min("_raw").alias("_m"))
    by_piece_down = Window.partitionBy(*grp).orderBy(F.desc("_piece")).rowsBetween(start, -1)
    floor = floor.select("_piece", *grp, F.min("_m").over(by_piece_down).alias("_rest"))
    tail = raw.withColumn("_tail", F.min("_raw").over(here.orderBy(F.desc("_rn")).rowsBetween(start, 0)))
    fdr = F.when(F.col("_v").isNull(), 1.0).otherwise(F.least("_tail", F.coalesce("_rest", F.lit(1.0)), F.lit(1.0)))
    return _join_pieces(tail, floor, grp).select(*df.columns, fdr.alias(out))


def _join_pieces(rows: DataFrame, pieces: DataFrame, grp: list[str]) -> DataFrame:
    """Per-range values on every row; group columns may be null."""
    names = ["_piece", *grp]
    other = pieces.withColumnsRenamed({c: f"_j{c}" for c in names})
    on = [rows[c].eqNullSafe(other[f"_j{c}"]) for c in names]
    return rows.join(other, on).drop(*[f"_j{c}" for c in names])


def pi0(df: DataFrame, p: str = "p_value", at: float | None = None) -> Column:
    """Share of true nulls: at the lambda ``at``, or without it by a natural spline through the lambda grid, whatever the number of tests.

    The grid is one aggregate of 19 counts; only those reach the driver.
    """
    good = valid_p(df, p)
    share = lambda lam: F.least(F.lit(1.0), F.count_if(F.col(p) > lam) / F.count(F.lit(1)) / (1 - lam))
    if at is not None:
        return scalars(good, share(at).alias("pi0"))[0]
    grid = np.round(np.arange(0.05, 1.0, 0.05), 2)
    row = good.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(p) > float(v)).alias(f"c{i}") for i, v in enumerate(grid)]).first()
    n = row["n"]
    if not n:
        return F.lit(1.0)
    y = np.array([row[f"c{i}"] for i in range(len(grid))]) / n / (1 - grid)
    # natural cubic spline with knots at the ends and the middle (three degrees of freedom)
    k = np.array([grid[0], grid[len(grid) // 2], grid[-1]])
    cube = lambda c: np.maximum(grid - c, 0.0) ** 3
    basis = (cube(k[0]) - cube(k[2])) / (k[2] - k[0]) - (cube(k[1]) - cube(k[2])) / (k[2] - k[1])
    design = np.column_stack([np.ones_like(grid), grid, basis])
    fit = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    return F.lit(float(min(1.0, max(fit[-1], 1.0 / n))))


def qvalues(df: DataFrame, p: str = "p_value", lam: float | None = None) -> DataFrame:
    """Storey q-values: the null share times the BH value."""
    out = bh_fdr(df, (), p, "_bh")
    return out.withColumn("qval", F.least(F.lit(1.0), F.col("_bh") * pi0(df, p, lam))).drop("_bh")


def significance_threshold(qv: DataFrame, fdr: float = 0.05, p: str = "p_value") -> DataFrame:
    """Largest p-value whose q-value is within the FDR, and how many rows are."""
    hit = F.col("qval") <= fdr
    return qv.agg(F.max(F.when(hit, F.col(p))).alias("p_threshold"), F.count_if(hit).alias("n_significant"))


def qq_points(df: DataFrame, *ids: str, p: str = "p_value") -> DataFrame:
    """Observed and expected -log10 p by global rank."""
    good = valid_p(df, p)
    (n,) = scalars(good, F.count(F.lit(1)).alias("n"))
    out = ordered(good.select(*ids, p), [], [F.col(p), *[F.col(i) for i in ids]]).select("*", n)
    return out.select(
        *ids, "rank", "n", neg_log10(F.col(p)).alias("observed"), (-F.log10(F.col("rank") / F.col("n"))).alias("expected")
    )


def qq_band(points: DataFrame, level: float = 0.95) -> DataFrame:
    """Pointwise band of the i-th of n uniform order statistics."""
    i, n = F.col("rank").cast("double"), F.col("n").cast("double")
    edge = lambda q: -F.log10(beta_ppf_udf(F.lit(q), i, n - i + 1))
    return points.withColumn("lower", edge((1 - level) / 2)).withColumn("upper", edge((1 + level) / 2))


def normal_qq(df: DataFrame, *ids: str, value: str = "value") -> DataFrame:
    """Sorted values against normal quantiles on an even grid from 0.01 to 0.99."""
    rows = df.where(F.col(value).isNotNull()).select(*ids, value)
    (n,) = scalars(rows, F.count(F.lit(1)).alias("_n"))
    out = ordered(rows, [], [F.col(value), *[F.col(i) for i in ids]]).select("*", n)
    share = 0.01 + 0.98 * (F.col("rank") - 1) / F.greatest(F.col("_n") - 1, F.lit(1))
    return out.select(*ids, "rank", F.col(value).alias("observed"), norm_ppf_col(share).alias("theoretical"))
