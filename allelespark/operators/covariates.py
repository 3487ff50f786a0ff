"""Covariate encoding, covariate-effect removal, principal components and correlations."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespark.operators.blocks import spread
from allelespark.operators.normalize import fill_by_sample
from allelespark.operators.ordered import columns_of, with_group_stats
from allelespark.operators.patterns import Fits, dot, solved
from allelespark.session import materialize


def one_hot(cov: DataFrame, few_levels: int = 10) -> DataFrame:
    """Indicators per level with the first (sorted) level dropped; numeric covariates with few levels count."""
    num = F.col("value").try_cast("double")
    kinds = cov.groupBy("covariate").agg(
        F.count_if(F.col("value").isNotNull() & num.isNull()).alias("_text"),
        F.count_distinct("value").alias("_d"), F.min("value").alias("_first"),
    ).where((F.col("_text") > 0) | (F.col("_d") < few_levels))
    levels = cov.join(kinds, "covariate").where(F.col("value") > F.col("_first"))
    levels = levels.select("covariate", F.col("value").alias("level")).distinct()
    rows = cov.join(levels, "covariate")
    hit = F.coalesce((F.col("value") == F.col("level")).cast("int"), F.lit(0))
    return rows.select(F.concat_ws("_", "covariate", "level").alias("covariate"), "sample_id", hit.alias("value"))


def impute_mean(cov: DataFrame) -> DataFrame:
    """Numeric covariates as doubles with gaps at the covariate mean; non-numeric ones are left out."""
    num = F.col("value").try_cast("double")
    out = with_group_stats(
        cov.select("covariate", "sample_id", "value", num.alias("value_num")), ["covariate"],
        F.avg("value_num").alias("_m"), F.count_if(F.col("value").isNotNull() & F.col("value_num").isNull()).alias("_text"),
    ).where("_text = 0")
    return out.select("covariate", "sample_id", F.coalesce("value_num", "_m").alias("value"))


def standardise(cov: DataFrame) -> DataFrame:
    """Population z-score of covariates with more than two values; others unchanged."""
    out = with_group_stats(
        cov, ["covariate"], F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"), F.count_distinct("value").alias("_d")
    )
    z = F.when(F.col("_d") > 2, (F.col("value") - F.col("_m")) / F.col("_s")).otherwise(F.col("value"))
    return out.select("covariate", "sample_id", z.alias("value"))


def design_rows(cov: DataFrame, fill: bool = False) -> tuple[DataFrame, list[str]]:
    """Numeric long covariates as one vector per sample: (sample_id, x) and the covariate order.

    Only the covariate names reach the driver.  Samples lacking a covariate are left out, or, with
    ``fill``, take its mean.  The source is checkpointed, as it is read more than once.
    """
    cov = materialize(cov)
    names = sorted(r[0] for r in cov.select("covariate").distinct().collect())
    wide = cov.groupBy("sample_id").pivot("covariate", names).agg(F.first("value"))
    cells = [F.col(f"`{n}`").cast("double") for n in names]
    if fill:
        means = columns_of(wide.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cells)]))
        return wide.select("sample_id", F.array(*[F.coalesce(c, m) for c, m in zip(cells, means)]).alias("x")), names
    return wide.dropna().select("sample_id", F.array(*cells).alias("x")), names


class Design:
    """Centred sample vectors with their means and the inverse of their cross-products."""

    def __init__(self, cov: DataFrame, fill: bool = False):
        rows, names = design_rows(cov, fill)
        self.k, self.names = len(names), names
        self.n, self.mean, self.inverse, self.power = gram_inverse(rows, self.k)
        mu = F.array(*[F.lit(float(m)) for m in self.mean])
        self.rows = rows.select("sample_id", F.zip_with("x", mu, lambda a, m: a - m).alias("xc"))


def gram_inverse(design: DataFrame, k: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Samples, means, pseudo-inverse of the centred cross-products and variances of the covariates, from one k x k aggregate."""
    at = lambda i: F.element_at("x", i + 1)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = design.agg(
        F.count(F.lit(1)), *[F.avg(at(i)) for i in range(k)],
        *[F.covar_pop(at(i), at(j)) for i, j in pairs],
    ).first()
    n, mean = row[0], np.array(row[1 : 1 + k], dtype=float)
    s = np.zeros((k, k))
    for (i, j), v in zip(pairs, row[1 + k :]):
        s[i, j] = s[j, i] = v * n
    return n, mean, solved(s, np.diag(s) + n * mean * mean)[0], np.diag(s) / max(n, 1)


def remove_effects(df: DataFrame, cov: DataFrame | Design, centre: bool = False, gaps: str = "fit") -> DataFrame:
    """Subtract the fitted covariate part of a least-squares model with intercept, feature by feature.

    ``cov`` is numeric and long (one-hot included); its gaps take the covariate's mean.  A feature with missing cells is fitted on those
    it has, or with ``gaps="keep"`` stays as it is.  Cross-products with the covariates are partial aggregates; constant features stay as they are.  With ``centre`` the
    intercept is removed as well, which leaves the residual.
    """
    design = cov if isinstance(cov, Design) else Design(cov, fill=True)
    rows = df.join(design.rows, "sample_id")
    per = Fits(rows, design.k, design.inverse, design.n, design.power).features
    slopes = F.when(F.col("n") == design.n, F.col("slopes")) if gaps == "keep" else F.col("slopes")
    per = per.select(F.col("feature_id").alias("_f"), "ybar", slopes.alias("slopes"), "xbar")
    out = rows.join(per, F.col("feature_id") == F.col("_f"), "left")
    # raw x times the slopes is the covariate part; x centred over the feature's samples leaves its mean in place
    mu = F.array(*[F.lit(float(m)) for m in design.mean])
    at = F.zip_with("xc", F.col("xbar") if centre else mu, (lambda a, m: a - m) if centre else (lambda a, m: a + m))
    value = F.col("value") - F.coalesce(dot(F.col("slopes"), at), F.lit(0.0)) - (F.col("ybar") if centre else F.lit(0.0))
    return out.select(*[value.alias(c) if c == "value" else F.col(c) for c in df.columns])


def sample_index(df: DataFrame) -> DataFrame:
    """0-based position of each sample in id order: one row per sample of the cohort, never per cell."""
    ids = df.select("sample_id").distinct()
    return ids.select("sample_id", (F.row_number().over(Window.orderBy("sample_id")) - 1).cast("int").alias("idx"))


def packed_rows(df: DataFrame, index: DataFrame, key: str, value: str = "value", *carry: str) -> DataFrame:
    """One row per feature or variant with its non-null cells as parallel (idx, val) arrays."""
    cells = df.where(F.col(value).isNotNull()).join(index, "sample_id")
    packed = cells.groupBy(key, *carry).agg(F.array_sort(F.collect_list(F.struct("idx", F.col(value).alias("v")))).alias("_p"))
    return packed.select(key, *carry, F.col("_p.idx").alias("idx"), F.col("_p.v").alias("val"))


def dense(idx: Sequence, val: Sequence, n: int) -> np.ndarray:
    """Scatter packed rows into a matrix; absent cells are 0."""
    out = np.zeros((len(idx), n))
    lens = np.fromiter((len(i) for i in idx), dtype=np.int64, count=len(idx))
    if lens.sum():
        out[np.repeat(np.arange(len(idx)), lens), np.concatenate(list(idx)).astype(np.int64)] = np.concatenate(list(val))
    return out


def _gram(df: DataFrame, column: Column, m: int) -> np.ndarray:
    """Sum over rows of the outer product of an array column of length ``m``: one matrix per task, added up row by row."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((m, m))
        for b in batches:
            if len(b):
                x = np.stack(b["v"].to_list())
                total += x.T @ x
        yield pd.DataFrame({"i": np.arange(m), "row": list(total)})

    parts = df.select(column.alias("v")).mapInPandas(part, "i int, row array<double>")
    rows = parts.groupBy("i").agg(F.array(*[F.sum(F.element_at("row", j + 1)) for j in range(m)]).alias("row")).toPandas().sort_values("i")
    return np.array(rows["row"].to_list()).reshape(m, m)


def _times(df: DataFrame, key: str, column: Column, matrix: np.ndarray, out: str) -> DataFrame:
    """(key, out): each row's array times a small matrix."""

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["v"].to_list()) @ matrix if len(b) else np.zeros((0, matrix.shape[1]))
            yield pd.DataFrame({key: b[key], out: list(x)})

    return df.select(key, column.alias("v")).mapInPandas(product, f"{key} {df.schema[key].dataType.simpleString()}, {out} array<double>")


def principal_components(scaled: DataFrame, k: int, key: str = "feature_id", extra: int = 8, steps: int = 12, tol: float = 1e-8) -> DataFrame:
    """Sample scores of the top components: (component, sample_id, score, explained).

    ``scaled`` holds rows centred over samples (absent cells count as 0).  A random block of ``k + extra`` vectors is multiplied by the
    matrix and its transpose again and again; the blocks, made orthogonal, span a space in which the components are found (Rayleigh-Ritz).
    Samples and features stay rows of DataFrames: products are joins with the cells and sums, and only cross-products of the basis,
    some hundred numbers squared, visit the driver.  It ends when the eigen equation holds to ``tol`` of the largest eigenvalue, when the
    space is exhausted, or after ``steps`` blocks.  Signs are fixed so that the largest loading is positive.
    """
    cells = materialize(scaled.where(F.col("value").isNotNull()).select(key, "sample_id", "value"))
    samples = cells.select("sample_id").distinct()
    n = samples.count()
    width = min(n, k + extra)
    if not width:
        return cells.sparkSession.createDataFrame([], f"component int, sample_id {scaled.schema['sample_id'].dataType.simpleString()}, score double, explained double")
    total = cells.agg(F.sum(F.col("value") * F.col("value"))).first()[0] or 0.0

    def applied(by: str, to: str, vectors: DataFrame, column: Column, m: int) -> DataFrame:
        rows = cells.join(vectors.select(by, column.alias("_v")), by)
        return rows.groupBy(to).agg(F.array(*[F.sum(F.col("value") * F.element_at("_v", j + 1)) for j in range(m)]).alias("z"))

    noise = F.array(*[F.xxhash64(F.lit(j), F.col("sample_id").cast("string")) / 2.0**63 for j in range(width)])
    state = materialize(samples.select("sample_id", F.array().cast("array<double>").alias("b"), noise.alias("z")))  # basis and next block
    image = None  # (key, w): the matrix times the basis
    size, ritz, values = 0, None, np.zeros(0)
    for step in range(steps):
        grams = _gram(state, F.concat("b", "z"), size + width)
        s_bb, s_bz, s_zz = grams[:size, :size], grams[:size, size:], grams[size:, size:]
        along = np.linalg.solve(s_bb, s_bz) if size else s_bz
        rest = s_zz - s_bz.T @ along
        spread_, turn = np.linalg.eigh((rest + rest.T) / 2)
        if size:
            last = ritz[size - width_before :, :k]
            left = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", last, rest, last), 0))
            if (left <= tol * values[0]).all():
                break
        use = spread_ > 1e-13 * max(np.diag(s_zz).max(), 1e-300)
        fresh = int(use.sum())
        if not fresh:
            break
        change = turn[:, use] / np.sqrt(spread_[use])
        combine = np.vstack([-along @ change, change])
        block = materialize(_times(state, "sample_id", F.concat("b", "z"), combine, "x"))
        basis = state.join(block, "sample_id").select("sample_id", F.concat("b", "x").alias("b"))
        new = applied("sample_id", key, block, F.col("x"), fresh)
        image = new.withColumnRenamed("z", "w") if image is None else image.join(new, key).select(key, F.concat("w", "z").alias("w"))
        image = materialize(image)
        size, width_before = size + fresh, fresh
        h = _gram(image, F.col("w"), size)
        values, ritz = np.linalg.eigh((h + h.T) / 2)
        values, ritz = values[::-1], ritz[:, ::-1]
        back = applied(key, "sample_id", image, F.slice("w", size - fresh + 1, fresh), fresh)
        state, width = materialize(basis.join(back, "sample_id").select("sample_id", "b", "z")), fresh
    k = int(min(k, (values[:k] > 1e-12 * max(values.max(initial=0.0), 1e-300)).sum()))
    if not k:
        return cells.sparkSession.createDataFrame([], f"component int, sample_id {scaled.schema['sample_id'].dataType.simpleString()}, score double, explained double")
    found = materialize(_times(state, "sample_id", F.col("b"), ritz[:, :k], "v"))
    at = lambda j: F.element_at("v", j + 1)
    largest = found.agg(*[F.max_by(at(j), F.struct(F.round(F.abs(at(j)), 9), "sample_id")).alias(f"c{j}") for j in range(k)]).first()
    sign = [1.0 if x >= 0 else -1.0 for x in largest]
    scale = F.array(*[F.struct(F.lit(j + 1).alias("component"), (at(j) * sign[j] * float(np.sqrt(values[j]))).alias("score"), F.lit(float(values[j] / total)).alias("explained")) for j in range(k)])
    return found.select("sample_id", F.inline(scale)).select("component", "sample_id", "score", "explained")


def scale_features(df: DataFrame) -> DataFrame:
    """Centre and scale each varying feature; a gap takes the feature mean, which is 0 after centring."""
    out = with_group_stats(
        df, ["feature_id"], F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"),
        (F.count("value") / F.count(F.lit(1))).alias("_share"),
    ).where(F.col("_s") > 0)
    z = (F.col("value") - F.col("_m")) / (F.col("_s") * F.sqrt("_share"))
    return out.select("feature_id", "sample_id", F.coalesce(z, F.lit(0.0)).alias("value"))


def phenotype_pcs(df: DataFrame, k: int = 10) -> DataFrame:
    """PCs of the scaled features, as many as there are up to ``k``."""
    return principal_components(scale_features(df), k)


def genotype_pcs(geno: DataFrame, k: int = 10) -> DataFrame:
    """PCs of (g - 2p) / sqrt(2p(1-p)); missing calls sit at the mean.

    A variant has one cell per sample at most, so its frequency is a window over them, which spares a second aggregation and a join.
    """
    freq = F.avg("dosage").over(Window.partitionBy("variant_id")) / 2
    out = geno.where("dosage IS NOT NULL").select("variant_id", "sample_id", "dosage", freq.alias("_p"))
    out = out.where((F.col("_p") > 0) & (F.col("_p") < 1))
    z = (F.col("dosage") - 2 * F.col("_p")) / F.sqrt(2 * F.col("_p") * (1 - F.col("_p")))
    return principal_components(out.select("variant_id", "sample_id", z.alias("value")), k, "variant_id")


def compare_pcs(raw: DataFrame, norm: DataFrame, k: int = 3) -> DataFrame:
    tag = lambda d, s: phenotype_pcs(d, k).withColumn("matrix", F.lit(s))
    return tag(raw, "raw").unionByName(tag(norm, "normalized"))


def pcs_as_covariates(pcs: DataFrame) -> DataFrame:
    name = F.concat(F.lit("PC"), F.col("component").cast("string"))
    return pcs.select(name.alias("covariate"), "sample_id", F.col("score").cast("string").alias("value"))


def cross_products(packed: DataFrame, n: int, key: str, tile: int = 1024, chunk: int = 2048) -> DataFrame:
    """Sums over rows of v_i v_j for all column pairs i <= j, as (i, j, s).

    Rows are cut into column tiles and row chunks of bounded size; each (tile pair, chunk) is one
    matrix product, and partial sums are aggregated.
    """
    tiles = (n + tile - 1) // tile
    pairs = [(a, b) for a in range(tiles) for b in range(a, tiles)]
    chunks = max(1, -(-packed.count() // chunk))
    keyed = packed.select(
        F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int").alias("c"), "idx", "val",
        F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])).alias("t"),
    ).select("c", "t.a", "t.b", "idx", "val")
    if tiles > 1:  # keep only the cells of the two tiles
        keep = lambda i: (F.floor(i / tile) == F.col("a")) | (F.floor(i / tile) == F.col("b"))
        cell = F.filter(F.arrays_zip("idx", "val"), lambda z: keep(z["idx"]))
        keyed = keyed.withColumn("z", cell).select("c", "a", "b", F.col("z.idx").alias("idx"), F.col("z.val").alias("val"))

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = int(pdf["a"].iloc[0]), int(pdf["b"].iloc[0])
        m = dense(pdf["idx"], pdf["val"], n) if tiles == 1 else None
        if m is None:
            lo = [np.asarray(i) for i in pdf["idx"]]
            cut = lambda t: dense(
                [i[(i // tile) == t] - t * tile for i in lo],
                [np.asarray(v)[(i // tile) == t] for i, v in zip(lo, pdf["val"])], tile,
            )
            left, right = cut(a), cut(b)
        else:
            left = right = m
        g = left.T @ right
        i, j = np.indices(g.shape)
        i, j = i + a * tile, j + b * tile
        use = (i <= j) & (i < n) & (j < n)
        return pd.DataFrame({"i": i[use], "j": j[use], "s": g[use]})

    parts = spread(keyed, "c", "a", "b").groupBy("c", "a", "b").applyInPandas(product, "i int, j int, s double")
    return parts.groupBy("i", "j").agg(F.sum("s").alias("s"))


def sample_correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of samples over features (gaps filled by sample mean)."""
    z = with_group_stats(fill_by_sample(df), ["sample_id"], F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"), F.count(F.lit(1)).alias("_n"))
    z = z.select("feature_id", "sample_id", ((F.col("value") - F.col("_m")) / F.col("_s") / F.sqrt("_n")).alias("value"))
    index = materialize(sample_index(z))
    out = cross_products(materialize(packed_rows(z, index, "feature_id")), index.count(), "feature_id")
    a = index.select(F.col("idx").alias("i"), F.col("sample_id").alias("sample_a"))
    b = index.select(F.col("idx").alias("j"), F.col("sample_id").alias("sample_b"))
    return out.join(a, "i").join(b, "j").select("sample_a", "sample_b", F.col("s").alias("r"))


def feature_correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of (already selected) features over samples."""
    swap = lambda d: d.select(F.col("sample_id").alias("feature_id"), F.col("feature_id").alias("sample_id"), "value")
    return sample_correlation(swap(df)).withColumnsRenamed({"sample_a": "feature_a", "sample_b": "feature_b"})


def correlation_difference(raw: DataFrame, norm: DataFrame) -> DataFrame:
    a = sample_correlation(raw).withColumnRenamed("r", "raw_r")
    b = sample_correlation(norm).withColumnRenamed("r", "norm_r")
    return a.join(b, ["sample_a", "sample_b"]).withColumn("difference", F.col("norm_r") - F.col("raw_r"))
