"""Association scans: cis nominal and permutation, trans, linear and logistic GWAS."""
from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.functions.stats import betainc, hwe_exact_udf, norm_p_udf, norm_ppf, r_threshold, t_log_p, t_p
from allelespark.operators.blocks import bin_width, gene_bins, in_turns, rows_per_block, scan_blocks, spread, variant_bins
from allelespark.operators.covariates import Design, dense, packed_rows, sample_index
from allelespark.operators.filters import remove_trait_outliers
from allelespark.operators.joins import align_samples, drop_cis, restrict, shared_samples, tagged_union
from allelespark.operators.multitest import qvalues
from allelespark.operators.normalize import fill_by_sample
from allelespark.operators.ordered import columns_of
from allelespark.operators.patterns import Fits, dot, matrix_lit
from allelespark.session import materialize


class Prepared:
    """Aligned, covariate-adjusted inputs of a scan, all still distributed.

    Missing dosages sit at the variant mean, so a centred row holds only called cells.  The
    phenotype residual is orthogonal to the covariates; the product of the two is therefore the
    numerator of the partial regression, and the genotype side needs only one scalar per variant.

    A feature without a row for some samples is fitted on those it has, with its own degrees of
    freedom.  Its row carries the covariates of the samples it lacks, and a variant's cohort sums
    are reduced by theirs (``pair_sums``), so genotypes are still read and packed once.

    The phenotype is checkpointed as it comes, and so are the per-sample table and the residuals, because
    all are read several times; genotypes are read once per scan.
    """

    def __init__(
        self, geno: DataFrame, pheno: DataFrame, cov: DataFrame | None = None, samples: DataFrame | None = None, fill_nulls: bool = True
    ):
        """``samples`` may name the genotyped ids (a file header knows them) to spare a scan for them.

        Null phenotype cells take the mean of their sample, or with ``fill_nulls=False`` count as absent.
        """
        pheno = materialize(pheno)  # read for its samples, its means, its fits, its residuals and its gaps
        tables = [geno if samples is None else samples, pheno] + ([cov] if cov is not None else [])
        common = shared_samples(*tables)
        self.geno = geno.where("dosage IS NOT NULL").withColumn("sample_id", F.trim(F.col("sample_id").cast("string")))
        y = restrict(pheno, common)
        y = fill_by_sample(y) if fill_nulls else y
        if cov is not None:
            design = Design(restrict(cov, common))
            self.k, self.inverse, power = design.k, design.inverse, design.power
            # numbered after samples without all covariates have gone
            index = sample_index(design.rows.select("sample_id")).join(design.rows, "sample_id")
        else:
            self.k, self.inverse, power = 0, np.zeros((0, 0)), np.zeros(0)
            index = sample_index(common).withColumn("xc", F.array().cast("array<double>"))
        self.samples = materialize(index)
        self.n = self.samples.count()
        self.fits = Fits(y.join(self.samples.select("sample_id", "xc"), "sample_id"), self.k, self.inverse, self.n, power)
        self.gapped = self.fits.gapped
        self.packed: DataFrame | None = None
        self.resid = materialize(self.fits.residuals())
        self.dof = self.n - 2 - (int(np.linalg.matrix_rank(self.inverse, hermitian=True)) if self.k else 0)

    def pack(self) -> "Prepared":
        """Write the packed variants once for several scans."""
        self.packed = materialize(self.variant_moments())
        return self

    def variant_moments(self) -> DataFrame:
        """Packed centred dosages and cohort sums of every variant: one join with the samples and one aggregation, nothing is exploded."""
        g, k = F.col("dosage"), self.k
        rows = self.geno.join(self.samples, "sample_id")
        sums = lambda w: F.array(*[F.sum(w * F.element_at("xc", i + 1)) for i in range(k)]) if k else F.array().cast("array<double>")
        out = rows.groupBy("variant_id").agg(
            F.count(g).alias("n_called"), F.sum(g).alias("_s"), F.sum(g * g).alias("ss"), sums(g).alias("_gx"), sums(F.lit(1.0)).alias("x"),
            F.count_if(g > 0.5).alias("above"), F.count_if(g < 1.5).alias("below"), *[F.count_if(F.round(g) == i).alias(f"n{i}") for i in range(3)],
            F.collect_list(F.struct("idx", g.alias("v"))).alias("_p"),
        ).withColumn("mean", F.col("_s") / F.col("n_called"))
        out = out.withColumn("c", F.zip_with("_gx", "x", lambda a, b: a - F.col("mean") * b))
        out = out.withColumn("cs2", F.col("ss") - F.col("n_called") * F.col("mean") * F.col("mean"))
        adjusted = F.col("cs2") - dot(F.transform(matrix_lit(self.inverse), lambda r: dot(r, F.col("c"))), F.col("c")) if k else F.col("cs2")
        out = out.withColumns({"sg2": adjusted, "af": F.col("mean") / 2, "idx": F.col("_p.idx"), "val": F.transform("_p", lambda q: q["v"] - F.col("mean"))})
        return out.withColumn("maf", F.least(F.col("af"), 1 - F.col("af"))).drop("_s", "_gx", "_p")

    def variant_rows(self, variants: DataFrame | None = None, maf: float = 0.0, missing: float = 1.0, hwe: float = 0.0) -> DataFrame:
        """Packed rows of the variants that vary beyond the covariates, with their positions if ``variants`` are given.

        ``missing`` is the largest share of cohort samples without a call, ``hwe`` the smallest exact Hardy-Weinberg p; both are judged
        over the cohort, from the same aggregation.  With gaps the frequency is judged for each pair, on the samples of the feature.
        """
        mom = (self.packed or self.variant_moments()).where(F.col("sg2") > VARIES * F.col("ss"))
        if maf > 0 and not self.gapped:
            mom = mom.where(F.col("maf") >= maf)
        if missing < 1:
            mom = mom.where(1 - F.col("n_called") / self.n <= missing)
        if hwe > 0:
            mom = mom.where(hwe_exact_udf("n0", "n1", "n2") >= hwe)
        mom = mom.select("variant_id", "idx", "val", "sg2", "af", "maf", "n_called", *_SUMS)
        return mom if variants is None else mom.join(variants.select("variant_id", "chrom", "pos"), "variant_id")

    def _packed(self) -> DataFrame:
        packed = packed_rows(self.resid, self.samples.select("sample_id", "idx"), "feature_id").withColumn("sy2", dot(F.col("val"), F.col("val")))
        own = self.fits.features.select("feature_id", "n", (F.col("dof") - 1).cast("double").alias("dof"), "cls", "inv", "ss")
        return packed.join(own, "feature_id")

    def feature_rows(self, places: DataFrame | None = None) -> DataFrame:
        """Packed residuals with their sum of squares, the feature's own fit, and the feature interval if ``places`` are given."""
        packed = self._packed().where(_VARYING)
        if self.gapped:
            packed = packed.join(self.fits.missing(self.samples), "cls", "left")
        packed = packed.drop("ss")
        if places is None:
            return packed
        return packed.join(places.select(F.col("gene_id").alias("feature_id"), "chrom", "gstart", "gend", "strand"), "feature_id")

    def skipped_features(self) -> DataFrame:
        """(feature_id, n, reason): features that no scan can fit."""
        out = self._packed().where(f"NOT {_VARYING}")
        return out.select("feature_id", "n", F.when(F.col("dof") < 1, "too few samples").otherwise("no variation beyond the covariates").alias("reason"))

    def skipped_variants(self) -> DataFrame:
        """(variant_id, n_called, reason): variants that no scan can fit."""
        mom = self.variant_moments().where(F.col("sg2") <= VARIES * F.col("ss"))
        return mom.select("variant_id", "n_called", F.lit("no variation beyond the covariates").alias("reason"))


#: Relative to the uncentred sum of squares: what is below is rounding.  One carrier among a hundred thousand million samples is above.
VARIES = 1e-12
_VARYING = "(sy2 > 1e-18D * ss AND dof >= 1)"
_SUMS = ["mean", "ss", "cs2", "c", "x", "above", "below"]


def _classes(g: pd.DataFrame, k: int) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray] | None]]:
    """Rows of the features that lack the same samples, with those samples, their covariates and the class's inverse (None if all are there)."""
    lacking, lacking_x, inverse = (g[c].to_numpy() if c in g.columns else None for c in ("miss", "miss_x", "inv"))
    for at in g.groupby("cls", sort=False).indices.values():
        miss = None if lacking is None else lacking[at[0]]
        if miss is None or not len(miss):
            yield at, None
            continue
        own_x = np.asarray(lacking_x[at[0]], float).reshape(len(miss), k)
        yield at, (np.asarray(miss, np.int64), own_x, np.asarray(inverse[at[0]], float).reshape(k, k))


class VariantSums:
    """Cohort sums of a block of variants, and what is left of them without some samples."""

    def __init__(self, v: pd.DataFrame, left: np.ndarray, n: int, k: int):
        self.left, self.there = left, dense(v["idx"], [np.ones(len(i)) for i in v["idx"]], n)
        wide = lambda name: np.array([np.asarray(r, float) for r in v[name]]).reshape(len(v), k)
        self.c, self.x = wide("c"), wide("x")
        self.mean, self.called, self.cs2 = v["mean"].to_numpy(float), v["n_called"].to_numpy(float), v["cs2"].to_numpy(float)
        self.ss = v["ss"].to_numpy(float)
        self.above, self.below = v["above"].to_numpy(float), v["below"].to_numpy(float)

    def without(self, miss: np.ndarray, own_x: np.ndarray, inverse: np.ndarray, rows: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, ...]:
        """(called, mean, sg2, scale, above, below, shift of the mean) of the variants ``rows`` on the other samples.

        What is left of cohort sums carries their rounding, so ``scale`` is the cohort's: a variant that is zero in all samples left has none.
        """
        out, dosage, mean = self.there[rows][:, miss], self.left[rows][:, miss], self.mean[rows]
        left = self.called[rows] - out.sum(axis=1)
        shift = np.divide(-dosage.sum(axis=1), left, out=np.zeros(len(left)), where=left > 0)
        ss = self.cs2[rows] - (dosage * dosage).sum(axis=1) - left * shift * shift
        cx = self.c[rows] - dosage @ own_x - shift[:, None] * (self.x[rows] - out @ own_x)
        raw = dosage + mean[:, None]
        above, below = ((out > 0) & (raw > 0.5)).sum(axis=1), ((out > 0) & (raw < 1.5)).sum(axis=1)
        sg2 = ss - ((cx @ inverse) * cx).sum(axis=1)
        return left, mean + shift, sg2, self.ss[rows], self.above[rows] - above, self.below[rows] - below, shift


class PairSums:
    """Sums of every variant x feature pair of a block, as arrays that broadcast to its shape.

    Where only the pairs ``near`` are wanted, a class with gaps is worked out for the variants near one of its features; the rest of its
    columns is not to be used.
    """

    def __init__(self, v: pd.DataFrame, g: pd.DataFrame, n: int, k: int, near: np.ndarray | None = None):
        self.left, self.right = dense(v["idx"], v["val"], n), dense(g["idx"], g["val"], n)
        self.num = self.left @ self.right.T
        self.dof, self.sy2, self.n = g["dof"].to_numpy()[None, :], g["sy2"].to_numpy()[None, :], g["n"].to_numpy()[None, :]
        column = lambda name: v[name].to_numpy(float)[:, None]
        self.called, self.mean, self.sg2, self.scale = column("n_called"), column("mean"), column("sg2"), column("ss")
        self.above, self.below = column("above"), column("below")
        self.shift = np.zeros_like(self.mean)
        self.classes: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(g)), None)]
        if "miss" in g.columns:
            self._reduce(v, g, n, k, near)

    def _reduce(self, v: pd.DataFrame, g: pd.DataFrame, n: int, k: int, near: np.ndarray | None) -> None:
        """Take the samples that a class of features lacks out of the variants' sums."""
        names = ["called", "mean", "sg2", "scale", "above", "below", "shift"]
        each = np.repeat(np.stack([getattr(self, name) for name in names]), len(g), axis=2)
        sums = VariantSums(v, self.left, n, k)
        self.there = sums.there
        seen = self.there @ self.right.T
        self.classes = []
        for at, gaps in _classes(g, k):
            if gaps is None:
                self.classes.append((at, None))
                continue
            rows = np.arange(len(v)) if near is None else np.flatnonzero(near[:, at].any(axis=1))
            cells = np.ix_(rows, at)
            own = np.stack(sums.without(*gaps, rows))
            each[:, cells[0], cells[1]] = own[:, :, None]
            self.num[cells] -= own[-1][:, None] * seen[cells]
            self.classes.append((at, np.delete(np.arange(n), gaps[0])))
        for name, value in zip(names, each):
            setattr(self, name, value)

    def usable(self, maf: float) -> np.ndarray:
        """Pairs whose variant varies on the feature's samples, and isn't rarer there than ``maf`` (up to rounding of the shifted mean)."""
        af = self.mean / 2
        return np.broadcast_to((self.sg2 > VARIES * self.scale) & (np.minimum(af, 1 - af) >= maf - 1e-12), self.num.shape)

    def centred(self, at: np.ndarray, samples: np.ndarray | None) -> np.ndarray:
        """Dosages centred over a class's samples, those samples only."""
        if samples is None:
            return self.left
        return self.left[:, samples] - self.shift[:, at[:1]] * self.there[:, samples]

    def rows(self, i: np.ndarray, j: np.ndarray) -> dict[str, np.ndarray]:
        """Statistics of the pairs (i, j)."""
        pick = lambda a: np.broadcast_to(a, self.num.shape)[i, j]
        mean, called, minor = pick(self.mean), pick(self.called), pick(self.mean) <= 1
        return {
            "af": mean / 2, "maf": np.minimum(mean / 2, 1 - mean / 2), "n": pick(self.n), "n_called": called.astype(np.int64),
            "ma_samples": np.where(minor, pick(self.above), pick(self.below)).astype(np.int64), "ma_count": called * np.where(minor, mean, 2 - mean),
            **_pair_stats(self.num[i, j], pick(self.sg2), pick(self.sy2), pick(self.dof)),
        }


def _pair_stats(num: np.ndarray, sg2: np.ndarray, sy2: np.ndarray, dof: np.ndarray | float) -> dict[str, np.ndarray]:
    slope = num / sg2
    with np.errstate(divide="ignore", invalid="ignore"):
        se = np.sqrt(np.maximum(sy2 - num * slope, 0.0) / dof / sg2)
        t = slope / se
    logp = t_log_p(t, dof)
    return {"beta": slope, "se": se, "t": t, "p_value": np.exp(logp), "log10p": -logp / np.log(10)}


_STATS = "beta double, se double, t double, p_value double, log10p double"


def cis_nominal(prep: Prepared, variants: DataFrame, genes: DataFrame, window: int = 1_000_000, maf: float = 0.0) -> DataFrame:
    """Every variant in the window of every feature: slope, se, t, p, frequencies, minor-allele samples and count, and distance.

    ``n``, the frequency and the counts are those of the samples that have the feature.
    """
    n, k = prep.n, prep.k

    def scan(v: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        pos = v["pos"].to_numpy()[:, None]
        near = (pos >= g["gstart"].to_numpy() - window) & (pos <= g["gend"].to_numpy() + window)
        sums = PairSums(v, g, n, k, near)
        i, j = np.nonzero(near & sums.usable(maf))
        vv, gg = v.iloc[i].reset_index(drop=True), g.iloc[j].reset_index(drop=True)
        tss = np.where(gg["strand"] == "+", gg["gstart"], gg["gend"])
        found = pd.DataFrame(sums.rows(i, j))
        ids = {"gene_id": gg["feature_id"], "variant_id": vv["variant_id"], "chrom": vv["chrom"], "pos": vv["pos"], "distance": vv["pos"] - tss}
        return pd.DataFrame(ids).join(found.drop(columns="n_called"))

    sides = window_sides(prep, variants, genes, window, maf, rows=1024)
    ids = f"gene_id {_kind(genes, 'gene_id')}, variant_id {_kind(variants, 'variant_id')}, chrom string, pos bigint, distance bigint"
    schema = f"{ids}, af double, maf double, n int, ma_samples bigint, ma_count double, {_STATS}"
    return scan_blocks(*sides, ["chrom", "_bin"], rows_per_block(n), scan, schema)


def window_sides(prep: Prepared, variants: DataFrame, genes: DataFrame, window: int, maf: float, rows: int = 256):
    """Packed rows keyed by position bin of about ``rows`` variants, and the narrow position tables that size the blocks.

    A place that is listed several times is one place, so a pair comes once and counts once.
    """
    variants = variants.select("variant_id", "chrom", "pos").distinct()
    genes = genes.select("gene_id", "chrom", "gstart", "gend", "strand").distinct()
    width = bin_width(variants, window, rows)
    v, g = variant_bins(variants, width), gene_bins(genes, window, width)
    return variant_bins(prep.variant_rows(variants, maf), width), gene_bins(prep.feature_rows(genes), window, width), v, g


def _kind(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


class TransSide:
    """Features of one turn as rows of unit length, a class with its own threshold at a time."""

    def __init__(self, g: pd.DataFrame, n: int, k: int, p: float):
        unit = dense(g["idx"], g["val"], n) / np.sqrt(g["sy2"].to_numpy())[:, None]
        self.at, self.sy2, self.dof = g["_at"].to_numpy(), g["sy2"].to_numpy(), g["dof"].to_numpy()
        cut = {dof: r_threshold(p, dof) ** 2 for dof in np.unique(self.dof)}
        self.classes = [(at, gaps, cut[self.dof[at[0]]], unit[at]) for at, gaps in _classes(g, k)]  # a class has one dof


def _trans_hits(v: pd.DataFrame, side: TransSide, n: int, k: int, maf: float) -> Iterator[pd.DataFrame]:
    """Hits of a slice of variants.  Each class needs one number per variant; a tile of pairs is one product and one comparison."""
    left = dense(v["idx"], v["val"], n)
    sums = VariantSums(v, left, n, k)
    cohort = sums.called, sums.mean, v["sg2"].to_numpy(float), v["ss"].to_numpy(float), sums.above, sums.below, np.zeros(len(v))
    names, chrom, pos = v["variant_id"].to_numpy(), v["chrom"].to_numpy(), v["pos"].to_numpy()
    found, rows = [], 0

    def frame(found: list) -> pd.DataFrame:
        i, j, num, sg2, freq = (np.concatenate(c) for c in zip(*found))
        ids = {"_at": side.at[j], "variant_id": names[i], "v_chrom": chrom[i], "pos": pos[i], "maf": freq}
        return pd.DataFrame({**ids, **_pair_stats(num, sg2, side.sy2[j], side.dof[j])})

    for at, gaps, cut, unit in side.classes:
        _, mean, sg2, scale, _, _, shift = cohort if gaps is None else sums.without(*gaps)
        freq = np.minimum(mean / 2, 1 - mean / 2)
        use = np.flatnonzero((sg2 > VARIES * scale) & (freq >= maf - 1e-12))
        centred = left[use] if gaps is None else left[use] - shift[use, None] * sums.there[use]
        size = np.sqrt(sg2[use])
        centred = centred / size[:, None]
        for first in range(0, len(at), TILE):
            r = centred @ unit[first : first + TILE].T
            flat = np.flatnonzero(np.abs(r) >= math.sqrt(cut) * (1 - 1e-9))
            if not len(flat):
                continue
            i, j = np.divmod(flat, r.shape[1])
            j = at[first + j]
            num = r.ravel()[flat] * size[i] * np.sqrt(side.sy2[j])
            keep = num * num >= cut * sg2[use[i]] * side.sy2[j]
            i, j, num = use[i[keep]], j[keep], num[keep]
            found.append((i, j, num, sg2[i], freq[i]))
            rows += len(i)
            if rows >= HITS:
                yield frame(found)
                found, rows = [], 0
    if rows:
        yield frame(found)


TILE = 256  # features beside a slice of variants: the tile's products stay in the processor's cache
HITS = 200_000  # rows of one batch of results


def trans_pairs(prep: Prepared, variants: DataFrame, genes: DataFrame, p: float = 1e-5, maf: float = 0.05) -> DataFrame:
    """All variant x feature pairs, but only hits at ``p`` leave a block.  Variants stay where they are, features come in turns.

    Hits grow with the pairs, so they aren't written here: the scan runs when the result is read.  Write it first if it is read more than once.
    """
    n, k = prep.n, prep.k
    schema = f"_at bigint, variant_id {_kind(variants, 'variant_id')}, v_chrom string, pos bigint, maf double, {_STATS}"
    tss = F.when(F.col("strand") == "+", F.col("gstart")).otherwise(F.col("gend"))
    about = [F.col("feature_id").alias("gene_id"), F.col("chrom").alias("g_chrom"), tss.alias("tss"), F.col("n").cast("int").alias("n")]
    out = in_turns(
        prep.variant_rows(variants, maf), prep.feature_rows(genes), n, k, lambda v, side: _trans_hits(v, side, n, k, maf), schema,
        prepare=lambda g: TransSide(g, n, k, p), about=about, keep=False,
    )
    return out.select("gene_id", "variant_id", "v_chrom", "pos", "g_chrom", "tss", "maf", "n", *[c.split()[0] for c in _STATS.split(", ")])


def trans_scan(
    prep: Prepared, variants: DataFrame, genes: DataFrame, p: float = 1e-5, maf: float = 0.05, cis_window: int = 5_000_000,
    lam: float | None = None,
) -> DataFrame:
    """Trans hits without cis pairs, with q-values."""
    return qvalues(materialize(drop_cis(trans_pairs(prep, variants, genes, p, maf), cis_window)), lam=lam)  # read several times


def _digamma(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digamma and trigamma for positive x by recurrence to 6 and the asymptotic series."""
    x = x.astype(float).copy()
    d, t = np.zeros_like(x), np.zeros_like(x)
    for _ in range(6):
        low = x < 6
        d -= np.where(low, 1 / x, 0)
        t += np.where(low, 1 / (x * x), 0)
        x = np.where(low, x + 1, x)
    i = 1 / (x * x)
    d += np.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i / 240)))
    t += 1 / x + i / 2 + i / x * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30)))
    return d, t


def fit_beta(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood beta shapes for each row of p-values: moment start, Newton steps."""
    p = np.clip(p, 1e-300, 1 - 1e-15)
    m, v = p.mean(axis=1), np.maximum(p.var(axis=1), 1e-12)
    s = np.maximum(m * (1 - m) / v - 1, 1e-2)
    a, b = np.maximum(m * s, 1e-2), np.maximum((1 - m) * s, 1e-2)
    la, lb = np.log(p).mean(axis=1), np.log1p(-p).mean(axis=1)
    for _ in range(50):
        (da, ta), (db, tb), (dc, tc) = _digamma(a), _digamma(b), _digamma(a + b)
        f, g = dc - da + la, dc - db + lb
        haa, hbb, hab = tc - ta, tc - tb, tc
        det = haa * hbb - hab * hab
        sa, sb = (f * hbb - g * hab) / det, (g * haa - f * hab) / det
        a, b = np.maximum(a - sa, a / 3), np.maximum(b - sb, b / 3)
        if np.all(np.abs(sa) < 1e-10 * a) and np.all(np.abs(sb) < 1e-10 * b):
            break
    return a, b


FINISH_ROWS = 256  # features whose permutations are judged at once: a batch of 10,000 would take gigabytes of temporaries


def _permutation_p(batches: Iterator[pd.DataFrame], permutations: int) -> Iterator[pd.DataFrame]:
    """p-values of the best variants against the largest |r| of each permutation, some features at a time."""
    p_of = lambda x, nu: t_p(x * np.sqrt(nu / (1 - x * x)), nu)
    for batch in batches:
        for at in range(0, len(batch), FINISH_ROWS):
            b = batch.iloc[at : at + FINISH_ROWS]
            null_r = np.stack(b["null"].to_list())
            r = np.minimum(np.abs(b["r"].to_numpy()), 1 - 1e-15)
            dof = b["dof"].to_numpy(float)
            p_nom = p_of(r, dof)
            a, c = fit_beta(p_of(np.minimum(null_r, 1 - 1e-12), dof[:, None]))
            yield b.drop(columns=["null", "dof"]).assign(
                p_value=p_nom, p_perm=(1 + (null_r >= r[:, None]).sum(axis=1)) / (1 + permutations),
                shape1=a, shape2=c, p_beta=betainc(a, c, p_nom),
            )


def cis_permutation(
    prep: Prepared, variants: DataFrame, genes: DataFrame, window: int = 1_000_000, permutations: int = 1000,
    seed: int = 12345, maf: float = 0.0,
) -> DataFrame:
    """Best variant per feature with empirical and beta-approximated p-values.

    Every block draws the same seeded permutations, returns only the largest |r| of each, and the
    maxima over a feature's blocks are an ordinary aggregate; a feature is never gathered whole.
    """
    n, k = prep.n, prep.k

    def scan(v: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        pos = v["pos"].to_numpy()
        near = (pos[:, None] >= g["gstart"].to_numpy() - window) & (pos[:, None] <= g["gend"].to_numpy() + window)
        sums = PairSums(v, g, n, k, near)
        near = near & sums.usable(maf)
        shape = sums.num.shape
        sg2, freq = np.broadcast_to(sums.sg2, shape), np.broadcast_to(np.minimum(sums.mean / 2, 1 - sums.mean / 2), shape)
        out, names = [], v["variant_id"].to_numpy()
        for at, samples in sums.classes:
            size = n if samples is None else len(samples)
            centred = sums.centred(at, samples)
            own = sums.right[at] if samples is None else sums.right[np.ix_(at, samples)]
            norm = np.sqrt(np.maximum(sg2[:, at[0]], np.finfo(float).tiny))
            left, right = centred / norm[:, None], own / np.sqrt(sums.sy2[0, at])[:, None]
            top = np.zeros((len(at), permutations))
            step = max(1, 2_000_000 // size)
            lists = [np.nonzero(near[:, f])[0] for f in at]
            for first in range(0, permutations, step):
                perm = np.stack([np.random.default_rng([seed, q]).permutation(size) for q in range(first, min(first + step, permutations))])
                for f, rows in enumerate(lists):
                    if len(rows):
                        top[f, first : first + len(perm)] = np.abs(left[rows] @ right[f][perm].T).max(axis=0)
            r = sums.num[:, at] / norm[:, None] / np.sqrt(sums.sy2[:, at])
            for f, (j, rows) in enumerate(zip(at, lists)):
                if len(rows):
                    b = rows[np.lexsort((names[rows], -np.abs(r[rows, f]).round(12)))[0]]
                    slope = sums.num[b, j] / sg2[b, j]
                    out.append((g["feature_id"].iloc[j], names[b], pos[b], freq[b, j], r[b, f], slope, len(rows), sums.dof[0, j], top[f]))
        return pd.DataFrame(out, columns=["gene_id", "variant_id", "pos", "maf", "r", "beta", "n_variants", "dof", "top"])

    sides = window_sides(prep, variants, genes, window, maf)
    ids = f"gene_id {_kind(genes, 'gene_id')}, variant_id {_kind(variants, 'variant_id')}, pos bigint"
    blocks = materialize(scan_blocks(  # read by both aggregates below
        *sides, ["chrom", "_bin"], rows_per_block(n), scan,
        f"{ids}, maf double, r double, beta double, n_variants bigint, dof double, top array<double>",
    ))
    order = F.struct(F.round(-F.abs("r"), 12), "variant_id")
    best = blocks.groupBy("gene_id").agg(
        F.min_by(F.struct("variant_id", "pos", "maf", "r", "beta"), order).alias("b"), F.sum("n_variants").alias("n_variants"),
        F.max("dof").alias("dof"),
    )
    null = blocks.select("gene_id", F.posexplode("top").alias("perm", "m")).groupBy("gene_id", "perm").agg(F.max("m").alias("m"))
    null = null.groupBy("gene_id").agg(F.collect_list("m").alias("null"))  # one number per permutation

    joined = best.select("gene_id", "b.*", "n_variants", "dof").join(null, "gene_id")
    schema = f"{ids}, maf double, r double, beta double, n_variants bigint, p_value double, p_perm double, shape1 double, shape2 double, p_beta double"
    return joined.mapInPandas(lambda batches: _permutation_p(batches, permutations), schema)


def cis_map(prep: Prepared, variants: DataFrame, genes: DataFrame, lam: float | None = None, **kw) -> DataFrame:
    """Permutation scan with q-values on the beta-approximated p."""
    return qvalues(materialize(cis_permutation(prep, variants, genes, **kw)), "p_beta", lam)


def by_type(scans: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """One table of results over (qtl_type, mode)."""
    tagged = {f"{q}|{m}": d for (q, m), d in scans.items()}
    out = tagged_union(tagged, "_tag")
    return out.withColumns({"qtl_type": F.split_part("_tag", F.lit("|"), F.lit(1)), "mode": F.split_part("_tag", F.lit("|"), F.lit(2))}).drop("_tag")


def scan_types(
    geno: DataFrame, phenotypes: Mapping[str, DataFrame], variants: DataFrame, genes: DataFrame, cov: DataFrame | None = None,
    modes: Sequence[str] = ("cis", "trans"), window: int = 1_000_000, maf: float = 0.0, p: float = 1e-5, cis_window: int = 5_000_000,
) -> dict[str, DataFrame]:
    """Scans of several phenotype matrices, as (qtl_type, gene_id, ...) for each mode.

    The matrices are one right side: their features are told apart by type, and a matrix without some of the samples is a matter of
    missing patterns.  So genotypes are read and packed once for all types and modes.
    """
    key = lambda kind, column: F.struct(F.lit(kind).alias("qtl_type"), F.col(column).alias("id"))
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    pheno = union([d.select(key(kind, "feature_id").alias("feature_id"), "sample_id", "value") for kind, d in phenotypes.items()])
    places = union([genes.withColumn("gene_id", key(kind, "gene_id")) for kind in phenotypes])
    prep = Prepared(geno, pheno, cov, fill_nulls=False).pack()
    scans = {
        "cis": lambda: cis_nominal(prep, variants, places, window, maf),
        "trans": lambda: drop_cis(trans_pairs(prep, variants, places, p, maf), cis_window),
    }
    return {m: scans[m]().withColumn("qtl_type", F.col("gene_id.qtl_type")).withColumn("gene_id", F.col("gene_id.id")) for m in modes}


def linear_gwas(
    geno: DataFrame, traits: DataFrame, cov: DataFrame | None = None, maf: float = 0.0, missing: float = 1.0, hwe: float = 0.0
) -> DataFrame:
    """Trait ~ dosage + covariates for every variant and trait with 95% limits.

    All traits share one pass over the genotypes.  A trait with missing samples is fitted on those that have it, with its own degrees of
    freedom.  ``maf`` is the smallest frequency among them; ``missing`` and ``hwe`` filter variants over the cohort.
    """
    known = traits.where(F.col("value").isNotNull()).withColumnRenamed("trait", "feature_id")
    prep = Prepared(geno, known, cov)
    n, k, z = prep.n, prep.k, float(norm_ppf(0.975))

    def scan(v: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        sums = PairSums(v, g, n, k)
        i, j = np.nonzero(sums.usable(maf))
        out = pd.DataFrame({"phenotype": g["feature_id"].to_numpy()[j], "variant_id": v["variant_id"].to_numpy()[i], **sums.rows(i, j)})
        out["ci_low"], out["ci_high"] = out["beta"] - z * out["se"], out["beta"] + z * out["se"]
        return out.drop(columns=["n", "ma_samples", "ma_count", "log10p"])

    ids = f"phenotype {_kind(traits, 'trait')}, variant_id {_kind(geno, 'variant_id')}"
    schema = f"{ids}, af double, maf double, n_called bigint, beta double, se double, t double, p_value double, ci_low double, ci_high double"
    out = in_turns(prep.variant_rows(None, maf, missing, hwe), prep.feature_rows(), n, k, scan, schema)
    return out.select("phenotype", "variant_id", "n_called", "af", "maf", "beta", "se", "t", "p_value", "ci_low", "ci_high")


def logistic_gwas(geno: DataFrame, trait: DataFrame, cov: DataFrame | None = None, maf: float = 0.0, steps: int = 25) -> DataFrame:
    """Binary trait (0/1) ~ dosage + covariates by Newton's method, a block of variants at a time.

    The per-sample design travels to each block through the shuffle, so nothing is broadcast.
    """
    y = trait.where(F.col("value").isNotNull()).select(F.lit("y").alias("feature_id"), "sample_id", F.col("value").cast("double").alias("value"))
    prep = Prepared(geno, y, cov)
    n = prep.n
    case = y.withColumn("sample_id", F.trim(F.col("sample_id").cast("string"))).select("sample_id", F.col("value").alias("y"))
    samples = prep.samples.join(case, "sample_id")
    x = F.col("xc") if prep.k else F.array().cast("array<double>")
    table = samples.agg(F.array_sort(F.collect_list(F.struct("idx", "y", x.alias("x")))).alias("_s"))  # cohort x covariates
    places = geno.select("variant_id").distinct().withColumns({"chrom": F.lit(""), "pos": F.lit(0).cast("bigint")})
    v = prep.variant_rows(places, maf)
    size = rows_per_block(n)
    blocks = columns_of(places.agg(F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(1)).cast("int").alias("_nb")))[0]
    left = v.select("variant_id", "idx", "val", "af", "n_called", F.pmod(F.xxhash64("variant_id"), blocks).cast("int").alias("_b"))
    right = table.select(F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_b"), "_s")

    def fit(g: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(g) or not len(d):
            return pd.DataFrame()
        rows = d["_s"].iloc[0]
        yv = np.array([r["y"] for r in rows], dtype=float)
        cols = np.array([np.asarray(r["x"], dtype=float) for r in rows]).reshape(len(yv), -1)
        gd = dense(g["idx"], g["val"], n)
        fixed = np.column_stack([np.ones(len(yv)), cols])
        z = np.concatenate([gd[:, :, None], np.broadcast_to(fixed, (len(g), *fixed.shape))], axis=2)
        b = np.zeros((len(g), z.shape[2]))
        h = np.zeros((len(g), z.shape[2], z.shape[2]))
        done = np.zeros(len(g), dtype=bool)
        ridge = 1e-12 * np.eye(z.shape[2])
        for _ in range(steps):
            mu = 1 / (1 + np.exp(-np.clip(np.einsum("vnp,vp->vn", z, b), -30, 30)))
            h = np.einsum("vnp,vn,vnq->vpq", z, mu * (1 - mu), z) + ridge
            move = np.linalg.solve(h, np.einsum("vnp,vn->vp", z, yv - mu)[:, :, None])[:, :, 0]
            b = b + np.clip(move, -5, 5)
            done = np.abs(move).max(axis=1) < 1e-8
            if done.all():
                break
        se = np.sqrt(np.maximum(np.linalg.inv(h)[:, 0, 0], 0))
        zs = b[:, 0] / se
        p = np.array([math.erfc(abs(q) / math.sqrt(2)) for q in zs])
        w = norm_ppf(0.975) * se
        limit = lambda e: np.exp(np.clip(e, -700, 700))
        return pd.DataFrame({
            "variant_id": g["variant_id"].to_numpy(), "n_called": g["n_called"].to_numpy(), "af": g["af"].to_numpy(), "beta": b[:, 0],
            "se": se, "z": zs, "p_value": p, "or_low": limit(b[:, 0] - w), "or_high": limit(b[:, 0] + w), "converged": done,
        })

    schema = (
        f"variant_id {_kind(geno, 'variant_id')}, n_called bigint, af double, beta double, se double, z double, p_value double, "
        "or_low double, or_high double, converged boolean"
    )
    return spread(left, "_b").groupBy("_b").cogroup(spread(right, "_b").groupBy("_b")).applyInPandas(fit, schema)


def null_logistic(samples: DataFrame, k: int, steps: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of y ~ 1 + covariates and the inverse information, by Newton's method: one small aggregate per step.

    ``samples`` has ``y`` (0/1) and ``xc`` (k covariates, centred).
    """
    z = [F.lit(1.0), *[F.element_at("xc", i + 1) for i in range(k)]]
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    b = np.zeros(k + 1)
    for _ in range(steps):
        mu = logistic_mean(b)
        row = samples.agg(*[F.sum((F.col("y") - mu) * c) for c in z], *[F.sum(mu * (1 - mu) * z[i] * z[j]) for i, j in pairs]).first()
        slope, info = np.array(row[: k + 1], float), np.zeros((k + 1, k + 1))
        for (i, j), v in zip(pairs, row[k + 1 :]):
            info[i, j] = info[j, i] = v
        inverse = np.linalg.pinv(info, rcond=1e-12, hermitian=True)
        move = np.clip(inverse @ slope, -5, 5)
        b = b + move
        if np.abs(move).max() < 1e-12:
            break
    return b, inverse


def logistic_mean(b: np.ndarray) -> Column:
    eta = F.lit(float(b[0]))
    for i, v in enumerate(b[1:]):
        eta = eta + F.element_at("xc", i + 1) * float(v)
    return 1 / (1 + F.exp(-F.least(F.greatest(eta, F.lit(-30.0)), F.lit(30.0))))


def _cases(geno: DataFrame, trait: DataFrame, cov: DataFrame | None) -> tuple[Prepared, DataFrame]:
    y = trait.where(F.col("value").isNotNull()).select(F.lit("y").alias("feature_id"), "sample_id", F.col("value").cast("double").alias("value"))
    prep = Prepared(geno, y, cov)
    case = y.withColumn("sample_id", F.trim(F.col("sample_id").cast("string"))).select("sample_id", F.col("value").alias("y"))
    return prep, materialize(prep.samples.join(case, "sample_id"))


def logistic_score(geno: DataFrame, trait: DataFrame, cov: DataFrame | None = None, maf: float = 0.0, refine: float = 0.0, steps: int = 25) -> DataFrame:
    """Score test of every variant for a binary trait (0/1) given covariates; variants with p up to ``refine`` are fitted as well.

    The null model is fitted once.  Each variant then needs sums over its called samples only, from one join with the sample table and one
    aggregation: nothing is packed, and no task holds a cohort.  Where the score p is small enough to matter, the full model is fitted by
    Newton's method; only those variants are packed, each row with its own samples' design, so memory doesn't depend on how many others
    there are.  ``beta`` and ``se`` are those of the fit, or without one the one-step estimates of the score.
    """
    prep, samples = _cases(geno, trait, cov)
    k, n = prep.k, prep.n
    b, inverse = null_logistic(samples, k)
    mu = logistic_mean(b)
    rows = prep.geno.join(samples.select("sample_id", "xc", (F.col("y") - mu).alias("r"), (mu * (1 - mu)).alias("w")), "sample_id")
    g, w, r = F.col("dosage"), F.col("w"), F.col("r")
    z = [F.lit(1.0), *[F.element_at("xc", i + 1) for i in range(k)]]
    sums = rows.groupBy("variant_id").agg(
        F.count(g).alias("n_called"), F.avg(g).alias("m"), F.sum(g * g).alias("ss"), F.sum(g * r).alias("gr"), F.sum(r).alias("sr"),
        F.sum(w * g * g).alias("wgg"), F.array(*[F.sum(w * g * c) for c in z]).alias("wgz"), F.array(*[F.sum(w * c) for c in z]).alias("wz"),
    )
    m = F.col("m")  # a missing call sits at the variant's mean and has no part
    cross = F.zip_with("wgz", "wz", lambda x, y: x - m * y)
    sums = sums.withColumn("c", cross).withColumn("u", F.col("gr") - m * F.col("sr"))
    whole = F.col("wgg") - 2 * m * F.element_at("wgz", 1) + m * m * F.element_at("wz", 1)
    sums = sums.withColumn("v", whole - dot(F.transform(matrix_lit(inverse), lambda x: dot(x, F.col("c"))), F.col("c")))
    sums = sums.withColumn("maf", F.least(m / 2, 1 - m / 2)).where((F.col("v") > VARIES * F.col("ss")) & (F.col("maf") >= maf))
    sums = sums.select("variant_id", "n_called", (m / 2).alias("af"), "maf", "u", "v", (F.col("u") / F.sqrt("v")).alias("z_score"))
    scored = sums.withColumn("p_score", norm_p_udf("z_score"))
    if refine <= 0:
        return scored.select("variant_id", "n_called", "af", "maf", "z_score", "p_score", (F.col("u") / F.col("v")).alias("beta"), (1 / F.sqrt("v")).alias("se"), F.lit(None).cast("boolean").alias("converged"))
    scored = materialize(scored)
    picked = scored.where(F.col("p_score") <= refine).select("variant_id", (2 * F.col("af")).alias("m"))
    every = picked.select("variant_id", "m", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("idx")).join(samples.select("idx", "sample_id", "y", "xc"), "idx")
    cells = every.join(prep.geno.select("variant_id", "sample_id", "dosage"), ["variant_id", "sample_id"], "left")
    cell = F.struct((F.coalesce("dosage", "m") - F.col("m")).alias("g"), "y", "xc")
    packed = cells.groupBy("variant_id").agg(F.collect_list(cell).alias("s")).select("variant_id", F.col("s.g").alias("g"), F.col("s.y").alias("y"), F.flatten(F.col("s.xc")).alias("x"))

    def fit(batches):
        for batch in batches:
            out = []
            for name, gv, yv, x in zip(batch["variant_id"], batch["g"], batch["y"], batch["x"]):
                design = np.column_stack([np.asarray(gv, float), np.ones(len(gv)), np.asarray(x, float).reshape(len(gv), k)])
                at, done = np.zeros(k + 2), False
                for _ in range(steps):
                    p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
                    cover = np.linalg.pinv(design.T @ (design * (p * (1 - p))[:, None]), hermitian=True)
                    move = cover @ (design.T @ (np.asarray(yv, float) - p))
                    at = at + np.clip(move, -5, 5)
                    done = bool(np.abs(move).max() < 1e-8)
                    if done:
                        break
                out.append((name, at[0], math.sqrt(max(cover[0, 0], 0.0)), done))
            yield pd.DataFrame(out, columns=["variant_id", "b", "s", "converged"])

    fits = packed.mapInPandas(fit, f"variant_id {_kind(geno, 'variant_id')}, b double, s double, converged boolean")
    joined = scored.join(fits, "variant_id", "left")
    return joined.select("variant_id", "n_called", "af", "maf", "z_score", "p_score", F.coalesce("b", F.col("u") / F.col("v")).alias("beta"), F.coalesce("s", 1 / F.sqrt("v")).alias("se"), "converged")


def gwas_inputs(geno: DataFrame, traits: DataFrame, names: Sequence[str], cov: DataFrame | None = None) -> DataFrame:
    """Aligned samples, outliers removed trait by trait, one row per sample."""
    tables = [geno, traits] + ([cov] if cov is not None else [])
    kept = remove_trait_outliers(align_samples(*tables)[1], names)
    return kept.groupBy("sample_id").pivot("trait", list(names)).agg(F.first("value"))
