"""Scalar clean-up, renaming and flag columns."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted spellings of each result column, first present wins.
ALIASES: dict[str, tuple[str, ...]] = {
    "chromosome": ("chromosome", "CHR", "chr", "CHROM", "chrom"),
    "position": ("position", "BP", "bp", "pos", "POS"),
    "p_value": ("p_value", "P", "pval", "pvalue", "P-value", "P_value", "p"),
    "beta": ("beta", "BETA", "Effect", "OR"),
    "maf": ("maf", "MAF", "FRQ", "Freq"),
    "info": ("info", "INFO", "Rsq"),
}

# Target names of summary-statistic columns.
SUMSTAT_NAMES = {
    "CHROM": "chromosome",
    "POS": "position",
    "SNP": "variant_id",
    "A1": "effect_allele",
    "A2": "other_allele",
    "BETA": "beta",
    "SE": "standard_error",
    "P": "p_value",
}

# Analysis type and the data it maps.
QTL_DATA_TYPES = {"eqtl": "expression", "pqtl": "protein", "sqtl": "splicing"}

GENOME_WIDE, TRANS_WIDE, SUGGESTIVE = 5e-8, 1e-10, 1e-5


def sample_key(c: Column, prefix_only: bool = True) -> Column:
    """Trim, drop every ``.0``, optionally keep the part before the first underscore."""
    c = F.replace(F.trim(c.cast("string")), F.lit(".0"), F.lit(""))
    return F.split_part(c, F.lit("_"), F.lit(1)) if prefix_only else c


def strip_version(c: Column) -> Column:
    return F.regexp_replace(c, r"\.\d+$", "")


def to_count(value: Column, add: float = 0.0) -> Column:
    return F.bround(value + F.lit(add), 0).cast("bigint")


def to_number(c: Column) -> Column:
    """Cast to double, bad text and NaN to null."""
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def coercion_loss(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cells per column that hold text but no number."""
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in cols]
    return df.agg(*lost).unpivot([], list(cols), "column_name", "n_lost")


def harmonise(df: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Add the canonical columns from the first alias present; originals stay."""
    add = {}
    for target, names in aliases.items():
        found = next((n for n in names if n in df.columns), None)
        if found and target not in df.columns:
            add[target] = F.col(f"`{found}`")
    return df.withColumns(add)


def standardise_sumstats(df: DataFrame) -> DataFrame:
    out = df.withColumnsRenamed({k: v for k, v in SUMSTAT_NAMES.items() if k in df.columns})
    return out.withColumn("z_score", F.try_divide("beta", "standard_error"))


def locus_from_id(df: DataFrame, column: str = "variant_id") -> DataFrame:
    """Chromosome and position from ids such as ``chr1_500_A_G``.

    A separator counts only if every id contains it, which one aggregate decides.
    """
    c = F.col(column)
    probe = df.agg(
        F.when(F.bool_and(F.contains(c, F.lit("_"))), "_").when(F.bool_and(F.contains(c, F.lit(":"))), ":").alias("s")
    )
    sep = probe.scalar()
    out = df.withColumn("_sep", sep)
    return out.select(
        *df.columns,
        F.expr(f"replace(split_part({column}, _sep, 1), 'chr', '')").alias("chromosome"),
        F.expr(f"try_cast(split_part({column}, _sep, 2) AS BIGINT)").alias("position"),
    )


def neg_log10(p: Column) -> Column:
    """-log10 p; p = 0 maps to infinity and p < 0 to NaN instead of null."""
    return F.when(p == 0, float("inf")).when(p < 0, float("nan")).otherwise(-F.log10(p))


def signed_significance(p: Column, beta: Column) -> Column:
    return neg_log10(p) * F.signum(beta)


def volcano_class(p: Column, beta: Column) -> Column:
    size = F.abs(beta)
    return (
        F.when((p < 1e-8) & (size > 0.2), "high").when((p < 0.05) & (size > 0.1), "medium").otherwise("none")
    )


def placeholder(c: Column, default: float) -> Column:
    """A lone dot means ``default``; other text is parsed."""
    return F.when(c == ".", F.lit(default)).otherwise(c.try_cast("double"))


def data_type_of(qtl_type: Column) -> Column:
    pairs = [F.lit(x) for kv in QTL_DATA_TYPES.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.lower(qtl_type))


def qtl_type_of(data_type: Column) -> Column:
    pairs = [F.lit(x) for k, v in QTL_DATA_TYPES.items() for x in (v, k)]
    return F.element_at(F.create_map(*pairs), F.lower(data_type))


def chrom_name(c: Column, style: str = "auto") -> Column:
    """``chr`` adds the prefix, ``none`` removes it, ``auto`` adds it only where absent."""
    if style == "none":
        return F.regexp_replace(c, "^chr", "")
    return F.when(F.startswith(c, F.lit("chr")), c).otherwise(F.concat(F.lit("chr"), c))


def split_multiallelic(df: DataFrame, first_only: bool = False) -> DataFrame:
    """One row per ALT; genotype alleles become 1 for that ALT, 0 for any other, dots stay."""
    out = df.select(*[c for c in df.columns if c != "alt"], F.posexplode(F.split("alt", ",")).alias("alt_index", "alt"))
    if first_only:
        out = out.where(F.col("alt_index") == 0)
    if "gt" in df.columns:
        this = (F.col("alt_index") + 1).cast("string")
        recode = lambda a: F.when(a == ".", a).when(a == this, "1").otherwise("0")
        joined = F.array_join(F.transform(F.split("gt", r"[|/]"), recode), "/")
        phased = F.array_join(F.transform(F.split("gt", r"[|/]"), recode), "|")
        out = out.withColumn("gt", F.when(F.contains("gt", F.lit("|")), phased).otherwise(joined))
    return out


def unphase(gt: Column) -> Column:
    return F.replace(gt, F.lit("|"), F.lit("/"))


def called(gt: Column) -> Column:
    return gt.isNotNull() & ~F.contains(gt, F.lit("."))


def drop_uncalled_sites(df: DataFrame, keys: Sequence[str] = ("variant_id",)) -> DataFrame:
    """Drop variants in which no sample has a call."""
    seen = df.groupBy(*keys).agg(F.count_if(called(F.col("gt"))).alias("_n")).where("_n > 0").drop("_n")
    return df.join(seen, list(keys), "left_semi")


def hover_text(r2: str | None = None) -> Column:
    """Label lines joined by ``<br>``; missing statistics are left out.  ``r2`` may name a column with the linkage to the lead variant."""

    def part(label: str, fmt: str, name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.format_string(f"{label}: {fmt}", F.col(name)))

    return F.concat_ws(
        "<br>",
        F.concat(F.lit("Variant: "), F.col("variant_id").cast("string")),
        F.concat(F.lit("Position: "), F.format_number("position", 0)),
        part("P-value", "%.2e", "p_value"),
        part("-log10(p)", "%.2f", "log10p"),
        part("Beta", "%.3f", "beta"),
        part("SE", "%.3f", "se"),
        part("MAF", "%.3f", "maf"),
        *([part("R²", "%.3f", r2)] if r2 else []),
    )


def significance(p: Column, mode: Column) -> Column:
    cut = F.when(mode == "trans", TRANS_WIDE).otherwise(GENOME_WIDE)
    return F.when(p <= cut, "significant").when(p <= SUGGESTIVE, "suggestive").otherwise("none")
