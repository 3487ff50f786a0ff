"""Order-dependent building blocks that stay balanced when one group is huge.

A plain ``Window.partitionBy(gene).orderBy(p)`` sends a whole gene to one task, and
``percentile`` keeps every distinct value of a group in one hash map.  The operators here
give the same answers with work split by value range instead of by group.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespark.session import materialize


def with_group_stats(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Attach per-group aggregates to every row.

    Partial aggregation shrinks each group before its shuffle; the join back can be broadcast
    by size or split by the adaptive skew join, which a window cannot.
    """
    if not keys:
        return df.select("*", *scalars(df, *aggs))
    stats = df.groupBy(*keys).agg(*aggs)
    return df.join(stats, list(keys))


def scalars(df: DataFrame, *aggs: Column) -> list[Column]:
    """Whole-table aggregates as scalar-subquery columns (no join in the plan)."""
    return columns_of(df.agg(*aggs))


def columns_of(row: DataFrame) -> list[Column]:
    """Columns of a one-row frame for use in other frames; the row is computed once and shared."""
    whole = row.select(F.struct("*").alias("_r")).scalar()
    return [whole.getField(name).alias(name) for name in row.columns]


def one_row(*rows: DataFrame) -> DataFrame:
    """Put several one-row frames side by side."""
    spark = rows[0].sparkSession
    return spark.range(1).select(*[c for r in rows for c in columns_of(r)])


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column] | None = None,
    rank: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add the row number in ``order`` within ``keys`` and exclusive running sums.

    Rows are range-partitioned on (keys, order), so a hot group or a run of equal values is
    cut across tasks (give ``order`` a unique last column).  The partition number is fixed by
    a reliable checkpoint; per-partition totals then give each piece its offset.
    """
    sums = dict(sums or {})
    keys = list(keys)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_o{i}" for i in range(len(order))]
    flat = df.select("*", *[c.alias(a) for c, a in zip(sums.values(), [f"_s{i}" for i in range(len(sums))])])
    ranged = flat.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    cut = materialize(ranged.withColumn("_piece", F.spark_partition_id()))
    slots = [f"_s{i}" for i in range(len(sums))]
    totals = cut.groupBy("_piece", *keys).agg(
        F.count(F.lit(1)).alias("_cnt"), *[F.sum(s).alias(f"_t{s}") for s in slots]
    )
    # one row per (group, piece): at most `n` rows in any one group
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_piece",
        *keys,
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        *[F.coalesce(F.sum(f"_t{s}").over(before), F.lit(0.0)).alias(f"_off{s}") for s in slots],
    )
    local = Window.partitionBy("_piece", *keys).orderBy(*order)
    prior = local.rowsBetween(Window.unboundedPreceding, -1)
    inner = cut.select(
        "*",
        F.row_number().over(local).alias("_rn"),
        *[F.coalesce(F.sum(s).over(prior), F.lit(0.0)).alias(f"_run{s}") for s in slots],
    )
    out = inner.join(offsets, ["_piece", *keys])
    return out.select(
        *df.columns,
        (F.col("_rn") + F.col("_off")).alias(rank),
        *[(F.col(f"_run{s}") + F.col(f"_off{s}")).alias(name) for s, name in zip(slots, sums)],
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    transform: Callable[[Column], Column] | None = None,
    small: int = 1_000_000,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, in bounded state at any group size.

    If a count shows that no group holds more than ``small`` values, the built-in exact aggregate
    is used.  Otherwise a mergeable sketch brackets each quantile, a second pass narrows the
    bracket, and a third counts the values below it and keeps, by distinct value, only those
    inside (under a hundred-thousandth of a large group).  A monotone ``transform`` is applied to
    the order statistics before interpolation.  Returns one row per group with ``n`` and one
    column per entry of ``probs``.
    """
    keys, v = list(keys), F.col("_v")
    base = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    base = base.select(*keys, F.col(value).cast("double").alias("_v"))
    largest = base.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= small:
        return _small_quantiles(base, keys, probs, transform)
    names, qs = list(probs), [float(q) for q in probs.values()]
    k = len(qs)
    slack = 3.0 / accuracy
    cuts = [max(q - slack, 0.0) for q in qs] + [min(q + slack, 1.0) for q in qs]
    tight = F.col("_n") <= accuracy  # groups this small survive whole
    ends = [(f"_lo{i}", f"_hi{i}") for i in range(k)]
    br = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", cuts, accuracy).alias("_b"))
    br = br.select(*keys, "_n", *[
        F.when(tight | F.lit(open_), float("-inf") if side == 0 else float("inf")).otherwise(F.col("_b")[side * k + i]).alias(ends[i][side])
        for i, q in enumerate(qs) for side, open_ in ((0, q - slack <= 0), (1, q + slack >= 1))
    ])
    br = materialize(br)
    inside = [v.between(F.col(lo), F.col(hi)) for lo, hi in ends]
    target = [(F.col("_n") - 1) * F.lit(q) for q in qs]

    # narrow: an even grid of the values inside each bracket, then the cells around the target
    steps = 256
    grid = [j / steps for j in range(steps + 1)]
    got = _attach(base, br, keys).groupBy(*keys, "_n", *[e for pair in ends for e in pair]).agg(*[
        a for i in range(k) for a in (
            F.count_if(v < F.col(ends[i][0])).alias(f"_u{i}"), F.count_if(inside[i]).alias(f"_m{i}"),
            F.percentile_approx(F.when(inside[i], v), grid, accuracy).alias(f"_g{i}"),
        )
    ])
    cols = []
    for i, (lo, hi) in enumerate(ends):
        at = (target[i] - F.col(f"_u{i}")) / F.greatest(F.col(f"_m{i}") - 1, F.lit(1)) * steps
        first, last = (F.floor(at) - 2).cast("int"), (F.ceil(at) + 2).cast("int")
        wide = F.col(f"_m{i}") > accuracy
        cols.append(F.when(wide & (first > 0), F.get(F.col(f"_g{i}"), first)).otherwise(F.col(lo)).alias(lo))
        cols.append(F.when(wide & (last < steps), F.get(F.col(f"_g{i}"), last)).otherwise(F.col(hi)).alias(hi))
    br = materialize(got.select(*keys, "_n", *cols))

    anyin = inside[0]
    for c in inside[1:]:
        anyin = anyin | c
    vals = _attach(base, br, keys).groupBy(*keys, "_n", *[e for pair in ends for e in pair], F.when(anyin, v).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), *[F.count_if(v < F.col(lo)).alias(f"_u{i}") for i, (lo, _) in enumerate(ends)]
    )
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(v.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    run = vals.select("*", *[
        (F.sum(f"_u{i}").over(whole) + F.sum(F.when(inside[i], F.col("_c")).otherwise(0)).over(upto)).alias(f"_cum{i}") for i in range(k)
    ])
    hit = lambda i, edge: F.min(F.when(inside[i] & (F.col(f"_cum{i}") > edge), v))
    res = run.groupBy(*keys, "_n").agg(*[
        a for i in range(k) for a in (hit(i, F.floor(target[i])).alias(f"_a{i}"), hit(i, F.ceil(target[i])).alias(f"_z{i}"))
    ])
    f = transform or (lambda c: c)
    between = lambda i: f(F.col(f"_a{i}")) + (f(F.col(f"_z{i}")) - f(F.col(f"_a{i}"))) * (target[i] - F.floor(target[i]))
    return res.select(*keys, F.col("_n").alias("n"), *[between(i).alias(name) for i, name in enumerate(names)])


def _attach(base: DataFrame, br: DataFrame, keys: list[str]) -> DataFrame:
    """Bracket columns on every row: by key, or from the single row of a keyless bracket."""
    return base.join(br, keys) if keys else base.select("*", *columns_of(br))


def _small_quantiles(base: DataFrame, keys: list[str], probs: Mapping[str, float], transform) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    if transform is None:
        return base.groupBy(*keys).agg(count, *[F.percentile("_v", float(q)).alias(name) for name, q in probs.items()])
    got = base.groupBy(*keys).agg(count, F.array_sort(F.collect_list("_v")).alias("_all"))

    def at(q: float) -> Column:
        pos = (F.col("n") - 1) * F.lit(float(q))
        a = transform(F.get("_all", F.floor(pos).cast("int")))
        z = transform(F.get("_all", F.ceil(pos).cast("int")))
        return a + (z - a) * (pos - F.floor(pos))

    return got.select(*keys, "n", *[at(q).alias(name) for name, q in probs.items()])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per group; the rank filter runs before the shuffle as well as after."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")
