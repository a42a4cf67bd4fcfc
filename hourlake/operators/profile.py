"""Profiling statistics.

Each statistic is one aggregation pass with partial aggregation; results
with one row per column are produced by unpivoting the one-row aggregate
(``stack``), never by looping over columns with one job each.

Exact quantiles come from ranks over range partitioned value counts
(``operators/quantiles.py``): no task holds the values of a column or group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.functions import columns as X
from hourlake.operators import quantiles as Q
from hourlake.session import cut_lineage

# ---- fixed values ---------------------------------------------------------
HIST_BINS = 30
IQR_FACTOR = 1.5
WINSOR_LIMIT = 0.01
QUARTILES = (0.25, 0.5, 0.75)
# Range of the random keys that rows draw.
KEY_RANGE = 1 << 52


def ratio(part, total, scale: int = 6) -> F.Column:
    """part / total rounded half-up at ``scale`` (exact decimal), double."""
    q = X.c(part).cast("decimal(20,0)") / X.c(total).cast("decimal(20,0)")
    return F.round(q, scale).cast("double")


def _unpivot(one_row: DataFrame, names, stats) -> DataFrame:
    """Turn ``{col}__{stat}`` columns of a one-row frame into one row per
    column."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts += [f"`{n}__{s}`" for s in stats]
    cols = ", ".join(["column"] + list(stats))
    return one_row.selectExpr(f"stack({len(names)}, {', '.join(parts)}) AS ({cols})")


def describe(df: DataFrame, cols, digits: int = 6, decimal_scale: int | None = None) -> DataFrame:
    """Count, mean, median, std, min, Q1, Q3, max, sum per column; the
    quartiles come from ranks (``quantiles``), the rest is one aggregation.

    With ``decimal_scale`` (values known to that many decimals, e.g. prices
    in cents) mean and sum are exact decimal aggregates."""
    aggs = []
    for c_ in cols:
        x = F.col(c_).cast("double")
        if decimal_scale is not None:
            d = F.col(c_).cast(f"decimal(18,{decimal_scale})")
            mean, total = X.decimal_mean(d, digits), F.sum(d).cast("double")
        else:
            mean, total = F.round(F.avg(x), digits), F.round(F.sum(x), digits)
        aggs += [F.count(x).alias(f"{c_}__count"),
                 mean.alias(f"{c_}__mean"),
                 F.round(F.stddev_samp(x), digits).alias(f"{c_}__std"),
                 F.min(x).alias(f"{c_}__min"), F.max(x).alias(f"{c_}__max"),
                 total.alias(f"{c_}__sum")]
    stats = _unpivot(df.agg(*aggs), cols, ("count", "mean", "std", "min", "max", "sum"))
    names = ("q1", "median", "q3")
    ranks = Q.quantiles(df, cols, dict(zip(names, QUARTILES))).select("column", *[F.round(n, digits).alias(n) for n in names])
    return stats.join(ranks, "column", "left").select("column", "count", "mean", "median", "std", "min", "q1", "q3", "max", "sum")


def null_rates(df: DataFrame, cols, scale: int = 6) -> DataFrame:
    """Share of NULLs per column, zero rates dropped, highest first."""
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c_).isNull().cast("long")).alias(f"{c_}__nulls") for c_ in cols])
    one = one.select(*[ratio(f"{c_}__nulls", "_n", scale).alias(f"{c_}__null_rate") for c_ in cols])
    return _unpivot(one, cols, ("null_rate",)).filter("null_rate > 0").orderBy(F.desc("null_rate"), "column")


def null_rates_by(df: DataFrame, key: str, cols, scale: int = 6) -> DataFrame:
    """NULL share per group for chosen columns."""
    a = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                            *[F.sum(F.col(c_).isNull().cast("long")).alias(f"_{c_}") for c_ in cols])
    return a.select(key, *[ratio(f"_{c_}", "_n", scale).alias(f"{c_}_null_rate") for c_ in cols]).orderBy(key)


def frequencies(df: DataFrame, dims: dict) -> DataFrame:
    """Row counts per value of several dimensions in one pass
    (GROUPING SETS: one Expand, one aggregation)."""
    named = df.select(*[expr.cast("string").alias(name) for name, expr in dims.items()])
    names = list(dims)
    g = named.groupingSets([[n] for n in names], *names).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"))
    # grouping_id has a 1 bit for every dimension *not* in the set.
    full = (1 << len(names)) - 1
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for i, n in enumerate(names):
        gid = full ^ (1 << (len(names) - 1 - i))
        dim = F.when(F.col("_gid") == gid, F.lit(n)).otherwise(dim)
        val = F.when(F.col("_gid") == gid, F.col(n)).otherwise(val)
    return g.select(dim.alias("dimension"), val.alias("value"), "n")


def histogram(df: DataFrame, cols, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins between min and max (max folded into the last
    bin; a constant column has one).  Least and greatest values of all columns
    are one row, read by scalar subqueries; binning and counting is one
    aggregation over (column, bin)."""
    xs = {c_: F.col(c_).cast("double") for c_ in cols}
    ends = cut_lineage(df.agg(*[f(x).alias(f"{c_}__{n}") for c_, x in xs.items() for n, f in (("lo", F.min), ("hi", F.max))]))
    bounds = {c_: [ends.select(f"{c_}__{n}").scalar() for n in ("lo", "hi")] for c_ in cols}
    cells = F.array(*[F.struct(F.lit(c_).alias("column"), x.alias("x"), bounds[c_][0].alias("lo"), bounds[c_][1].alias("hi"))
                      for c_, x in xs.items()])
    u = df.select(F.inline(cells)).filter(F.col("x").isNotNull())
    place = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins))
    b = F.when(F.col("hi") > F.col("lo"), place).otherwise(F.lit(1)).cast("int")
    a = u.groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    return a.select("column", "bin", F.round(F.col("lo") + (F.col("bin") - 1) * width, 6).alias("bin_start"),
                    F.round(F.col("lo") + F.col("bin") * width, 6).alias("bin_end"), "n")


def box_summary(df: DataFrame, key: str, col: str, digits: int = 6) -> DataFrame:
    """Five numbers, fences and outlier count per group, from the ranks
    and counts of its distinct values.  A group without a value has zero
    counts and no numbers."""
    running = Q.running_counts(Q.value_counts(df, [col], [key]), [key])
    stats = Q.fences(running, [key], IQR_FACTOR).withColumnsRenamed({"lower": "lower_fence", "upper": "upper_fence"})
    groups = df.select(F.col(key).alias("_key")).distinct()
    res = groups.join(stats, F.col("_key").eqNullSafe(F.col(key)), "left")
    return res.select(F.col("_key").alias(key), F.coalesce("total", F.lit(0)).alias("n"),
                      *[F.round(c_, digits).alias(c_) for c_ in
                        ("min", "q1", "median", "q3", "max", "lower_fence", "upper_fence")],
                      F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"))


def iqr_outliers(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """IQR bounds and outlier count of all columns in one pass."""
    stats = Q.fences(Q.running_counts(Q.value_counts(df, cols)), (), IQR_FACTOR)
    values = {"q1": F.col("q1"), "q3": F.col("q3"), "iqr": F.col("q3") - F.col("q1"), "lower": F.col("lower"), "upper": F.col("upper")}
    return stats.select("column", *[F.round(v, digits).alias(n) for n, v in values.items()], "n_outliers")


def winsorize(df: DataFrame, cols, limit: float = WINSOR_LIMIT, suffix: str = "_w") -> DataFrame:
    """Fill NULLs with the median, then clip to the order statistics
    at ranks k and n-k-1 (0-based), k = int(limit * n), as rank-based
    winsorising does.  Medians and cuts of all columns are one small table,
    read by scalar subqueries; a column without a value stays NULL."""
    cuts = cut_lineage(Q.winsor_cuts(df, cols, limit))
    out = {}
    for c_ in cols:
        one = cuts.filter(F.col("column") == c_)
        median, low, high = (one.select(n).scalar() for n in ("median", "low", "high"))
        x = F.col(c_).cast("double")
        out[c_ + suffix] = F.least(F.greatest(F.coalesce(X.nan_to_null(x), median), low), high)
    return df.withColumns(out)


def corr_matrix(df: DataFrame, cols, digits: int = 9) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair, one
    aggregation for all pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), digits)
                   .alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return one.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


def shares_pivot(df: DataFrame, key: str, cat, values, prefix="pct_") -> DataFrame:
    """Share (%) of each category per group, a column for each of a
    fixed list of values (no pass to discover them); NULL categories excluded.
    Several categories (with a prefix each) are counted in the same pass; groups
    without any category of the first have no row."""
    cats, prefixes = ([cat], [prefix]) if isinstance(cat, str) else (list(cat), list(prefix))
    hits = {(c_, v): F.count(F.when(F.col(c_) == v, 1)).alias(f"_{i}_{v}") for i, c_ in enumerate(cats) for v in values}
    counts = df.filter(F.col(cats[0]).isNotNull()).groupBy(key).agg(*hits.values())
    total = [sum((F.col(f"_{i}_{v}") for v in values), F.lit(0)) for i in range(len(cats))]
    shares = [X.pct_1dp(F.col(f"_{i}_{v}"), F.nullif(total[i], F.lit(0))).alias(p + v) for i, p in enumerate(prefixes) for v in values]
    return counts.select(key, *shares).orderBy(key)


# ---- resampling (J2, J3) ----------------------------------------------------

def _poisson1(u: F.Column) -> F.Column:
    """Poisson(1) draw from a uniform in [0, 1) by inverting the CDF (cut
    points e^-1 * sum 1/j!).  The cut points go on until none of the 52-bit
    uniforms lies beyond the last, so the whole tail is drawn."""
    cdf, acc, term = [], 0.0, math.exp(-1.0)
    while acc < 1 - 2.0 ** -53 and (not cdf or acc + term > acc):
        acc += term
        cdf.append(acc)
        term /= len(cdf)
    expr = F.lit(len(cdf))
    for j in reversed(range(len(cdf))):
        expr = F.when(u < cdf[j], F.lit(j)).otherwise(expr)
    return expr


def _uniform(seed: int, *cols) -> F.Column:
    """Deterministic uniform in [0, 1) from a hash of the columns and seed."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.pmod(h, F.lit(KEY_RANGE)).cast("double") / float(KEY_RANGE))


def bootstrap_mean_ci(df: DataFrame, col: str, replicates: int = 1000, seed: int = 42,
                      row_id: str | None = None, alpha: float = 0.05) -> DataFrame:
    """Poisson bootstrap of the mean.  Each row carries a seeded
    Poisson(1) weight per replicate; per-replicate weighted sums are one
    grouped aggregation (partial sums per task, so no replicate is ever
    collected whole); the CI is the percentile of the replicate means."""
    x = F.col(col).cast("double")
    rid = F.col(row_id) if row_id else F.monotonically_increasing_id()
    rows = df.filter(x.isNotNull()).select(x.alias("_x"), rid.alias("_rid"))
    rep = rows.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    rep = rep.withColumn("_w", _poisson1(_uniform(seed, F.col("_rid"), F.col("_r"))))
    means = (rep.groupBy("_r").agg((F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("_m")))
    return means.agg(F.percentile("_m", F.lit(alpha / 2)).alias("ci_low"),
                     F.percentile("_m", F.lit(1 - alpha / 2)).alias("ci_high"),
                     F.count(F.lit(1)).alias("replicates"))


def permutation_test(df: DataFrame, col: str, group: str, a, b, replicates: int = 1000,
                     seed: int = 42, row_id: str | None = None, buckets: int = 256, resolved: int = 1 << 10) -> DataFrame:
    """Two-sample permutation test of the difference of means.

    Each replicate gives every row a seeded random key; the n_a rows with the
    smallest keys form group A.  Rows aren't sorted for that: a histogram of
    the keys of each replicate (counts and sums by bucket, partial per task)
    tells in which bucket the n_a-th key lies and what the rows before it sum
    to.  Only that bucket is looked into, by a histogram of its own while it
    may hold more than ``resolved`` rows, and is ranked at last.  p = share of
    replicates with |diff| >= observed.

    Rows with equal keys are ordered by their id.  What is joined to the rows
    is a row a replicate."""
    x = F.col(col).cast("double")
    rid = F.col(row_id) if row_id else F.monotonically_increasing_id()
    rows = cut_lineage(df.filter(x.isNotNull() & F.col(group).isin(a, b)).select(
        x.alias("_x"), (F.col(group) == a).alias("_in_a"), rid.alias("_rid")))
    stats = rows.agg(F.coalesce(F.sum(F.col("_in_a").cast("long")), F.lit(0)).alias("na"), F.count(F.lit(1)).alias("n"),
                     F.avg(F.when(F.col("_in_a"), F.col("_x"))).alias("ma"),
                     F.avg(F.when(~F.col("_in_a"), F.col("_x"))).alias("mb"), F.sum("_x").alias("s")).first()
    if not 0 < stats["na"] < stats["n"]:  # one group is empty: nothing to test
        return df.sparkSession.createDataFrame([(None, replicates, None)], "p_value double, replicates long, observed_diff double")
    na, n, observed = stats["na"], stats["n"], abs(stats["ma"] - stats["mb"])
    drawn = rows.select("_x", "_rid", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("_r"))
    drawn = drawn.withColumn("_k", F.pmod(F.xxhash64(F.lit(seed), "_rid", "_r"), F.lit(KEY_RANGE)))
    # per replicate: the range of keys still open, and count and sum before it
    open_ = df.sparkSession.range(1, replicates + 1).select(
        F.col("id").cast("int").alias("_r"), F.lit(0).cast("long").alias("_low"), F.lit(0).cast("long").alias("_n"), F.lit(0.0).alias("_s"))
    width, inside = KEY_RANGE, n
    while inside > resolved and width > 1:
        width = max(1, width // buckets)
        found = drawn.join(F.broadcast(open_), "_r").filter((F.col("_k") >= F.col("_low")) & (F.col("_k") < F.col("_low") + width * buckets))
        found = found.groupBy("_r", F.floor((F.col("_k") - F.col("_low")) / F.lit(width)).alias("_b"), "_low", "_n", "_s").agg(
            F.count(F.lit(1)).alias("_bn"), F.sum("_x").alias("_bs"))
        upto = Window.partitionBy("_r").orderBy("_b")  # a bucket a row
        found = found.withColumns({"_cn": F.col("_n") + F.sum("_bn").over(upto), "_cs": F.col("_s") + F.sum("_bs").over(upto)})
        hit = found.filter((F.col("_cn") >= na) & (F.col("_cn") - F.col("_bn") < na))
        open_ = cut_lineage(hit.select("_r", (F.col("_low") + F.col("_b") * width).alias("_low"), (F.col("_cn") - F.col("_bn")).alias("_n"),
                                       (F.col("_cs") - F.col("_bs")).alias("_s"), "_bn"))
        inside = open_.agg(F.max("_bn")).first()[0]
        open_ = open_.drop("_bn")
    last = drawn.join(F.broadcast(open_), "_r").filter((F.col("_k") >= F.col("_low")) & (F.col("_k") < F.col("_low") + width))
    last = last.withColumn("_rank", F.row_number().over(Window.partitionBy("_r").orderBy("_k", "_rid")))
    sums = last.filter(F.col("_rank") <= na - F.col("_n")).groupBy("_r").agg((F.max("_s") + F.sum("_x")).alias("_sa"))
    diffs = sums.select((F.col("_sa") / na - (F.lit(stats["s"]) - F.col("_sa")) / (n - na)).alias("_d"))
    return diffs.agg(F.avg((F.abs("_d") >= observed - 1e-12).cast("double")).alias("p_value"),
                     F.count(F.lit(1)).alias("replicates"), F.lit(observed).alias("observed_diff"))
