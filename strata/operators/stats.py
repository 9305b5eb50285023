"""Exploratory and drift statistics as tables.

Most operators take a *long* frame (group columns..., feature, value) so
the number of features never widens a single aggregate past codegen limits,
and every per-feature statistic is one grouped aggregate with map-side
partial results. Quantiles use the distributed exact quantile operator.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import clip_upper, delta_pct
from strata.operators.ranking import exact_quantiles
from strata.session import materialize

LABEL = "label"
TERMS, REACH = 14, 8.75            # of the Gauss transform: see kde_curve
FENCE_TOL = 1e-9
EDGE_TOL = 1e-9


def to_long(df: DataFrame, cols: list[str], ids: list[str]) -> DataFrame:
    """Wide numeric columns -> (ids..., feature, value); NULL values dropped."""
    out = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot(
        ids, cols, "feature", "value")
    return out.filter(F.col("value").isNotNull())


def category_label_counts(df: DataFrame, cat: str, label: str = LABEL,
                          group_cols=()) -> DataFrame:
    """Rows per (category, label), label pivoted to n0/n1, missing -> 0."""
    g = list(group_cols)
    piv = df.groupBy(*g, cat).pivot(label, [0, 1]).count().na.fill(0)
    return piv.select(*g, F.col(cat).alias("category"), F.col("0").cast("bigint").alias("n0"),
                      F.col("1").cast("bigint").alias("n1"))


def stratified_means(long: DataFrame, label: str = LABEL, group_cols=()) -> DataFrame:
    """Mean per label, delta (1-0) and delta % with zero guard."""
    g = list(group_cols)
    m = long.groupBy(*g, "feature").agg(
        F.avg(F.when(F.col(label) == 0, F.col("value"))).alias("mean_0"),
        F.avg(F.when(F.col(label) == 1, F.col("value"))).alias("mean_1"))
    return (m.withColumn("delta", F.col("mean_1") - F.col("mean_0"))
             .withColumn("delta_pct", F.round(delta_pct("mean_1", "mean_0"), 1)))


def describe(long: DataFrame, group_cols=()) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 %, max per feature.

    Exact interpolated quartiles (not the approximate ``summary()``).
    """
    keys = [*group_cols, "feature"]
    base = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(long, keys, "value", [0.25, 0.5, 0.75])
    qw = q.groupBy(*keys).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("p75"))
    return base.join(qw, keys, "left").select(*keys, "count", "mean", "std", "min", "p25",
                                             "p50", "p75", "max")


def cohort_compare(long: DataFrame, cohorts=("D1", "D2"), cohort_col: str = "cohort") -> DataFrame:
    """Mean and sample std per feature for two cohorts side by side."""
    a, b = cohorts
    va = F.when(F.col(cohort_col) == a, F.col("value"))
    vb = F.when(F.col(cohort_col) == b, F.col("value"))
    return long.groupBy("feature").agg(
        F.avg(va).alias(f"{a.lower()}_mean"), F.stddev_samp(va).alias(f"{a.lower()}_std"),
        F.avg(vb).alias(f"{b.lower()}_mean"), F.stddev_samp(vb).alias(f"{b.lower()}_std"))


def variance_rank(long: DataFrame, k: int | None = None) -> DataFrame:
    """Sample variance per feature, highest first."""
    v = long.groupBy("feature").agg(F.var_samp("value").alias("variance"))
    # rank at 1e-9: scaled columns share variance n/(n-1) up to float noise
    v = v.orderBy(F.desc_nulls_last(F.round("variance", 9)), "feature")
    return v.limit(k) if k else v


def corr_with_label(long: DataFrame, label: str = LABEL) -> DataFrame:
    """Pearson r of each feature with the label.

    covar_pop / (std_pop x std_pop) with a zero guard: constant columns give
    NULL (Spark's ``corr`` raises under ANSI on them; pandas gives NaN).
    """
    y = F.col(label).cast("double")
    agg = long.groupBy("feature").agg(
        F.covar_pop("value", y).alias("_cov"), F.stddev_pop("value").alias("_sx"),
        F.stddev_pop(y).alias("_sy"))
    r = F.when((F.col("_sx") == 0) | (F.col("_sy") == 0), F.lit(None)).otherwise(
        F.col("_cov") / (F.col("_sx") * F.col("_sy")))
    return agg.select("feature", r.alias("r"), F.abs(r).alias("abs_r"))


def top_by_abs_corr(corr: DataFrame, k: int) -> DataFrame:
    """Top-k by |r| (compared at 1e-9), NULL last, name as tie-break."""
    return corr.orderBy(F.desc_nulls_last(F.round("abs_r", 9)), "feature").limit(k)


class PairMoments:
    """Moments of every pair of columns over the rows where both are there:
    ``n``; ``mean[i, j]`` of column i; ``ss[i, j]``, i's centred sum of squares;
    ``cross``, the centred products."""

    def __init__(self, x: np.ndarray):
        m = (~np.isnan(x)).astype(float)
        mean = np.divide(np.nansum(x, 0), m.sum(0), out=np.zeros(x.shape[1]), where=m.sum(0) > 0)
        c = np.where(m > 0, x - mean, 0.0)                     # near 0: products lose no digits
        self.n = m.T @ m
        one = np.maximum(self.n, 1)
        shift = (c.T @ m) / one
        self.mean = np.where(self.n > 0, shift + mean[:, None], 0.0)
        self.ss = (c * c).T @ m - shift * shift * self.n
        self.cross = c.T @ c - shift * shift.T * self.n

    def add(self, other: "PairMoments") -> "PairMoments":
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        d = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        both = self.n * share
        self.ss += other.ss + d * d * both
        self.cross += other.cross + d * d.T * both
        self.mean = np.where(self.n > 0, self.mean + d * share, other.mean)
        self.n = n
        return self

    def pack(self) -> bytes:
        return np.stack([self.n, self.mean, self.ss, self.cross]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> "PairMoments":
        out = cls.__new__(cls)
        flat = np.frombuffer(raw, np.float64)
        d = math.isqrt(len(flat) // 4)
        out.n, out.mean, out.ss, out.cross = flat.reshape(4, d, d).copy()
        return out

    def correlation(self) -> np.ndarray:
        """Pearson r, NaN where a column of the pair is constant or n < 2."""
        tiny = 1e-13 * np.maximum(self.mean * self.mean * self.n, 1e-300)
        sd = np.sqrt(np.where(self.ss > tiny, self.ss, 0.0))
        r = np.divide(self.cross, sd * sd.T, out=np.full(sd.shape, np.nan), where=(sd * sd.T) > 0)
        return np.clip(r, -1, 1)


def corr_matrix_lower(df: DataFrame, cols: list[str], block: int = 4096, tree_width: int = 32) -> DataFrame:
    """Pairwise-complete Pearson r among ``cols`` (in that order), lower
    triangle only (X2, X3): a pair uses the rows where neither value is null.
    One pass: every partition adds up d x d moments, which are merged as a tree
    (their size is bounded by d, not by rows); the d x d result is tabulated on
    the driver. ``r`` is null for a constant column or fewer than two rows.
    """
    def moments(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                x = np.column_stack([np.asarray(c.fill_null(np.nan), np.float64) for c in part.columns])
                got = PairMoments(x)
                total = got if total is None else total.add(got)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.pack()], pa.binary())],
                                             ["part", "sums"])

    def merge(table: pa.Table) -> pa.Table:
        sums = [PairMoments.unpack(v) for v in table.column("sums").to_pylist()]
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([reduce(PairMoments.add, sums).pack()], pa.binary())})

    schema = "part int, sums binary"
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = materialize(wide.mapInArrow(moments, schema).withColumn("part", F.spark_partition_id()), "moments")
    left = parts.count()
    while left > tree_width:
        left = -(-left // tree_width)
        parts = parts.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(left)).cast("int")) \
            .groupBy("part").applyInArrow(merge, schema)
    got = parts.toArrow()
    mat = PairMoments.unpack(merge(got)["sums"][0].as_py()).correlation() if got.num_rows else np.full((len(cols),) * 2, np.nan)
    rows = [(cols[i], cols[j], i, j, None if math.isnan(mat[i][j]) else float(mat[i][j]))
            for i in range(len(cols)) for j in range(i)]
    return df.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, i int, j int, r double")


def _group_bounds(long: DataFrame, keys: list[str]) -> DataFrame:
    return long.groupBy(*keys).agg(F.count("value").alias("n"), F.min("value").alias("lo"),
                                   F.max("value").alias("hi"),
                                   F.stddev_samp("value").alias("sd"))


def histogram(long: DataFrame, bins: int, group_cols=()) -> DataFrame:
    """Equal-width histogram per group over its own [min, max].

    Last bin closed; empty bins present (count 0); density = count / (n x
    width). A constant group uses [v - .5, v + .5] like numpy.
    """
    keys = [*group_cols, "feature"]
    b = _group_bounds(long, keys)
    const = F.col("hi") == F.col("lo")
    b = b.select(*keys, "n", F.when(const, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                 F.when(const, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    b = b.withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(bins))
    # one row per group: bounded by groups x features
    j = long.join(F.broadcast(b.select(*keys, "lo", "hi")), keys, "inner")
    # bins are [a, b) (last one closed); +1e-9 keeps values that sit on an
    # edge in exact arithmetic in the upper bin whatever the float noise
    pos = (F.col("value") - F.col("lo")) * F.lit(bins) / (F.col("hi") - F.col("lo"))
    idx = F.least(F.floor(pos + F.lit(EDGE_TOL)) + 1, F.lit(bins))
    counts = j.groupBy(*keys, idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = b.select(*keys, "n", "lo", "width", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = grid.join(counts, [*keys, "bin"], "left").withColumn(
        "count", F.coalesce(F.col("count"), F.lit(0)).cast("bigint"))
    return out.select(*keys, "bin",
                      (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_lo"),
                      (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_hi"),
                      "count", (F.col("count") / (F.col("n") * F.col("width"))).alias("density"))


def kde_curve(long: DataFrame, group_cols=(), points: int = 1000, cut: float | None = None,
              bins: int | None = None) -> DataFrame:
    """Gaussian KDE on a grid per group.

    Bandwidth: Scott, h = std(ddof 1) x n^(-1/5). Grid: ``points`` values over
    [min - r/2, max + r/2] (r = range) or, with ``cut`` given, over
    [min - cut x h, max + cut x h].

    Work: a fast Gauss transform. A value v lies in a cell of width h/2 with
    centre c; with u = (v - c) / h and X = (x - c) / h,

        exp(-(X - u)^2 / 2) = exp(-X^2 / 2) sum_p X^p / p!  u^p exp(-u^2 / 2)

    so a cell passes on ``TERMS`` sums over its values, whatever the number of
    grid points, and a grid point adds up the cells within ``REACH`` bandwidths.
    |u| <= 1/4 bounds the terms left out by 1e-13 a value, and the cells left
    out by 1e-15: the density is within 1e-12 / h of the direct sum. ``bins``
    moves values to the centres of that many equal-width bins first (an
    approximation that the caller asks for).
    """
    keys = [*group_cols, "feature"]
    b = _group_bounds(long, keys).filter(F.col("n") > 1)
    b = b.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    if cut is None:
        start = F.col("lo") - 0.5 * (F.col("hi") - F.col("lo"))
        stop = F.col("hi") + 0.5 * (F.col("hi") - F.col("lo"))
    else:
        start = F.col("lo") - F.lit(cut) * F.col("h")
        stop = F.col("hi") + F.lit(cut) * F.col("h")
    b = b.withColumn("x0", start).withColumn("step", (stop - start) / F.lit(points - 1))
    b = b.filter(F.col("h") > 0)
    # one row per group: bounded by groups x features
    bounds = F.broadcast(b.select(*keys, "n", "lo", "hi", "h", "x0", "step"))
    j = long.join(bounds, keys, "inner")
    if bins is not None:
        width = (F.col("hi") - F.col("lo")) / F.lit(bins)
        centre = F.col("lo") + (F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))
                                + 0.5) * width
        j = j.withColumn("value", centre)
    cell = F.floor((F.col("value") - F.col("lo")) / (F.col("h") / 2))
    u = (F.col("value") - F.col("lo")) / F.col("h") - (F.col("cell") + 0.5) / 2
    j = j.withColumn("cell", cell).withColumn("u", u).withColumn("e", F.exp(-0.5 * F.col("u") * F.col("u")))
    sums = [F.sum(reduce(lambda a, _: a * F.col("u"), range(p), F.col("e")) / F.lit(float(math.factorial(p)))).alias(f"m{p}")
            for p in range(TERMS)]
    cells = j.groupBy(*keys, "cell").agg(*sums).join(bounds, keys)
    centre = F.col("lo") + (F.col("cell") + 0.5) * F.col("h") / 2
    first = F.greatest(F.ceil((centre - REACH * F.col("h") - F.col("x0")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((centre + REACH * F.col("h") - F.col("x0")) / F.col("step")), F.lit(points - 1))
    near = cells.withColumn("_a", first).withColumn("_z", last).filter("_a <= _z") \
        .withColumn("k", F.explode(F.sequence(F.col("_a").cast("int"), F.col("_z").cast("int"))))
    x = ((F.col("x0") - F.col("lo") + F.col("k") * F.col("step")) / F.col("h")) - (F.col("cell") + 0.5) / 2
    series = reduce(lambda acc, p: acc * F.col("X") + F.col(f"m{p}"), range(TERMS - 2, -1, -1), F.col(f"m{TERMS - 1}"))
    dens = (near.withColumn("X", x).withColumn("s", F.exp(-0.5 * F.col("X") * F.col("X")) * series)
            .groupBy(*keys, "k").agg(F.sum("s").alias("_s")))
    grid = b.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.join(dens, [*keys, "k"], "left").select(
        *keys, "k", (F.col("x0") + F.col("k") * F.col("step")).alias("x"),
        (F.greatest(F.coalesce("_s", F.lit(0.0)), F.lit(0.0)) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))))
        .alias("density"))


def box_stats(long: DataFrame, group_cols=()) -> DataFrame:
    """Q1, median, Q3, whiskers (extreme points within 1.5 IQR), outliers."""
    keys = [*group_cols, "feature"]
    q = exact_quantiles(long, keys, "value", [0.25, 0.5, 0.75])
    qw = q.groupBy(*keys).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    qw = (qw.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
            .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    # one row per group: bounded by groups x features
    j = long.join(F.broadcast(qw), keys, "inner")
    # points within 1e-9 of a fence count as inside (fences often equal a
    # data point in exact arithmetic; float noise must not decide)
    tol = F.lit(FENCE_TOL) * F.greatest(F.lit(1.0), F.abs(F.col("q3") - F.col("q1")))
    inside = ((F.col("value") >= F.col("lo_fence") - tol)
              & (F.col("value") <= F.col("hi_fence") + tol))
    agg = j.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    return qw.join(agg, keys, "inner").select(*keys, "n", "q1", "median", "q3", "whisker_lo",
                                             "whisker_hi", "n_outliers", "min", "max")


def clip_at_quantile(long: DataFrame, q: float = 0.99, group_cols=()) -> DataFrame:
    """Cap each group's values at its own q-quantile, NULLs kept."""
    keys = [*group_cols, "feature"]
    caps = exact_quantiles(long, keys, "value", [q], out="cap").drop("prob")
    # one row per group: bounded by groups x features
    return long.join(F.broadcast(caps), keys, "inner").withColumn("value", clip_upper("value", "cap")).drop("cap")
