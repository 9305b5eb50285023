"""Exact ranks, prefix sums and quantiles without single-task windows.

A window with no PARTITION BY (or with a handful of huge partitions, such as
the two classes of a label) runs in one task. These helpers compute the same
results in a distributed way:

1. range-partition the rows on (group keys, order keys) -- Spark samples the
   keys and cuts balanced, ordered ranges;
2. aggregate one small row per (range, group) -- at most
   ``ranges x groups`` rows, a size bound that does not grow with the data;
3. prefix-sum those small rows with an ordinary window to get each range's
   offset, and join the offsets back (AQE broadcasts them: small by
   construction);
4. finish the rank / running sum locally inside each range.

Consistency: every evaluation of a range exchange samples its own bounds, so
range id and local position (or local running sum) are assigned in one pass
and that frame is written to the shared checkpoint folder
(``session.materialize``); offsets and final values are computed from the
written table only. Orders that come with a deterministic monotone bucket
(``bucket=`` -- e.g. a prefix of an md5 shuffle key) skip sampling entirely:
the bucket is a pure function of the row.

Hot keys stay safe: ranges split on the order keys, so one group holding a
third of all rows is spread over many ranges. Inputs with many equal order
keys are pre-aggregated by the callers (distinct value -> multiplicity)
before ranking, so a range never has to hold one giant run of equal keys.

Quantiles need no ranks of all rows: they are found by narrowing value ranges
(``exact_quantiles``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RNG = "_strata_rng"
_IDX = "_strata_idx"


def _num_ranges(df: DataFrame, num_ranges: int | None) -> int:
    if num_ranges:
        return num_ranges
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def md5_bucket(md5_hex: Column, hex_chars: int = 4) -> Column:
    """Monotone bucket of an md5 hex string: its first ``hex_chars`` digits."""
    return F.conv(F.substring(md5_hex, 1, hex_chars), 16, 10).cast("int")


def _bucketed_row_number(df, order, keys, bucket, out):
    b = "_strata_bkt"
    x = df.withColumn(b, bucket)
    counts = x.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = ((Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy())
             .orderBy(b).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*keys, b, F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"))
    local = x.withColumn("_lrn", F.row_number().over(Window.partitionBy(*keys, b).orderBy(*order)))
    # offsets: at most (bucket count x groups) rows by construction
    return (local.join(F.broadcast(offsets), [*keys, b], "inner")
                 .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("bigint"))
                 .drop(b, "_off", "_lrn"))


def exact_row_number(df: DataFrame, order_cols: Sequence, partition_cols: Sequence[str] = (),
                     out: str = "rn", num_ranges: int | None = None,
                     bucket: Column | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition_cols ORDER BY order_cols)``.

    Meant for few, large groups (class labels, whole table).

    With ``bucket`` (a deterministic expression monotone in the order, e.g.
    ``md5_bucket``): counts per (group, bucket) -> offsets -> row_number
    inside each bucket. Otherwise: range-partition once, take the per-range
    row index from ``monotonically_increasing_id`` right after a sort within
    each range partition (lower 33 bits = record number in the partition),
    write the frame, and add offsets counted from the written table.
    """
    keys = list(partition_cols)
    order = _as_cols(order_cols)
    if bucket is not None:
        return _bucketed_row_number(df, order, keys, bucket, out)
    from strata.session import materialize
    n = _num_ranges(df, num_ranges)
    ranged = materialize(df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
                         .sortWithinPartitions(*[F.col(k) for k in keys], *order)
                         .withColumn(_RNG, F.spark_partition_id())
                         .withColumn(_IDX, F.monotonically_increasing_id()
                                     - F.shiftleft(F.col(_RNG).cast("bigint"), 33)), "ranks")
    counts = ranged.groupBy(_RNG, *keys).agg(F.count(F.lit(1)).alias("_cnt"))
    if keys:
        w_in = Window.partitionBy(_RNG).orderBy(*[F.col(k) for k in keys]).rowsBetween(
            Window.unboundedPreceding, -1)
        within = F.coalesce(F.sum("_cnt").over(w_in), F.lit(0))
    else:
        within = F.lit(0).cast("bigint")
    w_across = (Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy())
    w_across = w_across.orderBy(_RNG).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _RNG, *keys,
        within.alias("_within"),
        F.coalesce(F.sum("_cnt").over(w_across), F.lit(0)).alias("_across"))
    joined = ranged.join(offsets, [_RNG, *keys], "inner")
    return joined.withColumn(out, (F.col(_IDX) - F.col("_within") + F.col("_across") + 1)
                             .cast("bigint")).drop(_RNG, _IDX, "_within", "_across")


def exact_prefix_sum(df: DataFrame, order_cols: Sequence, value_cols: Sequence[str],
                     partition_cols: Sequence[str] = (), suffix: str = "_cum",
                     num_ranges: int | None = None) -> DataFrame:
    """Running sums (inclusive) of ``value_cols`` in ``order_cols`` order per group.

    Order keys should be unique within a group (callers pre-aggregate). Range
    ids and local running sums are assigned once and written -- see module
    notes.
    """
    from strata.session import materialize
    n = _num_ranges(df, num_ranges)
    keys = list(partition_cols)
    order = _as_cols(order_cols)
    w_local = (Window.partitionBy(_RNG, *keys).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
                .withColumn(_RNG, F.spark_partition_id()))
    ranged = materialize(ranged.select(
        "*", *[F.sum(v).over(w_local).alias(f"_l_{v}") for v in value_cols]), "prefix-sums")
    totals = ranged.groupBy(_RNG, *keys).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    w_across = (Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy())
    w_across = w_across.orderBy(_RNG).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_RNG, *keys, *[
        F.coalesce(F.sum(f"_t_{v}").over(w_across), F.lit(0)).alias(f"_o_{v}") for v in value_cols])
    joined = ranged.join(offsets, [_RNG, *keys], "inner")
    return joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_l_{v}") + F.col(f"_o_{v}")).alias(f"{v}{suffix}") for v in value_cols])


BINS = 1024
CELL_ROWS = 50_000


def _bin_of(v: Column, lo: Column, hi: Column, bins: int, logarithmic: bool) -> Column:
    """Number of v's bin between lo and hi, monotone in v: equal widths, or
    equal widths of the logarithm of v's place (for values far apart).
    Infinities and NaN, the largest value, have bins of their own."""
    wide = (hi - lo) == float("inf")                           # halves where hi - lo overflows
    place = F.coalesce(F.try_divide(F.when(wide, v / 2 - lo / 2).otherwise(v - lo),
                                    F.when(wide, hi / 2 - lo / 2).otherwise(hi - lo)), F.lit(0.0))
    if logarithmic:
        place = F.log1p(place * F.lit(float(1 << 52))) / F.lit(math.log1p(float(1 << 52)))
    within = F.least(F.greatest(F.floor(place * F.lit(bins)), F.lit(0)), F.lit(bins - 1))
    return (F.when(F.isnan(v), F.lit(bins + 1)).when(v == float("inf"), F.lit(bins)).when(v == float("-inf"), F.lit(-1))
            .otherwise(within)).cast("int")


def _cells(rows: DataFrame, keys: list[str], more: list[str], value: str) -> DataFrame:
    """Rows counted per (keys, more), with the least and largest value and the
    range of finite ones."""
    v = F.col(value)
    finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    return rows.groupBy(*keys, *more).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
        F.min(finite).alias("_flo"), F.max(finite).alias("_fhi"))


def _wanted(cells: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that hold a target rank."""
    c, t = cells.alias("_c"), targets.alias("_t")
    cond = [F.col(f"_c.{k}") == F.col(f"_t.{k}") for k in keys]
    cond += [F.col("_c._before") <= F.col("_t._k"), F.col("_t._k") < F.col("_c._before") + F.col("_c._rows")]
    return c.join(t, reduce(lambda x, y: x & y, cond), "left_semi")


def _inside(vals: DataFrame, cells: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values that lie in a cell, with it. Cells: a few per group."""
    v, c = vals.alias("_v"), cells.alias("_c")
    cond = [F.col(f"_v.{k}") == F.col(f"_c.{k}") for k in keys]
    cond += [F.col(f"_v.{value}") >= F.col("_c._lo"), F.col(f"_v.{value}") <= F.col("_c._hi")]
    return v.join(c, reduce(lambda x, y: x & y, cond)).select(
        *[F.col(f"_v.{k}").alias(k) for k in keys], F.col(f"_v.{value}").alias(value),
        "_c._lo", "_c._hi", "_c._flo", "_c._fhi", "_c._before")


def exact_quantiles(long_df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], out: str = "value",
                    bins: int = BINS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Linear-interpolated quantiles (pandas / DuckDB ``quantile_cont``) per group.

    Returns (group_cols..., prob, out). NULL values are ignored. Ranks are
    selected by narrowing: a cell is a range of values of a group with its
    number of rows and of rows below it. Each round counts the values of the
    cells that hold a target rank into ``bins`` finer cells (map-side combined:
    a task ships bins, not values) and keeps those that hold a target. When no
    wanted cell has over ``cell_rows`` rows, or more than one value, the values
    inside are counted and ranked, one cell a group. The data are never sorted
    and are read once a round; every round divides a cell's range by ``bins``,
    of the values and of their logarithms in turn. Meant for few, large groups.
    """
    from strata.session import materialize
    keys = list(group_cols)
    vals = long_df.filter(F.col(value_col).isNotNull()).select(*keys, F.col(value_col).cast("double").alias(value_col))
    cells = materialize(_cells(vals, keys, [], value_col).withColumn("_before", F.lit(0).cast("bigint")), "cells")
    # one target row per (group, prob, rank): a few rows per group
    targets = cells.select(*keys, F.col("_rows").alias("_n"), F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")) \
        .withColumn("_pos", F.col("prob") * (F.col("_n") - 1)).drop("_n") \
        .withColumn("_k", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
    large = (F.col("_rows") > cell_rows) & (F.col("_lo") != F.col("_hi"))
    logarithmic = False
    while not cells.filter(large).isEmpty():
        number = _bin_of(F.col(value_col), F.col("_flo"), F.col("_fhi"), bins, logarithmic)
        fine = _inside(vals, cells.filter(large), keys, value_col).withColumn("_bin", number) \
            .withColumn("_start", F.col("_before"))
        finer = _cells(fine, keys, ["_start", "_bin"], value_col)
        below = (Window.partitionBy(*keys, "_start").orderBy("_bin")
                 .rowsBetween(Window.unboundedPreceding, -1))              # at most bins + 3 rows
        finer = finer.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_rows").over(below), F.lit(0)))
        cells = materialize(cells.filter(~large).unionByName(_wanted(finer, targets, keys).select(*cells.columns)), "cells")
        logarithmic = not logarithmic
    single = cells.filter("_lo = _hi").select(*keys, F.col("_lo").alias("_v"), F.col("_before").alias("_from"),
                                              (F.col("_before") + F.col("_rows")).alias("_to"))
    counted = (_inside(vals, cells.filter("_lo <> _hi"), keys, value_col)
               .groupBy(*keys, "_before", F.col(value_col).alias("_v")).agg(F.count(F.lit(1)).alias("_rows")))
    run = Window.partitionBy(*keys, "_before").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("_to", F.col("_before") + F.sum("_rows").over(run)) \
        .select(*keys, "_v", (F.col("_to") - F.col("_rows")).alias("_from"), "_to")
    c, t = counted.unionByName(single).alias("_c"), targets.alias("_t")
    cond = [F.col(f"_c.{k}") == F.col(f"_t.{k}") for k in keys]
    cond += [F.col("_c._from") <= F.col("_t._k"), F.col("_t._k") < F.col("_c._to")]
    hit = c.join(t, reduce(lambda x, y: x & y, cond)).select(
        *[F.col(f"_t.{k}").alias(k) for k in keys], "_t.prob", "_t._pos", "_t._k", "_c._v")
    res = hit.groupBy(*keys, "prob", "_pos").agg(
        F.max(F.when(F.col("_k") == F.floor("_pos"), F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_k") == F.ceil("_pos"), F.col("_v"))).alias("_hi"))
    frac = F.col("_pos") - F.floor("_pos")
    # equal neighbours need no interpolation (infinities would give NaN)
    between = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac)
    return res.select(*keys, "prob", between.alias(out))


def dense_rank_values(df: DataFrame, col: str, out: str = "code",
                      num_ranges: int | None = None) -> DataFrame:
    """Distinct values of ``col`` with their 0-based rank in code-point order."""
    distinct = df.select(col).distinct()
    ranked = exact_row_number(distinct, [F.col(col)], (), out="_r", num_ranges=num_ranges)
    return ranked.select(col, (F.col("_r") - 1).cast("int").alias(out))
