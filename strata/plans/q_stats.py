"""Registered queries: exploratory and drift statistics on the prepared
cohorts (A26-A30, C16, T1, T4, X1-X12)."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import stats as sx
from strata.plans.common import compose, r, register, rounded
from strata.plans.q_prep import VIEWS, prep_ctes
from strata.plans.workflow import prepare_cohorts, tagged_splits
from strata.sources.tables import read_table

KEY = "PATIENT"

# Named clinical panel (skipped when absent) and utilisation
# columns of the reference's EDA, plus the columns of its stratified means.
CLINICAL_FEATURES = [
    "obs_Body_Height_mean", "obs_Body_Weight_mean", "obs_Body_mass_index__BMI___Ratio_mean",
    "obs_Diastolic_Blood_Pressure_mean", "obs_Systolic_Blood_Pressure_mean",
    "obs_Heart_rate_mean", "obs_Cholesterol__Mass_volume__in_Serum_or_Plasma_mean",
]
UTIL_FEATURES = ["total_encounters", "total_medications", "total_procedures", "total_claims"]
STRAT_EXTRA = ["total_encounters", "total_medications", "total_procedures", "total_claims",
               "age", "INCOME"]
CATEGORY_COLS = ["GENDER", "RACE", "MARITAL"]
SQRT_2PI = math.sqrt(2 * math.pi)


def prepared_long(spark, sf_dir, features=None, keep=None, cohort=None, split=None):
    """(cohort, split, PATIENT, label, feature, value) of the scaled cohorts.

    ``features`` (names) or ``keep`` (predicate on a name) select columns
    *before* the unpivot, so the scan reads only those columns (a filter on
    ``feature`` after the unpivot cannot prune the stage table's columns).
    """
    prepared = prepare_cohorts(spark, sf_dir)
    feats = prepared["D1"].features
    if features is not None:
        feats = [f for f in feats if f in set(features)]
    if keep is not None:
        feats = [f for f in feats if keep(f)]
    wide = tagged_splits(prepared)
    # row filters before the unpivot too: Catalyst does not push a filter
    # through the Expand that unpivot becomes
    if cohort is not None:
        wide = wide.filter(F.col("cohort") == cohort)
    if split is not None:
        wide = wide.filter(F.col("split") == split)
    return sx.to_long(wide, feats, ["cohort", "split", KEY, "label"])


def _sql(final, extra=()):
    return compose(VIEWS, [*prep_ctes(), *extra], final)


def _in(names):
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


@register("category_by_label", _sql(
    f"SELECT cohort, feature AS column_name, {r('value')} AS category, "
    "CAST(count(*) FILTER (WHERE label = 0) AS BIGINT) AS n0, "
    "CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS n1 "
    f"FROM scaled WHERE feature IN {_in(CATEGORY_COLS)} GROUP BY cohort, feature, {r('value')}"))
def category_by_label(spark, sf_dir):
    """Rows per (encoded category, label) for gender, race, marital."""
    lg = prepared_long(spark, sf_dir, CATEGORY_COLS)
    lg = lg.withColumn("category", F.round("value", 6) + F.lit(0.0))
    out = sx.category_label_counts(lg, "category", group_cols=["cohort", "feature"])
    return out.withColumnRenamed("feature", "column_name")


def _strat_cols():
    return CLINICAL_FEATURES + STRAT_EXTRA


@register("stratified_means", _sql(
    f"SELECT feature, {r('m0', 3)} AS mean_0, {r('m1', 3)} AS mean_1, {r('m1 - m0', 3)} AS delta, "
    f"{r('round((m1 - m0) / nullif(m0, 0) * 100, 1)', 3)} AS delta_pct FROM ("
    "SELECT feature, avg(value) FILTER (WHERE label = 0) AS m0, avg(value) FILTER (WHERE label = 1) AS m1 "
    f"FROM scaled WHERE cohort = 'D1' AND feature IN {_in(_strat_cols())} GROUP BY feature)"))
def stratified_means(spark, sf_dir):
    """D1 label-stratified means of the clinical and utilisation columns."""
    lg = prepared_long(spark, sf_dir, _strat_cols(), cohort="D1")
    return rounded(sx.stratified_means(lg), 3)


@register("describe_features", _sql(
    f"SELECT cohort, feature, CAST(count(value) AS BIGINT) AS count, {r('avg(value)')} AS mean, "
    f"{r('stddev_samp(value)')} AS std, {r('min(value)')} AS min, "
    f"{r('quantile_cont(value, 0.25)')} AS p25, {r('quantile_cont(value, 0.5)')} AS p50, "
    f"{r('quantile_cont(value, 0.75)')} AS p75, {r('max(value)')} AS max FROM ("
    "SELECT cohort, feature, value FROM scaled UNION ALL "
    "SELECT DISTINCT cohort, 'label', CAST(label AS DOUBLE) FROM (SELECT cohort, PATIENT, label FROM splits)"
    ") GROUP BY cohort, feature").replace(
    "SELECT DISTINCT cohort, 'label', CAST(label AS DOUBLE) FROM (SELECT cohort, PATIENT, label FROM splits)",
    "SELECT cohort, 'label', CAST(label AS DOUBLE) FROM splits"))
def describe_features(spark, sf_dir):
    """describe() of each full cohort (train + test), label included."""
    prepared = prepare_cohorts(spark, sf_dir)
    feats = prepared["D1"].features
    wide = tagged_splits(prepared)
    lg = sx.to_long(wide, [*feats, "label"], ["cohort"])
    return rounded(sx.describe(lg, ["cohort"]))


def _corr_sql():
    return ("corr_t AS (SELECT feature, CASE WHEN stddev_pop(value) = 0 OR stddev_pop(label) = 0 "
            "THEN NULL ELSE covar_pop(value, label) / (stddev_pop(value) * stddev_pop(label)) END AS r "
            "FROM scaled WHERE cohort = 'D1' AND split = 'train' GROUP BY feature)",
            "corr_rank AS (SELECT feature, r, abs(r) AS abs_r, row_number() OVER "
            "(ORDER BY round(abs(r), 9) DESC NULLS LAST, feature) AS rank FROM corr_t)")


def _d1_train_corr(lg):
    return sx.corr_with_label(lg.filter((F.col("cohort") == "D1") & (F.col("split") == "train")))


def _d1_train_long(spark, sf_dir):
    return prepared_long(spark, sf_dir, cohort="D1", split="train")


@register("corr_with_label", _sql(
    f"SELECT feature, {r('r')} AS r, {r('abs_r')} AS abs_r FROM corr_rank", _corr_sql()))
def corr_with_label(spark, sf_dir):
    """Pearson r of every feature with the label on D1 train."""
    return rounded(_d1_train_corr(_d1_train_long(spark, sf_dir)))


@register("corr_top30", _sql(
    f"SELECT CAST(rank AS INTEGER) AS rank, feature, {r('r')} AS r, {r('abs_r')} AS abs_r "
    "FROM corr_rank WHERE rank <= 30", _corr_sql()))
def corr_top30(spark, sf_dir):
    """The 30 features most correlated (|r|) with the label."""
    top = sx.top_by_abs_corr(_d1_train_corr(_d1_train_long(spark, sf_dir)), 30)
    w = Window.orderBy(F.desc_nulls_last(F.round("abs_r", 9)), "feature")  # 30 rows
    return rounded(top.withColumn("rank", F.row_number().over(w).cast("int"))
                      .select("rank", "feature", "r", "abs_r"))


@register("corr_matrix_lower", _sql(
    f"SELECT a.feature AS feature_a, b.feature AS feature_b, {r('CASE WHEN stddev_pop(a.value) = 0 OR stddev_pop(b.value) = 0 THEN NULL ELSE covar_pop(a.value, b.value) / (stddev_pop(a.value) * stddev_pop(b.value)) END')} AS r "
    "FROM tv a JOIN tv b ON a.PATIENT = b.PATIENT AND a.idx > b.idx GROUP BY a.feature, b.feature",
    [*_corr_sql(),
     "idx AS (SELECT feature, rank AS idx FROM corr_rank WHERE rank <= 30 UNION ALL SELECT 'label', 31)",
     "tv AS (SELECT s.PATIENT, s.feature, i.idx, s.value FROM scaled s JOIN idx i ON i.feature = s.feature "
     "WHERE s.cohort = 'D1' AND s.split = 'train' UNION ALL SELECT PATIENT, 'label', 31, CAST(label AS DOUBLE) "
     "FROM splits WHERE cohort = 'D1' AND split = 'train')"]))
def corr_matrix_lower(spark, sf_dir):
    """Correlation matrix of top-30 + label, lower triangle only."""
    prepared = prepare_cohorts(spark, sf_dir)
    p1 = prepared["D1"]
    train = p1.frame.filter(F.col("split") == "train")
    lg = sx.to_long(train, p1.features, [KEY, "label"])
    top = [r_["feature"] for r_ in sx.top_by_abs_corr(sx.corr_with_label(lg), 30).collect()]
    cols = [*top, "label"]
    m = sx.corr_matrix_lower(train.select(*[F.col(f"`{c}`") for c in cols]), cols)
    return rounded(m.select("feature_a", "feature_b", "r"))


def _top10_corr_features(lg):
    return [r_["feature"] for r_ in sx.top_by_abs_corr(_d1_train_corr(lg), 10).collect()]


@register("drift_table", _sql(
    f"SELECT feature, {r('avg(value) FILTER (WHERE cohort = $D1$)', 3)} AS d1_mean, "
    f"{r('stddev_samp(value) FILTER (WHERE cohort = $D1$)', 3)} AS d1_std, "
    f"{r('avg(value) FILTER (WHERE cohort = $D2$)', 3)} AS d2_mean, "
    f"{r('stddev_samp(value) FILTER (WHERE cohort = $D2$)', 3)} AS d2_std "
    "FROM scaled WHERE split = 'train' AND feature IN (SELECT feature FROM corr_rank WHERE rank <= 10) "
    "GROUP BY feature", _corr_sql()).replace("$D1$", "'D1'").replace("$D2$", "'D2'"))
def drift_table(spark, sf_dir):
    """Top-10 |r| features, mean and std on D1 train vs D2 train."""
    top = _top10_corr_features(_d1_train_long(spark, sf_dir))
    tr = prepared_long(spark, sf_dir, top, split="train")
    return rounded(sx.cohort_compare(tr), 3)


def _kde_sql(src: str, keys: str, points: int, cut: float | None, name: str) -> list[str]:
    if cut is None:
        x0 = "lo - 0.5 * (hi - lo)"
        span = "2.0 * (hi - lo)"
    else:
        x0 = f"lo - {cut} * h"
        span = f"(hi - lo) + 2 * {cut} * h"
    return [
        f"{name}_b AS (SELECT {keys}, count(*) AS n, min(value) AS lo, max(value) AS hi, "
        "stddev_samp(value) * pow(count(*), -0.2) AS h FROM " + src + f" GROUP BY {keys} "
        "HAVING count(*) > 1 AND stddev_samp(value) > 0)",
        f"{name}_g AS (SELECT b.*, k, {x0} + k * ({span}) / {points - 1} AS x FROM {name}_b b, "
        f"range(0, {points}) t(k))",
        f"{name} AS (SELECT " + ", ".join(f"g.{c.strip()}" for c in keys.split(",")) +
        ", g.k, g.x, sum(exp(-0.5 * ((g.x - s.value) / g.h) * ((g.x - s.value) / g.h))) / "
        f"(max(g.n) * max(g.h) * {SQRT_2PI!r}) AS density FROM {name}_g g JOIN ({src}) s ON "
        + " AND ".join(f"s.{c.strip()} = g.{c.strip()}" for c in keys.split(",")) +
        f" GROUP BY " + ", ".join(f"g.{c.strip()}" for c in keys.split(",")) + ", g.k, g.x)",
    ]


DRIFT_SRC = ("(SELECT cohort, feature, value FROM scaled WHERE split = 'train' AND feature IN "
             "(SELECT feature FROM corr_rank WHERE rank <= 10))")


@register("drift_density", _sql(
    f"SELECT cohort, feature, CAST(k AS INTEGER) AS k, {r('x')} AS x, {r('density', 9)} AS density FROM kd",
    [*_corr_sql(), *_kde_sql(DRIFT_SRC, "cohort, feature", 1000, None, "kd")]))
def drift_density(spark, sf_dir):
    """KDE curves (1000 points) of the top-10 |r| features, D1
    train vs D2 train."""
    top = _top10_corr_features(_d1_train_long(spark, sf_dir))
    tr = prepared_long(spark, sf_dir, top, split="train")
    k = sx.kde_curve(tr.select("cohort", "feature", "value"), ["cohort"], 1000)
    return rounded(k.withColumn("k", F.col("k").cast("int")), per={"density": 9})


@register("variance_top10", _sql(
    f"SELECT feature, {r('var_samp(value)')} AS variance FROM scaled WHERE cohort = 'D1' AND split = 'train' "
    "GROUP BY feature ORDER BY round(var_samp(value), 9) DESC NULLS LAST, feature LIMIT 10"))
def variance_top10(spark, sf_dir):
    """Ten highest-variance features on D1 train."""
    return rounded(sx.variance_rank(_d1_train_long(spark, sf_dir), 10))


def _hist_sql(src: str, keys: str, bins: int, name: str) -> list[str]:
    ks = [c.strip() for c in keys.split(",")]
    on = " AND ".join(f"s.{c} = b.{c}" for c in ks)
    return [
        f"{name}_b0 AS (SELECT {keys}, count(*) AS n, min(value) AS lo0, max(value) AS hi0 FROM {src} GROUP BY {keys})",
        f"{name}_b AS (SELECT *, CASE WHEN hi0 = lo0 THEN lo0 - 0.5 ELSE lo0 END AS lo, "
        f"CASE WHEN hi0 = lo0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM {name}_b0)",
        f"{name}_c AS (SELECT " + ", ".join(f"b.{c}" for c in ks) +
        f", CAST(least(floor((s.value - b.lo) * {bins} / (b.hi - b.lo) + 1e-9) + 1, {bins}) AS INTEGER) AS bin, "
        f"count(*) AS cnt FROM {src} s JOIN {name}_b b ON {on} GROUP BY ALL)",
        f"{name} AS (SELECT " + ", ".join(f"b.{c}" for c in ks) +
        f", CAST(g.bin AS INTEGER) AS bin, b.lo + (g.bin - 1) * (b.hi - b.lo) / {bins} AS bin_lo, "
        f"b.lo + g.bin * (b.hi - b.lo) / {bins} AS bin_hi, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count, "
        f"coalesce(c.cnt, 0) / (b.n * (b.hi - b.lo) / {bins}) AS density FROM {name}_b b "
        f"CROSS JOIN range(1, {bins + 1}) g(bin) LEFT JOIN {name}_c c ON "
        + " AND ".join(f"c.{c} = b.{c}" for c in ks) + " AND c.bin = g.bin)",
    ]


VAR_SRC = ("(SELECT cohort, feature, value FROM scaled WHERE split = 'train' AND feature IN "
           "(SELECT feature FROM scaled WHERE cohort = 'D1' AND split = 'train' GROUP BY feature "
           "ORDER BY round(var_samp(value), 9) DESC NULLS LAST, feature LIMIT 10))")


def _hist_final(keys):
    return (f"SELECT {keys}, bin, {r('bin_lo')} AS bin_lo, {r('bin_hi')} AS bin_hi, count, "
            f"{r('density')} AS density FROM h")


@register("drift_histogram", _sql(_hist_final("cohort, feature"),
                                  _hist_sql(VAR_SRC, "cohort, feature", 25, "h")))
def drift_histogram(spark, sf_dir):
    """X10 variant / X4: 25-bin density histograms of the ten highest-variance
    D1-train features, D1 train vs D2 train."""
    top = [r_["feature"] for r_ in sx.variance_rank(_d1_train_long(spark, sf_dir), 10).collect()]
    sub = prepared_long(spark, sf_dir, top, split="train")
    h = sx.histogram(sub.select("cohort", "feature", "value"), 25, ["cohort"])
    return rounded(h.select("cohort", "feature", F.col("bin").cast("int"), "bin_lo", "bin_hi",
                            "count", "density"))


AGE_SRC = "(SELECT cohort, label, feature, value FROM scaled WHERE feature = 'age')"


@register("age_histogram_by_label", _sql(_hist_final("cohort, label, feature"),
                                         _hist_sql(AGE_SRC, "cohort, label, feature", 30, "h")))
def age_histogram_by_label(spark, sf_dir):
    """30-bin age density histogram per cohort and label."""
    lg = prepared_long(spark, sf_dir, ["age"])
    h = sx.histogram(lg.select("cohort", "label", "feature", "value"), 30, ["cohort", "label"])
    return rounded(h.select("cohort", "label", "feature", F.col("bin").cast("int"), "bin_lo",
                            "bin_hi", "count", "density"))


@register("age_kde_by_label", _sql(
    f"SELECT cohort, label, feature, CAST(k AS INTEGER) AS k, {r('x')} AS x, {r('density', 9)} AS density FROM kd",
    _kde_sql(AGE_SRC, "cohort, label, feature", 1000, None, "kd")))
def age_kde_by_label(spark, sf_dir):
    """Age KDE (1000 points, Scott bandwidth) per cohort and label."""
    lg = prepared_long(spark, sf_dir, ["age"])
    k = sx.kde_curve(lg.select("cohort", "label", "feature", "value"), ["cohort", "label"], 1000)
    return rounded(k.withColumn("k", F.col("k").cast("int")), per={"density": 9})


def _box_sql(src: str, keys: str) -> str:
    tol = "1e-9 * greatest(1.0, abs(q3 - q1))"
    return (f"SELECT {keys}, CAST(count(value) AS BIGINT) AS n, {r('q1')} AS q1, {r('med')} AS median, "
            f"{r('q3')} AS q3, {r('min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) - TOL AND value <= q3 + 1.5 * (q3 - q1) + TOL)')} AS whisker_lo, "
            f"{r('max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) - TOL AND value <= q3 + 1.5 * (q3 - q1) + TOL)')} AS whisker_hi, "
            "CAST(count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) - TOL OR value > q3 + 1.5 * (q3 - q1) + TOL) AS BIGINT) AS n_outliers, "
            f"{r('min(value)')} AS min, {r('max(value)')} AS max FROM (SELECT *, "
            f"quantile_cont(value, 0.25) OVER (PARTITION BY {keys}) AS q1, "
            f"quantile_cont(value, 0.5) OVER (PARTITION BY {keys}) AS med, "
            f"quantile_cont(value, 0.75) OVER (PARTITION BY {keys}) AS q3 FROM {src}) "
            f"GROUP BY {keys}, q1, med, q3").replace("TOL", tol)


UTIL_SRC = ("(SELECT s.cohort, s.label, s.feature, least(s.value, c.cap) AS value FROM scaled s JOIN "
            "(SELECT cohort, feature, quantile_cont(value, 0.99) AS cap FROM scaled GROUP BY cohort, feature) c "
            f"ON c.cohort = s.cohort AND c.feature = s.feature WHERE s.feature IN {_in(UTIL_FEATURES)})")


@register("utilization_box_stats", _sql(_box_sql(UTIL_SRC, "cohort, label, feature")))
def utilization_box_stats(spark, sf_dir):
    """Utilisation columns capped at each cohort's p99, then
    box-plot statistics per label."""
    lg = prepared_long(spark, sf_dir, UTIL_FEATURES)
    capped = sx.clip_at_quantile(lg.select("cohort", "label", "feature", "value"), 0.99, ["cohort"])
    return rounded(sx.box_stats(capped, ["cohort", "label"]))


INCOME_SRC = "(SELECT cohort, label, feature, value FROM scaled WHERE feature = 'INCOME')"


@register("income_box_by_label", _sql(_box_sql(INCOME_SRC, "cohort, label, feature")))
def income_box_by_label(spark, sf_dir):
    """INCOME box statistics per cohort and label."""
    lg = prepared_long(spark, sf_dir, ["INCOME"])
    return rounded(sx.box_stats(lg.select("cohort", "label", "feature", "value"), ["cohort", "label"]))


def _in_panel(name: str) -> bool:
    """Named clinical panel plus, as stand-in panel, the surviving observation
    columns and the average-cost columns."""
    return name in CLINICAL_FEATURES or name.startswith(("avg_", "obs_"))


PANEL_SRC = ("(SELECT cohort, label, feature, value FROM scaled WHERE feature IN "
             f"{_in(CLINICAL_FEATURES)} OR starts_with(feature, 'avg_') OR starts_with(feature, 'obs_'))")


@register("clinical_box_stats", _sql(_box_sql(PANEL_SRC, "cohort, label, feature")))
def clinical_box_stats(spark, sf_dir):
    """Box statistics of the clinical panel per cohort and label
    (named panel when present, else every observation mean)."""
    lg = prepared_long(spark, sf_dir, keep=_in_panel)
    return rounded(sx.box_stats(lg.select("cohort", "label", "feature", "value"), ["cohort", "label"]))


@register("violin_density", _sql(
    f"SELECT cohort, label, feature, CAST(k AS INTEGER) AS k, {r('x')} AS x, {r('density', 9)} AS density FROM kd",
    _kde_sql(PANEL_SRC, "cohort, label, feature", 100, 0.0, "kd")))
def violin_density(spark, sf_dir):
    """Violin curves -- KDE on 100 points within the data range."""
    lg = prepared_long(spark, sf_dir, keep=_in_panel)
    k = sx.kde_curve(lg.select("cohort", "label", "feature", "value"), ["cohort", "label"], 100,
                     cut=0.0)
    return rounded(k.withColumn("k", F.col("k").cast("int")), per={"density": 9})


_GAPS = ["balance", "n_orders", "spent", "largest"]
_GAPS_SQL = ("SELECT c.c_custkey, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DOUBLE) END AS balance, "
             "CAST(o.n AS DOUBLE) AS n_orders, CAST(o.spent AS DOUBLE) AS spent, "
             "CASE WHEN o.n > 5 THEN CAST(o.largest AS DOUBLE) END AS largest FROM customer c LEFT JOIN "
             "(SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spent, max(o_totalprice) AS largest FROM orders "
             "GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey")


@register("corr_pairwise_complete", f"WITH g AS ({_GAPS_SQL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})')} AS r FROM g"
    for i, a in enumerate(_GAPS) for b in _GAPS[:i]))
def corr_pairwise_complete(spark, sf_dir):
    """X2 on columns with missing values: each pair over the rows that have both."""
    orders = read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.sum("o_totalprice").cast("double").alias("spent"),
        F.max("o_totalprice").cast("double").alias("most"))
    frame = read_table(spark, sf_dir, "customer").join(orders, "c_custkey", "left").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("double")).alias("balance"), "n_orders", "spent",
        F.when(F.col("n_orders") > 5, F.col("most")).alias("largest"))
    return rounded(sx.corr_matrix_lower(frame, _GAPS).select("feature_a", "feature_b", "r"))
