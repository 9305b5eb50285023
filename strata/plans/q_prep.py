"""Registered queries: preprocessing chain (A21-A24, A32, A34, B2, J6, J7,
P3-P7, T2, W1, W2, W5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import balance as ba
from strata.operators import features as fe
from strata.operators import preprocess as pp
from strata.plans import q_features as qf
from strata.plans.common import compose, r, register, rounded
from strata.plans.workflow import cohort_frames, labelled_matrix, prepare_cohorts
from strata.sources import standins as st

KEY = "PATIENT"
VIEWS = tuple(dict.fromkeys([*qf.MATRIX_VIEWS, "encounters", "conditions"]))
VARIANT_VIEWS = tuple(dict.fromkeys([*qf.VARIANT_VIEWS, "encounters", "conditions"]))
MD5 = "md5(CAST(PATIENT AS VARCHAR) || '-42')"


def prep_ctes(inclusive: bool = False, variant: bool = False) -> list[str]:
    """Oracle chain in long form: cohorts -> missing shares -> kept features
    -> medians -> split -> imputed grid -> scaler -> scaled values.

    ``variant``: variant matrix, keep < 50 %, both cohorts use the features
    kept in both (no zero-filled columns)."""
    drop = ">=" if (inclusive or variant) else ">"
    final = ("final_feats AS (SELECT 'D1' AS cohort, feature FROM common_kept "
             "UNION ALL SELECT 'D2', feature FROM common_kept)") if variant else (
            "final_feats AS (SELECT 'D1' AS cohort, feature FROM kept WHERE cohort = 'D1' "
            "UNION ALL SELECT 'D2', feature FROM kept WHERE cohort = 'D1')")
    common = ["common_kept AS (SELECT feature FROM kept WHERE cohort = 'D1' "
              "INTERSECT SELECT feature FROM kept WHERE cohort = 'D2')"] if variant else []
    return [
        qf.variant_matrix_long_ctes("matrix_long") if variant else qf.matrix_long_ctes(),
        f"l AS ({qf.LABELLED_SQL})",
        "coh AS (SELECT 'D1' AS cohort, PATIENT, label FROM l WHERE in_d1 "
        "UNION ALL SELECT 'D2', PATIENT, label FROM l WHERE in_d2)",
        "csize AS (SELECT cohort, count(*) AS n FROM coh GROUP BY cohort)",
        "features_all AS (SELECT DISTINCT feature FROM matrix_long)",
        "cvals AS (SELECT c.cohort, c.PATIENT, c.label, m.feature, m.value FROM coh c "
        "JOIN matrix_long m ON c.PATIENT = m.PATIENT WHERE m.value IS NOT NULL)",
        "miss AS (SELECT s.cohort, f.feature, (s.n - coalesce(v.nn, 0)) * 1.0 / s.n AS frac "
        "FROM csize s CROSS JOIN features_all f LEFT JOIN (SELECT cohort, feature, count(*) AS nn "
        "FROM cvals GROUP BY cohort, feature) v ON v.cohort = s.cohort AND v.feature = f.feature)",
        f"kept AS (SELECT cohort, feature FROM miss WHERE NOT (frac {drop} 0.5))",
        *common,
        final,
        "med AS (SELECT cohort, feature, quantile_cont(value, 0.5) AS med FROM cvals GROUP BY cohort, feature)",
        "ranked AS (SELECT cohort, PATIENT, label, row_number() OVER (PARTITION BY cohort, label "
        f"ORDER BY {MD5}, PATIENT) AS rn FROM coh)",
        "quota AS (SELECT cohort, label, count(*) AS nc, sum(count(*)) OVER (PARTITION BY cohort) AS n, "
        "CAST(ceil(CAST(0.2 AS DOUBLE) * sum(count(*)) OVER (PARTITION BY cohort)) AS BIGINT) AS t "
        "FROM coh GROUP BY cohort, label)",
        "alloc AS (SELECT cohort, label, base + CASE WHEN row_number() OVER (PARTITION BY cohort ORDER BY rem DESC, "
        "label) <= t - sum(base) OVER (PARTITION BY cohort) THEN 1 ELSE 0 END AS ntest "
        "FROM (SELECT *, nc * t // n AS base, nc * t % n AS rem FROM quota))",
        "splits AS (SELECT r.cohort, r.PATIENT, r.label, CASE WHEN r.rn <= a.ntest THEN 'test' "
        "ELSE 'train' END AS split FROM ranked r JOIN alloc a ON a.cohort = r.cohort AND a.label = r.label)",
        "imputed AS (SELECT s.cohort, s.split, s.PATIENT, s.label, f.feature, "
        "CASE WHEN k.feature IS NULL THEN 0.0 ELSE coalesce(v.value, md.med) END AS value "
        "FROM splits s JOIN final_feats f ON f.cohort = s.cohort "
        "LEFT JOIN kept k ON k.cohort = s.cohort AND k.feature = f.feature "
        "LEFT JOIN cvals v ON v.cohort = s.cohort AND v.PATIENT = s.PATIENT AND v.feature = f.feature "
        "LEFT JOIN med md ON md.cohort = s.cohort AND md.feature = f.feature)",
        "scaler AS (SELECT cohort, feature, avg(value) AS mean, stddev_pop(value) AS std "
        "FROM imputed WHERE split = 'train' GROUP BY cohort, feature)",
        "scaled AS (SELECT i.cohort, i.split, i.PATIENT, i.label, i.feature, "
        "(i.value - sc.mean) / CASE WHEN sc.std = 0 THEN 1.0 ELSE sc.std END AS value "
        "FROM imputed i JOIN scaler sc ON sc.cohort = i.cohort AND sc.feature = i.feature)",
    ]


def _sql(final: str, inclusive: bool = False, extra=()) -> str:
    return compose(VIEWS, [*prep_ctes(inclusive), *extra], final)


def _fracs_frame(spark, m):
    rows = []
    for name, f in cohort_frames(m).items():
        feats = fe.feature_columns(f)
        for c, v in pp.missing_fractions(f, feats).items():
            rows.append((name, c, float(v)))
    return spark.createDataFrame(rows, "cohort string, feature string, missing_frac double")


@register("missing_fraction", _sql(f"SELECT cohort, feature, {r('frac')} AS missing_frac FROM miss"))
def missing_fraction(spark, sf_dir):
    """Share of NULLs per feature column in each cohort (one-row
    aggregate per cohort; the small result is tabulated)."""
    m = labelled_matrix(spark, sf_dir)
    return rounded(_fracs_frame(spark, m))


@register("sparse_columns", _sql(
    f"SELECT cohort, feature, {r('frac * 100', 3)} AS missing_pct, frac > 0.5 AS dropped FROM miss"))
def sparse_columns(spark, sf_dir):
    """Dropped-column report with percent missing."""
    m = labelled_matrix(spark, sf_dir)
    fr = _fracs_frame(spark, m)
    return rounded(fr.select("cohort", "feature", (F.col("missing_frac") * 100).alias("missing_pct"),
                             (F.col("missing_frac") > pp.MISSING_THRESHOLD).alias("dropped")), 3)


@register("missing_top20", _sql(
    f"SELECT feature, {r('frac')} AS missing_frac FROM miss WHERE cohort = 'D1' "
    "ORDER BY frac DESC, feature LIMIT 20"))
def missing_top20(spark, sf_dir):
    """T2 (variant report): 20 most-missing D1 columns before filtering."""
    m = labelled_matrix(spark, sf_dir)
    fr = _fracs_frame(spark, m).filter(F.col("cohort") == "D1")
    return rounded(fr.orderBy(F.desc("missing_frac"), "feature").limit(20)
                     .select("feature", "missing_frac"))


@register("observation_missingness", compose(
    ["patients", "observations"], [qf.NUM_CTE, qf.TOTAL_CTE],
    "SELECT DESCRIPTION, " + r("(1 - count(DISTINCT PATIENT) * 1.0 / (SELECT n FROM total)) * 100")
    + " AS missing_pct, (1 - count(DISTINCT PATIENT) * 1.0 / (SELECT n FROM total)) > 0.5 AS over_half "
    "FROM num GROUP BY DESCRIPTION"))
def observation_missingness(spark, sf_dir):
    """Percent of patients without any numeric observation of a type."""
    t = st.load_ehr(spark, sf_dir)
    n = fe.patient_spine(t["patients"]).count()
    cov = fe.observation_coverage(fe.numeric_observations(t["observations"]))
    miss = (F.lit(1.0) - F.col("n_patients") / F.lit(float(n)))
    return rounded(cov.select("DESCRIPTION", (miss * 100).alias("missing_pct"),
                              (miss > 0.5).alias("over_half")))


@register("cohort_medians", _sql(
    f"SELECT m.cohort, m.feature, {r('m.med')} AS median FROM med m JOIN kept k "
    "ON k.cohort = m.cohort AND k.feature = m.feature"))
def cohort_medians(spark, sf_dir):
    """Exact medians of every surviving feature per cohort."""
    m = labelled_matrix(spark, sf_dir)
    rows = []
    for name, f in cohort_frames(m).items():
        feats = fe.feature_columns(f)
        fr = pp.missing_fractions(f, feats)
        kept = [c for c in feats if c not in pp.sparse_columns(fr)]
        for c, v in pp.column_medians(f, kept).items():
            if v is not None:
                rows.append((name, c, float(v)))
    return rounded(spark.createDataFrame(rows, "cohort string, feature string, median double"))


@register("feature_modes", _sql(
    "SELECT feature, " + r("min(value) FILTER (WHERE cnt = best)") + " AS mode, "
    "CAST(max(best) AS BIGINT) AS count FROM (SELECT feature, value, cnt, max(cnt) OVER (PARTITION BY feature) AS best "
    "FROM (SELECT feature, round(value, 6) AS value, count(*) AS cnt FROM cvals WHERE cohort = 'D1' "
    "GROUP BY feature, round(value, 6))) "
    "GROUP BY feature"))
def feature_modes(spark, sf_dir):
    """Most frequent value per D1 feature, smallest among ties.

    Values are compared at 1e-6 so that computed means equal in exact
    arithmetic count as one value in every engine.
    """
    m = labelled_matrix(spark, sf_dir)
    d1 = cohort_frames(m)["D1"]
    feats = fe.feature_columns(d1)
    long = d1.select(*[F.round(F.col(f"`{c}`").cast("double"), 6).alias(c) for c in feats]).unpivot(
        [], feats, "feature", "value")
    return rounded(pp.column_modes(long).select("feature", "mode", F.col("count").cast("bigint")))


@register("stratified_split", _sql("SELECT cohort, PATIENT, label, split FROM splits"))
def stratified_split(spark, sf_dir):
    """Exact per-class 80/20 split by shuffle key."""
    m = labelled_matrix(spark, sf_dir)
    out = None
    for name, f in cohort_frames(m).items():
        s = pp.stratified_split(f.select(KEY, "label")).withColumn("cohort", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out.select("cohort", KEY, "label", "split")


@register("split_summary", _sql(
    "SELECT cohort, split, CAST(count(*) AS BIGINT) AS n_rows, "
    "CAST(count(*) FILTER (WHERE label = 0) AS BIGINT) AS n0, "
    "CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS n1, "
    + r("avg(label) * 100", 3) + " AS pct_positive FROM splits GROUP BY cohort, split"))
def split_summary(spark, sf_dir):
    """Rows, class counts and positive share per cohort x split."""
    s = QUERIES_LOCAL["stratified_split"](spark, sf_dir)
    return rounded(s.groupBy("cohort", "split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("label") == 0).alias("n0"),
        F.count_if(F.col("label") == 1).alias("n1"),
        (F.avg("label") * 100).alias("pct_positive")), 3)


@register("fold_assignment", _sql(
    "SELECT cohort, PATIENT, label, CAST((row_number() OVER (PARTITION BY cohort, label "
    f"ORDER BY {MD5}, PATIENT) - 1) % 5 AS INTEGER) AS fold FROM splits WHERE split = 'train'"))
def fold_assignment(spark, sf_dir):
    """Stratified 5-fold ids over each cohort's training rows."""
    s = QUERIES_LOCAL["stratified_split"](spark, sf_dir).filter(F.col("split") == "train")
    return pp.fold_assignment(s, 5, group_cols=["cohort"]).select("cohort", KEY, "label", "fold")


@register("scaler_params", _sql(
    f"SELECT cohort, feature, {r('mean')} AS mean, {r('std')} AS std FROM scaler"))
def scaler_params(spark, sf_dir):
    """Train-fitted mean and population std per cohort feature."""
    prepared = prepare_cohorts(spark, sf_dir)
    rows = [(n, c, float(m) if m is not None else None, float(s) if s is not None else None)
            for n, p in prepared.items() for c, (m, s) in p.scaler.items()]
    return rounded(spark.createDataFrame(rows, "cohort string, feature string, mean double, std double"))


@register("scaled_features", _sql(
    f"SELECT cohort, split, PATIENT, label, feature, {r('value')} AS value FROM scaled"))
def scaled_features(spark, sf_dir):
    """The whole chain; long form of the scaled train/test rows."""
    prepared = prepare_cohorts(spark, sf_dir)
    out = None
    for name, p in prepared.items():
        long = (p.frame.select(KEY, "label", "split", *[F.col(f"`{c}`").cast("double").alias(c)
                                                       for c in p.features])
                 .unpivot([KEY, "label", "split"], p.features, "feature", "value")
                 .withColumn("cohort", F.lit(name)))
        out = long if out is None else out.unionByName(long)
    return rounded(out.select("cohort", "split", KEY, "label", "feature", "value"))


@register("aligned_features", _sql(
    "SELECT f.feature, k2.feature IS NOT NULL AS in_d2, "
    "CASE WHEN k2.feature IS NULL THEN 'zero_fill' ELSE 'data' END AS d2_source "
    "FROM final_feats f LEFT JOIN kept k2 ON k2.cohort = 'D2' AND k2.feature = f.feature "
    "WHERE f.cohort = 'D2'"))
def aligned_features(spark, sf_dir):
    """D1's feature list and how D2 fills each column."""
    m = labelled_matrix(spark, sf_dir)
    fr = cohort_frames(m)
    kept = {}
    for name, f in fr.items():
        feats = fe.feature_columns(f)
        frac = pp.missing_fractions(f, feats)
        kept[name] = [c for c in feats if c not in pp.sparse_columns(frac)]
    d2 = set(kept["D2"])
    rows = [(c, c in d2, "data" if c in d2 else "zero_fill") for c in kept["D1"]]
    return spark.createDataFrame(rows, "feature string, in_d2 boolean, d2_source string")


@register("variant_common_features", _sql(
    "SELECT feature FROM kept WHERE cohort = 'D1' INTERSECT SELECT feature FROM kept WHERE cohort = 'D2'",
    inclusive=True))
def variant_common_features(spark, sf_dir):
    """J7 / P3a variant: features kept (< 50 % missing) in both cohorts."""
    m = labelled_matrix(spark, sf_dir)
    kept = {}
    for name, f in cohort_frames(m).items():
        feats = fe.feature_columns(f)
        frac = pp.missing_fractions(f, feats)
        kept[name] = [c for c in feats if c not in pp.sparse_columns(frac, inclusive=True)]
    common = pp.common_features(kept["D1"], kept["D2"])
    return spark.createDataFrame([(c,) for c in common], "feature string")


@register("label_encode", compose(["patients"], [], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS value, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'Unknown') AS v FROM patients)"
    for c in fe.CATEGORICAL)))
def label_encode(spark, sf_dir):
    """Code table of every categorical demographic column."""
    from strata.operators.ranking import dense_rank_values
    p = st.load_ehr(spark, sf_dir)["patients"]
    out = None
    for c in fe.CATEGORICAL:
        vals = p.select(F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias("value"))
        codes = dense_rank_values(vals, "value", out="code").withColumn("column_name", F.lit(c))
        out = codes if out is None else out.unionByName(codes)
    return out.select("column_name", "value", "code")


@register("class_weights", _sql(
    "SELECT cohort, label, CAST(count(*) AS BIGINT) AS n, "
    + r("sum(count(*)) OVER (PARTITION BY cohort) / (2.0 * count(*))")
    + " AS weight FROM splits WHERE split = 'train' GROUP BY cohort, label"))
def class_weights(spark, sf_dir):
    """B2: balanced class weights n / (2 n_c) on each cohort's train rows."""
    s = QUERIES_LOCAL["stratified_split"](spark, sf_dir).filter(F.col("split") == "train")
    return rounded(ba.class_weight_table(s, group_cols=["cohort"]))


QUERIES_LOCAL = {"stratified_split": stratified_split}


@register("scaled_features_variant", compose(VARIANT_VIEWS, prep_ctes(variant=True),
    f"SELECT cohort, split, PATIENT, label, feature, {r('value')} AS value FROM scaled"))
def scaled_features_variant(spark, sf_dir):
    """P3 variant: variant matrix, drop >= 50 % missing per cohort, impute,
    keep the features common to both cohorts (J7), split, scale."""
    prepared = prepare_cohorts(spark, sf_dir, mode="variant")
    out = None
    for name, p in prepared.items():
        long = (p.frame.select(KEY, "label", "split", *[F.col(f"`{c}`").cast("double").alias(c)
                                                       for c in p.features])
                 .unpivot([KEY, "label", "split"], p.features, "feature", "value")
                 .withColumn("cohort", F.lit(name)))
        out = long if out is None else out.unionByName(long)
    return rounded(out.select("cohort", "split", KEY, "label", "feature", "value"))
