"""Registered queries: feature aggregates, observation pivots, matrix, label,
cohorts (A1-A20, A25, A33, J1-J5, P1, P2, U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import cohorts as co
from strata.operators import features as fe
from strata.plans.common import compose, long_form, r, register, rounded
from strata.sources import standins as st

KEY = "PATIENT"
CUT = st.STANDIN_CUTOFF
REF = st.STANDIN_REF_DATE
LABEL_RE = st.STANDIN_LABEL_PATTERN

# Query name -> source table for the per-table aggregates.
TABLE_QUERIES = {
    "encounter_features": "encounters",
    "medication_features": "medications",
    "procedure_features": "procedures",
    "immunization_features": "immunizations",
    "allergy_features": "allergies",
    "careplan_features": "careplans",
    "imaging_features": "imaging_studies",
    "device_features": "devices",
    "supply_features": "supplies",
    "payer_transition_features": "payer_transitions",
    "claim_features": "claims",
    "claim_transaction_features": "claims_transactions",
}

SPINE_SQL = "SELECT DISTINCT Id AS PATIENT FROM patients WHERE Id IS NOT NULL"


def spec_sql(view: str, spec: fe.TableSpec) -> str:
    sels = []
    for out, fn, c in spec.aggs:
        if fn == "count":
            sels.append(f"CAST(count({c}) AS BIGINT) AS {out}")
        elif fn == "nunique":
            sels.append(f"CAST(count(DISTINCT {c}) AS BIGINT) AS {out}")
        elif fn == "mean":
            sels.append(f"avg(CAST({c} AS DOUBLE)) AS {out}")
        elif fn == "sum":
            sels.append(f"coalesce(sum(CAST({c} AS DOUBLE)), 0.0) AS {out}")
    return (f"SELECT {spec.key} AS PATIENT, {', '.join(sels)} FROM {view} "
            f"WHERE {spec.key} IS NOT NULL GROUP BY {spec.key}")


def _spine_join_sql(view: str, spec: fe.TableSpec) -> str:
    outs = []
    for out, fn, _ in spec.aggs:
        outs.append(r(f"a.{out}") + f" AS {out}" if fn in ("mean", "sum") else f"a.{out}")
    body = (f"SELECT s.PATIENT, {', '.join(outs)} FROM ({SPINE_SQL}) s "
            f"LEFT JOIN ({spec_sql(view, spec)}) a ON s.PATIENT = a.PATIENT")
    return compose(["patients", view], [], body)


def _make_table_query(view: str, spec: fe.TableSpec):
    def q(spark, sf_dir):
        t = st.load_ehr(spark, sf_dir)
        spine = fe.patient_spine(t["patients"])
        return rounded(spine.join(fe.aggregate_table(t[view], spec), KEY, "left"))
    return q


for _qname, _view in TABLE_QUERIES.items():
    register(_qname, _spine_join_sql(_view, fe.CANONICAL_SPECS[_view]))(
        _make_table_query(_view, fe.CANONICAL_SPECS[_view]))

for _qname, _view in (("claim_features_variant", "claims"),
                      ("imaging_features_variant", "imaging_studies"),
                      ("medication_features_variant", "medications")):
    register(_qname, _spine_join_sql(_view, fe.VARIANT_SPECS[_view]))(
        _make_table_query(_view, fe.VARIANT_SPECS[_view]))


# ------------------------------------------------------------ observations

NUM_OBS_SQL = (
    "SELECT PATIENT, DESCRIPTION, CAST(trim(VALUE) AS DOUBLE) AS v FROM observations "
    "WHERE regexp_matches(VALUE, '^\\s*[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\\s*$') "
    "AND PATIENT IS NOT NULL")
SANITIZE_SQL = "trim(regexp_replace({c}, '[^a-zA-Z0-9_]', '_', 'g'), '_')"


NUM_CTE = f"num AS ({NUM_OBS_SQL})"
TOTAL_CTE = f"total AS (SELECT count(*) AS n FROM ({SPINE_SQL}) s)"


@register("observation_coverage", compose(["patients", "observations"], [NUM_CTE, TOTAL_CTE], """
SELECT DESCRIPTION, CAST(count(DISTINCT PATIENT) AS BIGINT) AS n_patients,
       CAST(ceil(0.05 * (SELECT n FROM total)) AS BIGINT) AS min_patients,
       count(DISTINCT PATIENT) >= ceil(0.05 * (SELECT n FROM total)) AS is_common
FROM num GROUP BY DESCRIPTION"""))
def observation_coverage(spark, sf_dir):
    t = st.load_ehr(spark, sf_dir)
    n = fe.patient_spine(t["patients"]).count()
    need = fe.coverage_threshold(n)
    cov = fe.observation_coverage(fe.numeric_observations(t["observations"]))
    return cov.select("DESCRIPTION", F.col("n_patients").cast("bigint"),
                      F.lit(need).cast("bigint").alias("min_patients"),
                      (F.col("n_patients") >= need).alias("is_common"))


def _obs_long_sql() -> str:
    san = SANITIZE_SQL.format(c="DESCRIPTION")
    return f"""
{NUM_CTE},
{TOTAL_CTE},
common AS (SELECT DESCRIPTION FROM num GROUP BY DESCRIPTION
           HAVING count(DISTINCT PATIENT) >= ceil(0.05 * (SELECT n FROM total))),
agg AS (SELECT PATIENT, DESCRIPTION, avg(v) AS m, var_samp(v) AS s FROM num
        WHERE DESCRIPTION IN (SELECT DESCRIPTION FROM common) GROUP BY PATIENT, DESCRIPTION),
obs_long AS (
  SELECT PATIENT, 'obs_' || {san} || '_mean' AS feature, m AS value FROM agg
  UNION ALL
  SELECT PATIENT, 'obs_' || {san} || '_var' AS feature, s AS value FROM agg WHERE s IS NOT NULL)"""


def _with(body_ctes: str, final: str, *views: str) -> str:
    return compose(views, [body_ctes], final)


@register("observation_pivot_mean_var", _with(
    _obs_long_sql(), f"SELECT PATIENT, feature, {r('value')} AS value FROM obs_long",
    "patients", "observations"))
def observation_pivot_mean_var(spark, sf_dir):
    t = st.load_ehr(spark, sf_dir)
    n = fe.patient_spine(t["patients"]).count()
    wide = fe.observation_features(t["observations"], n)
    return rounded(long_form(wide, [KEY]))


def _obs_variant_sql() -> str:
    return f"""
{NUM_CTE},
per AS (SELECT PATIENT, DESCRIPTION, avg(v) AS m, stddev_samp(v) AS s,
        left(regexp_replace(DESCRIPTION, '[^a-zA-Z0-9]', '_', 'g'), 40) AS dkey
        FROM num GROUP BY PATIENT, DESCRIPTION),
piv AS (SELECT PATIENT, dkey, avg(m) AS m, avg(s) AS s FROM per GROUP BY PATIENT, dkey),
npiv AS (SELECT count(DISTINCT PATIENT) AS n FROM per),
vlong AS (SELECT PATIENT, 'obs_' || dkey || '_mean' AS feature, m AS value FROM piv
          UNION ALL SELECT PATIENT, 'obs_' || dkey || '_var', s FROM piv),
keep AS (SELECT feature FROM vlong GROUP BY feature
         HAVING count(value) * 1.0 / (SELECT n FROM npiv) >= 0.05)"""


@register("observation_pivot_variant", _with(
    _obs_variant_sql(),
    f"SELECT PATIENT, feature, {r('value')} AS value FROM vlong "
    "WHERE value IS NOT NULL AND feature IN (SELECT feature FROM keep)",
    "observations"))
def observation_pivot_variant(spark, sf_dir):
    t = st.load_ehr(spark, sf_dir)
    return rounded(long_form(fe.observation_features_variant(t["observations"]), [KEY]))


# ------------------------------------------------------------ full matrix

def _demo_sql(null_category: str = "Unknown", variant: bool = False, name: str = "demo_long") -> str:
    """Demographics in long form (oracle)."""
    enc = lambda c: (f"(SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
                     f"(SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), '{null_category}') AS v FROM patients))")
    days = f"floor(epoch(TIMESTAMP '{REF}' - CAST(BIRTHDATE AS TIMESTAMP)) / 86400)"
    age = f"CAST(floor({days} / 365) AS DOUBLE)" if variant else f"round({days} / 365.25, 1)"
    parts = [
        f"SELECT Id AS PATIENT, 'age' AS feature, {age} AS value FROM patients",
        "SELECT Id, 'is_deceased', CAST(DEATHDATE IS NOT NULL AS INTEGER) FROM patients",
        "SELECT Id, 'INCOME', INCOME FROM patients",
        "SELECT Id, 'HEALTHCARE_COVERAGE', HEALTHCARE_COVERAGE FROM patients",
    ]
    for c in fe.CATEGORICAL:
        parts.append(f"SELECT p.Id, '{c}', e.code FROM patients p JOIN {enc(c)} e "
                     f"ON coalesce(CAST(p.{c} AS VARCHAR), '{null_category}') = e.v")
    return f"{name} AS (" + "\nUNION ALL ".join(parts) + ")"


def _table_long_sql(specs=None, name: str = "tables_long") -> str:
    parts = []
    for view, spec in (specs or fe.CANONICAL_SPECS).items():
        agg = spec_sql(view, spec)
        for out, _, _ in spec.aggs:
            parts.append(f"SELECT PATIENT, '{out}' AS feature, CAST({out} AS DOUBLE) AS value FROM ({agg}) a_{out}")
    return f"{name} AS (" + "\nUNION ALL ".join(parts) + ")"


MATRIX_VIEWS = ("patients", "observations", *fe.CANONICAL_SPECS.keys())


def matrix_long_ctes() -> str:
    return ",\n".join([_obs_long_sql().strip(), _demo_sql(), _table_long_sql(),
                       "matrix_long AS (SELECT PATIENT, feature, CAST(value AS DOUBLE) AS value FROM obs_long "
                       "UNION ALL SELECT PATIENT, feature, CAST(value AS DOUBLE) FROM demo_long "
                       "UNION ALL SELECT PATIENT, feature, value FROM tables_long)"])


@register("feature_matrix", _with(
    matrix_long_ctes(),
    f"SELECT PATIENT, feature, {r('value')} AS value FROM matrix_long WHERE value IS NOT NULL",
    *MATRIX_VIEWS))
def feature_matrix(spark, sf_dir):
    """P1 in long form, read from the session's checkpointed labelled matrix."""
    from strata.plans.workflow import labelled_matrix
    m = labelled_matrix(spark, sf_dir)
    return rounded(long_form(m.drop("label", "earliest_enc", "latest_enc", "in_d1", "in_d2"), [KEY]))


@register("existence_label", compose(["patients", "conditions"], [],
    f"SELECT s.PATIENT, CAST(CASE WHEN p.PATIENT IS NULL THEN 0 ELSE 1 END AS INTEGER) AS label "
    f"FROM ({SPINE_SQL}) s LEFT JOIN (SELECT DISTINCT PATIENT FROM conditions "
    f"WHERE regexp_matches(DESCRIPTION, '{LABEL_RE}') AND PATIENT IS NOT NULL) p "
    f"ON s.PATIENT = p.PATIENT"))
def existence_label(spark, sf_dir):
    t = st.load_ehr(spark, sf_dir)
    return co.attach_label(fe.patient_spine(t["patients"]), t["conditions"], LABEL_RE)


BOUNDS_SQL = ("SELECT PATIENT, min(START) AS earliest_enc, max(START) AS latest_enc "
              "FROM encounters WHERE PATIENT IS NOT NULL GROUP BY PATIENT")


@register("date_bounds", compose(["patients", "encounters"], [],
    f"SELECT s.PATIENT, b.earliest_enc, b.latest_enc FROM ({SPINE_SQL}) s "
    f"LEFT JOIN ({BOUNDS_SQL}) b ON s.PATIENT = b.PATIENT"))
def date_bounds(spark, sf_dir):
    t = st.load_ehr(spark, sf_dir)
    return fe.patient_spine(t["patients"]).join(co.encounter_bounds(t["encounters"]), KEY, "left")


FLAGS_SQL = (f"SELECT s.PATIENT, coalesce(b.earliest_enc < TIMESTAMP '{CUT}', false) AS in_d1, "
             f"coalesce(b.latest_enc >= TIMESTAMP '{CUT}', false) AS in_d2 FROM ({SPINE_SQL}) s "
             f"LEFT JOIN ({BOUNDS_SQL}) b ON s.PATIENT = b.PATIENT")


def _flags(spark, sf_dir):
    t = st.load_ehr(spark, sf_dir)
    f = fe.patient_spine(t["patients"]).join(co.encounter_bounds(t["encounters"]), KEY, "left")
    return co.cohort_flags(f, CUT), t


@register("temporal_cohorts", compose(["patients", "encounters"], [], FLAGS_SQL))
def temporal_cohorts(spark, sf_dir):
    f, _ = _flags(spark, sf_dir)
    return f.select(KEY, "in_d1", "in_d2")


@register("cohort_overlap", compose(["patients", "encounters"], [],
    f"SELECT CAST(count(*) FILTER (WHERE in_d1) AS BIGINT) AS d1_patients, "
    f"CAST(count(*) FILTER (WHERE in_d2) AS BIGINT) AS d2_patients, "
    f"CAST(count(*) FILTER (WHERE in_d1 AND in_d2) AS BIGINT) AS overlap_patients, "
    f"CAST(count(*) FILTER (WHERE NOT in_d1 AND NOT in_d2) AS BIGINT) AS neither_patients, "
    f"CAST(count(*) AS BIGINT) AS total_patients FROM ({FLAGS_SQL}) f"))
def cohort_overlap(spark, sf_dir):
    f, _ = _flags(spark, sf_dir)
    return co.cohort_sizes(f)


LABELLED_SQL = (f"SELECT f.PATIENT, f.in_d1, f.in_d2, "
                f"CAST(CASE WHEN p.PATIENT IS NULL THEN 0 ELSE 1 END AS INTEGER) AS label "
                f"FROM ({FLAGS_SQL}) f LEFT JOIN (SELECT DISTINCT PATIENT FROM conditions "
                f"WHERE regexp_matches(DESCRIPTION, '{LABEL_RE}') AND PATIENT IS NOT NULL) p "
                f"ON f.PATIENT = p.PATIENT")


@register("cohort_class_distribution", compose(
    ["patients", "encounters", "conditions"],
    [f"l AS ({LABELLED_SQL})",
     "t AS (SELECT 'D1' AS cohort, label FROM l WHERE in_d1 UNION ALL SELECT 'D2', label FROM l WHERE in_d2)",
     "c AS (SELECT cohort, label, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY cohort, label)"],
    f"SELECT cohort, label, n, {r('n * 100.0 / sum(n) OVER (PARTITION BY cohort)')} AS pct FROM c"))
def cohort_class_distribution(spark, sf_dir):
    f, t = _flags(spark, sf_dir)
    lab = co.attach_label(f, t["conditions"], LABEL_RE)
    return rounded(co.class_distribution(co.tagged_cohorts(lab)))


def _feature_order_sql() -> str:
    """Column order of the canonical matrix (oracle): demographics, encounter
    aggregates, observation means then variances (by description), tables."""
    static = [(c, i) for i, c in enumerate(fe.DEMOGRAPHIC_ORDER)]
    base = len(static)
    static += [(out, base + i) for i, (out, _, _) in enumerate(fe.CANONICAL_SPECS["encounters"].aggs)]
    k = 10_000
    for view, spec in fe.CANONICAL_SPECS.items():
        if view == "encounters":
            continue
        for out, _, _ in spec.aggs:
            static.append((out, k))
            k += 1
    values = ", ".join(f"('{n}', {o})" for n, o in static)
    san = SANITIZE_SQL.format(c="DESCRIPTION")
    return ("ords AS (SELECT * FROM (VALUES " + values + ") t(feature, ord) UNION ALL "
            f"SELECT 'obs_' || {san} || '_mean', 100 + row_number() OVER (ORDER BY DESCRIPTION) FROM common "
            f"UNION ALL SELECT 'obs_' || {san} || '_var', 100 + (SELECT count(*) FROM common) + "
            "row_number() OVER (ORDER BY DESCRIPTION) FROM common)")


VARIANT_VIEWS = ("patients", "observations", *fe.VARIANT_SPECS.keys())


def variant_matrix_long_ctes(name: str = "vmatrix") -> str:
    return ",\n".join([_obs_variant_sql().strip(), _demo_sql("nan", True, "vdemo"),
                       _table_long_sql(fe.VARIANT_SPECS, "vtables"),
                       f"{name} AS (SELECT PATIENT, feature, value FROM vlong WHERE feature IN "
                       "(SELECT feature FROM keep) "
                       "UNION ALL SELECT PATIENT, feature, CAST(value AS DOUBLE) FROM vdemo "
                       "UNION ALL SELECT PATIENT, feature, value FROM vtables)"])


@register("feature_matrix_variant", _with(
    variant_matrix_long_ctes(),
    f"SELECT PATIENT, feature, {r('value')} AS value FROM vmatrix WHERE value IS NOT NULL",
    *VARIANT_VIEWS))
def feature_matrix_variant(spark, sf_dir):
    """P1 variant: floor age, 'nan' category, variant counts/names, extra
    claim cost, truncated-key observation pivot with its own coverage rule."""
    from strata.plans.workflow import labelled_matrix
    m = labelled_matrix(spark, sf_dir, mode="variant")
    return rounded(long_form(m.drop("label", "earliest_enc", "latest_enc", "in_d1", "in_d2"), [KEY]))
