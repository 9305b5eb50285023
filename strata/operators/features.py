"""Per-entity feature aggregation and the wide feature matrix.

Each event table is reduced to one row per PATIENT with a declarative spec
(partial aggregation map-side, one shuffle on PATIENT; a hot patient only
ships one partial row per map task). The reduced tables are left-joined
onto the patient spine, a few at a time (``join_sides``); the inputs of a join
chain are hash-partitioned on PATIENT, so it adds no exchange beyond the
aggregates' own, and AQE broadcasts any side that turns out small at run time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.parse import lenient_double
from strata.functions.scalars import (age_floor_years, age_years, deceased_flag,
                                      sanitize_name, sanitize_name_truncated)
from strata.operators.ranking import dense_rank_values
from strata.session import materialize

KEY = "PATIENT"
BROADCAST_CODES = 100_000   # rows of a (counted) code table joined by broadcast
SIDES_AT_ONCE = 4           # sides of the matrix that one task joins


@dataclass(frozen=True)
class TableSpec:
    key: str                                   # entity key column in the table
    aggs: tuple[tuple[str, str, str], ...]     # (output, aggregate, input column)


# Feature names, aggregates and inputs of the canonical
# feature matrix, per source table, in the reference's join order.
CANONICAL_SPECS: dict[str, TableSpec] = {
    "encounters": TableSpec("PATIENT", (
        ("total_encounters", "count", "Id"),
        ("unique_encounter_types", "nunique", "ENCOUNTERCLASS"),
        ("avg_base_encounter_cost", "mean", "BASE_ENCOUNTER_COST"),
        ("total_claim_cost", "sum", "TOTAL_CLAIM_COST"),
        ("avg_payer_coverage", "mean", "PAYER_COVERAGE"))),
    "medications": TableSpec("PATIENT", (
        ("total_medications", "count", "DESCRIPTION"),
        ("unique_medications", "nunique", "DESCRIPTION"),
        ("avg_medication_cost", "mean", "BASE_COST"),
        ("total_dispenses", "sum", "DISPENSES"))),
    "procedures": TableSpec("PATIENT", (
        ("total_procedures", "count", "DESCRIPTION"),
        ("unique_procedures", "nunique", "DESCRIPTION"),
        ("avg_procedure_cost", "mean", "BASE_COST"))),
    "immunizations": TableSpec("PATIENT", (
        ("total_immunizations", "count", "DESCRIPTION"),
        ("unique_vaccines", "nunique", "DESCRIPTION"))),
    "allergies": TableSpec("PATIENT", (
        ("total_allergies", "count", "DESCRIPTION"),
        ("unique_allergy_types", "nunique", "TYPE"),
        ("unique_allergy_categories", "nunique", "CATEGORY"))),
    "careplans": TableSpec("PATIENT", (
        ("total_careplans", "count", "DESCRIPTION"),
        ("unique_careplan_reasons", "nunique", "REASONDESCRIPTION"))),
    "imaging_studies": TableSpec("PATIENT", (
        ("total_imaging_studies", "count", "Id"),
        ("unique_modalities", "nunique", "MODALITY_DESCRIPTION"),
        ("unique_body_sites", "nunique", "BODYSITE_DESCRIPTION"))),
    "devices": TableSpec("PATIENT", (
        ("total_devices", "count", "DESCRIPTION"),
        ("unique_device_types", "nunique", "DESCRIPTION"))),
    "supplies": TableSpec("PATIENT", (
        ("total_supplies", "count", "DESCRIPTION"),
        ("unique_supply_types", "nunique", "DESCRIPTION"))),
    "payer_transitions": TableSpec("PATIENT", (
        ("total_payer_transitions", "count", "PAYER"),
        ("unique_payers", "nunique", "PAYER"))),
    "claims": TableSpec("PATIENTID", (
        ("total_claims", "count", "Id"),)),
    "claims_transactions": TableSpec("PATIENTID", (
        ("total_transactions", "count", "ID"),
        ("total_transaction_amount", "sum", "AMOUNT"),
        ("unique_transaction_types", "nunique", "TYPE"))),
}

# The variant pipeline counts other columns, renames imaging
# and adds the average claim cost.
VARIANT_SPECS: dict[str, TableSpec] = {
    **CANONICAL_SPECS,
    "medications": TableSpec("PATIENT", (
        ("total_medications", "count", "START"),
        ("unique_medications", "nunique", "DESCRIPTION"),
        ("avg_medication_cost", "mean", "BASE_COST"),
        ("total_dispenses", "sum", "DISPENSES"))),
    "procedures": TableSpec("PATIENT", (
        ("total_procedures", "count", "START"),
        ("unique_procedures", "nunique", "DESCRIPTION"),
        ("avg_procedure_cost", "mean", "BASE_COST"))),
    "immunizations": TableSpec("PATIENT", (
        ("total_immunizations", "count", "DATE"),
        ("unique_vaccines", "nunique", "DESCRIPTION"))),
    "allergies": TableSpec("PATIENT", (
        ("total_allergies", "count", "START"),
        ("unique_allergy_types", "nunique", "TYPE"),
        ("unique_allergy_categories", "nunique", "CATEGORY"))),
    "careplans": TableSpec("PATIENT", (
        ("total_careplans", "count", "Id"),
        ("unique_careplan_reasons", "nunique", "REASONDESCRIPTION"))),
    "imaging_studies": TableSpec("PATIENT", (
        ("total_imaging", "count", "Id"),
        ("unique_modalities", "nunique", "MODALITY_DESCRIPTION"),
        ("unique_body_sites", "nunique", "BODYSITE_DESCRIPTION"))),
    "devices": TableSpec("PATIENT", (
        ("total_devices", "count", "START"),
        ("unique_device_types", "nunique", "DESCRIPTION"))),
    "supplies": TableSpec("PATIENT", (
        ("total_supplies", "count", "DATE"),
        ("unique_supply_types", "nunique", "DESCRIPTION"))),
    "payer_transitions": TableSpec("PATIENT", (
        ("total_payer_transitions", "count", "START_DATE"),
        ("unique_payers", "nunique", "PAYER"))),
    "claims": TableSpec("PATIENTID", (
        ("total_claims", "count", "Id"),
        ("avg_claim_cost", "mean", "OUTSTANDING1"))),
    "claims_transactions": TableSpec("PATIENTID", (
        ("total_transactions", "count", "TYPE"),
        ("total_transaction_amount", "sum", "AMOUNT"),
        ("unique_transaction_types", "nunique", "TYPE"))),
}

# Categorical demographics, label-encoded.
CATEGORICAL = ("GENDER", "RACE", "ETHNICITY", "MARITAL")
# Order of demographic columns in the canonical matrix.
DEMOGRAPHIC_ORDER = ("GENDER", "RACE", "ETHNICITY", "INCOME", "HEALTHCARE_COVERAGE",
                     "MARITAL", "age", "is_deceased")
VARIANT_DEMOGRAPHIC_ORDER = ("age", "is_deceased", "GENDER", "RACE", "ETHNICITY",
                             "MARITAL", "INCOME", "HEALTHCARE_COVERAGE")


def _agg_expr(fn: str, c: str, out: str) -> Column:
    col = F.col(c)
    if fn == "count":
        return F.count(col).alias(out)
    if fn == "nunique":
        return F.count_distinct(col).alias(out)
    if fn == "mean":
        return F.avg(col.cast("double")).alias(out)
    if fn == "sum":
        # pandas: sum over no (non-missing) values is 0.0, Spark gives NULL
        return F.coalesce(F.sum(col.cast("double")), F.lit(0.0)).alias(out)
    raise ValueError(f"unknown aggregate {fn}")


def aggregate_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per entity: the spec's aggregates."""
    present = [a for a in spec.aggs if a[2] in df.columns]
    return (df.filter(F.col(spec.key).isNotNull())
              .groupBy(F.col(spec.key).alias(KEY))
              .agg(*[_agg_expr(fn, c, out) for out, fn, c in present]))


def patient_spine(patients: DataFrame, id_col: str = "Id") -> DataFrame:
    """Distinct, non-NULL patient ids."""
    return patients.select(F.col(id_col).alias(KEY)).filter(F.col(KEY).isNotNull()).distinct()


def label_encode(df: DataFrame, cols, null_category: str = "Unknown",
                 max_window_values: int = 1_000_000) -> DataFrame:
    """Replace each categorical column by its 0-based code.

    Codes follow code-point order of the distinct values, fitted on all rows.
    All columns are encoded from one distinct (column, value) table: its
    size is counted first; up to ``max_window_values`` rows it is ranked
    with one window per column (a bounded table), beyond that with the
    distributed ranker. The code table is joined back per column (AQE
    broadcasts it when small).
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null_category)).alias(c)
                      if c in cols else F.col(c) for c in df.columns])
    pairs = out.select(*cols).unpivot([], cols, "_col", "_val").distinct()
    n_pairs = pairs.count()
    if n_pairs <= max_window_values:
        codes = pairs.withColumn(
            "_code", (F.dense_rank().over(Window.partitionBy("_col").orderBy("_val")) - 1).cast("int"))
    else:
        codes = None
        for c in cols:
            part = dense_rank_values(pairs.filter(F.col("_col") == c).select(F.col("_val")), "_val",
                                     out="_code").withColumn("_col", F.lit(c))
            codes = part if codes is None else codes.unionByName(part)
    for c in cols:
        cc = codes.filter(F.col("_col") == c).select(F.col("_val").alias(c), "_code")
        # counted above: broadcast when small, so a hot category value never
        # becomes one sort-merge partition
        cc = F.broadcast(cc) if n_pairs <= BROADCAST_CODES else cc
        out = out.join(cc, c, "left").withColumn(c, F.col("_code")).drop("_code")
    return out


def demographics(patients: DataFrame, ref_date: str, age_mode: str = "canonical",
                 null_category: str = "Unknown") -> DataFrame:
    """Patient-level columns: age, deceased flag, encoded categories, numbers."""
    ref = F.to_timestamp(F.lit(ref_date))
    p = patients.filter(F.col("Id").isNotNull()).dropDuplicates(["Id"])
    age = (age_years("BIRTHDATE", ref) if age_mode == "canonical"
           else age_floor_years("BIRTHDATE", ref).cast("double"))
    p = p.select(F.col("Id").alias(KEY), age.alias("age"),
                 deceased_flag("DEATHDATE").alias("is_deceased"),
                 *[F.col(c) for c in CATEGORICAL if c in patients.columns],
                 *[F.col(c).cast("double").alias(c) for c in ("INCOME", "HEALTHCARE_COVERAGE")
                   if c in patients.columns])
    p = label_encode(p, CATEGORICAL, null_category)
    order = DEMOGRAPHIC_ORDER if age_mode == "canonical" else VARIANT_DEMOGRAPHIC_ORDER
    return p.select(KEY, *[c for c in order if c in p.columns])


# ---------------------------------------------------------------- observations

def numeric_observations(obs: DataFrame) -> DataFrame:
    """(PATIENT, DESCRIPTION, v) for observations whose VALUE parses."""
    return (obs.select(F.col(KEY), F.col("DESCRIPTION"), lenient_double("VALUE").alias("v"))
               .filter(F.col("v").isNotNull() & F.col(KEY).isNotNull()))


def observation_coverage(obs_num: DataFrame) -> DataFrame:
    """Distinct patients per description (A2)."""
    return obs_num.groupBy("DESCRIPTION").agg(F.count_distinct(KEY).alias("n_patients"))


def coverage_threshold(n_patients: int, min_fraction: float = 0.05) -> int:
    """ceil(fraction x patients) (A3); ceil of the exact decimal product."""
    return int(math.ceil(round(min_fraction * n_patients, 9)))


def common_descriptions(obs_num: DataFrame, n_patients: int, min_fraction: float = 0.05):
    """Driver barrier: the pivot value list (description, sanitised name).

    Bounded by ``spark.sql.pivotMaxValues``; it is the schema of the matrix.
    """
    need = coverage_threshold(n_patients, min_fraction)
    rows = (observation_coverage(obs_num).filter(F.col("n_patients") >= need)
            .select("DESCRIPTION", sanitize_name("DESCRIPTION").alias("name"))
            .orderBy("DESCRIPTION").limit(_pivot_cap(obs_num) + 1).collect())
    if len(rows) > _pivot_cap(obs_num):
        raise ValueError(f"more than {_pivot_cap(obs_num)} common observation types; raise "
                         "min_fraction or spark.sql.pivotMaxValues")
    return _dedupe_names([(r["DESCRIPTION"], r["name"]) for r in rows])


def _pivot_cap(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))


def _dedupe_names(pairs):
    """Two descriptions may sanitise to one name: suffix _2, _3, ... (trap 13)."""
    seen: dict[str, int] = {}
    out = []
    for desc, name in pairs:
        k = seen.get(name, 0) + 1
        seen[name] = k
        out.append((desc, name if k == 1 else f"{name}_{k}"))
    return out


def observation_pivot(obs_num: DataFrame, values, spread: str = "var") -> DataFrame:
    """Mean and sample variance per patient x description, as columns.

    One pivot with two aggregates replaces the mean pivot + variance pivot +
    outer join. Pivot values are given, so no extra distinct job runs.
    """
    descs = [d for d, _ in values]
    if not descs:
        return obs_num.select(KEY).distinct()
    spread_fn = F.var_samp if spread == "var" else F.stddev_samp
    # Keep only the common types before the shuffle (an InSet
    # filter; the list is bounded by the pivot cap)
    common = obs_num.filter(F.col("DESCRIPTION").isin(descs))
    piv = (common.groupBy(KEY).pivot("DESCRIPTION", descs)
                  .agg(F.avg("v").alias("m"), spread_fn("v").alias("s")))
    means = [F.col(f"`{d}_m`").alias(f"obs_{n}_mean") for d, n in values]
    spreads = [F.col(f"`{d}_s`").alias(f"obs_{n}_var") for d, n in values]
    return piv.select(KEY, *means, *spreads)


def observation_features(obs: DataFrame, n_patients: int, min_fraction: float = 0.05):
    num = numeric_observations(obs)
    return observation_pivot(num, common_descriptions(num, n_patients, min_fraction))


def observation_features_variant(obs: DataFrame, min_fraction: float = 0.05,
                                 width: int = 40) -> DataFrame:
    """Variant (A6, A7): per (patient, description) mean and std, key =
    sanitised first ``width`` characters, colliding keys averaged; columns
    with less than ``min_fraction`` non-missing among pivot rows dropped.
    """
    num = numeric_observations(obs)
    per = (num.groupBy(KEY, "DESCRIPTION")
              .agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
              .withColumn("dkey", sanitize_name_truncated("DESCRIPTION", width)))
    cap = _pivot_cap(per)
    keys = [r["dkey"] for r in per.select("dkey").distinct().orderBy("dkey").limit(cap + 1).collect()]
    if len(keys) > cap:
        raise ValueError(f"more than {cap} observation keys; raise spark.sql.pivotMaxValues")
    if not keys:
        return num.select(KEY).distinct()
    piv = per.groupBy(KEY).pivot("dkey", keys).agg(F.avg("m").alias("m"), F.avg("s").alias("s"))
    cols = ([(f"`{k}_m`", f"obs_{k}_mean") for k in keys]
            + [(f"`{k}_s`", f"obs_{k}_var") for k in keys])
    piv = piv.select(KEY, *[F.col(a).alias(b) for a, b in cols])
    # barrier: non-missing share of every pivot column (long form, one row each)
    names = [b for _, b in cols]
    shares = {r["feature"]: r["share"] for r in
              piv.select(*names).unpivot([], names, "feature", "value").groupBy("feature")
                 .agg(F.avg(F.col("value").isNotNull().cast("double")).alias("share")).collect()}
    keep = [b for b in names if shares.get(b) is not None and shares[b] >= min_fraction]
    return piv.select(KEY, *keep)


# -------------------------------------------------------------- matrix build

def build_feature_matrix(tables: dict[str, DataFrame], ref_date: str,
                         mode: str = "canonical", min_obs_fraction: float = 0.05,
                         n_patients: int | None = None, staged: bool = True) -> DataFrame:
    """Spine + demographics + encounters + observation pivot + per-table
    aggregates, all left-joined on PATIENT (P1); without ``staged`` nothing is
    written and one plan joins all of them."""
    specs = CANONICAL_SPECS if mode == "canonical" else VARIANT_SPECS
    pats = tables["patients"]
    spine = patient_spine(pats)
    if n_patients is None:
        n_patients = spine.count()
    demo = demographics(pats, ref_date, age_mode=mode,
                        null_category="Unknown" if mode == "canonical" else "nan")
    sides = [demo, aggregate_table(tables["encounters"], specs["encounters"])]
    if "observations" in tables:
        sides.append(observation_features(tables["observations"], n_patients, min_obs_fraction)
                     if mode == "canonical"
                     else observation_features_variant(tables["observations"], min_obs_fraction))
    sides += [aggregate_table(tables[name], spec) for name, spec in specs.items()
              if name != "encounters" and name in tables]
    return join_sides(spine, sides) if staged else _left_joins(spine, sides)


def join_sides(spine: DataFrame, sides: list[DataFrame], at_once: int = SIDES_AT_ONCE) -> DataFrame:
    """Spine left-joined with every side (one row per ``KEY`` each), in order.

    In one chain every task would hold the aggregation and sort buffers of all
    sides together. ``at_once`` sides are joined and written at a time; the
    written tables (one narrow row per entity) are joined in the same way until
    one join holds them.
    """
    while len(sides) > at_once:
        sides = [materialize(_left_joins(spine, sides[i:i + at_once]), "matrix-part")
                 for i in range(0, len(sides), at_once)]
    return _left_joins(spine, sides)


def _left_joins(spine: DataFrame, sides: list[DataFrame]) -> DataFrame:
    return reduce(lambda feat, side: feat.join(side, KEY, "left"), sides, spine)


def feature_columns(df: DataFrame, exclude=(KEY, "label", "earliest_enc", "latest_enc",
                                            "cohort", "split", "in_d1", "in_d2")) -> list[str]:
    return [c for c in df.columns if c not in exclude]
