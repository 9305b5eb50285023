"""End-to-end plans over the stand-in tables: labelled matrix -> cohorts ->
preprocessed splits. Shared by the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import cohorts as co
from strata.operators import features as fe
from strata.operators import preprocess as pp
from strata.session import materialize
from strata.sources import standins as st

KEY = "PATIENT"

# Per-application memo of checkpointed results (the reference memoises its
# whole pipeline the same way). Keys include the application id, so a new
# session recomputes; values only point at reliable checkpoint files.
_MEMO: dict[tuple, object] = {}


def _memo_key(spark: SparkSession, *parts) -> tuple:
    return (spark.sparkContext.applicationId, *parts)


def labelled_matrix(spark: SparkSession, sf_dir: str, mode: str = "canonical",
                    checkpoint: bool = True) -> DataFrame:
    """Feature matrix + label + encounter bounds + cohort flags.

    Checkpointed (reliable, in spark.checkpoint.dir): the preprocessing
    barriers that follow re-read it instead of re-running 14 aggregates.
    """
    key = _memo_key(spark, "matrix", sf_dir, mode)
    if checkpoint and key in _MEMO:
        return _MEMO[key]
    t = st.load_ehr(spark, sf_dir)
    m = fe.build_feature_matrix(t, st.STANDIN_REF_DATE, mode=mode, staged=checkpoint)
    m = co.attach_label(m, t["conditions"], st.STANDIN_LABEL_PATTERN)
    m = m.join(co.encounter_bounds(t["encounters"]), KEY, "left")
    m = co.cohort_flags(m, st.STANDIN_CUTOFF)
    if not checkpoint:
        return m
    m = materialize(m)
    _MEMO[key] = m
    return m


def cohort_frames(m: DataFrame) -> dict[str, DataFrame]:
    return {"D1": co.cohort(m, "D1"), "D2": co.cohort(m, "D2")}


def prepare_cohorts(spark: SparkSession, sf_dir: str, mode: str = "canonical",
                    fit_on: str = "all") -> dict[str, pp.Prepared]:
    key = _memo_key(spark, "prepared", sf_dir, mode, fit_on)
    if key in _MEMO:
        return _MEMO[key]
    m = labelled_matrix(spark, sf_dir, mode)
    frames = cohort_frames(m)
    p1 = pp.preprocess_cohort(frames["D1"], "D1", None, mode, fit_on=fit_on)
    p2 = pp.preprocess_cohort(frames["D2"], "D2", p1.features if mode == "canonical" else None,
                              mode, fit_on=fit_on)
    if mode != "canonical":
        common = pp.common_features(p1.features, p2.features)
        for p in (p1, p2):
            p.frame = p.frame.select(KEY, "label", "split", *common)
            p.features = common
    _MEMO[key] = {"D1": p1, "D2": p2}
    return _MEMO[key]


def tagged_splits(prepared: dict[str, pp.Prepared]) -> DataFrame:
    """Both cohorts' prepared rows in one frame with a ``cohort`` column."""
    out = None
    for name, p in prepared.items():
        f = p.frame.withColumn("cohort", F.lit(name))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
