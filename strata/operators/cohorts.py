"""Label, encounter date bounds and overlapping temporal cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import matches_flag

KEY = "PATIENT"

# Canonical label rule and cutoff.
LABEL_PATTERN = r"\(disorder\)|\(finding\)"
TEMPORAL_CUTOFF = "2020-01-01"


def positive_patients(conditions: DataFrame, pattern: str = LABEL_PATTERN,
                      text_col: str = "DESCRIPTION") -> DataFrame:
    """Distinct patients with at least one matching condition."""
    return (conditions.filter(matches_flag(text_col, pattern) & F.col(KEY).isNotNull())
                      .select(KEY).distinct())


def attach_label(df: DataFrame, conditions: DataFrame, pattern: str = LABEL_PATTERN) -> DataFrame:
    """label = 1 if the patient has a matching condition else 0.

    The positive side is a distinct id list, aggregated before the join, so
    the left join cannot fan out.
    """
    pos = positive_patients(conditions, pattern).withColumn("_pos", F.lit(1))
    return (df.join(pos, KEY, "left")
              .withColumn("label", F.coalesce(F.col("_pos"), F.lit(0)).cast("int"))
              .drop("_pos"))


def encounter_bounds(encounters: DataFrame, start_col: str = "START") -> DataFrame:
    """earliest / latest encounter start per patient."""
    return (encounters.filter(F.col(KEY).isNotNull())
                      .groupBy(KEY)
                      .agg(F.min(start_col).alias("earliest_enc"),
                           F.max(start_col).alias("latest_enc")))


def cohort_flags(df: DataFrame, cutoff: str = TEMPORAL_CUTOFF) -> DataFrame:
    """in_d1: earliest < cutoff; in_d2: latest >= cutoff.

    Patients without a valid encounter date are in neither cohort.
    """
    cut = F.to_timestamp(F.lit(cutoff)).cast("timestamp_ntz")
    return (df.withColumn("in_d1", F.coalesce(F.col("earliest_enc") < cut, F.lit(False)))
              .withColumn("in_d2", F.coalesce(F.col("latest_enc") >= cut, F.lit(False))))


def cohort(df: DataFrame, name: str) -> DataFrame:
    """Rows of one cohort, helper columns dropped."""
    flag = "in_d1" if name == "D1" else "in_d2"
    return df.filter(F.col(flag)).drop("earliest_enc", "latest_enc", "in_d1", "in_d2")


def tagged_cohorts(df: DataFrame) -> DataFrame:
    """Both (overlapping) cohorts in one frame with a ``cohort`` column.

    One pass: each row is emitted once per cohort it belongs to (explode of
    its cohort tags), instead of a union that would run the whole upstream
    plan twice.
    """
    tags = F.filter(F.array(F.when(F.col("in_d1"), F.lit("D1")), F.when(F.col("in_d2"), F.lit("D2"))),
                    lambda t: t.isNotNull())
    return (df.withColumn("cohort", F.explode(tags))
              .drop("earliest_enc", "latest_enc", "in_d1", "in_d2"))


def cohort_sizes(df_flags: DataFrame) -> DataFrame:
    """Sizes of D1, D2, their overlap and all patients in one pass."""
    return df_flags.agg(
        F.count_if(F.col("in_d1")).alias("d1_patients"),
        F.count_if(F.col("in_d2")).alias("d2_patients"),
        F.count_if(F.col("in_d1") & F.col("in_d2")).alias("overlap_patients"),
        F.count_if(~F.col("in_d1") & ~F.col("in_d2")).alias("neither_patients"),
        F.count(F.lit(1)).alias("total_patients"))


def class_distribution(df: DataFrame, group_cols=("cohort",)) -> DataFrame:
    """Count and share of each label per group."""
    from pyspark.sql import Window
    g = list(group_cols)
    counts = df.groupBy(*g, "label").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*g) if g else Window.partitionBy()
    return counts.withColumn(
        "pct", F.col("n").cast("double") / F.sum("n").over(w) * F.lit(100.0))
