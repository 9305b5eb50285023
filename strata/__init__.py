"""strata: cohort analytics on Spark.

Event tables -> per-entity feature rows -> existence label -> temporal
cohorts -> preprocessing -> statistics, models and evaluation, all as
DataFrame / SQL / Spark ML plans.
"""

__version__ = "0.1.0"
