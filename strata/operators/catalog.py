"""Feature catalogue: category counts and name search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's feature-category rules (substring or prefix
# matches on the feature name; categories overlap).
CATEGORY_RULES = (
    ("demographic", "contains", ("GENDER", "RACE", "ETHNICITY", "INCOME", "MARITAL", "age",
                                 "is_deceased", "HEALTHCARE")),
    ("encounter", "contains", ("encounter", "claim_cost", "payer_coverage")),
    ("observation", "prefix", ("obs_",)),
    ("utilization", "contains", ("medication", "procedure", "immunization", "careplan", "imaging",
                                 "device", "supply", "transaction", "payer", "claims")),
)


def _rule(kind, pats, col="feature"):
    c = F.col(col)
    conds = [c.startswith(p) if kind == "prefix" else c.contains(p) for p in pats]
    return reduce(lambda a, b: a | b, conds)


def category_counts(features: DataFrame, col: str = "feature") -> DataFrame:
    """Features per category in one pass, plus those in no category."""
    rules = [(name, _rule(kind, pats, col)) for name, kind, pats in CATEGORY_RULES]
    any_rule = reduce(lambda a, b: a | b, [e for _, e in rules])
    row = features.agg(*[F.count_if(e).alias(n) for n, e in rules],
                       F.count_if(~any_rule).alias("none"))
    names = [n for n, _ in rules] + ["none"]
    return row.unpivot([], names, "category", "n_features")


def search(features: DataFrame, term: str, col: str = "feature") -> DataFrame:
    """Case-insensitive substring filter over feature names."""
    return features.filter(F.lower(F.col(col)).contains(term.lower()))
