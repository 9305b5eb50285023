"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from strata.plans import q_eval, q_features, q_models, q_prep, q_sources, q_stats  # noqa: F401
from strata.plans.common import ORACLE, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLE)
