"""A representative slice of the registered queries against their DuckDB
oracle on the smallest tables (the full set runs in tools/oracle_check.py)."""

import math

import duckdb
import pytest

from tests.conftest import SF_SMALL

NAMES = ["encounter_features", "medication_features", "observation_pivot_mean_var",
         "existence_label", "cohort_overlap", "cohort_class_distribution", "stratified_split",
         "label_encode", "binary_metrics", "roc_auc", "confusion_matrix", "lenient_numeric",
         "date_parsing", "age_features", "na_tokens", "csv_lenient_scan"]


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(None if x is None or (not isinstance(x, str) and x != x) else x) for x in r)
           for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    from strata.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    for a, b in zip(r1, r2):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, (int, float)):
                assert abs(x - y) <= 2e-6 * max(1.0, abs(x))
            else:
                assert x == y
