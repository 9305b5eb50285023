"""Shared helpers for registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    """Register a query (and its oracle SQL, if SQL can express it)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS, per: dict[str, int] | None = None) -> DataFrame:
    """Round every DOUBLE column (sums differ in the last bits by order);
    ``per`` names columns with digits of their own."""
    per = per or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # + 0.0 turns -0.0 into 0.0 so both engines print one zero
            cols.append((F.round(F.col(f"`{f.name}`").cast("double"), per.get(f.name, digits)) + F.lit(0.0))
                        .alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def long_form(df: DataFrame, ids: list[str], feature: str = "feature",
              value: str = "value", drop_nulls: bool = True) -> DataFrame:
    """Wide numeric columns -> (ids..., feature, value) rows (static schema)."""
    vals = [c for c in df.columns if c not in ids]
    out = df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in vals]).unpivot(
        ids, vals, feature, value)
    return out.filter(F.col(value).isNotNull()) if drop_nulls else out


def r(expr: str, digits: int = DIGITS) -> str:
    """SQL rounding of a double expression (oracle side)."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def compose(views, ctes, final: str) -> str:
    """DuckDB oracle text: stand-in views + named CTEs + final SELECT."""
    from strata.sources.standins import sql_views
    vs = sql_views()
    parts = [f"{n} AS ({vs[n]})" for n in views]
    parts += [c.strip() for c in ctes if c and c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + final
