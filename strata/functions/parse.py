"""Lenient parsing: bad text becomes NULL instead of failing the job.

ANSI mode is on in Spark 4, so plain casts raise on bad input; every parser
here is a ``try_*`` built-in guarded by a pattern where Spark is more lenient
than the semantics we must reproduce.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value tokens recognised by pandas.read_csv by
# default (public pandas documentation), matched case-sensitively.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Text accepted as a number: optional sign, decimal with optional exponent,
# or infinity; surrounding blanks allowed. Rejects Spark-only forms such as
# '1d', '2f', hex floats and 'NaN' (which must become missing, not NaN).
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"

DAYFIRST_FORMAT = "d-M-yyyy"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_na_tokens(c) -> Column:
    """Map missing-value tokens to NULL (CSV readers accept only one token)."""
    c = _c(c)
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def lenient_double(c) -> Column:
    """Text -> DOUBLE; anything non-numeric (incl. 'NaN') -> NULL."""
    c = _c(c).cast("string")
    return F.when(c.rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))


def lenient_timestamp(c, fmt: str | None = None) -> Column:
    """Text -> naive timestamp; unparseable -> NULL."""
    c = _c(c).cast("string")
    ts = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return ts.cast("timestamp_ntz")


def utc_naive_timestamp(c, fmt: str | None = None) -> Column:
    """Parse as an instant (offsets honoured), express in UTC, drop the zone.

    Parsing straight to TIMESTAMP_NTZ would ignore a '+02:00' offset, so the
    value is parsed as TIMESTAMP (session zone UTC) and then cast.
    """
    c = _c(c).cast("string")
    ts = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    # TIMESTAMP -> NTZ renders in the session zone; shifting by that zone first
    # yields the UTC wall clock whatever the cluster's session zone is.
    return F.to_utc_timestamp(ts, F.current_timezone()).cast("timestamp_ntz")


def dayfirst_timestamp(c) -> Column:
    """Day-first dates such as '5-3-2019' or '15-03-2019'; others -> NULL."""
    return lenient_timestamp(c, DAYFIRST_FORMAT)
