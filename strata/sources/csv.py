"""Lenient CSV scan for raw EHR exports.

Semantics reproduced: lines with *more* fields than the header are
skipped, lines with *fewer* fields are kept and padded with NULL, quoted
fields may contain commas, doubled quotes and line ends, blank-header columns
are dropped, and the common missing-value tokens become NULL.

Spark's own reader cannot split a file whose quoted fields span lines, so
records are found here, in one pass over the bytes:

* Spark splits the files into blocks and lines as for any text. A line turns
  the state before it (inside a quoted field or not) into the state after it;
  a task follows both possible states through its block, and writes each line
  with both.
* What a block does to the state is a function of two values, and functions
  compose: over the blocks of a file, the state before each one follows from
  the last block that fixes it and the number of blocks since that flip it.
* With that state known, a line that is outside before and after is a record.
  The others are joined to records, grouped by the number of the opening line;
  only they are shuffled.

The header is the first record of a file, by position; every file's columns go
by its own header, and a column that only some files have is NULL in the
others. Distinct headers, not files, come to the driver. Line ends inside
fields come out as newlines.
"""

from __future__ import annotations

import csv as pycsv
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.parse import null_na_tokens
from strata.session import materialize

JUNK_COLUMN = re.compile(r"^_c\d+$")
_QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
_REST_OF_QUOTED = r'^[^"]*+(?:""[^"]*+)*+"'
_LINES = ("file string, block long, line long, value string, before0 boolean, before1 boolean, after0 boolean, "
          "after1 boolean, opened0 long, opened1 long")


def _parse_header(line: str) -> list[str]:
    """Header names; blank names become _c<i> (dropped later as junk)."""
    names = next(pycsv.reader([line]))
    return [n if n.strip() else f"_c{i}" for i, n in enumerate(names)]


def _outside_quotes(c):
    return F.regexp_replace(c, _QUOTED_FIELD, "$1")


def follow(after_outside: np.ndarray, after_inside: np.ndarray, start: bool) -> np.ndarray:
    """State before every line and after the last one, from the state before
    the first: the last line that fixes the state, then every line that flips it."""
    fixes, flips = after_outside == after_inside, after_outside & ~after_inside
    n = np.arange(1, len(fixes) + 1)
    last = np.maximum.accumulate(np.where(fixes, n, 0)) if len(n) else n
    value = np.concatenate([[start], after_outside])[last]
    turned = np.concatenate([[0], np.cumsum(flips)])
    return np.concatenate([[start], value ^ ((turned[n] - turned[last]) % 2 == 1)]).astype(bool)


def _number_lines(batches):
    """Task: lines in the order of their block, with both states."""
    file = block = None
    at, state, opened = 0, [False, True], [0, 0]
    for batch in batches:
        names, blocks = batch.column("file"), np.asarray(batch.column("block"))
        codes = np.asarray(names.dictionary_encode().indices)
        new = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])])[:len(blocks)])
        for a, z in zip(new, [*new[1:], len(blocks)]):
            if (names[a].as_py(), blocks[a]) != (file, block):
                file, block = names[a].as_py(), blocks[a]
                at, state, opened = 0, [False, True], [0, 0]
            part = batch.slice(a, z - a)
            out, inside = (np.asarray(part.column(c).to_numpy(zero_copy_only=False), bool) for c in ("out", "inside"))
            cols = {"file": part.column("file"), "block": part.column("block"),
                    "line": pa.array(np.arange(at, at + z - a)), "value": part.column("value")}
            for h in (0, 1):
                s = follow(out, inside, state[h])
                opens = opened[h] + np.cumsum(~s[:-1] & s[1:])
                cols |= {f"before{h}": pa.array(s[:-1]), f"after{h}": pa.array(s[1:]), f"opened{h}": pa.array(opens)}
                state[h], opened[h] = bool(s[-1]), int(opens[-1])
            at += z - a
            yield pa.RecordBatch.from_pydict({c.split()[0]: cols[c.split()[0]] for c in _LINES.split(", ")})


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file, with the states (``_LINES``), written."""
    v = F.col("value")
    ends = lambda rest: _outside_quotes(rest).rlike('(^|,)"')  # noqa: E731  a field is left open
    text = spark.read.text(path).select(
        v, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        ends(v).alias("out"),
        # inside: up to the closing quote, then the rest of that field ("x") and of the line
        F.when(v.rlike(_REST_OF_QUOTED), ends(F.concat(F.lit("x"), F.regexp_replace(v, _REST_OF_QUOTED, ""))))
        .otherwise(True).alias("inside"))
    return materialize(text.mapInArrow(_number_lines, _LINES), "csv-lines")


def _block_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside, opened): the state before every block and the
    opening lines of the file before it."""
    last = F.max_by(F.struct("after0", "after1", "opened0", "opened1"), "line")
    blocks = lines.groupBy("file", "block").agg(last.alias("x")).select("file", "block", "x.*")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixes, flips = F.col("after0") == F.col("after1"), F.col("after0") & ~F.col("after1")
    flipped = F.coalesce(F.sum(flips.cast("int")).over(before), F.lit(0))
    blocks = blocks.withColumn("flipped", flipped)
    at = F.when(fixes, F.struct(F.col("after0").alias("state"), (F.col("flipped") + 0).alias("flipped")))
    blocks = blocks.withColumn("fixed", F.last(at, ignorenulls=True).over(before))
    start = F.coalesce(F.col("fixed.state"), F.lit(False))
    inside = start != ((F.col("flipped") - F.coalesce("fixed.flipped", F.lit(0))) % 2 == 1)
    blocks = blocks.withColumn("inside", inside)
    opened = F.sum(F.when(F.col("inside"), F.col("opened1")).otherwise(F.col("opened0"))).over(before)
    return blocks.select("file", "block", "inside", F.coalesce(opened, F.lit(0)).alias("opened"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, record): the text of every record that is not blank,
    with the place where it begins."""
    lines = _lines(spark, path)
    b = _block_states(lines).toDF("f", "b", "inside", "earlier")
    x = lines.join(b, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    pick = lambda c: F.when(F.col("inside"), F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
    x = x.select("file", "block", "line", "value", pick("before").alias("before"), pick("after").alias("after"),
                 (F.col("earlier") + pick("opened")).alias("opening"))
    whole = x.filter("NOT before AND NOT after").select("file", "block", "line", F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    joined = (x.filter("before OR after").groupBy("file", "opening").agg(parts.alias("p"))
              .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["line"].alias("line"),
                      F.array_join(F.transform("p", lambda q: q["value"]), "\n").alias("record")))
    return whole.unionByName(joined).filter(F.trim("record") != "")


def read_csv_lenient(spark: SparkSession, path: str, columns: list[str] | None = None,
                     usecols=None, header: bool | None = None, na_tokens: bool = True) -> DataFrame:
    """Read CSV text as all-string columns with pandas-like bad-line handling.

    A record with more delimiters (outside quoted fields) than the header
    allows is skipped; missing trailing fields are NULL.
    ``columns``: names when the files have no header (or, with ``header=True``,
    to override it). ``header`` defaults to True only when ``columns`` is None.
    ``usecols``: list of names or predicate; absent names are tolerated (S2, S3).
    """
    if header is None:
        header = columns is None
    records = read_records(spark, path)
    if header:
        place = F.struct("block", "line")
        first = records.groupBy("file").agg(F.min_by("record", place).alias("head"), F.min(place).alias("at"))
        first = materialize(first, "csv-heads")                              # one row a file
        h = first.toDF("f", "head", "at")
        records = records.join(h, F.col("file") == F.col("f")).filter(place != F.col("at"))
        heads = sorted(r["head"] for r in first.select("head").distinct().collect())
    else:
        records, heads = records.withColumn("head", F.lit("")), [""]
    names = {k: list(columns) if columns is not None else _parse_header(k) for k in heads}
    every = list(dict.fromkeys(c for k in heads for c in names[k] if not JUNK_COLUMN.match(c)))
    keep = every if usecols is None else [c for c in every if (usecols(c) if callable(usecols) else c in set(usecols))]
    most = max((len(n) for n in names.values()), default=0)
    if not most:
        return spark.createDataFrame([], "file string").select()

    def by_head(of):                                  # a value of the record's header
        out = F.lit(None)
        for k in reversed(heads):
            out = of(k) if out is None or len(heads) == 1 else F.when(F.col("head") == k, of(k)).otherwise(out)
        return out

    delimiters = F.length(F.regexp_replace(_outside_quotes(F.col("record")), r"[^,]", ""))
    good = records.filter(delimiters < by_head(lambda k: F.lit(len(names[k]))))
    ddl = ", ".join(f"_{i} STRING" for i in range(most))
    fields = F.from_csv("record", ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    parsed = good.withColumn("x", fields)

    def column(c: str):
        value = by_head(lambda k: F.col(f"x._{names[k].index(c)}") if c in names[k] else F.lit(None).cast("string"))
        return value.alias(c)

    out = parsed.select(*[column(c) for c in keep])
    return out.select(*[null_na_tokens(f"`{c}`").alias(c) for c in keep]) if na_tokens else out
