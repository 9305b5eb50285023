"""Registered queries: scans, sinks, cleaning and scalar functions
(S1-S4, S6, S9, C1-C5, C14, C17, A35, F1-F3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import parse as fp
from strata.functions import scalars as fs
from strata.operators import catalog as cat
from strata.plans import q_features as qf
from strata.plans import q_prep as qp
from strata.plans.common import compose, r, register, rounded
from strata.plans.workflow import prepare_cohorts, tagged_splits
from strata.sources import sinks
from strata.sources import standins as st
from strata.sources.csv import read_csv_lenient
from strata.sources.tables import read_table

# Columns of the CSV written by csv_lenient_scan; two blank junk columns.
CSV_COLUMNS = ["Id", "PATIENT", "ENCOUNTERCLASS", "START", "BASE_ENCOUNTER_COST", "_c5", "_c6"]


def _csv_lines(orders):
    """Encounter-like CSV lines from orders, with bad lines by a fixed rule:
    status P -> one field too many (skipped), priority 5-LOW -> short line
    (padded), 3-MEDIUM -> class 'NA' (missing), 1-URGENT -> quoted comma."""
    k = F.col("o_orderkey").cast("string")
    c = F.col("o_custkey").cast("string")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    p = F.col("o_totalprice").cast("string")
    prio = F.col("o_orderpriority")
    line = (F.when(F.col("o_orderstatus") == "P", F.concat_ws(",", k, c, prio, d, p, F.lit(""), F.lit(""), F.lit("x")))
             .when(prio == "5-LOW", F.concat_ws(",", k, c, prio, d))
             .when(prio == "3-MEDIUM", F.concat_ws(",", k, c, F.lit("NA"), d, p, F.lit(""), F.lit("")))
             .when(prio == "1-URGENT", F.concat_ws(",", k, c, F.lit('"1,URGENT"'), d, p, F.lit(""), F.lit("")))
             .otherwise(F.concat_ws(",", k, c, prio, d, p, F.lit(""), F.lit(""))))
    return orders.select(line.alias("value"))


@register("csv_lenient_scan", (
    "SELECT PATIENT, CAST(count(Id) AS BIGINT) AS n_rows, CAST(count(DISTINCT cls) AS BIGINT) AS n_classes, "
    + r("avg(cost)") + " AS avg_cost, CAST(count(*) FILTER (WHERE cost IS NULL) AS BIGINT) AS n_missing_cost "
    "FROM (SELECT o_orderkey AS Id, o_custkey AS PATIENT, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL "
    "WHEN o_orderpriority = '1-URGENT' THEN '1,URGENT' ELSE o_orderpriority END AS cls, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS cost FROM orders "
    "WHERE o_orderstatus <> 'P') GROUP BY PATIENT"))
def csv_lenient_scan(spark, sf_dir):
    """Write CSV text, read it back leniently, aggregate."""
    path = sinks.scratch_path(spark, "csv")
    _csv_lines(read_table(spark, sf_dir, "orders")).write.mode("overwrite").text(path)
    enc = read_csv_lenient(spark, path, columns=CSV_COLUMNS, header=False)
    cost = fp.lenient_double("BASE_ENCOUNTER_COST")
    return rounded(enc.filter(F.col("PATIENT").isNotNull()).groupBy(
        F.col("PATIENT").cast("bigint").alias("PATIENT")).agg(
        F.count("Id").alias("n_rows"), F.count_distinct("ENCOUNTERCLASS").alias("n_classes"),
        F.avg(cost).alias("avg_cost"), F.count_if(cost.isNull()).alias("n_missing_cost")))


def _scratch_csv(spark, sf_dir):
    path = sinks.scratch_path(spark, "csv")
    _csv_lines(read_table(spark, sf_dir, "orders")).write.mode("overwrite").text(path)
    return path


@register("csv_column_list_scan", (
    "SELECT ENCOUNTERCLASS, CAST(count(DISTINCT PATIENT) AS BIGINT) AS n_patients FROM (SELECT o_custkey AS PATIENT, "
    "CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN '1,URGENT' "
    "ELSE o_orderpriority END AS ENCOUNTERCLASS FROM orders WHERE o_orderstatus <> 'P') GROUP BY ENCOUNTERCLASS"))
def csv_column_list_scan(spark, sf_dir):
    """Read named columns only; names that the file lacks are tolerated."""
    enc = read_csv_lenient(spark, _scratch_csv(spark, sf_dir), columns=CSV_COLUMNS, header=False,
                           usecols=["PATIENT", "ENCOUNTERCLASS", "NOT_THERE"])
    return enc.groupBy("ENCOUNTERCLASS").agg(F.count_distinct("PATIENT").alias("n_patients"))


@register("csv_column_predicate_scan", (
    "SELECT column_name, CAST(n AS BIGINT) AS n FROM (SELECT 'Id' AS column_name, count(o_orderkey) AS n FROM orders "
    "WHERE o_orderstatus <> 'P' UNION ALL SELECT 'BASE_ENCOUNTER_COST', count(*) FILTER (WHERE o_orderpriority <> '5-LOW') "
    "FROM orders WHERE o_orderstatus <> 'P')"))
def csv_column_predicate_scan(spark, sf_dir):
    """S3: columns chosen by a predicate on their names; values present per column."""
    enc = read_csv_lenient(spark, _scratch_csv(spark, sf_dir), columns=CSV_COLUMNS, header=False,
                           usecols=lambda c: c == "Id" or "COST" in c)
    return (enc.unpivot([], enc.columns, "column_name", "v").filter(F.col("v").isNotNull())
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n")))


@register("csv_multiline_scan", (
    "SELECT o_custkey AS PATIENT, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(note)) AS BIGINT) AS n_chars, "
    "CAST(sum(length(note) - length(replace(note, chr(10), ''))) AS BIGINT) AS n_line_ends, "
    "min(o_orderkey) AS first_id FROM (SELECT *, o_orderpriority || chr(10) || 'said \"' || o_orderstatus || '\", twice' "
    "|| CASE WHEN o_orderstatus = 'F' THEN chr(10) || chr(10) || 'end' ELSE '' END AS note FROM orders) GROUP BY o_custkey"))
def csv_multiline_scan(spark, sf_dir):
    """Files with headers, written in two column orders, whose quoted
    fields hold line ends, blank lines, commas and quotes."""
    o = read_table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    note = F.concat("o_orderpriority", F.lit('\nsaid "'), status, F.lit('", twice'),
                    F.when(status == "F", "\n\nend").otherwise(""))
    rows = o.select(F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("PATIENT"), note.alias("NOTE"), status.alias("S"))
    path = sinks.scratch_path(spark, "csv")
    out = {"header": True, "escape": '"'}
    rows.filter("S = 'O'").drop("S").write.mode("overwrite").options(**out).csv(path)
    rows.filter("S <> 'O'").select("NOTE", "PATIENT", "Id").write.mode("append").options(**out).csv(path)
    got = read_csv_lenient(spark, path)
    ends = F.length("NOTE") - F.length(F.regexp_replace("NOTE", "\n", ""))
    return got.groupBy(F.col("PATIENT").cast("bigint").alias("PATIENT")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("NOTE")).cast("bigint").alias("n_chars"),
        F.sum(ends).cast("bigint").alias("n_line_ends"), F.min(F.col("Id").cast("bigint")).alias("first_id"))


@register("na_tokens", (
    "SELECT c_nationkey AS nation, CAST(count(seg) AS BIGINT) AS n_present, "
    "CAST(count(DISTINCT seg) AS BIGINT) AS n_distinct FROM (SELECT c_nationkey, CASE c_mktsegment "
    "WHEN 'BUILDING' THEN NULL WHEN 'HOUSEHOLD' THEN NULL WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS seg "
    "FROM customer) GROUP BY c_nationkey"))
def na_tokens(spark, sf_dir):
    """S4: 'NA', 'null' and '' are missing (count / nunique skip them)."""
    c = read_table(spark, sf_dir, "customer")
    text = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NA"))
             .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("null"))
             .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
             .otherwise(F.col("c_mktsegment")))
    seg = fp.null_na_tokens(text)
    return c.groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(seg).alias("n_present"), F.count_distinct(seg).alias("n_distinct"))


@register("lenient_numeric", (
    "SELECT event_id, " + r("CASE WHEN event_type IN ('click', 'signup') THEN value END")
    + " AS parsed FROM events"))
def lenient_numeric(spark, sf_dir):
    """C4: numeric text (padded or plain) parses; '12.5d', 'NaN', 'n/a' -> NULL."""
    e = read_table(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    text = (F.when(F.col("event_type") == "click", v)
             .when(F.col("event_type") == "view", F.concat(v, F.lit("d")))
             .when(F.col("event_type") == "signup", F.concat(F.lit(" "), v, F.lit(" ")))
             .when(F.col("event_type") == "error", F.lit("NaN"))
             .otherwise(F.lit("n/a")))
    return rounded(e.select("event_id", fp.lenient_double(fp.null_na_tokens(text)).alias("parsed")))


@register("date_parsing", (
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderdate END AS dayfirst, "
    "o_orderdate + INTERVAL 8 HOUR AS utc_naive, "
    "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS lenient FROM orders"))
def date_parsing(spark, sf_dir):
    """Day-first text ('d-M-yyyy'; ISO text under day-first -> NULL),
    offset text parsed as an instant and kept as naive UTC, unparseable
    text -> NULL."""
    o = read_table(spark, sf_dir, "orders")
    df_text = F.when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd")) \
               .otherwise(F.date_format("o_orderdate", "d-M-yyyy"))
    tz_text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00+02:00"))
    loose = F.when(F.col("o_orderstatus") == "F", F.lit("not a date")) \
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", fp.dayfirst_timestamp(df_text).alias("dayfirst"),
                    fp.utc_naive_timestamp(tz_text).alias("utc_naive"),
                    fp.lenient_timestamp(loose, "yyyy-MM-dd").alias("lenient"))


@register("age_features", compose(["patients"], [], (
    f"SELECT Id AS PATIENT, round(date_diff('day', BIRTHDATE, DATE '{st.STANDIN_REF_DATE}') / 365.25, 1) + 0.0 AS age, "
    f"CAST(floor(date_diff('day', BIRTHDATE, DATE '{st.STANDIN_REF_DATE}') / 365.0) AS BIGINT) AS age_floor, "
    "CAST(DEATHDATE IS NOT NULL AS INTEGER) AS is_deceased, "
    "coalesce(MARITAL, 'Unknown') AS marital_filled FROM patients")))
def age_features(spark, sf_dir):
    """Canonical and floor ages, deceased flag, NULL category fill."""
    p = st.load_ehr(spark, sf_dir)["patients"]
    ref = F.to_date(F.lit(st.STANDIN_REF_DATE))
    # + 0.0: one zero for newborns in every engine (no -0.0)
    return p.select(F.col("Id").alias("PATIENT"), (fs.age_years("BIRTHDATE", ref) + F.lit(0.0)).alias("age"),
                    fs.age_floor_years("BIRTHDATE", ref).alias("age_floor"),
                    fs.deceased_flag("DEATHDATE").alias("is_deceased"),
                    F.coalesce(F.col("MARITAL"), F.lit("Unknown")).alias("marital_filled"))


def _d1_features(spark, sf_dir):
    prepared = prepare_cohorts(spark, sf_dir)
    feats = prepared["D1"].features
    return spark.createDataFrame([(i, f) for i, f in enumerate(feats)], "position int, feature string")


def _cat_sql():
    parts = []
    for name, kind, pats in cat.CATEGORY_RULES:
        if kind == "prefix":
            cond = " OR ".join(f"starts_with(feature, '{p}')" for p in pats)
        else:
            cond = " OR ".join(f"contains(feature, '{p}')" for p in pats)
        parts.append(f"SELECT '{name}' AS category, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS n_features "
                     "FROM kept WHERE cohort = 'D1'")
    parts.append("SELECT 'none' AS category, CAST(count(*) FILTER (WHERE NOT (" + " OR ".join(
        (" OR ".join(f"starts_with(feature, '{p}')" for p in pats) if kind == "prefix"
         else " OR ".join(f"contains(feature, '{p}')" for p in pats))
        for _, kind, pats in cat.CATEGORY_RULES) + ")) AS BIGINT) FROM kept WHERE cohort = 'D1'")
    return " UNION ALL ".join(parts)


@register("feature_category_counts", qp._sql(_cat_sql()))
def feature_category_counts(spark, sf_dir):
    """Overlapping substring categories over the surviving D1 features."""
    return cat.category_counts(_d1_features(spark, sf_dir))


SEARCH_TERM = "Cost"


@register("feature_search", qp._sql(
    f"SELECT feature FROM kept WHERE cohort = 'D1' AND contains(lower(feature), lower('{SEARCH_TERM}'))"))
def feature_search(spark, sf_dir):
    """C17: case-insensitive substring search over the feature catalogue."""
    return cat.search(_d1_features(spark, sf_dir), SEARCH_TERM).select("feature")


@register("split_parquet_roundtrip", qp._sql(
    "SELECT cohort, split, CAST(count(*) AS BIGINT) AS n_rows, "
    "CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS n1 FROM splits GROUP BY cohort, split"))
def split_parquet_roundtrip(spark, sf_dir):
    """Write prepared splits partitioned by cohort/split, read back."""
    path = sinks.scratch_path(spark, "splits")
    sinks.write_splits(tagged_splits(prepare_cohorts(spark, sf_dir)), path)
    back = sinks.read_splits(spark, path)
    return back.groupBy("cohort", "split").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.count_if(F.col("label") == 1).alias("n1"))


@register("feature_list", qp._sql(
    "SELECT CAST(row_number() OVER (ORDER BY o.ord) - 1 AS INTEGER) AS position, k.feature "
    "FROM kept k JOIN ords o ON o.feature = k.feature WHERE k.cohort = 'D1'",
    extra=[qf._feature_order_sql()]))
def feature_list(spark, sf_dir):
    """The ordered feature list (schema artifact) with positions."""
    return _d1_features(spark, sf_dir)
