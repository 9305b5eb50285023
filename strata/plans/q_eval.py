"""Registered queries: evaluation operators on deterministic stand-in scores
(E1-E5, W3, A31, M8, X13, U3).

Stand-in predictions: documents joined to labels; label = toxic; two
"models" score every document from its own text -- ``chars`` from the
character count, ``words`` from the word count of the whole text --
and ``evaluated_on`` is D1 for English documents, D2 otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.plans.common import compose, r, register, rounded
from strata.sources.tables import read_table

GROUPS = ["model", "evaluated_on"]

PRED_SQL = (
    "preds AS (SELECT model, evaluated_on, doc_id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction "
    "FROM (SELECT 'chars' AS model, CASE WHEN lang = 'en' THEN 'D1' ELSE 'D2' END AS evaluated_on, d.doc_id, "
    "l.toxic AS label, round(n_chars / (n_chars + 1500.0), 3) AS score FROM documents d JOIN labels l "
    "ON d.doc_id = l.doc_id UNION ALL "
    "SELECT 'words', CASE WHEN lang = 'en' THEN 'D1' ELSE 'D2' END, d.doc_id, l.toxic, "
    "round(len(string_split(text, ' ')) / (len(string_split(text, ' ')) + 250.0), 3) "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id))")


def predictions(spark, sf_dir):
    """One scan of documents x labels; both scorers in one projection,
    exploded to one row per (model, document)."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id")
    words = F.size(F.split(F.col("text"), " "))
    scores = F.array(
        F.struct(F.lit("chars").alias("model"),
                 F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(1500.0)), 3).alias("score")),
        F.struct(F.lit("words").alias("model"),
                 F.round(words / (words + F.lit(250.0)), 3).alias("score")))
    u = j.select(F.when(F.col("lang") == "en", "D1").otherwise("D2").alias("evaluated_on"), "doc_id",
                 F.col("toxic").alias("label"), F.explode(scores).alias("m"))
    u = u.select(F.col("m.model").alias("model"), "evaluated_on", "doc_id", "label",
                 F.col("m.score").alias("score"))
    return u.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def _sql(final, *ctes):
    return compose([], [PRED_SQL, *ctes], final)


COUNTS = ("cm AS (SELECT model, evaluated_on, count(*) AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, "
          "count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp, "
          "count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn, "
          "count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM preds GROUP BY model, evaluated_on)")
AUC = ("sc AS (SELECT model, evaluated_on, score, count(*) FILTER (WHERE label = 1) AS pos, "
       "count(*) FILTER (WHERE label <> 1) AS neg FROM preds GROUP BY model, evaluated_on, score)",
       "auc AS (SELECT model, evaluated_on, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc "
       "FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, evaluated_on ORDER BY score "
       "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc) GROUP BY model, evaluated_on)")
METRIC_SQL = ("met AS (SELECT c.model, c.evaluated_on, CAST(n AS BIGINT) AS n, CAST(tp AS BIGINT) AS tp, "
              "CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, "
              "(tp + tn) * 1.0 / n AS accuracy, coalesce(tp * 1.0 / nullif(tp + fp, 0), 0.0) AS precision, "
              "coalesce(tp * 1.0 / nullif(tp + fn, 0), 0.0) AS recall, "
              "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1, a.roc_auc FROM cm c "
              "JOIN auc a ON a.model = c.model AND a.evaluated_on = c.evaluated_on)")


@register("binary_metrics", _sql(
    "SELECT model, evaluated_on, n, tp, fp, fn, tn, " + ", ".join(
        f"{r(m)} AS {m}" for m in ev.METRICS) + " FROM met", COUNTS, *AUC, METRIC_SQL))
def binary_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1, AUC for every model x set."""
    return rounded(ev.binary_metrics(predictions(spark, sf_dir), GROUPS))


@register("roc_auc", _sql(f"SELECT model, evaluated_on, {r('roc_auc')} AS roc_auc FROM auc", *AUC))
def roc_auc(spark, sf_dir):
    """Rank-based AUC with half credit for ties."""
    return rounded(ev.roc_auc(predictions(spark, sf_dir), GROUPS))


@register("confusion_matrix", _sql(
    "SELECT model, evaluated_on, CAST(label AS INTEGER) AS label, "
    "CAST(count(*) FILTER (WHERE prediction = 0) AS BIGINT) AS pred_0, "
    "CAST(count(*) FILTER (WHERE prediction = 1) AS BIGINT) AS pred_1 FROM preds "
    "GROUP BY model, evaluated_on, label"))
def confusion_matrix(spark, sf_dir):
    """2 x 2 confusion counts per model x set."""
    return ev.confusion_matrix(predictions(spark, sf_dir), GROUPS)


ROC_SQL = (
    "pts AS (SELECT model, evaluated_on, NULL::DOUBLE AS threshold, 0::BIGINT AS tps, 0::BIGINT AS fps "
    "FROM sc GROUP BY model, evaluated_on UNION ALL SELECT model, evaluated_on, score, "
    "CAST(sum(pos) OVER w AS BIGINT), CAST(sum(neg) OVER w AS BIGINT) FROM sc "
    "WINDOW w AS (PARTITION BY model, evaluated_on ORDER BY score DESC ROWS UNBOUNDED PRECEDING))",
    "nb AS (SELECT *, lag(tps) OVER o AS tp_prev, lead(tps) OVER o AS tp_next, lag(fps) OVER o AS fp_prev, "
    "lead(fps) OVER o AS fp_next FROM pts WINDOW o AS (PARTITION BY model, evaluated_on ORDER BY tps, fps))",
    "tot AS (SELECT model, evaluated_on, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY model, evaluated_on)")


@register("roc_points", _sql(
    f"SELECT nb.model, nb.evaluated_on, {r('threshold')} AS threshold, {r('fps * 1.0 / N')} AS fpr, "
    f"{r('tps * 1.0 / P')} AS tpr FROM nb JOIN tot ON tot.model = nb.model AND tot.evaluated_on = nb.evaluated_on "
    "WHERE tp_prev IS NULL OR tp_next IS NULL OR tp_next - 2 * tps + tp_prev <> 0 OR fp_next - 2 * fps + fp_prev <> 0",
    AUC[0], *ROC_SQL))
def roc_points(spark, sf_dir):
    """ROC points with collinear intermediates dropped."""
    return rounded(ev.roc_points(predictions(spark, sf_dir), GROUPS))


@register("metrics_pivot", _sql(
    "SELECT model, metric, " + r("max(value) FILTER (WHERE evaluated_on = 'D1')", 3) + " AS D1, "
    + r("max(value) FILTER (WHERE evaluated_on = 'D2')", 3) + " AS D2 FROM (" + " UNION ALL ".join(
        f"SELECT model, evaluated_on, '{m}' AS metric, {m} AS value FROM met" for m in ev.METRICS)
    + ") GROUP BY model, metric", COUNTS, *AUC, METRIC_SQL))
def metrics_pivot(spark, sf_dir):
    """Metric table pivoted to one column per evaluation set."""
    m = ev.binary_metrics(predictions(spark, sf_dir), GROUPS)
    return rounded(ev.metrics_pivot(m), 3)


@register("before_after", _sql(
    "SELECT metric, " + r("b", 4) + " AS before, " + r("a", 4) + " AS after, " + r("a - b", 4)
    + " AS delta, CASE WHEN a - b > 0 THEN 'improved' WHEN a - b < 0 THEN 'dropped' ELSE 'same' END AS change "
    "FROM (SELECT metric, max(value) FILTER (WHERE model = 'chars') AS b, max(value) FILTER (WHERE model = 'words') AS a "
    "FROM (" + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM met WHERE evaluated_on = 'D2'"
                                  for m in ev.METRICS) + ") GROUP BY metric)", COUNTS, *AUC, METRIC_SQL))
def before_after(spark, sf_dir):
    """M8: two models on the D2 set, deltas and improved/dropped flag."""
    m = ev.binary_metrics(predictions(spark, sf_dir), GROUPS).filter(F.col("evaluated_on") == "D2")
    return rounded(ev.before_after(m, "chars", "words"), 4)


@register("metrics_csv_roundtrip", _sql(
    "SELECT model, " + ", ".join(f"{r(m)} AS {m}" for m in ev.METRICS) + ", evaluated_on FROM met",
    COUNTS, *AUC, METRIC_SQL))
def metrics_csv_roundtrip(spark, sf_dir):
    """Metric table written as CSV and read with its fixed schema."""
    from strata.sources import sinks
    path = sinks.scratch_path(spark, "metrics")
    m = ev.binary_metrics(predictions(spark, sf_dir), GROUPS)
    sinks.write_table_csv(m.select("model", "accuracy", "precision", "recall", "f1", "roc_auc", "evaluated_on"), path)
    return rounded(sinks.read_metrics_csv(spark, path))
