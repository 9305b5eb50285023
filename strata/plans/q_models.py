"""Registered queries: class balance and models.

SMOTE neighbours and post-SMOTE class counts have exact oracles. SQL cannot
express the fits: they are tested against numpy replays and brute-force duals
in ``tests/test_network.py`` and ``tests/test_kernel_svm.py``. A fitted model
is kept for the session, so queries that need the same one share it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import balance as ba
from strata.operators import evaluate as ev
from strata.operators import models as mo
from strata.operators import preprocess as pp
from strata.plans.common import compose, r, register, rounded
from strata.plans.workflow import prepare_cohorts
from strata.sources.tables import read_table

KEY = "PATIENT"

# Stand-in: embeddings with label 0 as the rare positive class (10 %).
EMB_SQL = ("emb AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, "
           "CAST(CASE WHEN label = 0 THEN 1 ELSE 0 END AS INTEGER) AS label FROM embeddings)")


def embedding_train(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"),
                    (F.col("label") == 0).cast("int").alias("label"))


@register("smote_neighbors", compose([], [EMB_SQL], (
    "SELECT id, nbr_id, CAST(rank AS INTEGER) AS rank, " + r("dist") + " AS dist FROM ("
    "SELECT a.id, b.id AS nbr_id, sqrt(list_sum(list_transform(range(1, len(a.vec) + 1), "
    "lambda i: (a.vec[i] - b.vec[i]) * (a.vec[i] - b.vec[i])))) AS dist, row_number() OVER (PARTITION BY a.id "
    "ORDER BY sqrt(list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: (a.vec[i] - b.vec[i]) * "
    "(a.vec[i] - b.vec[i])))), b.id) AS rank FROM emb a JOIN emb b ON a.id <> b.id "
    "WHERE a.label = 1 AND b.label = 1) WHERE rank <= 5")))
def smote_neighbors(spark, sf_dir):
    """Exact 5 nearest minority neighbours of every minority row (the
    oracle is brute force; ours skips cells by the triangle inequality)."""
    mino = embedding_train(spark, sf_dir).filter(F.col("label") == 1)
    return rounded(ba.knn_within(mino, 5))


@register("smote_balanced", compose([], [EMB_SQL], (
    "SELECT CAST(label AS INTEGER) AS label, CAST(max(n) OVER () AS BIGINT) AS n_rows, "
    "CAST(max(n) OVER () - n AS BIGINT) AS n_synthetic FROM "
    "(SELECT label, count(*) AS n FROM emb GROUP BY label)")))
def smote_balanced(spark, sf_dir):
    """Classes after SMOTE -- minority raised to the majority count."""
    out = ba.smote(embedding_train(spark, sf_dir), k=5)
    return out.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("synthetic")).alias("n_synthetic"))


def _model_data(spark, sf_dir):
    prepared = prepare_cohorts(spark, sf_dir)
    feats = prepared["D1"].features
    d1, d2 = (mo.assemble(prepared[c].frame, feats).select(KEY, "label", "split", "features") for c in ("D1", "D2"))
    return d1, d2, feats


_FITTED: dict[tuple, object] = {}


def _fitted(spark, sf_dir, name, fit):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _metrics(model_name, model, tests):
    out = None
    for name, test in tests.items():
        pred = mo.with_score(model.transform(test)).select("label", "prediction", "score")
        m = ev.binary_metrics(pred.withColumn("model", F.lit(model_name))
                                  .withColumn("evaluated_on", F.lit(name)),
                              ["model", "evaluated_on"])
        out = m if out is None else out.unionByName(m)
    return out


def _tests(d1, d2):
    return {"D1": d1.filter(F.col("split") == "test"), "D2": d2.filter(F.col("split") == "test")}


def _folds(d1):
    return pp.fold_assignment(d1.filter(F.col("split") == "train"), 5)


def _tree(spark, sf_dir, d1):
    return _fitted(spark, sf_dir, "tree", lambda: mo.tree_grid_search(_folds(d1)))


def _svm(spark, sf_dir, d1):
    return _fitted(spark, sf_dir, "svm", lambda: mo.svm_grid_search(_folds(d1), KEY))


def _mlp(spark, sf_dir, d1, feats):
    return _fitted(spark, sf_dir, "mlp", lambda: mo.mlp(_smote_vectors(d1), len(feats), key_cols=["id"]))


@register("tree_model_metrics")
def tree_model_metrics(spark, sf_dir):
    """Tree chosen by 5-fold stratified CV on D1 train."""
    d1, d2, _ = _model_data(spark, sf_dir)
    return rounded(_metrics("DT", _tree(spark, sf_dir, d1), _tests(d1, d2)), 4)


@register("tree_importance_top20")
def tree_importance_top20(spark, sf_dir):
    """20 largest feature importances of the selected tree."""
    d1, _, feats = _model_data(spark, sf_dir)
    pairs = mo.importances(_tree(spark, sf_dir, d1), feats)
    df = spark.createDataFrame(pairs, "feature string, importance double")
    return rounded(df.orderBy(F.desc("importance"), "feature").limit(20), 6)


@register("svm_kernel_metrics")
def svm_kernel_metrics(spark, sf_dir):
    """M2 / M4: RBF-kernel SVM, C chosen by stratified CV on D1 train."""
    d1, d2, _ = _model_data(spark, sf_dir)
    return rounded(_metrics("SVM", _svm(spark, sf_dir, d1), _tests(d1, d2)), 4)


@register("svm_rff_metrics")
def svm_rff_metrics(spark, sf_dir):
    """M2 / M4: the SVM over random Fourier features, same grid and folds."""
    d1, d2, _ = _model_data(spark, sf_dir)
    svm = _fitted(spark, sf_dir, "rff", lambda: mo.rff_svm_grid_search(_folds(d1)))
    return rounded(_metrics("SVM", svm, _tests(d1, d2)), 4)


def _smote_vectors(df):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    tr = df.filter(F.col("split") == "train").select(
        F.col(KEY).alias("id"), vector_to_array("features").alias("vec"), "label")
    bal = ba.smote(tr, k=5)
    return bal.select("id", array_to_vector("vec").alias("features"), "label")


@register("mlp_metrics")
def mlp_metrics(spark, sf_dir):
    """M3: 128-64-32 network trained on SMOTE-balanced D1 train."""
    d1, d2, feats = _model_data(spark, sf_dir)
    return rounded(_metrics("MLP", _mlp(spark, sf_dir, d1, feats), _tests(d1, d2)), 4)


@register("continual_finetune")
def continual_finetune(spark, sf_dir):
    """M7 / M8: D1 network trained on with SMOTE-balanced D2 train, 50 epochs
    of batches of 64; metrics on D2 test before and after, with deltas."""
    d1, d2, feats = _model_data(spark, sf_dir)
    base = _mlp(spark, sf_dir, d1, feats)
    tuned = mo.fine_tune(base, _smote_vectors(d2), epochs=50, batch_rows=64, key_cols=["id"])
    test = {"D2": d2.filter(F.col("split") == "test")}
    m = _metrics("MLP_D1", base, test).unionByName(_metrics("MLP_CL", tuned, test))
    return rounded(ev.before_after(m, "MLP_D1", "MLP_CL"), 4)


@register("evaluate_all")
def evaluate_all(spark, sf_dir):
    """The three models on both test sets, pivoted by set."""
    d1, d2, feats = _model_data(spark, sf_dir)
    tests = _tests(d1, d2)
    m = _metrics("DT", _tree(spark, sf_dir, d1), tests)
    m = m.unionByName(_metrics("SVM", _svm(spark, sf_dir, d1), tests))
    m = m.unionByName(_metrics("MLP", _mlp(spark, sf_dir, d1, feats), tests))
    return rounded(ev.metrics_pivot(m), 4)
