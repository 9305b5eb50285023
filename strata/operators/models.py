"""Classifiers (M1-M7): the exact tree of ``cart``, the kernel SVM of
``kernel_svm`` and the network of ``network``, behind one interface. Beside
them, approximations that stay linear in the rows: Spark ML's binned tree, and
a linear SVM over random Fourier features (Rahimi & Recht, 2007).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import cart
from strata.operators import kernel_svm as ks
from strata.operators import network as net
from strata.operators.balance import with_class_weights
from strata.session import materialize

LABEL = "label"
SEED = 42

# The reference's hyper-parameter grids and network shape.
TREE_DEPTHS = (3, 5, 10, None)
SVM_C = (0.1, 1.0, 10.0)
MLP_HIDDEN = (128, 64, 32)
SPARK_MAX_DEPTH = 30   # of the binned tree: Spark's deepest


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    va = VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")
    return va.transform(df)


class PositiveF1(Evaluator):
    """F1 of the positive class with zero_division = 0 (the reference's
    scoring='f1'). Spark's ``fMeasureByLabel`` raises when a validation
    fold has neither a positive row nor a positive prediction; this is one
    ``count_if`` aggregate instead.
    """

    def _evaluate(self, dataset: DataFrame) -> float:
        y, p = F.col(LABEL) == 1, F.col("prediction") == 1
        r = dataset.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                        F.count_if(y & ~p).alias("fn")).first()
        den = 2 * r["tp"] + r["fp"] + r["fn"]
        return 2.0 * r["tp"] / den if den else 0.0

    def isLargerBetter(self) -> bool:
        return True


def f1_evaluator() -> Evaluator:
    return PositiveF1()


def tree_grid_search(train: DataFrame, fold_col: str = "fold", local_rows: int | None = None) -> "TreeModel":
    """M1 + M4: balanced-weight decision tree with exact thresholds, depth grid
    (None: unlimited), stratified CV by F1 (see ``cart``)."""
    data = train.select(F.col(LABEL), F.col(fold_col).alias("fold"), vector_to_array("features").alias("x"))
    return TreeModel(cart.grid_search(data, TREE_DEPTHS, local_rows))


class TreeModel:
    """A fitted ``CartModel`` behind the interface of the other models."""

    def __init__(self, tree: cart.CartModel):
        self.tree = tree

    def transform(self, df: DataFrame) -> DataFrame:
        return self.tree.transform(df, vector_to_array("features"))


def binned_tree_grid_search(train: DataFrame, fold_col: str = "fold", parallelism: int = 4,
                            num_folds: int = 5):
    """The same grid over Spark ML's tree (binned thresholds, depth 30 at most):
    one pass a level over any number of rows."""
    # written once: the grid fits read it many times
    data = materialize(with_class_weights(train.withColumn(LABEL, F.col(LABEL).cast("double"))), "tree-train")
    dt = DecisionTreeClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight",
                                seed=SEED)
    grid = ParamGridBuilder().addGrid(
        dt.maxDepth, [d if d is not None else SPARK_MAX_DEPTH for d in TREE_DEPTHS]).build()
    cv = CrossValidator(estimator=dt, estimatorParamMaps=grid, evaluator=f1_evaluator(),
                        foldCol=fold_col, numFolds=num_folds, parallelism=parallelism, seed=SEED)
    return cv.fit(data).bestModel


class RffSvm:
    """RBF-kernel SVM approximation: z(x) = sqrt(2/D) cos(W x + b) -> LinearSVC
    (balanced weights) -> Platt scaling (logistic regression on the margin).
    Linear in the rows, for tables beyond the dual solver's support vectors.

    W ~ N(0, 2 gamma), gamma = 1 / (d x var(X)) like the reference's default.
    The projection is an Arrow-batched pandas UDF (a dense matrix product
    per batch); D = ``components``.
    """

    def __init__(self, features_col="features", components: int = 256, c: float = 1.0,
                 seed: int = SEED):
        self.features_col, self.components, self.c, self.seed = features_col, components, c, seed
        self.w = self.b = None
        self.svm = self.platt = None

    def fit_projection(self, train: DataFrame) -> "RffSvm":
        """Draw the random features from the training data's dimension and variance."""
        d = len(train.select(self.features_col).first()[0])
        lg = train.select(F.explode(vector_to_array(self.features_col)).alias("v"))
        var_x = lg.agg(F.var_pop("v")).first()[0] or 1.0
        gamma = 1.0 / (d * var_x) if var_x > 0 else 1.0
        rng = np.random.default_rng(self.seed)
        self.w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(self.components, d))
        self.b = rng.uniform(0.0, 2.0 * np.pi, size=self.components)
        return self

    def project(self, df: DataFrame) -> DataFrame:
        w, b = self.w, self.b
        scale = float(np.sqrt(2.0 / self.components))

        @F.pandas_udf("array<double>")
        def rff(col: pd.Series) -> pd.Series:
            x = np.vstack(col.to_numpy()) if len(col) else np.zeros((0, w.shape[1]))
            return pd.Series(list(scale * np.cos(x @ w.T + b)))

        return df.withColumn("_rff", array_to_vector(rff(vector_to_array(F.col(self.features_col)))))

    def _svm(self, n: int, c: float) -> LinearSVC:
        return LinearSVC(featuresCol="_rff", labelCol=LABEL, weightCol="weight",
                         regParam=1.0 / (c * max(n, 1)), maxIter=50)

    def fit_projected(self, data: DataFrame, n: int, unseen: DataFrame) -> "RffSvm":
        """Fit the SVM on rows that carry ``_rff`` and ``weight``, and Platt
        scaling on ``unseen``: scored rows of models that were not fitted on them."""
        self.svm = self._svm(n, self.c).fit(data)
        margin = unseen.withColumn("_m", array_to_vector(F.array(vector_to_array("rawPrediction")[1])))
        self.platt = LogisticRegression(featuresCol="_m", labelCol=LABEL, maxIter=100).fit(
            margin.select("_m", LABEL))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        z = self.project(df)
        out = self.svm.transform(z).withColumnRenamed("prediction", "svm_prediction")
        out = out.withColumn("_m", array_to_vector(F.array(vector_to_array("rawPrediction")[1])))
        out = out.drop("rawPrediction", "probability")
        p = self.platt.transform(out)
        return (p.withColumn("prediction", F.col("svm_prediction"))
                 .drop("_rff", "_m", "svm_prediction", "rawPrediction"))


def rff_svm_grid_search(train: DataFrame, fold_col: str = "fold", components: int = 256,
                        parallelism: int = 4) -> RffSvm:
    """C of the approximate SVM by positive-class F1 over the stratified folds.

    The random-feature projection runs once (written); the C grid x folds are
    plain LinearSVC fits in a CrossValidator. The chosen C's fold models score
    the folds they have not seen, for the Platt scaling.
    """
    model = RffSvm(components=components).fit_projection(train)
    data = materialize(with_class_weights(
        model.project(train).withColumn(LABEL, F.col(LABEL).cast("double"))), "rff")
    n = data.count()
    folds = data.agg(F.max(fold_col)).first()[0] + 1
    est = model._svm(n, 1.0)
    grid = ParamGridBuilder().addGrid(est.regParam, [1.0 / (c * max(n, 1)) for c in SVM_C]).build()
    cvm = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=f1_evaluator(), foldCol=fold_col,
                         numFolds=folds, parallelism=parallelism, seed=SEED, collectSubModels=True).fit(data)
    best = max(range(len(SVM_C)), key=lambda k: (cvm.avgMetrics[k], -k))
    model.c = SVM_C[best]
    unseen = None
    for f in range(folds):
        part = cvm.subModels[f][best].transform(data.filter(F.col(fold_col) == f))
        unseen = part if unseen is None else unseen.unionByName(part)
    return model.fit_projected(data, n, unseen)


def svm_grid_search(train: DataFrame, id_col: str, fold_col: str = "fold", part_rows: int | None = None) -> "SvmModel":
    """M2 + M4: RBF-kernel SVM solved in the dual, C chosen by the positive
    class's F1 over the stratified folds (see ``kernel_svm``)."""
    data = train.select(F.col(id_col).cast("long").alias("id"), F.col(LABEL), F.col(fold_col).alias("fold"),
                        vector_to_array("features").alias("x"))
    folds = data.agg(F.max("fold")).first()[0] + 1
    return SvmModel(ks.fit(data, SVM_C, folds, part_rows), id_col)


class SvmModel:
    """A fitted ``KernelSvm`` behind the interface of the other models."""

    def __init__(self, svm: ks.KernelSvm, id_col: str):
        self.svm, self.id_col = svm, id_col

    def transform(self, df: DataFrame) -> DataFrame:
        return self.svm.transform(df, self.id_col, vector_to_array("features"))


def mlp(train: DataFrame, n_features: int, max_iter: int = 500, seed: int = SEED, **options) -> net.NetworkModel:
    """M3: d-128-64-32-1 ReLU network, Adam, batches of 200 rows, stopped early
    by a held-out tenth (see ``network.train``)."""
    return net.train(train, n_features, MLP_HIDDEN, max_iter, seed=seed, **options)


def fine_tune(model: net.NetworkModel, new_train: DataFrame, epochs: int = 50, batch_rows: int = 64,
              seed: int = SEED, **options) -> net.NetworkModel:
    """M7: ``epochs`` passes over new data in mini-batches, from the model's
    weights and optimiser state. The old model is unchanged."""
    return net.fine_tune(model, new_train, epochs, batch_rows, seed=seed, **options)


def with_score(pred: DataFrame) -> DataFrame:
    """M5: P(label = 1) as ``score`` next to ``prediction``."""
    return pred.withColumn("score", vector_to_array("probability")[1])


def importances(model, features: list[str]) -> list[tuple[str, float]]:
    """M6: feature importance pairs of a fitted tree."""
    imp = model.tree.importances() if isinstance(model, TreeModel) else model.featureImportances.toArray()
    return [(f, float(v)) for f, v in zip(features, imp)]


def save(model, path: str) -> None:
    """Persist a fitted model: Parquet for trees and networks of this
    library, Spark ML's format for its models."""
    if isinstance(model, TreeModel):
        model.tree.save(path)
    elif isinstance(model, net.NetworkModel):
        model.save(SparkSession.getActiveSession(), path)
    else:
        model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


__all__ = ["assemble", "tree_grid_search", "TreeModel", "binned_tree_grid_search", "SvmModel", "svm_grid_search", "RffSvm", "rff_svm_grid_search", "mlp", "fine_tune",
           "with_score", "importances", "save", "load_pipeline", "Pipeline"]
