"""Model fitting and scoring with ``pyspark.ml`` pipelines.

Every model is one ``Pipeline`` (assemble -> standardise -> estimator) so
training and scoring always see the same transformation. The training frame
is checkpointed to the cluster's shared checkpoint folder first: iterative
fits then re-read it instead of replaying the feature lineage after a lost
executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from . import forest
from .naive_bayes import GaussianModel, fit_gaussian


TREES = ("rf", "dt")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``class_weight='balanced'``: n / (k * n_class), joined from a per-class table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.struct(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")).alias("s")).scalar()
    w = counts.select(label, (tot["n"] / (tot["k"] * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)  # one row per class


def estimator(kind: str, label: str, features: str = "scaled", weight: str | None = None,
              seed: int = C.SEED, num_trees: int = C.N_TREES, n_rows: int | None = None,
              max_depth: int = C.TREE_DEPTH):
    """A classifier. ``max_depth`` bounds trees (Spark allows up to 30).

    Rows remember the node they have reached (``cacheNodeIds``, checkpointed in the
    shared folder), so a deep level costs no walk from the root.
    """
    deep = dict(maxDepth=max_depth, seed=seed, cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=C.TREE_MEMORY_MB)
    if kind == "rf":
        e = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees, **deep)
    elif kind == "dt":
        e = DecisionTreeClassifier(featuresCol=features, labelCol=label, **deep)
    elif kind == "lr":
        # sklearn's C=1 penalises the summed loss; Spark's regParam the mean loss
        e = LogisticRegression(featuresCol=features, labelCol=label, maxIter=1000,
                               regParam=1.0 / max(n_rows or 1, 1), elasticNetParam=0.0)
    else:
        raise ValueError(kind)
    if weight:
        e.setWeightCol(weight)
    return e


def fit(train: DataFrame, feature_cols: Sequence[str], label: str, kind: str = "rf",
        weight: str | None = None, scale: bool = True, seed: int = C.SEED,
        num_trees: int = C.N_TREES, checkpoint: bool = True, max_depth: int = C.TREE_DEPTH, shared: dict | None = None) -> PipelineModel | GaussianModel:
    """A model of one kind. Trees leave their preparation and binned rows in ``shared``, for further fits of the same training rows."""
    if kind == "nb":
        return fit_gaussian(train, feature_cols, label)  # one pass: nothing to keep
    train = train.withColumn(label, F.col(label).cast("double"))
    if checkpoint:
        train = cut_lineage(train)
    n_rows = train.count() if kind == "lr" else None
    stages = [VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    last = estimator(kind, label, "scaled" if scale else "features", weight, seed, num_trees, n_rows, max_depth)
    if kind not in TREES:
        return Pipeline(stages=[*stages, last]).fit(train)
    shared = {} if shared is None else shared
    if "prepared" not in shared:
        shared["prepared"] = Pipeline(stages=stages).fit(train)
    prepared = shared["prepared"]
    return PipelineModel(stages=[*prepared.stages, fit_trees(last, prepared.transform(train), shared)])


def fit_trees(e, train: DataFrame, shared: dict | None = None):
    """The trees that a Spark estimator describes, grown by ``forest``: neither trees nor nodes need to fit the driver.

    Weights have to be the same for all rows of a class, as balanced ones are; for others the estimator itself is fitted.
    """
    label, weight = e.getLabelCol(), e.getWeightCol() if e.isDefined(e.weightCol) else None
    w = F.col(weight) if weight else F.lit(1.0)
    rows = train.groupBy(F.col(label).cast("int").alias("y")).agg(F.min(w).alias("a"), F.max(w).alias("b")).collect()
    if any(r.a != r.b for r in rows):
        return e.fit(train)
    found = {r.y: float(r.a) for r in rows}
    weights = [found.get(y, 1.0) for y in range(max(found, default=0) + 1)]
    trees = e.getNumTrees() if isinstance(e, RandomForestClassifier) else 1
    shared = {} if shared is None else shared
    if "binned" not in shared:
        shared["binned"] = forest.bins(train, e.getFeaturesCol(), [label])
    return forest.fit_forests(train, e.getFeaturesCol(), [label], trees, e.getMaxDepth(), e.getSeed(), [weights], max(len(weights), 2), binned=shared["binned"])[0]


def fit_forests(train: DataFrame, feature_cols: Sequence[str], labels: Sequence[str], weights: Sequence[Sequence[float]], seed: int = C.SEED,
                num_trees: int = C.N_TREES, max_depth: int = C.TREE_DEPTH, threads: int = 1) -> tuple[PipelineModel, list]:
    """The preparation and one forest per 0/1 column of ``labels``, with its class weights; rows are binned once for all."""
    prepared = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep"),
                                StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)]).fit(train)
    e = estimator("rf", labels[0], seed=seed, num_trees=num_trees, max_depth=max_depth)
    with ThreadPoolExecutor(max_workers=threads) as pool:  # independent fits, whose jobs share the cluster
        return prepared, forest.fit_forests(prepared.transform(train), "scaled", labels, e.getNumTrees(), e.getMaxDepth(), e.getSeed(), weights, fit_all=pool.map)


def score_forests(prepared: PipelineModel, models: Sequence, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with the probability of class 1 from every forest, in one pass."""
    p = forest.probabilities(prepared.transform(df), "scaled", models, "_all")
    return p.select(*df.columns, *[F.col("_all")[i][1].alias(n) for i, n in enumerate(names)])


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], prob_col: str = "probability_1") -> DataFrame:
    """Keys plus predicted class and the probability of class 1."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias(prob_col))


def kmeans(df: DataFrame, cols: Sequence[str], k: int = C.N_CLUSTERS, scale: bool = False,
           seed: int = C.SEED, starts: int = C.CLUSTER_STARTS):
    """The clustering of least cost among ``starts`` fits with seeds of their own (ties: the first)."""
    stages = [VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip")]
    if scale:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    prepared = Pipeline(stages=stages).fit(df)
    x = cut_lineage(prepared.transform(df).select("scaled" if scale else "features"))  # read by every start
    fits = [KMeans(k=k, seed=seed + i, featuresCol=x.columns[0], predictionCol="cluster").fit(x) for i in range(starts)]
    return PipelineModel(stages=[*prepared.stages, min(fits, key=lambda m: m.summary.trainingCost)])


def cluster_centres(model: PipelineModel) -> list[list[float]]:
    """Centres of a fitted clustering, in the space in which rows were compared."""
    return [[float(v) for v in c] for c in model.stages[-1].clusterCenters()]


def pca(df: DataFrame, cols: Sequence[str], k: int = 3) -> PipelineModel:
    stages = [VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip"),
              StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False),
              PCA(k=k, inputCol="centred", outputCol="pca")]
    return Pipeline(stages=stages).fit(df)


def component_signs(model: PipelineModel) -> list[float]:
    """1 or -1 per principal component, so that its greatest loading (ties: the first column) is positive."""
    loadings = model.stages[-1].pc.toArray()
    return [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
