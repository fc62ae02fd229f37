"""Naive Bayes from sufficient statistics.

Both models are one grouped aggregate over the training rows; scoring is a column
expression (Gaussian) or a join with a table of at most vocabulary x classes numbers
(multinomial). Nothing iterates, and any SQL engine repeats the answer.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import add

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of a feature's variance over all rows that is added to its variance in each class.
VARIANCE_SMOOTHING = 1e-9
#: Added to each class's weight of a term.
TERM_SMOOTHING = 1.0


def softmax(logs: Sequence[Column]) -> list[Column]:
    """Probabilities from unnormalised logarithms, free of overflow."""
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    total = reduce(add, [F.exp(x - top) for x in logs])
    return [F.exp(x - top) / total for x in logs]


@dataclass
class GaussianModel:
    """Class-wise count, mean and variance of each feature."""

    features: list[str]
    classes: list[float]
    counts: list[int]
    means: list[list[float]]
    variances: list[list[float]]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "GaussianModel":
        return GaussianModel(**json.loads(s))

    def log_densities(self) -> list[Column]:
        total, out = sum(self.counts), []
        for n, means, variances in zip(self.counts, self.means, self.variances, strict=True):
            start = math.log(n / total) - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
            terms = [F.pow(F.col(f) - F.lit(m), 2) * F.lit(-0.5 / v) for f, m, v in zip(self.features, means, variances, strict=True)]
            out.append(reduce(add, terms, F.lit(start)))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (vector over the classes) and ``prediction`` (ties: the first class)."""
        p = F.array(*softmax(self.log_densities()))
        best = F.array_position(F.col("_p"), F.array_max("_p")).cast("int")
        return (df.withColumn("_p", p).withColumn("prediction", F.element_at(F.array(*[F.lit(float(c)) for c in self.classes]), best))
                .withColumn("probability", array_to_vector("_p")).drop("_p"))


def fit_gaussian(train: DataFrame, features: Sequence[str], label: str, smoothing: float = VARIANCE_SMOOTHING) -> GaussianModel:
    """One aggregate by class.

    Each variance grows by ``smoothing`` times the feature's variance over all rows (1 for a
    constant feature): the model of standardised features, without standardising. Rows without
    a label don't count.
    """
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(features):
        aggregates += [F.avg(F.col(f)).alias(f"m{i}"), F.var_pop(F.col(f)).alias(f"v{i}")]
    rows = sorted(train.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("double").alias("_class")).agg(*aggregates).collect(),
                  key=lambda r: r["_class"])
    if not rows:
        raise ValueError("no labelled rows")
    total, counts = sum(r["n"] for r in rows), [r["n"] for r in rows]
    means = [[r[f"m{i}"] for i in range(len(features))] for r in rows]
    within = [[r[f"v{i}"] for i in range(len(features))] for r in rows]
    variances = [[0.0] * len(features) for _ in rows]
    for i in range(len(features)):
        mean = sum(n * m[i] for n, m in zip(counts, means, strict=True)) / total
        whole = sum(n * (v[i] + (m[i] - mean) ** 2) for n, m, v in zip(counts, means, within, strict=True)) / total
        for k in range(len(rows)):
            variances[k][i] = within[k][i] + smoothing * (whole or 1.0)
    return GaussianModel(list(features), [r["_class"] for r in rows], counts, means, variances)


@dataclass
class MultinomialModel:
    """Terms with their inverse document frequency and one log probability per class."""

    classes: list[str]
    priors: list[float]
    terms: DataFrame  # term, idf, logs (array over the classes); at most the vocabulary


def fit_multinomial(weights: DataFrame, labels: DataFrame, idf: DataFrame, smoothing: float = TERM_SMOOTHING) -> MultinomialModel:
    """``weights``: (doc, term, w); ``labels``: (doc, label), nulls don't count; ``idf``: the vocabulary (term, idf)."""
    labels = labels.where(F.col("label").isNotNull())
    counts = sorted(labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["label"])
    if not counts:
        raise ValueError("no labelled rows")
    classes, total = [r["label"] for r in counts], sum(r["n"] for r in counts)
    sums = weights.join(labels, "doc").groupBy("term").agg(*[
        F.sum(F.when(F.col("label") == c, F.col("w"))).alias(f"s{i}") for i, c in enumerate(classes)])
    filled = idf.join(sums, "term", "left").select("term", "idf", *[F.coalesce(f"s{i}", F.lit(0.0)).alias(f"s{i}") for i in range(len(classes))])
    whole = filled.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(classes))]).first()
    logs = [F.log((F.col(f"s{i}") + smoothing) / F.lit((whole[f"s{i}"] or 0.0) + smoothing * whole["v"])) for i in range(len(classes))]
    return MultinomialModel(classes, [math.log(r["n"] / total) for r in counts], filled.select("term", "idf", F.array(*logs).alias("logs")))


def score_multinomial(model: MultinomialModel, weights: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, label, probabilities) of all ``docs`` (doc); one without a known term has the priors. Ties: the first class."""
    n = len(model.classes)
    known = weights.join(F.broadcast(model.terms.select("term", "logs")), "term")  # the vocabulary
    sums = known.groupBy("doc").agg(*[F.sum(F.col("w") * F.col("logs")[i]).alias(f"l{i}") for i in range(n)])
    logs = [F.lit(model.priors[i]) + F.coalesce(f"l{i}", F.lit(0.0)) for i in range(n)]
    p = docs.join(sums, "doc", "left").select("doc", F.array(*softmax(logs)).alias("probabilities"))
    best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
    return p.select("doc", F.element_at(F.array(*[F.lit(c) for c in model.classes]), best).alias("label"), "probabilities")
