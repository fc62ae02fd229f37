"""Review text: TF-IDF, sentiment models, customer segments, term counts."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyarrow import dataset, fs
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .. import config as C
from ..functions import text as T
from ..functions.stats import cut_right_closed
from ..session import cut_lineage
from . import models as Mo
from . import naive_bayes as NB
from .quantiles import prefix_sums


#: Bytes of text in one partition of documents: what a task holds of their terms does not grow with the corpus.
PARTITION_BYTES = 16 << 20


def text_partitions(df: DataFrame, text_col: str) -> int:
    """Partitions of ``PARTITION_BYTES`` of text, and one for every core at least."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))


def term_counts_by_doc(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, term, tf), written once in partitions by document: vocabulary and weights both read it."""
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    # Partition by document once, by an explicit number that grows with the texts: tokenising
    # runs in parallel, and the per-doc term counts then need no further shuffle.
    docs = docs.repartition(text_partitions(docs, "text"), "doc")
    toks = docs.select("doc", F.explode(T.tokens(F.col("text"))).alias("term"))
    return cut_lineage(toks.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf")))


def inverse_frequencies(tf: DataFrame, n_docs: Column | int, vocab_size: int = C.TFIDF_VOCAB_SIZE) -> DataFrame:
    """(term, idf) of the ``vocab_size`` most frequent terms (ties by term): ln((1+n)/(1+df)) + 1."""
    vocab = (tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
             .orderBy(F.col("total").desc(), F.col("term")).limit(vocab_size))
    return vocab.select("term", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def term_weights(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """(doc, term, w): counts x idf of the vocabulary's terms, L2 normalised per document, in as many partitions as ``tf``."""
    w = tf.join(F.broadcast(idf), "term").select("doc", "term", (F.col("tf") * F.col("idf")).alias("w"))
    w = w.repartition(tf.rdd.getNumPartitions(), "doc")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return w.select("doc", "term", (F.col("w") / norm).alias("w"))


def tfidf(docs: DataFrame, id_col: str, text_col: str, vocab_size: int = C.TFIDF_VOCAB_SIZE) -> DataFrame:
    """(doc id, term, tfidf): raw counts x smooth idf ln((1+n)/(1+df)) + 1, L2
    normalised per document, over the ``vocab_size`` most frequent terms
    (ties by term). Long form, one shuffle per aggregate; the vocabulary is a
    top-k of bounded size joined back by broadcast."""
    tf = term_counts_by_doc(docs, id_col, text_col)
    idf = inverse_frequencies(tf, docs.agg(F.count(F.lit(1))).scalar(), vocab_size)
    return term_weights(tf, idf).select(F.col("doc").alias(id_col), "term", F.col("w").alias("tfidf"))


def train_naive_bayes(labelled: DataFrame, id_col: str, label_col: str = "sentiment_label", text_col: str = "review_text",
                      vocab_size: int = C.TFIDF_VOCAB_SIZE) -> NB.MultinomialModel:
    """Multinomial naive Bayes over the TF-IDF weights of the labelled texts."""
    tf = term_counts_by_doc(labelled, id_col, text_col)
    idf = cut_lineage(inverse_frequencies(tf, labelled.count(), vocab_size))
    model = NB.fit_multinomial(term_weights(tf, idf), labelled.select(F.col(id_col).alias("doc"), F.col(label_col).alias("label")), idf)
    return NB.MultinomialModel(model.classes, model.priors, cut_lineage(model.terms))


def score_naive_bayes(model: NB.MultinomialModel, reviews: DataFrame, id_col: str, keep: Sequence[str] = (),
                      text_col: str = "review_text", score_class: str = "positive") -> DataFrame:
    """``id_col``, ``keep``, predicted label and the probability of ``score_class`` (null if never seen) per review.

    ``id_col`` tells reviews apart; rows that share one are scored as one text would be, together.
    """
    tf = term_counts_by_doc(reviews, id_col, text_col)
    docs = reviews.select(F.col(id_col).alias("doc")).distinct()
    s = NB.score_multinomial(model, term_weights(tf, model.terms.select("term", "idf")), docs)
    at = model.classes.index(score_class) if score_class in model.classes else None
    p = F.col("probabilities")[at] if at is not None else F.lit(None).cast("double")
    s = s.select(F.col("doc").alias(id_col), F.col("label").alias("sentiment"), p.alias("sentiment_score"))
    return reviews.select(id_col, *keep).join(s, id_col, "left").select(id_col, *keep, "sentiment", "sentiment_score")


def prepare_text(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    return df.withColumn("text_clean", T.normalize(F.coalesce(F.col(text_col), F.lit(""))))


def train_sentiment(labelled: DataFrame, kind: str = "lr", label_col: str = "sentiment_label",
                    vocab_size: int = C.TFIDF_VOCAB_SIZE, seed: int = C.SEED,
                    max_depth: int = C.TREE_DEPTH) -> PipelineModel:
    """Label index (alphabetical) -> tokens -> counts (top terms) -> smooth idf + 1 -> L2 -> classifier.

    Weights are those of ``tfidf``: the fitted inverse document frequencies
    plus one scale the counts, so a term of every document keeps weight.
    """
    train = cut_lineage(prepare_text(labelled).select("text_clean", label_col))
    counts = Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"),
        RegexTokenizer(inputCol="text_clean", outputCol="tokens", pattern=C.TOKEN_PATTERN, gaps=False, toLowercase=False),
        CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=vocab_size)]).fit(train)
    idf = IDF(inputCol="tf", outputCol="idf").fit(counts.transform(train)).idf  # at most ``vocab_size`` numbers
    weights = PipelineModel(stages=[
        *counts.stages, ElementwiseProduct(scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="features", p=2.0)])
    n_rows = train.count() if kind == "lr" else None
    classifier = Mo.estimator(kind, "label", "features", seed=seed, n_rows=n_rows, max_depth=max_depth)
    rows = weights.transform(train).withMetadata("label", {})  # which would count a class of unknown labels, of which no row is
    if kind == "lr":  # up to 1,000 passes: no more tasks in each than there is text for
        rows = rows.coalesce(text_partitions(train, "text_clean"))
    return PipelineModel(stages=[*weights.stages, Mo.fit_trees(classifier, rows) if kind in Mo.TREES else classifier.fit(rows)])


def score_reviews(model: PipelineModel, reviews: DataFrame, keep: Sequence[str],
                  score_index: int | None = None, score_class: str = "positive") -> DataFrame:
    """Predicted label and a class score per review; ``score_index`` reproduces
    a fixed probability position, otherwise the probability of ``score_class``."""
    labels = model.stages[0].labels
    idx = score_index if score_index is not None else labels.index(score_class)
    out = model.transform(prepare_text(reviews))
    lab = F.get(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int"))  # null for the class of rows trained without a label
    return out.select(*keep, lab.alias("sentiment"), vector_to_array("probability")[idx].alias("sentiment_score"))


def customer_type(score: Column) -> Column:
    """<= 0.3 Detractor, <= 0.7 Neutral, else Promoter (right-closed bins)."""
    return cut_right_closed(score, [C.DETRACTOR_MAX, C.PROMOTER_MIN], ["Detractor", "Neutral", "Promoter"])


def customer_type_two_scores(neg: Column, pos: Column) -> Column:
    """negative > 0.3 Detractor, else positive > 0.7 Promoter, else Neutral."""
    return (F.when(F.coalesce(neg, F.lit(0.0)) > C.DETRACTOR_MAX, "Detractor")
            .when(F.coalesce(pos, F.lit(0.0)) > C.PROMOTER_MIN, "Promoter").otherwise("Neutral"))


def term_counts(df: DataFrame, segment_col: str, text_col: str, top_n: int | None = None) -> DataFrame:
    """Terms per segment with their count and rank (ties by term); with
    ``top_n`` only the first of each segment, planned as a window group limit.

    Ranks of all terms come from prefix sums over range partitions, so no
    segment's vocabulary has to fit one task.
    """
    t = df.select(segment_col, F.explode(T.tokens(F.col(text_col))).alias("term"))
    c = t.groupBy(segment_col, "term").agg(F.count(F.lit(1)).alias("count"))
    if top_n is None:
        key = F.struct((-F.col("count")).alias("down"), F.col("term"))
        ranked = prefix_sums(c.withColumn("_order", key).withColumn("_one", F.lit(1)), "_order", ["_one"], [segment_col])
        return ranked.select(segment_col, "term", "count", (F.col("_one_before") + 1).cast("bigint").alias("rank"))
    r = F.row_number().over(Window.partitionBy(segment_col).orderBy(F.col("count").desc(), "term"))
    return c.select("*", r.alias("rank")).where(F.col("rank") <= top_n).select(
        segment_col, "term", "count", F.col("rank").cast("bigint").alias("rank"))


def score_with(df: DataFrame, text_col: str, scorer: Callable[[list[str]], list[dict]],
               batch_size: int = 128) -> DataFrame:
    """Per-class score map from a pluggable batch scorer (e.g. a neural model),
    run with ``mapInPandas`` on Arrow batches of ``batch_size`` texts."""
    schema = StructType(list(df.schema.fields) + [StructField("sentiment_scores", MapType(StringType(), DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str).tolist()
            out = []
            for i in range(0, len(texts), batch_size):
                out.extend(scorer(texts[i:i + batch_size]))
            pdf = pdf.copy()
            pdf["sentiment_scores"] = out
            yield pdf

    return df.mapInPandas(run, schema)


_SCORERS: dict[str, tuple[dict[str, tuple[float, np.ndarray]], np.ndarray]] = {}


def save_text_model(model: NB.MultinomialModel, folder: str) -> str:
    """Writes a version of the model into the shared folder and returns its path: the terms, and a row without term for the priors."""
    path = f"{folder.rstrip('/')}/text-model-{uuid.uuid4().hex}"
    priors = model.terms.sparkSession.createDataFrame([(None, 0.0, model.priors)], model.terms.schema)
    model.terms.unionByName(priors).coalesce(1).write.parquet(path)  # the vocabulary at most
    return path


def load_text_model(path: str) -> tuple[dict[str, tuple[float, np.ndarray]], np.ndarray]:
    """The weights of a version, read once per worker."""
    if path not in _SCORERS:
        store, root = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
        rows = dataset.dataset(root, filesystem=store, format="parquet").to_table().to_pylist()
        _SCORERS[path] = ({r["term"]: (r["idf"], np.array(r["logs"])) for r in rows if r["term"] is not None},
                          np.array(next(r["logs"] for r in rows if r["term"] is None)))
    return _SCORERS[path]


def class_scores(df: DataFrame, text_col: str, path: str, classes: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``sentiment_scores``, a probability per class, from a saved model version.

    Texts are cut into tokens by Spark; the workers get them in Arrow batches and load
    the version named by ``path`` once. A text without a known term has the priors.
    """
    rows = df.select(*keep, T.tokens(F.col(text_col)).alias("_tokens"))
    schema = StructType([*[f for f in rows.schema.fields if f.name != "_tokens"],
                         StructField("sentiment_scores", MapType(StringType(), DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, priors = load_text_model(path)
        for pdf in batches:
            scores = []
            for tokens in pdf.pop("_tokens"):
                found = [(n * weights[t][0], weights[t][1]) for t, n in Counter(tokens).items() if t in weights]
                logs = priors.copy()
                if found:
                    w = np.array([x for x, _ in found])
                    logs += (w / np.sqrt((w * w).sum())) @ np.array([x for _, x in found])
                p = np.exp(logs - logs.max())
                scores.append(dict(zip(classes, (p / p.sum()).tolist(), strict=True)))
            pdf["sentiment_scores"] = scores
            yield pdf

    return rows.mapInPandas(run, schema)
