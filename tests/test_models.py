"""Model pipelines: round trip, probability range, rows-only keys run."""

import math
import os
import statistics
import tempfile

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL

import __spark_entry__ as E
from cartographer import config as C
from cartographer.operators import models as Mo
from cartographer.operators import naive_bayes as NB
from cartographer.operators import quality
from cartographer.operators import sentiment as S
from cartographer.plans import models as PM
from cartographer.plans import registry


def test_pipeline_round_trip(spark):
    rows = [(float(i % 7), float(i % 3), 1 if i % 7 > 3 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    m = Mo.fit(df, ["a", "b"], "y", "rf", num_trees=10)
    s1 = Mo.score(m, df, ["a", "b"]).orderBy("a", "b")
    path = os.path.join(tempfile.mkdtemp(prefix="model-"), "m")
    Mo.save(m, path)
    s2 = Mo.score(Mo.load(path), df, ["a", "b"]).orderBy("a", "b")
    assert s1.collect() == s2.collect()
    assert s1.where((F.col("probability_1") < 0) | (F.col("probability_1") > 1)).count() == 0
    # planted signal: better than the majority class
    acc = s1.select(F.avg(((F.col("prediction") == (F.col("a") > 3).cast("int"))).cast("double"))).first()[0]
    assert acc > 0.9


def test_pluggable_scorer(spark):
    df = spark.createDataFrame([("good",), ("bad",), (None,)], "t string")

    def scorer(texts):
        return [{"positive": 1.0 if x == "good" else 0.0, "negative": 1.0 if x == "bad" else 0.0} for x in texts]

    out = S.score_with(df, "t", scorer).collect()
    assert [r.sentiment_scores["positive"] for r in out] == [1.0, 0.0, 0.0]


QUERIES = E.queries()


@pytest.fixture(autouse=True)
def small_forests(monkeypatch):
    """Ten trees do for these tests; the default stays a hundred."""
    own = Mo.estimator

    def small(kind, label, features="scaled", weight=None, seed=1, num_trees=10, n_rows=None, max_depth=30):
        return own(kind, label, features, weight, seed, min(num_trees, 10), n_rows, max_depth)

    monkeypatch.setattr(Mo, "estimator", small)
    yield own


def test_forests_have_a_hundred_trees_by_default(spark, small_forests):
    forest = small_forests("rf", "y")
    assert forest.getNumTrees() == 100 and forest.getMaxDepth() == 30 and forest.getCacheNodeIds()
    assert small_forests("rf", "y", max_depth=7).getMaxDepth() == 7


def run(spark, key):
    return QUERIES[key](spark, SF_SMALL)


def customers(spark, where="true"):
    from cartographer.plans.registry import Ctx
    return {r[0] for r in Ctx(spark, SF_SMALL).lines.where(where).select("customer_id").distinct().collect()}


@pytest.mark.parametrize("key", ["churn_rf", "churn_lr", "churn_nb", "churn_dt", "propensity_rf"])
def test_hold_out_rows(spark, key):
    """Hold-out rows are a fifth of the training set, once each, with probabilities."""
    rows = run(spark, key).collect()
    prob = "probability" if key == "propensity_rf" else "churn_probability"
    assert len({(r.customer_id, r.window_start) for r in rows}) == len(rows)
    assert all(0 <= r[prob] <= 1 and r.prediction == int(r[prob] > 0.5) for r in rows)
    if key != "propensity_rf":
        n = run(spark, "split").count()
        assert abs(len(rows) / n - 0.2) < 0.03


def test_stratified_split_keeps_class_shares(spark):
    rows = run(spark, "split_stratified").groupBy("churned").agg(F.avg(F.col("is_test").cast("int")).alias("share")).collect()
    assert len(rows) == 2 and all(abs(r.share - 0.2) < 0.02 for r in rows)


def test_churn_scores_cover_current_customers(spark):
    rows = run(spark, "churn_scores").collect()
    assert len(rows) == len({r.customer_id for r in rows}) == run(spark, "churn_features_current").count()
    assert all(0 <= r[f"churn_probability_{k}"] <= 1 for r in rows for k in ("rf", "lr", "nb", "dt"))


def test_model_comparisons(spark):
    churn = {r.model: r for r in run(spark, "churn_model_comparison").collect()}
    assert set(churn) == {"rf", "lr", "nb", "dt"}
    assert all(0 <= r[c] <= 1 for r in churn.values() for c in ("accuracy", "precision", "recall", "f1", "roc_auc"))
    text = run(spark, "sentiment_model_comparison").collect()
    assert {r.model for r in text} == {"mnb", "rf", "lr", "dt"}
    assert {r["class"] for r in text if r.model == "mnb"} >= {"accuracy", "macro avg", "weighted avg"}


def test_curves_fall_with_the_threshold(spark):
    rows = sorted(run(spark, "churn_model_curves").collect(), key=lambda r: (r.model, r.threshold))
    assert {r.model for r in rows} == {"rf", "lr", "nb", "dt"}
    assert all(a.tpr >= b.tpr and a.fpr >= b.fpr for a, b in zip(rows, rows[1:], strict=False) if a.model == b.model)


def test_every_customer_gets_category_propensities(spark):
    rows = run(spark, "category_propensities").collect()
    assert {r.customer_id for r in rows} == customers(spark) and len(rows) == len(customers(spark))
    assert all(0 <= x <= 1 for r in rows for c, x in r.asDict().items() if c != "customer_id")
    report = run(spark, "multi_category_rf").collect()
    assert {f"propensity_{r.category}" for r in report} == set(rows[0].asDict()) - {"customer_id"}


def test_best_offers_of_fitted_models(spark):
    rows = run(spark, "next_best_offer_models").collect()
    assert {r.customer_id for r in rows} <= customers(spark)
    assert len(rows) == len({r.customer_id for r in rows}) > 0
    assert all(0 <= r.probability <= 1 for r in rows)


@pytest.mark.parametrize("key", ["sentiment_nb", "sentiment_rf", "sentiment_lr", "sentiment_dt"])
def test_text_models_label_the_hold_out(spark, key):
    rows = run(spark, key).collect()
    assert rows and {r.sentiment for r in rows} <= {"positive", "neutral", "negative"}
    assert all(0 <= r.sentiment_score <= 1 for r in rows)


def test_text_model_finds_a_planted_signal(spark):
    rows = [(f"{'lovely' if i % 2 else 'dreadful'} thing number{i % 5} everywhere", "positive" if i % 2 else "negative") for i in range(80)]
    df = spark.createDataFrame(rows, "review_text string, sentiment_label string")
    labelled = df.withColumn("id", F.monotonically_increasing_id())
    out = S.score_naive_bayes(S.train_naive_bayes(labelled, "id"), labelled, "id", ["sentiment_label"]).collect()
    assert len(out) == 80 and all(r.sentiment == r.sentiment_label for r in out)
    for kind in ("lr", "rf", "dt"):
        out = S.score_reviews(S.train_sentiment(df, kind), df, ["sentiment_label"]).collect()
        assert all(r.sentiment == r.sentiment_label for r in out), kind


def test_text_weights_equal_the_tfidf_operator(spark):
    rows = [("1", "the red fox"), ("2", "the blue fox fox"), ("3", "the the end")]
    df = spark.createDataFrame([(i, t, "positive" if i == "1" else "negative") for i, t in rows], "id string, review_text string, sentiment_label string")
    model = S.train_sentiment(df, "dt")
    vocabulary = model.stages[2].vocabulary
    out = model.transform(S.prepare_text(df)).select("id", vector_to_array("features").alias("f")).collect()
    got = {(r.id, vocabulary[k]): v for r in out for k, v in enumerate(r.f) if v}
    want = {(r.id, r.term): r.tfidf for r in S.tfidf(df, "id", "review_text").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_logistic_penalty_is_per_row(spark):
    df = spark.createDataFrame([("good", "positive"), ("bad", "negative")] * 25, "review_text string, sentiment_label string")
    assert S.train_sentiment(df, "lr").stages[-1].getRegParam() == pytest.approx(1 / 50)


def test_text_regression_has_the_classes_of_its_labels_only(spark):
    """No probability goes to a class of unknown labels; rows with a label that was never seen are scored."""
    df = spark.createDataFrame([("good", "positive"), ("bad", "negative"), ("so so", "neutral")] * 20, "review_text string, sentiment_label string")
    model = S.train_sentiment(df, "lr")
    assert model.stages[-1].numClasses == 3
    new = spark.createDataFrame([("good", "other"), ("new words", None)], df.schema)
    out = model.transform(S.prepare_text(new)).select(vector_to_array("probability").alias("p")).collect()
    assert [len(r.p) for r in out] == [3, 3]
    assert [r.sentiment is None for r in S.score_reviews(model, new, ["review_text"]).collect()] == [False, False]
    model = S.train_sentiment(df.unionByName(spark.createDataFrame([("none here", None)] * 20, df.schema)), "lr")
    got = S.score_reviews(model, df.limit(1).unionByName(spark.createDataFrame([("none here", None)], df.schema)), ["review_text"]).collect()
    assert {r.review_text: r.sentiment for r in got} == {"good": "positive", "none here": None}


def test_cluster_keys(spark):
    n = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert run(spark, "propensity_clusters").count() == n == run(spark, "propensity_pca").count()
    profile = run(spark, "cluster_profile").collect()
    assert sum(r["size"] for r in profile) == n and len(profile) == 3
    assert run(spark, "behaviour_clusters").count() == len(customers(spark))


@pytest.mark.parametrize("scale", [False, True])
def test_rows_stand_in_the_cluster_of_their_nearest_centre(spark, scale):
    """SQL over the stored centres assigns every row as the clustering did; the kept fit is the cheapest start."""
    df = spark.createDataFrame([(i, float(i % 3 * 10 + i % 7), float(i * i % 31)) for i in range(300)], "id int, a double, b double")
    m = Mo.kmeans(df, ["a", "b"], 3, scale=scale)
    column = "scaled" if scale else "features"
    spark.createDataFrame(list(enumerate(Mo.cluster_centres(m))), "cluster int, centre array<double>").createOrReplaceTempView("centres")
    m.transform(df).select("id", "cluster", vector_to_array(column).alias("x")).createOrReplaceTempView("placed")
    wrong = spark.sql("""
        SELECT id FROM (SELECT p.id, p.cluster, min_by(c.cluster, d) AS nearest FROM placed p JOIN centres c ON true
          LATERAL VIEW explode(array(aggregate(zip_with(x, centre, (u, v) -> (u - v) * (u - v)), 0D, (s, e) -> s + e))) e AS d
          GROUP BY p.id, p.cluster) WHERE cluster <> nearest""")
    assert wrong.count() == 0
    one = Mo.kmeans(df, ["a", "b"], 3, scale=scale, starts=1)
    assert m.stages[-1].summary.trainingCost <= one.stages[-1].summary.trainingCost + 1e-9


def test_offer_forests_grow_without_a_depth_cut(spark, monkeypatch):
    """The forests of the propensity targets use the default depth, the greatest that Spark allows."""
    depths = []
    monkeypatch.setattr(Mo, "fit", lambda *a, **k: depths.append(k.get("max_depth", C.TREE_DEPTH)))
    monkeypatch.setattr(quality, "check_binary_label", lambda *a: True)
    PM._propensity_fit(registry.Ctx(spark, SF_SMALL), F.col("product_class") == C.PROPENSITY_CATEGORY)
    assert depths == [30]


def test_review_scores_cover_all_reviews(spark):
    rows = run(spark, "review_scores").collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert {r.customer_type for r in rows} <= {"Detractor", "Neutral", "Promoter"}


def test_gaussian_naive_bayes_by_hand(spark):
    """Class-wise normal densities with variances raised as for standardised features; a constant feature adds nothing."""
    rows = [(1.0, 0.0, 5.0, 0), (3.0, 0.0, 5.0, 0), (2.0, 1.0, 5.0, 0), (6.0, 1.0, 5.0, 1), (8.0, 1.0, 5.0, 1), (0.0, 0.0, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    model = NB.fit_gaussian(df, ["a", "b", "c"], "y")
    assert NB.GaussianModel.from_json(model.to_json()) == model
    known = [r for r in rows if r[3] is not None]

    def log_joint(row, y):
        mine = [r for r in known if r[3] == y]
        out = math.log(len(mine) / len(known))
        for i in range(3):
            xs, every = [r[i] for r in mine], [r[i] for r in known]
            var = statistics.pvariance(xs) + 1e-9 * (statistics.pvariance(every) or 1.0)
            out -= 0.5 * (math.log(2 * math.pi * var) + (row[i] - statistics.fmean(xs)) ** 2 / var)
        return out

    ask = [(2.0, 0.0, 5.0), (4.0, 1.0, 5.0), (4.5, 1.0, 5.0), (100.0, 1.0, 5.0)]
    got = model.transform(spark.createDataFrame(ask, "a double, b double, c double")).orderBy("a").collect()
    for r, row in zip(got, sorted(ask), strict=True):
        a, b = log_joint(row, 0), log_joint(row, 1)
        want = 1 / (1 + math.exp(min(a - b, 700)))
        assert r.probability[1] == pytest.approx(want, abs=1e-9) and r.prediction == float(want > .5)


def test_multinomial_naive_bayes_by_hand(spark):
    rows = [("1", "red fox red", "p"), ("2", "blue fox", "n"), ("3", "blue sky", "n"), ("4", "red", None)]
    df = spark.createDataFrame(rows, "id string, review_text string, label string")
    model = S.train_naive_bayes(df, "id", "label")
    weight = {(r.id, r.term): r.tfidf for r in S.tfidf(df, "id", "review_text").collect()}
    label, terms = {r[0]: r[2] for r in rows}, sorted({t for _, t in weight})
    total = {y: {t: 1 + sum(w for (d, x), w in weight.items() if x == t and label[d] == y) for t in terms} for y in "np"}
    assert model.classes == ["n", "p"]
    for r in S.score_naive_bayes(model, df, "id", score_class="p").collect():
        logs = [math.log({"n": 2, "p": 1}[y] / 3) + sum(w * math.log(total[y][t] / sum(total[y].values())) for (d, t), w in weight.items() if d == r.id)
                for y in "np"]
        want = 1 / (1 + math.exp(logs[0] - logs[1]))
        assert r.sentiment_score == pytest.approx(want, abs=1e-9) and r.sentiment == ("p" if want > .5 else "n")
    unknown = spark.createDataFrame([("9", "never seen"), ("10", None)], "id string, review_text string")
    assert [r.sentiment_score for r in S.score_naive_bayes(model, unknown, "id", score_class="p").collect()] == [pytest.approx(1 / 3)] * 2


def test_trees_grow_beyond_ten_levels(spark):
    """A list of decisions, one bit after the other, needs a level for each."""
    df = spark.range(1 << 13).select("id", *[((F.shiftright("id", i) % 2) == 1).cast("double").alias(f"b{i}") for i in range(13)])
    label = F.lit(0)
    for i in reversed(range(13)):
        label = F.when(F.col(f"b{i}") == 1, i % 2).otherwise(label)
    df = df.withColumn("y", label.cast("int"))
    model = Mo.fit(df, [f"b{i}" for i in range(13)], "y", "dt")
    assert model.stages[-1].depth > 10
    assert Mo.score(model, df, ["y"]).where("prediction = y").count() == df.count()


def test_confusion_of_every_fitted_model(spark):
    rows = run(spark, "churn_model_confusion").collect()
    total = run(spark, "churn_model_comparison").count() and {r.model: 0 for r in rows}
    assert set(total) == {"rf", "lr", "nb", "dt"} and len(rows) == 16


def test_components_have_a_sign_rule(spark):
    rows = spark.range(60).selectExpr("cast(id as double) as a", "cast(-2 * id + id % 5 as double) as b", "cast(id % 7 as double) as c")
    model = Mo.pca(rows, ["a", "b", "c"], 3)
    x = np.array(rows.collect())
    x = x - x.mean(0)
    values, vectors = np.linalg.eigh(x.T @ x)
    vectors = vectors[:, ::-1]
    vectors = vectors * np.array([1.0 if v[abs(v).argmax()] >= 0 else -1.0 for v in vectors.T])
    got = np.array([r.p for r in model.transform(rows).select(vector_to_array("pca").alias("p")).collect()]) * Mo.component_signs(model)
    assert np.allclose(got, x @ vectors, atol=1e-6)


def test_clusters_keep_the_cheapest_start_and_the_nearest_centre(spark):
    rng = np.random.default_rng(4)
    points = [(float(x), float(y)) for cx, cy in ((0, 0), (9, 0), (0, 9), (9, 9), (30, 30)) for x, y in rng.normal((cx, cy), .4, (40, 2))]
    df = spark.createDataFrame(points, "a double, b double")
    model = Mo.kmeans(df, ["a", "b"], 5, starts=6)
    centres = np.array(Mo.cluster_centres(model))
    rows = model.transform(df).select("a", "b", "cluster").collect()
    distance = ((np.array([(r.a, r.b) for r in rows])[:, None, :] - centres[None]) ** 2).sum(2)
    assert [r.cluster for r in rows] == distance.argmin(1).tolist()
    one = [Mo.kmeans(df, ["a", "b"], 5, seed=42 + i, starts=1).stages[-1].summary.trainingCost for i in range(6)]
    assert model.stages[-1].summary.trainingCost == pytest.approx(min(one))
