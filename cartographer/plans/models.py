"""Model queries; each returns hold-out or scoring rows. Naive Bayes has a SQL
answer; the other fits are not bit-comparable across libraries and have rows-only checks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.sampling import hash_bucket
from ..operators import churn as CH
from ..operators import explore as X
from ..operators import features as FE
from ..operators import joins
from ..operators import metrics as M
from ..operators import models as Mo
from ..operators import propensity as P
from ..operators import quality
from ..operators.quantiles import quantile_table
from ..sources import io
from ..sources.prepared import fingerprint
from .churn import FEATURE_CTES, TRAINING_CTES
from .exploration import product_classes
from .registry import Ctx, query
from .sources import hash_sql

NUMERIC = ["frequency", "avg_spend", "max_spend", "recency", "total_monthly_spend",
           "flag_phone_provided", C.LOYALTY_STATUS_COL]
CATEGORICAL = ["job_type", "region", "loyalty_type"]
FIT_THREADS = 6
CHURN_KINDS = ["rf", "lr", "nb", "dt"]
OFFERS = {f"category_{C.PROPENSITY_CATEGORY}": lambda: F.col("product_class") == C.PROPENSITY_CATEGORY,
          f"product_{C.PROPENSITY_PRODUCT}": lambda: F.col("product_id") == C.PROPENSITY_PRODUCT}


def _attributes(c: Ctx):
    return joins.keep_first(joins.customer_data(c.customers, c.addresses, c.accounts), ["customer_id"])


def _churn_set(c: Ctx):
    """Window features with customer attributes, materialised once: the split,
    the preprocessor fit, training and scoring all read it."""
    from ..session import cut_lineage
    return cut_lineage(CH.churn_features(c.lines).join(_attributes(c), "customer_id", "left"))


def _prep(train):
    return FE.fit_preprocessor(train, NUMERIC, CATEGORICAL, ["gender"], email_col="email_provider")


#: Fits that several queries use, kept for the application and the input they belong to.
_FITTED: dict[tuple, tuple] = {}


def _mark(c: Ctx) -> tuple:
    return c.spark.sparkContext.applicationId, fingerprint(c.spark, [f"{c.sf_dir}/{t}.parquet" for t in ("lineitem", "orders", "customer", "part")])


def _holdout(c: Ctx, kinds) -> DataFrame:
    """Hold-out rows with the churn probability of each kind of model, fitted on one split."""
    from ..session import cut_lineage
    d = io.split(_churn_set(c), C.TEST_FRACTION, "customer_id", "window_start")
    train = d.where(~F.col("is_test"))
    keys = ["customer_id", "window_start", "churned"]
    mark = ("churn", *_mark(c))
    if mark not in _FITTED:
        p = _prep(train)
        _FITTED[mark] = p, cut_lineage(p.transform(train, keys, safe=True)), {}, {}
    p, x, models, shared = _FITTED[mark]
    for k in kinds:
        if k not in models:
            models[k] = Mo.fit(x, p.feature_names(safe=True), "churned", k, checkpoint=False, shared=shared)
    test = p.transform(d.where(F.col("is_test")), keys, safe=True)
    return _scored(test, {k: models[k] for k in kinds}, keys)


def _scored(x: DataFrame, models: dict, keys) -> DataFrame:
    """``keys`` and churn_probability_<name> for each model, in one pass."""
    names = []
    for name, m in models.items():
        x = m.transform(x).withColumn(f"churn_probability_{name}", vector_to_array("probability")[1]).drop(
            "features", "scaled", "rawPrediction", "probability", "prediction")
        names.append(f"churn_probability_{name}")
    return x.select(*keys, *names)


def _churn_eval(c: Ctx, kind: str):
    out = _holdout(c, [kind]).withColumnRenamed(f"churn_probability_{kind}", "churn_probability")
    return out.withColumn("prediction", (F.col("churn_probability") > 0.5).cast("int"))


@query("split", extra_ctes=FEATURE_CTES, sql=f"""
SELECT customer_id, window_start, churned, {hash_sql('customer_id', 'window_start')} % 10000 < 2000 AS is_test FROM x_feat""")
def split(c: Ctx):
    """80/20 split of the churn training rows by key hash (is_test flag)."""
    return io.split(_churn_set(c), C.TEST_FRACTION, "customer_id", "window_start").select(
        "customer_id", "window_start", "churned", "is_test")


@query("split_stratified", extra_ctes=dict(FEATURE_CTES, x_h=f"""
SELECT customer_id, window_start, churned, {hash_sql('customer_id', 'window_start')} % 10000 AS h FROM x_feat"""), sql=f"""
SELECT customer_id, window_start, x_h.churned, h <= q.cut AS is_test FROM x_h
JOIN (SELECT churned, quantile_cont(h, {C.TEST_FRACTION}) AS cut FROM x_h GROUP BY 1) q ON x_h.churned = q.churned""")
def split_stratified(c: Ctx):
    """Per-class 20% test share: rows below the class's 20% hash quantile."""
    return _stratified(_churn_set(c), "churned", "customer_id", "window_start").select(
        "customer_id", "window_start", "churned", "is_test")


@query("churn_rf")
def churn_rf(c: Ctx):
    return _churn_eval(c, "rf")


@query("churn_lr")
def churn_lr(c: Ctx):
    return _churn_eval(c, "lr")


def _cells(cols: list[str], kind: str) -> str:
    return " UNION ALL ".join({
        "num": f"SELECT customer_id, window_start, churned, is_test, 'num_{c}' AS f, coalesce(CAST({c} AS DOUBLE), "
               f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM y_email WHERE NOT is_test)) AS v FROM y_email",
        "cat": f"SELECT customer_id, window_start, churned, is_test, 'cat_{c}_' || l AS f, CASE WHEN coalesce({c}, 'missing') = l THEN 1.0 ELSE 0.0 END AS v "
               f"FROM y_email CROSS JOIN (SELECT DISTINCT coalesce({c}, 'missing') AS l FROM y_email WHERE NOT is_test) x",
    }[kind] for c in cols)


GAUSSIAN_CTES = dict(TRAINING_CTES, **{
    "y_set": f"""SELECT f.*, c.* EXCLUDE (customer_id), {hash_sql('f.customer_id', 'f.window_start')} % 10000 < {round(C.TEST_FRACTION * 10000)} AS is_test
  FROM x_feat f LEFT JOIN x_cust c ON f.customer_id = c.customer_id""",
    "y_email": """SELECT * REPLACE (CASE WHEN email_provider IN (SELECT email_provider FROM y_set WHERE NOT is_test AND email_provider IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, email_provider LIMIT 3) THEN email_provider ELSE 'others' END AS email_provider) FROM y_set""",
    "y_levels": """SELECT gender, row_number() OVER (ORDER BY gender) AS place, count(*) OVER () AS n,
  first(gender) OVER (ORDER BY k DESC, gender) AS common FROM (SELECT gender, count(*) AS k FROM y_email WHERE NOT is_test AND gender IS NOT NULL GROUP BY 1) g""",
    "y_cell": f"""{_cells(NUMERIC, 'num')} UNION ALL {_cells([*CATEGORICAL, 'email_provider'], 'cat')}
  UNION ALL SELECT customer_id, window_start, churned, is_test, 'bin_' || l.gender, CASE WHEN coalesce(e.gender, l.common) = l.gender THEN 1.0 ELSE 0.0 END
  FROM y_email e CROSS JOIN (SELECT * FROM y_levels WHERE n <> 2 OR place = 2) l""",
    "y_eps": "SELECT f, 1e-9 * coalesce(nullif(var_pop(v), 0), 1) AS eps FROM y_cell WHERE NOT is_test GROUP BY 1",
    "y_par": "SELECT churned AS y, f, avg(v) AS m, var_pop(v) + any_value(eps) AS s FROM y_cell JOIN y_eps USING (f) WHERE NOT is_test GROUP BY 1, 2",
    "y_prior": "SELECT churned AS y, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM y_email WHERE NOT is_test GROUP BY 1",
    "y_log": """SELECT customer_id, window_start, churned, y, any_value(prior) - 0.5 * sum(ln(2 * pi() * s) + (v - m) * (v - m) / s) AS l
  FROM y_cell JOIN y_par USING (f) JOIN y_prior USING (y) WHERE is_test GROUP BY ALL""",
    "y_two": """SELECT customer_id, window_start, churned, 1 / (1 + exp(least(sum(CASE WHEN y = 0 THEN l ELSE -l END), 700))) AS churn_probability
  FROM y_log GROUP BY ALL""",
})


@query("churn_nb", extra_ctes=GAUSSIAN_CTES, doubles=["churn_probability"], sql="""
SELECT customer_id, window_start, churned, churn_probability, CAST(churn_probability > 0.5 AS INTEGER) AS prediction FROM y_two""")
def churn_nb(c: Ctx):
    return _churn_eval(c, "nb")


@query("churn_dt")
def churn_dt(c: Ctx):
    return _churn_eval(c, "dt")


@query("churn_scores")
def churn_scores(c: Ctx):
    """All four models, fitted on all windows, score the customers of the last 90 days."""
    from ..session import cut_lineage
    train = _churn_set(c)
    p = _prep(train)
    x = cut_lineage(p.transform(train, ["churned"], safe=True))
    shared: dict = {}
    models = {k: Mo.fit(x, p.feature_names(safe=True), "churned", k, checkpoint=False, shared=shared) for k in CHURN_KINDS}
    current = CH.features_current(CH.last_window(c.lines)).join(_attributes(c), "customer_id", "left")
    return _scored(p.transform(current, ["customer_id"], safe=True), models, ["customer_id"])


@query("churn_model_comparison")
def churn_model_comparison(c: Ctx):
    """Accuracy, precision, recall, F1 and AUC of the four fitted models on the hold-out rows."""
    from ..session import cut_lineage
    d = cut_lineage(_holdout(c, CHURN_KINDS))
    rows = [M.binary_metrics(d, "churned", f"churn_probability_{k}").select(F.lit(k).alias("model"), "*") for k in CHURN_KINDS]
    return reduce(DataFrame.unionByName, rows)


@query("churn_model_confusion")
def churn_model_confusion(c: Ctx):
    """Confusion matrix of each of the four fitted models on the hold-out rows."""
    from ..session import cut_lineage
    d = cut_lineage(_holdout(c, CHURN_KINDS))
    rows = [M.confusion_matrix(d.withColumn("_p", (F.col(f"churn_probability_{k}") > 0.5).cast("int")), "churned", "_p")
            .select(F.lit(k).alias("model"), "*") for k in CHURN_KINDS]
    return reduce(DataFrame.unionByName, rows)


@query("churn_model_curves")
def churn_model_curves(c: Ctx):
    """ROC and precision-recall points of the four fitted models on the hold-out rows."""
    from ..session import cut_lineage
    d = cut_lineage(_holdout(c, CHURN_KINDS))
    rows = [M.roc_curve(d, "churned", f"churn_probability_{k}").select(F.lit(k).alias("model"), "*") for k in CHURN_KINDS]
    return reduce(DataFrame.unionByName, rows)


@query("behaviour_clusters")
def behaviour_clusters(c: Ctx):
    b = X.customer_behaviour(c.lines)
    m = Mo.kmeans(b, ["purchase_frequency", "avg_order_value"], C.N_CLUSTERS)
    return m.transform(b).select("customer_id", "purchase_frequency", "avg_order_value", "cluster")


def _propensity_set(c: Ctx, cond):
    from ..session import cut_lineage
    return cut_lineage(P.period_training_set(c.lines, cond).join(_attributes(c), "customer_id", "left"))


def _stratified(d: DataFrame, label: str, *keys: str) -> DataFrame:
    """Adds is_test: the rows below their class's ``TEST_FRACTION`` hash quantile."""
    d = d.withColumn("_h", hash_bucket(*[F.col(k) for k in keys]))
    cut = quantile_table(d, ["_h"], [C.TEST_FRACTION], [label]).select(label, F.col("q")[0].alias("_cut"))
    return d.join(F.broadcast(cut), label).withColumn("is_test", F.col("_h") <= F.col("_cut")).drop("_h", "_cut")  # one row per class


PROPENSITY_KEYS = ["customer_id", "window_start", "target"]


def _propensity_fit(c: Ctx, cond):
    """Preprocessor, balanced forest (None with one class only) and the hold-out rows of a target."""
    d = _stratified(_propensity_set(c, cond), "target", "customer_id", "window_start")
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    p = _prep(train)
    if not quality.check_binary_label(train, "target"):
        return p, None, test
    tw = Mo.class_weights(p.transform(train, PROPENSITY_KEYS, safe=True), "target")
    return p, Mo.fit(tw, p.feature_names(safe=True), "target", "rf", weight="weight"), test


@query("propensity_rf")
def propensity_rf(c: Ctx):
    """Balanced forest for the category target on a stratified split; hold-out predictions."""
    p, model, test = _propensity_fit(c, F.col("product_class") == C.PROPENSITY_CATEGORY)
    if model is None:
        return test.select(*PROPENSITY_KEYS, F.lit(None).cast("int").alias("prediction"),
                           F.lit(None).cast("double").alias("probability")).limit(0)
    return Mo.score(model, p.transform(test, PROPENSITY_KEYS, safe=True), PROPENSITY_KEYS, "probability")


def _everyone(c: Ctx) -> DataFrame:
    """Features of every customer over the last observation window, with attributes."""
    return CH.features_of_all(c.lines, C.PROPENSITY_OBSERVATION_DAYS).join(_attributes(c), "customer_id", "left")


@query("offer_scores")
def offer_scores(c: Ctx):
    """Every customer's probability of each offer from the fitted category and product models."""
    out = None
    for offer, cond in OFFERS.items():
        p, model, _ = _propensity_fit(c, cond())
        if model is not None:
            s = Mo.score(model, p.transform(_everyone(c), ["customer_id"], safe=True), ["customer_id"], "probability")
            s = s.select("customer_id", F.lit(offer).alias("offer"), "probability")
            out = s if out is None else out.unionByName(s)
    return out if out is not None else c.lines.select(
        "customer_id", F.lit("").alias("offer"), F.lit(0.0).alias("probability")).limit(0)


@query("next_best_offer_models")
def next_best_offer_models(c: Ctx):
    """Per customer the offer of greatest value, from the fitted models' probabilities."""
    values = P.npv_cost(c.lines, {o: cond() for o, cond in OFFERS.items()})
    s = offer_scores(c)
    j = s.join(F.broadcast(values), s.offer == values.target)  # one row per offer
    v = j.select("customer_id", "offer", "probability", P.vpo(F.col("probability"), F.col("npv"), F.col("cost")).alias("vpo"))
    return P.next_best_offer(v, list(OFFERS))


def _category_models(c: Ctx):
    """Preprocessor, one balanced forest per category on one training frame with its preparation, and the hold-out frame.

    Both category queries use the same fits: they are kept for the application
    and input they belong to.
    """
    from ..session import cut_lineage
    base = io.split(P.multi_period_training_set(c.lines), C.TEST_FRACTION, "customer_id", "window_start")
    mark = _mark(c)
    if mark in _FITTED:
        return _FITTED[mark]
    base = cut_lineage(base.join(_attributes(c), "customer_id", "left"))
    train = base.where(~F.col("is_test"))
    p = _prep(train)
    keys = ["customer_id", "window_start", "target_categories"]
    x = cut_lineage(p.transform(train, keys, safe=True))
    test = cut_lineage(p.transform(base.where(F.col("is_test")), keys, safe=True))
    # class-diversity guard and class weights for every category from one aggregate
    pos = {r["cat"]: r["n"] for r in x.select(F.explode("target_categories").alias("cat"))
           .groupBy("cat").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = x.count()
    cats = [cat for cat in product_classes(c) if 0 < pos.get(cat, 0) < total]

    labelled = x.select("*", *[F.array_contains("target_categories", cat).cast("int").alias(f"_y{i}") for i, cat in enumerate(cats)])
    prepared, models = Mo.fit_forests(labelled, p.feature_names(safe=True), [f"_y{i}" for i in range(len(cats))],
                                      [[total / (2 * (total - pos[cat])), total / (2 * pos[cat])] for cat in cats],
                                      max_depth=C.CATEGORY_TREE_DEPTH, threads=FIT_THREADS) if cats else (None, [])
    _FITTED[mark] = p, prepared, dict(zip(cats, models, strict=True)), test
    return _FITTED[mark]


@query("multi_category_rf")
def multi_category_rf(c: Ctx):
    """Hold-out report of the forest of every category: accuracy, precision, recall, F1 and AUC."""
    from ..session import cut_lineage
    _, prepared, models, test = _category_models(c)
    cols = [f"propensity_{cat}" for cat in models]
    d = cut_lineage(Mo.score_forests(prepared, list(models.values()), test, cols).select("target_categories", *cols))

    def report(cat: str) -> DataFrame:
        return M.binary_metrics(d.withColumn("y", F.array_contains("target_categories", cat).cast("int")), "y", f"propensity_{cat}").select(F.lit(cat).alias("category"), "*")

    with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:  # short jobs, each on its own
        rows = list(pool.map(report, models))
    return reduce(DataFrame.unionByName, rows)


@query("category_propensities")
def category_propensities(c: Ctx):
    """propensity_<category> columns, one row for every customer."""
    p, prepared, models, _ = _category_models(c)
    x = p.transform(_everyone(c), ["customer_id"], safe=True)
    cols = [f"propensity_{cat}" for cat in models]
    return Mo.score_forests(prepared, list(models.values()), x, cols).select("customer_id", *cols) if models else x.select("customer_id")


PROP_COLS = ["propensity_1", "propensity_2", "propensity_3"]


@query("propensity_clusters")
def propensity_clusters(c: Ctx):
    m = Mo.kmeans(c.scores, PROP_COLS, C.N_CLUSTERS, scale=True)
    return m.transform(c.scores).select("customer_id", *PROP_COLS, "cluster")


@query("cluster_profile")
def cluster_profile(c: Ctx):
    """Per cluster: size, share and the three categories with the largest centre."""
    m = Mo.kmeans(c.scores, PROP_COLS, C.N_CLUSTERS, scale=True)
    centres = m.stages[-1].clusterCenters()
    names = [x.split("_")[1] for x in PROP_COLS]
    top = {i: ",".join(n for _, n in sorted(zip(-ctr, names))[:3]) for i, ctr in enumerate(centres)}
    a = m.transform(c.scores).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    total = c.scores.agg(F.count(F.lit(1))).scalar()
    tmap = F.create_map(*[x for i, t in top.items() for x in (F.lit(i), F.lit(t))])
    return a.select("cluster", "size", (F.col("size") / total).alias("share"),
                    tmap[F.col("cluster")].alias("top_categories"))


@query("propensity_pca")
def propensity_pca(c: Ctx):
    m = Mo.pca(c.scores, PROP_COLS, 3)
    arr, signs = vector_to_array("pca"), Mo.component_signs(m)
    return m.transform(c.scores).select("customer_id", *[(arr[i] * signs[i]).alias(f"pc{i + 1}") for i in range(3)])
