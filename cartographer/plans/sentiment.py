"""Text and sentiment queries (J*, E25, E26, customer-type box plot)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.stats import money_avg
from ..operators import explore as X
from ..operators import metrics as M
from ..operators import sentiment as S
from ..sources import io
from .exploration import BOX_DOUBLES, box_sql
from ..session import ensure_checkpoint_dir
from .registry import Ctx, query
from .sources import hash_sql

TOKENS_SQL = (r"regexp_extract_all(regexp_replace(lower(coalesce({t}, '')), '[^\p{{L}}\p{{M}}\p{{N}}_\s]', '', 'g'),"
              r" '[\p{{L}}\p{{M}}\p{{N}}_]{{2,}}')")
TYPE_SQL = (f"CASE WHEN score <= {C.DETRACTOR_MAX} THEN 'Detractor' WHEN score <= {C.PROMOTER_MIN} THEN 'Neutral' "
            f"ELSE 'Promoter' END")
TYPE_CTES = {
    "x_types": f"SELECT customer_id, score AS sentiment_score, {TYPE_SQL} AS customer_type FROM f_scores",
    "x_seg": """SELECT m.customer_id, m.gross_price, t.sentiment_score, t.customer_type FROM f_merged m
  JOIN x_types t ON m.customer_id = t.customer_id""",
}


def _types(c: Ctx):
    return c.scores.select("customer_id", F.col("score").alias("sentiment_score"),
                           S.customer_type(F.col("score")).alias("customer_type"))


def _segments(c: Ctx):
    return c.lines.select("customer_id", "gross_price").join(_types(c), "customer_id")


@query("tfidf", doubles=["tfidf"], extra_ctes={
    "x_tok": "SELECT labelled_reviews_index AS doc, unnest(" + TOKENS_SQL.format(t="review_text")
             + ") AS term FROM f_labelled",
    "x_tf": "SELECT doc, term, count(*) AS tf FROM x_tok GROUP BY 1, 2",
    "x_voc": f"""SELECT term, sum(tf) AS total, count(*) AS df FROM x_tf GROUP BY 1
  ORDER BY total DESC, term LIMIT {C.TFIDF_VOCAB_SIZE}""",
    "x_w": """SELECT t.doc, t.term, t.tf * (ln((1 + n.n) / (1 + v.df)) + 1) AS w
  FROM x_tf t JOIN x_voc v ON t.term = v.term, (SELECT count(*) AS n FROM f_labelled) n"""}, sql="""
SELECT doc AS labelled_reviews_index, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS tfidf FROM x_w""")
def tfidf(c: Ctx):
    return S.tfidf(c.labelled, "labelled_reviews_index", "review_text")


@query("customer_type", extra_ctes=TYPE_CTES, sql="SELECT * FROM x_types")
def customer_type(c: Ctx):
    return _types(c)


@query("customer_type_two_score", sql=f"""
SELECT customer_id, propensity_2 AS negative_score, propensity_3 AS positive_score,
  CASE WHEN coalesce(propensity_2, 0.0) > {C.DETRACTOR_MAX} THEN 'Detractor'
       WHEN coalesce(propensity_3, 0.0) > {C.PROMOTER_MIN} THEN 'Promoter' ELSE 'Neutral' END AS customer_type
FROM f_scores""")
def customer_type_two_score(c: Ctx):
    """Segment from a per-class score map (negative, positive)."""
    m = F.create_map(F.lit("negative"), F.col("propensity_2"), F.lit("positive"), F.col("propensity_3"))
    d = c.scores.select("customer_id", m.alias("scores"))
    neg, pos = d.scores["negative"], d.scores["positive"]
    return d.select("customer_id", neg.alias("negative_score"), pos.alias("positive_score"),
                    S.customer_type_two_scores(neg, pos).alias("customer_type"))


@query("segment_summary", extra_ctes=TYPE_CTES, doubles=["avg_sentiment_score"], sql="""
SELECT customer_type, count(customer_id) AS count,
  CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price) AS avg_gross_price,
  avg(sentiment_score) AS avg_sentiment_score FROM x_seg GROUP BY 1""")
def segment_summary(c: Ctx):
    return _segments(c).groupBy("customer_type").agg(
        F.count("customer_id").alias("count"), money_avg(F.col("gross_price")).alias("avg_gross_price"),
        F.avg("sentiment_score").alias("avg_sentiment_score"))


_body, _ctes = box_sql("x_seg", ["customer_type"], "gross_price")
query("boxplot_by_customer_type", sql=_body, extra_ctes={**TYPE_CTES, **_ctes}, doubles=BOX_DOUBLES)(
    lambda c: X.boxplot_stats(_segments(c), ["customer_type"], "gross_price"))


@query("term_frequency", extra_ctes=dict(TYPE_CTES, x_rt="""
SELECT 'all' AS segment, review_text FROM f_reviews
UNION ALL SELECT t.customer_type, r.review_text FROM f_reviews r JOIN x_types t ON r.customer_id = t.customer_id
  WHERE t.customer_type IN ('Detractor', 'Promoter')""", x_tc="""
SELECT segment, term, count(*) AS count FROM (SELECT segment, unnest(""" + TOKENS_SQL.format(t="review_text")
    + """) AS term FROM x_rt) u GROUP BY 1, 2"""), sql="""
SELECT segment, term, count, row_number() OVER (PARTITION BY segment ORDER BY count DESC, term) AS rank FROM x_tc""")
def term_frequency(c: Ctx):
    """Word-cloud input: ranked terms of all reviews, detractors and promoters."""
    r = c.reviews
    seg = r.join(_types(c), "customer_id").where(F.col("customer_type").isin("Detractor", "Promoter"))
    rows = r.select(F.lit("all").alias("segment"), "review_text").unionByName(
        seg.select(F.col("customer_type").alias("segment"), "review_text"))
    return S.term_counts(rows, "segment", "review_text")


def _sentiment_eval(c: Ctx, kind: str):
    d = io.split(c.labelled, C.TEST_FRACTION, "labelled_reviews_index")
    if kind == "mnb":
        model = S.train_naive_bayes(d.where(~F.col("is_test")), "labelled_reviews_index")
        return S.score_naive_bayes(model, d.where(F.col("is_test")), "labelled_reviews_index", ["sentiment_label"])
    model = S.train_sentiment(d.where(~F.col("is_test")), kind)
    return S.score_reviews(model, d.where(F.col("is_test")), ["labelled_reviews_index", "sentiment_label"])


def _nb_sql(train: str, docs: str, doc: str) -> tuple[dict[str, str], str]:
    """Multinomial naive Bayes in SQL: trained on (doc, text, label) rows, scoring (doc, text) rows."""
    ctes = {
        "y_train": train, "y_docs": docs,
        "y_tf": f"""SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest({TOKENS_SQL.format(t='text')}) AS term FROM y_train) t GROUP BY 1, 2""",
        "y_voc": f"""SELECT term, ln((1 + (SELECT count(*) FROM y_train)) / (1 + df)) + 1 AS idf FROM (SELECT term, sum(tf) AS total, count(*) AS df
  FROM y_tf GROUP BY 1 ORDER BY total DESC, term LIMIT {C.TFIDF_VOCAB_SIZE}) v""",
        "y_w": "SELECT doc, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc)) AS w FROM y_tf JOIN y_voc USING (term)",
        "y_cls": "SELECT label, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM y_train GROUP BY 1",
        "y_sum": """SELECT label, term, coalesce(s, 0) AS s FROM y_cls CROSS JOIN y_voc
  LEFT JOIN (SELECT label, term, sum(w) AS s FROM y_w JOIN y_train USING (doc) GROUP BY 1, 2) t USING (label, term)""",
        "y_log": "SELECT label, term, ln((s + 1) / (sum(s) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))) AS lp FROM y_sum",
        "y_dtf": f"""SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest({TOKENS_SQL.format(t='text')}) AS term FROM y_docs) t GROUP BY 1, 2""",
        "y_dw": "SELECT doc, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc)) AS w FROM y_dtf JOIN y_voc USING (term)",
        "y_joint": """SELECT d.doc, c.label, c.prior + coalesce(x.l, 0) AS l FROM (SELECT DISTINCT doc FROM y_docs) d CROSS JOIN y_cls c
  LEFT JOIN (SELECT doc, label, sum(w * lp) AS l FROM y_dw JOIN y_log USING (term) GROUP BY 1, 2) x ON d.doc = x.doc AND c.label = x.label""",
        "y_top": "SELECT doc, label, exp(l - max(l) OVER (PARTITION BY doc)) AS e FROM y_joint",
        "y_p": "SELECT doc, label, e / sum(e) OVER (PARTITION BY doc) AS p FROM y_top",
    }
    return ctes, f"""SELECT doc AS {doc}, arg_max(label, p) AS sentiment, max(p) FILTER (WHERE label = 'positive') AS sentiment_score FROM y_p GROUP BY 1"""


_SPLIT = f"{hash_sql('labelled_reviews_index')} % 10000 < {round(C.TEST_FRACTION * 10000)}"
_LABELLED = "SELECT labelled_reviews_index AS doc, review_text AS text, sentiment_label AS label FROM f_labelled"
_nb_ctes, _nb_body = _nb_sql(f"{_LABELLED} WHERE NOT {_SPLIT}", f"{_LABELLED} WHERE {_SPLIT}", "labelled_reviews_index")


@query("sentiment_nb", extra_ctes=_nb_ctes, doubles=["sentiment_score"], sql=f"""
SELECT n.labelled_reviews_index, d.label AS sentiment_label, n.sentiment, n.sentiment_score FROM ({_nb_body}) n
JOIN y_docs d ON n.labelled_reviews_index = d.doc""")
def sentiment_nb(c: Ctx):
    """Multinomial naive Bayes on TF-IDF; hold-out predictions."""
    return _sentiment_eval(c, "mnb")


@query("sentiment_rf")
def sentiment_rf(c: Ctx):
    return _sentiment_eval(c, "rf")


@query("sentiment_lr")
def sentiment_lr(c: Ctx):
    return _sentiment_eval(c, "lr")


@query("sentiment_dt")
def sentiment_dt(c: Ctx):
    return _sentiment_eval(c, "dt")


@query("sentiment_model_comparison")
def sentiment_model_comparison(c: Ctx):
    """Hold-out report (per class, accuracy, averages) of the four text models."""
    out = None
    for kind in ("mnb", "rf", "lr", "dt"):
        r = M.classification_report(_sentiment_eval(c, kind), "sentiment_label", "sentiment").select(F.lit(kind).alias("model"), "*")
        out = r if out is None else out.unionByName(r)
    return out


_rs_ctes, _rs_body = _nb_sql(_LABELLED, "SELECT review_id AS doc, review_text AS text FROM f_reviews", "review_id")


@query("review_scores", extra_ctes=_rs_ctes, doubles=["sentiment_score"], sql=f"""
SELECT n.review_id, r.customer_id, n.sentiment, n.sentiment_score, CASE WHEN n.sentiment_score <= {C.DETRACTOR_MAX} THEN 'Detractor'
  WHEN n.sentiment_score <= {C.PROMOTER_MIN} THEN 'Neutral' ELSE 'Promoter' END AS customer_type
FROM ({_rs_body}) n JOIN f_reviews r USING (review_id)""")
def review_scores(c: Ctx):
    """Customer reviews scored by a model trained on the labelled reviews."""
    model = S.train_naive_bayes(c.labelled, "labelled_reviews_index")
    s = S.score_naive_bayes(model, c.reviews, "review_id", ["customer_id"])
    return s.withColumn("customer_type", S.customer_type(F.col("sentiment_score")))


@query("review_class_scores", extra_ctes=_rs_ctes, doubles=["negative", "neutral", "positive"], sql="""
SELECT doc AS review_id, max(p) FILTER (WHERE label = 'negative') AS negative, max(p) FILTER (WHERE label = 'neutral') AS neutral,
  max(p) FILTER (WHERE label = 'positive') AS positive FROM y_p GROUP BY 1""")
def review_class_scores(c: Ctx):
    """Class-score map of every review from a model version that the workers load from the shared folder."""
    model = S.train_naive_bayes(c.labelled, "labelled_reviews_index")
    path = S.save_text_model(model, ensure_checkpoint_dir(c.spark))
    scored = S.class_scores(c.reviews, "review_text", path, model.classes, ["review_id"])
    return scored.select("review_id", *[F.col("sentiment_scores")[y].alias(y) for y in ("negative", "neutral", "positive")])
