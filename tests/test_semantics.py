"""Hand-computed checks of the pandas-vs-Spark semantic rules."""

import datetime as dt
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartographer import config as C
from cartographer.functions.dates import age_exact, elapsed_days
from cartographer.functions.text import normalize, strip_markup, tokens
from cartographer.operators import basket as B
from cartographer.operators import churn as CH
from cartographer.operators import clean as K
from cartographer.operators import explore as X
from cartographer.operators import joins
from cartographer.operators import metrics as M
from cartographer.operators import propensity as P
from cartographer.operators import quality as Q
from cartographer.operators import ranking as RK
from cartographer.operators import rfm as R


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_elapsed_days_floor_across_midnight(spark):
    df = spark.createDataFrame([(ts("2024-01-01 23:00:00"), ts("2024-01-02 01:00:00")),
                                (ts("2024-01-01 01:00:00"), ts("2024-01-03 00:59:59")),
                                (ts("2024-01-03 00:00:00"), ts("2024-01-01 12:00:00"))], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(elapsed_days(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 1, -2]          # pandas .dt.days floors, also for negative gaps


def test_interpolated_quantile_and_qcut(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    from cartographer.operators.quantiles import quantile
    assert df.select(quantile(df, "v", 0.75)).first()[0] == pytest.approx(4.75)
    out = {r.v: r.v_label for r in RK.qcut_labels(df, "v", ["Low", "Medium", "High"]).collect()}
    # edges at 2.0 and 3.0 (1/3 and 2/3 quantiles), right-closed, lowest included
    assert out == {1.0: "Low", 2.0: "Low", 3.0: "Medium", 10.0: "High"}


def test_cut_right_closed_segments(spark):
    from cartographer.operators.sentiment import customer_type
    df = spark.createDataFrame([(0.3,), (0.31,), (0.7,), (0.71,)], "s double")
    assert [r[0] for r in df.select(customer_type(F.col("s"))).collect()] == \
        ["Detractor", "Neutral", "Neutral", "Promoter"]


def test_age_rounds_half_to_even(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),)], "b date")
    # 2001-01-01 minus 2000-01-01 is 366 days -> 1.0027 -> 1; 912.5 days would be 2.5 -> 2
    assert df.select(age_exact(F.col("b"), "2001-01-01")).first()[0] == 1
    df2 = spark.createDataFrame([(dt.date(2000, 1, 1),)], "b date")
    assert df2.select(F.bround(F.lit(2.5))).first()[0] == 2.0


def test_keep_first_total_order_with_nulls(spark):
    df = spark.createDataFrame([("o1", "p1", "b", 2.0), ("o1", "p1", None, 5.0), ("o1", "p1", "a", 1.0),
                                ("o2", "p1", "z", 1.0)], "order_id string, product_id string, c string, v double")
    got = sorted(tuple(r) for r in joins.keep_first(df, ["order_id", "product_id"]).collect())
    assert got == [("o1", "p1", None, 5.0), ("o2", "p1", "z", 1.0)]   # nulls sort first


def test_null_groups_dropped_and_sum_of_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), ("F", None), ("F", None), ("M", 2.5)], "gender string, gross_price double")
    got = {r.gender: r.total_gross_price for r in X.price_by(df, "gender").collect()}
    assert got == {"F": 0.0, "M": 2.5}


def test_mode_lowest_on_tie(spark):
    df = spark.createDataFrame([("c", "o1", 1.0, "b"), ("c", "o2", 3.0, "a"), ("c", "o3", 2.0, "b"),
                                ("c", "o4", 2.0, "a")],
                               "customer_id string, order_id string, gross_price double, product_class string")
    r = X.customer_behaviour(df).first()
    assert (r.purchase_frequency, r.avg_order_value, r.favorite_category) == (4, 2.0, "a")


def test_outlier_population_z(spark):
    vals = [10.0] * 20 + [1000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r.x for r in K.outlier_to_median(df, ["x"]).collect()]
    assert out.count(10.0) == 21 and out.count(None) == 1


def test_sliding_window_bounds(spark):
    base = ts("2024-01-01 00:00:00")
    rows = [("a", base), ("a", base + dt.timedelta(days=89, hours=23)), ("b", base + dt.timedelta(days=30)),
            ("b", base + dt.timedelta(days=90)), ("c", base + dt.timedelta(days=150))]
    df = spark.createDataFrame(rows, "customer_id string, purchase_datetime timestamp_ntz")
    lab = {(r.customer_id, r.window_start.date().isoformat()): r.churned
           for r in CH.churn_labels(df, 90, 30, 30).collect()}
    # end = day 150: windows start at day 0 and day 30 (30 + 120 <= 150)
    assert lab == {("a", "2024-01-01"): 1, ("b", "2024-01-01"): 0,
                   ("a", "2024-01-31"): 1, ("b", "2024-01-31"): 1}


def test_rfm_formula(spark):
    rows = [("o1", "c1", 10.0, ts("2024-01-15 10:00:00")), ("o2", "c1", 20.0, ts("2024-03-01 09:00:00")),
            ("o3", "c2", 5.0, ts("2024-03-02 08:00:00"))]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, gross_price double, purchase_datetime timestamp_ntz")
    got = {r.customer_id: (r.recency, r.monetary, r.frequency) for r in R.rfm(df).collect()}
    assert got == {"c1": (0, 30.0, pytest.approx(2 / 3)), "c2": (0, 5.0, 1.0)}


def test_pairs_rules_on_small_baskets(spark):
    rows = [("1", "a"), ("1", "b"), ("1", "c"), ("2", "a"), ("2", "b"), ("3", "a"), ("3", "a"), ("4", "c"),
            ("5", "b"), ("5", "c")]
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    pc = {(r.item_1, r.item_2): r["count"] for r in B.pair_counts(B.basket_items(df, "product_id")).collect()}
    assert pc == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 2}
    # blocked expansion equals the plain self join for any block size
    pc1 = {(r.item_1, r.item_2): r["count"] for r in B.pair_counts(B.basket_items(df, "product_id"), 1).collect()}
    assert pc1 == pc
    fi = B.frequent_itemsets(df, "product_id", 0.4)
    sets = {r.items_key: r.freq for r in fi.select(F.array_join("items", ",").alias("items_key"), "freq").collect()}
    assert sets == {"a": 3, "b": 3, "c": 3, "a,b": 2, "b,c": 2}
    rules = {(r.antecedents, r.consequents): (r.confidence, r.lift)
             for r in B.association_rules(fi, 0.0).collect()}
    assert rules[("a", "b")] == (pytest.approx(2 / 3), pytest.approx((2 / 3) / 0.6))


def test_multi_item_consequents(spark):
    rows = [(str(o), i) for o in range(4) for i in "xyz"] + [("9", "x")]
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    rules = B.association_rules(B.frequent_itemsets(df, "product_id", 0.5), 0.0)
    cons = {r.consequents for r in rules.where(F.col("antecedents") == "x").collect()}
    assert "y,z" in cons


def test_report_zero_division_and_auc_ties(spark):
    df = spark.createDataFrame([(1, 0, 0.5), (0, 0, 0.5), (1, 0, 0.9), (0, 0, 0.1)],
                               "label int, prediction int, score double")
    rep = {r["class"]: r for r in M.classification_report(df, "label", "prediction").collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["0"].recall == 1.0
    # positives 0.5, 0.9; negatives 0.5, 0.1 -> (0.5 + 1 + 1 + 1) / 4
    assert M.roc_auc(df, "label", "score").first()[0] == pytest.approx(0.875)
    neg = df.withColumn("score", -F.col("score"))
    assert M.roc_auc(neg, "label", "score").first()[0] == pytest.approx(0.125)


def test_next_best_offer_invalid_probability(spark):
    s = spark.createDataFrame([("c1", 0.5, 0.9), ("c2", 1.2, -0.1), ("c3", 0.2, 0.2)],
                              "customer_id string, pa double, pb double")
    v = spark.createDataFrame([("A", 100.0, 1.0), ("B", 10.0, 1.0)], "target string, npv double, cost double")
    vals = P.offer_values(s, {"A": "pa", "B": "pb"}, v)
    best = {r.customer_id: r.offer for r in P.next_best_offer(vals, ["A", "B"]).collect()}
    assert best == {"c1": "A", "c3": "A"}          # c2 has no valid offer and drops out


def test_primary_secondary_ties(spark):
    df = spark.createDataFrame([("c1", 0.5, 0.5, 0.39), ("c2", 0.2, 0.9, 0.75)],
                               "customer_id string, propensity_a double, propensity_b double, propensity_c double")
    got = {r.customer_id: (r.primary_category, r.secondary_categories) for r in P.primary_secondary(df).collect()}
    assert got == {"c1": ("a", "b"), "c2": ("b", "c")}


def test_review_cleanup_and_tokens(spark):
    df = spark.createDataFrame([("<br>bright href Étion ça, don't!",)], "t string")
    r = df.select(strip_markup(F.col("t")).alias("c"), normalize(F.col("t")).alias("n"),
                  tokens(F.col("t")).alias("k")).first()
    assert r.c == "ight  Étion ça, don't!"        # 'br' is removed inside words as well
    assert r.n == "brbright href étion ça dont"
    assert r.k == ["brbright", "href", "étion", "ça", "dont"]


def test_quantiles_of_skewed_values(spark):
    """One far value, a heavy tie and a group without values: still exact."""
    import numpy as np
    from cartographer.operators.quantiles import quantile_row, quantile_table
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=3000), [1e9], np.full(2000, 0.5)])
    rows = [("a", float(x)) for x in v] + [("b", float(i)) for i in range(7)] + [("c", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = {r.g: (r.n, r.q) for r in quantile_table(df, ["v"], qs, ["g"]).collect()}
    assert set(got) == {"a", "b", None}
    assert got["a"][0] == len(v) and np.allclose(got["a"][1], np.quantile(v, qs))
    assert np.allclose(got["b"][1], np.quantile(range(7), qs))
    empty = quantile_row(df.where("g = 'c'"), ["v"], [0.5]).first()["s"]
    assert empty["v"] == [None]


def test_prefix_sums_over_partitions(spark):
    from cartographer.operators.quantiles import prefix_sums
    df = spark.createDataFrame([(float(i if i else -1e9), i % 3) for i in range(500)], "x double, n long")
    got = sorted(tuple(r) for r in prefix_sums(df, "x", ["n"]).collect())
    total = 0
    for x, n, before, whole in got:
        assert (before, whole) == (total, 499)
        total += n


def test_curves_with_a_far_score(spark):
    from cartographer.operators import metrics as M
    rows = [(int(i % 3 == 0), i / 1000) for i in range(1000)] + [(1, 1e6)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)
    curve = M.roc_curve(df, "y", "s").collect()
    assert len(curve) == 1001
    for r in curve[::97]:
        assert r.tpr == pytest.approx(sum(p >= r.threshold for p in pos) / len(pos))


def test_segments_of_missing_scores(spark):
    from cartographer.operators.sentiment import customer_type
    df = spark.createDataFrame([(None,), (float("nan"),), (0.9,)], "s double")
    assert [r[0] for r in df.select(customer_type(F.col("s"))).collect()] == [None, None, "Promoter"]


def test_money_keeps_fine_prices(spark):
    from cartographer.functions.stats import money_avg, money_sum
    r = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "p double").agg(
        money_sum(F.col("p")).alias("s"), money_avg(F.col("p")).alias("a")).first()
    assert (r.s, r.a) == (0.012, 0.004)


def test_timestamps_ignore_the_session_zone(spark):
    from cartographer.operators.clean import parse_timestamp
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = spark.createDataFrame([("2024-03-10 02:30:00",), ("no",)], "t string").select(
            parse_timestamp(F.col("t")).cast("string").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [x[0] for x in r] == ["2024-03-10 02:30:00", None]


def test_rules_of_a_large_itemset(spark):
    """Twelve items bought together always: every split is a rule, none twice."""
    from cartographer.operators import basket as B
    items = [f"i{k:02d}" for k in range(12)]
    df = spark.createDataFrame([(str(o), x) for o in range(6) for x in items], "order_id string, product_class string")
    fi = B.frequent_itemsets(df, "product_class", 0.5)
    assert fi.count() == 2 ** 12 - 1
    rules = B.association_rules(fi.where("size = 12 or size < 12"), 0.0)
    top = rules.where("size(split(antecedents, ',')) + size(split(consequents, ',')) = 12")
    assert top.count() == 2 ** 12 - 2 == top.select("antecedents").distinct().count()


def test_pairs_of_a_huge_order(spark):
    from cartographer.operators import basket as B
    df = spark.range(10_000).select(F.lit("o").alias("order_id"), F.col("id").cast("string").alias("product_id"))
    pairs = B.pair_counts(B.basket_items(df, "product_id"))
    assert pairs.agg(F.count("*"), F.max("count")).first() == (10_000 * 9_999 // 2, 1)


def test_windows_are_expanded_after_the_first_aggregate(spark):
    from cartographer.operators import churn as CH
    df = spark.createDataFrame([("c", 1.0, 0)], "customer_id string, gross_price double, d int").select(
        "customer_id", "gross_price", F.timestamp_add("DAY", F.col("d"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("purchase_datetime"))
    for plan in (CH.churn_labels(df), CH.churn_features(df)):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("Generate") < text.rindex("Aggregate")  # an aggregate stands below the copies


def test_orders_without_birthdate_stay(spark):
    from cartographer.operators import clean as K
    from cartographer.operators import explore as X
    df = spark.createDataFrame([("F", 10.0, None), ("F", 20.0, "1980-05-05"), (None, 5.0, "1990-01-01")],
                               "gender string, gross_price double, b string").withColumn("birthdate", F.col("b").cast("date"))
    r = X.demographics_summary(K.with_age(df, "2002-01-01", exact=False, keep_unknown=True)).collect()
    assert [(x.gender, x.total_gross_price, x.order_count, x.avg_age) for x in r] == [("F", 30.0, 2, 22.0)]


def test_tags_only_cleanup(spark):
    from cartographer.operators import clean as K
    df = spark.createDataFrame([("a <b>bright</b> idea<br/> 3 < 4",)], "review_text string")
    assert K.clean_reviews(df, tags_only=True).first()[0] == "a bright idea 3 < 4"


def test_partial_prepared_copy_is_ignored(spark, tmp_path):
    import os
    from cartographer.sources import prepared as PR
    src = f"{tmp_path}/in.parquet"
    spark.range(5).write.parquet(src)
    build = lambda: spark.read.parquet(src)
    assert PR.prepared(spark, "t", [src], build).count() == 5
    root = PR.ensure_checkpoint_dir(spark).removeprefix("file:")
    folder = f"{root}/prepared/t-{PR.fingerprint(spark, [src])}-{PR.code_version([])}"
    for copy in os.listdir(folder):
        os.rename(f"{folder}/{copy}/_SUCCESS", f"{folder}/{copy}/_OTHER")
    os.makedirs(f"{folder}/0partial")
    assert PR.prepared(spark, "t", [src], build).count() == 5
    assert PR.code_version([PR]) != PR.code_version([])


def test_attribute_grain(spark):
    from cartographer.operators import joins
    feats = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, f int")
    merged = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "w")], "customer_id string, job_type string")
    one = joins.with_attributes(feats, merged, ["job_type"]).collect()
    assert {(r.customer_id, r.job_type) for r in one} == {("a", "w"), ("b", None)}
    assert joins.with_attributes(feats, merged, ["job_type"], grain="row").count() == 4
    with pytest.raises(ValueError):
        joins.with_attributes(feats, merged, ["job_type"], grain="other")


def test_too_many_levels_raise(spark, monkeypatch):
    from cartographer.operators import features as FE
    df = spark.createDataFrame([(str(i), "m" if i % 3 else None) for i in range(9)], "job_type string, gender string")
    p = FE.fit_preprocessor(df, [], ["job_type"], ["gender"], email_col=None)
    assert p.categorical["job_type"] == [str(i) for i in range(9)] and p.binary["gender"] == ["m", ["m"]]
    monkeypatch.setattr(FE, "MAX_LEVELS", 8)
    with pytest.raises(ValueError, match="job_type"):
        FE.fit_preprocessor(df, [], ["job_type"], ["gender"], email_col=None)


def test_itemsets_with_one_order_of_many_items(spark):
    """An order of 100,000 items is one bit in each item's map; no row holds it."""
    big = spark.range(100_000).selectExpr("'big' AS order_id", "concat('i', id) AS product_id")
    small = spark.range(400).selectExpr("concat('o', id % 100) AS order_id", "concat('i', id div 100) AS product_id")
    fi = B.frequent_itemsets(big.union(small), "product_id", 0.5)
    got = {tuple(r["items"]): (r["size"], r["freq"]) for r in fi.collect()}
    names = ["i0", "i1", "i2", "i3"]
    assert got == {c: (k, 101) for k in range(1, 5) for c in itertools.combinations(names, k)}


def test_itemsets_against_counting(spark, monkeypatch):
    """Random orders against plain counts, with candidates in several blocks and bitmaps of several buckets."""
    rng = random.Random(3)
    rows = [(f"o{o}", f"p{rng.randint(0, 9)}") for o in range(300) for _ in range(rng.randint(1, 7))]
    monkeypatch.setattr(B, "CANDIDATES", 7)
    orders = {}
    for o, p in rows:
        orders.setdefault(o, set()).add(p)
    want = Counter(c for items in orders.values() for k in range(1, 8) for c in itertools.combinations(sorted(items), k))
    want = {c: n for c, n in want.items() if n / len(orders) >= 0.02}
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    assert {tuple(r["items"]): r["freq"] for r in B.frequent_itemsets(df, "product_id", 0.02).collect()} == want
    assert B.frequent_itemsets(df.limit(0), "product_id", 0.02).count() == 0


def test_bitmap_counts_need_no_shuffle_of_bitmaps(spark):
    """The AND runs where the bitmaps of a bucket lie: one exchange by bucket, none by itemset and bucket."""
    df = spark.createDataFrame([(f"o{i % 50}", f"p{i % 7}") for i in range(300)], "order_id string, product_id string")
    bits = B.order_bitmaps(B.basket_items(df)).repartition("bucket")
    members = spark.createDataFrame([("a", "p1"), ("a", "p2")], "k string, item string")
    both = bits.join(F.broadcast(members), "item").groupBy("bucket", "k").agg(F.expr("bitmap_and_agg(bits)").alias("b"))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(bucket#\d+L?, \d+\)", plan) and not re.search(r"hashpartitioning\(bucket#\d+L?, k#", plan)


def test_text_join_with_a_third_of_the_rows_on_one_text(spark, monkeypatch):
    """A hot text is dealt over salts, null texts match nothing, repeated labels fan out."""
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    left = [(str(i), "hot" if i % 3 == 0 else f"text {i % 50}" if i % 7 else None) for i in range(300)]
    right = [("hot", "positive"), ("hot", "negative"), ("text 5", "neutral"), (None, "positive"), ("other", "positive")]
    a = spark.createDataFrame(left, "review_id string, review_text string")
    b = spark.createDataFrame(right, "review_text string, sentiment_label string")
    got = Counter(tuple(r) for r in joins.review_sentiment_join(a, b).select("review_id", "review_text", "sentiment_score").collect())
    score = {"positive": 1, "neutral": 0, "negative": -1}
    want = Counter()
    for i, t in left:
        found = [score[y] for x, y in right if t is not None and x == t]
        want.update((i, t, s) for s in found or [None])
    assert got == want
    plan = joins.join_on_text(a, b, "review_text")._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_digest" in plan


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_duplicates_by_digest(spark, monkeypatch, limit):
    """Nulls in different columns, copies and near copies; digests broadcast and shuffled."""
    monkeypatch.setattr(Q, "BROADCAST_DIGESTS", limit)
    rows = [(1, None, "a"), (None, 1, "a"), (1, None, "a"), (2, 2, None), (2, 2, None), (2, 2, None), (3, 3, "b"), (3, 3, "c")]
    df = spark.createDataFrame(rows, "x int, y int, z string")
    assert Q.duplicate_row_count(df).first()[0] == 3
    assert Counter(map(tuple, Q.dedup_exact(df).collect())) == Counter(set(rows))
    assert Counter(map(tuple, Q.duplicates(df).collect())) == Counter({(1, None, "a"): 2, (2, 2, None): 3})
    assert Counter(map(tuple, Q.duplicates(df, ["x", "y"]).collect())) == Counter({(1, None, "a"): 2, (2, 2, None): 3, (3, 3, "b"): 1, (3, 3, "c"): 1})
    assert Q.dedup_exact(df.limit(0)).count() == Q.duplicate_row_count(df.limit(0)).first()[0] == 0


def test_whole_rows_are_not_shuffled_for_duplicates(spark):
    """Rows with a digest of their own pass without an exchange of their columns."""
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) || id AS wide")
    plan = Q._split_repeated(df, df.columns)[1]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_offer_warnings_are_counted(spark):
    scores = spark.createDataFrame([("a", 0.5), ("b", 1.5), ("c", -0.1), ("d", None)], "customer_id string, p double")
    values = spark.createDataFrame([("o", -1.0, 2.0)], "target string, npv double, cost double")
    seen = Observation()
    rows = P.offer_values(scores, {"o": "p"}, values, seen).collect()
    assert seen.get == {"rows": 4, "invalid_probabilities": 2, "negative_npv": 4, "negative_cost": 0}
    assert {r.customer_id: r.vpo for r in rows} == {"a": -2.5, "b": None, "c": None, "d": None}


def test_box_plots_read_the_rows_once(spark, tmp_path):
    """Weighted rows, ties and outliers against numpy; after the distinct values are written no row is read again."""
    rng = np.random.default_rng(5)
    rows = [(g, float(v), int(w)) for g in ("a", "b") for v, w in zip(rng.integers(0, 40, 60), rng.integers(1, 4, 60), strict=True)]
    rows += [("a", 400.0, 2), ("b", -300.0, 1), ("c", 7.0, 1), (None, 1.0, 1), ("a", None, 1)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "k string, x double, w int").write.parquet(path)
    out = X.boxplot_stats(spark.read.parquet(path), ["k"], "x", weight="w")
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        x = np.concatenate([[v] * w for k, v, w in rows if k == r.k and v is not None])
        q1, median, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (r.n, r.outliers) == (len(x), int(((x < low) | (x > high)).sum()))
        assert np.allclose([r.q1, r.median, r.q3, r.whisker_low, r.whisker_high], [q1, median, q3, x[x >= low].min(), x[x <= high].max()])
    assert out.count() == 3
