"""Forests grown by groups: where a node is finished changes nothing, splits are the best ones."""

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cartographer.operators import forest as Fo
from cartographer.operators import models as Mo
from cartographer.session import cut_lineage


def rows(spark, n=400):
    df = spark.range(n).select("id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(9)) / 3).alias(f"x{i}") for i in range(4)])
    df = df.withColumn("y", ((F.col("x0") > 1) & (F.col("x1") + F.col("x2") > 2)).cast("int"))
    return VectorAssembler(inputCols=[f"x{i}" for i in range(4)], outputCol="features").transform(df)


def test_a_node_finished_in_a_group_or_by_passes_gives_the_same_tree(spark):
    df = rows(spark).repartition(3)
    cuts = Fo.thresholds(df, "features", 4)
    assert [len(c) for c in cuts] == [8] * 4
    blocks = Fo.blocks(df.select("features", F.array("y").alias("l")), "features", "l", cuts)
    got = []
    for local in (1, 60, 10_000):  # passes only, both, one group
        trees, subtrees = Fo.grow(blocks, 4, 2, 1, 30, 42, [1.0, 2.0], local_rows=local)
        model = Fo.ForestModel("features", cuts, 2, [1.0, 2.0], trees, subtrees)
        out = model.transform(df).select("id", "y", "prediction", F.col("probability").cast("string").alias("p")).orderBy("id").collect()
        assert len(out) == 400 and all(r.y == r.prediction for r in out)
        got.append((model.depth, out))
    assert got[0] == got[1] == got[2]


def test_the_best_split_by_brute_force():
    rng = np.random.default_rng(3)
    x, y, w = rng.integers(0, 6, (60, 3)).astype(np.uint8), rng.integers(0, 3, 60), rng.integers(1, 4, 60)
    weights = np.array([1.0, 2.0, 0.5])
    chosen, node = np.broadcast_to(np.arange(3), (2, 3)), (np.arange(60) % 2).astype(np.int64)
    totals = np.bincount(node * 3 + y, w, 6).reshape(2, 3).astype(np.int64)
    place, last = Fo._best(*Fo._cells(x, np.arange(60), node, chosen, y, w, 3), totals, 3, weights)

    def gini(mask):
        c = np.bincount(y[mask], w[mask], 3) * weights
        return c.sum() - (c * c).sum() / c.sum()

    for v in range(2):
        mine = node == v
        cost = {(f, b): gini(mine & (x[:, f] <= b)) + gini(mine & (x[:, f] > b)) for f in range(3) for b in range(5)
                if (mine & (x[:, f] <= b)).any() and (mine & (x[:, f] > b)).any()}
        assert abs(cost[int(place[v]), int(last[v])] - min(cost.values())) < 1e-9


def test_labels_share_the_rows_dealt_out_and_small_subtrees_meet_the_rows_where_they_are(spark, monkeypatch):
    df = cut_lineage(rows(spark).withColumn("z", (F.col("x3") > 1).cast("int")).repartition(3))
    calls, subtrees = [], Fo._subtrees
    monkeypatch.setattr(Fo, "_subtrees", lambda *a: calls.append(a[2]) or subtrees(*a))
    weights = [[1.0, 2.0], [1.0, 1.0]]
    models = Fo.fit_forests(df, "features", ["y", "z"], 5, 6, 42, weights)
    assert calls == [[0, 1]]
    alone = [Fo.fit_forests(df, "features", [c], 5, 6, 42, [w])[0] for c, w in zip("yz", weights)]
    got = []
    for some, most in ((models, 64 << 20), (models, 0), (alone, 64 << 20)):  # subtrees to the rows, rows to the subtrees
        monkeypatch.setattr(Fo, "SHARED_BYTES", most)
        got.append(Fo.probabilities(df, "features", some, "p").select("id", F.col("p").cast("string")).orderBy("id").collect())
    assert len(got[0]) == 400 and got[0] == got[1] == got[2]


def test_a_level_counted_in_stretches_gives_the_same_subtree(monkeypatch):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, b, 6000) for b in (32, 2, 2, 9, 2, 1)]).astype(np.uint8)
    y, w = ((x[:, 0] > 11) ^ (rng.random(6000) < 0.3)).astype(np.uint8) + (x[:, 3] > 6), rng.integers(1, 5, 6000).astype(np.uint8)
    weights, got = np.array([1.0, 2.0, 0.5]), []
    for m in (3, 6):
        for dense in (0, 4, 1000):  # no node, some, all
            monkeypatch.setattr(Fo, "DENSE", dense)
            got.append(Fo._grow(x, y, w, 3, m, 30, np.random.default_rng(1), weights))
        assert len(got[-1]["feature"]) > 1000
        for other in got[-3:-1]:
            assert all((other[k] == got[-1][k]).all() for k in other)
        tree = got[-1]
        assert (tree["totals"][0] == np.bincount(y, w, 3)).all()
        inner = np.flatnonzero(tree["feature"] >= 0)
        below = tree["child"][inner]
        assert (tree["totals"][inner] == tree["totals"][below] + tree["totals"][below + 1]).all()
        ends = Fo._descend(x, tree, np.arange(6000))
        assert (np.bincount(ends * 3 + y, w, 3 * len(tree["feature"])).reshape(-1, 3)[tree["feature"] < 0] == tree["totals"][tree["feature"] < 0]).all()


def test_a_large_node_whose_chosen_features_are_all_constant_is_counted(monkeypatch):
    """Below an upper part the rows of a group may share one value in most features."""
    rng = np.random.default_rng(7)
    x = np.zeros((4000, 12), np.uint8)
    x[:, 0], x[:, 1:11] = rng.integers(0, 32, 4000), rng.integers(0, 9, 10)
    y, w = ((x[:, 0] > 11) ^ (rng.random(4000) < 0.3)).astype(np.uint8), rng.integers(1, 5, 4000).astype(np.uint8)
    got = []
    for dense in (0, 4, 1000):
        monkeypatch.setattr(Fo, "DENSE", dense)
        got.append([Fo._grow(x, y, w, 2, 3, 30, np.random.default_rng(seed), np.ones(2)) for seed in range(20)])
    assert any(len(t["feature"]) == 1 for t in got[0]) and any(len(t["feature"]) > 1 for t in got[0])
    assert all((a[k] == b[k]).all() for other in got[1:] for a, b in zip(got[0], other, strict=True) for k in a)
    assert Fo._crossed(Fo._joint(x[:, 11:], y, 2), 0, 4000, np.zeros(1, int), np.ones(1, int), 2, w.astype(float))[0][1].tolist() == [np.bincount(y, w, 2).tolist()]


def test_a_tree_and_a_forest_of_the_same_rows_share_preparation_and_bins(spark, monkeypatch):
    df = cut_lineage(rows(spark).drop("features").repartition(3))
    calls, blocks = [], Fo.blocks
    monkeypatch.setattr(Fo, "blocks", lambda *a: calls.append(1) or blocks(*a))
    shared, got = {}, []
    for common in (shared, None):
        for kind in ("rf", "dt"):
            model = Mo.fit(df, [f"x{i}" for i in range(4)], "y", kind, num_trees=5, checkpoint=False, shared=common)
            got.append(Mo.score(model, df, ["id"]).orderBy("id").collect())
    assert len(calls) == 3 and got[:2] == got[2:]


def test_dense_vectors_are_described_and_binned_like_sparse_ones(spark):
    import pyarrow as pa
    from pyspark.ml.linalg import Vectors
    vectors = [[float(i % 7), 0.0, float(i % 3 == 0), float("nan") if i % 11 == 0 else i / 9] for i in range(300)]
    sparse = [Vectors.sparse(4, [(j, v) for j, v in enumerate(r) if v != 0]) for r in vectors]
    got = []
    for kind in (sparse, [Vectors.dense(r) for r in vectors]):
        df = spark.createDataFrame([(v,) for v in kind], ["features"]).coalesce(1)
        cuts = Fo.thresholds(df, "features", 4)
        got.append((cuts, Fo._binned(pa.table(df.toArrow())["features"], cuts)))
    assert Fo._dense(pa.table(df.toArrow())["features"]).shape == (300, 4)
    assert all((a == b).all() for a, b in zip(got[0][0], got[1][0], strict=True)) and (got[0][1] == got[1][1]).all()


def test_a_subtree_goes_to_its_rows_once_not_once_a_block(spark, monkeypatch):
    df = cut_lineage(rows(spark).repartition(6))  # six blocks
    model = Fo.fit_forests(df, "features", ["y"], 3, 6, 42, [[1.0, 1.0]])[0]
    want = Fo.probabilities(df, "features", [model], "p").select("id", F.col("p").cast("string")).orderBy("id").collect()
    monkeypatch.setattr(Fo, "SHARED_BYTES", 0)
    for group_rows in (1_000_000, 100):  # one group a subtree, four
        monkeypatch.setattr(Fo, "GROUP_ROWS", group_rows)
        got = Fo.probabilities(df, "features", [model], "p")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow vote" not in plan
        assert got.select("id", F.col("p").cast("string")).orderBy("id").collect() == want


def test_trees_take_turns_when_their_rows_are_many(spark, monkeypatch):
    """Any number of trees at once gives the same trees; a turn's shuffle is done and let go before the next."""
    df = cut_lineage(rows(spark).repartition(3))
    cuts, blocks = Fo.bins(df, "features", ["y"])
    calls, released, dealt, release = [], [], Fo._dealt_and_grown, Fo.release
    monkeypatch.setattr(Fo, "_dealt_and_grown", lambda rows, trees, turn, *a: calls.append(turn) or dealt(rows, trees, turn, *a))
    monkeypatch.setattr(Fo, "release", lambda spark: released.append(len(calls)) or release(spark))
    size = blocks.agg(F.sum(F.octet_length("x") + F.col("n"))).first()[0]
    got = []
    for beside, at_once in ((1 << 30, 1), (0, 2 * size), (0, 1)):
        monkeypatch.setattr(Fo, "BESIDE_BYTES", beside)
        monkeypatch.setattr(Fo, "DEALT_BYTES", at_once)
        _, subtrees = Fo.grow(blocks, 4, 2, 5, 30, 42, [1.0, 2.0])
        got.append([tuple(r) for r in subtrees.orderBy("tree", "node").collect()])
    assert calls == [[0, 1, 2, 3, 4], [0, 1], [2, 3], [4], [0], [1], [2], [3], [4]]
    assert released == list(range(2, 10)) and len(got[0]) == 5 and got[0] == got[1] == got[2]
