"""Histogram trees: the same model from any layout, the same splits as a plain search over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from shoplens.operators import trees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for key in range(900):
        a, b, c = rng.integers(0, 30) / 4, rng.normal(), float(rng.integers(0, 2))
        rows.append((key * 7 - 50, float(a), float(b), c, int(rng.random() < 1 / (1 + math.exp(-(a - 4 + 2 * b * c))))))
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, y int").repartition(5).persist()


@pytest.fixture(scope="module")
def plain(table):
    frame = table.orderBy("id").toPandas()
    return frame["id"].to_numpy(), frame[FEATURES].to_numpy(), frame["y"].to_numpy()


def boosted(frame, rounds=3, depth=3):
    return trees.boost(frame, "id", "y", FEATURES, rounds, depth, 0.3, positive=1.7)


def grown(frame):
    return trees.grow_forest(frame, "id", "y", FEATURES, 12, 4, [0.8, 1.4], seed=3)


def test_cuts_are_values_at_even_positions(table, plain):
    _, x, _ = plain
    for f, cuts in enumerate(trees.quantile_cuts(table, FEATURES, 8)):
        ordered = np.sort(x[:, f])
        assert cuts.tolist() == sorted({float(ordered[math.ceil(k * len(ordered) / 8) - 1]) for k in range(1, 8)})


@pytest.mark.parametrize("fit", [boosted, grown])
def test_layout_leaves_no_trace(table, fit, monkeypatch):
    one = fit(table)
    two = fit(table.repartition(11, F.rand(5)).orderBy(F.rand(4)))
    monkeypatch.setattr(trees, "BLOCK", 64)
    monkeypatch.setattr(trees, "RENEW", 1)
    monkeypatch.setattr(trees, "RESULT", 1)
    three = fit(table.repartition(3))
    for other in (two, three):
        for x, y in zip(one.trees, other.trees):
            assert (x.feature == y.feature).all() and (x.cut == y.cut).all() and (x.value == y.value).all()
        assert (one.gains == other.gains).all()


def test_boosting_equals_a_plain_search(table, plain):
    """Two rounds by trying every split on all rows, in doubles."""
    _, x, y = plain
    model = boosted(table, rounds=2, depth=2)
    bins = trees.binned(x, model.cuts)
    margin = np.zeros(len(y))
    weight = np.where(y == 1, 1.7, 1.0)
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.ones(len(y), dtype=int)
        for level in range(2):
            for n in range(1 << level, 2 << level):
                rows = node == n
                score = lambda mask: g[mask].sum() ** 2 / (h[mask].sum() + 1)
                options = [
                    (score(rows & (bins[:, f] <= c)) + score(rows & (bins[:, f] > c)) - score(rows), f, c)
                    for f in range(3) for c in range(trees.BINS - 1)
                    if min(h[rows & (bins[:, f] <= c)].sum(), h[rows & (bins[:, f] > c)].sum()) >= 1
                ]
                gain = max(o[0] for o in options)
                found = [o for o in options if o[1:] == (tree.feature[n], tree.cut[n])]
                assert found and found[0][0] == pytest.approx(gain, rel=1e-4)
                node = np.where(rows, 2 * n + (bins[:, tree.feature[n]] > tree.cut[n]), node)
        assert (node == tree.nodes(bins)).all()
        leaf = {n: -0.3 * g[node == n].sum() / (h[node == n].sum() + 1) for n in set(node.tolist())}
        assert all(tree.value[n] == pytest.approx(v, abs=1e-5) for n, v in leaf.items())
        margin = margin + tree.value[node]
    assert model.importances.sum() == pytest.approx(1)


def test_forest_leaves_are_weighted_shares_of_the_bootstrap(table, plain):
    keys, x, y = plain
    model = grown(table)
    bins = trees.binned(x, model.cuts)
    for number, tree in enumerate(model.trees):
        times = trees.copies(keys, number, 3)
        node = tree.nodes(bins)
        for n in np.unique(node[times > 0]):
            mass = [(times[(node == n) & (y == c)].sum()) * w for c, w in ((0, 0.8), (1, 1.4))]
            assert tree.value[n] == pytest.approx(mass[1] / sum(mass))
    total = [sum(t.value[t.nodes(bins)][i] for t in model.trees) / 12 for i in range(5)]
    scored = model.score(table, "p").orderBy("id").limit(5).collect()
    assert [r.p for r in scored] == pytest.approx(total)


def test_draws_are_poisson_and_differ_between_trees():
    keys = np.arange(200_000)
    draws = [trees.copies(keys, t, 42) for t in (0, 1)]
    for times in draws:
        share = np.bincount(times, minlength=4)[:4] / len(keys)
        assert share == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(4)], abs=5e-3)
    assert abs(np.corrcoef(*draws)[0, 1]) < 0.01
    order = trees.feature_order(5, np.arange(20_000), 8, 42)
    assert np.bincount(order[:, 0], minlength=8) / 20_000 == pytest.approx([0.125] * 8, abs=0.01)


def test_a_feature_without_a_split_is_passed_over(spark):
    """One feature is looked at in each node, yet constant ones never end a tree."""
    rows = [(i, 1.0, float(i % 10), 2.0, int(i % 10 > 4)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id bigint, a double, b double, c double, y int")
    model = trees.grow_forest(frame, "id", "y", FEATURES, 5, 3, [1.0, 1.0], 1, looked_at=1)
    assert all(t.feature[1] == 1 and t.cut[1] == trees.binned(np.array([[1.0, 4.0, 2.0]]), model.cuts)[0, 1] for t in model.trees)
    assert model.score(frame, "p").filter("abs(p - y) > 1e-12").isEmpty()


def test_empty_and_null_values_score(table, spark):
    model = boosted(table)
    assert model.score(table.limit(0), "p").count() == 0
    assert model.score(table.withColumn("z", F.lit(None).cast("string")), "p").filter("p between 0 and 1").count() == 900


def test_histograms_of_a_forest_stay_on_the_executors(table, monkeypatch):
    def summed(*args):
        raise AssertionError("histograms came to the driver")

    monkeypatch.setattr(trees, "summed", summed)
    monkeypatch.setattr(trees, "BLOCK", 200)
    assert all(t.feature[1] >= 0 for t in grown(table).trees)


def test_a_boosting_task_has_a_block_of_rows_even_if_they_come_in_one_partition(table, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK", 400)
    cuts = trees.quantile_cuts(table, FEATURES)
    blocks = trees.blocks_of(table.coalesce(1), "id", "y", FEATURES, cuts)
    assert blocks.map(lambda b: len(b.keys)).collect() == [300] * 3


def test_cuts_of_more_features_take_no_more_passes(spark):
    """Each feature had a sketch, a count and a gathering of its own."""
    x = F.xxhash64("id")
    frame = spark.range(260_000).select(
        (x % 1000 / 7).alias("a"), F.when(x % 3 == 0, 1.0).otherwise(x % 50_000 / 3).alias("b"), F.rand(1).alias("c"),
        F.lit(2.0).alias("d"),
    ).persist()
    values, context, jobs = frame.toPandas(), spark.sparkContext, []
    for features in (["a"], ["a", "b", "c", "d"]):
        context.setJobGroup(f"cuts-{len(features)}", "")
        cuts = trees.quantile_cuts(frame, features)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"cuts-{len(features)}")))
        for name, found in zip(features, cuts):
            ordered = np.sort(values[name].to_numpy())
            assert found.tolist() == np.unique([ordered[-(-k * 260_000 // 64) - 1] for k in range(1, 64)]).tolist()
    context.setJobGroup("", "")
    frame.unpersist()
    assert jobs[1] <= jobs[0] + 1


def test_a_task_of_many_rows_works_through_blocks(spark, table, monkeypatch):
    """Files packed into one task made one block, whose columns left the caches."""
    monkeypatch.setattr(trees, "BLOCK", 100)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        blocks = trees.blocks_of(table, "id", "y", FEATURES, trees.quantile_cuts(table, FEATURES))
        sizes = blocks.map(lambda b: len(b.keys)).glom().collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(sizes) < 9 and sum(map(sum, sizes)) == 900 and max(map(max, sizes)) <= 100


@pytest.mark.parametrize("rows, size, width", [(20_000, 2, 3), (300, 5, 4), (0, 3, 2)])
def test_histograms_of_chosen_rows_equal_a_count_one_by_one(rows, size, width):
    rng = np.random.default_rng(rows)
    bins = np.asfortranarray(rng.integers(0, trees.BINS, (rows, width)).astype(np.uint8))
    chosen = np.flatnonzero(rng.random(rows) < 0.6)
    for some in (None, chosen):
        mine = bins if some is None else bins[some]
        cells, weight = rng.integers(0, size, len(mine)), rng.integers(-(2**30), 2**30, len(mine)).astype(np.int32)
        expected = np.zeros((size, width, trees.BINS, 2), dtype=np.int64)
        for f in range(width):
            np.add.at(expected[..., 0], (cells, f, mine[:, f]), weight)
            np.add.at(expected[..., 1], (cells, f, mine[:, f]), 1)
        found = trees.histogram(cells, bins, [weight, np.ones(len(mine), np.uint8)], size, some)
        assert (found == expected).all()


@pytest.mark.parametrize("sign", [1, -1])
def test_only_the_child_of_less_curvature_is_added_up(table, monkeypatch, sign):
    """Left children were, however many rows they had."""
    table, seen = table.withColumns({c: sign * F.col(c) for c in FEATURES}), []
    summed = trees.summed
    monkeypatch.setattr(trees, "summed", lambda blocks, count: seen.append(summed(blocks, count)) or seen[-1])
    tree = boosted(table, rounds=1, depth=2).trees[0]
    root, below = (sums[0, 0].sum(axis=0) for sums in seen)
    left = seen[0][0, tree.feature[1], : tree.cut[1] + 1].sum(axis=0)
    assert below.tolist() == min((left.tolist(), (root - left).tolist()), key=lambda s: s[1])
