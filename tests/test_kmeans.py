"""K-means fits from any layout, and silhouettes over the tree against the exact form."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from shoplens.operators import clustering, kmeans, silhouette_tree

COLUMNS = list(clustering.RFM_COLUMNS)


def table(spark, count=600, seed=0, spread=0.7):
    rng = np.random.default_rng(seed)
    middles = np.array([[-4.0, 0.0, 1.0], [4.0, 0.0, -1.0], [0.0, 6.0, 3.0]])
    data = middles[rng.integers(0, 3, count)] + rng.normal(0, spread, (count, 3))
    frame = pd.DataFrame(data, columns=COLUMNS)
    frame.insert(0, "CustomerID", range(count))
    return frame, spark.createDataFrame(frame).repartition(4).persist()


def plain_fit(points, keys, k, restart, seed):
    """The same fit in plain loops over all points."""
    centers = []
    for step in range(k):
        weight = np.array([min((sum((x - c) ** 2) for c in centers), default=1.0) for x in points])
        race = [kmeans.draws(np.array([key]), restart, step, seed)[0] / w if w > 0 else np.inf for key, w in zip(keys, weight)]
        centers.append(points[int(np.argmin(race))])
    for _ in range(kmeans.STEPS):
        near = np.array([int(np.argmin([sum((x - c) ** 2) for c in centers])) for x in points])
        moved = [points[near == j].mean(axis=0) if (near == j).any() else centers[j] for j in range(k)]
        shift = sum(((a - b) ** 2).sum() for a, b in zip(moved, centers))
        centers = moved
        if shift <= kmeans.TOLERANCE:
            break
    cost = sum(min(sum((x - c) ** 2) for c in centers) for x in points)
    return sorted(c.tolist() for c in centers), cost


def test_fits_equal_plain_loops(spark):
    frame, points = table(spark, 150)
    found = kmeans.best_fits(points, "CustomerID", COLUMNS, [2, 4], 3, 42)
    data, keys = frame[COLUMNS].to_numpy(), frame["CustomerID"].to_numpy()
    for k in (2, 4):
        centers, cost = min((plain_fit(data, keys, k, r, 42) for r in range(3)), key=lambda f: f[1])
        assert found[k].cost == pytest.approx(cost, abs=1e-4)
        assert np.allclose(found[k].centers, centers, atol=1e-5)


def test_layout_leaves_no_trace(spark):
    _, points = table(spark)
    one = kmeans.best_fits(points, "CustomerID", COLUMNS, range(2, 6), 4, 42)
    two = kmeans.best_fits(points.repartition(9).orderBy(F.rand(3)), "CustomerID", COLUMNS, range(2, 6), 4, 42)
    assert one == two
    costs = [one[k].cost for k in range(2, 6)]
    assert costs == sorted(costs, reverse=True)


def test_fewer_points_than_centers(spark):
    rows = [(i, float(i % 2), 0.0, 1.0) for i in range(10)]
    points = spark.createDataFrame(rows, "CustomerID long, Recency double, Frequency double, Monetary double")
    found = kmeans.best_fits(points, "CustomerID", COLUMNS, [3], 2, 42)[3]
    assert found.centers == [[0.0, 0.0, 1.0], [1.0, 0.0, 1.0]] and found.cost == 0
    assert kmeans.best_fits(points.limit(0), "CustomerID", COLUMNS, [3], 2, 42) == {}


# ---- silhouettes ---------------------------------------------------------------------------------


@pytest.mark.parametrize("leaf, opening", [(8, 0.5), (64, 0.7)])
def test_tree_silhouettes_are_within_their_bound(spark, leaf, opening):
    frame, _ = table(spark, 1500, spread=1.5)
    rng = np.random.default_rng(2)
    frame["A"] = ((frame[COLUMNS].to_numpy()[:, None] - np.array([[-4, 0, 1], [4, 0, -1], [0, 6, 3]])) ** 2).sum(-1).argmin(1)
    frame["B"] = rng.integers(0, 2, len(frame))
    labelled = spark.createDataFrame(pd.concat([frame, frame.iloc[:200]]).assign(CustomerID=range(1700))).persist()
    exact = clustering.silhouettes(labelled, ["A", "B"])
    for name, found in silhouette_tree.silhouettes(labelled, COLUMNS, ["A", "B"], leaf, opening).items():
        assert abs(found.mean - exact[name]) <= found.error < 0.1
        assert found.mean == pytest.approx(exact[name], abs=1e-4)


def test_tree_without_far_cells_is_exact(spark):
    frame, _ = table(spark, 300)
    frame["A"] = np.where(frame["CustomerID"] == 0, 2, frame["CustomerID"] % 2)  # one alone in 2
    labelled = spark.createDataFrame(frame).persist()
    found = silhouette_tree.silhouettes(labelled, COLUMNS, ["A"], leaf=10, opening=0.0)["A"]
    assert found.error == 0 and found.mean == pytest.approx(clustering.silhouettes(labelled, ["A"])["A"], abs=1e-9)


def test_equal_points_are_one_point_with_a_weight(spark):
    rows = [(i, float(i % 4), 0.0, 1.0, int(i % 4 > 1)) for i in range(4000)]
    labelled = spark.createDataFrame(rows, "CustomerID long, Recency double, Frequency double, Monetary double, A int")
    found = silhouette_tree.silhouettes(labelled, COLUMNS, ["A"], leaf=1)["A"]
    own, other = 1000 / 1999, [2.5, 1.5]  # distances inside a cluster, to the other one
    expected = np.mean([(b - own) / b for b in other])
    assert abs(found.mean - expected) <= found.error + 1e-9
    assert silhouette_tree.silhouettes(labelled.limit(0), COLUMNS, ["A"])["A"].mean is None


def test_work_grows_about_linearly(spark):
    """Leaves met point by point and cells taken whole, per leaf."""
    per_leaf = []
    for count in (2_000, 8_000):
        rng = np.random.default_rng(1)
        frame = pd.DataFrame(rng.random((count, 3)), columns=COLUMNS).assign(A=rng.integers(0, 2, count))
        rows = silhouette_tree.folded(spark.createDataFrame(frame), COLUMNS, ["A"])
        points = silhouette_tree.with_cells(rows, 16).persist()
        cells = silhouette_tree.cell_table(points, 1).persist()
        pairs = silhouette_tree.interactions(cells, 0.7).count()
        per_leaf.append(pairs / cells.filter("leaf").count())
    assert per_leaf[1] < 2.2 * per_leaf[0]


def test_far_sums_are_within_their_bound():
    rng = np.random.default_rng(4)
    members = rng.normal(0, 0.3, (40, 3))
    x = rng.normal(0, 1, (30, 3)) + [3, 0, 0]
    row = [0, 0, len(members), *members.sum(axis=0)]
    row += [float((members[:, a] * members[:, b]).sum()) for a in range(3) for b in range(a, 3)]
    row += [v for d in range(3) for v in (members[:, d].min(), members[:, d].max())]
    value, bound = silhouette_tree.far_sums(x, np.array([row]), np.array([0]), 1)
    exact = np.sqrt(((x[:, None] - members[None]) ** 2).sum(-1)).sum(axis=1)
    assert (np.abs(value[:, 0] - exact) <= bound[:, 0]).all() and np.abs(value[:, 0] / exact - 1).max() < 1e-2
