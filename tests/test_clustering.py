import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from shoplens.operators import clustering


def points(spark, count=400, seed=0):
    rng = np.random.default_rng(seed)
    centers = np.array([[-4.0, 0.0, 1.0], [4.0, 0.0, -1.0], [0.0, 6.0, 3.0]])
    data = centers[rng.integers(0, 3, count)] + rng.normal(0, 0.5, (count, 3))
    frame = pd.DataFrame(data, columns=list(clustering.RFM_COLUMNS))
    frame.insert(0, "CustomerID", range(count))
    return frame, spark.createDataFrame(frame)


def brute_silhouette(data, labels):
    distances = np.sqrt(((data[:, None, :] - data[None, :, :]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = distances[i, mine].sum() / (mine.sum() - 1)
        b = min(distances[i, labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("block_rows", [10_000, 60])
def test_silhouette_equals_brute_force(spark, block_rows):
    frame, table = points(spark)
    rng = np.random.default_rng(1)
    frame["A"] = rng.integers(0, 4, len(frame))
    frame["B"] = np.where(frame["CustomerID"] == 0, 2, frame["CustomerID"] % 2)  # one alone in 2
    labelled = spark.createDataFrame(frame)
    got = clustering.silhouettes(labelled, ["A", "B"], block_rows)
    data = frame[list(clustering.RFM_COLUMNS)].to_numpy()
    for name in ("A", "B"):
        assert got[name] == pytest.approx(brute_silhouette(data, frame[name].to_numpy()), abs=1e-9)


def test_scaler_uses_population_deviation_and_survives_constants(spark):
    frame, table = points(spark)
    constant = table.withColumn("Recency", F.lit(3.0))
    scaled = clustering.Scaler.fit(constant, clustering.RFM_COLUMNS).apply(constant).toPandas()
    assert (scaled["Recency"] == 0).all()
    assert scaled["Monetary"].mean() == pytest.approx(0, abs=1e-9)
    assert scaled["Monetary"].std(ddof=0) == pytest.approx(1)


def test_inertia_falls_with_k_and_labels_are_stable(spark):
    _, table = points(spark)
    table = table.cache()
    costs = []
    for k in (2, 3, 4, 5):
        centers = clustering.fit_centers(table, k, restarts=4)
        assert centers == sorted(centers)
        costs.append(clustering.inertia(table, centers).first()[0])
    assert costs == sorted(costs, reverse=True)
    centers = clustering.fit_centers(table, 3, restarts=4)
    assert clustering.fit_centers(table.repartition(3), 3, restarts=4) == [
        pytest.approx(c, abs=1e-3) for c in centers
    ]
    table.unpersist()


def test_assignment_is_the_nearest_center(spark):
    frame, table = points(spark)
    centers = [[0.0, 0.0, 0.0], [1.0, 2.0, -1.0], [4.0, -4.0, 2.0]]
    got = clustering.assign(table, centers).toPandas().sort_values("CustomerID")
    data = frame[list(clustering.RFM_COLUMNS)].to_numpy()
    expected = ((data[:, None, :] - np.array(centers)[None]) ** 2).sum(-1).argmin(1)
    assert list(got["Cluster"]) == list(expected)


def test_sweep_prefers_the_true_k_in_both_metrics(spark):
    frame, table = points(spark)
    for metric in ("euclidean", "squaredEuclidean"):
        sweep = clustering.k_sweep(table, range(2, 6), restarts=4, metric=metric).toPandas()
        assert list(sweep["K"]) == [2, 3, 4, 5]
        assert sweep.loc[sweep["Silhouette"].idxmax(), "K"] == 3
    with pytest.raises(ValueError, match="unknown metric"):
        clustering.k_sweep(table, [2], restarts=1, metric="cosine")


def test_components_equal_the_covariance_eigenvectors(spark):
    frame, table = points(spark)
    scaled = clustering.Scaler.fit(table, clustering.RFM_COLUMNS).apply(table)
    components = clustering.Components.fit(scaled)
    data = scaled.toPandas()[list(clustering.RFM_COLUMNS)].to_numpy()
    values, vectors = np.linalg.eigh(np.cov(data.T))
    order = values.argsort()[::-1][:2]
    assert components.variance_ratio == pytest.approx(values[order] / values.sum(), abs=1e-9)
    for mine, theirs in zip(components.loadings, vectors.T[order]):
        assert abs(np.dot(mine, theirs)) == pytest.approx(1, abs=1e-9)
        assert mine[int(np.argmax(np.abs(mine)))] > 0


def test_profile_shares_come_from_rounded_revenue(spark):
    rows = [(1, 0, 10, 1, 1.005), (2, 0, 20, 2, 2.0), (3, 1, 30, 3, 7.0), (4, None, 1, 1, 1.0)]
    frame = spark.createDataFrame(
        rows, "CustomerID long, Cluster int, Recency int, Frequency long, Monetary double"
    )
    profile = clustering.cluster_profile(frame).collect()
    assert [r.Cluster for r in profile] == [1, 0]
    assert sum(r.PctOfCustomers for r in profile) == pytest.approx(100, abs=0.02)
    assert profile[0].PctOfRevenue == pytest.approx(100 * 7 / 10.0, abs=0.05)


def test_exact_silhouette_counts_rows_that_share_a_customer(spark):
    """Sums belong to rows, not to customers, and pairs of blocks meet without a shuffle of copies."""
    frame, _ = points(spark, 130, seed=3)
    frame["CustomerID"] //= 2
    frame["A"] = np.arange(len(frame)) % 3
    labelled = spark.createDataFrame(frame)
    data = frame[list(clustering.RFM_COLUMNS)].to_numpy()
    for block_rows in (7, 1000):
        got = clustering.silhouettes(labelled, ["A"], block_rows)["A"]
        assert got == pytest.approx(brute_silhouette(data, frame["A"].to_numpy()), abs=1e-9)


def test_exact_silhouette_is_null_beside_a_row_without_features(spark):
    frame, _ = points(spark, 50)
    labelled = spark.createDataFrame(frame.assign(A=frame["CustomerID"] % 2))
    missing = labelled.withColumn("Recency", F.when(F.col("CustomerID") > 0, F.col("Recency")))
    missing = missing.withColumn("A", F.when(F.col("CustomerID") > 0, F.col("A")))
    assert clustering.silhouettes(missing, ["A"], 10) == {"A": None}


@pytest.mark.parametrize("groups", [1, 3])
def test_distances_of_two_blocks_are_taken_once_for_both(spark, groups):
    """Each pair came twice, once for either block."""
    blocks = spark.range(0, 23, 1, 4).select(F.monotonically_increasing_id().alias("block"), F.col("id").alias("points"))
    blocks = spark.createDataFrame(blocks.collect(), blocks.schema)
    pairs = clustering.block_pairs(blocks, groups)
    met = [tuple(sorted((r.points, r.o_points))) for r in pairs.collect()]
    assert len(met) == len(set(met)) == 23 * 24 // 2
    assert "CartesianProduct" in pairs._jdf.queryExecution().toString()
    own = pairs.filter("block < o_block").count()
    assert 23 * 22 / 8 < own < 23 * 22 * 3 / 8
