"""Scaling, K-means, silhouettes and principal components of the RFM table."""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.expressions import half_even, share_percent
from shoplens.operators import kmeans, silhouette_tree
from shoplens.sources.stages import store

RFM_COLUMNS = ("Recency", "Frequency", "Monetary")
CLUSTERS = 4
K_RANGE = range(2, 11)
RESTARTS = 10
SEED = 42
BLOCK_ROWS, TASK_BLOCKS = 4096, 64
SLAB = 16  # rows whose distances to a block stay in a core's cache
TOTALS = 16 << 20  # bytes of sums that a task holds for the blocks on one side


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations, fitted on one table and applied to any."""

    stats: dict[str, tuple[float, float]]

    @staticmethod
    def fit(frame: DataFrame, columns: Sequence[str]) -> "Scaler":
        value = {c: F.col(c).cast("double") for c in columns}
        row = frame.agg(
            *[F.avg(v).alias(f"mean_{c}") for c, v in value.items()],
            *[F.stddev_pop(v).alias(f"std_{c}") for c, v in value.items()],
        ).first()
        return Scaler({c: (row[f"mean_{c}"], row[f"std_{c}"]) for c in columns})

    def column(self, name: str) -> Column:
        mean, std = self.stats[name]
        # A constant column is only centred.
        return (F.col(name).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)

    def apply(self, frame: DataFrame) -> DataFrame:
        return frame.withColumns({c: self.column(c) for c in self.stats})


def log1p_features(rfm: DataFrame) -> DataFrame:
    return rfm.select(
        "CustomerID", *[F.log1p(F.col(c).cast("double")).alias(c) for c in RFM_COLUMNS]
    )


def scaled_features(rfm: DataFrame) -> DataFrame:
    """CustomerID and the z-scores of the logged features, stored because fits re-read them."""
    logged = log1p_features(rfm)
    return store(Scaler.fit(logged, RFM_COLUMNS).apply(logged), "rfm-scaled")


def _vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(RFM_COLUMNS), outputCol="features").transform(features)


def _best_fits(
    features: DataFrame, ks: Sequence[int], restarts: int, seed: int
) -> dict[int, kmeans.Fit]:
    return kmeans.best_fits(features, "CustomerID", RFM_COLUMNS, ks, restarts, seed)


def fit_centers(
    features: DataFrame, k: int = CLUSTERS, restarts: int = RESTARTS, seed: int = SEED
) -> list[list[float]]:
    """Centers of the best of several K-means runs, in ascending order so labels are stable."""
    return _best_fits(features, [k], restarts, seed)[k].centers


def _squared_distances(centers: Sequence[Sequence[float]]) -> Column:
    return F.array(
        *[
            sum(
                (
                    (F.col(c) - F.lit(x)) * (F.col(c) - F.lit(x))
                    for c, x in zip(RFM_COLUMNS, center)
                ),
                F.lit(0.0),
            )
            for center in centers
        ]
    )


def assign(features: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest center per row as column arithmetic, the lowest label on ties."""
    distances = _squared_distances(centers)
    return features.withColumn(
        "Cluster", (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
    )


def inertia(features: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Sum of squared distances to the nearest center."""
    return features.agg(F.sum(F.array_min(_squared_distances(centers))).alias("Inertia"))


def k_sweep(
    features: DataFrame,
    ks: Sequence[int] = K_RANGE,
    restarts: int = RESTARTS,
    seed: int = SEED,
    metric: str = "squaredEuclidean",
) -> DataFrame:
    """Inertia and silhouette per k.

    The silhouette in squared distances is exact and linear in customers. ``metric="euclidean"``
    asks for plain distances, summed over a tree of cells: about linear too, and near the exact value.
    """
    models = _best_fits(features, list(ks), restarts, seed)
    labelled = features
    for k, model in models.items():
        labelled = assign(labelled, model.centers).withColumnRenamed("Cluster", f"k{k}")
    labels = [f"k{k}" for k in models]
    if metric == "euclidean":
        scores = {c: found.mean for c, found in tree_silhouettes(labelled, labels).items()}
    elif metric == "squaredEuclidean":
        scores = {c: squared_silhouette(labelled, c) for c in labels}
    else:
        raise ValueError(f"unknown metric {metric!r}")
    rows = [(k, m.cost, scores[f"k{k}"]) for k, m in models.items()]
    return features.sparkSession.createDataFrame(rows, "K int, Inertia double, Silhouette double")


def squared_silhouette(labelled: DataFrame, label: str) -> float:
    """Mean silhouette in squared Euclidean distance, from per-cluster moments."""
    points = _vectors(labelled).withColumn("prediction", F.col(label).cast("double"))
    return ClusteringEvaluator().evaluate(points)


def block_pairs(blocks: DataFrame, groups: int) -> DataFrame:
    """Each two rows of ``blocks`` once, and each row with itself, the second one as ``o_...``; a task holds the pairs
    of two of ``groups`` groups, about half of them one way round and half in the task of the same groups reversed."""
    other = blocks.select(*[F.col(c).alias(f"o_{c}") for c in blocks.columns]).repartition(groups)

    def number(c: str) -> Column:
        return F.shiftright(c, 33) + F.col(c).bitwiseAND(F.lit((1 << 33) - 1))

    even = (number("block") + number("o_block")) % 2 == 0
    once = (F.col("block") == F.col("o_block")) | (
        (F.col("block") != F.col("o_block")) & ((F.col("block") < F.col("o_block")) == even)
    )
    return blocks.repartition(groups).hint("shuffle_replicate_nl").crossJoin(other).filter(once)


def silhouettes(
    labelled: DataFrame, labels: Sequence[str], block_rows: int = BLOCK_ROWS
) -> dict[str, float]:
    """Exact mean silhouette in plain Euclidean distance for several labelings at once.

    Rows are packed into blocks of at most ``block_rows`` and every pair of blocks meets once, in a product
    of block tables that no shuffle copies. Distances are taken block by block and shared by all labelings and by
    both blocks; a task adds up a row's sums per cluster over ``TASK_BLOCKS`` blocks before they leave it, so disk
    and memory grow with the rows, only the arithmetic with half their square. ``labelled`` is read several
    times; pass a stored table.
    """
    sizes = labelled.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.max(c).alias(f"max_{c}") for c in labels],
    ).first()
    if sizes.rows == 0:
        return dict.fromkeys(labels, None)
    width = {c: sizes[f"max_{c}"] + 1 for c in labels}
    members = labelled.agg(
        *[F.count_if(F.col(c) == j).alias(f"{c}_{j}") for c in labels for j in range(width[c])]
    ).first()
    count = {c: [members[f"{c}_{j}"] for j in range(width[c])] for c in labels}
    blocks = math.ceil(sizes.rows / block_rows)
    sums = [f"{c}_{j}" for c in labels for j in range(width[c])]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In even pieces, so that a partition a few rows too long makes no block of a few rows.
            step = math.ceil(batch.num_rows / max(math.ceil(batch.num_rows / (1.25 * block_rows)), 1)) or 1
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                columns = [c.to_numpy(zero_copy_only=False).astype("<f8") for c in part.columns]
                points = np.stack(columns[: len(RFM_COLUMNS)]).tobytes()
                marks = np.nan_to_num(np.stack(columns[len(RFM_COLUMNS) :]), nan=-1).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary()) for x in (points, marks.tobytes())], ["points", "marks"]
                )

    chosen = labelled.select(
        *[F.col(c).cast("double").alias(c) for c in RFM_COLUMNS], *[F.col(c).cast("double").alias(c) for c in labels]
    ).repartition(blocks)
    stored = store(
        chosen.mapInArrow(packed, "points binary, marks binary").withColumn(
            "block", F.monotonically_increasing_id()
        ),
        "silhouette-blocks",
    )
    held = max(min(TASK_BLOCKS, TOTALS // (8 * block_rows * len(sums))), 1)
    cores = labelled.sparkSession.sparkContext.defaultParallelism
    groups = max(math.ceil(blocks / held), min(blocks, math.ceil(math.sqrt(4 * cores))))

    def unpack(points: bytes, marks: bytes) -> tuple[np.ndarray, np.ndarray]:
        place = np.frombuffer(points, "<f8").reshape(len(RFM_COLUMNS), -1)
        return place, np.frombuffer(marks, "<i4").reshape(len(labels), -1)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, mine, marks, total = None, None, None, None
        others: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def done(block: int, marks: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            columns = [np.full(marks.shape[1], block), np.arange(marks.shape[1]), *marks, *total]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "place", *labels, *sums]
            )

        def members(marks: np.ndarray) -> np.ndarray:
            return np.vstack([marks[i] == np.arange(width[c])[:, None] for i, c in enumerate(labels)]).astype(float)

        for batch in batches:
            for number in range(batch.num_rows):
                (row,) = batch.slice(number, 1).to_pylist()
                if row["block"] != block:
                    if block is not None:
                        yield done(block, marks, total)
                    block = row["block"]
                    mine, marks = unpack(row["points"], row["marks"])
                    total, own = np.zeros((len(sums), mine.shape[1])), members(marks)
                other, theirs = unpack(row["o_points"], row["o_marks"])
                alone = row["o_block"] == block
                if not alone and row["o_block"] not in others:
                    others[row["o_block"]] = theirs, np.zeros((len(sums), other.shape[1]))
                member = np.ascontiguousarray(members(theirs).T)
                for at in range(0, mine.shape[1], SLAB):
                    some = mine[:, at : at + SLAB]
                    squares = np.subtract(some[0][:, None], other[0][None, :])
                    np.multiply(squares, squares, out=squares)
                    away = np.empty_like(squares)
                    for d in range(1, len(RFM_COLUMNS)):
                        np.subtract(some[d][:, None], other[d][None, :], out=away)
                        np.multiply(away, away, out=away)
                        squares += away
                    np.sqrt(squares, out=squares)
                    total[:, at : at + SLAB] += (squares @ member).T
                    if not alone:
                        others[row["o_block"]][1][...] += own[:, at : at + SLAB] @ squares
        if block is not None:
            yield done(block, marks, total)
        for number, (theirs, found) in others.items():
            yield done(number, theirs, found)

    kinds = [pa.int64(), pa.int32(), *[pa.int32()] * len(labels), *[pa.float64()] * len(sums)]
    keys = ["block", "place", *labels]
    schema = "block long, place int, " + ", ".join(
        [f"{c} int" for c in labels] + [f"{s} double" for s in sums]
    )
    # A row whose distances are not numbers has no silhouette.
    known = [F.nullif(F.sum(s), F.lit(float("nan"))).alias(s) for s in sums]
    per_point = (
        block_pairs(stored, groups)
        .mapInArrow(met, schema)
        .groupBy(*keys)
        .agg(*known)
    )

    def width_of(c: str) -> Column:
        own = F.lit(None).cast("double")
        others = []
        for j in range(width[c]):
            if not count[c][j]:
                continue
            mine = F.col(c) == j
            total = F.col(f"{c}_{j}")
            own = F.when(mine, total / max(count[c][j] - 1, 1)).otherwise(own)
            others.append(F.when(~mine, total / count[c][j]))
        nearest = F.array_min(F.array(*others))
        alone = F.lit(False)
        for j, n in enumerate(count[c]):
            if n == 1:
                alone = alone | (F.col(c) == j)
        spread = F.greatest(own, nearest)
        return F.when(alone | (spread == 0), 0.0).otherwise((nearest - own) / spread)

    means = per_point.agg(*[F.avg(width_of(c)).alias(c) for c in labels]).first()
    return {c: means[c] for c in labels}


def tree_silhouettes(
    labelled: DataFrame, labels: Sequence[str]
) -> dict[str, silhouette_tree.Silhouette]:
    """Mean silhouettes in plain distances with bounds of their errors, by cells of a tree."""
    return silhouette_tree.silhouettes(labelled, RFM_COLUMNS, labels)


def silhouette(labelled: DataFrame, label: str = "Cluster") -> DataFrame:
    """The exact mean silhouette of one labeling as a one-row table."""
    value = silhouettes(labelled, [label])[label]
    return labelled.sparkSession.createDataFrame([(value,)], "Silhouette double")


def squared_silhouette_row(labelled: DataFrame, label: str = "Cluster") -> DataFrame:
    value = squared_silhouette(labelled, label)
    return labelled.sparkSession.createDataFrame([(value,)], "Silhouette double")


@dataclass(frozen=True)
class Components:
    """Two principal directions of centred features, and the variance they keep."""

    loadings: list[list[float]]
    variance_ratio: list[float]

    @staticmethod
    def fit(features: DataFrame) -> "Components":
        model = PCA(k=2, inputCol="features", outputCol="pca").fit(_vectors(features))
        loadings = []
        for direction in model.pc.toArray().T:
            # A direction has no sign of its own: the largest loading is made positive.
            sign = 1.0 if direction[np.argmax(np.abs(direction))] >= 0 else -1.0
            loadings.append([float(sign * x) for x in direction])
        return Components(loadings, [float(x) for x in model.explainedVariance.toArray()])

    def variance(self, frame: DataFrame) -> DataFrame:
        """The share of the variance that each direction keeps."""
        return frame.sparkSession.createDataFrame(
            list(enumerate(self.variance_ratio, start=1)), "Component int, Ratio double"
        )

    def apply(self, features: DataFrame) -> DataFrame:
        return features.withColumns(
            {
                f"PCA{n}": sum(
                    (F.col(c) * F.lit(x) for c, x in zip(RFM_COLUMNS, direction)), F.lit(0.0)
                )
                for n, direction in enumerate(self.loadings, start=1)
            }
        )


def cluster_customers(
    segments: DataFrame,
    k: int = CLUSTERS,
    restarts: int = RESTARTS,
    seed: int = SEED,
    features: DataFrame | None = None,
) -> DataFrame:
    """The scored table with its cluster and two principal coordinates.

    ``features``: the scaled features, where they are stored already.
    """
    features = scaled_features(segments) if features is None else features
    labelled = assign(features, fit_centers(features, k, restarts, seed))
    placed = Components.fit(features).apply(labelled)
    return segments.join(placed.select("CustomerID", "Cluster", "PCA1", "PCA2"), "CustomerID")


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size and averages per cluster, rounded; revenue shares come from the rounded revenue."""
    profile = (
        clustered.filter(F.col("Cluster").isNotNull())
        .groupBy("Cluster")
        .agg(
            F.count("CustomerID").alias("Customers"),
            *[half_even(F.avg(F.col(c).cast("double")), 2).alias(f"Avg{c}") for c in RFM_COLUMNS],
            half_even(F.sum("Monetary"), 2).alias("TotalRevenue"),
        )
    )
    totals = profile.agg(
        F.struct(F.sum("Customers").alias("customers"), F.sum("TotalRevenue").alias("revenue"))
    ).scalar()
    return profile.select(
        "*",
        half_even(share_percent(F.col("Customers"), totals.getField("customers")), 2).alias(
            "PctOfCustomers"
        ),
        half_even(share_percent(F.col("TotalRevenue"), totals.getField("revenue")), 2).alias(
            "PctOfRevenue"
        ),
    ).orderBy(F.desc("AvgMonetary"), "Cluster")
