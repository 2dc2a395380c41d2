"""Churn classifiers: fits that do not depend on how rows are laid out, scores, importances, comparison."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators import trees as tree_models
from shoplens.operators.churn_features import FEATURES, class_counts
from shoplens.operators.clustering import Scaler
from shoplens.operators.evaluation import classification_metrics
from shoplens.operators.exploration import best_row

# Model names and the reference settings.
LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Boosted Trees"
FOREST_TREES, FOREST_DEPTH = 300, 8
BOOST_ROUNDS, BOOST_DEPTH, BOOST_STEP = 300, 5, 0.05
SEED = 42


def balanced_weight(counts: dict[int, int], label: str = "Churned") -> Column:
    rows = sum(counts.values())
    case = F.lit(1.0)
    for value, n in counts.items():
        if n:
            case = F.when(F.col(label) == value, rows / (len(counts) * n)).otherwise(case)
    return case


def positive_weight(counts: dict[int, int], label: str = "Churned") -> Column:
    return F.when(F.col(label) == 1, counts[0] / max(counts[1], 1)).otherwise(1.0)


def _check_two_classes(counts: dict[int, int]) -> None:
    if not all(counts.values()):
        raise ValueError(f"a classifier needs rows of both classes, got {counts}")


@dataclass
class Logistic:
    """Coefficients of the scaled features."""

    coefficients: DenseVector
    intercept: float

    def score(self, frame: DataFrame, name: str, scaler: Scaler) -> DataFrame:
        terms = [F.lit(float(w)) * scaler.column(c) for w, c in zip(self.coefficients, FEATURES)]
        margin = reduce(lambda total, term: total + term, terms, F.lit(float(self.intercept)))
        return frame.withColumn(name, 1 / (1 + F.exp(-margin)))


def logistic_sums(data: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature matrix of the weighted logistic loss at ``beta`` (the constant last),
    added up on the executors. ``data``: label, weight, then the features; one row of sums per batch comes back."""
    size = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y, w, *xs = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
            x = np.column_stack([*xs, np.ones(len(y))])
            margin = x @ beta
            p = 1 / (1 + np.exp(-margin))
            loss = (w * (np.logaddexp(0, margin) - y * margin)).sum()
            curve = (x * (w * p * (1 - p))[:, None]).T @ x
            sums = np.concatenate([[loss], x.T @ (w * (p - y)), curve.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], ["place", "value"]
            )

    rows = data.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    sums = np.zeros(1 + size + size * size)
    for row in rows.collect():  # as many rows as the model has sums, whatever the data
        sums[row.place] = row.value
    return float(sums[0]), sums[1 : 1 + size], sums[1 + size :].reshape(size, size)


def fit_logistic(train: DataFrame, label: str = "Churned", max_iter: int = 1000):
    """Balanced L2 logistic regression on standardized features, run to its single optimum.

    Newton steps on the summed loss with a unit penalty (the constant is free); a step that does not lower the
    objective is halved. Returns the model and the scaler fitted on the training rows. ``train`` is
    read once per step; pass a stored table.
    """
    counts = class_counts(train, label)
    _check_two_classes(counts)
    scaler = Scaler.fit(train, FEATURES)
    data = train.select(
        F.col(label).cast("double").alias("label"), balanced_weight(counts, label).alias("weight"),
        *(scaler.column(c).alias(f"x{i}") for i, c in enumerate(FEATURES)),
    )
    penalty = np.array([1.0] * len(FEATURES) + [0.0])

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, slope, curve = logistic_sums(data, beta)
        return loss + 0.5 * float(penalty @ beta**2), slope + penalty * beta, curve + np.diag(penalty)

    beta = np.zeros(len(FEATURES) + 1)
    value, slope, curve = at(beta)
    for _ in range(max_iter):
        step = np.linalg.solve(curve + 1e-12 * np.eye(len(beta)), -slope)
        while True:
            found = at(beta + step)
            if found[0] <= value + 1e-12 * abs(value) or np.abs(step).max() < 1e-12:
                break
            step = step / 2
        beta = beta + step
        value, slope, curve = found
        if np.abs(step).max() < 1e-9:
            break
    return Logistic(DenseVector(beta[:-1]), float(beta[-1])), scaler


def fit_forest(
    train: DataFrame,
    label: str = "Churned",
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = SEED,
    key: str = "CustomerID",
) -> tree_models.Ensemble:
    """Class-balanced forest; the bootstrap follows the hash of ``key``."""
    counts = class_counts(train, label)
    _check_two_classes(counts)
    rows = sum(counts.values())
    weights = [rows / (len(counts) * counts[c]) for c in (0, 1)]
    return tree_models.grow_forest(train, key, label, FEATURES, trees, depth, weights, seed)


def fit_boosted(
    train: DataFrame,
    label: str = "Churned",
    rounds: int = BOOST_ROUNDS,
    depth: int = BOOST_DEPTH,
    step: float = BOOST_STEP,
    key: str = "CustomerID",
) -> tree_models.Ensemble:
    """Gradient-boosted trees; positives weigh as much as all negatives."""
    counts = class_counts(train, label)
    _check_two_classes(counts)
    weight = counts[0] / counts[1]
    return tree_models.boost(train, key, label, FEATURES, rounds, depth, step, positive=weight)


def score(model, frame: DataFrame, name: str = "ChurnProbability", scaler=None) -> DataFrame:
    """Add P(churn) to every row; the model travels to the executors, the rows do not move."""
    return model.score(frame, name, scaler) if scaler else model.score(frame, name)


def linear_score(frame: DataFrame, weights: Sequence[float], intercept: float) -> DataFrame:
    """P(churn) of a logistic model with known coefficients, as plain column arithmetic."""
    margin = reduce(
        lambda total, pair: total + F.lit(float(pair[0])) * F.col(pair[1]).cast("double"),
        zip(weights, FEATURES),
        F.lit(float(intercept)),
    )
    return frame.withColumn("ChurnProbability", 1 / (1 + F.exp(-margin)))


def feature_importance(model, frame: DataFrame) -> DataFrame:
    """Importances of a tree model, largest first."""
    rows = [
        (i, name, float(value))
        for i, (name, value) in enumerate(zip(FEATURES, model.importances))
    ]
    table = frame.sparkSession.createDataFrame(rows, "Position int, Feature string, Importance double")
    return table.orderBy(F.desc("Importance"), "Position").drop("Position")


def model_comparison(scored: dict[str, DataFrame], label: str, probability: str) -> DataFrame:
    """One row of metrics per model, in the given order."""
    rows = [
        classification_metrics(frame, label, probability).select(
            F.lit(i).alias("Position"), F.lit(name).alias("Model"), "*"
        )
        for i, (name, frame) in enumerate(scored.items())
    ]
    return reduce(DataFrame.unionByName, rows)


def best_model(comparison: DataFrame) -> DataFrame:
    return best_row(comparison, "ROC-AUC", F.col("Position"))
