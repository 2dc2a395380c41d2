"""K-means fits that come out the same from any layout of the rows.

Coordinates are counted in whole units of 1 / ``UNIT``, so the sums behind every center add exactly in any
order. Starts are drawn by D-squared sampling as a race: each row gets an exponential draw from a hash of
its key, divided by its squared distance to the centers so far; the least wins. The draws of a
restart do not depend on k, so the start of a smaller k is the beginning of that of a larger one, and
all fits of a sweep share the passes: one per center for the starts, then one per Lloyd step for all fits
that still move. A pass returns sums per center; no row leaves its task but the winners of the races.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.trees import MASK, mixed
from shoplens.sources.stages import store

UNIT = 1 << 24
GOLDEN, STRIDE = 0x9E3779B1, 0x85EBCA6B
STEPS, TOLERANCE = 300, 1e-4


@dataclass
class Fit:
    """Centers in ascending order, and the summed squared distance to the nearest."""

    centers: list[list[float]]
    cost: float


def whole_units(features: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key and the coordinates in whole units, stored because every step reads them."""
    units = [F.floor(F.col(c).cast("double") * UNIT + 0.5).cast("bigint").alias(f"x{i}") for i, c in enumerate(columns)]
    return store(features.select(F.col(key).cast("bigint").alias("key"), *units), "kmeans-points")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy() for c in batch.columns[1:]])


def squares(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(row, center): squared distances, added up in the order of the coordinates."""
    total = np.zeros((len(points), len(centers)))
    for d in range(points.shape[1]):
        total = total + (points[:, d, None] - centers[None, :, d]) ** 2
    return total


def draws(keys: np.ndarray, restart: int, step: int, seed: int) -> np.ndarray:
    """Exponential draws from a hash of key, seed, restart and step."""
    keys = keys.astype(np.int64).view(np.uint64)
    own = mixed((keys ^ (keys >> np.uint64(32))) + np.uint64(seed))
    own = mixed(own + np.uint64(restart * GOLDEN + step * STRIDE & MASK))
    return -np.log((own.astype(float) + 0.5) / 2**32)


def starts(points: DataFrame, most: int, restarts: int, seed: int) -> list[np.ndarray]:
    """For each restart up to ``most`` centers; fewer if there are fewer different points."""
    width = len(points.columns) - 1
    chosen = [np.empty((0, width)) for _ in range(restarts)]
    schema = "restart int, race double, key bigint, " + ", ".join(f"x{i} bigint" for i in range(width))
    for step in range(most):
        sent = [c.copy() for c in chosen]

        def run(batches: Iterator[pa.RecordBatch], step=step, sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, units = batch.column("key").to_numpy(), matrix(batch)
                rows = []
                for restart, centers in enumerate(sent):
                    if len(centers) < step:
                        continue
                    weight = squares(units / UNIT, centers).min(axis=1) if step else np.ones(len(keys))
                    with np.errstate(divide="ignore"):
                        race = draws(keys, restart, step, seed) / weight
                    at = np.lexsort((keys, race))[0]
                    if weight[at] > 0:
                        rows.append((restart, float(race[at]), int(keys[at]), *map(int, units[at])))
                columns = zip(*rows) if rows else [[]] * (3 + width)
                kinds = [pa.int32(), pa.float64()] + [pa.int64()] * (1 + width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], [p.split()[0] for p in schema.split(", ")]
                )

        winners = points.mapInArrow(run, schema).groupBy("restart").agg(
            F.min(F.struct("race", "key", *(f"x{i}" for i in range(width)))).alias("first")
        )
        for row in winners.collect():  # one row per restart
            chosen[row.restart] = np.vstack([chosen[row.restart], np.array(row.first[2:], dtype=float) / UNIT])
    return chosen


def sums_of(points: DataFrame, models: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per center of each model (one after the other) its rows and their summed coordinates, and per model
    its cost; all in whole units."""
    width = len(points.columns) - 1
    size = sum(len(m) for m in models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = matrix(batch)
            found, costs = [], []
            for centers in models:
                distance = squares(units / UNIT, centers)
                near = distance.argmin(axis=1)
                k = len(centers)
                found.append(np.column_stack(
                    [np.bincount(near, minlength=k), *(np.bincount(near, units[:, d], k) for d in range(width))]
                ).astype(np.int64))
                least = distance[np.arange(len(near)), near]
                costs.append(int(np.floor(least * UNIT + 0.5).astype(np.int64).sum()))
            flat = np.concatenate([np.vstack(found).ravel(), np.array(costs, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["place", "value"]
            )

    rows = points.mapInArrow(run, "place int, value bigint").groupBy("place").agg(F.sum("value").alias("value"))
    flat = np.zeros(size * (1 + width) + len(models), dtype=np.int64)
    for row in rows.collect():  # as many rows as the models have sums
        flat[row.place] = row.value
    return flat[: size * (1 + width)].reshape(size, 1 + width), flat[size * (1 + width) :]


def best_fits(
    features: DataFrame, key: str, columns: Sequence[str], ks: Sequence[int], restarts: int, seed: int,
    steps: int = STEPS, tolerance: float = TOLERANCE,
) -> dict[int, Fit]:
    """Per k the fit of least cost over the restarts (of equal ones the first). A fit ends when its centers
    move by at most ``tolerance`` (summed squares), or after ``steps`` steps. A center without rows stays."""
    points = whole_units(features, key, columns)
    first = starts(points, max(ks), restarts, seed)
    models = {(k, r): first[r][:k] for k in ks for r in range(restarts) if len(first[r])}
    moving = list(models)
    for _ in range(steps):
        if not moving:
            break
        sums, _ = sums_of(points, [models[m] for m in moving])
        at, still = 0, []
        for name in moving:
            old = models[name]
            own = sums[at : at + len(old)]
            at += len(old)
            filled = own[:, :1] > 0
            models[name] = np.where(filled, own[:, 1:].astype(float) / np.maximum(own[:, :1], 1) / UNIT, old)
            if ((models[name] - old) ** 2).sum() > tolerance:
                still.append(name)
        moving = still
    names = list(models)
    _, costs = sums_of(points, [models[m] for m in names])
    found = {}
    for k in ks:
        mine = [(int(c), r) for (other, r), c in zip(names, costs) if other == k]
        if mine:
            cost, restart = min(mine)
            found[k] = Fit(sorted(models[k, restart].tolist()), cost / UNIT)
    return found
