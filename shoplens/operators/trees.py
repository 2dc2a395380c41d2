"""Histogram trees that come out the same from any layout of the rows.

Features are cut into at most ``BINS`` bins at exact quantiles of the training rows. A tree grows a level at
a time: executors add up whole numbers per (node, feature, bin). For a boosted tree the driver sees the sums and
chooses the splits; a forest's splits are chosen where a tree's sums meet, and only they come to the driver. Whole numbers add exactly in any order, and what a row draws comes from a hash of its key,
so partitions, files and lost tasks leave no trace in a model.

``boost`` is second-order boosting of the logistic loss: gradients and curvatures in units of 1 / ``UNIT``, gain
with an L2 penalty and a least curvature per child. ``grow_forest`` bootstraps by Poisson weights and looks
at a random few of the features in each node.

Rows travel once: they are stored as blocks of numpy columns and cached, and each level is one small pass
over the blocks (hundreds of passes for a boosted model, which is why they are an RDD: planning a query
for each would take longer than the pass). A task works through blocks of at most ``BLOCK`` rows, whose columns
stay in a core's cache. Margins, gradients and curvatures of boosting are worked out once a round and cached; below
the root only the child of less curvature is added up, and the other one is what is left of its parent, exact in
whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.order_stats import ordered_values
from shoplens.sources.stages import store

BINS, BLOCK = 64, 1 << 16
UNIT = 1 << 24
RESULT = 16 << 20  # bytes of histograms that a task of one pass may hold
RENEW = 20  # rounds after which margins are worked out from the stored blocks again
MASKED = 5  # levels of a tree that comparing all rows with each node takes less time than looking up each row's node
FEW = 32  # tasks whose sums the driver adds up itself
MASK = 0xFFFFFFFF
#: Poisson(1) by inversion: how many of these limits a 32-bit draw reaches.
LIMITS = np.rint(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(11)]) * 2**32
).astype(np.uint64)


# ---- bins ----------------------------------------------------------------------------------------


def quantile_cuts(frame: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature the distinct values at the positions that part the rows into ``bins`` equal groups.
    ``frame`` is read several times; pass a stored table."""
    rows = frame.count()
    places = sorted({-(-k * rows // bins) - 1 for k in range(1, bins)}) if rows else []
    values = frame.select(*[F.col(name).cast("double").alias(name) for name in features])
    found = ordered_values(values, features, places)
    return [np.unique([found[name][p] for p in places]).astype(float) for name in features]


def binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """How many cuts lie below each value; a column per feature, each in one piece."""
    out = np.empty(values.shape, dtype=np.uint8, order="F")
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(c, values[:, f], side="left")
    return out


@dataclass
class Block:
    """Rows by column. ``steps``: gradients and curvatures of the boosting round."""

    keys: np.ndarray
    labels: np.ndarray
    bins: np.ndarray
    margins: np.ndarray | None = None
    steps: list[np.ndarray] = field(default_factory=list)


def blocks_of(
    train: DataFrame, key: str, label: str, features: Sequence[str], cuts: Sequence[np.ndarray]
) -> RDD:
    """The training rows in blocks, stored in the shared folder and cached from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                columns = [part.column(i).to_numpy(zero_copy_only=False) for i in range(part.num_columns)]
                matrix = binned(np.column_stack(columns[2:]).astype(float), cuts)
                raw = columns[0].astype("<i8"), columns[1].astype("i1"), matrix
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in raw], ["keys", "labels", "bins"]
                )

    chosen = train.select(
        F.col(key).cast("bigint").alias("key"), F.col(label).cast("int").alias("label"),
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)),
    )
    chosen = chosen.repartition(max(math.ceil(train.count() / BLOCK), 1))
    rows = store(chosen.mapInArrow(run, "keys binary, labels binary, bins binary"), "tree-blocks")
    width = len(features)

    def joined(pieces: Iterable) -> Block:
        keys, labels, bins = (b"".join(parts) for parts in zip(*pieces))
        matrix = np.frombuffer(bins, dtype=np.uint8).reshape(-1, width)
        return Block(np.frombuffer(keys, dtype="<i8"), np.frombuffer(labels, dtype="i1"), np.asfortranarray(matrix))

    def unpack(some: Iterable) -> Iterator[Block]:
        held, size = [], 0
        for row in some:
            if held and size + len(row.labels) > BLOCK:
                yield joined(held)
                held, size = [], 0
            held.append((row.keys, row.labels, row.bins))
            size += len(row.labels)
        if held:
            yield joined(held)

    # In whole rounds of tasks: hundreds of passes would each wait for a last round of a few.
    packed, cores = rows.rdd, train.sparkSession.sparkContext.defaultParallelism
    parts = packed.getNumPartitions()
    return (packed.coalesce(parts // cores * cores) if parts > cores else packed).mapPartitions(unpack)


# ---- trees -----------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Node 1 is the root, n has the children 2n and 2n + 1; feature -1 marks a leaf. A row goes right
    if its bin is above the cut."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 << self.depth
        self.feature, self.cut = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.value = np.zeros(size)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The last node that each row reaches so far."""
        # A leaf sends its rows to itself; a cut above all bins sends none to the right.
        inner = self.feature >= 0
        kind = np.uint8 if len(inner) <= 256 else np.uint16 if len(inner) <= 1 << 16 else np.int64
        left = np.where(inner, 2 * np.arange(len(inner)), np.arange(len(inner))).astype(kind)
        cut = np.where(inner, self.cut, 255).astype(np.uint8)
        offset = np.maximum(self.feature, 0) * len(bins)
        node = np.ones(len(bins), dtype=kind)
        flat = rows = None
        for level in range(self.depth):
            splits = np.flatnonzero(inner[1 << level : 2 << level]) + (1 << level)
            if not len(splits):
                break
            if level < MASKED:
                right = np.zeros(len(bins), dtype=bool)
                for n in splits.tolist():
                    here = node == n
                    here &= bins[:, self.feature[n]] > cut[n]
                    right |= here
                node = left.take(node)
            else:
                if flat is None:
                    flat, rows = bins.ravel(order="F"), np.arange(len(bins))
                at = node.astype(np.intp)
                place = offset.take(at)
                place += rows
                right = flat.take(place) > cut.take(at)
                node = left.take(at)
            node += right
        return node


@dataclass
class Ensemble:
    """Trees over binned features. ``total`` adds leaf values and gives their logistic probability, otherwise
    the mean of the leaf shares counts. ``gains``: per feature the gain of each split, added up."""

    features: list[str]
    cuts: list[np.ndarray]
    trees: list[Tree]
    total: bool
    gains: np.ndarray
    splits: np.ndarray

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        values = np.zeros(len(bins))
        for tree in self.trees:
            values += tree.value[tree.nodes(bins)]
        return 1 / (1 + np.exp(-values)) if self.total else values / max(len(self.trees), 1)

    @property
    def importances(self) -> np.ndarray:
        """Boosting: the mean gain of a feature's splits; a forest: the total. Both as shares of one."""
        raw = self.gains / np.maximum(self.splits, 1) if self.total else self.gains
        return raw / raw.sum() if raw.sum() > 0 else raw

    def score(self, frame: DataFrame, name: str) -> DataFrame:
        """``frame`` with the probability of each row; the model travels to the executors."""
        shared = frame.sparkSession.sparkContext.broadcast(self)
        inputs = [f"_f_{i}" for i in range(len(self.features))]
        columns = {i: F.col(c).cast("double") for i, c in zip(inputs, self.features)}
        schema = T.StructType([*frame.schema.fields, T.StructField(name, T.DoubleType())])
        kept = frame.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches:
                values = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in inputs])
                found = pa.array(model.probabilities(binned(values.astype(float), model.cuts)))
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), found], [*kept, name])

        return frame.withColumns(columns).mapInArrow(run, schema)


def summed(blocks: RDD, count: Callable[[Block], np.ndarray]) -> np.ndarray:
    """The blocks' arrays added up; whole numbers, so in any order."""

    def partition(some: Iterable[Block]) -> Iterator[np.ndarray]:
        total = None
        for block in some:
            found = count(block)
            total = found if total is None else total + found
        if total is not None:
            yield total

    sums = blocks.mapPartitions(partition)
    return sums.treeReduce(np.add, depth=2 if sums.getNumPartitions() > FEW else 1)


def histogram(
    cells: np.ndarray, bins: np.ndarray, weights: Sequence[np.ndarray], size: int, rows: np.ndarray | None = None
) -> np.ndarray:
    """(cell, feature, bin, weight): sums of whole numbers below 2**53 per block, exact in doubles. ``rows``: those
    rows of ``bins`` that cells and weights are of, if not all. Two features are counted at once, as
    pairs of bins, where the table of pairs is not much larger than the rows."""
    width = bins.shape[1]
    out = np.empty((size, width, BINS, len(weights)), dtype=np.int64)
    weights = [w.astype(float) for w in weights]
    together = 2 if size * BINS * BINS <= 2 * len(cells) else 1
    start = cells.astype(np.int64) * BINS**together
    for f in range(0, width, together):
        columns = [bins[:, g] if rows is None else bins[:, g].take(rows) for g in range(f, min(f + together, width))]
        if len(columns) == 2:
            code = columns[0].astype(np.uint16)
            code *= BINS
            code += columns[1]
            columns = [code]
        elif together == 2:  # the last of an odd number of features
            columns = [columns[0].astype(np.uint16) * np.uint16(BINS)]
        place = start + columns[0]
        for w, weight in enumerate(weights):
            found = np.bincount(place, weight, minlength=size * BINS**together)
            if together == 1:
                out[:, f, :, w] = found.reshape(size, BINS)
                continue
            pairs = found.reshape(size, BINS, BINS)
            out[:, f, :, w] = pairs.sum(axis=2)
            if f + 1 < width:
                out[:, f + 1, :, w] = pairs.sum(axis=1)
    return out


# ---- boosting --------------------------------------------------------------------------------------


def steps_of(block: Block, margins: np.ndarray, positive: float) -> list[np.ndarray]:
    """Gradient and curvature of each row's loss in whole units, in four bytes where they fit."""
    p = 1 / (1 + np.exp(-margins))
    weight = np.where(block.labels == 1, positive, 1.0)
    first, second = weight * (p - block.labels), weight * (p * (1 - p))
    kind = np.int32 if (max(positive, 1.0) + 1) * UNIT < 1 << 31 else float
    return [np.floor(x * UNIT + 0.5).astype(kind) for x in (first, second)]


def boost_level(sums: np.ndarray, penalty: float, least: float) -> list[tuple[float, int, int] | None]:
    """For each node the gain, feature and cut of its best split; ``sums``: (node, feature, bin, 2)."""
    left = np.cumsum(sums, axis=2)[:, :, :-1].astype(float) / UNIT
    whole = sums[:, 0].sum(axis=1).astype(float) / UNIT
    g, h = left[..., 0], left[..., 1]
    all_g, all_h = whole[:, None, None, 0], whole[:, None, None, 1]
    gain = g * g / (h + penalty) + (all_g - g) * (all_g - g) / (all_h - h + penalty) - all_g * all_g / (all_h + penalty)
    gain = np.where((h >= least) & (all_h - h >= least), gain, -np.inf).reshape(len(sums), -1)
    best = gain.argmax(axis=1)  # of equal gains the first feature, its lowest cut
    found = []
    for node, at in enumerate(best.tolist()):
        size = gain[node, at]
        found.append((float(size), at // (BINS - 1), at % (BINS - 1)) if size > 1e-6 else None)
    return found


def boost(
    train: DataFrame, key: str, label: str, features: Sequence[str], rounds: int, depth: int, step: float,
    positive: float = 1.0, penalty: float = 1.0, least: float = 1.0,
) -> Ensemble:
    """A boosted ensemble; ``positive`` weighs the rows of class 1. ``train`` should be a stored table."""
    cuts = quantile_cuts(train, features)
    base = blocks_of(train, key, label, features, cuts).map(lambda b: Block(b.keys[:0], b.labels, b.bins))
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    model = Ensemble(list(features), cuts, [], True, np.zeros(len(features)), np.zeros(len(features)))

    def advanced(block: Block, trees: list[Tree]) -> Block:
        margins = np.zeros(len(block.labels)) if block.margins is None else block.margins
        for tree in trees:
            margins = margins + tree.value[tree.nodes(block.bins)]
        return Block(block.keys, block.labels, block.bins, margins, steps_of(block, margins, positive))

    current = base
    for number in range(rounds):
        # From the stored blocks with all trees now and then, so that a lost block does not cost a long chain.
        older = current
        source, trees = (base, list(model.trees)) if number % RENEW == 0 else (older, model.trees[-1:])
        current = source.map(lambda b, trees=trees: advanced(b, trees)).persist(StorageLevel.MEMORY_AND_DISK)
        tree = Tree(depth)
        above, counted = np.empty(0), np.zeros(2 << depth, dtype=np.int64)
        for level in range(depth):
            first = 1 << level

            # Of the children of each node that was split the one to add up, by the place of the node on its level.
            parents = np.flatnonzero(tree.feature[first >> 1 : first] >= 0) if level else np.empty(0, np.int64)
            spot = np.full(2 << depth, -1)
            spot[counted[parents + (first >> 1)]] = parents

            def count(block: Block, tree=tree, first=first, spot=spot) -> np.ndarray:
                if first == 1:
                    return histogram(np.zeros(len(block.labels), np.int64), block.bins, block.steps, 1)
                cell = spot.take(tree.nodes(block.bins))
                chosen = np.flatnonzero(cell >= 0)
                weights = [w.take(chosen) for w in block.steps]
                return histogram(cell.take(chosen), block.bins, weights, first >> 1, chosen)

            sums = summed(current, count)
            if level:
                # Children of a leaf have no rows.
                split = tree.feature[first >> 1 : first] >= 0
                other = np.where(split[:, None, None, None], above - sums, 0)
                right = (counted[first >> 1 : first] & 1 == 1)[:, None, None, None]
                pair = [np.where(right, other, sums), np.where(right, sums, other)]
                sums = np.stack(pair, axis=1).reshape(first, *sums.shape[1:])
            above = sums
            for node, split in enumerate(boost_level(sums, penalty, least), first):
                whole = sums[node - first, 0].sum(axis=0).astype(float) / UNIT
                tree.value[node] = -step * whole[0] / (whole[1] + penalty)
                if split is None:
                    continue
                gain, f, cut = split
                tree.feature[node], tree.cut[node] = f, cut
                model.gains[f] += gain
                model.splits[f] += 1
                left = sums[node - first, f, : cut + 1].sum(axis=0).astype(float) / UNIT
                counted[node] = 2 * node + int(left[1] > whole[1] - left[1])
                for child, (g, h) in ((2 * node, left), (2 * node + 1, whole - left)):
                    tree.value[child] = -step * g / (h + penalty)
            if level == 0 and older is not base:
                older.unpersist()
            if not (tree.feature[first : 2 * first] >= 0).any():
                break
        model.trees.append(tree)
    current.unpersist()
    base.unpersist()
    return model


# ---- forest ----------------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """32 well-spread bits of 32-bit numbers."""
    x = (x & np.uint64(MASK)).astype(np.uint32)  # products wrap
    for _ in range(2):
        x = (x ^ (x >> np.uint32(16))) * np.uint32(0x45D9F3B)
    return x ^ (x >> np.uint32(16))


def seeds(keys: np.ndarray, seed: int) -> np.ndarray:
    """What the draws of all trees for a row start from."""
    keys = keys.astype(np.int64).view(np.uint64)
    return mixed((keys ^ (keys >> np.uint64(32))) + np.uint64(seed))


def drawn(own: np.ndarray, tree: int) -> np.ndarray:
    draw = mixed(own + np.uint64(tree * 0x9E3779B1 & MASK))
    times = np.zeros(len(draw), dtype=np.uint8)
    for limit in LIMITS[LIMITS <= MASK]:
        times += draw >= np.uint32(limit)
    return times


def copies(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree's bootstrap has each row: Poisson(1) from a hash of key, seed and tree."""
    return drawn(seeds(keys, seed), tree).astype(np.int64)


def feature_order(tree: int, nodes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """For each node the features in the order in which it looks at them."""
    own = mixed(np.uint64(tree * 0x9E3779B1 + seed + 1 & MASK) + nodes.astype(np.uint64))
    draws = mixed(own[:, None] + np.arange(width, dtype=np.uint64) * np.uint64(0x85EBCA6B))
    return np.argsort(draws, axis=1, kind="stable")


def forest_level(
    sums: np.ndarray, order: np.ndarray, weights: Sequence[float], looked_at: int
) -> list[tuple[float, int, int] | None]:
    """For each node the impurity decrease, feature and cut of the best split among the first ``looked_at``
    features of its order that have one; ``sums``: (node, feature, bin, class) row counts."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, 0].sum(axis=1)
    right = whole[:, None, None, :] - left
    valid = (left.sum(axis=3) > 0) & (right.sum(axis=3) > 0)
    w = np.asarray(weights, dtype=float)

    def purity(counts: np.ndarray) -> np.ndarray:
        zero, one = counts[..., 0] * w[0], counts[..., 1] * w[1]
        return (zero * zero + one * one) / np.maximum(zero + one, 1e-300)

    value = np.where(valid, purity(left) + purity(right), -np.inf)
    parent = purity(whole)
    found: list[tuple[float, int, int] | None] = []
    for node in range(len(sums)):
        if not whole[node].all():  # of one class, or empty
            found.append(None)
            continue
        best, seen = None, 0
        for f in order[node].tolist():
            if not valid[node, f].any():
                continue
            cut = int(value[node, f].argmax())
            if best is None or value[node, f, cut] > best[0]:
                best = float(value[node, f, cut]), f, cut
            seen += 1
            if seen == looked_at:
                break
        found.append(best and (best[0] - float(parent[node]), best[1], best[2]))
    return found


def leaf_share(counts: np.ndarray, share: np.ndarray) -> float:
    """The weighted part of class 1."""
    mass = counts * share
    return float(mass[1] / mass.sum()) if mass.sum() > 0 else 0.0


def grow_forest(
    train: DataFrame, key: str, label: str, features: Sequence[str], trees: int, depth: int,
    weights: Sequence[float], seed: int, looked_at: int | None = None,
) -> Ensemble:
    """A forest by Gini impurity; ``weights`` of class 0 and 1. All trees grow a level in a few passes."""
    width = len(features)
    looked_at = looked_at or max(int(width**0.5), 1)
    cuts = quantile_cuts(train, features)
    blocks = blocks_of(train, key, label, features, cuts).persist(StorageLevel.MEMORY_AND_DISK)
    grown = [Tree(depth) for _ in range(trees)]
    model = Ensemble(list(features), cuts, grown, False, np.zeros(width), np.zeros(width))
    share = np.asarray(weights, dtype=float)
    for level in range(depth):
        first = 1 << level
        # The nodes that a tree still has to look at on this level: children of splits.
        todo = [
            (number, tree, nodes) for number, tree in enumerate(grown)
            if len(nodes := np.array([n for n in range(first, 2 * first) if n == 1 or tree.feature[n // 2] >= 0]))
        ]
        while todo:
            sizes = np.cumsum([len(nodes) * width * BINS * 2 * 8 for _, _, nodes in todo])
            together = max(int(np.searchsorted(sizes, RESULT, "right")), 1)
            some, todo = todo[:together], todo[together:]

            def count(held: Iterable[Block], some=some, first=first) -> Iterator[tuple[int, np.ndarray]]:
                total = {}
                for block in held:
                    own, labels = seeds(block.keys, seed), block.labels.view(np.uint8)
                    for number, tree, nodes in some:
                        spot = np.full(2 << tree.depth, -1)
                        spot[nodes] = np.arange(len(nodes))
                        cell, times = spot.take(tree.nodes(block.bins)), drawn(own, number)
                        mine = np.flatnonzero((cell >= 0) & (times > 0) & (labels < 2))
                        cells = 2 * cell.take(mine) + labels.take(mine)
                        sums = histogram(cells, block.bins, [times.take(mine)], 2 * len(nodes), mine)
                        total[number] = total[number] + sums if number in total else sums
                for number, sums in total.items():
                    sums = np.moveaxis(sums.reshape(-1, 2, width, BINS), 1, 3)
                    yield number, sums.astype(np.min_scalar_type(-1 - int(sums.max(initial=0))))

            def decide(found: tuple[int, np.ndarray], some=some) -> tuple[int, list]:
                """For each node its rows by class, and its split with the rows by class left of it."""
                number, sums = found
                nodes = next(nodes for n, _, nodes in some if n == number)
                order = feature_order(number, nodes, width, seed)
                splits = forest_level(sums, order, weights, looked_at)
                return number, [
                    (counts[0].sum(axis=0), s and (*s, counts[s[1], : s[2] + 1].sum(axis=0)))
                    for counts, s in zip(sums, splits)
                ]

            met = blocks.mapPartitions(count).combineByKey(
                lambda sums: sums.astype(np.int64), np.add, np.add, numPartitions=min(len(some), blocks.getNumPartitions())
            )
            chosen = dict(met.map(decide).collect())  # a split per node, whatever the rows
            for number, tree, nodes in some:
                for node, (whole, split) in zip(nodes.tolist(), chosen[number]):
                    tree.value[node] = leaf_share(whole, share)
                    if split is None:
                        continue
                    gain, f, cut, left = split
                    tree.feature[node], tree.cut[node] = f, cut
                    model.gains[f] += gain
                    model.splits[f] += 1
                    tree.value[2 * node] = leaf_share(left, share)
                    tree.value[2 * node + 1] = leaf_share(whole - left, share)
    blocks.unpersist()
    return model
