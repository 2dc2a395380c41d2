"""Exact order statistics and quantile cuts on tables of any size.

A table of at most ``task_rows`` values is handled by Spark's exact ``percentile``, whose single
aggregator then holds a bounded map. A larger one is narrowed: a quantile sketch brackets each
wanted position, one pass counts the rows around each bracket, and only the strict inside of the
bracket is looked at again. Ties of any weight are settled by the counts alone, so nothing
unbounded reaches one task and the answer is still exact.
"""

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.expressions import number

TASK_ROWS = 250_000  # values one task may hold at once
SKETCH_ACCURACY = 5_000


def exact_quantiles(
    frame: DataFrame,
    wanted: dict[str, Sequence[float]],
    task_rows: int = TASK_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column; nulls and NaN are left out.

    ``frame`` is read several times, so pass a stored table. Only the quantiles come back to the
    driver.
    """
    values = frame.select(*[number(F.col(c)).alias(c) for c in wanted])
    counts = values.agg(*[F.count(c).alias(c) for c in wanted]).first()
    result: dict[str, list[float | None]] = {}
    small = [c for c in wanted if counts[c] <= task_rows]
    if small:
        row = values.agg(
            *[
                F.percentile(c, F.array(*[F.lit(float(p)) for p in wanted[c]])).alias(c)
                for c in small
            ]
        ).first()
        for c in small:
            result[c] = list(row[c]) if row[c] is not None else [None] * len(wanted[c])
    for c in wanted:
        if c in result:
            continue
        spots = [(counts[c] - 1) * p for p in wanted[c]]
        needed = sorted({f(s) for s in spots for f in (math.floor, math.ceil)})
        at = _narrowed(values.select(c).dropna(), c, counts[c], needed, task_rows, accuracy)
        result[c] = [_between(at[math.floor(s)], at[math.ceil(s)], s) for s in spots]
    return result


def _between(low: float, high: float, spot: float) -> float:
    if low == high:
        return low
    share = spot - math.floor(spot)
    return (1 - share) * low + share * high


def ordered_keys(
    frame: DataFrame,
    columns: Sequence[str],
    positions: Sequence[int],
    task_rows: int = TASK_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[int, tuple]:
    """The rows at the given 0-based positions when ordered by ``columns`` (numbers, no nulls).

    Works one column at a time: find the leading value at a position, then look for the rest
    among the rows tied on it. ``frame`` is read several times, so pass a stored table.
    """
    positions = sorted(set(positions))
    if not positions:
        return {}
    total = frame.count()
    if total <= task_rows:
        return _gathered(frame, columns, positions)
    # The sketch compares doubles, which cannot tell long neighbours apart: a long is looked up
    # as its upper and its lower 32 bits.
    kinds = dict(frame.dtypes)
    parts: dict[str, list[Column]] = {
        c: [F.shiftright(c, 32), F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))]
        if kinds[c] == "bigint"
        else [F.col(c)]
        for c in columns
    }
    split = frame.select(*[p.alias(f"{c}_{i}") for c in columns for i, p in enumerate(parts[c])])
    found = _tied_search(split, split.columns, positions, total, task_rows, accuracy)
    out = {}
    for position, values in found.items():
        rest = iter(values)
        out[position] = tuple(
            (next(rest) << 32) + next(rest) if len(parts[c]) == 2 else next(rest) for c in columns
        )
    return out


def ordered_values(
    frame: DataFrame,
    columns: Sequence[str],
    positions: Sequence[int],
    task_rows: int = TASK_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, dict[int, float]]:
    """The values at the given 0-based positions of each of several double columns (no nulls), each ordered by itself.

    All columns share each pass: one for the sketches, one that counts the values between and at the brackets' ends,
    and one that gathers those between the two ends around a position. ``frame`` is read several times, so pass a
    stored table.
    """
    positions = sorted(set(positions))
    if not positions:
        return {c: {} for c in columns}
    total = frame.count()
    if total <= task_rows:
        found = {c: _gathered(frame, [c], positions) for c in columns}
        return {c: {p: v for p, (v,) in at.items()} for c, at in found.items()}
    slack = 2.0 / accuracy
    shares = [p / (total - 1) for p in positions]
    asked = [min(1.0, max(0.0, s + d)) for s in shares for d in (-slack, slack)]
    ends = frame.agg(
        *[F.percentile_approx(c, asked, accuracy).alias(f"at{i}") for i, c in enumerate(columns)],
        *[F.min(c).alias(f"least{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"most{i}") for i, c in enumerate(columns)],
    ).first()
    edges = [
        np.unique(np.array([*ends[f"at{i}"], ends[f"least{i}"], ends[f"most{i}"]], dtype=float))
        for i in range(len(columns))
    ]

    def places(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The values of a column, and 2 * k + 1 for one at the k-th end, 2 * k for one below it and above the last."""
        values = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
        sides = (np.searchsorted(edges[i], values, side) for side in ("left", "right"))
        return values, sum(sides)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(2 * len(e) + 1, dtype=np.int64) for e in edges]
        for batch in batches:
            for i, found in enumerate(sums):
                found += np.bincount(places(batch, i)[1], minlength=len(found))
        for i, found in enumerate(sums):
            arrays = [np.full(len(found), i), np.arange(len(found)), found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()) for a in arrays], ["number", "place", "rows"]
            )

    values = frame.select(*columns)
    sizes = [np.zeros(2 * len(e) + 1, dtype=np.int64) for e in edges]
    sums = values.mapInArrow(counted, "number long, place long, rows long")
    for row in sums.groupBy("number", "place").agg(F.sum("rows").alias("rows")).collect():
        sizes[row.number][row.place] = row.rows
    out: dict[str, dict[int, float]] = {c: {} for c in columns}
    inner: dict[tuple[int, int], dict[int, int]] = {}
    for i, c in enumerate(columns):
        upto = np.cumsum(sizes[i])
        for p in positions:
            place = int(np.searchsorted(upto, p, side="right"))
            if place % 2:
                out[c][p] = float(edges[i][place // 2])
            else:
                inner.setdefault((i, place), {})[p] = p - int(upto[place] - sizes[i][place])
    for i, place in [at for at in inner if sizes[at[0]][at[1]] > task_rows]:
        # Too many for one task: brackets of their own.
        spots, low, high = inner.pop((i, place)), edges[i][place // 2 - 1], edges[i][place // 2]
        c, value = columns[i], F.col(columns[i])
        rest = values.select(c).filter((value > F.lit(float(low))) & (value < F.lit(float(high))))
        found = _narrowed(rest, c, int(sizes[i][place]), sorted(spots.values()), task_rows, accuracy)
        out[c] |= {p: found[spot] for p, spot in spots.items()}
    if not inner:
        return out
    wanted = [np.array([p for j, p in inner if j == i], dtype=np.int64) for i in range(len(columns))]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, mine in enumerate(wanted):
                if len(mine):
                    found, place = places(batch, i)
                    kept = np.flatnonzero(np.isin(place, mine))
                    arrays = [np.full(len(kept), i), place[kept], found[kept]]
                    kinds = [pa.int64(), pa.int64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, k) for a, k in zip(arrays, kinds)], ["number", "place", "value"]
                    )

    def picked(group: pa.Table) -> pa.Table:
        at = group["number"][0].as_py(), group["place"][0].as_py()
        ordered = np.sort(group["value"].to_numpy())
        spots = inner[at]
        arrays = [np.full(len(spots), at[0]), list(spots), ordered[list(spots.values())]]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(a, k) for a, k in zip(arrays, kinds)], names=["number", "position", "value"])

    between = values.mapInArrow(inside, "number long, place long, value double").groupBy("number", "place")
    for row in between.applyInArrow(picked, "number long, position long, value double").collect():
        out[columns[row.number]][row.position] = row.value
    return out


def _gathered(frame: DataFrame, columns: Sequence[str], positions: Sequence[int]) -> dict:
    """Rows at the positions of a frame small enough for one task."""
    row = (
        frame.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("ordered"))
        .select(*[F.col("ordered")[p].alias(f"p{p}") for p in positions])
        .first()
    )
    return {p: tuple(row[f"p{p}"]) for p in positions}


def _tied_search(frame, columns, positions, total, task_rows, accuracy) -> dict[int, tuple]:
    if total <= task_rows:
        return _gathered(frame, columns, positions)
    head, tail = columns[0], columns[1:]
    heads = _narrowed(frame.select(head), head, total, positions, task_rows, accuracy)
    if not tail:
        return {p: (v,) for p, v in heads.items()}
    found: dict[int, tuple] = {}
    for value in set(heads.values()):
        around = frame.agg(
            F.count_if(F.col(head) < F.lit(value)).alias("below"),
            F.count_if(F.col(head) == F.lit(value)).alias("tied"),
        ).first()
        mine = {p - around.below: p for p, v in heads.items() if v == value}
        tied = frame.filter(F.col(head) == F.lit(value)).select(*tail)
        rest = _tied_search(tied, tail, sorted(mine), around.tied, task_rows, accuracy)
        for p, values in rest.items():
            found[mine[p]] = (value, *values)
    return found


def _narrowed(frame, column, total, positions, task_rows, accuracy) -> dict:
    """Values at sorted positions of one column, by bracketing."""
    if total <= task_rows:
        return {p: v for p, (v,) in _gathered(frame, [column], positions).items()}
    value = F.col(column)
    slack = 2.0 / accuracy
    shares = [p / (total - 1) for p in positions]
    lows = [max(0.0, s - slack) for s in shares]
    highs = [min(1.0, s + slack) for s in shares]
    ends = frame.agg(
        F.percentile_approx(column, lows, accuracy).alias("lows"),
        F.percentile_approx(column, highs, accuracy).alias("highs"),
        F.min(column).alias("least"),
        F.max(column).alias("most"),
    ).first()
    brackets = [
        (ends.least if lo_share == 0 else lo, ends.most if hi_share == 1 else hi)
        for lo, hi, lo_share, hi_share in zip(ends.lows, ends.highs, lows, highs)
    ]
    counts = frame.agg(
        *[
            aggregate
            for i, (lo, hi) in enumerate(brackets)
            for aggregate in (
                F.count_if(value < F.lit(lo)).alias(f"below{i}"),
                F.count_if(value == F.lit(lo)).alias(f"low{i}"),
                F.count_if((value > F.lit(lo)) & (value < F.lit(hi))).alias(f"inside{i}"),
                # An empty bracket (both ends tied) is counted once, at its low end.
                F.count_if((value == F.lit(hi)) & F.lit(lo != hi)).alias(f"high{i}"),
            )
        ]
    ).first()
    found = {}
    inner = {}
    for i, (p, (lo, hi)) in enumerate(zip(positions, brackets)):
        offset = p - counts[f"below{i}"]
        inside = counts[f"inside{i}"]
        if offset < 0 or offset >= counts[f"low{i}"] + inside + counts[f"high{i}"]:
            # The sketch missed the position: look at everything on the side it fell to.
            side = value < F.lit(lo) if offset < 0 else value > F.lit(hi)
            rest = frame.filter(side)
            size = rest.count()
            spot = p if offset < 0 else p - (total - size)
            found[p] = _narrowed(rest, column, size, [spot], task_rows, accuracy)[spot]
        elif offset < counts[f"low{i}"]:
            found[p] = lo
        elif offset >= counts[f"low{i}"] + inside:
            found[p] = hi
        else:
            spot = offset - counts[f"low{i}"]
            if inside <= task_rows:
                inner[p] = (lo, hi, spot)
                continue
            rest = frame.filter((value > F.lit(lo)) & (value < F.lit(hi)))
            found[p] = _narrowed(rest, column, inside, [spot], task_rows, accuracy)[spot]
    return found | _inside(frame, column, inner)


def _inside(frame: DataFrame, column: str, wanted: dict[int, tuple]) -> dict:
    """The values at (low, high, place between them), all in one pass; a task holds one bracket's rows."""
    if not wanted:
        return {}
    value = F.col(column)
    within = [F.when((value > F.lit(lo)) & (value < F.lit(hi)), F.lit(p)) for p, (lo, hi, _) in wanted.items()]
    places = F.create_map(*[F.lit(x) for p, (_, _, spot) in wanted.items() for x in (p, spot)])
    rows = (
        frame.select(value, F.explode(F.array_compact(F.array(*within))).alias("_at"))
        .groupBy("_at")
        .agg(F.array_sort(F.collect_list(column)).alias("_ordered"))
        .select("_at", F.get("_ordered", F.element_at(places, F.col("_at")).cast("int")).alias("_value"))
        .collect()
    )
    return {r["_at"]: r["_value"] for r in rows}


def cut_at(value: Column, edges: Sequence[float]) -> Column:
    """1 for the lowest bin, one more per edge strictly below the value; null stays null."""
    code = F.lit(1)
    for edge in edges:
        code = code + F.when(value > F.lit(edge), 1).otherwise(0)
    return F.when(value.isNotNull(), code)


def label_of(code: Column, names: Sequence[str]) -> Column:
    """The name of a 1-based bin code; null stays null."""
    case = F.lit(None).cast("string")
    for rank, name in enumerate(names, start=1):
        case = F.when(code == rank, name).otherwise(case)
    return case


def inner_edges(
    frame: DataFrame, cuts: dict[str, Sequence[float]], on_ties: str = "raise"
) -> dict[str, list[float]]:
    """Inner bin edges of the quantile cuts of several columns, ends left out.

    Tied edges leave fewer bins than labels. ``on_ties="raise"`` refuses that; ``"merge"`` keeps
    the labels of the bins that remain (a value on tied edges takes the lowest).
    """
    if on_ties not in ("raise", "merge"):
        raise ValueError(f"on_ties must be 'raise' or 'merge', not {on_ties!r}")
    found = exact_quantiles(frame, {c: [0.0, *shares, 1.0] for c, shares in cuts.items()})
    edges = {}
    for column, quantiles in found.items():
        if quantiles[0] is None:
            edges[column] = []
            continue
        if on_ties == "raise" and len(set(quantiles)) < len(quantiles):
            raise ValueError(f"bin edges of {column} are not unique: {quantiles}")
        edges[column] = quantiles[1:-1]
    return edges
