"""Global positions and running totals without a single-partition window.

``Window.orderBy`` without ``partitionBy`` sends every row to one task. Here the rows are
range-partitioned and sorted, stored once (so both later reads see the same partitions, also after
an executor is lost), and each partition is shifted by the totals of those before it. That offset
table has one row per partition.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.sources.stages import store

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row in partition below


def _ranged(frame: DataFrame, keys: Sequence[Column], partitions: int | None) -> DataFrame:
    spread = (
        frame.repartitionByRange(partitions, *keys)
        if partitions
        else frame.repartitionByRange(*keys)
    )
    placed = spread.sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    return store(placed, "ranged").withColumn("_part", F.shiftright("_place", _ROW_BITS))


def _shifted(ranged: DataFrame, totals: Sequence[Column], names: Sequence[str]) -> DataFrame:
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(*[t.alias(n) for t, n in zip(totals, names)])
        .select("_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in names])
    )
    # One row per range partition: bounded by the partition count, not by the data.
    return ranged.join(F.broadcast(offsets), "_part")


def global_row_number(
    frame: DataFrame, keys: Sequence[Column], name: str, partitions: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row in the total order given by ``keys``."""
    ranged = _ranged(frame, keys, partitions)
    row_in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        _shifted(ranged, [F.count(F.lit(1))], ["_before"])
        .withColumn(name, F.col("_before") + row_in_part + 1)
        .drop("_part", "_place", "_before")
    )


def running_totals(
    frame: DataFrame,
    keys: Sequence[Column],
    totals: dict[str, str],
    partitions: int | None = None,
) -> DataFrame:
    """Add inclusive running sums over the total order ``keys``: ``{new column: summed column}``."""
    ranged = _ranged(frame, keys, partitions)
    names = [f"_before_{n}" for n in totals]
    shifted = _shifted(ranged, [F.sum(c) for c in totals.values()], names)
    upto = (
        Window.partitionBy("_part")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    for (name, column), before in zip(totals.items(), names):
        shifted = shifted.withColumn(name, F.sum(column).over(upto) + F.col(before))
    return shifted.drop("_part", "_place", *names)
