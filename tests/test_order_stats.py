import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shoplens.functions.order_stats import cut_at, exact_quantiles, inner_edges, ordered_keys
from shoplens.functions.ranking import global_row_number, running_totals

TINY = {"task_rows": 20, "accuracy": 50}  # forces the narrowing path on small tables
SHARES = [0.0, 0.2, 1 / 3, 0.5, 0.8, 0.97, 1.0]


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def shapes():
    rng = np.random.default_rng(5)
    return {
        "uniform": rng.random(3000),
        "heavy tail": np.exp(rng.normal(0, 6, 3000)),
        "one third tied": np.concatenate([np.full(1000, 7.0), rng.integers(0, 20, 2000)]),
        "two values": np.repeat([1.0, 2.0], 1500),
        "constant": np.full(500, 3.0),
        "cluster far away": np.concatenate([rng.random(2990), 1e15 + rng.random(10)]),
    }


@pytest.mark.parametrize("shape", list(shapes()))
def test_narrowed_quantiles_equal_numpy(spark, shape):
    values = shapes()[shape]
    frame = column(spark, values).repartition(5).cache()
    got = exact_quantiles(frame, {"x": SHARES}, **TINY)["x"]
    assert got == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-12)
    frame.unpersist()


def test_interpolation_and_nulls(spark):
    frame = column(spark, [9, None, 1, float("nan"), 4, 2])
    assert exact_quantiles(frame, {"x": [0.2, 0.5]})["x"] == pytest.approx([1.6, 3.0])
    assert exact_quantiles(column(spark, [None]), {"x": [0.5]})["x"] == [None]


def test_several_columns_of_different_length(spark):
    frame = spark.createDataFrame(
        [(float(i), float(i) if i < 10 else None) for i in range(100)], "a double, b double"
    )
    got = exact_quantiles(frame, {"a": [0.5], "b": [0.5]}, **TINY)
    assert got == {"a": [49.5], "b": [4.5]}


def test_ordered_keys_break_ties_by_the_next_column(spark):
    rng = np.random.default_rng(1)
    rows = [(int(f), int(k)) for f, k in zip(rng.integers(1, 4, 900), rng.permutation(900))]
    frame = spark.createDataFrame(rows, "f long, k long").repartition(4).cache()
    positions = [0, 1, 299, 450, 450, 899]
    got = ordered_keys(frame, ["f", "k"], positions, **TINY)
    ordered = sorted(rows)
    assert got == {p: ordered[p] for p in positions}
    frame.unpersist()


def test_keys_wider_than_a_double_are_still_exact(spark):
    rng = np.random.default_rng(8)
    keys = [int(k) for k in rng.integers(2**59, 2**60, 1500)]
    keys += [2**60 + i for i in range(500)]  # neighbours a double cannot tell apart
    frame = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3).cache()
    positions = [0, 700, 1499, 1500, 1750, 1999]
    ordered = sorted(keys)
    got = ordered_keys(frame, ["k"], positions, **TINY)
    assert got == {p: (ordered[p],) for p in positions}
    frame.unpersist()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=5, max_size=60))
def test_cut_equals_qcut(spark, values):
    try:
        expected = pd.qcut(pd.Series(values, dtype=float), 5, labels=False) + 1
    except ValueError:
        with pytest.raises(ValueError, match="not unique"):
            inner_edges(column(spark, values), {"x": [0.2, 0.4, 0.6, 0.8]})
        return
    frame = column(spark, values)
    edges = inner_edges(frame, {"x": [0.2, 0.4, 0.6, 0.8]})["x"]
    got = [r[0] for r in frame.select(cut_at(F.col("x"), edges)).collect()]
    assert got == list(expected)


def test_tied_edges_merge_on_request(spark):
    frame = column(spark, [1, 1, 1, 1, 2, 3])
    with pytest.raises(ValueError, match="not unique"):
        inner_edges(frame, {"x": [1 / 3, 2 / 3]})
    edges = inner_edges(frame, {"x": [1 / 3, 2 / 3]}, on_ties="merge")["x"]
    assert [r[0] for r in frame.select(cut_at(F.col("x"), edges)).collect()] == [1, 1, 1, 1, 3, 3]


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_global_row_number(spark, partitions):
    rng = np.random.default_rng(2)
    rows = [(int(f), int(k)) for f, k in zip(rng.integers(0, 3, 2000), rng.permutation(2000))]
    frame = spark.createDataFrame(rows, "f long, k long")
    ranked = global_row_number(frame, [F.col("f"), F.col("k")], "r", partitions)
    got = {(r.f, r.k): r.r for r in ranked.collect()}
    assert got == {row: i for i, row in enumerate(sorted(rows), start=1)}


@pytest.mark.parametrize("partitions", [1, 6])
def test_running_totals(spark, partitions):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"k": rng.permutation(500), "v": rng.integers(0, 9, 500)})
    out = running_totals(
        spark.createDataFrame(frame), [F.desc("k")], {"upto": "v"}, partitions
    ).toPandas()
    expected = frame.sort_values("k", ascending=False)
    expected["upto"] = expected["v"].cumsum()
    assert dict(zip(out.k, out.upto)) == dict(zip(expected.k, expected.upto))


def test_ranking_of_nothing(spark):
    frame = spark.createDataFrame([], "k long")
    assert global_row_number(frame, [F.col("k")], "r").count() == 0


def test_all_brackets_are_opened_in_one_pass(spark):
    from shoplens.functions.order_stats import ordered_keys

    rng = np.random.default_rng(4)
    data = np.round(rng.normal(size=6000), 3)
    frame = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(3).persist()
    places = list(range(90, 6000, 95))
    spark.sparkContext.setJobGroup("brackets", "brackets")
    found = ordered_keys(frame, ["v"], places, task_rows=600, accuracy=300)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("brackets")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    ordered = np.sort(data)
    assert {p: v for p, (v,) in found.items()} == {p: ordered[p] for p in places}
    assert len(jobs) < 20  # a job or two for each of the 63 places before
