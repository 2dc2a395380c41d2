"""Every registered query: its physical plan, and its rows against SQL on the same tables."""

import re

import __spark_entry__ as entry
import pytest
from shoplens.plans import registry
from sql_check import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()

# These read the joined source tables; the others start from the cleaned table, stored once.
FROM_SOURCE = {"read_raw", "read_clean", "clean_transactions", "country_revenue", "rfm_segment"}

# The lifetime formulas are the only ones that need Python on the executors.
PYTHON_ALLOWED = {"expected_purchases", "clv_12m", "unstable_clv_count"}


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def lines_of(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"^[\s:+\-*()\d]*", "", line) for line in plan.splitlines()]


def check_plan(name, frame):
    lines = lines_of(frame)
    text = "\n".join(lines)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON_ALLOWED:
        assert "Python" not in text and "Pandas" not in text
    for i, line in enumerate(lines):
        if not line.startswith(("Window ", "Sort ")):
            continue
        below = next((x for x in lines[i + 1 :] if "Exchange" in x or "Scan" in x), "")
        if "SinglePartition" in below:
            # One task may only see a row per range partition, a row per month, or a top-k.
            assert re.search(r"_part#|Month(End)?#|_urgent#", line), line


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, clean, duck, monkeypatch, name):
    if name not in FROM_SOURCE:
        monkeypatch.setattr(registry, "clean_of", lambda *_: clean)
        monkeypatch.setattr(registry, "stored_clean", lambda *_: clean)
    frame = QUERIES[name](spark, folder)
    check_plan(name, frame)
    assert compare(frame, duck, SQL[name]) is None


def test_entry(spark):
    segments = entry.entry(spark)
    assert segments.groupBy("Segment").count().count() == 9
