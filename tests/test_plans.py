"""The physical plans hold at scale: what is pushed down, what never meets in one task."""

import re

from pyspark.sql import functions as F
from shoplens.operators import churn_features as cf
from shoplens.operators import cleaning, decisions, exploration, rfm
from shoplens.operators import lifetime_value as lv
from shoplens.sources.retail_view import retail_raw


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def lines_of(frame):
    return [re.sub(r"^[\s:+\-*()\d]*", "", line) for line in plan_of(frame).splitlines()]


def test_cutoff_reaches_the_scan(clean):
    frame = cf.observation_window(clean, cf.churn_cutoff(clean)).select("CustomerID")
    scans = [x for x in lines_of(frame) if x.startswith("FileScan")]
    assert any("LessThanOrEqual(InvoiceDate" in x for x in scans)
    assert all("Description" not in x for x in scans)


def test_scans_read_only_what_is_needed(clean):
    scan = next(x for x in lines_of(rfm.customer_base(clean)) if x.startswith("FileScan"))
    schema = re.search(r"ReadSchema: struct<(.*)>", plan_of(rfm.customer_base(clean))).group(1)
    assert scan and set(re.findall(r"(\w+):", schema)) == {
        "InvoiceNo", "InvoiceDate", "CustomerID", "TotalPrice",
    }
    country = plan_of(exploration.country_revenue(clean))
    assert "struct<Country:string,TotalPrice:decimal(25,4)>" in country


def test_cleaning_filters_reach_the_scan_of_a_raw_table(spark, folder, tmp_path):
    path = str(tmp_path / "raw")
    retail_raw(spark, folder).write.parquet(path)
    plan = plan_of(cleaning.clean_transactions(spark.read.parquet(path)))
    for pushed in ("IsNotNull(CustomerID)",):
        assert pushed in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the dedup, nothing else


def test_customer_aggregates_fold_before_they_move(clean):
    for frame in (
        rfm.customer_base(clean),
        cf.customer_features(clean, F.lit("2001-01-01").cast("timestamp_ntz")),
        exploration.purchase_frequency(clean),
        lv.actual_spend(clean),
    ):
        lines = lines_of(frame)
        for i, line in enumerate(lines):
            if line.startswith("Exchange hashpartitioning"):
                assert lines[i + 1].startswith("HashAggregate"), line


def test_scoring_is_a_projection(clean):
    scored = rfm.rfm_segments(rfm.rfm_table(clean))
    main = plan_of(scored).split("Subquery")[0]
    assert "Exchange" not in main and "Window" not in main


def test_recommendation_needs_no_join(spark):
    frame = spark.createDataFrame([("High Value", "High Risk")], ["CLV_Tier", "ChurnRiskTier"])
    assert "Join" not in plan_of(decisions.recommend(frame))


def test_dashboards_derive_the_live_features_once(spark, folder, monkeypatch):
    from shoplens.plans import registry

    calls, live_of = [], registry.live_of
    monkeypatch.setattr(registry, "live_of", lambda *args: calls.append(args) or live_of(*args))
    assert registry.dashboard_tables(spark, folder).count() == 6
    assert len(calls) == 1


def test_no_task_holds_more_lines_when_there_are_more(spark, folder, monkeypatch):
    from shoplens.plans import registry
    from shoplens.sources import stages

    whole = registry.clean_of(spark, folder)
    expected, rows = sorted(map(str, whole.collect())), 100
    monkeypatch.setattr(stages, "TASK_LINES", rows)
    frame = registry.clean_of(spark, folder)
    assert sorted(map(str, frame.collect())) == expected
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert max(sizes) < 2 * rows
    # The join with the orders and the dedup: all lines meet in as many partitions as there are lines for.
    parts = stages.parts_for(spark.read.parquet(f"{folder}/lineitem.parquet"))
    assert parts > len(expected) // rows
    plan = plan_of(frame).split("== Initial Plan ==")[0]
    assert plan.count(f", {parts}), REPARTITION_BY_NUM") == 3
