import pytest
from pyspark.sql import functions as F
from shoplens.operators import decisions, reports

SCHEMA = (
    "CustomerID long, ChurnProbability double, Recency int, Frequency long, Monetary double, "
    "Segment string, CLV_12m double, CLV_Tier string, ChurnRiskTier string"
)


def merged(spark, *rows):
    """Rows of (id, probability, value, value tier, risk tier)."""
    return spark.createDataFrame(
        [(i, p, 1, 1, 1.0, "Lost", v, tier, risk) for i, p, v, tier, risk in rows], SCHEMA
    )


def test_every_cell_and_missing_tiers(spark):
    tiers = ["High Value", "Mid Value", "Low Value", None]
    risks = ["High Risk", "Medium Risk", "Low Risk", None]
    cells = [(t, r) for t in tiers for r in risks]
    frame = merged(spark, *[(i, 0.5, 1.0, t, r) for i, (t, r) in enumerate(cells)])
    got = {(r.CLV_Tier, r.ChurnRiskTier): r for r in decisions.recommend(frame).collect()}
    assert len(got) == 16
    for (tier, risk), row in got.items():
        if tier is None or risk is None:
            assert (row.Recommendation, row.Priority) == ("Unknown", 99)
            assert row.Action == "Review customer manually"
        else:
            assert row.Priority == 1 + 3 * tiers.index(tier) + risks.index(risk)
    assert got["High Value", "High Risk"].Recommendation == "URGENT: VIP Win-back"
    assert got["Low Value", "Low Risk"].Recommendation == "Minimal Spend"


def test_top_urgent_falls_back_to_all(spark):
    calm = merged(spark, *[(i, 0.5, float(i), "Mid Value", "Low Risk") for i in range(30)])
    top = decisions.top_urgent(decisions.recommend(calm)).collect()
    assert len(top) == 20 and [r.CustomerID for r in top] == list(range(29, 9, -1))
    some = merged(
        spark,
        *[(i, 0.5, 100.0 + i, "Mid Value", "Low Risk") for i in range(30)],
        (50, 0.129, 7.5, "High Value", "High Risk"),
        (51, 0.9, None, "High Value", "High Risk"),
    )
    top = decisions.top_urgent(decisions.recommend(some)).collect()
    assert [(r.CustomerID, r.ChurnProb, r.CLV_12m) for r in top] == [(50, 0.13, 8.0), (51, 0.9, None)]


def test_sort_puts_missing_values_last(spark):
    frame = decisions.recommend(
        merged(
            spark,
            (1, 0.5, None, "High Value", "High Risk"),
            (2, 0.5, 5.0, "High Value", "High Risk"),
            (3, 0.5, 9.0, "High Value", "High Risk"),
            (4, 0.5, 99.0, None, None),
        )
    )
    assert [r.CustomerID for r in decisions.sort_recommendations(frame).collect()] == [3, 2, 1, 4]


def test_crosstab_leaves_missing_out_and_fills_zero(spark):
    frame = merged(
        spark,
        (1, 0.5, 1.0, "Low Value", "Low Risk"),
        (2, 0.5, 1.0, None, "Low Risk"),
        (3, 0.5, 1.0, "High Value", None),
        (4, 0.5, 1.0, "High Value", "High Risk"),
    )
    rows = [tuple(r) for r in decisions.tier_risk_crosstab(frame).collect()]
    assert rows == [("Low Value", 1, 0, 0), ("High Value", 0, 0, 1)]


def test_no_urgent_customer_means_no_revenue_at_risk(spark):
    frame = decisions.recommend(merged(spark, (1, 0.5, 5.0, "Low Value", "Low Risk")))
    assert tuple(decisions.revenue_at_risk(frame).first()) == (0, 0.0)
    kpis = reports.kpi_row(frame).first()
    assert kpis.RevenueAtRisk == 0 and kpis.LowPriorityShare == 1


def test_tied_probabilities(spark):
    frame = spark.createDataFrame(
        [(i, p) for i, p in enumerate([1.0, 1.0, 1.0, 1.0, 2.0, 3.0])],
        "CustomerID long, ChurnProbability double",
    )
    with pytest.raises(ValueError, match="not unique"):
        decisions.churn_risk_tiers(frame)
    got = decisions.churn_risk_tiers(frame, "merge").orderBy("CustomerID").collect()
    assert [r.ChurnRiskTier for r in got] == ["Low Risk"] * 4 + ["High Risk"] * 2


def test_missing_probability_has_no_tier(spark):
    frame = spark.createDataFrame(
        [(1, 0.1), (2, 0.2), (3, 0.3), (4, float("nan")), (5, None)],
        "CustomerID long, ChurnProbability double",
    )
    got = {r.CustomerID: r.ChurnRiskTier for r in decisions.churn_risk_tiers(frame).collect()}
    assert got == {1: "Low Risk", 2: "Medium Risk", 3: "High Risk", 4: None, 5: None}


def test_cap_keeps_missing(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "v double")
    got = decisions.cap_at_quantile(frame, "v", 0.97, "c").agg(F.max("c"), F.count("c")).first()
    assert tuple(got) == (97.0, 101)
