"""Risk tiers, the value-by-risk recommendation table and its summaries."""

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.expressions import clip_upper, half_even, number
from shoplens.functions.order_stats import cut_at, exact_quantiles, inner_edges, label_of
from shoplens.operators.lifetime_value import TIERS

# Risk tiers in ascending order and the quantiles between them.
RISKS = ("Low Risk", "Medium Risk", "High Risk")
RISK_CUTS = (1 / 3, 2 / 3)

# Value tier, risk tier, recommendation, priority, action.
MATRIX = (
    ("High Value", "High Risk", "URGENT: VIP Win-back", 1,
     "Personal outreach + exclusive offer; highest priority, do not lose"),
    ("High Value", "Medium Risk", "Proactive Loyalty", 2,
     "Early access, loyalty rewards, relationship check-in"),
    ("High Value", "Low Risk", "Nurture & Upsell", 3,
     "Cross-sell premium items, referral incentives"),
    ("Mid Value", "High Risk", "Automated Win-back", 4,
     "Targeted email campaign with moderate discount"),
    ("Mid Value", "Medium Risk", "Engagement Campaign", 5,
     "Personalized product recommendations"),
    ("Mid Value", "Low Risk", "Standard Loyalty", 6,
     "Newsletter, seasonal offers"),
    ("Low Value", "High Risk", "Low-cost Automation Only", 7,
     "Generic re-engagement email; retention spend not justified by CLV"),
    ("Low Value", "Medium Risk", "Monitor", 8,
     "No proactive action; track for tier changes"),
    ("Low Value", "Low Risk", "Minimal Spend", 9,
     "Standard mass marketing only"),
)
# The outcome without a tier, and the recommendations that reports single out.
UNKNOWN = ("Unknown", 99, "Review customer manually")
URGENT = "URGENT: VIP Win-back"
LOW_PRIORITY = ("Low-cost Automation Only", "Minimal Spend")


def churn_risk_tiers(scored: DataFrame, on_ties: str = "raise") -> DataFrame:
    """Add the risk tier, tertiles of the churn probability. Pass a stored table."""
    edges = inner_edges(scored, {"ChurnProbability": RISK_CUTS}, on_ties)
    code = cut_at(number(F.col("ChurnProbability")), edges["ChurnProbability"])
    return scored.withColumn("ChurnRiskTier", label_of(code, RISKS))


def join_segment(scored: DataFrame, clustered: DataFrame) -> DataFrame:
    """Both sides hold one row per customer, so no key can be hot."""
    return scored.join(clustered.select("CustomerID", "Segment", "Cluster"), "CustomerID", "left")


def join_clv(scored: DataFrame, valued: DataFrame) -> DataFrame:
    return scored.join(valued.select("CustomerID", "CLV_12m", "CLV_Tier"), "CustomerID", "left")


def merge_missing_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count_if(F.col("Segment").isNull()).alias("MissingSegment"),
        F.count_if(F.col("CLV_12m").isNull()).alias("MissingCLV"),
    )


def recommendation() -> Column:
    """Struct of recommendation, priority and action, looked up in the constant matrix."""

    def outcome(name: str, priority: int, action: str) -> Column:
        return F.struct(
            F.lit(name).alias("Recommendation"),
            F.lit(priority).alias("Priority"),
            F.lit(action).alias("Action"),
        )

    matrix = F.create_map(
        *chain.from_iterable(
            (F.lit(f"{tier}|{risk}"), outcome(name, priority, action))
            for tier, risk, name, priority, action in MATRIX
        )
    )
    cell = F.concat_ws("|", F.col("CLV_Tier"), F.col("ChurnRiskTier"))
    return F.coalesce(F.try_element_at(matrix, cell), outcome(*UNKNOWN))


def recommend(merged: DataFrame) -> DataFrame:
    """Three new columns; a missing tier is for manual review."""
    return (
        merged.withColumn("_outcome", recommendation()).select("*", "_outcome.*").drop("_outcome")
    )


def sort_recommendations(business: DataFrame) -> DataFrame:
    """Priority first, then value, missing values last."""
    return business.orderBy(
        F.asc_nulls_last("Priority"), F.desc_nulls_last("CLV_12m"), "CustomerID"
    )


def business_table(
    scored: DataFrame, clustered: DataFrame, valued: DataFrame, on_ties: str = "raise"
) -> DataFrame:
    """Live churn scores with segment, value, risk tier and recommendation, unsorted.

    ``scored`` is read again for the tertiles; pass a stored table.
    """
    tiered = churn_risk_tiers(
        scored.select("CustomerID", "ChurnProbability", "Recency", "Frequency", "Monetary"),
        on_ties,
    )
    return recommend(join_clv(join_segment(tiered, clustered), valued))


def tier_risk_crosstab(business: DataFrame) -> DataFrame:
    """Customers per value tier and risk tier; rows with a missing tier are left out."""
    tier_rank = F.array_position(F.array(*map(F.lit, TIERS)), F.col("CLV_Tier"))
    return (
        business.filter(F.col("CLV_Tier").isNotNull() & F.col("ChurnRiskTier").isNotNull())
        .groupBy("CLV_Tier")
        .pivot("ChurnRiskTier", list(RISKS))
        .count()
        .fillna(0)
        .orderBy(tier_rank)
    )


def recommendation_summary(business: DataFrame) -> DataFrame:
    return (
        business.groupBy("Priority", "Recommendation")
        .agg(
            F.count("CustomerID").alias("Customers"),
            half_even(F.coalesce(F.sum("CLV_12m"), F.lit(0.0)), 2).alias("TotalCLV"),
            half_even(F.avg("ChurnProbability"), 2).alias("AvgChurnProb"),
        )
        .orderBy("Priority", "Recommendation")
    )


def urgent_customers(business: DataFrame) -> DataFrame:
    return business.filter(F.col("Recommendation") == URGENT)


def low_priority_customers(business: DataFrame) -> DataFrame:
    return business.filter(F.col("Recommendation").isin(*LOW_PRIORITY))


def low_priority_share(business: DataFrame) -> DataFrame:
    low = F.col("Recommendation").isin(*LOW_PRIORITY)
    return business.agg(
        F.count_if(low).alias("LowPriority"), F.avg(low.cast("int")).alias("LowPriorityShare")
    )


def revenue_at_risk(business: DataFrame) -> DataFrame:
    """Urgent customers and their predicted value; 0 when there are none."""
    urgent = F.col("Recommendation") == URGENT
    return business.agg(
        F.count_if(urgent).alias("UrgentCustomers"),
        F.coalesce(F.sum(F.when(urgent, F.col("CLV_12m"))), F.lit(0.0)).alias("RevenueAtRisk"),
    )


def cap_at_quantile(frame: DataFrame, column: str, share: float, name: str) -> DataFrame:
    """Add ``name``: the column capped at its quantile."""
    bound = exact_quantiles(frame, {column: [share]})[column][0]
    return frame.withColumn(name, clip_upper(number(F.col(column)), bound))


def priority_map(business: DataFrame, share: float = 0.97) -> DataFrame:
    """Churn probability against capped value, with the columns shown on hover."""
    return cap_at_quantile(business, "CLV_12m", share, "CLV_capped").select(
        "CustomerID",
        "ChurnProbability",
        "CLV_capped",
        "Segment",
        "CLV_12m",
        "Recommendation",
        "Recency",
        "Frequency",
        "Monetary",
    )


def top_urgent(business: DataFrame, count: int = 20) -> DataFrame:
    """The most valuable urgent customers, or of all customers when none is urgent.

    Urgent rows sort first, so the top rows start with them when there are any; rows of the
    other kind are then dropped. One top-k job; the window sees at most ``count`` rows.
    """
    top = (
        business.withColumn("_urgent", (F.col("Recommendation") == URGENT).cast("int"))
        .orderBy(F.desc("_urgent"), F.desc_nulls_last("CLV_12m"), "CustomerID")
        .limit(count)
        .withColumn("_kind", F.max("_urgent").over(Window.partitionBy()))
    )
    return top.filter(F.col("_urgent") == F.col("_kind")).select(
        "CustomerID",
        "Segment",
        half_even(F.col("ChurnProbability"), 2).alias("ChurnProb"),
        half_even(F.col("CLV_12m"), 0).alias("CLV_12m"),
        "Recency",
    )
