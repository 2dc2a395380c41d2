"""Recency, frequency and monetary value per customer, quintile scores and named segments."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.expressions import days, log10_or_null, number, share_percent, whole_days
from shoplens.functions.order_stats import cut_at, inner_edges, ordered_keys
from shoplens.functions.ranking import global_row_number
from shoplens.sources.stages import store

QUINTILES = (0.2, 0.4, 0.6, 0.8)


def customer_base(clean: DataFrame) -> DataFrame:
    """Last purchase, distinct invoices and spend per customer.

    The distinct count is planned as partial sums per (customer, invoice), so a customer with a
    third of all lines is spread over its invoices before the final merge.
    """
    return clean.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("LastPurchase"),
        F.countDistinct("InvoiceNo").alias("Frequency"),
        F.sum("TotalPrice").alias("Monetary"),
    )


def reference_date(frame: DataFrame, column: str = "InvoiceDate") -> DataFrame:
    """One row: the day after the last purchase."""
    return frame.agg((F.max(column) + days(1)).alias("ReferenceDate"))


def rfm_table(clean: DataFrame) -> DataFrame:
    """Recency (whole days to the reference date), frequency and monetary value per customer.

    The customer table is stored: the transactions are read once, and the reference date, the
    quantiles and the scores all come from the small table.
    """
    base = store(customer_base(clean), "customer-base")
    last = reference_date(base, "LastPurchase").scalar()
    return base.select(
        "CustomerID",
        whole_days(last, F.col("LastPurchase")).alias("Recency"),
        "Frequency",
        "Monetary",
    )


def quintile_edges(rfm: DataFrame, on_ties: str = "raise") -> dict[str, list[float]]:
    """Score edges of recency and monetary value, both from one pass."""
    return inner_edges(rfm, {"Recency": QUINTILES, "Monetary": QUINTILES}, on_ties)


def recency_score(edges: dict[str, list[float]]) -> Column:
    """5 for the most recent fifth, 1 for the least recent."""
    return 6 - cut_at(number(F.col("Recency")), edges["Recency"])


def monetary_score(edges: dict[str, list[float]]) -> Column:
    return cut_at(number(F.col("Monetary")), edges["Monetary"])


def frequency_score(rfm: DataFrame) -> Column:
    """Quintile of the first-come rank of the frequency, ties in CustomerID order.

    A rank r of n falls above the j-th edge when r > 1 + j(n-1)/5, so only the four customers at
    those ranks are looked up; no global rank is needed to score.
    """
    ranked = rfm.filter(F.col("Frequency").isNotNull())
    count = ranked.count()
    fifths = range(1, 5)
    at_edge = ordered_keys(
        ranked, ["Frequency", "CustomerID"], [j * (count - 1) // 5 for j in fifths if count]
    )
    code = F.lit(1)
    frequency, customer = F.col("Frequency"), F.col("CustomerID")
    for j in fifths:
        if not count:
            break
        value, key = at_edge[j * (count - 1) // 5]
        above = (frequency > F.lit(value)) | ((frequency == F.lit(value)) & (customer > F.lit(key)))
        code = code + F.when(above, 1).otherwise(0)
    return F.when(frequency.isNotNull(), code)


def first_rank(rfm: DataFrame, partitions: int | None = None) -> DataFrame:
    """The first-come rank itself, for every customer."""
    return global_row_number(
        rfm.select("CustomerID", "Frequency"),
        [F.col("Frequency"), F.col("CustomerID")],
        "FrequencyRank",
        partitions,
    )


def score_rfm(rfm: DataFrame, on_ties: str = "raise") -> DataFrame:
    """Add the three scores, their digits as text and their sum: a projection, no shuffle."""
    edges = quintile_edges(rfm, on_ties)
    return (
        rfm.withColumns(
            {
                "R_Score": recency_score(edges),
                "F_Score": frequency_score(rfm),
                "M_Score": monetary_score(edges),
            }
        )
        .withColumn("RFM_Score", score_text())
        .withColumn("RFM_Sum", score_sum())
    )


def score_text() -> Column:
    return F.concat(*[F.col(c).cast("string") for c in ("R_Score", "F_Score", "M_Score")])


def score_sum() -> Column:
    return F.col("R_Score") + F.col("F_Score") + F.col("M_Score")


# Segment names and their score ranges (R, F, M), the first match wins.
SEGMENT_RULES = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Promising", (3, 5), (1, 2), (1, 2)),
    ("Can't Lose Them", (1, 2), (4, 5), (4, 5)),
    ("At Risk", (1, 2), (3, 5), (3, 5)),
    ("Lost", (1, 2), (1, 2), (1, 2)),
    ("Need Attention", (3, 3), (3, 3), (1, 5)),
)
OTHER_SEGMENT = "Others"


def segment() -> Column:
    """The named segment of a scored row, as one CASE expression."""
    case = F.lit(OTHER_SEGMENT)
    for name, *ranges in reversed(SEGMENT_RULES):
        match = F.lit(True)
        for column, (low, high) in zip(("R_Score", "F_Score", "M_Score"), ranges):
            match = match & F.col(column).between(low, high)
        case = F.when(match, name).otherwise(case)
    return case


def rfm_segments(rfm: DataFrame, on_ties: str = "raise") -> DataFrame:
    return score_rfm(rfm, on_ties).withColumn("Segment", segment())


def segment_summary(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("Segment")
        .agg(
            F.count("CustomerID").alias("Customers"),
            F.avg("Recency").alias("AvgRecency"),
            F.avg("Frequency").alias("AvgFrequency"),
            F.avg(F.col("Monetary").cast("double")).alias("AvgMonetary"),
            F.sum("Monetary").alias("TotalRevenue"),
        )
        .orderBy(F.desc("TotalRevenue"), "Segment")
    )


def segment_revenue(segments: DataFrame, ascending: bool = False) -> DataFrame:
    revenue = F.col("Revenue")
    return (
        segments.filter(F.col("Segment").isNotNull())
        .groupBy("Segment")
        .agg(F.count("CustomerID").alias("Customers"), F.sum("Monetary").alias("Revenue"))
        .orderBy(revenue.asc() if ascending else revenue.desc(), "Segment")
    )


def treemap_shares(segments: DataFrame) -> DataFrame:
    """Per segment: revenue, its share of the area and the tile label."""
    grouped = segment_revenue(segments)
    total = segments.filter(F.col("Segment").isNotNull()).agg(F.sum("Monetary")).scalar()
    return grouped.withColumn("SharePct", share_percent(F.col("Revenue"), total)).withColumn(
        "Label", segment_label()
    )


def segment_label() -> Column:
    """Three lines: the segment, its customers, its revenue in millions."""
    return F.format_string(
        "%s\n%d Customers\n£%.2fM",
        F.col("Segment"),
        F.col("Customers"),
        F.col("Revenue").cast("double") / 1e6,
    )


def rfm_scatter(segments: DataFrame) -> DataFrame:
    """Every customer with log-axis coordinates."""
    return segments.select(
        "CustomerID",
        "Segment",
        "Frequency",
        "Monetary",
        log10_or_null(F.col("Frequency")).alias("LogFrequency"),
        log10_or_null(F.col("Monetary")).alias("LogMonetary"),
    )
