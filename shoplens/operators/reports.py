"""Tables behind the charts and the dashboard."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators import decisions, exploration, lifetime_value, rfm
from shoplens.sources.stages import store

INVOICE_BINS, ORDER_BINS, CLV_BINS = 50, 40, 50


def eda_inputs(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Invoice values and purchases per customer, stored."""
    return (
        store(exploration.invoice_value(clean), "invoice-value"),
        store(exploration.purchase_frequency(clean), "purchase-frequency"),
    )


def eda_charts(
    clean: DataFrame, inputs: tuple[DataFrame, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Monthly revenue, top countries, and the two trimmed histograms."""
    invoices, orders = inputs or eda_inputs(clean)
    return {
        "monthly_revenue": exploration.monthly_revenue(clean),
        "top_countries": exploration.top_countries(clean, 10),
        "invoice_histogram": exploration.histogram(
            exploration.trim_below_quantile(invoices, "InvoiceValue"), "InvoiceValue", INVOICE_BINS
        ),
        "order_histogram": exploration.histogram(
            exploration.trim_below_quantile(orders, "Invoices"), "Invoices", ORDER_BINS
        ),
    }


def clv_charts(valued: DataFrame) -> dict[str, DataFrame]:
    """Trimmed histogram of the value and its total per tier."""
    return {
        "clv_histogram": exploration.histogram(
            exploration.trim_below_quantile(valued, "CLV_12m"), "CLV_12m", CLV_BINS
        ),
        "clv_by_tier": lifetime_value.clv_tier_summary(valued),
    }


def kpi_row(business: DataFrame) -> DataFrame:
    """The five headline numbers from one aggregate."""
    urgent = F.col("Recommendation") == decisions.URGENT
    low = F.col("Recommendation").isin(*decisions.LOW_PRIORITY)
    return business.agg(
        F.count(F.lit(1)).alias("TotalCustomers"),
        F.coalesce(F.sum("CLV_12m"), F.lit(0.0)).alias("TotalCLV"),
        F.avg("ChurnProbability").alias("AvgChurn"),
        F.coalesce(F.sum(F.when(urgent, F.col("CLV_12m"))), F.lit(0.0)).alias("RevenueAtRisk"),
        F.avg(low.cast("int")).alias("LowPriorityShare"),
    )


def clv_pie(business: DataFrame) -> DataFrame:
    return (
        business.filter(F.col("CLV_Tier").isNotNull())
        .groupBy("CLV_Tier")
        .agg(F.count("CustomerID").alias("Customers"), F.sum("CLV_12m").alias("TotalCLV"))
        .orderBy("CLV_Tier")
    )


def risk_bar(business: DataFrame) -> DataFrame:
    """Customers per risk tier, in tier order."""
    rank = F.array_position(F.array(*map(F.lit, decisions.RISKS)), F.col("ChurnRiskTier"))
    return exploration.value_counts(business, "ChurnRiskTier").orderBy(rank)


def dashboard_tables(business: DataFrame, segments: DataFrame) -> dict[str, DataFrame]:
    """Everything the dashboard shows. ``business`` should be a stored table."""
    return {
        "kpis": kpi_row(business),
        "segment_bar": rfm.segment_revenue(segments, ascending=True),
        "clv_pie": clv_pie(business),
        "risk_bar": risk_bar(business),
        "priority_map": decisions.priority_map(business),
        "top_urgent": decisions.top_urgent(business),
    }


#: What names a row of each dashboard table; the kpis are one row.
ROW_KEYS = {
    "segment_bar": "Segment", "clv_pie": "CLV_Tier", "risk_bar": "ChurnRiskTier",
    "priority_map": "CustomerID", "top_urgent": "CustomerID",
}
#: The tables that are shown in an order; they have a handful of rows.
ORDERED = ("segment_bar", "risk_bar", "top_urgent")


def long_form(name: str, table: DataFrame) -> DataFrame:
    """Table, Row, Position, Column, Number, Text: one row per cell, the position where rows have an order."""
    key = F.col(ROW_KEYS[name]).cast("string") if name in ROW_KEYS else F.lit("all")
    position = F.lit(None).cast("int")
    if name in ORDERED:
        # Counted as the rows come, so that a table that lost its order shows it.
        table = table.coalesce(1)
        position = (F.monotonically_increasing_id() + 1).cast("int")
    cells = []
    for field in table.schema.fields:
        text = isinstance(field.dataType, T.StringType)
        column = F.col(f"`{field.name}`")
        cells.append(F.struct(
            F.lit(field.name).alias("Column"),
            (F.lit(None) if text else column).cast("double").alias("Number"),
            (column if text else F.lit(None)).cast("string").alias("Text"),
        ))
    return table.select(
        F.lit(name).alias("Table"), key.alias("Row"), position.alias("Position"), F.array(*cells).alias("cells")
    ).select("Table", "Row", "Position", F.inline("cells"))


def contents(tables: dict[str, DataFrame]) -> DataFrame:
    """All cells of the given dashboard tables."""
    return reduce(DataFrame.unionByName, (long_form(name, table) for name, table in tables.items()))
