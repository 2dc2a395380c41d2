"""Exploratory aggregates: revenue by country, month and invoice, spreads and histograms."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.expressions import number, share_percent
from shoplens.functions.order_stats import exact_quantiles


def country_revenue(clean: DataFrame) -> DataFrame:
    return (
        clean.filter(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(F.sum("TotalPrice").alias("Revenue"))
        .orderBy(F.desc("Revenue"), "Country")
    )


def top_countries(clean: DataFrame, count: int = 10) -> DataFrame:
    return country_revenue(clean).limit(count)


def home_country_share(clean: DataFrame, home_country: str) -> DataFrame:
    """Revenue share of one country in percent; 0 when it has no sales."""
    home = F.coalesce(
        F.sum(F.when(F.col("Country") == home_country, F.col("TotalPrice"))), F.lit(0)
    )
    return clean.agg(share_percent(home, F.sum("TotalPrice")).alias("HomeSharePct"))


def invoice_value(clean: DataFrame) -> DataFrame:
    return (
        clean.filter(F.col("InvoiceNo").isNotNull())
        .groupBy("InvoiceNo")
        .agg(F.sum("TotalPrice").alias("InvoiceValue"))
    )


def purchase_frequency(clean: DataFrame) -> DataFrame:
    """Distinct invoices per customer; (customer, invoice) pairs collapse before they move."""
    return clean.groupBy("CustomerID").agg(F.countDistinct("InvoiceNo").alias("Invoices"))


def monthly_revenue(clean: DataFrame) -> DataFrame:
    """Revenue per calendar month, months without sales included as 0.

    Each month is spread up to the next month with sales, so the transactions are read once and
    the empty months need no join. The window sees one row per calendar month.
    """
    month = F.trunc(F.to_date("InvoiceDate"), "month").alias("Month")
    by_month = clean.groupBy(month).agg(F.sum("TotalPrice").alias("Sales"))
    following = F.lead("Month").over(Window.orderBy("Month"))
    spread = by_month.withColumn(
        "Last", F.coalesce(F.add_months(following, -1), F.col("Month"))
    ).select(
        "Sales",
        F.posexplode(
            F.sequence("Month", "Last", F.make_ym_interval(F.lit(0), F.lit(1)))
        ).alias("Gap", "Month"),
    )
    return spread.select(
        F.last_day("Month").alias("MonthEnd"),
        F.when(F.col("Gap") == 0, F.col("Sales")).otherwise(0).alias("Revenue"),
    ).orderBy("MonthEnd")


def eda_key_stats(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean and median invoice value and purchases per customer, from stored tables."""
    median_value = exact_quantiles(invoices, {"InvoiceValue": [0.5]})["InvoiceValue"][0]
    median_orders = exact_quantiles(customers, {"Invoices": [0.5]})["Invoices"][0]
    mean_orders = customers.agg(F.avg("Invoices")).scalar()
    return invoices.agg(F.avg(F.col("InvoiceValue").cast("double")).alias("MeanInvoiceValue")).select(
        "MeanInvoiceValue",
        F.lit(median_value).cast("double").alias("MedianInvoiceValue"),
        mean_orders.alias("MeanPurchases"),
        F.lit(median_orders).cast("double").alias("MedianPurchases"),
    )


def trim_below_quantile(frame: DataFrame, column: str, share: float = 0.95) -> DataFrame:
    """Rows whose value lies strictly below the quantile; the bound is a literal filter."""
    bound = exact_quantiles(frame, {column: [share]})[column][0]
    return frame.filter(number(F.col(column)) < F.lit(bound).cast("double"))


def histogram(frame: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the range of the column; the last bin includes its upper end."""
    value = number(F.col(column))
    ends = frame.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    schema = "Bin int, BinStart double, BinEnd double, Rows bigint"
    if ends.low is None:
        return frame.sparkSession.createDataFrame([], schema)
    low, high = ends.low, ends.high
    if low == high:  # a single value gets a unit-wide range around it
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    spot = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(bins))
    counted = (
        frame.filter(value.isNotNull())
        .groupBy(F.least(spot, F.lit(bins - 1)).cast("int").alias("Bin"))
        .agg(F.count(F.lit(1)).alias("Rows"))
    )
    spine = frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("Bin"))
    return spine.join(counted, "Bin", "left").select(
        "Bin",
        (F.lit(low) + F.col("Bin") * F.lit(width)).alias("BinStart"),
        (F.lit(low) + (F.col("Bin") + 1) * F.lit(width)).alias("BinEnd"),
        F.coalesce("Rows", F.lit(0)).alias("Rows"),
    )


def describe_table(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    quartiles = exact_quantiles(frame, {c: [0.25, 0.5, 0.75] for c in columns})
    stats = frame.agg(
        *[
            F.struct(
                F.lit(c).alias("Column"),
                F.count(number(F.col(c))).alias("Count"),
                F.avg(number(F.col(c))).alias("Mean"),
                F.stddev_samp(number(F.col(c))).alias("Std"),
                F.min(number(F.col(c))).alias("Min"),
                *[
                    F.lit(q).cast("double").alias(label)
                    for q, label in zip(quartiles[c], ("P25", "P50", "P75"))
                ],
                F.max(number(F.col(c))).alias("Max"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(c) for c in columns])))


def value_counts(frame: DataFrame, column: str, count_name: str = "Customers") -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.desc(count_name), column)
    )


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    return frame.select(column).distinct()


def percent_of_total(grouped: DataFrame, column: str, name: str) -> DataFrame:
    """Share of the grand total in percent; the total is a one-row subquery."""
    total = grouped.agg(F.sum(column)).scalar()
    return grouped.withColumn(name, share_percent(F.col(column), total))


def best_row(frame: DataFrame, metric: str, position: Column) -> DataFrame:
    """The first row with the highest metric."""
    return frame.orderBy(F.desc_nulls_last(metric), position).limit(1)
