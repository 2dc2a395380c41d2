"""Observation and holdout windows, customer features, churn labels, split and weights."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.expressions import days, whole_days
from shoplens.functions.order_stats import ordered_keys
from shoplens.sources.stages import TASK_LINES, store

HOLDOUT_DAYS = 90

# The feature columns, in model order.
FEATURES = (
    "Recency",
    "Frequency",
    "Monetary",
    "UniqueProducts",
    "AvgQuantity",
    "Tenure",
    "AvgOrderValue",
    "AvgDaysBetweenPurchases",
)


def churn_cutoff(clean: DataFrame, holdout_days: int = HOLDOUT_DAYS) -> Column:
    """Last purchase minus the holdout, as a scalar subquery (pushed down as a scan filter)."""
    return clean.agg(F.max("InvoiceDate") - days(holdout_days)).scalar()


def observation_window(clean: DataFrame, cutoff: Column) -> DataFrame:
    return clean.filter(F.col("InvoiceDate") <= cutoff)


def holdout_window(clean: DataFrame, cutoff: Column) -> DataFrame:
    return clean.filter(F.col("InvoiceDate") > cutoff)


def _with_ratios(grouped: DataFrame, cutoff: Column, *extra: str) -> DataFrame:
    spend = F.col("Monetary").cast("double")
    aged = grouped.select(
        "CustomerID",
        whole_days(cutoff, F.col("LastPurchase")).alias("Recency"),
        "Frequency",
        "Monetary",
        "UniqueProducts",
        "AvgQuantity",
        whole_days(cutoff, F.col("FirstPurchase")).alias("Tenure"),
        *extra,
    )
    return aged.select(
        *[c for c in aged.columns if c not in extra],
        (spend / F.col("Frequency")).alias("AvgOrderValue"),
        days_between_purchases(F.col("Tenure"), F.col("Frequency")).alias(
            "AvgDaysBetweenPurchases"
        ),
        *extra,
    )


def days_between_purchases(tenure: Column, frequency: Column) -> Column:
    return F.when(frequency > 1, tenure / frequency).otherwise(tenure.cast("double"))


def customer_features(window: DataFrame, cutoff: Column) -> DataFrame:
    """The eight features of every customer in ``window``, as of ``cutoff``."""
    return _with_ratios(_purchase_history(window), cutoff)


def _purchase_history(
    lines: DataFrame, seen: Column | None = None, parts: int | None = None
) -> DataFrame:
    """One row per customer, over the lines that are ``seen``; ``Latest`` looks at all of them.

    Lines fold to one row per invoice and one per product; only these meet as customers, so a hot customer
    is spread over its invoices and products. With ``parts`` lines are first shuffled to that many
    partitions, so that a task holds the groups of one of them, whatever the size of its input files.
    """

    def spread(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.repartition(parts, *keys) if parts else frame

    def when_seen(column: str) -> Column:
        return F.col(column) if seen is None else F.when(seen, F.col(column))

    spent = lines.select(F.sum("TotalPrice").alias("Monetary")).schema["Monetary"].dataType
    known = F.count(when_seen("InvoiceNo")) > 0
    bought = lines.select("CustomerID", "InvoiceNo", "InvoiceDate", "TotalPrice", "Quantity")
    invoices = (
        spread(bought, "CustomerID", "InvoiceNo")
        .groupBy("CustomerID", "InvoiceNo")
        .agg(
            F.max(when_seen("InvoiceDate")).alias("LastPurchase"),
            F.min(when_seen("InvoiceDate")).alias("FirstPurchase"),
            known.cast("int").alias("Frequency"),
            F.sum(when_seen("TotalPrice")).alias("Monetary"),
            F.sum(when_seen("Quantity")).alias("Items"),
            F.count(when_seen("Quantity")).alias("Lines"),
            F.max("InvoiceDate").alias("Latest"),
            F.lit(0).alias("UniqueProducts"),
        )
    )
    codes = lines.select("CustomerID", when_seen("StockCode").alias("StockCode")).filter("StockCode IS NOT NULL")
    products = (
        spread(codes, "CustomerID", "StockCode").distinct()
        .select("CustomerID", F.lit(1).alias("UniqueProducts"))
    )
    return (
        invoices.unionByName(products, allowMissingColumns=True)
        .groupBy("CustomerID")
        .agg(
            F.max("LastPurchase").alias("LastPurchase"),
            F.min("FirstPurchase").alias("FirstPurchase"),
            F.sum("Frequency").alias("Frequency"),
            F.sum("Monetary").cast(spent).alias("Monetary"),
            F.sum("UniqueProducts").alias("UniqueProducts"),
            (F.sum("Items").cast("double") / F.nullif(F.sum("Lines"), F.lit(0))).alias("AvgQuantity"),
            F.max("Latest").alias("Latest"),
        )
    )


def live_features(clean: DataFrame) -> DataFrame:
    """Features of every customer over the full history, as of the day after the last purchase.

    The grouped table is stored and holds that date, so the transactions are read once.
    """
    history = store(_purchase_history(clean), "purchase-history")
    today = history.agg(F.max("LastPurchase") + days(1)).scalar()
    return _with_ratios(history, today)


def churn_dataset(clean: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Features from the observation window, label from the holdout, by the same foldings.

    A customer churned when the latest purchase overall is not after the cutoff, so the label
    needs no join with the holdout customers. ``clean`` is read several times; pass a stored table.
    """
    cutoff = churn_cutoff(clean) if cutoff is None else cutoff
    parts = math.ceil(max(clean.count(), 1) / TASK_LINES)
    grouped = (
        _purchase_history(clean, F.col("InvoiceDate") <= cutoff, parts)
        .filter(F.col("LastPurchase").isNotNull())
        .withColumn("Churned", (F.col("Latest") <= cutoff).cast("int"))
    )
    return _with_ratios(grouped, cutoff, "Churned")


def churn_label(window: DataFrame, holdout: DataFrame) -> DataFrame:
    """1 for customers of the first window without a purchase in the second (anti-membership)."""
    returned = holdout.select("CustomerID").distinct().withColumn("Returned", F.lit(True))
    return (
        window.select("CustomerID")
        .distinct()
        .join(returned, "CustomerID", "left")
        .select("CustomerID", F.col("Returned").isNull().cast("int").alias("Churned"))
    )


def window_customer_counts(clean: DataFrame, cutoff: Column) -> DataFrame:
    """Distinct customers on each side of the cutoff, from one pass over the customers."""
    per_customer = clean.groupBy("CustomerID").agg(
        F.min("InvoiceDate").alias("First"), F.max("InvoiceDate").alias("Last")
    )
    return per_customer.agg(
        F.count_if(F.col("First") <= cutoff).alias("ObservationCustomers"),
        F.count_if(F.col("Last") > cutoff).alias("HoldoutCustomers"),
    )


def churn_rate(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.avg("Churned").alias("ChurnRate"))


def class_counts(labelled: DataFrame, label: str = "Churned") -> dict[int, int]:
    """Rows per class; the driver gets one small row per class."""
    row = labelled.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ).first()
    return {0: row.negatives, 1: row.positives}


def class_weights(labelled: DataFrame, label: str = "Churned") -> DataFrame:
    """Balanced weights n / (classes * class rows), one row per class."""
    grouped = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("Rows"))
    totals = grouped.agg(
        F.struct(F.sum("Rows").alias("rows"), F.count(F.lit(1)).alias("classes"))
    ).scalar()
    return grouped.withColumn(
        "Weight",
        totals.getField("rows").cast("double") / (totals.getField("classes") * F.col("Rows")),
    )


def scale_pos_weight(labelled: DataFrame, label: str = "Churned") -> DataFrame:
    """Negatives per positive."""
    positives = F.count_if(F.col(label) == 1)
    return labelled.agg(
        (F.count_if(F.col(label) == 0) / F.nullif(positives, F.lit(0))).alias("ScalePosWeight")
    )


def split_hash(key: Column, seed: int = 42) -> Column:
    """60 bits of an md5 digest: the same draw on every engine, run and partitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _test_sizes(counts: dict[int, int], test_share: float) -> dict[int, int]:
    """Whole test rows per class: floors, then the largest remainders."""
    rows = sum(counts.values())
    if not rows:
        return dict.fromkeys(counts, 0)
    wanted = math.ceil(test_share * rows)
    sizes = {c: n * wanted // rows for c, n in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * wanted % rows), c))
    for c in by_remainder[: wanted - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


def stratified_split(
    labelled: DataFrame, test_share: float = 0.25, seed: int = 42, label: str = "Churned"
) -> DataFrame:
    """Add ``IsTest``: an exact share of each class, the lowest hashes of it.

    Only the border row of each class is looked up, so no class is gathered or sorted in one
    task. ``labelled`` is read several times; pass a stored table.
    """
    drawn = labelled.withColumn("_draw", split_hash(F.col("CustomerID"), seed))
    sizes = _test_sizes(class_counts(labelled, label), test_share)
    in_test = F.lit(False)
    for value, size in sizes.items():
        if size == 0:
            continue
        mine = drawn.filter(F.col(label) == value).select("_draw", "CustomerID")
        draw, key = ordered_keys(mine, ["_draw", "CustomerID"], [size - 1])[size - 1]
        low = (F.col("_draw") < draw) | ((F.col("_draw") == draw) & (F.col("CustomerID") <= key))
        in_test = in_test | ((F.col(label) == value) & low)
    return drawn.withColumn("IsTest", in_test.cast("int")).drop("_draw")
