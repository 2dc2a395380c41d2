"""Cleaning of raw invoice lines, and the audit of what each rule removed."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from shoplens.functions.expressions import exact_number, total_price
from shoplens.sources.schemas import RAW

# Invoice prefixes of cancellations and adjustments, service stock codes.
VOID_PREFIXES = ("C", "A")
NON_PRODUCT_CODES = ("POST", "D", "M", "BANK CHARGES", "PADS", "DOT", "CRUK")

# The names of the audit steps, in order.
STEPS = (
    "missing customer",
    "cancelled or adjusted",
    "non-product code",
    "non-positive quantity or price",
    "duplicate row",
)


def has_customer() -> Column:
    return F.col("CustomerID").isNotNull()


def is_sale() -> Column:
    """Prefixes are matched with case, so ``c123`` is a sale."""
    invoice = F.col("InvoiceNo")
    return reduce(and_, [~invoice.startswith(p) for p in VOID_PREFIXES])


def is_product() -> Column:
    """Codes are matched without case; the stored code keeps its own."""
    return ~F.upper("StockCode").isin(*NON_PRODUCT_CODES)


def is_positive() -> Column:
    return (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)


# A missing invoice number or stock code is neither void nor a service code, so its row stays;
# a missing quantity or price is not positive, so its row goes.
def _rules() -> list[Column]:
    yes, no = F.lit(True), F.lit(False)
    return [
        has_customer(),
        F.coalesce(is_sale(), yes),
        F.coalesce(is_product(), yes),
        F.coalesce(is_positive(), no),
    ]


def drop_missing_customer(frame: DataFrame) -> DataFrame:
    return frame.filter(_rules()[0])


def drop_cancellations(frame: DataFrame) -> DataFrame:
    return frame.filter(_rules()[1])


def drop_non_product(frame: DataFrame) -> DataFrame:
    return frame.filter(_rules()[2])


def drop_nonpositive(frame: DataFrame) -> DataFrame:
    return frame.filter(_rules()[3])


def dedup_rows(frame: DataFrame, parts: int | None = None) -> DataFrame:
    """Full-row dedup; nulls compare equal. Copies collapse before the shuffle; with ``parts`` rows are first
    shuffled to that many partitions, so that a task holds the rows of one of them, whatever it reads."""
    dealt = frame.repartition(parts, *frame.columns) if parts else frame
    return dealt.dropDuplicates()


def _typed(field: StructField, date_format: str | None) -> Column:
    text = F.col(field.name)
    if field.name in ("CustomerID", "UnitPrice"):
        return exact_number(text, field.dataType)
    if field.name == "InvoiceDate" and date_format:
        # Read as UTC and counted from the epoch, so that no session time zone moves the clock.
        at = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(f"{date_format} X"))
        seconds = (F.unix_micros(at).cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
        since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        return F.lit("1970-01-01").cast("timestamp_ntz") + since
    return text.try_cast(field.dataType)


def cast_types(frame: DataFrame, date_format: str | None = None) -> DataFrame:
    """Raw columns in their declared types.

    A customer may be written ``17850.0``. A value that does not parse, or that its type would
    round, becomes null; ``cast_losses`` counts them.
    """
    return frame.select(*[_typed(f, date_format).alias(f.name) for f in RAW.fields])


def cast_losses(frame: DataFrame, date_format: str | None = None) -> DataFrame:
    """Per column, the values that ``cast_types`` turns into null, from one aggregate."""
    lost = frame.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & _typed(f, date_format).isNull()).alias(f.name)
            for f in RAW.fields
        ]
    )
    rows = [F.struct(F.lit(c).alias("Column"), F.col(c).alias("Lost")) for c in lost.columns]
    return lost.select(F.inline(F.array(*rows)))


def add_total_price(frame: DataFrame) -> DataFrame:
    return frame.withColumn("TotalPrice", total_price(F.col("Quantity"), F.col("UnitPrice")))


def clean_transactions(raw: DataFrame, parts: int | None = None) -> DataFrame:
    """All cleaning rules: four filters in one scan, one dedup shuffle (to ``parts``), then the line total."""
    kept = raw
    for step in (drop_missing_customer, drop_cancellations, drop_non_product, drop_nonpositive):
        kept = kept.transform(step)
    return kept.transform(dedup_rows, parts).transform(add_total_price)


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """Rows before, removed and after each step, in one scan and one shuffle.

    Each row is labelled with the first rule it breaks. Broken rows lose their other values, so
    they fold into one group per rule before the shuffle; only clean rows travel whole.
    """
    broken = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(_rules(), start=1))):
        broken = F.when(~rule, number).otherwise(broken)
    labelled = raw.withColumn("Broken", broken)
    kept = F.col("Broken").isNull()
    grouped = (
        labelled.select("Broken", *[F.when(kept, F.col(c)).alias(c) for c in raw.columns])
        .groupBy("Broken", *raw.columns)
        .agg(F.count(F.lit(1)).alias("Copies"))
    )
    by_rule = grouped.agg(
        F.coalesce(F.sum("Copies"), F.lit(0)).alias("All"),
        *[
            F.coalesce(F.sum(F.when(F.col("Broken") == n, F.col("Copies"))), F.lit(0)).alias(
                f"Step{n}"
            )
            for n in range(1, len(STEPS))
        ],
        F.coalesce(F.sum(F.when(kept, F.col("Copies") - 1)), F.lit(0)).alias(f"Step{len(STEPS)}"),
    )
    steps = F.array(
        *[
            F.struct(
                F.lit(n).alias("StepNo"),
                F.lit(name).alias("Step"),
                reduce(lambda left, m: left - F.col(f"Step{m}"), range(1, n), F.col("All")).alias(
                    "RowsBefore"
                ),
                F.col(f"Step{n}").alias("RowsRemoved"),
            )
            for n, name in enumerate(STEPS, start=1)
        ]
    )
    return by_rule.select(F.inline(steps)).withColumn(
        "RowsAfter", F.col("RowsBefore") - F.col("RowsRemoved")
    )


def null_profile(frame: DataFrame) -> DataFrame:
    """One row per column: type, rows and nulls, from one aggregate."""
    counted = frame.agg(
        F.count(F.lit(1)).alias("Rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("Column"),
                F.lit(kind).alias("Type"),
                F.col("Rows").alias("Rows"),
                F.col(name).alias("Nulls"),
            )
            for name, kind in frame.dtypes
        ]
    )
    return counted.select(F.inline(rows))


def clean_profile(clean: DataFrame) -> DataFrame:
    """Size, date range, distinct keys and revenue of the cleaned table in one row.

    Lines fold to one row per invoice, customer and country before keys are counted, and products to one
    row each, so no line is copied per column.
    """
    revenue = F.coalesce(F.sum("TotalPrice"), F.lit(0)).alias("TotalRevenue")
    kind = clean.agg(revenue).schema["TotalRevenue"].dataType
    invoices = clean.groupBy("InvoiceNo", "CustomerID", "Country").agg(
        F.count(F.lit(1)).alias("Rows"), F.min("InvoiceDate").alias("First"), F.max("InvoiceDate").alias("Last"),
        F.sum("TotalPrice").alias("TotalPrice"),
    )
    products = clean.select("StockCode").distinct().agg(F.count("StockCode")).scalar()
    return invoices.agg(
        F.coalesce(F.sum("Rows"), F.lit(0)).cast("bigint").alias("Rows"),
        F.min("First").alias("FirstDate"),
        F.max("Last").alias("LastDate"),
        F.countDistinct("CustomerID").alias("Customers"),
        F.countDistinct("InvoiceNo").alias("Invoices"),
        F.countDistinct("Country").alias("Countries"),
        revenue,
    ).select(
        "Rows", "FirstDate", "LastDate", "Customers", "Invoices", products.alias("Products"), "Countries",
        F.col("TotalRevenue").cast(kind).alias("TotalRevenue"),
    )
