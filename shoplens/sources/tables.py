"""Readers and writers for the transaction and customer tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from shoplens.functions.expressions import exact_number
from shoplens.sources import csv_blocks
from shoplens.sources.schemas import CLEAN, RAW

#: Seconds with or without a fraction; a fraction is always written.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

#: Columns of a CSV file that other programs write as decimals of their own (``17850.0``).
LOOSE = ("CustomerID", "UnitPrice")
WIDE = DecimalType(38, 12)


def _csv(
    spark: SparkSession, path: str, schema: StructType, date_format: str, multi_line: bool
) -> DataFrame:
    # Quotes inside a description are doubled, as pandas and spreadsheets write them.
    options = {"escape": '"', "mode": "FAILFAST", "timestampNTZFormat": date_format}
    if multi_line:
        files = csv_blocks.files_of(spark, path)
        if csv_blocks.can_be_cut(files):
            return csv_blocks.read_csv(spark, files, schema, options)
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", multi_line).options(**options).csv(path)
    )


def _fitting(name: str, kind: DataType) -> Column:
    """The column in its declared type; a value that would change ends the read."""
    value = exact_number(F.col(name), kind)
    text = F.format_string(f"{name} %s does not fit {kind.simpleString()}", F.col(name).cast("string"))
    return F.when(F.col(name).isNotNull() & value.isNull(), F.raise_error(text).cast(kind)).otherwise(
        value
    )


def _lines(
    spark: SparkSession, path: str, schema: StructType, fmt: str, date_format: str, multi_line: bool
) -> DataFrame:
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    loose = [StructField(f.name, WIDE if f.name in LOOSE else f.dataType) for f in schema.fields]
    return _csv(spark, path, StructType(loose), date_format, multi_line).select(
        *[
            _fitting(f.name, f.dataType).alias(f.name) if f.name in LOOSE else F.col(f.name)
            for f in schema.fields
        ]
    )


def read_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    date_format: str = TIMESTAMP_FORMAT,
    multi_line: bool = True,
) -> DataFrame:
    """Raw invoice lines with the declared schema.

    CSV: a customer may be written ``17850.0``; ``date_format`` is that of the file. A description
    may hold line ends: large files are cut at true record starts (``csv_blocks``). ``multi_line=False`` is for
    files without any, which Spark's own reader can cut.
    """
    return _lines(spark, path, RAW, fmt, date_format, multi_line)


def read_clean(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    date_format: str = TIMESTAMP_FORMAT,
    multi_line: bool = True,
) -> DataFrame:
    """Cleaned invoice lines, ``TotalPrice`` included."""
    return _lines(spark, path, CLEAN, fmt, date_format, multi_line)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A customer-grain table an earlier stage wrote as Parquet."""
    return spark.read.parquet(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that ``write_csv`` wrote."""
    return _csv(spark, path, schema, TIMESTAMP_FORMAT, True)


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header; the group key of a profile table is an ordinary column."""
    (
        frame.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_stage(frame: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Parquet hand-off; the cleaned table may be partitioned (for example by invoice month)."""
    writer = frame.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
