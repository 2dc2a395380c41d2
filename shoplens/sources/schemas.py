"""Declared table schemas: nothing is inferred at read time."""

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("UnitPrice", T.DecimalType(14, 4)),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

CLEAN = T.StructType(RAW.fields + [T.StructField("TotalPrice", T.DecimalType(25, 4))])
