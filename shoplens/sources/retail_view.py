"""The star-schema test tables seen as raw retail transactions.

The plain tables hold no nulls, cancellations or repeats, so key arithmetic puts them in; every
cleaning rule then has rows to remove.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sources.stages import parts_for

#: Buyers from here on are single orders; customer keys are smaller.
ONE_TIME_BUYERS = 1_000_000_000_000


def retail_raw(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Each order of every fifth customer has a buyer of its own, so one-time buyers occur and every
    # line stays. Order keys keep these buyers apart from each other and from the customers.
    buyer = F.when(
        F.col("o_custkey") % 5 == 0, F.col("o_orderkey") + ONE_TIME_BUYERS
    ).otherwise(F.col("o_custkey"))
    kept = orders.withColumn("buyer", buyer)

    # The customer and nation joins run at order grain, before the orders meet their lines.
    buyers = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name")
    )
    kept = kept.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # Lines meet their orders in as many partitions as there are lines for; their number comes from the files.
    lineitem = table("lineitem")
    parts = parts_for(lineitem)

    def dealt(frame: DataFrame, key: str) -> DataFrame:
        return frame.repartition(parts, key) if parts else frame

    lines = (
        lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
        )
        .join(
            table("part").select("p_partkey", "p_name", "p_retailprice"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
        .transform(dealt, "l_orderkey")
        .join(dealt(kept, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    )

    order, part, line = F.col("o_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    prefix = (
        F.when((F.col("l_returnflag") == "R") & (order % 7 == 0), "C")
        .when(order % 211 == 0, "A")
        .otherwise("")
    )
    seconds = ((order * 7919) % 86400).cast("int")
    quantity = F.col("l_quantity").cast("int")
    copies = F.when((order + line) % 67 == 0, 2).otherwise(1)
    return (
        lines.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(
            F.concat(prefix, order.cast("string")).alias("InvoiceNo"),
            F.when(part % 97 == 0, "post")
            .when(part % 89 == 0, "D")
            .otherwise(part.cast("string"))
            .alias("StockCode"),
            F.when(part % 43 != 0, F.col("p_name")).alias("Description"),
            F.when((order + line) % 53 == 0, -quantity).otherwise(quantity).alias("Quantity"),
            (
                F.col("o_orderdate")
                + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
            ).alias("InvoiceDate"),
            F.when((part + F.col("l_suppkey")) % 61 == 0, F.lit(0).cast("decimal(14,4)"))
            .otherwise(F.col("p_retailprice").cast("decimal(14,4)"))
            .alias("UnitPrice"),
            F.when(F.col("o_custkey") % 41 != 0, F.col("buyer")).alias("CustomerID"),
            F.col("n_name").alias("Country"),
        )
    )
