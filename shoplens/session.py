"""A local session for tests and the benchmark; on a cluster use the session you are given."""

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*") -> SparkSession:
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shoplens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
