"""Run the whole batch: ``python -m shoplens --input raw.parquet --output folder``."""

import argparse

from pyspark.sql import SparkSession

from shoplens.operators import churn_features, churn_models, clustering
from shoplens.plans import batch
from shoplens.sources.tables import TIMESTAMP_FORMAT, read_raw


def main() -> None:
    options = argparse.ArgumentParser(prog="shoplens")
    options.add_argument("--input", required=True, help="raw invoice lines")
    options.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    options.add_argument("--output", required=True, help="folder for the result tables")
    options.add_argument("--trees", type=int, default=churn_models.FOREST_TREES)
    options.add_argument("--rounds", type=int, default=churn_models.BOOST_ROUNDS)
    options.add_argument("--restarts", type=int, default=clustering.RESTARTS)
    options.add_argument("--on-ties", default="raise", choices=["raise", "merge"])
    options.add_argument("--clusters", type=int, default=clustering.CLUSTERS)
    options.add_argument("--holdout-days", type=int, default=churn_features.HOLDOUT_DAYS)
    options.add_argument("--home-country", default=batch.HOME_COUNTRY)
    options.add_argument("--date-format", default=TIMESTAMP_FORMAT, help="of a CSV input")
    options.add_argument("--csv", action="store_true", help="also write the tables as CSV")
    chosen = options.parse_args()
    spark = SparkSession.builder.appName("shoplens").getOrCreate()
    paths = batch.run(
        spark,
        read_raw(spark, chosen.input, chosen.format, chosen.date_format),
        chosen.output,
        chosen.trees,
        chosen.rounds,
        chosen.restarts,
        chosen.on_ties,
        chosen.csv,
        chosen.clusters,
        chosen.holdout_days,
        chosen.home_country,
    )
    for name, path in paths.items():
        print(name, path)


if __name__ == "__main__":
    main()
