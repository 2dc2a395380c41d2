"""The whole batch, step by step: each step writes Parquet the next one reads."""

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import (
    churn_features,
    churn_models,
    cleaning,
    clustering,
    decisions,
    evaluation,
    exploration,
    lifetime_value,
    reports,
    rfm,
)
from shoplens.sources.stages import Run, input_key, parts_for, scratch, store
from shoplens.sources.tables import write_csv

HOME_COUNTRY = "United Kingdom"


def live_scores(
    clean: DataFrame, trees: int = churn_models.FOREST_TREES, training: DataFrame | None = None
) -> DataFrame:
    """P(churn) of every customer today, from a forest validated on the holdout window.

    ``training``: the churn dataset, where it is stored already.
    """
    if training is None:
        training = store(churn_features.churn_dataset(clean), "churn-features")
    model = churn_models.fit_forest(training, trees=trees)
    return churn_models.score(model, churn_features.live_features(clean))


def compare_churn_models(
    labelled: DataFrame,
    trees: int = churn_models.FOREST_TREES,
    rounds: int = churn_models.BOOST_ROUNDS,
) -> tuple[DataFrame, dict[str, DataFrame], object]:
    """Fit the three classifiers on the training part; metrics on the test part.

    Returns the comparison, the scored test rows per model and the boosted model.
    """
    split = store(churn_features.stratified_split(labelled), "churn-split")
    train = split.filter(F.col("IsTest") == 0).drop("IsTest")
    test = split.filter(F.col("IsTest") == 1).drop("IsTest")
    logistic, scaler = churn_models.fit_logistic(train)
    forest = churn_models.fit_forest(train, trees=trees)
    boosted = churn_models.fit_boosted(train, rounds=rounds)
    scored = {
        churn_models.LOGISTIC: churn_models.score(logistic, test, scaler=scaler),
        churn_models.FOREST: churn_models.score(forest, test),
        churn_models.BOOSTED: churn_models.score(boosted, test),
    }
    scored = {name: store(frame, "churn-scored") for name, frame in scored.items()}
    comparison = churn_models.model_comparison(scored, "Churned", "ChurnProbability")
    return comparison, scored, boosted


def cleaning_reports(raw: DataFrame, clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "cleaning_funnel": cleaning.cleaning_funnel(raw),
        "raw_profile": cleaning.null_profile(raw),
        "clean_profile": cleaning.clean_profile(clean),
    }


def exploration_reports(clean: DataFrame, home_country: str) -> dict[str, DataFrame]:
    inputs = reports.eda_inputs(clean)
    charts = reports.eda_charts(clean, inputs)
    return {
        "eda_country_revenue": exploration.country_revenue(clean),
        "eda_home_country_share": exploration.home_country_share(clean, home_country),
        "eda_key_stats": exploration.eda_key_stats(*inputs),
        **{f"eda_{name}": table for name, table in charts.items()},
    }


def segment_reports(segments: DataFrame) -> dict[str, DataFrame]:
    return {
        "rfm_describe": exploration.describe_table(segments, clustering.RFM_COLUMNS),
        "segment_counts": exploration.value_counts(segments, "Segment"),
        "segment_summary": rfm.segment_summary(segments),
        "segment_treemap": rfm.treemap_shares(segments),
        "rfm_scatter": rfm.rfm_scatter(segments),
    }


def cluster_reports(features: DataFrame, clustered: DataFrame, restarts: int) -> dict[str, DataFrame]:
    labels = clustered.select("CustomerID", "Cluster")
    return {
        "cluster_profile": clustering.cluster_profile(clustered),
        "cluster_k_selection": clustering.k_sweep(features, restarts=restarts),
        "cluster_silhouette": clustering.squared_silhouette_row(
            features.join(labels, "CustomerID")
        ),
        "cluster_pca_variance": clustering.Components.fit(features).variance(features),
    }


def churn_reports(
    comparison: DataFrame, scored: dict[str, DataFrame], boosted, labelled: DataFrame
) -> dict[str, DataFrame]:
    """Curves of all models; importances; what the best model gets right on the test part."""
    best = churn_models.best_model(comparison)
    winner = scored[best.first()["Model"]]
    label, probability = "Churned", "ChurnProbability"
    curves = [
        evaluation.roc_curve(frame, label, probability).select(F.lit(name).alias("Model"), "*")
        for name, frame in scored.items()
    ]
    return {
        "churn_rate": churn_features.churn_rate(labelled),
        "churn_best_model": best.drop("Position"),
        "churn_roc_curves": reduce(DataFrame.unionByName, curves),
        "churn_confusion_matrix": evaluation.confusion_matrix(winner, label, probability),
        "churn_classification_report": evaluation.classification_report(winner, label, probability),
        "churn_feature_importance": churn_models.feature_importance(boosted, labelled),
    }


def value_reports(valued: DataFrame, fits: dict[str, DataFrame]) -> dict[str, DataFrame]:
    charts = reports.clv_charts(valued)
    return {
        **{f"clv_{name}": table for name, table in fits.items()},
        "clv_repeat_buyers": lifetime_value.repeat_buyer_counts(valued),
        "clv_tier_summary": charts["clv_by_tier"],
        "clv_histogram": charts["clv_histogram"],
    }


def decision_reports(business: DataFrame) -> dict[str, DataFrame]:
    return {
        "merge_missing_counts": decisions.merge_missing_counts(business),
        "tier_risk_crosstab": decisions.tier_risk_crosstab(business),
        "recommendation_summary": decisions.recommendation_summary(business),
        "low_priority_share": decisions.low_priority_share(business),
        "revenue_at_risk": decisions.revenue_at_risk(business),
    }


def churn_tables(labelled: DataFrame, trees: int, rounds: int) -> dict[str, DataFrame]:
    """The comparison, its reports, and everyone's scores by the boosted model."""
    comparison, tested, boosted = compare_churn_models(labelled, trees, rounds)
    comparison = store(comparison, "churn-comparison")
    return {
        "churn_model_comparison": comparison,
        **churn_reports(comparison, tested, boosted, labelled),
        "churn_predictions": churn_models.score(boosted, labelled, "ChurnProbability_Boosted"),
    }


def value_tables(clean: DataFrame, on_ties: str) -> dict[str, DataFrame]:
    """Everyone's lifetime value and the reports on it."""
    scored, fits = lifetime_value.clv_scores(clean)
    valued = store(lifetime_value.clv_predictions(clean, on_ties, scored), "clv-predictions")
    return {"clv_predictions": valued, **value_reports(valued, fits)}


def run(
    spark: SparkSession,
    raw: DataFrame,
    folder: str,
    trees: int = churn_models.FOREST_TREES,
    rounds: int = churn_models.BOOST_ROUNDS,
    restarts: int = clustering.RESTARTS,
    on_ties: str = "raise",
    csv: bool = False,
    clusters: int = clustering.CLUSTERS,
    holdout_days: int = churn_features.HOLDOUT_DAYS,
    home_country: str = HOME_COUNTRY,
) -> dict[str, str]:
    """Run every stage over ``raw`` and return the written paths by table name.

    Each step writes its tables and the reports on them, in one move each. ``csv`` also writes each table as
    CSV under ``folder``/csv. A run that was killed goes on after its last whole step when it is started again
    with the same files and settings; a finished one leaves nothing but its tables.
    """
    settings = (trees, rounds, restarts, on_ties, csv, clusters, holdout_days, home_country)
    key = input_key(raw, *settings)
    run = Run(spark, folder, key)

    def as_csv(name: str, written: DataFrame) -> None:
        if csv:
            write_csv(written, f"{folder.rstrip('/')}/csv/{name}")

    def step(name: str, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        return run.step(name, make, as_csv)

    def one(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return step(name, lambda: {name: make()})[name]

    with scratch(spark, key):
        clean = one("cleaned", lambda: cleaning.clean_transactions(raw, parts_for(raw)))
        step("cleaning-reports", lambda: cleaning_reports(raw, clean))
        step("exploration", lambda: exploration_reports(clean, home_country))
        segments = one("rfm_table", lambda: rfm.rfm_segments(rfm.rfm_table(clean), on_ties))
        step("segment-reports", lambda: segment_reports(segments))

        features = cache(lambda: clustering.scaled_features(segments))
        clustered = one(
            "rfm_clustered",
            lambda: clustering.cluster_customers(segments, clusters, restarts, features=features()),
        )
        step("cluster-reports", lambda: cluster_reports(features(), clustered, restarts))

        labelled = one(
            "churn_features",
            lambda: churn_features.churn_dataset(clean, churn_features.churn_cutoff(clean, holdout_days)),
        )
        step("churn-models", lambda: churn_tables(labelled, trees, rounds))
        valued = step("lifetime-values", lambda: value_tables(clean, on_ties))["clv_predictions"]

        def recommended() -> DataFrame:
            live = store(live_scores(clean, trees, labelled), "live-scores")
            business = decisions.business_table(live, clustered, valued, on_ties)
            return decisions.sort_recommendations(business)

        business = one("business_recommendations", recommended)
        step("decision-reports", lambda: decision_reports(business))
        step("dashboard", lambda: {
            f"dashboard_{name}": table for name, table in reports.dashboard_tables(business, segments).items()
        })
    run.finish()
    return run.paths
