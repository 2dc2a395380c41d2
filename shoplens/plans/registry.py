"""The registered queries: every operator over the whole test tables.

Operators that follow a model take their score from a formula here, so that SQL can check them;
the model fits themselves are registered beside them.
"""

from collections.abc import Callable
from dataclasses import astuple
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import expressions as ex
from shoplens.functions.order_stats import exact_quantiles
from shoplens.operators import churn_features as cf
from shoplens.operators import churn_models as cm
from shoplens.operators import cleaning, clustering, decisions, evaluation, exploration, reports
from shoplens.operators import lifetime_value as lv
from shoplens.operators import rfm
from shoplens.plans import batch
from shoplens.sources import schemas, tables
from shoplens.sources.retail_view import retail_raw
from shoplens.sources.stages import parts_for, stage_path, store

HOME_COUNTRY = "NATION_0"

# Model parameters used where SQL checks the formula, not the fit.
PURCHASES = lv.BgNbd(r=0.9, alpha=20.0, a=1.6, b=4.0)
SPEND = lv.GammaGamma(p=6.0, q=4.0, v=15.0)
CENTERS = [[-1.0, 1.0, 1.0], [-0.5, -0.5, -0.5], [0.5, 0.5, 0.0], [1.0, -1.0, -1.0]]
LOGIT_WEIGHTS = [0.004, -0.15, -0.0000005, 0.01, 0.02, 0.0005, 0.000002, 0.001]
LOGIT_INTERCEPT = -0.5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def plain(frame: DataFrame, **places: int) -> DataFrame:
    """Types every engine prints alike; ``places`` rounds columns whose sums depend on order."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind == "decimal":
            column = column.cast("double")
        elif kind in ("date", "timestamp_ntz"):
            column = column.cast("string")
        if field.name in places:
            column = F.round(column, places[field.name])
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def as_text(frame: DataFrame, *columns: str) -> DataFrame:
    """Whole-number columns that may be null, as text."""
    return frame.withColumns({c: F.col(c).cast("string") for c in columns})


# ---- shared inputs ---------------------------------------------------------------------------


def line_parts(spark: SparkSession, folder: str) -> int | None:
    """Partitions for the lines, whose number the files tell."""
    return parts_for(spark.read.parquet(f"{folder}/lineitem.parquet"))


def clean_of(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_transactions(retail_raw(spark, folder), line_parts(spark, folder))


def stored_clean(spark: SparkSession, folder: str) -> DataFrame:
    return store(clean_of(spark, folder), "cleaned")


def rfm_of(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.rfm_table(clean_of(spark, folder))


def segments_of(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.rfm_segments(rfm_of(spark, folder), on_ties="merge")


def labelled_of(spark: SparkSession, folder: str) -> DataFrame:
    return store(cf.churn_dataset(stored_clean(spark, folder)), "churn-features")


def with_formula_score(frame: DataFrame) -> DataFrame:
    return frame.withColumn("ChurnProbability", F.col("Recency") / (F.col("Tenure") + 1.0))


def scored_labels(spark: SparkSession, folder: str) -> DataFrame:
    return with_formula_score(labelled_of(spark, folder))


def summary_of(spark: SparkSession, folder: str) -> DataFrame:
    return store(lv.clv_summary_input(clean_of(spark, folder)), "clv-summary")


def live_of(spark: SparkSession, folder: str) -> DataFrame:
    return with_formula_score(cf.live_features(clean_of(spark, folder)))


def clustered_of(live: DataFrame) -> DataFrame:
    recent = live.select("CustomerID", "Recency", "Frequency", "Monetary")
    return rfm.rfm_segments(recent, on_ties="merge").withColumn(
        "Cluster", (F.col("CustomerID") % 4).cast("int")
    )


def tiers_of(live: DataFrame) -> DataFrame:
    spent = live.select("CustomerID", F.col("Monetary").cast("double").alias("CLV_12m"))
    return lv.clv_tiers(spent, "merge")


def known(frame: DataFrame) -> DataFrame:
    """Without every 29th customer: what a join then misses feeds the Unknown branch."""
    return frame.filter(F.col("CustomerID") % 29 != 0)


def business_frame(
    spark: SparkSession, folder: str, live: DataFrame | None = None
) -> DataFrame:
    """``live``: the scored live features, where a query has them already."""
    live = live_of(spark, folder) if live is None else live
    return decisions.business_table(
        live, known(clustered_of(live)), known(tiers_of(live)), "merge"
    )


def business_of(
    spark: SparkSession, folder: str, live: DataFrame | None = None
) -> DataFrame:
    return store(business_frame(spark, folder, live), "business")


def valued_of(spark: SparkSession, folder: str) -> DataFrame:
    return tiers_of(live_of(spark, folder))


def scaled_of(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.scaled_features(rfm_of(spark, folder))


# ---- sources and sinks -----------------------------------------------------------------------


@query
def read_raw(spark, folder):
    path = stage_path(spark, "raw")
    tables.write_stage(retail_raw(spark, folder), path)
    return as_text(plain(tables.read_raw(spark, path)), "CustomerID")


@query
def read_clean(spark, folder):
    path = stage_path(spark, "clean-csv")
    tables.write_csv(clean_of(spark, folder), path)
    return plain(tables.read_clean(spark, path, "csv"))


@query
def read_stage_tables(spark, folder):
    path = stage_path(spark, "rfm")
    tables.write_stage(segments_of(spark, folder), path)
    return plain(tables.read_stage(spark, path))


@query
def write_csv(spark, folder):
    path = stage_path(spark, "segments-csv")
    table = segments_of(spark, folder)
    tables.write_csv(table, path)
    return plain(tables.read_csv_table(spark, path, table.schema))


@query
def write_profile_csv(spark, folder):
    path = stage_path(spark, "profile-csv")
    clustered = clustered_of(live_of(spark, folder))
    profile = clustering.cluster_profile(clustered)
    tables.write_csv(profile, path)
    return plain(tables.read_csv_table(spark, path, profile.schema))


# ---- filters, cleaning and data quality ------------------------------------------------------


@query
def drop_missing_customer(spark, folder):
    return plain(cleaning.drop_missing_customer(retail_raw(spark, folder)))


@query
def drop_cancellations(spark, folder):
    return as_text(plain(cleaning.drop_cancellations(retail_raw(spark, folder))), "CustomerID")


@query
def drop_non_product(spark, folder):
    return as_text(plain(cleaning.drop_non_product(retail_raw(spark, folder))), "CustomerID")


@query
def drop_nonpositive(spark, folder):
    return as_text(plain(cleaning.drop_nonpositive(retail_raw(spark, folder))), "CustomerID")


@query
def dedup_rows(spark, folder):
    return as_text(plain(cleaning.dedup_rows(retail_raw(spark, folder), line_parts(spark, folder))), "CustomerID")


@query
def clean_transactions(spark, folder):
    return plain(clean_of(spark, folder))


@query
def cleaning_funnel(spark, folder):
    return plain(cleaning.cleaning_funnel(retail_raw(spark, folder)))


@query
def null_profile(spark, folder):
    return cleaning.null_profile(retail_raw(spark, folder))


@query
def clean_profile(spark, folder):
    return plain(cleaning.clean_profile(clean_of(spark, folder)))


@query
def merge_missing_counts(spark, folder):
    return decisions.merge_missing_counts(business_frame(spark, folder))


@query
def observation_window(spark, folder):
    clean = stored_clean(spark, folder)
    return plain(cf.observation_window(clean, cf.churn_cutoff(clean)))


@query
def holdout_window(spark, folder):
    clean = stored_clean(spark, folder)
    return plain(cf.holdout_window(clean, cf.churn_cutoff(clean)))


@query
def trim_below_quantile(spark, folder):
    invoices = store(exploration.invoice_value(clean_of(spark, folder)), "invoice-value")
    return plain(exploration.trim_below_quantile(invoices, "InvoiceValue"))


@query
def repeat_buyers(spark, folder):
    return plain(lv.repeat_buyers(summary_of(spark, folder)))


@query
def repeat_buyer_counts(spark, folder):
    return lv.repeat_buyer_counts(summary_of(spark, folder))


@query
def urgent_customers(spark, folder):
    frame = decisions.urgent_customers(business_frame(spark, folder))
    return as_text(plain(frame), "Cluster")


@query
def low_priority_customers(spark, folder):
    frame = decisions.low_priority_customers(business_frame(spark, folder))
    return as_text(plain(frame), "Cluster")


@query
def low_priority_share(spark, folder):
    return decisions.low_priority_share(business_frame(spark, folder))


# ---- projections -----------------------------------------------------------------------------


@query
def total_price(spark, folder):
    frame = retail_raw(spark, folder)
    return plain(cleaning.add_total_price(frame).select("InvoiceNo", "StockCode", "TotalPrice"))


@query
def cast_types(spark, folder):
    raw = retail_raw(spark, folder)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return as_text(plain(cleaning.cast_types(text)), "CustomerID")


@query
def cast_losses(spark, folder):
    raw = retail_raw(spark, folder)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    # Service codes are no numbers: read as quantities, they are what gets lost.
    return cleaning.cast_losses(text.withColumn("Quantity", F.col("StockCode")))


@query
def reference_date(spark, folder):
    dates = clean_of(spark, folder).agg(
        (F.max("InvoiceDate") + ex.days(1)).alias("ReferenceDate"),
        (F.max("InvoiceDate") - ex.days(cf.HOLDOUT_DAYS)).alias("Cutoff"),
    )
    return plain(dates)


@query
def whole_days_between(spark, folder):
    rows = rfm_of(spark, folder)
    return rows.select("CustomerID", "Recency")


@query
def safe_ratio_features(spark, folder):
    return cf.live_features(clean_of(spark, folder)).select(
        "CustomerID", "AvgOrderValue", "AvgDaysBetweenPurchases"
    )


@query
def log1p_features(spark, folder):
    return plain(
        clustering.log1p_features(rfm_of(spark, folder)), Recency=8, Frequency=8, Monetary=8
    )


@query
def rfm_score_string(spark, folder):
    scored = rfm.score_rfm(rfm_of(spark, folder), "merge")
    return scored.select("CustomerID", "RFM_Score")


@query
def rfm_sum(spark, folder):
    return rfm.score_rfm(rfm_of(spark, folder), "merge").select("CustomerID", "RFM_Sum")


@query
def rfm_segment(spark, folder):
    return plain(segments_of(spark, folder))


@query
def recommendation(spark, folder):
    return business_frame(spark, folder).select(
        "CustomerID", "CLV_Tier", "ChurnRiskTier", "Recommendation", "Priority", "Action"
    )


@query
def clip_lower(spark, folder):
    lines = retail_raw(spark, folder)
    clipped = ex.clip_lower(F.col("Quantity").cast("double"), 0.0).alias("Clipped")
    return lines.select("InvoiceNo", "StockCode", "Quantity", clipped)


@query
def cap_at_quantile(spark, folder):
    valued = valued_of(spark, folder)
    return plain(
        decisions.cap_at_quantile(valued, "CLV_12m", 0.97, "CLV_capped").select(
            "CustomerID", "CLV_capped"
        ),
        CLV_capped=4,
    )


@query
def fill_missing(spark, folder):
    known = business_frame(spark, folder).select(
        "CustomerID", F.col("CLV_12m").alias("monetary_value")
    )
    return lv.fill_missing_spend(known)


@query
def round2(spark, folder):
    features = cf.live_features(clean_of(spark, folder))
    return features.select(
        "CustomerID",
        ex.half_even(F.col("Recency") / 8, 2).alias("RecencyEighths"),
        ex.half_even(F.col("Recency") / 16, 0).alias("RecencySixteenths"),
        ex.half_even(F.col("Monetary"), 2).alias("Monetary"),
    )


@query
def percent_of_total(spark, folder):
    revenue = exploration.country_revenue(clean_of(spark, folder))
    return plain(exploration.percent_of_total(revenue, "Revenue", "SharePct"), SharePct=8)


@query
def segment_label_text(spark, folder):
    return rfm.segment_revenue(segments_of(spark, folder)).select(
        "Segment", rfm.segment_label().alias("Label")
    )


@query
def select_rename_drop(spark, folder):
    features = cf.live_features(clean_of(spark, folder)).drop("Tenure")
    return plain(
        features.withColumnRenamed("CustomerID", "Customer").select(
            "Customer", "Recency", "Frequency", "Monetary"
        )
    )


@query
def log10_axes(spark, folder):
    scatter = rfm.rfm_scatter(segments_of(spark, folder))
    return plain(
        scatter.select("CustomerID", "LogFrequency", "LogMonetary"), LogFrequency=8, LogMonetary=8
    )


# ---- joins -----------------------------------------------------------------------------------


@query
def join_segment(spark, folder):
    live = live_of(spark, folder)
    clustered = known(clustered_of(live))
    joined = decisions.join_segment(live.select("CustomerID", "ChurnProbability"), clustered)
    return as_text(joined, "Cluster")


@query
def join_clv(spark, folder):
    live = live_of(spark, folder)
    valued = known(tiers_of(live))
    return decisions.join_clv(live.select("CustomerID", "ChurnProbability"), valued)


@query
def churn_label(spark, folder):
    clean = stored_clean(spark, folder)
    cutoff = cf.churn_cutoff(clean)
    return cf.churn_label(cf.observation_window(clean, cutoff), cf.holdout_window(clean, cutoff))


@query
def window_customer_counts(spark, folder):
    clean = stored_clean(spark, folder)
    return cf.window_customer_counts(clean, cf.churn_cutoff(clean))


@query
def actual_spend_lookup(spark, folder):
    clean = stored_clean(spark, folder)
    one_time = lv.clv_summary_input(clean).filter(F.col("frequency") == 0).select("CustomerID")
    return plain(one_time.join(lv.actual_spend(clean), "CustomerID", "left"))


@query
def broadcast_scalar(spark, folder):
    clean = stored_clean(spark, folder)
    reference = rfm.reference_date(clean).scalar()
    age = ex.whole_days(reference, F.col("InvoiceDate")).alias("AgeDays")
    return clean.select("InvoiceNo", "StockCode", "Quantity", age)


# ---- aggregations ----------------------------------------------------------------------------


@query
def rfm_table(spark, folder):
    return plain(rfm_of(spark, folder))


@query
def churn_dataset(spark, folder):
    return plain(cf.churn_dataset(stored_clean(spark, folder)))


@query
def churn_features(spark, folder):
    clean = stored_clean(spark, folder)
    cutoff = cf.churn_cutoff(clean)
    return plain(cf.customer_features(cf.observation_window(clean, cutoff), cutoff))


@query
def live_features(spark, folder):
    return plain(cf.live_features(clean_of(spark, folder)))


@query
def segment_summary(spark, folder):
    return plain(
        rfm.segment_summary(segments_of(spark, folder)),
        AvgRecency=8,
        AvgFrequency=8,
        AvgMonetary=4,
    )


@query
def segment_revenue(spark, folder):
    return plain(rfm.segment_revenue(segments_of(spark, folder)))


@query
def cluster_profile(spark, folder):
    return plain(clustering.cluster_profile(clustered_of(live_of(spark, folder))))


@query
def country_revenue(spark, folder):
    return plain(exploration.country_revenue(clean_of(spark, folder)))


@query
def invoice_value(spark, folder):
    return plain(exploration.invoice_value(clean_of(spark, folder)))


@query
def purchase_frequency(spark, folder):
    return exploration.purchase_frequency(clean_of(spark, folder))


@query
def monthly_revenue(spark, folder):
    return plain(exploration.monthly_revenue(clean_of(spark, folder)))


@query
def eda_key_stats(spark, folder):
    clean = stored_clean(spark, folder)
    stats = exploration.eda_key_stats(
        store(exploration.invoice_value(clean), "invoice-value"),
        store(exploration.purchase_frequency(clean), "purchase-frequency"),
    )
    return plain(stats, MeanInvoiceValue=4, MedianInvoiceValue=4, MeanPurchases=8)


@query
def home_country_share(spark, folder):
    share = exploration.home_country_share(clean_of(spark, folder), HOME_COUNTRY)
    return plain(share, HomeSharePct=8)


@query
def describe_table(spark, folder):
    described = exploration.describe_table(
        rfm_of(spark, folder), ["Recency", "Frequency", "Monetary"]
    )
    return plain(described, Mean=4, Std=4, P25=4, P50=4, P75=4)


@query
def segment_counts(spark, folder):
    return exploration.value_counts(segments_of(spark, folder), "Segment")


@query
def churn_rate(spark, folder):
    return plain(cf.churn_rate(labelled_of(spark, folder)), ChurnRate=8)


@query
def clv_tier_summary(spark, folder):
    return plain(lv.clv_tier_summary(valued_of(spark, folder)), AvgCLV=4, TotalCLV=2)


@query
def tier_risk_crosstab(spark, folder):
    return decisions.tier_risk_crosstab(business_frame(spark, folder))


@query
def recommendation_summary(spark, folder):
    return decisions.recommendation_summary(business_frame(spark, folder))


@query
def revenue_at_risk(spark, folder):
    return plain(decisions.revenue_at_risk(business_frame(spark, folder)), RevenueAtRisk=2)


@query
def kpi_row(spark, folder):
    kpis = reports.kpi_row(business_frame(spark, folder))
    return plain(kpis, TotalCLV=2, AvgChurn=8, RevenueAtRisk=2, LowPriorityShare=8)


@query
def freq_monetary_corr(spark, folder):
    return plain(lv.frequency_spend_correlation(summary_of(spark, folder)), Correlation=8)


@query
def unstable_clv_count(spark, folder):
    scored = summary_of(spark, folder).withColumn("CLV_12m", lv.clv_12m(PURCHASES, SPEND))
    return lv.unstable_clv_count(scored)


@query
def clv_summary_input(spark, folder):
    return plain(lv.clv_summary_input(clean_of(spark, folder)))


# ---- quantile bins and ranks -----------------------------------------------------------------


@query
def recency_score(spark, folder):
    table = rfm_of(spark, folder)
    return table.select("CustomerID", rfm.recency_score(rfm.quintile_edges(table, "merge")).alias("R_Score"))


@query
def frequency_score(spark, folder):
    table = rfm_of(spark, folder)
    return table.select("CustomerID", rfm.frequency_score(table).alias("F_Score"))


@query
def monetary_score(spark, folder):
    table = rfm_of(spark, folder)
    return table.select("CustomerID", rfm.monetary_score(rfm.quintile_edges(table, "merge")).alias("M_Score"))


@query
def clv_tier(spark, folder):
    return valued_of(spark, folder)


@query
def churn_risk_tier(spark, folder):
    live = live_of(spark, folder)
    return decisions.churn_risk_tiers(live, "merge").select(
        "CustomerID", "ChurnProbability", "ChurnRiskTier"
    )


@query
def first_rank(spark, folder):
    return rfm.first_rank(rfm_of(spark, folder))


@query
def quantile_value(spark, folder):
    table = rfm_of(spark, folder)
    wanted = {c: [0.5, 0.95, 0.97] for c in ("Recency", "Frequency", "Monetary")}
    found = exact_quantiles(table, wanted)
    rows = [(c, p, v) for c in wanted for p, v in zip(wanted[c], found[c])]
    frame = spark.createDataFrame(rows, "Column string, Share double, Quantile double")
    return plain(frame, Quantile=4)


@query
def histogram(spark, folder):
    orders = store(exploration.purchase_frequency(clean_of(spark, folder)), "purchase-frequency")
    trimmed = exploration.trim_below_quantile(orders, "Invoices")
    bins = exploration.histogram(trimmed, "Invoices", reports.ORDER_BINS)
    return plain(bins, BinStart=6, BinEnd=6)


# ---- sorts, limits, distinct -----------------------------------------------------------------


@query
def sort_recommendations(spark, folder):
    frame = decisions.sort_recommendations(business_of(spark, folder))
    return as_text(plain(frame), "Cluster")


@query
def top_countries(spark, folder):
    return plain(exploration.top_countries(clean_of(spark, folder), 10))


@query
def top_five_countries(spark, folder):
    return plain(exploration.top_countries(clean_of(spark, folder), 5))


@query
def top_urgent(spark, folder):
    return decisions.top_urgent(business_of(spark, folder))


@query
def sorted_group_tables(spark, folder):
    return plain(rfm.segment_revenue(segments_of(spark, folder), ascending=True))


@query
def distinct_values(spark, folder):
    return exploration.distinct_values(segments_of(spark, folder), "Segment")


def formula_models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Three formula scores standing in for three models."""
    labelled = labelled_of(spark, folder)
    formulas = {
        "Recency over tenure": F.col("Recency") / (F.col("Tenure") + 1.0),
        "Inverse frequency": 1.0 / F.col("Frequency"),
        "Few products": 10.0 / (F.col("UniqueProducts") + 9.0),
    }
    return {
        name: labelled.select("CustomerID", "Churned", value.alias("ChurnProbability"))
        for name, value in formulas.items()
    }


@query
def argmax_row(spark, folder):
    table = cm.model_comparison(formula_models(spark, folder), "Churned", "ChurnProbability")
    return cm.best_model(store(table, "comparison")).select("Model", "ROC-AUC")


# ---- clustering ------------------------------------------------------------------------------


@query
def standardize(spark, folder):
    return plain(scaled_of(spark, folder), Recency=6, Frequency=6, Monetary=6)


@query
def kmeans_k_sweep(spark, folder):
    return plain(clustering.k_sweep(scaled_of(spark, folder)), Inertia=4, Silhouette=6)


@query
def kmeans_assign(spark, folder):
    features = scaled_of(spark, folder)
    labelled = clustering.assign(features, clustering.fit_centers(features))
    return labelled.select("CustomerID", "Cluster")


@query
def kmeans_check(spark, folder):
    """What must hold of the sweep and of the fit, whatever the start: no center is left without
    customers, no fit costs more than other centers do, cost falls with k, silhouettes are in range."""
    features = scaled_of(spark, folder)
    centers = clustering.fit_centers(features)
    labelled = clustering.assign(features, centers)
    cost = clustering.inertia(features, centers).first()[0]
    other = clustering.inertia(features, CENTERS).first()[0]
    sweep = clustering.k_sweep(features).orderBy("K").collect()
    costs = [r.Inertia for r in sweep]
    return labelled.agg(
        F.count("Cluster").alias("Customers"), F.count_distinct("Cluster").alias("Clusters")
    ).select(
        "*",
        F.lit(cost <= other).alias("NotAboveFixed"),
        F.lit(len(sweep)).alias("Ks"),
        F.lit(costs == sorted(costs, reverse=True)).alias("Falling"),
        F.lit(abs(costs[2] / cost - 1) < 1e-3).alias("SweepAgrees"),
        F.lit(all(-1 <= r.Silhouette <= 1 for r in sweep)).alias("SilhouettesInRange"),
    )


@query
def kmeans_assign_fixed(spark, folder):
    return clustering.assign(scaled_of(spark, folder), CENTERS).select("CustomerID", "Cluster")


@query
def silhouette(spark, folder):
    labelled = clustering.assign(scaled_of(spark, folder), CENTERS)
    return plain(clustering.silhouette(labelled), Silhouette=6)


@query
def silhouette_tree(spark, folder):
    """The plain-distance silhouette by expansion of far cells; its error bound is far above its error."""
    labelled = clustering.assign(scaled_of(spark, folder), CENTERS)
    found = clustering.tree_silhouettes(labelled, ["Cluster"])["Cluster"]
    row = [(found.mean, 0 <= found.error < 0.05)]
    return plain(spark.createDataFrame(row, "Silhouette double, SmallBound boolean"), Silhouette=4)


@query
def silhouette_squared(spark, folder):
    labelled = clustering.assign(scaled_of(spark, folder), CENTERS)
    return plain(clustering.squared_silhouette_row(labelled), Silhouette=6)


@query
def pca_2d(spark, folder):
    features = scaled_of(spark, folder)
    placed = clustering.Components.fit(features).apply(features)
    return plain(placed.select("CustomerID", "PCA1", "PCA2"), PCA1=6, PCA2=6)


@query
def pca_variance(spark, folder):
    features = scaled_of(spark, folder)
    return plain(clustering.Components.fit(features).variance(features), Ratio=8)


@query
def inertia(spark, folder):
    return plain(clustering.inertia(scaled_of(spark, folder), CENTERS), Inertia=4)


# ---- churn models and evaluation -------------------------------------------------------------


@query
def stratified_split(spark, folder):
    return cf.stratified_split(labelled_of(spark, folder)).select(
        "CustomerID", "Churned", "IsTest"
    )


@query
def class_weights(spark, folder):
    return plain(cf.class_weights(labelled_of(spark, folder)), Weight=8)


@query
def scale_pos_weight(spark, folder):
    return plain(cf.scale_pos_weight(labelled_of(spark, folder)), ScalePosWeight=8)


def _split(spark, folder):
    split = store(cf.stratified_split(labelled_of(spark, folder)), "churn-split")
    train = split.filter(F.col("IsTest") == 0).drop("IsTest")
    return train, split.filter(F.col("IsTest") == 1).drop("IsTest")


@query
def logreg_churn(spark, folder):
    train, test = _split(spark, folder)
    model, scaler = cm.fit_logistic(train)
    scored = cm.score(model, test, scaler=scaler)
    return plain(scored.select("CustomerID", "Churned", "ChurnProbability"), ChurnProbability=6)


@query
def logreg_score_fixed(spark, folder):
    scored = cm.linear_score(labelled_of(spark, folder), LOGIT_WEIGHTS, LOGIT_INTERCEPT)
    return plain(scored.select("CustomerID", "ChurnProbability"), ChurnProbability=8)


@query
def random_forest_churn(spark, folder):
    train, test = _split(spark, folder)
    model = cm.fit_forest(train)
    scored = cm.score(model, test)
    return plain(scored.select("CustomerID", "Churned", "ChurnProbability"), ChurnProbability=6)


@query
def boosted_trees_churn(spark, folder):
    train, test = _split(spark, folder)
    model = cm.fit_boosted(train)
    scored = cm.score(model, test)
    return plain(scored.select("CustomerID", "Churned", "ChurnProbability"), ChurnProbability=6)


@query
def score_live_customers(spark, folder):
    live = batch.live_scores(stored_clean(spark, folder))
    return plain(live.select("CustomerID", "ChurnProbability"), ChurnProbability=6)


@query
def score_all_observed(spark, folder):
    labelled = labelled_of(spark, folder)
    train, _ = _split(spark, folder)
    scored = cm.score(cm.fit_boosted(train), labelled, "ChurnProbability_Boosted")
    return plain(scored, ChurnProbability_Boosted=6)


def in_range(name: str):
    return F.col(name).between(0, 1).alias("InRange")


@query
def churn_models_check(spark, folder):
    """Test rows of the three fits with their labels; whether the scores are probabilities and
    whether each model tells the classes of its training rows apart better than chance."""
    train, test = _split(spark, folder)
    logistic, scaler = cm.fit_logistic(train)
    fits = {
        cm.LOGISTIC: (logistic, scaler),
        cm.FOREST: (cm.fit_forest(train), None),
        cm.BOOSTED: (cm.fit_boosted(train), None),
    }
    parts = []
    for name, (model, scale) in fits.items():
        known = store(cm.score(model, train, scaler=scale), "train-scores")
        area = evaluation.roc_auc(known, "Churned", "ChurnProbability").first()[0]
        parts.append(
            cm.score(model, test, scaler=scale).select(
                F.lit(name).alias("Model"), "CustomerID", "Churned", in_range("ChurnProbability"),
                F.lit(area > 0.55).alias("Learned"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def logreg_gradient_check(spark, folder):
    """The gradient of the logistic objective at the fit, per coefficient: flat at the optimum."""
    train, _ = _split(spark, folder)
    model, scaler = cm.fit_logistic(train)
    counts = cf.class_counts(train)
    rows = sum(counts.values())
    miss = cm.balanced_weight(counts) * (F.col("ChurnProbability") - F.col("Churned"))
    slopes = cm.score(model, train, scaler=scaler).agg(
        *[(F.sum(miss * scaler.column(c)) / rows).alias(c) for c in cf.FEATURES],
        (F.sum(miss) / rows).alias("Intercept"),
    )
    weights = [*(w / rows for w in model.coefficients.toArray()), 0.0]
    flat = [
        F.struct(F.lit(c).alias("Term"), (F.abs(F.col(c) + float(w)) < 1e-3).alias("Flat"))
        for c, w in zip(slopes.columns, weights)
    ]
    return slopes.select(F.inline(F.array(*flat)))


@query
def churn_scores_check(spark, folder):
    """All customers scored live and all observed customers scored: who, and whether in range."""
    clean = stored_clean(spark, folder)
    labelled = store(cf.churn_dataset(clean), "churn-features")
    live = batch.live_scores(clean, training=labelled)
    boosted = cm.fit_boosted(labelled)
    known = cm.score(boosted, labelled)
    importance = cm.feature_importance(boosted, labelled)
    total = importance.agg(F.sum("Importance")).first()[0]
    parts = [
        live.select(F.lit("live").alias("Rows"), "CustomerID", in_range("ChurnProbability")),
        known.select(F.lit("observed").alias("Rows"), "CustomerID", in_range("ChurnProbability")),
        importance.select(
            F.concat(F.lit("importance "), "Feature").alias("Rows"),
            F.lit(0).cast("long").alias("CustomerID"),
            ((F.col("Importance") >= 0) & F.lit(abs(total - 1) < 1e-9)).alias("InRange"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def classification_metrics(spark, folder):
    return evaluation.classification_metrics(
        scored_labels(spark, folder), "Churned", "ChurnProbability"
    )


@query
def roc_auc(spark, folder):
    return plain(
        evaluation.roc_auc(scored_labels(spark, folder), "Churned", "ChurnProbability"), RocAuc=10
    )


@query
def roc_curve(spark, folder):
    curve = evaluation.roc_curve(scored_labels(spark, folder), "Churned", "ChurnProbability")
    # The origin's threshold is infinite, which engines print differently; it is shown as -1.
    return curve.select(
        "Fpr",
        "Tpr",
        F.when(F.col("Threshold") < 2, F.round("Threshold", 10)).alias("Threshold"),
    ).fillna(-1.0, ["Threshold"])


@query
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(
        scored_labels(spark, folder), "Churned", "ChurnProbability"
    )


@query
def classification_report(spark, folder):
    report = evaluation.classification_report(
        scored_labels(spark, folder), "Churned", "ChurnProbability"
    )
    return plain(report, Precision=8, Recall=8, F1=8)


@query
def feature_importance(spark, folder):
    train, _ = _split(spark, folder)
    return plain(cm.feature_importance(cm.fit_boosted(train), train), Importance=6)


@query
def model_comparison(spark, folder):
    return cm.model_comparison(formula_models(spark, folder), "Churned", "ChurnProbability").drop(
        "Position"
    )


@query
def churn_model_comparison(spark, folder):
    comparison, _, _ = batch.compare_churn_models(labelled_of(spark, folder))
    return comparison.drop("Position")


# ---- customer lifetime value -----------------------------------------------------------------


@query
def bgnbd_loglik(spark, folder):
    return plain(lv.bgnbd_loglik(summary_of(spark, folder), PURCHASES), LogLikelihood=4)


@query
def bgnbd_fit(spark, folder):
    model, _ = lv.fit_bgnbd(summary_of(spark, folder))
    return spark.createDataFrame(
        [(model.r, model.alpha, model.a, model.b)], "r double, alpha double, a double, b double"
    )


@query
def bgnbd_params(spark, folder):
    return lv.fit_bgnbd(summary_of(spark, folder))[1]


@query
def lifetime_fit_check(spark, folder):
    """Customers behind each fit, and whether the penalised likelihood is at its highest there:
    every parameter is tried a twentieth lower and higher."""
    summary = summary_of(spark, folder)
    fits = {
        "purchases": (lv.fit_bgnbd(summary)[0], lv.bgnbd_objective),
        "spend": (lv.fit_gamma_gamma(summary)[0], lv.gamma_gamma_objective),
    }
    rows = []
    for name, (model, objective) in fits.items():
        theta = list(astuple(model))
        tried = [theta] + [
            [v * (factor if i == j else 1) for j, v in enumerate(theta)]
            for i in range(len(theta))
            for factor in (0.95, 1.05)
        ]
        customers, values = objective(summary, tried)
        slack = 1e-6 * max(1.0, abs(values[0]))
        rows.append((name, int(customers), min(values[1:]) >= values[0] - slack))
    return spark.createDataFrame(rows, "Model string, Customers long, AtBest boolean")


@query
def clv_rows_check(spark, folder):
    """Every customer once, with the value of one-time buyers and the range of the others."""
    valued = lv.clv_predictions(stored_clean(spark, folder), on_ties="merge")
    one_time = F.when(F.col("frequency") == 0, F.round("CLV_12m", 4))
    return valued.select(
        "CustomerID",
        one_time.alias("OneTimeValue"),
        (
            (F.col("CLV_12m") >= 0) & F.col("ProbAlive").between(0, 1)
            & (F.col("PredictedPurchases_90d") >= 0)
        ).alias("InRange"),
    )


@query
def expected_purchases(spark, folder):
    value = lv.expected_purchases(PURCHASES, 90).alias("PredictedPurchases_90d")
    return plain(summary_of(spark, folder).select("CustomerID", value), PredictedPurchases_90d=8)


@query
def prob_alive(spark, folder):
    value = lv.prob_alive(PURCHASES).alias("ProbAlive")
    return plain(summary_of(spark, folder).select("CustomerID", value), ProbAlive=8)


@query
def gamma_gamma_loglik(spark, folder):
    return plain(lv.gamma_gamma_loglik(summary_of(spark, folder), SPEND), LogLikelihood=4)


@query
def gamma_gamma_fit(spark, folder):
    model, _ = lv.fit_gamma_gamma(summary_of(spark, folder))
    return spark.createDataFrame([(model.p, model.q, model.v)], "p double, q double, v double")


@query
def gamma_gamma_params(spark, folder):
    return lv.fit_gamma_gamma(summary_of(spark, folder))[1]


@query
def expected_avg_spend(spark, folder):
    value = lv.expected_avg_spend(SPEND).alias("ExpectedSpend")
    return plain(summary_of(spark, folder).select("CustomerID", value), ExpectedSpend=4)


@query
def clv_12m(spark, folder):
    value = lv.clv_12m(PURCHASES, SPEND).alias("CLV_12m")
    return plain(summary_of(spark, folder).select("CustomerID", value), CLV_12m=4)


@query
def one_time_fallback(spark, folder):
    clean = stored_clean(spark, folder)
    scored = lv.clv_summary_input(clean).select(
        "CustomerID", "frequency", (F.col("monetary_value") - 500000.0).alias("CLV_12m")
    )
    return plain(lv.one_time_fallback(scored, lv.actual_spend(clean)), CLV_12m=4)


@query
def clv_predictions(spark, folder):
    return lv.clv_predictions(stored_clean(spark, folder), on_ties="merge")


# ---- chart and report tables -----------------------------------------------------------------


def stacked(charts: dict[str, DataFrame], series: dict[str, tuple[str, str]]) -> DataFrame:
    """Several chart series as one long table: chart, point, value."""
    parts = [
        charts[name].select(
            F.lit(name).alias("Chart"),
            F.col(point).cast("string").alias("Point"),
            F.col(value).cast("double").alias("Value"),
        )
        for name, (point, value) in series.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def chart_eda(spark, folder):
    charts = reports.eda_charts(stored_clean(spark, folder))
    return stacked(
        charts,
        {
            "monthly_revenue": ("MonthEnd", "Revenue"),
            "top_countries": ("Country", "Revenue"),
            "invoice_histogram": ("Bin", "Rows"),
            "order_histogram": ("Bin", "Rows"),
        },
    )


@query
def chart_treemap_shares(spark, folder):
    return plain(rfm.treemap_shares(segments_of(spark, folder)), SharePct=8)


@query
def chart_rfm_scatter(spark, folder):
    scatter = rfm.rfm_scatter(segments_of(spark, folder))
    return plain(scatter, LogFrequency=8, LogMonetary=8)


@query
def chart_k_selection(spark, folder):
    sweep = clustering.k_sweep(scaled_of(spark, folder), metric="squaredEuclidean")
    return plain(sweep, Inertia=4, Silhouette=6)


@query
def chart_pca_points(spark, folder):
    placed = clustering.cluster_customers(segments_of(spark, folder))
    return plain(placed.select("CustomerID", "PCA1", "PCA2", "Cluster"), PCA1=6, PCA2=6)


@query
def chart_pca_check(spark, folder):
    placed = clustering.cluster_customers(segments_of(spark, folder))
    return plain(placed.select("CustomerID", "PCA1", "PCA2"), PCA1=6, PCA2=6)


@query
def chart_clv(spark, folder):
    charts = reports.clv_charts(valued_of(spark, folder))
    table = stacked(
        charts, {"clv_histogram": ("Bin", "Rows"), "clv_by_tier": ("CLV_Tier", "TotalCLV")}
    )
    return plain(table, Value=2)


@query
def chart_priority_map(spark, folder):
    return plain(decisions.priority_map(business_of(spark, folder)), CLV_capped=4)


@query
def chart_segment_bar(spark, folder):
    clustered = clustered_of(live_of(spark, folder))
    return plain(rfm.segment_revenue(clustered, ascending=True))


@query
def chart_clv_pie(spark, folder):
    return plain(reports.clv_pie(business_frame(spark, folder)), TotalCLV=2)


@query
def chart_risk_bar(spark, folder):
    return reports.risk_bar(business_frame(spark, folder))


@query
def dashboard_contents(spark, folder):
    """Every cell of the dashboard tables, with the place of the rows that have an order."""
    live = live_of(spark, folder)
    clustered = clustered_of(live)
    shown = reports.dashboard_tables(business_of(spark, folder, live), clustered)
    return plain(reports.contents(shown), Number=2)


@query
def dashboard_tables(spark, folder):
    live = live_of(spark, folder)
    clustered = clustered_of(live)
    business = business_of(spark, folder, live)
    shown = {}
    for name, table in reports.dashboard_tables(business, clustered).items():
        path = stage_path(spark, f"dashboard-{name}")
        tables.write_stage(table, path)
        shown[name] = tables.read_stage(spark, path)
    counts = [
        frame.agg(F.lit(name).alias("Table"), F.count(F.lit(1)).alias("Rows"))
        for name, frame in shown.items()
    ]
    return reduce(DataFrame.unionByName, counts)
