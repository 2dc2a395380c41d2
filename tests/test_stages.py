import os

import pytest
from shoplens.operators import churn_models as cm
from shoplens.plans import batch
from shoplens.sources import stages, tables
from shoplens.sources.retail_view import retail_raw


#: Every table that the batch writes.
TABLES = set(
    """cleaned cleaning_funnel raw_profile clean_profile eda_country_revenue eda_home_country_share
    eda_key_stats eda_monthly_revenue eda_top_countries eda_invoice_histogram eda_order_histogram
    rfm_table rfm_describe segment_counts segment_summary segment_treemap rfm_scatter rfm_clustered
    cluster_profile cluster_k_selection cluster_silhouette cluster_pca_variance churn_features
    churn_model_comparison churn_rate churn_best_model churn_roc_curves churn_confusion_matrix
    churn_classification_report churn_feature_importance churn_predictions clv_predictions
    clv_purchase_coefficients clv_spend_coefficients clv_frequency_monetary_corr clv_unstable_clv
    clv_repeat_buyers clv_tier_summary clv_histogram business_recommendations merge_missing_counts
    tier_risk_crosstab recommendation_summary low_priority_share revenue_at_risk dashboard_kpis
    dashboard_segment_bar dashboard_clv_pie dashboard_risk_bar dashboard_priority_map
    dashboard_top_urgent""".split()
)


class Session:
    """Just enough of a session to see which folder is picked."""

    def __init__(self, master, configured=None, checkpoint=None):
        self.configured, self.checkpoint, self.master = configured, checkpoint, master
        self.conf = self.sparkContext = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


def test_the_configured_folder_wins():
    session = Session("spark://cluster", "hdfs://shared/ckpt", "hdfs://shared/ckpt/1")
    assert stages.shared_folder(session) == "hdfs://shared/ckpt"
    assert stages.shared_folder(Session("yarn", None, "hdfs://set/by/user")) == "hdfs://set/by/user"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stages.shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert os.path.isdir(stages.shared_folder(local))
    assert stages.shared_folder(local) == local.checkpoint


def test_store_reads_back_the_same_rows(spark):
    frame = spark.range(50).selectExpr("id", "cast(id as decimal(33,2)) d", "null n")
    frame = frame.withColumn("n", frame["n"].cast("string"))
    back = stages.store(frame, "test")
    assert back.schema.simpleString() == frame.schema.simpleString()
    assert back.exceptAll(frame).isEmpty() and back.count() == 50


def test_csv_keeps_text_types_quotes_and_nulls(spark, tmp_path):
    from datetime import datetime
    from decimal import Decimal

    from shoplens.sources.schemas import RAW

    rows = [
        ("00123", "85A", 'say "hi", ok', 1, datetime(2011, 1, 2, 3, 4, 5), Decimal("1.10"), None, "UK"),
        ("C9", "D", None, -1, datetime(2011, 1, 2), Decimal("0.00"), 5, "UK"),
    ]
    path = str(tmp_path / "raw")
    tables.write_csv(spark.createDataFrame(rows, RAW), path)
    back = tables.read_raw(spark, path, "csv").orderBy("InvoiceNo").collect()
    assert [tuple(r) for r in back] == rows


def test_csv_keeps_line_ends_fractions_and_fine_prices(spark, tmp_path):
    from datetime import datetime
    from decimal import Decimal

    from shoplens.sources.schemas import RAW

    rows = [
        ("1", "85A", "two\nlines", 1, datetime(2011, 1, 2, 1, 1, 1, 123456), Decimal("0.0010"), 5, "UK")
    ]
    path = str(tmp_path / "raw")
    tables.write_csv(spark.createDataFrame(rows, RAW), path)
    assert [tuple(r) for r in tables.read_raw(spark, path, "csv").collect()] == rows


def test_csv_of_other_programs(spark, tmp_path):
    from datetime import datetime

    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    (tmp_path / "a.csv").write_text(header + "1,x,d,2,12/1/2010 8:26,2.55,17850.0,UK\n2,x,,1,12/1/2010 8:26,1,,UK\n")
    read = tables.read_raw(spark, str(tmp_path / "a.csv"), "csv", "M/d/yyyy H:mm").orderBy("InvoiceNo")
    assert [r.CustomerID for r in read.collect()] == [17850, None]
    assert read.first().InvoiceDate == datetime(2010, 12, 1, 8, 26)
    for name, line in (("b", "1,x,d,2,12/1/2010 8:26,2.55,17850.5,UK"), ("c", "1,x,d,2,12/1/2010 8:26,0.00001,1,UK")):
        (tmp_path / f"{name}.csv").write_text(f"{header}{line}\n")
        with pytest.raises(Exception, match="does not fit"):
            tables.read_raw(spark, str(tmp_path / f"{name}.csv"), "csv", "M/d/yyyy H:mm").collect()


def test_partitioned_stage_prunes(spark, folder, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "by-country")
    tables.write_stage(retail_raw(spark, folder), path, partition_by="Country")
    plan = (
        tables.read_stage(spark, path).filter(F.col("Country") == "NATION_0")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PartitionFilters: [isnotnull(Country" in plan


def test_whole_batch(spark, folder, tmp_path):
    paths = batch.run(
        spark, retail_raw(spark, folder), str(tmp_path / "out"), trees=10, rounds=3, restarts=2,
        on_ties="merge", csv=True, home_country="NATION_0",
    )
    read = {name: tables.read_stage(spark, path) for name, path in paths.items()}
    customers = read["rfm_table"].count()
    assert customers == 408 and read["cleaned"].count() == 5243
    for name in ("rfm_clustered", "clv_predictions", "business_recommendations"):
        assert read[name].count() == customers
        assert read[name].select("CustomerID").distinct().count() == customers
    assert read["cluster_profile"].count() == 4
    assert read["churn_model_comparison"].count() == 3
    assert {r.Model for r in read["churn_model_comparison"].collect()} == {
        cm.LOGISTIC, cm.FOREST, cm.BOOSTED,
    }
    assert read["churn_predictions"].count() == read["churn_features"].count() == 399
    assert set(paths) == TABLES
    funnel = read["cleaning_funnel"].orderBy("StepNo").collect()
    assert funnel[-1].RowsAfter == 5243
    assert read["segment_counts"].agg({"Customers": "sum"}).first()[0] == customers
    assert [r.K for r in read["cluster_k_selection"].orderBy("K").collect()] == list(range(2, 11))
    best = read["churn_best_model"].first()
    compared = {r.Model: r["ROC-AUC"] for r in read["churn_model_comparison"].collect()}
    assert best["ROC-AUC"] == max(compared.values()) == compared[best.Model]
    assert set(compared) == {r.Model for r in read["churn_roc_curves"].collect()}
    assert read["churn_confusion_matrix"].agg({"Customers": "sum"}).first()[0] == 100
    assert read["clv_purchase_coefficients"].count() == 4
    assert read["merge_missing_counts"].first().MissingCLV == 0
    assert read["recommendation_summary"].agg({"Customers": "sum"}).first()[0] == customers
    assert read["dashboard_kpis"].first().TotalCustomers == customers
    assert 0 < read["dashboard_top_urgent"].count() <= 20
    business = read["business_recommendations"]
    copied = tables.read_csv_table(
        spark, str(tmp_path / "out" / "csv" / "business_recommendations"), business.schema
    )
    assert copied.count() == customers
    assert business.filter("Priority = 99").count() == 0


def test_a_killed_run_goes_on_and_a_finished_one_leaves_its_tables(spark, folder, tmp_path, monkeypatch):
    """The second start makes only what the first did not finish."""
    raw = tmp_path / "raw"
    tables.write_stage(retail_raw(spark, folder), str(raw))
    out, shared = tmp_path / "out", tmp_path / "shared"
    monkeypatch.setattr(stages, "shared_folder", lambda _: str(shared))
    settings = {"trees": 3, "rounds": 2, "restarts": 2, "on_ties": "merge", "home_country": "NATION_0"}
    made = []
    plain = batch.value_tables
    monkeypatch.setattr(batch, "churn_tables", lambda *a, keep=batch.churn_tables: made.append("churn") or keep(*a))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(batch, "value_tables", killed)
    with pytest.raises(KeyboardInterrupt):
        batch.run(spark, tables.read_raw(spark, str(raw)), str(out), **settings)
    assert (out / "churn_predictions").exists() and not (out / "clv_predictions").exists()
    assert not list(shared.iterdir())  # no stage table is left
    before = os.path.getmtime(out / "churn_predictions" / "_SUCCESS")

    monkeypatch.setattr(batch, "value_tables", plain)
    paths = batch.run(spark, tables.read_raw(spark, str(raw)), str(out), **settings)
    assert made == ["churn"] and set(paths) == TABLES
    assert os.path.getmtime(out / "churn_predictions" / "_SUCCESS") == before
    assert {p.name for p in out.iterdir()} == TABLES and not list(shared.iterdir())


def test_other_input_or_settings_are_another_run(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_stage(spark.range(5), path)
    one = stages.input_key(spark.read.parquet(path), 1)
    assert one == stages.input_key(spark.read.parquet(path), 1) != stages.input_key(spark.read.parquet(path), 2)
    tables.write_stage(spark.range(6), path)
    assert one != stages.input_key(spark.read.parquet(path), 1)
    assert stages.input_key(spark.createDataFrame([(1,)], "x int")) != stages.input_key(spark.createDataFrame([(1,)], "x int"))


def test_a_step_is_listed_only_when_it_is_whole(spark, tmp_path):
    run = stages.Run(spark, str(tmp_path), "k")
    bad = spark.range(4).selectExpr("raise_error('stop') AS x")
    with pytest.raises(Exception, match="stop"):
        run.step("two", lambda: {"a": spark.range(3), "b": bad})
    assert not (tmp_path / "a").exists() and not (tmp_path / "_manifest" / "k" / "two.json").exists()
    seen = []
    found = run.step("two", lambda: {"a": spark.range(3), "b": spark.range(4)}, lambda name, _: seen.append(name))
    assert found["b"].count() == 4 and seen == ["a", "b"] and set(run.paths) == {"a", "b"}
    again = stages.Run(spark, str(tmp_path), "k").step("two", lambda: pytest.fail("made again"))
    assert again["a"].count() == 3
    run.finish()
    assert {p.name for p in tmp_path.iterdir()} == {"a", "b"}
