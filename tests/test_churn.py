import math
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from shoplens.operators import churn_features as cf
from shoplens.operators import churn_models as cm
from shoplens.operators import evaluation
from shoplens.plans.registry import with_formula_score
from shoplens.sources.schemas import CLEAN
from shoplens.sources.stages import store


@pytest.fixture(scope="module")
def labelled(clean):
    return store(cf.churn_dataset(clean), "test-churn")


def scores(spark, labels, values):
    return spark.createDataFrame(
        [(i, int(y), float(p)) for i, (y, p) in enumerate(zip(labels, values))],
        "CustomerID long, y int, p double",
    )


def test_features_and_label_worked_by_hand(spark):
    """The last sale is on 2011-12-31, so the holdout window begins after 2011-10-02 00:00."""
    sales = [
        (1, "x1", "p", 2, datetime(2011, 1, 2), 20),
        (1, "x1", "q", 4, datetime(2011, 1, 2), 40),
        (1, "x2", "p", 6, datetime(2011, 9, 2), 60),
        (1, "x3", "r", 1, datetime(2011, 12, 31), 99),  # comes back
        (2, "y1", "p", 3, datetime(2011, 10, 2), 9),  # at the cutoff, never seen again
        (3, "z1", "p", 5, datetime(2011, 12, 1), 7),  # only in the holdout window
    ]
    lines = [
        (invoice, code, "d", count, when, Decimal(1), buyer, "UK", Decimal(paid))
        for buyer, invoice, code, count, when, paid in sales
    ]
    rows = cf.churn_dataset(store(spark.createDataFrame(lines, CLEAN), "test-sales"))
    names = (
        "CustomerID", "Recency", "Frequency", "Monetary", "UniqueProducts", "AvgQuantity",
        "Tenure", "AvgOrderValue", "AvgDaysBetweenPurchases", "Churned",
    )
    got = [tuple(float(r[n]) for n in names) for r in rows.orderBy("CustomerID").collect()]
    assert got == [(1, 30, 2, 120, 2, 4, 273, 60, 136.5, 0), (2, 0, 1, 9, 1, 3, 0, 9, 0, 1)]


def test_label_join_agrees_with_the_one_pass_label(clean, labelled):
    cutoff = cf.churn_cutoff(clean)
    joined = cf.churn_label(cf.observation_window(clean, cutoff), cf.holdout_window(clean, cutoff))
    assert joined.exceptAll(labelled.select("CustomerID", "Churned")).isEmpty()
    assert joined.count() == labelled.count()


def test_split_is_exact_and_repeatable(labelled):
    counts = cf.class_counts(labelled)
    split = cf.stratified_split(labelled)
    test = split.filter("IsTest = 1")
    in_test = cf.class_counts(test)
    total = sum(counts.values())
    assert sum(in_test.values()) == math.ceil(0.25 * total)
    for value, n in counts.items():
        assert abs(in_test[value] - 0.25 * n) <= 1
    again = cf.stratified_split(labelled.repartition(7)).filter("IsTest = 1")
    assert test.select("CustomerID").exceptAll(again.select("CustomerID")).isEmpty()
    other = cf.stratified_split(labelled, seed=7).filter("IsTest = 1")
    assert not test.select("CustomerID").exceptAll(other.select("CustomerID")).isEmpty()


def test_split_of_one_class(spark):
    rows = scores(spark, [1] * 9, [0.5] * 9)
    assert cf.stratified_split(rows, label="y").filter("IsTest = 1").count() == 3


def brute_auc(labels, values):
    pairs = [
        (p > q) + 0.5 * (p == q)
        for y, p in zip(labels, values) if y
        for z, q in zip(labels, values) if not z
    ]
    return sum(pairs) / len(pairs)


@pytest.mark.parametrize("seed,distinct", [(0, 4), (1, 50), (2, 1)])
def test_auc_counts_ties_half(spark, seed, distinct):
    rng = np.random.default_rng(seed)
    labels = rng.integers(0, 2, 120)
    values = rng.integers(0, distinct, 120) / 10
    frame = scores(spark, labels, values)
    for partitions in (1, 5):
        got = evaluation.roc_auc(frame, "y", "p", partitions).first()[0]
        assert got == pytest.approx(brute_auc(labels, values), abs=1e-12)


def test_auc_of_one_class_is_missing(spark):
    assert evaluation.roc_auc(scores(spark, [1, 1], [0.2, 0.4]), "y", "p").first()[0] is None


def test_roc_curve_has_origin_end_and_the_same_area(spark):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 2, 200)
    values = np.round(rng.random(200), 2)
    frame = scores(spark, labels, values)
    points = sorted(
        (r.Fpr, r.Tpr) for r in evaluation.roc_curve(frame, "y", "p", 4).collect()
    )
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(brute_auc(labels, values), abs=1e-12)
    distinct = len(set(values))
    assert len(points) <= distinct + 1


def test_report_without_predictions_is_zero_not_missing(spark):
    frame = scores(spark, [0, 1, 1], [0.1, 0.2, 0.5])  # 0.5 is not above the threshold
    metrics = evaluation.classification_metrics(frame, "y", "p").first()
    assert metrics.Precision == 0 and metrics.Recall == 0 and metrics.F1 == 0
    assert metrics.Accuracy == pytest.approx(0.3333)
    report = {r.Class: r for r in evaluation.classification_report(frame, "y", "p").collect()}
    assert report["Active"].Recall == 1 and report["Churned"].Support == 2
    assert report["macro avg"].Recall == 0.5
    matrix = evaluation.confusion_matrix(frame, "y", "p").collect()
    assert [tuple(r) for r in matrix] == [(0, 0, 1), (0, 1, 0), (1, 0, 2), (1, 1, 0)]


def test_logistic_minimum_has_no_slope(labelled):
    """At the fit, sum of w * (p - y) * x + beta is 0 for every coefficient."""
    model, scaler = cm.fit_logistic(labelled)
    frame = scaler.apply(labelled).toPandas()
    x = frame[list(cf.FEATURES)].to_numpy(float)
    y = frame["Churned"].to_numpy(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    assert np.abs(x.T @ (weight * (p - y)) + beta).max() < 0.05
    assert abs((weight * (p - y)).sum()) < 0.05


def test_models_beat_a_coin_and_keep_every_row(labelled):
    forest = cm.fit_forest(labelled, trees=20, depth=5)
    boosted = cm.fit_boosted(labelled, rounds=5, depth=3)
    logistic, scaler = cm.fit_logistic(labelled)
    for model, scaled in ((forest, None), (boosted, None), (logistic, scaler)):
        scored = cm.score(model, labelled, scaler=scaled)
        assert scored.columns == [*labelled.columns, "ChurnProbability"]
        assert scored.drop("ChurnProbability").exceptAll(labelled).isEmpty()
        stats = scored.agg(F.min("ChurnProbability"), F.max("ChurnProbability")).first()
        assert 0 <= stats[0] <= stats[1] <= 1
        auc = evaluation.roc_auc(store(scored, "t"), "Churned", "ChurnProbability").first()[0]
        assert auc > 0.6
    importance = cm.feature_importance(forest, labelled).collect()
    assert {r.Feature for r in importance} == set(cf.FEATURES)
    assert sum(r.Importance for r in importance) == pytest.approx(1.0)
    assert [r.Importance for r in importance] == sorted(
        (r.Importance for r in importance), reverse=True
    )


def test_one_class_is_refused(labelled):
    with pytest.raises(ValueError, match="both classes"):
        cm.fit_forest(labelled.filter("Churned = 1"), trees=2)


def test_best_model_is_the_first_of_equals(spark):
    rows = [(0, "a", 0.7), (1, "b", 0.9), (2, "c", 0.9)]
    frame = spark.createDataFrame(rows, ["Position", "Model", "ROC-AUC"])
    assert cm.best_model(frame).first().Model == "b"


def test_comparison_lists_models_in_order(labelled):
    scored = {
        "first": with_formula_score(labelled),
        "second": labelled.withColumn("ChurnProbability", 1.0 / F.col("Frequency")),
    }
    table = cm.model_comparison(scored, "Churned", "ChurnProbability").orderBy("Position")
    assert [r.Model for r in table.collect()] == ["first", "second"]


def test_histories_fold_lines_without_copies_of_them(spark):
    """No line is expanded per distinct count; missing invoices and products count for nothing."""
    day, late = datetime(2020, 1, 1), datetime(2021, 1, 1)
    rows = [
        (1, "a", "x", 2, day, Decimal("1.5")), (1, "a", "x", 4, day, Decimal("2.5")),
        (1, None, "y", None, day, None), (1, "b", None, 3, late, Decimal("9")),
        (None, "c", "x", 5, day, Decimal("4")),
    ]
    lines = spark.createDataFrame(
        rows, "CustomerID long, InvoiceNo string, StockCode string, Quantity int, InvoiceDate timestamp_ntz,"
        " TotalPrice decimal(20,4)"
    )
    found = cf.churn_dataset(lines)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.CustomerID: r for r in found.collect()}
    one = got[1]
    assert (one.Frequency, one.UniqueProducts, one.AvgQuantity, one.Churned) == (1, 2, 3.0, 0)
    assert one.Monetary == 4 and found.schema["Monetary"].dataType.precision == 30
    assert (got[None].Frequency, got[None].Monetary, got[None].Churned) == (1, 4, 1)
