"""A third of all rows in one customer, one invoice, one product and one copy group."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from shoplens.operators import churn_features as cf
from shoplens.operators import cleaning, exploration, rfm
from shoplens.operators import lifetime_value as lv
from shoplens.sources.schemas import RAW
from shoplens.sources.stages import store

HOT = 1


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    count = 6000
    hot = rng.random(count) < 1 / 3
    customer = np.where(hot, HOT, rng.integers(2, 300, count))
    invoice = np.where(hot, 7, rng.integers(1000, 3000, count))  # one huge invoice
    start = datetime(2011, 1, 1)
    frame = pd.DataFrame(
        {
            "InvoiceNo": invoice.astype(str),
            "StockCode": np.where(hot, "hot", rng.integers(0, 80, count).astype(str)),
            "Description": "thing",
            "Quantity": rng.integers(1, 9, count).astype("int32"),
            "InvoiceDate": [start + timedelta(minutes=int(m)) for m in rng.integers(0, 400_000, count)],
            "UnitPrice": "1.25",
            "CustomerID": customer,
            "Country": np.where(hot, "Hotland", "Elsewhere"),
        }
    )
    copies = frame[frame["CustomerID"] == HOT].head(1)
    frame = pd.concat([frame, *[copies] * 3000], ignore_index=True)  # one group of copies
    raw = cleaning.cast_types(spark.createDataFrame(frame))
    expected = frame.drop_duplicates().assign(
        TotalPrice=lambda x: x["Quantity"] * 1.25
    )
    return store(raw, "skew-raw"), expected


def test_clean_rows(skewed):
    raw, expected = skewed
    assert raw.schema.names == RAW.names
    assert cleaning.clean_transactions(raw).count() == len(expected)
    funnel = cleaning.cleaning_funnel(raw).orderBy("StepNo").collect()
    assert funnel[-1].RowsAfter == len(expected)
    assert funnel[-1].RowsRemoved == raw.count() - len(expected)


def test_customer_tables(skewed):
    raw, expected = skewed
    clean = store(cleaning.clean_transactions(raw), "skew-clean")
    groups = expected.groupby("CustomerID")
    got = rfm.rfm_table(clean).toPandas().set_index("CustomerID").sort_index()
    assert list(got["Frequency"]) == list(groups["InvoiceNo"].nunique())
    assert list(got["Monetary"].astype(float)) == pytest.approx(list(groups["TotalPrice"].sum()))
    features = cf.live_features(clean).toPandas().set_index("CustomerID").sort_index()
    assert list(features["UniqueProducts"]) == list(groups["StockCode"].nunique())
    assert list(features["AvgQuantity"]) == pytest.approx(list(groups["Quantity"].mean()))
    days = expected.assign(day=expected["InvoiceDate"].dt.normalize()).groupby("CustomerID")["day"]
    summary = lv.clv_summary_input(clean).toPandas().set_index("CustomerID").sort_index()
    assert list(summary["frequency"]) == list(days.nunique() - 1)


def test_value_tables(skewed):
    raw, expected = skewed
    clean = store(cleaning.clean_transactions(raw), "skew-clean")
    got = {r.InvoiceNo: float(r.InvoiceValue) for r in exploration.invoice_value(clean).collect()}
    assert got == pytest.approx(expected.groupby("InvoiceNo")["TotalPrice"].sum().to_dict())
    top = exploration.top_countries(clean, 1).first()
    totals = expected.groupby("Country")["TotalPrice"].sum()
    assert float(top.Revenue) == pytest.approx(totals.max())


def test_scores_with_many_ties(skewed):
    """Most customers share a frequency, so ties decide the quintiles."""
    raw, expected = skewed
    table = rfm.rfm_table(cleaning.clean_transactions(raw))
    got = rfm.rfm_segments(table, on_ties="merge").toPandas().sort_values("CustomerID")
    ranks = got["Frequency"].rank(method="first")
    assert list(got["F_Score"]) == list(pd.qcut(ranks, 5, labels=False) + 1)
