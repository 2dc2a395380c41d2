from datetime import datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from shoplens.functions import expressions as ex
from shoplens.operators import cleaning, exploration
from shoplens.sources.schemas import CLEAN, RAW

NOON = datetime(2011, 12, 1, 12, 0)


def line(invoice="536365", code="85123A", text="MUG", quantity=2, date=NOON, price="2.55",
         customer=17850, country="United Kingdom"):
    return (invoice, code, text, quantity, date, Decimal(price), customer, country)


def test_rules_keep_and_drop(spark):
    rows = {
        "kept": line(),
        "lower-case prefix kept": line(invoice="c123"),
        "cancelled": line(invoice="C536379"),
        "adjusted": line(invoice="A563185"),
        "service code in lower case": line(code="post"),
        "bank charges": line(code="Bank Charges"),
        "code that only starts with D": line(code="DOTCOM"),
        "zero price": line(price="0.00"),
        "negative quantity": line(quantity=-1),
        "no customer": line(customer=None),
    }
    raw = spark.createDataFrame(list(rows.values()), RAW)
    kept = cleaning.clean_transactions(raw).select("InvoiceNo", "StockCode").collect()
    assert sorted(map(tuple, kept)) == [
        ("536365", "85123A"),
        ("536365", "DOTCOM"),
        ("c123", "85123A"),
    ]


def test_null_descriptions_are_duplicates(spark):
    raw = spark.createDataFrame([line(text=None), line(text=None), line()], RAW)
    assert cleaning.clean_transactions(raw).count() == 2


def test_total_price_is_exact(spark):
    raw = spark.createDataFrame([line(quantity=3, price="0.10")], RAW)
    assert cleaning.clean_transactions(raw).first().TotalPrice == Decimal("0.30")


def test_cleaning_is_idempotent(spark, clean):
    again = cleaning.clean_transactions(clean.drop("TotalPrice"))
    assert again.exceptAll(clean).isEmpty() and again.count() == clean.count()


def test_funnel_adds_up(spark):
    raw = spark.createDataFrame(
        [line(), line(), line(customer=None), line(invoice="C1"), line(code="m"),
         line(quantity=0), line(invoice="C2", customer=None)],
        RAW,
    )
    rows = cleaning.cleaning_funnel(raw).orderBy("StepNo").collect()
    assert [r.RowsBefore for r in rows] == [7, 5, 4, 3, 2]
    assert [r.RowsRemoved for r in rows] == [2, 1, 1, 1, 1]
    assert [r.RowsAfter for r in rows] == [5, 4, 3, 2, 1]


def test_empty_input(spark):
    raw = spark.createDataFrame([], RAW)
    assert cleaning.clean_transactions(raw).count() == 0
    assert [r.RowsAfter for r in cleaning.cleaning_funnel(raw).collect()] == [0] * 5
    profile = cleaning.clean_profile(cleaning.clean_transactions(raw)).first()
    assert profile.Rows == 0 and profile.Customers == 0


def test_cast_types_nulls_what_does_not_parse(spark):
    text = spark.createDataFrame(
        [("1", "x", "d", "many", "2011-01-02 03:04:05", "1.50", "12", "UK")], RAW.names
    )
    row = cleaning.cast_types(text).first()
    assert row.Quantity is None and row.UnitPrice == Decimal("1.50")
    assert row.InvoiceDate == datetime(2011, 1, 2, 3, 4, 5)


def test_cast_types_reads_what_spreadsheets_write(spark):
    rows = [
        ("1", "x", "d", "3", "12/1/2010 8:26", "0.001", "17850.0", "UK"),
        ("2", "x", "d", "3", "3/27/2011 2:30", "0.00001", "17850.5", "UK"),
        ("3", "x", "d", "3", "2011-13-45", None, None, "UK"),
    ]
    text = spark.createDataFrame(rows, RAW.names)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # no 02:30 on that day there
    try:
        got = cleaning.cast_types(text, "M/d/yyyy H:mm").collect()
        lost = cleaning.cast_losses(text, "M/d/yyyy H:mm").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.CustomerID for r in got] == [17850, None, None]
    assert [r.UnitPrice for r in got] == [Decimal("0.0010"), None, None]
    assert [r.InvoiceDate for r in got] == [
        datetime(2010, 12, 1, 8, 26), datetime(2011, 3, 27, 2, 30), None,
    ]
    assert {r.Column: r.Lost for r in lost if r.Lost} == {
        "CustomerID": 1, "UnitPrice": 1, "InvoiceDate": 1,
    }


def test_whole_days_are_elapsed_days(spark):
    row = spark.sql(
        "SELECT TIMESTAMP_NTZ '2011-12-10 12:50:00' AS b, TIMESTAMP_NTZ '2011-12-09 23:00:00' AS a"
    ).select(ex.whole_days(F.col("b"), F.col("a")).alias("d"))
    assert row.first().d == 0


@pytest.mark.parametrize("value,rounded", [(1.005, 1.0), (0.125, 0.12), (2.675, 2.68)])
def test_half_even(spark, value, rounded):
    frame = spark.createDataFrame([(value,)], "x double")
    assert frame.select(ex.half_even(F.col("x"), 2)).first()[0] == rounded


def sales(spark, *rows):
    """Rows of (invoice, date, customer, country, total)."""
    return spark.createDataFrame(
        [(i, "p", "d", 1, d, Decimal("1.00"), c, k, Decimal(t)) for i, d, c, k, t in rows], CLEAN
    )


def test_empty_month_is_zero(spark):
    frame = sales(
        spark,
        ("1", datetime(2011, 1, 5), 1, "UK", "10.00"),
        ("2", datetime(2011, 3, 31, 23), 1, "UK", "5.00"),
        ("3", datetime(2011, 3, 1), 1, "UK", "1.00"),
    )
    rows = exploration.monthly_revenue(frame).collect()
    assert [(str(r.MonthEnd), float(r.Revenue)) for r in rows] == [
        ("2011-01-31", 10.0), ("2011-02-28", 0.0), ("2011-03-31", 6.0),
    ]


def test_absent_home_country_has_no_share(spark):
    frame = sales(spark, ("1", datetime(2011, 1, 5), 1, "France", "10.00"))
    assert exploration.home_country_share(frame, "United Kingdom").first()[0] == 0.0


def test_histogram_upper_edge_is_in_the_last_bin(spark):
    frame = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    rows = exploration.histogram(frame, "x", 5).orderBy("Bin").collect()
    assert [r.Rows for r in rows] == [2, 2, 2, 2, 3]
    assert rows[-1].BinEnd == 10.0


def test_histogram_of_one_value(spark):
    frame = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert sum(r.Rows for r in exploration.histogram(frame, "x", 10).collect()) == 4


def test_describe_equals_pandas(spark, clean, clean_pandas):
    described = exploration.describe_table(clean, ["Quantity", "TotalPrice"]).toPandas()
    expected = clean_pandas[["Quantity", "TotalPrice"]].describe().T
    for i, name in enumerate(["Quantity", "TotalPrice"]):
        got = described.iloc[i][["Count", "Mean", "Std", "Min", "P25", "P50", "P75", "Max"]]
        assert list(got) == pytest.approx(list(expected.loc[name]), rel=1e-12)


def test_value_counts_skip_missing(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in exploration.value_counts(frame, "x", "n").collect()] == [
        ("b", 2), ("a", 1),
    ]


def test_monthly_equals_pandas(clean, clean_pandas):
    got = exploration.monthly_revenue(clean).toPandas()
    expected = clean_pandas.set_index("InvoiceDate")["TotalPrice"].resample("ME").sum()
    assert list(pd.to_datetime(got["MonthEnd"])) == list(expected.index)
    assert list(got["Revenue"].astype(float)) == pytest.approx(list(expected), rel=1e-12)
