import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from shoplens.functions import special
from shoplens.operators import lifetime_value as lv

PURCHASES = lv.BgNbd(0.9, 20.0, 1.6, 4.0)
SPEND = lv.GammaGamma(6.0, 4.0, 15.0)


@pytest.mark.parametrize("x", [1e-9, 1e-3, 0.5, 1.0, 2.0, 9.99, 10.0, 123.4, 1e6])
def test_gammaln_and_digamma(x):
    assert special.gammaln(x) == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-12)
    step = 1e-5 * x
    slope = (math.lgamma(x + step) - math.lgamma(x - step)) / (2 * step)
    assert special.digamma(x) == pytest.approx(slope, rel=1e-5, abs=1e-7)


def test_hyp2f1_known_values():
    z = np.array([0.0, 0.3, 0.9])
    assert special.hyp2f1(2.0, 3.0, 3.0, z) == pytest.approx((1 - z) ** -2.0, rel=1e-12)
    logs = special.hyp2f1(1.0, 1.0, 2.0, z[1:])
    assert logs == pytest.approx(-np.log(1 - z[1:]) / z[1:], rel=1e-12)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, 50).astype(float)
    age = rng.uniform(50, 300, 50)
    recency = np.where(x > 0, age * rng.random(50), 0.0)
    spend = rng.uniform(5, 80, 50)
    cases = [
        (lv.bgnbd_log_likelihood, np.array([0.9, 20.0, 1.6, 4.0]), (x, recency, age)),
        (lv.gamma_gamma_log_likelihood, np.array([6.0, 4.0, 15.0]), (x + 1, spend)),
    ]
    for likelihood, theta, inputs in cases:
        _, gradient = likelihood(theta, *inputs)
        for j in range(len(theta)):
            step = np.eye(len(theta))[j] * 1e-6 * theta[j]
            slope = (likelihood(theta + step, *inputs)[0] - likelihood(theta - step, *inputs)[0])
            assert gradient[j] == pytest.approx(slope / (2e-6 * theta[j]), rel=1e-4, abs=1e-6)


def simulate(count, seed=0):
    """Customers who buy at a gamma rate, drop out with a beta chance and spend gamma amounts."""
    rng = np.random.default_rng(seed)
    rate = rng.gamma(PURCHASES.r, 1 / PURCHASES.alpha, count)
    drop = rng.beta(PURCHASES.a, PURCHASES.b, count)
    age = rng.integers(100, 400, count)
    rows = []
    for i in range(count):
        clock, x, last = 0.0, 0, 0.0
        while True:
            clock += rng.exponential(1 / rate[i])
            if clock > age[i]:
                break
            x, last = x + 1, clock
            if rng.random() < drop[i]:
                break
        scale = rng.gamma(SPEND.q, 1 / SPEND.v)
        spend = rng.gamma(SPEND.p * x, 1 / scale) / x if x else 0.0
        rows.append((i, x, last, int(age[i]), spend))
    return pd.DataFrame(rows, columns=["CustomerID", "frequency", "recency", "T", "monetary_value"])


@pytest.fixture(scope="module")
def simulated(spark):
    return spark.createDataFrame(simulate(12_000)).repartition(4).cache()


def test_purchase_fit_recovers_the_parameters(simulated):
    model, table = lv.fit_bgnbd(simulated, penalty=0.0)
    assert model.r == pytest.approx(PURCHASES.r, rel=0.15)
    assert model.alpha == pytest.approx(PURCHASES.alpha, rel=0.2)
    mean_drop = PURCHASES.a / (PURCHASES.a + PURCHASES.b)
    assert model.a / (model.a + model.b) == pytest.approx(mean_drop, rel=0.1)
    rows = {r.Parameter: r for r in table.collect()}
    assert rows["r"].Lower95 < PURCHASES.r < rows["r"].Upper95
    assert all(r.StdErr > 0 for r in rows.values())


def test_spend_fit_recovers_the_parameters(simulated):
    model, table = lv.fit_gamma_gamma(simulated, penalty=0.0)
    mean = SPEND.p * SPEND.v / (SPEND.q - 1)
    assert model.p * model.v / (model.q - 1) == pytest.approx(mean, rel=0.05)
    assert model.q == pytest.approx(SPEND.q, rel=0.2)
    assert table.count() == 3


def test_the_penalty_shrinks_the_fit(simulated):
    free, _ = lv.fit_gamma_gamma(simulated, penalty=0.0)
    held, _ = lv.fit_gamma_gamma(simulated, penalty=0.01)
    size = lambda m: m.p**2 + m.q**2 + m.v**2
    assert size(held) < size(free)


def test_alive_and_forecast_behave(simulated):
    scored = simulated.select(
        "frequency",
        lv.prob_alive(PURCHASES).alias("alive"),
        *[lv.expected_purchases(PURCHASES, h).alias(f"e{h}") for h in (30, 90, 360)],
        lv.clv_12m(PURCHASES, SPEND).alias("clv"),
    ).toPandas()
    assert scored["alive"].between(0, 1).all()
    assert (scored.loc[scored["frequency"] == 0, "alive"] == 1).all()
    assert (scored["e30"] >= 0).all()
    assert (scored["e30"] <= scored["e90"]).all() and (scored["e90"] <= scored["e360"]).all()
    assert (scored["clv"] >= 0).all()


def test_forecast_is_smooth_at_a_equal_one():
    x, age = np.array([0.0, 3.0]), np.array([100.0, 200.0])
    at = [lv._expected_while_alive(lv.BgNbd(0.9, 20.0, a, 4.0), 90, x, age)
          for a in (0.999, 1.0, 1.001)]
    assert at[1] == pytest.approx((at[0] + at[2]) / 2, rel=1e-4)


def test_boundary_parameters_stay_finite():
    x, age = np.array([0.0, 1.0, 9.0]), np.array([300.0, 300.0, 300.0])
    value = lv._expected_while_alive(lv.BgNbd(0.8, 75.0, 1e-8, 1e-8), 75.0, x, age)
    assert np.isfinite(value).all() and (value > 0).all()


@pytest.mark.parametrize(
    "a,b,c,rest",
    [(3.7, 0.6, 4.6, 1e-2), (3.7, 0.6, 4.6, 2e-5), (3.7, 0.6, 9.6, 1e-4), (3.7, 0.6, 400.6, 1e-5),
     (1003.0, 0.6, 1004.6, 1e-2), (2.0, -0.5, 1.2, 1e-5)],
)
def test_series_near_one_equals_the_long_sum(a, b, c, rest):
    n = np.arange(3_000_000)
    expected = 1 + np.cumprod((a + n) * (b + n) / ((c + n) * (1 + n)) * (1 - rest)).sum()
    assert float(special.hyp2f1(a, b, c, 1 - rest, rest)[0]) == pytest.approx(expected, rel=1e-10)


def test_new_customers_do_not_stop_the_forecast():
    x, age = np.array([0.0, 0.0, 3.0, 250.0]), np.array([0.0, 10.0, 0.0, 0.0])
    before = np.zeros(4)
    for alpha in (20.0, 0.05, 0.005, 1e-9):
        value = lv._expected_while_alive(lv.BgNbd(0.9, alpha, 1.6, 4.0), 360.0, x, age)
        assert np.isfinite(value).all() and (value >= before).all()
        before = value


def test_no_errors_at_the_boundary():
    theta = np.array([0.5, 1e-13])
    flat = lv._errors(np.array([[2.0, 0.0], [0.0, 1e-12]]), theta, 100.0)
    assert flat == (pytest.approx(0.5 / np.sqrt(200)), None)
    assert lv._errors(np.array([[1.0, 2.0], [2.0, 1.0]]), theta, 100.0) == (None, None)


def test_summary_equals_pandas(clean, clean_pandas):
    days = clean_pandas.assign(day=clean_pandas["InvoiceDate"].dt.normalize())
    daily = days.groupby(["CustomerID", "day"])["TotalPrice"].sum().reset_index()
    end = daily["day"].max()
    rows = {}
    for customer, group in daily.groupby("CustomerID"):
        group = group.sort_values("day")
        spend = group["TotalPrice"].iloc[1:].mean() if len(group) > 1 else 0.0
        first, last = group["day"].iloc[0], group["day"].iloc[-1]
        rows[customer] = (len(group) - 1, (last - first).days, (end - first).days, spend)
    got = lv.clv_summary_input(clean).collect()
    assert {r.CustomerID for r in got} == set(rows)
    for r in got:
        assert (r.frequency, r.recency, r.T, r.monetary_value) == pytest.approx(rows[r.CustomerID])


def test_one_time_buyers_fall_back_to_spend(spark):
    scored = spark.createDataFrame(
        [(1, 0, float("nan")), (2, 0, -5.0), (3, 2, -1.0), (4, 2, 9.0)],
        "CustomerID long, frequency long, CLV_12m double",
    )
    spend = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "CustomerID long, ActualSpend double")
    got = {r.CustomerID: r.CLV_12m for r in lv.one_time_fallback(scored, spend).collect()}
    assert got == {1: 10.0, 2: 20.0, 3: 0.0, 4: 9.0}
    assert tuple(lv.unstable_clv_count(scored).first()) == (2, 2)


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], "frequency long, recency int, T int, monetary_value double")
    with pytest.raises(ValueError):
        lv.fit_bgnbd(empty)


def test_tiers(spark):
    frame = spark.createDataFrame([(i, float(i)) for i in range(1, 11)], "CustomerID long, CLV_12m double")
    got = lv.clv_tiers(frame).groupBy("CLV_Tier").agg(F.count("*")).collect()
    assert {r[0]: r[1] for r in got} == {"Low Value": 5, "Mid Value": 3, "High Value": 2}
