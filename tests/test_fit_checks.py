"""The check queries of the fits must fail when a fit is broken."""

import pytest
from shoplens.operators import churn_models as cm
from shoplens.operators import clustering
from shoplens.operators import lifetime_value as lv
from shoplens.plans import registry


@pytest.fixture(autouse=True)
def cleaned(clean, monkeypatch):
    monkeypatch.setattr(registry, "clean_of", lambda *_: clean)
    monkeypatch.setattr(registry, "stored_clean", lambda *_: clean)


def test_a_worse_purchase_model_is_not_at_its_best(spark, folder, monkeypatch):
    fit = lv.fit_bgnbd

    def off(summary):
        model, table = fit(summary)
        return lv.BgNbd(model.r * 1.3, model.alpha, model.a, model.b), table

    monkeypatch.setattr(lv, "fit_bgnbd", off)
    found = {r.Model: r.AtBest for r in registry.QUERIES["lifetime_fit_check"](spark, folder).collect()}
    assert found == {"purchases": False, "spend": True}


def test_misplaced_centers_cost_more(spark, folder, monkeypatch):
    far = [[9.0, 9.0, float(i)] for i in range(4)]
    monkeypatch.setattr(clustering, "fit_centers", lambda *_: far)
    monkeypatch.setattr(clustering, "RESTARTS", 1)
    assert not registry.QUERIES["kmeans_check"](spark, folder).first().NotAboveFixed


def test_an_unfinished_regression_is_not_flat(spark, folder, monkeypatch):
    fit = cm.fit_logistic
    monkeypatch.setattr(cm, "fit_logistic", lambda train: fit(train, max_iter=1))
    rows = registry.QUERIES["logreg_gradient_check"](spark, folder).collect()
    assert not all(r.Flat for r in rows)
