"""Granger, OLS, R^2 and directional accuracy against numpy."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickpulse.operators import econ as E


def test_chi2_sf_known_values():
    assert abs(E.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(E.chi2_sf(5.991464547107979, 2) - 0.05) < 1e-9
    assert abs(E.chi2_sf(7.814727903251178, 3) - 0.05) < 1e-9
    assert abs(E.chi2_sf(11.070497693516351, 5) - 0.05) < 1e-9
    assert E.chi2_sf(0.0, 4) == 1.0


def _panel(n=200, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    y = np.zeros(n)
    for t in range(2, n):
        y[t] = 0.3 * y[t - 1] + 0.5 * x[t - 2] + rng.normal(scale=0.5)
    return pd.DataFrame({"symbol": "S", "date": pd.date_range("2020-01-01", periods=n).date,
                         "return": y, "bullishness": x, "agreement": rng.normal(size=n),
                         "msg_volume": rng.normal(size=n)})


def _granger_numpy(y, x, L):
    rows = range(L, len(y))
    Y = np.array([y[t] for t in rows])
    own = np.array([[1.0] + [y[t - k] for k in range(1, L + 1)] for t in rows])
    full = np.array([[1.0] + [y[t - k] for k in range(1, L + 1)] + [x[t - k] for k in range(1, L + 1)] for t in rows])
    ssr_r = float(np.sum((Y - own @ np.linalg.lstsq(own, Y, rcond=None)[0]) ** 2))
    ssr_u = float(np.sum((Y - full @ np.linalg.lstsq(full, Y, rcond=None)[0]) ** 2))
    stat = len(Y) * (ssr_r - ssr_u) / ssr_u
    return stat, E.chi2_sf(stat, L)


def test_granger_matches_numpy(spark):
    pdf = _panel()
    got = E.granger_pvalues(spark.createDataFrame(pdf)).collect()
    assert len(got) == 15
    for r in got:
        stat, p = _granger_numpy(pdf["return"].to_numpy(), pdf[r["feature"]].to_numpy(), r["lag"])
        assert r["n_obs"] == len(pdf) - r["lag"]
        assert math.isclose(r["chi2"], stat, rel_tol=1e-6, abs_tol=1e-9)
        assert math.isclose(r["p_value"], p, rel_tol=1e-6, abs_tol=1e-12)
    strong = [r for r in got if r["feature"] == "bullishness" and r["lag"] == 2][0]
    assert strong["p_value"] < 1e-6


def test_ols_predict_r2_diracc_match_numpy(spark):
    rng = np.random.default_rng(5)
    n = 120
    X = rng.normal(size=(n, 3))
    y = 1.5 + X @ np.array([0.5, -2.0, 0.25]) + rng.normal(scale=0.1, size=n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(y=y, g="G")
    df = spark.createDataFrame(pdf)
    coefs = E.ols_by_group(df, ["g"], ["a", "b", "c"], "y")
    beta = np.linalg.lstsq(np.c_[np.ones(n), X], y, rcond=None)[0]
    r = coefs.first()
    assert np.allclose([r["intercept"], r["coef_a"], r["coef_b"], r["coef_c"]], beta, atol=1e-9)
    pred = E.predict(df, coefs, ["g"], ["a", "b", "c"])
    m = pred.agg(E.r2_score("y", "prediction").alias("r2"),
                 E.directional_accuracy("y", "prediction").alias("da")).first()
    yhat = np.c_[np.ones(n), X] @ beta
    r2 = 1 - np.sum((y - yhat) ** 2) / np.sum((y - y.mean()) ** 2)
    assert abs(m["r2"] - r2) < 1e-9
    assert abs(m["da"] - np.mean(np.sign(yhat) == np.sign(y))) < 1e-12


def test_singular_design_has_the_shortest_fit(spark):
    df = spark.createDataFrame([("G", 1.0, 1.0, 2.0), ("G", 2.0, 2.0, 3.0), ("G", 3.0, 3.0, 5.0)],
                               "g string, a double, b double, y double")
    r = E.ols_by_group(df, ["g"], ["a", "b"], "y").first()
    beta = np.linalg.lstsq(np.array([[-1.0, -1.0], [0.0, 0.0], [1.0, 1.0]]), np.array([2.0, 3.0, 5.0]), rcond=None)[0]
    assert abs(r["coef_a"] - beta[0]) < 1e-9 and abs(r["coef_b"] - beta[1]) < 1e-9
    assert abs(r["intercept"] - (10 / 3 - 2 * beta.sum())) < 1e-9


def test_chrono_split_75_percent(spark):
    df = spark.range(8).select(F.lit("S").alias("symbol"), F.col("id").alias("date"))
    got = [r["split"] for r in E.chrono_split(df).orderBy("date").collect()]
    assert got == ["train"] * 6 + ["test"] * 2


def test_ols_well_conditioned_with_large_offsets(spark):
    rng = np.random.default_rng(9)
    n = 400
    x = 1e7 + rng.normal(size=n)
    y = 5.0 + 3.0 * (x - 1e7) + rng.normal(scale=0.01, size=n)
    pdf = pd.DataFrame({"g": "G", "x": x, "y": y})
    r = E.ols_by_group(spark.createDataFrame(pdf), ["g"], ["x"], "y").first()
    beta = np.linalg.lstsq(np.c_[np.ones(n), x - x.mean()], y, rcond=None)[0]
    assert abs(r["coef_x"] - beta[1]) < 1e-6
    assert abs(r["intercept"] - (beta[0] - beta[1] * x.mean())) / abs(beta[1] * x.mean()) < 1e-9


def test_grouped_solves_equal_single_series_runs(spark):
    from tickpulse.sources import testviews as V
    d = "/root/testdata/sf0.001"
    panel = E.daily_panel(V.bars_by_priority_v(spark, d), V.label_corpus_by_priority_v(spark, d)).cache()
    allg = {(r["symbol"], r["feature"], r["lag"]): r["p_value"] for r in E.granger_pvalues(panel).collect()}
    sym = sorted({k[0] for k in allg})[0]
    one = {(r["symbol"], r["feature"], r["lag"]): r["p_value"]
           for r in E.granger_pvalues(panel.filter(F.col("symbol") == sym)).collect()}
    assert one and all(math.isclose(allg[k], v, rel_tol=1e-9, abs_tol=1e-12) for k, v in one.items())
    panel.unpersist()
