"""Exact quantiles, scalers, linear fits and permutation importance against numpy."""
import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalar
from tickloom.plans import linear, models, scaling

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def quantiles(df, columns, by=(), rows=scaling.SORTED):
    got = scaling.exact_quantiles(df, columns, PROBS, by, rows).collect()
    return {tuple(r[k] for k in [*by, "feature", "p"]): r["value"] for r in got}


@pytest.mark.parametrize("rows", [5, 200_000])
def test_quantiles_of_heavy_tails_copies_and_groups(spark, rows):
    draw = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": draw.choice(["a", "b", "c"], 3000, p=[.9, .09, .01]), "x": draw.standard_cauchy(3000) ** 3,
                        "y": np.where(draw.random(3000) < .35, 7.0, draw.normal(size=3000)), "z": draw.integers(0, 3, 3000).astype(float)})
    pdf.loc[:40, "x"] = None
    pdf.loc[:3, "y"] = [1.7e308, -1.7e308, 1e-320, 0.0]
    df = spark.createDataFrame(pdf).repartition(5).withColumn("g", F.when(F.col("g") != "c", F.col("g")))
    got = quantiles(df, ["x", "y", "z"], ["g"], rows)
    assert len(got) == 3 * 3 * len(PROBS)
    for g in ("a", "b", "c"):
        for c in "xyz":
            vals = pdf[pdf["g"] == g][c].dropna().to_numpy()
            for p in PROBS:
                lo, hi = np.sort(vals)[[int(np.floor(p * (len(vals) - 1))), int(np.ceil(p * (len(vals) - 1)))]]
                t = p * (len(vals) - 1) % 1
                assert got[None if g == "c" else g, c, p] == pytest.approx(lo * (1 - t) + hi * t if lo != hi else lo, rel=1e-12)


def test_quantiles_without_groups_or_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None), (float("inf"), None)], "x double, y double")
    got = quantiles(df, ["x", "y"])
    assert got[("x", 0.5)] == 1.5 and not any(k[0] == "y" for k in got)
    assert quantiles(df.limit(0), ["x"]) == {}
    tiny = spark.createDataFrame([(x,) for x in [0.0] * 9 + [5e-324] * 9], "x double")
    assert quantiles(tiny, ["x"], rows=2)[("x", 0.75)] == 5e-324


def test_scaled_columns(spark):
    draw = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 50, "x": draw.normal(size=100), "flat": 3.0})
    df = spark.createDataFrame(pdf)
    out = scaling.scaled_columns(df, scaling.scales(df, ["x", "flat"], ["g"]), ["x", "flat"], ["g"]).toPandas()
    for g, part in out.groupby("g"):
        x = part["x"]
        q1, q2, q3 = np.percentile(x, [25, 50, 75])
        assert np.allclose(part["robust_x"], (x - q2) / (q3 - q1)) and np.allclose(part["standard_x"], (x - x.mean()) / x.std(ddof=0))
    assert (out["robust_flat"] == 0).all() and (out["standard_flat"] == 0).all()
    assert list(out.columns) == ["g", "x", "flat", "robust_x", "robust_flat", "standard_x", "standard_flat"]
    whole = scaling.scaled_columns(df, scaling.scales(df, ["x"]), ["x"]).toPandas()
    assert np.allclose(whole["standard_x"], (whole["x"] - whole["x"].mean()) / whole["x"].std(ddof=0))


def linear_rows(n=600):
    draw = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, "a", "b"), "key": [f"k{i}" for i in range(n)], "x1": draw.normal(size=n) * 5 + 1000,
                        "x2": draw.normal(size=n), "x3": draw.normal(size=n) * 0.01, "flat": 1.0})
    pdf["y"] = 2 * pdf["x1"] - 30 * pdf["x2"] * np.where(pdf["g"] == "a", 1, -1) + draw.normal(size=n) * 3
    return pdf


def coefficients(model, *group):
    return {r["feature"]: r["coefficient"] for r in model.collect() if not group or r["g"] == group[0]}


def test_least_squares_by_group(spark):
    pdf = linear_rows()
    holes = pd.concat([pdf, pd.DataFrame({"g": ["a", "b"], "key": ["n1", "n2"], "x1": [None, 1.0], "x2": 1.0, "x3": 1.0, "flat": 1.0, "y": [1.0, np.inf]})])
    model = linear.fit_linear(spark.createDataFrame(holes), ["x1", "x2", "x3", "flat"], "y", ["g"])
    for g, part in pdf.groupby("g"):
        a = np.c_[part[["x1", "x2", "x3"]], np.ones(len(part))]
        want = np.linalg.lstsq(a, part["y"], rcond=None)[0]
        got = coefficients(model, g)
        assert np.allclose([got["x1"], got["x2"], got["x3"], got["intercept"]], want, rtol=1e-6) and got["flat"] == 0
    one = linear.fit_linear(spark.createDataFrame(pdf), ["x1"], "y")
    assert coefficients(one)["x1"] == pytest.approx(np.polyfit(pdf["x1"], pdf["y"], 1)[0])
    assert linear.fit_linear(spark.createDataFrame(pdf).limit(0), ["x1"], "y", ["g"]).count() == 0


def test_elastic_net_is_that_of_the_regressor(spark):
    from pyspark.ml.regression import LinearRegression
    from tickloom.plans import models
    pdf = linear_rows()
    df = spark.createDataFrame(pdf)
    got = coefficients(linear.fit_linear(df, ["x1", "x2", "x3"], "y", penalty=0.1, l1_ratio=0.5))
    want = LinearRegression(labelCol="y", featuresCol="raw", elasticNetParam=0.5, regParam=0.1, tol=1e-12, maxIter=1000).fit(
        models.assemble(df, ["x1", "x2", "x3"]))
    assert np.allclose([got["x1"], got["x2"], got["x3"]], want.coefficients.toArray(), rtol=1e-4, atol=1e-6)
    assert got["intercept"] == pytest.approx(want.intercept, rel=1e-4)


def test_permutation_importance(spark, monkeypatch):
    monkeypatch.setattr(linear, "BUCKET", 3)
    pdf = linear_rows(300)
    df = spark.createDataFrame(pdf).repartition(6)
    names = ["x1", "x2", "x3"]
    model = linear.fit_linear(df, names, "y", ["g"])
    got = {(r["g"], r["feature"]): r["importance"] for r in linear.permutation_importance(
        df, names, "y", lambda d: linear.predict_linear(d, model, names, ["g"]), F.col("key"), ["g"]).collect()}
    order = lambda part, seed: part.iloc[np.argsort([hashlib.md5(f"{seed}|{k}".encode()).hexdigest() for k in part["key"]])]
    for g, part in pdf.groupby("g"):
        c = coefficients(model, g)
        mine, other = order(part, 42), order(part, 43)
        guess = lambda d: sum(c[f] * d[f].to_numpy() for f in names) + c["intercept"]
        base = np.mean((mine["y"].to_numpy() - guess(mine)) ** 2)
        for f in names:
            moved = mine.assign(**{f: other[f].to_numpy()})
            assert got[g, f] == pytest.approx(np.mean((mine["y"].to_numpy() - guess(moved)) ** 2) - base, rel=1e-6, abs=1e-9)
        assert got[g, "x3"] < got[g, "x1"] and got[g, "x3"] < got[g, "x2"]


def test_correlation_with_a_side_that_does_not_vary(spark):
    rows = [(float(i), 0.7, 3.0 * i, None if i == 3 else float(-i)) for i in range(6)]
    df = spark.createDataFrame(rows, "prediction double, confidence double, actual double, part double").repartition(3)
    assert math.isnan(models.confidence_correlation(df).first().correlation)
    assert models.confidence_correlation(df.limit(0)).first().correlation is None
    scores = {r.feature: r.score for r in models.correlation_scores(df, ["prediction", "confidence", "part"], "actual").collect()}
    want = abs(np.corrcoef([0.0, -1, -2, 0, -4, -5], [r[2] for r in rows])[0, 1])
    assert scores["confidence"] == 0 and abs(scores["prediction"] - 1) < 1e-12 and abs(scores["part"] - want) < 1e-12
    pairs = df.agg(scalar.pearson("part", "actual").alias("c")).first().c
    assert abs(pairs + 1) < 1e-12
