"""Exponential means of any smoothing, with nulls anywhere, against pandas."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import ewm as module
from tickloom.operators.ewm import ewm

SCHEMA = "symbol string, timeframe string, open_time timestamp, x double"


def rows(n, symbol, nulls, seed):
    rng = np.random.default_rng(seed)
    x = 100 + rng.standard_normal(n).cumsum()
    x[rng.random(n) < nulls] = np.nan
    if nulls:
        x[:7] = np.nan
        x[200:900] = np.nan
    return pd.DataFrame({"symbol": symbol, "timeframe": "M1", "open_time": pd.date_range("2024-01-01", periods=n, freq="min"), "x": x})


@pytest.fixture(scope="module")
def series():
    gone = rows(50, "gone", 0, 3)
    gone["x"] = np.nan
    return pd.concat([rows(6000, "full", 0, 1), rows(4000, "holes", 0.3, 2), gone, rows(1, "one", 0, 4)], ignore_index=True)


@pytest.mark.parametrize("alpha, group", [(0.3, 256), (2 / 201, 256), (1e-5, 2), (0.999, 7), (0.9, 256), (1.0, 256)])
def test_equals_pandas(spark, series, monkeypatch, alpha, group):
    monkeypatch.setattr(module, "GROUP", group)
    df = spark.createDataFrame(series, SCHEMA).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).repartition(4)
    got = ewm(df, "x", alpha, "y").toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    assert list(got.columns) == ["symbol", "timeframe", "open_time", "x", "y"]
    want = series.sort_values(["symbol", "open_time"], ignore_index=True)
    want = want.groupby("symbol")["x"].transform(lambda x: x.ewm(alpha=alpha, adjust=False).mean())
    np.testing.assert_allclose(got["y"].astype(float), want, rtol=1e-9, atol=1e-9)


def test_refused_and_empty(spark, series):
    df = spark.createDataFrame(series.head(3), SCHEMA)
    for alpha in (0, -1, 1.5):
        with pytest.raises(ValueError):
            ewm(df, "x", alpha, "y")
    assert ewm(df.limit(0), "x", 0.5, "y").agg(F.count("y")).first()[0] == 0
