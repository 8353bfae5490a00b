"""Blocked frames against pandas on a series longer than several blocks."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import outcome
from tickloom.operators.asof import context_at, last_bars
from tickloom.operators.indicators import stored_indicators
from tickloom.operators.sequence import BLOCK_ROWS, running_total
from tickloom.plans.features import bar_features, forward_fill

ROWS = 2 * BLOCK_ROWS + 1500


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(5)
    gaps = rng.integers(1, 4, ROWS)  # bars are not contiguous
    t = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(gaps), unit="min")
    close = 100 + np.cumsum(rng.normal(0, 0.3, ROWS))
    open_ = close + rng.normal(0, 0.1, ROWS)
    high = np.maximum(open_, close) + rng.random(ROWS) * 0.2
    low = np.minimum(open_, close) - rng.random(ROWS) * 0.2
    return pd.DataFrame({"symbol": "X", "timeframe": "M1", "open_time": t, "open_price": open_, "high_price": high,
                         "low_price": low, "close_price": close, "volume": rng.integers(1, 50, ROWS)})


@pytest.fixture(scope="module")
def bars(spark, series):
    return spark.createDataFrame(series).repartition(8)


def in_order(df):
    return df.toPandas().sort_values("open_time").reset_index(drop=True)


def close_to(got, want):
    got, want = got.to_numpy(dtype=float), want.to_numpy(dtype=float)
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.nanmax(np.abs(got - want)) < 1e-8


def rma(x):
    return x.ewm(alpha=1 / 14, adjust=False).mean()


def test_indicators_equal_pandas(bars, series):
    got = in_order(stored_indicators(bars))
    h, l, c, v = (series[x] for x in ("high_price", "low_price", "close_price", "volume"))
    pc = c.shift()
    tr = pd.concat([h - l, (h - pc).abs(), (l - pc).abs()], axis=1).max(axis=1)
    close_to(got["atr"], rma(tr))
    up, down = h.diff(), -l.diff()
    plus = rma(pd.Series(np.where((up > 0) & (up > down), up, 0.0))) * 100 / rma(tr)
    minus = rma(pd.Series(np.where((down > 0) & (down > up), down, 0.0))) * 100 / rma(tr)
    close_to(got["adx"], rma(100 * (plus - minus).abs() / (plus + minus).replace(0, np.nan)))
    macd = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    close_to(got["macd"], macd)
    close_to(got["macd_signal"], macd.ewm(span=9, adjust=False).mean())
    close_to(got["ema"], c.ewm(span=20, adjust=False).mean())
    d = c.diff()
    close_to(got["rsi"], 100 - 100 / (1 + rma(d.clip(lower=0)) / rma(-d.clip(upper=0)).replace(0, np.nan)))
    close_to(got["obv"], (np.sign(d).fillna(0) * v).cumsum())
    close_to(got["bb_upper"], c.rolling(20).mean() + 2 * c.rolling(20).std())
    tp = (h + l + c) / 3
    mad = tp.rolling(20).apply(lambda x: np.mean(np.abs(x - np.mean(x))), raw=True)
    close_to(got["cci"], (tp - tp.rolling(20).mean()) / (0.015 * mad))
    k = 100 * (c - l.rolling(14).min()) / (h.rolling(14).max() - l.rolling(14).min())
    close_to(got["stochastic_d"], k.rolling(3).mean())
    # bounds up to floating point: a one-sided DX is 100 * p / p, which may round to 100.00000000000001
    for name in ("rsi", "adx"):
        assert got[name].dropna().between(-1e-9, 100 + 1e-9).all()


def test_running_total_and_fill(bars, series):
    total = in_order(running_total(bars, F.col("volume"), "total"))
    assert (total["total"] == series["volume"].cumsum()).all()
    holes = bars.withColumn("x", F.when(F.col("volume") > 48, F.col("close_price")))
    filled = in_order(forward_fill(holes, {"x": "y"}))["y"]
    want = series["close_price"].where(series["volume"] > 48).ffill().fillna(0)
    close_to(filled, want)


def test_feature_columns(bars, series):
    got = in_order(bar_features(bars, ["sma_50_ratio", "volume_ratio", "realized_vol_20"]))
    c = series["close_price"]
    close_to(got["sma_50_ratio"], c / c.rolling(50).mean() - 1)
    close_to(got["volume_ratio"], series["volume"] / series["volume"].rolling(20).mean())
    close_to(got["realized_vol_20"], np.log(c / c.shift()).rolling(20).std())


def test_row_targets(bars, series):
    got = in_order(outcome.row_targets(bars, 60))
    high = series["high_price"][::-1].rolling(60).max()[::-1].shift(-1)
    want = ((high - series["close_price"]) / series["close_price"] * 100).dropna().reset_index(drop=True)
    close_to(got["target_gain"], want)


def test_forward_and_trailing_frames(bars, series):
    got = in_order(outcome.forward_stats(bars))
    t = series["open_time"].to_numpy()
    hi = series["high_price"].to_numpy()
    first = np.searchsorted(t, t, side="right")
    last = np.searchsorted(t, t + np.timedelta64(3600, "s"), side="right")
    want = [hi[a:b].max() if b > a else np.nan for a, b in zip(first, last)]
    close_to(got["fwd_high"], pd.Series(want))
    assert (got["fwd_bars"] == last - first).all()
    vol = in_order(outcome.day_volume(bars))
    start = np.searchsorted(t, t - np.timedelta64(86400, "s"), side="right")
    sums = np.concatenate([[0], series["volume"].cumsum()])
    assert (vol["volume_24h"].to_numpy() == sums[np.arange(ROWS) + 1] - sums[start]).all()


def test_last_bars_differ_by_timeframe(bars, spark, series):
    two = bars.unionByName(bars.withColumn("timeframe", F.lit("M5")))
    got = last_bars(two, {"M1": 60, "M5": 7}, ["close_price"]).select("timeframe", "open_time", F.size("candles").alias("n"))
    sizes = got.groupBy("timeframe", "n").count().toPandas().set_index(["timeframe", "n"])["count"]
    assert sizes["M1", 60] == ROWS - 59 and sizes["M5", 7] == ROWS - 6 and sizes["M1", 1] == 1


def test_no_candle_after_the_point(bars, spark):
    points = bars.select("symbol", F.col("open_time").alias("at"))
    for visible, gap in (("open", 0), ("closed", 60)):
        rows = context_at(points, bars, ["open_time"], {"M1": 5}, visible)
        late = rows.where(F.unix_seconds("at") - F.unix_seconds(F.element_at("candles", -1)["open_time"]) < gap)
        assert late.count() == 0
