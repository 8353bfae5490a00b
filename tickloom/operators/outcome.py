"""One-hour outcomes and trailing range statistics over M1 bars."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.rangejoin import range_join
from tickloom.operators.sequence import block_window, ranged, rolling

HOUR = 3600


def _pct(value, price, digits):
    return F.round(F.try_divide(value - price, price) * 100, digits)


def _ahead(seconds=HOUR, keys=("symbol", "timeframe")):
    return block_window(keys, "_t").rangeBetween(1, seconds)


def forward_stats(m1, seconds=HOUR):
    """Highest high, lowest low and bar count in (t, t + seconds] of every bar."""
    w = _ahead(seconds)
    return ranged(m1, {"fwd_high": F.max("high_price").over(w), "fwd_low": F.min("low_price").over(w),
                       "fwd_bars": F.count(F.lit(1)).over(w)}, ahead=seconds)


def gain_loss(price="close_price", high="fwd_high", low="fwd_low", digits=4):
    """Signed gain / loss in percent; 0.0 without later bars or without a price."""
    p = F.col(price)
    zero = F.lit(0.0)
    gain = F.coalesce(F.when(p > 0, _pct(F.col(high), p, digits)), zero)
    loss = F.coalesce(F.when(p > 0, _pct(F.col(low), p, digits)), zero)
    return gain, loss


def one_sided(price="close_price", high="fwd_high", low="fwd_low", digits=2):
    """Gain only if the high beats the price, loss only if the low is below it; else null."""
    p = F.col(price)
    gain = F.when((p != 0) & (F.col(high) > p), _pct(F.col(high), p, digits))
    loss = F.when((p != 0) & (F.col(low) < p), _pct(F.col(low), p, digits))
    return gain, loss


def snapshot_outcomes(m1, min_bars=60, mode="history"):
    """Outcome columns of every M1 snapshot.

    With fewer than ``min_bars`` later bars the history mode leaves the values
    null, the live mode keeps them and sets prediction_mode.
    """
    gain, loss = gain_loss()
    enough = F.col("fwd_bars") >= min_bars
    pick = (lambda x: F.when(enough, x)) if mode == "history" else (lambda x: x)
    return forward_stats(m1).select(
        "symbol", F.col("open_time").alias("snapshot_time"), "close_price", "high_price", "low_price",
        pick(gain).alias("max_gain_pct_1h"), pick(loss).alias("max_loss_pct_1h"),
        F.col("fwd_bars").alias("calculation_range_minutes"),
        (F.lit(False) if mode == "history" else ~enough).alias("prediction_mode"))


def outcomes_at(snapshots, m1, seconds=HOUR):
    """Outcomes for arbitrary snapshot times (not only bar times): bucketed range join
    to the later bars, aggregated per distinct time and joined back, so equal snapshots each
    keep their row. Needs symbol, snapshot_time, price."""
    at = snapshots.select("symbol", "snapshot_time").distinct()
    pairs = range_join(at, m1.select("symbol", F.col("open_time").alias("_bar"), "high_price", "low_price"),
                       ["symbol"], "snapshot_time", "_bar", 0, seconds)
    ahead = pairs.groupBy("symbol", "snapshot_time").agg(
        F.max("high_price").alias("fwd_high"), F.min("low_price").alias("fwd_low"), F.count("_bar").alias("fwd_bars"))
    out = snapshots.join(ahead, ["symbol", "snapshot_time"], "left").select(*snapshots.columns, "fwd_high", "fwd_low", "fwd_bars")
    return out.withColumn("fwd_bars", F.coalesce("fwd_bars", F.lit(0)))


def trailing_ranges(m1):
    """High-low span of [t-1h, t] and [t-4h, t], both ends included, 2 decimals."""
    w1 = block_window(order="_t").rangeBetween(-HOUR, 0)
    w4 = block_window(order="_t").rangeBetween(-4 * HOUR, 0)
    span = lambda w: F.round(F.max("high_price").over(w) - F.min("low_price").over(w), 2)
    return ranged(m1, {"price_range_1h": span(w1), "price_range_4h": span(w4)}, back=4 * HOUR)


def day_volume(m1):
    """Volume in (t-24h, t]; 0 becomes null. Two growing frames instead of a sliding
    one: linear in the rows of a block, exact for whole-number volumes."""
    w = block_window(order="_t")
    upto = lambda end: F.coalesce(F.sum("volume").over(w.rangeBetween(Window.unboundedPreceding, end)), F.lit(0))
    total = upto(0) - upto(-24 * HOUR)
    return ranged(m1, {"volume_24h": F.when(total != 0, total)}, back=24 * HOUR, width=4 * 86400)


def close_deviation(m5):
    """Population deviation of the non-zero closes in (t-4h, t], 5 decimals, needs two."""
    w = block_window(order="_t").rangeBetween(-(4 * HOUR - 1), 0)
    x = F.when(F.col("close_price") != 0, F.col("close_price"))
    return ranged(m5, {"volatility_4h": F.when(F.count(x).over(w) > 1, F.round(F.stddev_pop(x).over(w), 5))},
                  back=4 * HOUR)


def row_targets(bars, n=60):
    """Gain / loss targets over the next ``n`` rows; rows without ``n`` later rows are dropped."""
    w = block_window().rowsBetween(1, n)
    p = F.col("close_price")
    out = rolling(bars, {"_later": F.count(F.lit(1)).over(w), "_high": F.max("high_price").over(w),
                         "_low": F.min("low_price").over(w)}, halo=0, after=n)
    return (out.where(F.col("_later") == n)
            .withColumn("target_gain", F.try_divide(F.col("_high") - p, p) * 100)
            .withColumn("target_loss", F.try_divide(F.col("_low") - p, p) * 100)
            .drop("_later", "_high", "_low"))
