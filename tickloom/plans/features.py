"""Feature columns over bars (row frames in bounded blocks)."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.classify import session_flags
from tickloom.operators.asof import asof_join
from tickloom.operators.indicators import ratio
from tickloom.operators.sequence import (BLOCK_ROWS, SERIES, block_window, drop_halo, full, join_blocks, row_blocks, rows_back,
                                         tf_seconds, time_block, with_row_index)


def O():
    return F.col("open_price")


def H():
    return F.col("high_price")


def L():
    return F.col("low_price")


def C():
    return F.col("close_price")


def V():
    return F.col("volume")


def _mean(x, n):
    return full(F.avg(x), x, rows_back(n), n)


def _simple_rsi():
    gain, loss = _mean("_gain", 14), _mean("_loss", 14)
    return (F.when((loss == 0) & (gain > 0), 100.0)
            .otherwise(100 - ratio(F.lit(100.0), 1 + ratio(gain, F.when(loss != 0, loss)))))


# name -> expression over a frame of row blocks carrying _delta, _gain, _loss, _log_return
EXPRESSIONS = {
    "price_change": lambda: ratio(C() - O(), O()) * 100,
    "high_low_ratio": lambda: ratio(H() - L(), L()) * 100,
    "body_size": lambda: ratio(F.abs(C() - O()), O()) * 100,
    "upper_shadow": lambda: ratio(H() - F.greatest(O(), C()), O()) * 100,
    "lower_shadow": lambda: ratio(F.least(O(), C()) - L(), O()) * 100,
    "sma_5_ratio": lambda: ratio(C(), _mean("close_price", 5)) - 1,
    "sma_10_ratio": lambda: ratio(C(), _mean("close_price", 10)) - 1,
    "sma_20_ratio": lambda: ratio(C(), _mean("close_price", 20)) - 1,
    "sma_50_ratio": lambda: ratio(C(), _mean("close_price", 50)) - 1,
    "bb_position": lambda: ratio(
        C() - (_mean("close_price", 20) - 2 * full(F.stddev_samp("close_price"), "close_price", rows_back(20), 20)),
        4 * full(F.stddev_samp("close_price"), "close_price", rows_back(20), 20)),
    "volume_ratio": lambda: ratio(V(), _mean("volume", 20)),
    "rsi_simple": _simple_rsi,
    "realized_vol_20": lambda: full(F.stddev_samp("_log_return"), "_log_return", rows_back(20), 20),
}


def bar_features(bars, columns=None):
    """Bars plus the named feature columns (default: all), in one block shuffle."""
    columns = columns or list(EXPRESSIONS)
    prev = F.lag("close_price").over(block_window())
    df = row_blocks(with_row_index(bars), 64).withColumn("_delta", C() - prev)
    df = df.withColumns({
        # the first bar, which has no change, counts as neither gain nor loss
        "_gain": F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(0.0),
        "_loss": F.when(F.col("_delta") < 0, -F.col("_delta")).otherwise(0.0),
        "_log_return": F.when((C() > 0) & (C() - F.col("_delta") > 0), F.log(F.try_divide(C(), prev)))})
    df = df.withColumns({c: EXPRESSIONS[c]() for c in columns})
    return drop_halo(df.drop("_delta", "_gain", "_loss", "_log_return"))


def forward_fill(df, columns, keys=SERIES, time="open_time", default=0.0):
    """Last non-null value per series, then ``default``: found inside time blocks,
    carried across them by block summaries."""
    cut = df.withColumn("_tb", time_block(time, tf_seconds() * BLOCK_ROWS))
    last = cut.groupBy(*keys, "_tb").agg(*[
        F.max_by(x, F.when(F.col(x).isNotNull(), F.col(time))).alias(f"_last_{x}") for x in columns])
    earlier = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, "_tb", *[F.last(f"_last_{x}", ignorenulls=True).over(earlier).alias(f"_c_{x}")
                                        for x in columns])
    inner = Window.partitionBy(*keys, "_tb").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.withColumns({f"_in_{x}": F.last(x, ignorenulls=True).over(inner) for x in columns})
    out = join_blocks(out, carry, [*keys, "_tb"])
    out = out.withColumns({name: F.coalesce(f"_in_{x}", f"_c_{x}", F.lit(default)) for x, name in columns.items()})
    return out.drop("_tb", *[f"_in_{x}" for x in columns], *[f"_c_{x}" for x in columns])


def feature_table(bars, sentiment=None):
    """All feature columns, session flags and, if given, the sentiment of the time;
    gaps are forward filled, then 0."""
    df = bar_features(bars).withColumns(session_flags())
    filled = [c for c in EXPRESSIONS]
    if sentiment is not None:
        cols = [c for c in sentiment.columns if c not in ("symbol", "timestamp")]
        df = asof_join(df, sentiment, ["symbol"], "open_time", "timestamp", cols)
        filled += cols
    df = forward_fill(df.withColumnsRenamed({c: f"_raw_{c}" for c in filled}),
                      {f"_raw_{c}": c for c in filled})
    return df.drop(*[f"_raw_{c}" for c in filled])


def multi_timeframe(bars, indicators, column="rsi", timeframes=("M5", "M15", "H1"), base="M1"):
    """The column's value of each named timeframe at every base bar: one as-of join keyed
    by (symbol, timeframe), then a pivot of the few timeframes."""
    points = bars.where(F.col("timeframe") == base).select("symbol", "open_time").withColumn(
        "timeframe", F.explode(F.array(*[F.lit(t) for t in timeframes])))
    side = indicators.where(F.col("timeframe").isin(*timeframes)).select(*SERIES, F.col("open_time").alias("_at"), column)
    found = asof_join(points, side, SERIES, "open_time", "_at", [column])
    return found.groupBy("symbol", "open_time").agg(*[
        F.max(F.when(F.col("timeframe") == t, F.col(column))).alias(f"{column}_{t.lower()}") for t in timeframes])
