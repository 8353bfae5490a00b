"""Checks of resampling, indicators and row-frame windows."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import SERIES as OVER
from tickloom.catalog.oracle_views import full as sql_full
from tickloom.constants import TICK_TF_SECONDS
from tickloom.functions import classify
from tickloom.operators import outcome, resample
from tickloom.operators.ewm import ewm
from tickloom.operators.indicators import on_balance_volume, ratio, stored_indicators
from tickloom.operators.sequence import SERIES, block_window, full, ranged, rolling, rows_back, running_total, with_row_index
from tickloom.plans import features

KEYS = ["symbol", "timeframe", "open_time"]
KEYSQL = "symbol, timeframe, open_time"


def stored(name, *cols):
    """An entry showing some stored indicator columns of all bars."""
    @query(name, f"SELECT {KEYSQL}, {rs(*cols)} FROM ind")
    def _(v):
        return stored_indicators(v.bars, list(cols)).select(*KEYS, *[r(c) for c in cols])


stored("i01_true_range", "true_range")
stored("i02_atr", "atr")
stored("i03_directional_movement", "plus_dm", "minus_dm")
stored("i04_directional_index", "plus_di", "minus_di")
stored("i05_adx", "adx")
stored("i06_bollinger", "bb_middle", "bb_upper", "bb_lower")
stored("i07_cci", "cci")
stored("i08_ema", "ema")
stored("i09_macd", "macd", "macd_signal", "macd_hist")
stored("i11_rsi_wilder", "rsi")
stored("i12_sma", "sma")
stored("i13_stochastic_k", "stochastic_k")
stored("i14_stochastic_d", "stochastic_d")
stored("i15_williams_r", "willr")


@query("i10_obv", f"SELECT {KEYSQL}, obv FROM ind")
def i10(v):
    return on_balance_volume(v.bars).select(*KEYS, "obv")


@query("w05_running_total", f"SELECT {KEYSQL}, CAST(sum(volume) OVER ({OVER} ROWS UNBOUNDED PRECEDING) AS BIGINT) "
       "AS running_volume FROM bars")
def w05(v):
    return running_total(v.bars, F.col("volume"), "running_volume").select(*KEYS, "running_volume")


@query("w06_ewm_any_smoothing", """SELECT * FROM (WITH RECURSIVE s AS (SELECT symbol, timeframe, open_time, close_price AS x, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY open_time) AS i FROM bars),
e AS (SELECT symbol, timeframe, open_time, i, x + 0e0 AS fast, x + 0e0 AS slow FROM s WHERE i = 1 UNION ALL
SELECT s.symbol, s.timeframe, s.open_time, s.i, 0.7e0 * e.fast + 0.3e0 * s.x, (199e0 / 201e0) * e.slow + (2e0 / 201e0) * s.x
FROM e JOIN s ON s.symbol = e.symbol AND s.timeframe = e.timeframe AND s.i = e.i + 1)
SELECT symbol, timeframe, open_time, round(fast, 6) + 0e0 AS fast, round(slow, 6) + 0e0 AS slow FROM e)""")
def w06_any(v):
    """Means of a quick and a slow smoothing, beyond those that fit the halo of a block."""
    out = ewm(ewm(v.bars.select(*KEYS, "close_price"), "close_price", 0.3, "fast"), "close_price", 2 / 201, "slow")
    return out.select(*KEYS, r("fast"), r("slow"))


@query("e01_ewm_rows", f"SELECT {KEYSQL}, {rs('ema', 'atr', 'adx')} FROM ind WHERE timeframe IN ('M1', 'H1')")
def e01(v):
    return stored_indicators(v.bars_of("M1", "H1"), ["ema", "atr", "adx"]).select(*KEYS, r("ema"), r("atr"), r("adx"))


@query("w03_rolling_full_frame", f"SELECT {KEYSQL}, " + ", ".join(
    f"round({sql_full(f, 'close_price', 20)}, 6) + 0e0 AS {n}" for f, n in
    [("avg", "mean_20"), ("stddev_samp", "std_20"), ("min", "min_20"), ("max", "max_20")]) + " FROM bars")
def w03(v):
    w = rows_back(20)
    out = rolling(v.bars, {n: full(f("close_price"), "close_price", w, 20) for n, f in
                           [("mean_20", F.avg), ("std_20", F.stddev_samp), ("min_20", F.min), ("max_20", F.max)]}, 19)
    return out.select(*KEYS, *[r(c) for c in ("mean_20", "std_20", "min_20", "max_20")])


@query("w04_lag_diff", f"SELECT {KEYSQL}, lag(close_price) OVER ({OVER}) AS previous_close, "
       f"round(close_price - lag(close_price) OVER ({OVER}), 6) + 0e0 AS delta FROM bars")
def w04(v):
    prev = F.lag("close_price").over(block_window())
    return rolling(v.bars, {"previous_close": prev, "delta": F.round(F.col("close_price") - F.col("previous_close"), 6)},
                   1).select(*KEYS, "previous_close", "delta")


@query("w07_forward_row_targets",
       f"SELECT {KEYSQL}, round((hi - close_price) / nullif(close_price, 0e0) * 100e0, 6) + 0e0 AS target_gain, "
       "round((lo - close_price) / nullif(close_price, 0e0) * 100e0, 6) + 0e0 AS target_loss FROM (SELECT *, "
       "count(*) OVER w AS k, max(high_price) OVER w AS hi, min(low_price) OVER w AS lo FROM bars WINDOW w AS "
       f"({OVER} ROWS BETWEEN 1 FOLLOWING AND 60 FOLLOWING)) WHERE k = 60")
def w07(v):
    return outcome.row_targets(v.bars, 60).select(*KEYS, r("target_gain"), r("target_loss"))


@query("w08_time_range_frames",
       "SELECT symbol, open_time, max(high_price) OVER b AS high_back, min(low_price) OVER b AS low_back, "
       "max(high_price) OVER f AS high_ahead, min(low_price) OVER f AS low_ahead FROM m1 WINDOW "
       "b AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW), "
       "f AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 1 SECOND FOLLOWING AND INTERVAL 1 HOUR FOLLOWING)")
def w08(v):
    back = block_window(order="_t").rangeBetween(-3600, 0)
    ahead = block_window(order="_t").rangeBetween(1, 3600)
    return ranged(v.m1, {"high_back": F.max("high_price").over(back), "low_back": F.min("low_price").over(back),
                         "high_ahead": F.max("high_price").over(ahead), "low_ahead": F.min("low_price").over(ahead)},
                  back=3600, ahead=3600).select("symbol", "open_time", "high_back", "low_back", "high_ahead", "low_ahead")


# --- resampling ---------------------------------------------------------------

OHLC = "open_price, high_price, low_price, close_price"


@query("a01_resample", f"SELECT {KEYSQL}, {OHLC}, volume FROM bars WHERE timeframe = 'H1'")
def a01(v):
    return v.bars_of("H1").select(*KEYS, "open_price", "high_price", "low_price", "close_price", "volume")


@query("a03_roll_up", f"SELECT {KEYSQL}, {OHLC}, volume FROM bars")
def a03(v):
    return v.bars.select(*KEYS, "open_price", "high_price", "low_price", "close_price", "volume")


TICK_SLOTS = ", ".join(f"('{t}', {s}::BIGINT)" for t, s in TICK_TF_SECONDS.items() if s)


@query("a01_tick_tool_timeframes", f"""SELECT concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, k.timeframe,
make_timestamp((epoch_us(ts) // (k.secs * 1000000)) * k.secs * 1000000) AS open_time, arg_min(value, (epoch_us(ts)::HUGEINT * 1000000000 + event_id)) AS open_price,
max(value) AS high_price, min(value) AS low_price, arg_max(value, (epoch_us(ts)::HUGEINT * 1000000000 + event_id)) AS close_price, count(*) AS volume
FROM events CROSS JOIN (VALUES {TICK_SLOTS}) k(timeframe, secs) GROUP BY 1, 2, 3""")
def a01_tick_tool(v):
    return resample.tick_tool_timeframes(v.ticks).select(*KEYS, "open_price", "high_price", "low_price", "close_price", "volume")


@query("w03_tick_tool_index", f"""SELECT timeframe, count(*) AS bars, CAST(sum(n) AS BIGINT) AS index_sum FROM (SELECT timeframe,
row_number() OVER (PARTITION BY symbol, timeframe ORDER BY slot) - 1 AS n FROM (SELECT DISTINCT user_id % 5 AS symbol, k.timeframe, epoch_us(ts) // (k.secs * 1000000) AS slot
FROM events CROSS JOIN (VALUES {TICK_SLOTS}) k(timeframe, secs))) GROUP BY 1""")
def w03_tick_tool(v):
    """Row frames keep every bar of every timeframe."""
    rows = with_row_index(resample.tick_tool_timeframes(v.ticks))
    return rows.groupBy("timeframe").agg(F.count(F.lit(1)).alias("bars"), F.sum("_rn").alias("index_sum"))


@query("a02_gap_fill", f"""
SELECT symbol, unnest(range(open_time, coalesce(nxt, open_time + INTERVAL 30 MINUTE), INTERVAL 30 MINUTE)) AS open_time, {OHLC}
FROM (SELECT *, lead(open_time) OVER (PARTITION BY symbol, CAST(open_time AS DATE) ORDER BY open_time) AS nxt
      FROM bars WHERE timeframe = 'M30')""")
def a02(v):
    filled = resample.fill_gaps(v.bars_of("M30"), 1800)
    return filled.select("symbol", "open_time", "open_price", "high_price", "low_price", "close_price")


# --- feature columns ------------------------------------------------------------

def feature(name, cols, sql_cols):
    @query(name, f"SELECT {KEYSQL}, {sql_cols} FROM bars")
    def _(v):
        return features.bar_features(v.bars, cols).select(*KEYS, *[r(c) for c in cols])


def avg_n(x, n):
    return sql_full("avg", x, n)


GAIN = "CASE WHEN d > 0 THEN d ELSE 0e0 END"
LOSS = "CASE WHEN d < 0 THEN -d ELSE 0e0 END"
SIMPLE_RSI = f"""SELECT {KEYSQL}, CASE WHEN al = 0 AND ag = 0 THEN NULL WHEN al = 0 THEN 100e0
ELSE 100e0 - 100e0 / (1e0 + ag / al) END AS rsi_simple FROM (SELECT {KEYSQL}, {avg_n('g', 14)} AS ag, {avg_n('l', 14)} AS al
FROM (SELECT *, {GAIN} AS g, {LOSS} AS l FROM (SELECT *, close_price - lag(close_price) OVER ({OVER}) AS d FROM bars)))"""


@query("i16_rsi_simple", f"SELECT {KEYSQL}, {rs('rsi_simple', digits=4)} FROM ({SIMPLE_RSI})")
def i16(v):
    return features.bar_features(v.bars, ["rsi_simple"]).select(*KEYS, r("rsi_simple", 4))


@query("i17_rsi_spot_check", f"""
SELECT symbol, timeframe, count(*) AS checked, count(*) FILTER (abs(a.rsi - b.rsi_simple) < 5) AS within_tolerance
FROM ind a JOIN ({SIMPLE_RSI}) b USING (symbol, timeframe, open_time)
WHERE a.rsi IS NOT NULL AND b.rsi_simple IS NOT NULL GROUP BY 1, 2""")
def i17(v):
    a = v.indicators.select(*KEYS, "rsi").join(
        features.bar_features(v.bars, ["rsi_simple"]).select(*KEYS, "rsi_simple"), KEYS)
    a = a.where("rsi is not null and rsi_simple is not null")
    return a.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("checked"),
                                  F.count_if(F.abs(F.col("rsi") - F.col("rsi_simple")) < 5).alias("within_tolerance"))


feature("i18_sma_ratio", [f"sma_{n}_ratio" for n in (5, 10, 20, 50)], ", ".join(
    f"round(close_price / nullif({avg_n('close_price', n)}, 0e0) - 1, 6) + 0e0 AS sma_{n}_ratio" for n in (5, 10, 20, 50)))
feature("i19_bollinger_position", ["bb_position"],
        f"round((close_price - ({avg_n('close_price', 20)} - 2 * {sql_full('stddev_samp', 'close_price', 20)})) / "
        f"nullif(4e0 * {sql_full('stddev_samp', 'close_price', 20)}, 0e0), 6) + 0e0 AS bb_position")
feature("i20_bar_shape", ["price_change", "high_low_ratio", "body_size", "upper_shadow", "lower_shadow"],
        "round((close_price - open_price) / nullif(open_price, 0e0) * 100e0, 6) + 0e0 AS price_change, "
        "round((high_price - low_price) / nullif(low_price, 0e0) * 100e0, 6) + 0e0 AS high_low_ratio, "
        "round(abs(close_price - open_price) / nullif(open_price, 0e0) * 100e0, 6) + 0e0 AS body_size, "
        "round((high_price - greatest(open_price, close_price)) / nullif(open_price, 0e0) * 100e0, 6) + 0e0 AS upper_shadow, "
        "round((least(open_price, close_price) - low_price) / nullif(open_price, 0e0) * 100e0, 6) + 0e0 AS lower_shadow")
feature("i21_volume_ratio", ["volume_ratio"], f"round(volume / {avg_n('volume', 20)}, 6) + 0e0 AS volume_ratio")


@query("i22_realized_volatility", f"""
SELECT {KEYSQL}, round({sql_full('stddev_samp', 'lr', 20)}, 6) + 0e0 AS realized_vol_20
FROM (SELECT *, CASE WHEN close_price > 0 AND p > 0 THEN ln(close_price / p) END AS lr
      FROM (SELECT *, lag(close_price) OVER ({OVER}) AS p FROM bars))""")
def i22(v):
    return features.bar_features(v.bars, ["realized_vol_20"]).select(*KEYS, r("realized_vol_20"))


@query("i23_forward_fill", f"""
SELECT {KEYSQL}, coalesce(last_value(x IGNORE NULLS) OVER ({OVER} ROWS UNBOUNDED PRECEDING), 0e0) AS spread_filled
FROM (SELECT *, CASE WHEN spread > 0 THEN spread END AS x FROM bars)""")
def i23(v):
    df = v.bars.withColumn("x", F.when(F.col("spread") > 0, F.col("spread")))
    return features.forward_fill(df, {"x": "spread_filled"}).select(*KEYS, "spread_filled")


@query("p09_session_flags", f"""
SELECT {KEYSQL}, CAST(hour(open_time) AS INTEGER) AS hour, CAST(isodow(open_time) - 1 AS INTEGER) AS day_of_week,
CAST(hour(open_time) BETWEEN 8 AND 16 AS INTEGER) AS is_london, CAST(hour(open_time) BETWEEN 13 AND 21 AS INTEGER) AS is_new_york,
CAST(hour(open_time) BETWEEN 13 AND 16 AS INTEGER) AS is_overlap FROM bars""")
def p09(v):
    return v.bars.select(*KEYS, *[c.alias(n) for n, c in classify.session_flags().items()])
