"""Checks of joins, outcomes, trades and classifiers."""
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import session
from tickloom.constants import FULL_LIMITS, PATTERN_LIMITS, TF_SECONDS
from tickloom.functions import classify
from tickloom.operators import outcome
from tickloom.operators.asof import asof_join, context_at
from tickloom.operators.rangejoin import range_join, valid_at
from tickloom.operators.resample import floor_time
from tickloom.operators.sequence import epoch
from tickloom.plans import features, trades

KEYS = ["symbol", "timeframe", "open_time"]


def limits_sql(limits):
    return "(VALUES " + ", ".join(f"('{t}', {n})" for t, n in limits.items()) + ") AS lims(timeframe, lim)"


MINUTE_POINTS = "(SELECT symbol, open_time AS at FROM m1)"


def minute_points(v):
    return v.m1.select("symbol", F.col("open_time").alias("at"))


def context_sql(limits, points, known="open_time"):
    parts = " UNION ALL ".join(
        f"SELECT symbol, timeframe, open_time, {known} AS known, count(*) OVER w AS n_candles, min(open_time) OVER w AS first_open, "
        f"sum(close_price) OVER w AS close_sum FROM bars WHERE timeframe = '{t}' "
        f"WINDOW w AS (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for t, n in limits.items())
    return f"""SELECT p.symbol, p.timeframe, p.at, c.open_time AS ref_time, coalesce(c.n_candles, 0) AS n_candles, c.first_open,
round(c.close_sum, 4) + 0e0 AS close_sum
FROM (SELECT * FROM {points} CROSS JOIN (SELECT timeframe FROM {limits_sql(limits)})) p
ASOF LEFT JOIN ({parts}) c ON p.symbol = c.symbol AND p.timeframe = c.timeframe AND p.at >= c.known"""


CANDLE = ["open_time", "open_price", "high_price", "low_price", "close_price", "volume"]


def context_digest(df):
    return df.select("symbol", "timeframe", "at", "ref_time",
                     F.coalesce(F.size("candles"), F.lit(0)).cast("long").alias("n_candles"),
                     F.get("candles", F.lit(0))["open_time"].alias("first_open"),
                     F.round(F.aggregate("candles", F.lit(0.0), lambda a, c: a + c["close_price"]), 4).alias("close_sum"))


@query("j01_asof_last_n_pattern", context_sql(PATTERN_LIMITS, "(SELECT symbol, open_time AS at FROM m1)"))
def j01(v):
    return context_digest(context_at(minute_points(v), v.bars, CANDLE, PATTERN_LIMITS))


@query("j01_asof_last_n_closed_bars", context_sql(PATTERN_LIMITS, MINUTE_POINTS, "open_time + to_seconds(secs)"))
def j01_closed(v):
    return context_digest(context_at(minute_points(v), v.bars, CANDLE, PATTERN_LIMITS, visible="closed"))


@query("j01_asof_last_n_full", context_sql(FULL_LIMITS, MINUTE_POINTS))
def j01_full(v):
    return context_digest(context_at(minute_points(v), v.bars, CANDLE, FULL_LIMITS))


@query("j02_asof_latest", """SELECT p.symbol, p.at, a.timestamp AS state_time, a.balance, a.profit
FROM (SELECT symbol, open_time AS at FROM m1) p ASOF LEFT JOIN account_state a ON p.symbol = a.symbol AND p.at >= a.timestamp""")
def j02(v):
    return trades.account_at(minute_points(v), v.account_state).select(
        "symbol", "at", F.col("timestamp").alias("state_time"), "balance", "profit")


@query("j03_exact_time", """SELECT a.account_id, a.symbol, a.timestamp, b.close_price, b.volume FROM account_state a
LEFT JOIN m1 b ON a.symbol = b.symbol AND b.open_time = date_trunc('minute', a.timestamp)""")
def j03(v):
    snaps = v.account_state.select("account_id", "symbol", "timestamp", F.date_trunc("minute", "timestamp").alias("open_time"))
    return snaps.join(v.m1, ["symbol", "open_time"], "left").select("account_id", "symbol", "timestamp", "close_price", "volume")


@query("j04_forward_range", """SELECT a.account_id, a.symbol, a.timestamp, count(b.open_time) AS later_bars,
max(b.high_price) AS fwd_high, min(b.low_price) AS fwd_low FROM account_state a LEFT JOIN m1 b
ON a.symbol = b.symbol AND b.open_time > a.timestamp AND b.open_time <= a.timestamp + INTERVAL 60 MINUTE GROUP BY 1, 2, 3""")
def j04(v):
    snaps = v.account_state.select("account_id", "symbol", F.col("timestamp").alias("snapshot_time"))
    return outcome.outcomes_at(snaps, v.m1).select("account_id", "symbol", F.col("snapshot_time").alias("timestamp"),
                                                   F.col("fwd_bars").alias("later_bars"), "fwd_high", "fwd_low")


@query("j05_backward_range", f"""SELECT p.symbol, p.at, count(*) AS n_trades, round(sum(c.profit), 6) + 0e0 AS profit,
arg_max(c.id, c.time) AS newest_id FROM {MINUTE_POINTS} p JOIN closed_trades c ON p.symbol = c.symbol AND c.time <= p.at
AND c.time > p.at - INTERVAL 24 HOUR GROUP BY 1, 2""")
def j05(v):
    return trades.closed_totals(minute_points(v), v.closed_trades).select("symbol", "at", "n_trades", r("profit"), "newest_id")


@query("j06_interval_join", f"""SELECT p.symbol, p.at, count(*) AS n_open, round(sum(o.open_price), 4) + 0e0 AS price_sum,
max(o.trade_id) AS newest_trade FROM {MINUTE_POINTS} p JOIN open_trades o ON p.symbol = o.symbol AND o.open_time <= p.at
AND (o.close_time IS NULL OR o.close_time > p.at) GROUP BY 1, 2""")
def j06(v):
    return trades.open_totals(minute_points(v), v.open_trades).select("symbol", "at", "n_open", r("price_sum", 4), "newest_trade")


@query("j06_valid_counts", f"""SELECT p.symbol, p.at, count(o.trade_id) AS n_open, round(coalesce(sum(o.open_price), 0), 4) + 0e0 AS price_sum
FROM {MINUTE_POINTS} p LEFT JOIN open_trades o ON p.symbol = o.symbol AND o.open_time <= p.at AND (o.close_time IS NULL OR o.close_time > p.at) GROUP BY 1, 2""")
def j06_counts(v):
    """Number and price sum of the trades open at every M1 time, by a sweep over starts and ends."""
    held = v.open_trades.withColumnRenamed("open_time", "trade_time")
    counts = valid_at(minute_points(v), held, ["symbol"], "at", "trade_time", "close_time", ["open_price"], "n_open")
    return counts.select("symbol", "at", "n_open", (F.round("open_price_sum", 4) + 0.0).alias("price_sum"))


STOPS = ("SELECT magic_number, arg_min(sl, timestamp) AS original_sl, arg_min(tp, timestamp) AS original_tp FROM planned_trades "
         "WHERE sl IS NOT NULL AND tp IS NOT NULL GROUP BY 1")


@query("j07_first_match_lookup", f"""SELECT o.trade_id, o.magic_number, o.sl, o.tp, s.original_sl, s.original_tp
FROM open_trades o LEFT JOIN ({STOPS}) s ON o.magic_number = s.magic_number""")
def j07(v):
    return trades.with_original_stops(v.open_trades, v.planned_trades).select(
        "trade_id", "magic_number", "sl", "tp", "original_sl", "original_tp")


@query("j08_latest_account_chain", """SELECT account_id, timestamp, balance, equity, margin, free_margin, profit, currency
FROM account_state WHERE account_id = (SELECT arg_max(account_id, timestamp) FROM account_state)
ORDER BY timestamp DESC LIMIT 1""")
def j08(v):
    return trades.latest_account_state(v.account_state).select("account_id", "timestamp", "balance", "equity", "margin",
                                                               "free_margin", "profit", "currency")


@query("j11_missing_series", """SELECT s.symbol, t.timeframe FROM (SELECT DISTINCT symbol FROM bars) s CROSS JOIN tfs t
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.symbol = s.symbol AND b.timeframe = t.timeframe AND b.volume >= 4)""")
def j11(v):
    """Expected series (symbols x the fixed timeframe list) without a bar of 4 ticks."""
    expected = v.bars.select("symbol").distinct().withColumn(
        "timeframe", F.explode(F.array(*[F.lit(t) for t in TF_SECONDS])))
    actual = v.bars.where("volume >= 4").select("symbol", "timeframe").distinct()
    return expected.join(actual, ["symbol", "timeframe"], "left_anti")


@query("j12_rows_at_latest_time", """SELECT b.symbol, b.timeframe, b.open_time, b.close_price FROM bars b
WHERE b.open_time = (SELECT max(x.open_time) FROM bars x WHERE x.symbol = b.symbol)""")
def j12(v):
    latest = v.bars.groupBy("symbol").agg(F.max("open_time").alias("open_time"))
    return v.bars.join(latest, ["symbol", "open_time"], "left_semi").select(*KEYS, "close_price")


@query("j13_existence", """SELECT b.symbol, b.open_time, EXISTS (SELECT 1 FROM account_state a WHERE a.symbol = b.symbol
AND date_trunc('hour', a.timestamp) = b.open_time) AS has_state FROM bars b WHERE b.timeframe = 'H1'""")
def j13(v):
    states = v.account_state.select("symbol", floor_time("timestamp", 3600).alias("open_time")).distinct()
    bars = v.bars_of("H1").select("symbol", "open_time")
    return bars.join(states, ["symbol", "open_time"], "left_semi").withColumn("has_state", F.lit(True)).unionByName(
        bars.join(states, ["symbol", "open_time"], "left_anti").withColumn("has_state", F.lit(False)))


@query("j14_lateral_timeframes", """SELECT t.timeframe, count(b.symbol) AS bars, max(b.open_time) AS latest
FROM tfs t LEFT JOIN bars b ON b.timeframe = t.timeframe AND b.spread > 0 GROUP BY 1""")
def j14(v):
    wanted = v.spark.createDataFrame([(t,) for t in TF_SECONDS], "timeframe string")
    stats = v.bars.where("spread > 0").groupBy("timeframe").agg(F.count(F.lit(1)).alias("bars"),
                                                                F.max("open_time").alias("latest"))
    return wanted.join(stats, "timeframe", "left").select("timeframe", F.coalesce("bars", F.lit(0)).alias("bars"), "latest")


SENTIMENT = ("SELECT concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, date_trunc('hour', ts) AS timestamp, "
             "avg((value - 50e0) / 100e0) AS sentiment FROM events WHERE event_type = 'view' GROUP BY 1, 2")


@query("j15_bars_with_hourly_sentiment", f"""SELECT b.symbol, b.open_time, b.close_price, s.timestamp AS sentiment_time,
round(s.sentiment, 6) + 0e0 AS sentiment FROM (SELECT * FROM bars WHERE timeframe = 'M15') b
ASOF LEFT JOIN ({SENTIMENT}) s ON b.symbol = s.symbol AND b.open_time >= s.timestamp""")
def j15(v):
    s = (v.events.where("event_type = 'view'")
         .groupBy("symbol", floor_time("ts", 3600).alias("sentiment_time"))
         .agg(F.avg((F.col("value") - 50) / 100.0).alias("sentiment")))
    return asof_join(v.bars_of("M15"), s, ["symbol"], "open_time", "sentiment_time", ["sentiment_time", "sentiment"]).select(
        "symbol", "open_time", "close_price", "sentiment_time", r("sentiment"))


@query("m15_multi_timeframe_features", """SELECT m.symbol, m.open_time, round(a.rsi, 6) + 0e0 AS rsi_m5, round(b.rsi, 6) + 0e0 AS rsi_m15,
round(c.rsi, 6) + 0e0 AS rsi_h1 FROM m1 m
ASOF LEFT JOIN (SELECT * FROM ind WHERE timeframe = 'M5') a ON m.symbol = a.symbol AND m.open_time >= a.open_time
ASOF LEFT JOIN (SELECT * FROM ind WHERE timeframe = 'M15') b ON m.symbol = b.symbol AND m.open_time >= b.open_time
ASOF LEFT JOIN (SELECT * FROM ind WHERE timeframe = 'H1') c ON m.symbol = c.symbol AND m.open_time >= c.open_time""")
def m15(v):
    out = features.multi_timeframe(v.bars, v.indicators)
    return out.select("symbol", "open_time", r("rsi_m5"), r("rsi_m15"), r("rsi_h1"))


# --- outcomes -------------------------------------------------------------------

@query("a04_max_gain_loss", """SELECT symbol, open_time,
coalesce(CASE WHEN close_price > 0 THEN round((fwd_high - close_price) / close_price * 100e0, 4) END, 0e0) AS max_gain_pct,
coalesce(CASE WHEN close_price > 0 THEN round((fwd_low - close_price) / close_price * 100e0, 4) END, 0e0) AS max_loss_pct FROM fwd""")
def a04(v):
    gain, loss = outcome.gain_loss()
    return outcome.forward_stats(v.m1).select("symbol", "open_time", gain.alias("max_gain_pct"), loss.alias("max_loss_pct"))


SNAP = "symbol, snapshot_time, max_gain_pct_1h, max_loss_pct_1h, calculation_range_minutes, prediction_mode"


@query("a05_outcome_policy_history", f"SELECT {SNAP} FROM snapshots")
def a05(v):
    return v.snapshots.select(*SNAP.split(", "))


@query("a05_outcome_policy_live", """SELECT symbol, open_time AS snapshot_time,
coalesce(CASE WHEN close_price > 0 THEN round((fwd_high - close_price) / close_price * 100e0, 4) END, 0e0) AS max_gain_pct_1h,
coalesce(CASE WHEN close_price > 0 THEN round((fwd_low - close_price) / close_price * 100e0, 4) END, 0e0) AS max_loss_pct_1h,
fwd_bars AS calculation_range_minutes, fwd_bars < 3 AS prediction_mode FROM fwd""")
def a05_live(v):
    return outcome.snapshot_outcomes(v.m1, 3, "live").select(*SNAP.split(", "))


ONE_SIDED = ("CASE WHEN {p} <> 0 AND fwd_high > {p} THEN round((fwd_high - {p}) / {p} * 100e0, 2) END AS max_gain_pct_1h, "
             "CASE WHEN {p} <> 0 AND fwd_low < {p} THEN round((fwd_low - {p}) / {p} * 100e0, 2) END AS max_loss_pct_1h")


@query("a06_one_sided_outcome_history", f"SELECT symbol, open_time, {ONE_SIDED.format(p='close_price')} FROM fwd")
def a06(v):
    gain, loss = outcome.one_sided()
    return outcome.forward_stats(v.m1).select("symbol", "open_time", gain.alias("max_gain_pct_1h"), loss.alias("max_loss_pct_1h"))


@query("a06_one_sided_outcome_asof_price", f"""SELECT account_id, symbol, timestamp, {ONE_SIDED.format(p='price')} FROM (
SELECT p.account_id, p.symbol, p.timestamp, p.price, max(b.high_price) AS fwd_high, min(b.low_price) AS fwd_low
FROM (SELECT a.account_id, a.symbol, a.timestamp, c.close_price AS price FROM account_state a
      ASOF LEFT JOIN m1 c ON a.symbol = c.symbol AND a.timestamp >= c.open_time) p
LEFT JOIN m1 b ON p.symbol = b.symbol AND b.open_time > p.timestamp AND b.open_time <= p.timestamp + INTERVAL 60 MINUTE
GROUP BY ALL)""")
def a06_asof(v):
    at = v.account_state.select("account_id", "symbol", F.col("timestamp").alias("snapshot_time"))
    price = v.m1.select("symbol", "open_time", F.col("close_price").alias("price"))
    snaps = asof_join(at, price, ["symbol"], "snapshot_time", "open_time", ["price"])
    gain, loss = outcome.one_sided(price="price")
    return outcome.outcomes_at(snaps, v.m1).select("account_id", "symbol", F.col("snapshot_time").alias("timestamp"),
                                                   gain.alias("max_gain_pct_1h"), loss.alias("max_loss_pct_1h"))


@query("a07_trailing_ranges", """SELECT symbol, open_time, round(max(high_price) OVER w1 - min(low_price) OVER w1, 2) AS price_range_1h,
round(max(high_price) OVER w4 - min(low_price) OVER w4, 2) AS price_range_4h FROM m1 WINDOW
w1 AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW),
w4 AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW)""")
def a07(v):
    return outcome.trailing_ranges(v.m1).select("symbol", "open_time", "price_range_1h", "price_range_4h")


VOL24 = ("SELECT symbol, open_time, nullif(CAST(sum(volume) OVER (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN "
         "INTERVAL 86399 SECOND PRECEDING AND CURRENT ROW) AS BIGINT), 0) AS volume_24h, open_price, high_price, low_price, "
         "close_price FROM m1")
DEV4 = ("SELECT symbol, open_time, CASE WHEN count(x) OVER w > 1 THEN round(stddev_pop(x) OVER w, 5) END AS volatility_4h FROM "
        "(SELECT *, nullif(close_price, 0e0) AS x FROM bars WHERE timeframe = 'M5') WINDOW w AS (PARTITION BY symbol ORDER BY "
        "open_time RANGE BETWEEN INTERVAL 14399 SECOND PRECEDING AND CURRENT ROW)")


@query("a08_volume_24h", f"SELECT symbol, open_time, volume_24h FROM ({VOL24})")
def a08(v):
    return outcome.day_volume(v.m1).select("symbol", "open_time", "volume_24h")


@query("a09_close_deviation_4h", DEV4)
def a09(v):
    return outcome.close_deviation(v.bars_of("M5")).select("symbol", "open_time", "volatility_4h")


SESSION_H = ("CASE WHEN hour({t}) <= 5 THEN 'Asian' WHEN hour({t}) <= 13 THEN 'European' WHEN hour({t}) <= 21 THEN 'American' "
             "ELSE 'Asian' END")
MARKET_SQL = f"""SELECT m.symbol, m.open_time AS at, m.close_price AS current_price,
CASE WHEN m.high_price <> 0 AND m.low_price <> 0 THEN round(m.high_price - m.low_price, 5) END AS spread,
CAST(m.volume_24h AS DOUBLE) AS volume_24h,
(SELECT CASE WHEN count(nullif(b.close_price, 0e0)) > 1 THEN round(stddev_pop(nullif(b.close_price, 0e0)), 5) END FROM bars b
 WHERE b.timeframe = 'M5' AND b.symbol = m.symbol AND b.open_time > m.open_time - INTERVAL 4 HOUR AND b.open_time <= m.open_time) AS volatility,
{SESSION_H.format(t='m.open_time')} AS market_session FROM ({VOL24}) m"""


@query("a10_market_state_row", MARKET_SQL)
def a10(v):
    from tickloom.plans.documents import market_state_history
    return market_state_history(v.m1, v.bars_of("M5"))


@query("a30_readiness", """SELECT symbol, count(*) FILTER (fwd_bars >= 3) AS ready, count(*) FILTER (fwd_bars < 3) AS not_ready,
count(*) AS missing, min(CASE WHEN fwd_bars >= 3 THEN open_time END) AS earliest_ready,
round(count(*) FILTER (fwd_bars >= 3) * 100e0 / count(*), 2) AS ready_pct FROM fwd GROUP BY 1""")
def a30(v):
    from tickloom.plans.quality import readiness
    return readiness(outcome.forward_stats(v.m1), min_bars=3)
