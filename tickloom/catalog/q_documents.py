"""Checks of document builders (compared through digests of the nested values)."""
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import session
from tickloom.catalog.q_joins import (MARKET_SQL, MINUTE_POINTS, ONE_SIDED, STOPS, context_sql, limits_sql,
                                      minute_points)
from tickloom.catalog.q_quality import SPREAD_A
from tickloom.constants import COMPACT_LIMITS, DOCUMENT_TIMEFRAMES, FULL_LIMITS, INDICATOR_COLUMNS, PATTERN_LIMITS
from tickloom.functions.scalar import first_present, json_number, json_text, utc_text
from tickloom.plans import documents as d
from tickloom.plans import quality, trades

ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S+00:00')"
TIERS = {"H1": (15, 8), "H4": (25, 12), "M15": (6, 3), "M5": (3, "1.5e0")}


def tier_sql(values):
    return "coalesce(" + ", ".join(
        f"CASE WHEN {values[t]} > {TIERS[t][0]} THEN 'high' WHEN {values[t]} > {TIERS[t][1]} THEN 'medium' "
        f"WHEN {values[t]} IS NOT NULL THEN 'low' END" for t in TIERS) + ", 'no_data')"


def _inner(ind, tf):
    return F.try_element_at(F.try_element_at(F.col("indicators"), F.lit(ind)), F.lit(tf))


def _size(tf, column="context"):
    return F.size(F.try_element_at(F.col(column), F.lit(tf))).cast("long")


def close_sum():
    total = F.aggregate(F.flatten(F.map_values("context")), F.lit(0.0), lambda a, c: a + c["close"])
    return F.round(total, 4).alias("close_sum")

FRAMES = " UNION ALL ".join(
    f"SELECT symbol, timeframe, open_time, coalesce(rsi, 0e0) AS rsi, coalesce(atr, 0e0) AS atr, count(*) OVER w AS k, "
    f"sum(close_price) OVER w AS cs FROM ind WHERE timeframe = '{t}' WINDOW w AS (PARTITION BY symbol ORDER BY open_time "
    f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for t, n in PATTERN_LIMITS.items())
D02_SQL = f"""SELECT p.symbol, {ISO.format(t='p.at')} AS snapshot_time, CAST(sum(c.k) AS BIGINT) AS candles, round(sum(c.cs), 4) + 0e0 AS close_sum,
round(max(CASE WHEN p.timeframe = 'H1' THEN c.rsi END), 6) + 0e0 AS rsi_h1, round(max(CASE WHEN p.timeframe = 'D1' THEN c.atr END), 6) + 0e0 AS atr_d1,
any_value(f.max_gain_pct_1h) AS max_gain_pct_1h, any_value(f.max_loss_pct_1h) AS max_loss_pct_1h, any_value({session('p.at')}) AS session,
{tier_sql({t: f"max(CASE WHEN p.timeframe = '{t}' THEN c.atr END)" for t in TIERS})} AS volatility
FROM (SELECT * FROM (SELECT symbol, open_time AS at FROM m1) CROSS JOIN (SELECT timeframe FROM {limits_sql(PATTERN_LIMITS)})) p
ASOF LEFT JOIN ({FRAMES}) c ON p.symbol = c.symbol AND p.timeframe = c.timeframe AND p.at >= c.open_time
LEFT JOIN (SELECT symbol, open_time, {ONE_SIDED.format(p='close_price')} FROM fwd) f ON f.symbol = p.symbol AND f.open_time = p.at
GROUP BY p.symbol, p.at"""


@query("d02_history_pattern", D02_SQL)
def d02(v):
    docs = d.history_pattern(minute_points(v), v.indicators)
    return docs.select("symbol", "snapshot_time", d.total_candles().cast("long").alias("candles"),
                       close_sum(), F.round(_inner("rsi", "H1"), 6).alias("rsi_h1"),
                       F.round(_inner("atr", "D1"), 6).alias("atr_d1"), "outcome_1h.max_gain_pct_1h",
                       "outcome_1h.max_loss_pct_1h", "session", "volatility")


LATEST = "(SELECT symbol, max(open_time) AS at FROM m1 GROUP BY 1)"
LIVE_K = f"""(SELECT b.symbol, b.timeframe, count(*) AS k, sum(b.close_price) AS cs, arg_max(b.atr, b.open_time) AS atr, arg_max(b.rsi, b.open_time) AS rsi
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY open_time DESC) AS rk FROM ind) b
JOIN {{lims}} ON lims.timeframe = b.timeframe AND b.rk <= lims.lim GROUP BY 1, 2)"""
RANGES = f"""(SELECT l.symbol, l.at, round(max(CASE WHEN m.open_time >= l.at - INTERVAL 1 HOUR THEN m.high_price END)
- min(CASE WHEN m.open_time >= l.at - INTERVAL 1 HOUR THEN m.low_price END), 2) AS price_range_1h,
round(max(m.high_price) - min(m.low_price), 2) AS price_range_4h,
arg_max({SPREAD_A.replace('high_price', 'm.high_price').replace('low_price', 'm.low_price')}, m.open_time) AS spread
FROM {LATEST} l JOIN m1 m ON m.symbol = l.symbol AND m.open_time >= l.at - INTERVAL 4 HOUR GROUP BY 1, 2)"""


@query("d01_live_pattern", f"""SELECT g.symbol, {ISO.format(t='any_value(g.at)')} AS snapshot_time, CAST(sum(k.k) AS BIGINT) AS candles,
round(sum(k.cs), 4) + 0e0 AS close_sum, round(max(CASE WHEN k.timeframe = 'M5' THEN k.rsi END), 6) + 0e0 AS rsi_m5,
any_value(price_range_1h) AS price_range_1h, any_value(price_range_4h) AS price_range_4h, any_value(spread) AS spread, any_value({session('g.at')}) AS session,
{tier_sql({t: f"max(CASE WHEN k.timeframe = '{t}' THEN k.atr END)" for t in TIERS})} AS volatility, false AS news_event,
CAST(NULL AS DOUBLE) AS max_gain_pct_1h
FROM {RANGES} g JOIN {LIVE_K.format(lims=limits_sql(PATTERN_LIMITS))} k ON k.symbol = g.symbol GROUP BY g.symbol""")
def d01(v):
    docs = d.live_pattern(d.recent_with_indicators(v.bars))
    return docs.select("symbol", "snapshot_time", d.total_candles().cast("long").alias("candles"),
                       close_sum(), F.round(_inner("rsi", "M5"), 6).alias("rsi_m5"),
                       "volatility_metrics.price_range_1h", "volatility_metrics.price_range_4h", "spread", "session",
                       "volatility", "news_event", "outcome_1h.max_gain_pct_1h")


def ohlc_digest(docs):
    flat = F.flatten(F.map_values("ohlc"))
    return docs.select("symbol", "at", *[_size(t, "ohlc").alias(f"n_{t.lower()}") for t in FULL_LIMITS],
                       F.round(F.aggregate(flat, F.lit(0.0), lambda a, c: a + c["close"]), 3).alias("close_sum"),
                       F.try_element_at("ohlc_last_time", F.lit("M1")).alias("last_m1"),
                       F.try_element_at("ohlc_last_time", F.lit("D1")).alias("last_d1"))


def ohlc_sql(inner, m1="M1"):
    sizes = ", ".join(f"coalesce(max(CASE WHEN timeframe = '{t}' THEN n_candles END), 0) AS n_{t.lower()}" for t in FULL_LIMITS)
    last = ", ".join(f"{ISO.format(t=f'''max(CASE WHEN timeframe = '{t}' THEN ref_time END)''')} AS last_{t.lower()}" for t in ("M1", "D1"))
    return f'SELECT symbol, "at", {sizes}, round(sum(close_sum), 3) + 0e0 AS close_sum, {last} FROM ({inner}) GROUP BY symbol, "at"'


@query("d03_history_ohlc", ohlc_sql(context_sql(FULL_LIMITS, MINUTE_POINTS).replace("round(c.close_sum, 4)", "c.close_sum")))
def d03(v):
    return ohlc_digest(d.history_ohlc(minute_points(v), v.indicators))


@query("d03_live_ohlc", ohlc_sql(f"""SELECT l.symbol, l.at, k.timeframe, k.k AS n_candles, k.cs AS close_sum,
(SELECT max(open_time) FROM bars b WHERE b.symbol = l.symbol AND b.timeframe = k.timeframe) AS ref_time
FROM {LATEST} l JOIN {LIVE_K.format(lims=limits_sql(FULL_LIMITS))} k ON k.symbol = l.symbol"""))
def d03_live(v):
    return ohlc_digest(d.live_ohlc(v.indicators))


@query("k09_last_bar_times", """SELECT symbol, timeframe, strftime(max(open_time), '%Y-%m-%dT%H:%M:%S+00:00') AS last_time FROM bars
WHERE timeframe <> 'M30' GROUP BY 1, 2""")
def k09(v):
    docs = d.live_ohlc(v.indicators)
    return docs.select("symbol", F.explode("ohlc_last_time").alias("timeframe", "last_time"))


@query("d04_account_live", f"""SELECT account_id, {ISO.format(t='timestamp')} AS state_time, balance, equity, margin, free_margin, leverage, profit, currency
FROM account_state ORDER BY timestamp DESC LIMIT 1""")
def d04(v):
    return trades.live_account_document(v.account_state).select(
        "account_id", F.col("account.timestamp").alias("state_time"), "account.balance", "account.equity", "account.margin",
        "account.free_margin", "account.leverage", "account.profit", "account.currency")


@query("d04_account_history", f"""SELECT p.symbol, p.at, a.balance, a.equity, a.margin, a.free_margin, a.margin_level, a.profit AS profit_loss,
coalesce(a.total_positions, 0) AS total_positions, a.risk_percent, {ISO.format(t='a.timestamp')} AS state_time FROM (SELECT symbol, open_time AS at FROM m1) p ASOF JOIN account_state a ON p.symbol = a.symbol AND p.at >= a.timestamp""")
def d04_history(v):
    return trades.history_account_documents(minute_points(v), v.account_state).select(
        "symbol", "at", "account.balance", "account.equity", "account.margin", "account.free_margin", "account.margin_level",
        "account.profit_loss", "account.total_positions", "account.risk_percent", F.col("account.timestamp").alias("state_time"))


@query("d05_open_trades_live", f"""SELECT account_id, count(*) AS n_trades, round(sum(open_price), 4) + 0e0 AS price_sum,
count(original_sl) AS with_stops, {ISO.format(t='min(open_time)')} AS first_open, count(*) FILTER (status = 'pending') AS pending
FROM (SELECT o.*, s.original_sl FROM open_trades o LEFT JOIN ({STOPS}) s ON o.magic_number = s.magic_number
WHERE o.status IN ('open', 'pending')) GROUP BY 1""")
def d05(v):
    docs = trades.live_trade_documents(v.open_trades, v.planned_trades)
    count = lambda test: F.size(F.filter("trades", test)).cast("long")
    return docs.select("account_id", F.size("trades").cast("long").alias("n_trades"),
                       F.round(F.aggregate("trades", F.lit(0.0), lambda a, t: a + t["open_price"]), 4).alias("price_sum"),
                       count(lambda t: t["original_sl"].isNotNull()).alias("with_stops"),
                       F.element_at("trades", 1)["open_time"].alias("first_open"),
                       count(lambda t: t["status"] == "pending").alias("pending"))


@query("d05_open_trades_history", f"""SELECT p.symbol, p.at, count(*) AS n_trades, round(sum(o.sl), 4) + 0e0 AS stop_sum,
arg_min(o.trade_id, o.open_time) AS oldest FROM {MINUTE_POINTS} p JOIN open_trades o ON p.symbol = o.symbol AND o.open_time <= p.at
AND (o.close_time IS NULL OR o.close_time > p.at) GROUP BY 1, 2""")
def d05_history(v):
    docs = trades.open_trade_documents(minute_points(v), v.open_trades)
    return docs.select("symbol", "at", F.size("trades").cast("long").alias("n_trades"),
                       F.round(F.aggregate("trades", F.lit(0.0), lambda a, t: a + t["stop_loss"]), 4).alias("stop_sum"),
                       F.element_at("trades", 1)["trade_id"].alias("oldest"))


@query("d06_closed_trades_history", f"""SELECT p.symbol, p.at, count(*) AS n_trades, round(sum(c.profit), 4) + 0e0 AS profit,
arg_max(c.id, c.time) AS newest FROM {MINUTE_POINTS} p JOIN closed_trades c ON p.symbol = c.symbol AND c.time <= p.at
AND c.time > p.at - INTERVAL 24 HOUR GROUP BY 1, 2""")
def d06(v):
    docs = trades.closed_trade_documents(minute_points(v), v.closed_trades)
    return docs.select("symbol", "at", F.size("trades").cast("long").alias("n_trades"),
                       F.round(F.aggregate("trades", F.lit(0.0), lambda a, t: a + t["profit"]), 4).alias("profit"),
                       F.element_at("trades", 1)["trade_id"].alias("newest"))


def trade_rows(docs, *keys):
    """The trades of the documents field by field, with their places in the list."""
    rows = docs.select(*keys, F.posexplode("trades").alias("place", "t"))
    return rows.select(*keys, "place", *[F.col(f"t.{c}").alias(f"t_{c}") for c in docs.schema["trades"].dataType.elementType.names])


def place(order, by):
    return f"CAST(row_number() OVER (PARTITION BY {by} ORDER BY {order}) - 1 AS INTEGER) AS place"


@query("d05_live_trade_fields", f"""SELECT o.account_id, {place('o.open_time, o.trade_id', 'o.account_id')}, o.symbol AS t_symbol, o.magic_number AS t_magic, o.order_type AS t_order_type,
o.lot_size AS t_lot_size, o.open_price AS t_open_price, o.sl AS t_sl, o.tp AS t_tp, {ISO.format(t='o.open_time')} AS t_open_time, o.status AS t_status,
o.comment AS t_comment, s.original_sl AS t_original_sl, s.original_tp AS t_original_tp
FROM open_trades o LEFT JOIN ({STOPS}) s ON o.magic_number = s.magic_number WHERE o.status IN ('open', 'pending')""")
def d05_live_fields(v):
    return trade_rows(trades.live_trade_documents(v.open_trades, v.planned_trades), "account_id")


@query("d05_history_trade_fields", f"""SELECT p.symbol, p.at, {place('o.open_time, o.trade_id', 'p.symbol, p.at')}, o.trade_id AS t_trade_id, o.symbol AS t_symbol, o.order_type AS t_type,
o.lot_size AS t_volume, o.open_price AS t_open_price, o.sl AS t_stop_loss, o.tp AS t_take_profit, 0e0 AS t_profit, 0e0 AS t_commission, 0e0 AS t_swap,
{ISO.format(t='o.open_time')} AS t_open_time, coalesce(o.comment, '') AS t_comment, o.magic_number AS t_magic
FROM {MINUTE_POINTS} p JOIN open_trades o ON p.symbol = o.symbol AND o.open_time <= p.at AND (o.close_time IS NULL OR o.close_time > p.at)""")
def d05_history_fields(v):
    return trade_rows(trades.open_trade_documents(minute_points(v), v.open_trades), "symbol", "at")


@query("d06_history_trade_fields", f"""SELECT p.symbol, p.at, {place('c.time DESC, c.id DESC', 'p.symbol, p.at')}, c.id AS t_trade_id, c.symbol AS t_symbol, c.type AS t_type, c.volume AS t_volume,
c.entry_price AS t_open_price, c.exit_price AS t_close_price, CAST(NULL AS DOUBLE) AS t_stop_loss, CAST(NULL AS DOUBLE) AS t_take_profit, c.profit AS t_profit,
0e0 AS t_commission, 0e0 AS t_swap, {ISO.format(t='c.time')} AS t_open_time, {ISO.format(t='c.time')} AS t_close_time, coalesce(c.comment, '') AS t_comment, 0 AS t_magic
FROM {MINUTE_POINTS} p JOIN closed_trades c ON p.symbol = c.symbol AND c.time <= p.at AND c.time > p.at - INTERVAL 24 HOUR""")
def d06_history_fields(v):
    return trade_rows(trades.closed_trade_documents(minute_points(v), v.closed_trades), "symbol", "at")


SINCE = "(SELECT symbol, max(open_time) - INTERVAL 1 HOUR AS since FROM m1 GROUP BY 1)"


@query("d06_closed_trades_live", f"""SELECT s.symbol, count(*) AS n_trades, round(sum(c.profit), 4) + 0e0 AS profit,
{ISO.format(t='max(c.time)')} AS newest FROM {SINCE} s JOIN closed_trades c ON c.symbol = s.symbol AND c.time > s.since GROUP BY 1""")
def d06_live(v):
    since = trades.last_snapshot_or_hour_ago(v.m1, v.snapshots, F.lit(False))
    docs = trades.live_closed_documents(v.closed_trades, since)
    return docs.select("symbol", F.size("trades").cast("long").alias("n_trades"),
                       F.round(F.aggregate("trades", F.lit(0.0), lambda a, t: a + t["profit"]), 4).alias("profit"),
                       F.element_at("trades", 1)["close_time"].alias("newest"))


@query("d06_live_trade_fields", f"""SELECT * FROM (SELECT s.symbol, {place('c.time DESC, c.id DESC', 's.symbol')}, c.symbol AS t_symbol, CAST(c.account_id AS INTEGER) AS t_magic, c.type AS t_order_type,
c.volume AS t_lot_size, c.entry_price AS t_open_price, c.exit_price AS t_close_price, CAST(NULL AS DOUBLE) AS t_sl, CAST(NULL AS DOUBLE) AS t_tp, c.profit AS t_profit,
CAST(NULL AS VARCHAR) AS t_open_time, {ISO.format(t='c.time')} AS t_close_time, CAST(NULL AS INTEGER) AS t_duration_minutes
FROM (SELECT symbol, max(open_time) - INTERVAL 240 HOUR AS since FROM m1 GROUP BY 1) s JOIN closed_trades c ON c.symbol = s.symbol AND c.time > s.since) WHERE place < 50""")
def d06_live_fields(v):
    since = v.m1.groupBy("symbol").agg(F.timestamp_seconds(F.unix_seconds(F.max("open_time")) - 240 * 3600).alias("since"))
    return trade_rows(trades.live_closed_documents(v.closed_trades, since), "symbol")


@query("k06_recent_closed_trades", """SELECT symbol, id, time, profit FROM (SELECT c.*, row_number() OVER (PARTITION BY c.symbol ORDER BY time DESC, id DESC) AS rk
FROM closed_trades c JOIN (SELECT symbol, max(open_time) - INTERVAL 240 HOUR AS since FROM m1 GROUP BY 1) s ON c.symbol = s.symbol
WHERE c.time > s.since) WHERE rk <= 50""")
def k06(v):
    since = v.m1.groupBy("symbol").agg(F.timestamp_seconds(F.unix_seconds(F.max("open_time")) - 240 * 3600).alias("since"))
    return trades.recent_closed(v.closed_trades, since).select("symbol", "id", "time", "profit")


@query("d07_market_state_history", MARKET_SQL)
def d07(v):
    return d.market_state_history(v.m1, v.bars_of("M5"))


@query("d07_market_document", f"""SELECT d.symbol, d.at, {ISO.format(t='d.at')} AS said_at, d.symbol AS said_symbol, d.current_price, d.market_session
FROM ({MARKET_SQL}) d""")
def d07_document(v):
    """Fields of the market document as its JSON text holds them."""
    rows = d.history_snapshots(minute_points(v), v.bars, v.account_state, v.open_trades, v.closed_trades, parts=["market"])
    text = lambda path: F.get_json_object("market_state_json", path)
    return rows.select("symbol", F.col("snapshot_time").alias("at"), text("$.timestamp").alias("said_at"), text("$.symbol").alias("said_symbol"),
                       json_number("market_state_json", "$.current_price").alias("current_price"), text("$.market_session").alias("market_session"))


@query("d07_market_state_live", f"""SELECT symbol, open_time AS at, CASE WHEN coalesce(atr, 0e0) > 1.5e0 THEN 'high' ELSE 'low' END AS volatility,
{SPREAD_A} AS spread, CASE WHEN hour(open_time) BETWEEN 7 AND 16 THEN 'London' WHEN hour(open_time) BETWEEN 13 AND 20 THEN 'NY' ELSE 'Other' END AS session,
false AS news_event FROM ind WHERE timeframe = 'M1' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1""")
def d07_live(v):
    return d.market_state_live(v.indicators)


@query("d08_combined_snapshot", f"""SELECT k.symbol, CAST(sum(k.k) AS BIGINT) AS candles, round(sum(k.cs), 4) + 0e0 AS close_sum,
(SELECT account_id FROM account_state ORDER BY timestamp DESC LIMIT 1) AS account_id,
(SELECT balance FROM account_state ORDER BY timestamp DESC LIMIT 1) AS balance,
(SELECT count(*) FROM open_trades WHERE status IN ('open', 'pending') AND account_id = (SELECT account_id FROM account_state ORDER BY timestamp DESC LIMIT 1)) AS n_trades,
6e0 AS daily_loss_limit_pct FROM {LIVE_K.format(lims=limits_sql(COMPACT_LIMITS))} k GROUP BY 1""")
def d08(v):
    docs = d.combined_snapshot(v.indicators, v.account_state, v.open_trades, v.planned_trades)
    flat = F.flatten(F.map_values("ohlc"))
    return docs.select("symbol", F.size(flat).cast("long").alias("candles"),
                       F.round(F.aggregate(flat, F.lit(0.0), lambda a, c: a + c["close"]), 4).alias("close_sum"), "account_id",
                       "account.balance", F.coalesce(F.size("trades"), F.lit(0)).cast("long").alias("n_trades"),
                       "limits.daily_loss_limit_pct")


@query("d09_fresh_document", f"""SELECT symbol, {ISO.format(t='open_time')} AS snapshot_time, {session()} AS session, {SPREAD_A} AS spread,
'fresh_data' AS volatility, false AS news_event, 'force_generated' AS data_freshness FROM m1
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) = 1""")
def d09(v):
    return d.fresh_document(v.m1)


@query("d10_validate_documents", f"""SELECT "check", count(*) AS documents, count(*) FILTER (passed) AS passed FROM (
SELECT unnest([struct_pack("check" := 'session_rule', passed := true), struct_pack("check" := 'required_keys', passed := true),
struct_pack("check" := 'snake_case', passed := true), struct_pack("check" := 'candle_count', passed := candles <= 200),
struct_pack("check" := 'outcome_present', passed := max_gain_pct_1h IS NOT NULL AND max_loss_pct_1h IS NOT NULL),
struct_pack("check" := 'volatility_rule', passed := false)], recursive := true) FROM ({D02_SQL})) GROUP BY 1""")
def d10(v):
    """History documents never use the *_price labels, so the old volatility rule never holds."""
    rows = d.validate_pattern(d.history_pattern(minute_points(v), v.indicators))
    return rows.groupBy("check").agg(F.count(F.lit(1)).alias("documents"), F.count_if("passed").alias("passed"))


@query("d11_no_m1_no_document", """SELECT s.symbol, count(m.open_time) > 0 AS has_document FROM (SELECT DISTINCT concat('U', CAST(user_id AS VARCHAR)) AS symbol FROM events) s
LEFT JOIN (SELECT concat('U', CAST(user_id AS VARCHAR)) AS symbol, ts AS open_time FROM events WHERE event_type = 'click') m ON s.symbol = m.symbol GROUP BY 1""")
def d11(v):
    """A symbol (here: a user) without M1 bars (here: clicks) yields no document row."""
    per_user = v.events.withColumn("symbol", F.concat(F.lit("U"), F.col("user_id").cast("string")))
    m1 = per_user.where("event_type = 'click'").select("symbol", F.lit("M1").alias("timeframe"), F.col("ts").alias("open_time"))
    docs = d.newest_m1(m1).select("symbol", F.lit(True).alias("_has"))
    return (per_user.select("symbol").distinct().join(docs, "symbol", "left")
            .select("symbol", F.coalesce("_has", F.lit(False)).alias("has_document")))


@query("d12_history_backfill", f"""SELECT h.symbol, h.at AS snapshot_time,
a.balance IS NOT NULL AS has_account, coalesce(o.n, 0) > 0 AS has_open, coalesce(c.n, 0) > 0 AS has_closed, a.balance AS balance,
coalesce(o.n, 0) AS n_open, coalesce(c.n, 0) AS n_closed
FROM {MINUTE_POINTS} h ASOF LEFT JOIN account_state a ON a.symbol = h.symbol AND h.at >= a.timestamp
LEFT JOIN (SELECT p.symbol, p.at, count(*) AS n FROM {MINUTE_POINTS} p JOIN open_trades o ON p.symbol = o.symbol AND o.open_time <= p.at
AND (o.close_time IS NULL OR o.close_time > p.at) GROUP BY 1, 2) o ON o.symbol = h.symbol AND o.at = h.at
LEFT JOIN (SELECT p.symbol, p.at, count(*) AS n FROM {MINUTE_POINTS} p JOIN closed_trades c ON p.symbol = c.symbol AND c.time <= p.at
AND c.time > p.at - INTERVAL 24 HOUR GROUP BY 1, 2) c ON c.symbol = h.symbol AND c.at = h.at""")
def d12(v):
    rows = d.history_snapshots(minute_points(v), v.bars, v.account_state, v.open_trades, v.closed_trades,
                               parts=["account", "open_trades", "closed_trades"])
    n = lambda c: F.json_array_length(c).cast("long")
    return rows.select("symbol", "snapshot_time", F.col("account_state_json").isNotNull().alias("has_account"),
                       (n("open_trades_json") > 0).alias("has_open"), (n("closed_trades_json") > 0).alias("has_closed"),
                       json_number("account_state_json", "$.balance").alias("balance"), n("open_trades_json").alias("n_open"),
                       n("closed_trades_json").alias("n_closed"))


@query("a42_document_completeness", f"""SELECT count(*) AS total, count(a.balance) AS account_state_json_present,
count(m.volume_24h) AS market_state_json_present FROM {MINUTE_POINTS} h
ASOF LEFT JOIN account_state a ON a.symbol = h.symbol AND h.at >= a.timestamp
LEFT JOIN (SELECT symbol, open_time, 1 AS volume_24h FROM m1) m ON m.symbol = h.symbol AND m.open_time = h.at""")
def a42(v):
    rows = d.history_snapshots(minute_points(v), v.bars, v.account_state, v.open_trades, v.closed_trades, parts=["account", "market"])
    return quality.documents_present(rows, ["account_state_json", "market_state_json"])


@query("d13_live_exporters", f"""SELECT l.symbol, l.at AS snapshot_time, 5 + CAST(EXISTS (SELECT 1 FROM closed_trades c WHERE c.symbol = l.symbol
AND c.time > l.at - INTERVAL 1 HOUR) AS INTEGER) AS exported FROM {LATEST} l""")
def d13(v):
    return d.live_snapshots(v.indicators, v.account_state, v.open_trades, v.closed_trades, v.planned_trades).select(
        "symbol", "snapshot_time", "exported")


@query("a40_outcome_by_volatility", f"""SELECT volatility, count(*) AS total, count(gain) AS with_gain, round(avg(gain), 4) + 0e0 AS avg_gain,
round(avg(loss), 4) + 0e0 AS avg_loss, max(gain) AS max_gain, min(loss) AS min_loss
FROM (SELECT volatility, max_gain_pct_1h AS gain, max_loss_pct_1h AS loss FROM ({D02_SQL})) GROUP BY 1""")
def a40(v):
    return quality.by_label(_json_outcomes(v), "volatility")


def _json_outcomes(v):
    """Label and outcome values read back from the JSON text of the documents."""
    docs = d.history_pattern(minute_points(v), v.indicators)
    text = docs.select(json_text(F.struct("session", "volatility", "outcome_1h")).alias("j"))
    return text.select(F.get_json_object("j", "$.session").alias("session"), F.get_json_object("j", "$.volatility").alias("volatility"),
                       json_number("j", "$.outcome_1h.max_gain_pct_1h").alias("gain"),
                       json_number("j", "$.outcome_1h.max_loss_pct_1h").alias("loss"))


@query("a40_outcome_by_session", f"""SELECT session, count(*) AS total, count(gain) AS with_gain, round(avg(gain), 4) + 0e0 AS avg_gain,
round(avg(loss), 4) + 0e0 AS avg_loss, max(gain) AS max_gain, min(loss) AS min_loss FROM (SELECT {session()} AS session,
{ONE_SIDED.format(p='close_price').replace('max_gain_pct_1h', 'gain').replace('max_loss_pct_1h', 'loss')} FROM fwd) GROUP BY 1""")
def a40_session(v):
    return quality.by_label(_json_outcomes(v), "session")


@query("a41_exploded_candle_counts", f"""SELECT k.timeframe, count(*) AS candles, count(*) FILTER (b.rsi IS NULL) AS rsi_null,
count(*) FILTER (b.rsi > 70) AS overbought, count(*) FILTER (b.atr > 0) AS atr_positive
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, timeframe ORDER BY open_time DESC) AS rk FROM ind) b
JOIN {limits_sql(PATTERN_LIMITS).replace('lims(', 'k(')} ON k.timeframe = b.timeframe AND b.rk <= k.lim GROUP BY 1""")
def a41(v):
    rows = d.live_pattern(d.recent_with_indicators(v.bars)).select(F.explode("context").alias("timeframe", "candles")).select(
        "timeframe", F.explode("candles").alias("c"))
    return rows.groupBy("timeframe").agg(
        F.count(F.lit(1)).alias("candles"), F.count_if(F.col("c.rsi").isNull()).alias("rsi_null"),
        F.count_if(F.col("c.rsi") > 70).alias("overbought"), F.count_if(F.col("c.atr") > 0).alias("atr_positive"))


@query("p33_expected_volatility", f"""SELECT CASE WHEN atr > 5 THEN 'high' ELSE 'low' END AS expected, volatility, count(*) AS total FROM (
SELECT max(CASE WHEN p.timeframe = 'H1' THEN c.atr END) AS atr, {tier_sql({t: f"max(CASE WHEN p.timeframe = '{t}' THEN c.atr END)" for t in TIERS})} AS volatility
FROM (SELECT * FROM (SELECT symbol, open_time AS at FROM m1) CROSS JOIN (SELECT timeframe FROM {limits_sql(PATTERN_LIMITS)})) p
ASOF LEFT JOIN ({FRAMES}) c ON p.symbol = c.symbol AND p.timeframe = c.timeframe AND p.at >= c.open_time GROUP BY p.symbol, p.at) GROUP BY 1, 2""")
def p33(v):
    docs = d.history_pattern(minute_points(v), v.indicators)
    expected = F.when(_inner("atr", "H1") > 5.0, "high").otherwise("low")
    return docs.groupBy(expected.alias("expected"), "volatility").agg(F.count(F.lit(1)).alias("total"))
