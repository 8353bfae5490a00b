"""Checks of projections, predicates, classifiers, scalar functions and monitoring."""
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import SERIES as OVER
from tickloom.catalog.oracle_views import half_up, session
from tickloom.catalog.q_quality import NOW, SPREAD_A
from tickloom.catalog.q_joins import limits_sql
from tickloom.constants import INDICATOR_COLUMNS, PATTERN_LIMITS
from tickloom.functions import classify, scalar
from tickloom.operators import outcome
from tickloom.operators.resample import floor_time
from tickloom.plans import documents, monitor, sentiment
from tickloom.session import shared_dir
from tickloom.sources import sinks

KEYS = ["symbol", "timeframe", "open_time"]
KEYSQL = "symbol, timeframe, open_time"
ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S+00:00')"


@query("p01_candle_projection", f"""SELECT symbol, timeframe, {ISO.format(t='open_time')} AS open_time, open_price AS open, high_price AS high, low_price AS low,
close_price AS close, volume, round(coalesce(stochastic_k, 0e0), 6) + 0e0 AS stoch_k, round(coalesce(stochastic_d, 0e0), 6) + 0e0 AS stoch_d,
round(coalesce(willr, 0e0), 6) + 0e0 AS willr FROM ind""")
def p01(v):
    c = v.indicators.select("symbol", "timeframe", F.struct(*documents.candle(INDICATOR_COLUMNS, zero_nulls=True)).alias("c"))
    return c.select("symbol", "timeframe", "c.open_time", "c.open", "c.high", "c.low", "c.close", "c.volume",
                    *[F.round(f"c.{n}", 6).alias(n) for n in ("stoch_k", "stoch_d", "willr")])


@query("p02_narrow_candle", f"SELECT symbol, timeframe, {ISO.format(t='open_time')} AS open_time, close_price AS close, {rs('rsi', 'ema', 'atr')} FROM ind")
def p02(v):
    c = v.indicators.select("symbol", "timeframe", F.struct(*documents.candle()).alias("c"))
    return c.select("symbol", "timeframe", "c.open_time", "c.close", *[F.round(f"c.{n}", 6).alias(n) for n in ("rsi", "ema", "atr")])


def session_query(name, fn, sql):
    @query(name, f"SELECT {KEYSQL}, {sql} AS session FROM bars")
    def _(v):
        return v.bars.select(*KEYS, fn().alias("session"))


session_query("p04_session_pattern", classify.session_pattern, session())
session_query("p06_session_market_live", classify.session_market_live,
              "CASE WHEN hour(open_time) BETWEEN 7 AND 16 THEN 'London' WHEN hour(open_time) BETWEEN 13 AND 20 THEN 'NY' ELSE 'Other' END")
session_query("p07_session_market_history", classify.session_market_history,
              "CASE WHEN hour(open_time) <= 5 THEN 'Asian' WHEN hour(open_time) <= 13 THEN 'European' WHEN hour(open_time) <= 21 THEN 'American' ELSE 'Asian' END")
session_query("p08_session_dashboard", classify.session_dashboard,
              "CASE WHEN hour(open_time) >= 22 OR hour(open_time) <= 6 THEN 'Sydney' WHEN hour(open_time) BETWEEN 8 AND 16 THEN 'London' "
              "WHEN hour(open_time) BETWEEN 17 AND 21 THEN 'New York' ELSE 'Transition' END")


@query("p05_session_bridge_from_text", f"SELECT event_id, {session('ts', 'New_York')} AS session FROM events")
def p05(v):
    """The bridge accepts ISO text; it is parsed as UTC."""
    text = v.events.select("event_id", scalar.utc_text("ts").alias("text"))
    return text.select("event_id", classify.session_bridge(F.col("text").cast("timestamp")).alias("session"))


@query("p10_volatility_atr", f"""SELECT {KEYSQL}, CASE WHEN atr IS NULL THEN 'no_data' WHEN atr > hi THEN 'high' WHEN atr > mid THEN 'medium' ELSE 'low' END AS volatility
FROM ind JOIN (VALUES ('H1', 15e0, 8e0), ('H4', 25e0, 12e0), ('M15', 6e0, 3e0), ('M5', 3e0, 1.5e0)) AS lims(timeframe, hi, mid) USING (timeframe)""")
def p10(v):
    rows = v.indicators.where(F.col("timeframe").isin("H1", "H4", "M15", "M5"))
    atr = {tf: F.when(F.col("timeframe") == tf, F.col("atr")) for tf in ("H1", "H4", "M15", "M5")}
    return rows.select(*KEYS, classify.volatility_pattern(atr).alias("volatility"))


@query("p11_volatility_range_fallback", """SELECT symbol, open_time, CASE WHEN r4 > 20 THEN 'high_price' WHEN r4 > 10 THEN 'medium_price' WHEN r4 <> 0 THEN 'low_price'
WHEN r1 > 8 THEN 'high_price' WHEN r1 > 4 THEN 'medium_price' WHEN r1 <> 0 THEN 'low_price' ELSE 'no_data' END AS volatility FROM (
SELECT symbol, open_time, round(max(high_price) OVER w1 - min(low_price) OVER w1, 2) AS r1, round(max(high_price) OVER w4 - min(low_price) OVER w4, 2) AS r4
FROM m1 WINDOW w1 AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW),
w4 AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW))""")
def p11(v):
    return outcome.trailing_ranges(v.m1).select(
        "symbol", "open_time", classify.volatility_pattern({}, "price_range_1h", "price_range_4h").alias("volatility"))


@query("p12_volatility_live", "SELECT symbol, open_time, CASE WHEN coalesce(atr, 0e0) > 1.5e0 THEN 'high' ELSE 'low' END AS volatility FROM ind WHERE timeframe = 'M1'")
def p12(v):
    from tickloom.operators.indicators import stored_indicators
    return stored_indicators(v.m1, ["atr"]).select("symbol", "open_time", classify.volatility_live("atr").alias("volatility"))


@query("p13_volatility_score", f"SELECT {KEYSQL}, coalesce(CASE WHEN open_price <> 0 AND high_price <> 0 AND low_price <> 0 THEN "
       "round((high_price - low_price) / open_price * 100, 4) END, 0e0) + 0e0 AS volatility_score FROM bars")
def p13(v):
    return v.bars.select(*KEYS, classify.volatility_score().alias("volatility_score"))


@query("p14_regime", "SELECT symbol, timeframe, CASE WHEN sd > 2 THEN 'high' WHEN sd < 0.5e0 THEN 'low' ELSE 'medium' END AS regime FROM "
       "(SELECT symbol, timeframe, stddev_pop((high_price - low_price) / nullif(low_price, 0e0) * 100e0) AS sd FROM bars GROUP BY 1, 2)")
def p14(v):
    from tickloom.operators.indicators import ratio
    feature = ratio(F.col("high_price") - F.col("low_price"), "low_price") * 100
    return v.bars.groupBy("symbol", "timeframe").agg(F.stddev_pop(feature).alias("sd")).select(
        "symbol", "timeframe", classify.regime("sd").alias("regime"))


@query("p15_spread_from_range", f"SELECT {KEYSQL}, {SPREAD_A} AS spread_a FROM bars")
def p15(v):
    return v.bars.select(*KEYS, classify.spread_from_range().alias("spread_a"))


@query("p16_spread_range", f"SELECT {KEYSQL}, round(high_price - low_price, 5) AS spread_b FROM bars")
def p16(v):
    return v.bars.select(*KEYS, classify.spread_range().alias("spread_b"))


NAMED = "CASE symbol WHEN 'S0' THEN 'XAUUSD' WHEN 'S1' THEN 'EURUSD' WHEN 'S2' THEN 'GBPUSD' WHEN 'S3' THEN 'USDJPY' ELSE 'AUDUSD' END"
DEFAULTS = f"CASE {NAMED} WHEN 'XAUUSD' THEN 0.3e0 WHEN 'EURUSD' THEN 0.00015e0 WHEN 'GBPUSD' THEN 0.0002e0 WHEN 'USDJPY' THEN 0.015e0 ELSE 0.0001e0 END"


def named(v):
    return v.bars.withColumn("symbol", F.expr(NAMED))


@query("p17_spread_default", f"SELECT {NAMED} AS symbol, timeframe, open_time, coalesce(nullif(spread, 0e0), {DEFAULTS}) AS estimated_spread FROM bars")
def p17(v):
    return named(v).select(*KEYS, classify.spread_default().alias("estimated_spread"))


@query("p18_bar_enrichment", f"""SELECT {NAMED} AS symbol, timeframe, open_time, coalesce(nullif(spread, 0e0), {DEFAULTS}) AS estimated_spread,
{session(ny='New_York')} AS trading_session, coalesce(CASE WHEN open_price <> 0 AND high_price <> 0 AND low_price <> 0 THEN
round((high_price - low_price) / open_price * 100, 4) END, 0e0) + 0e0 AS volatility_score,
coalesce(CASE WHEN open_price <> 0 AND close_price <> 0 THEN round((close_price - open_price) / open_price * 100, 4) END, 0e0) + 0e0 AS price_change_pct,
{NOW} AS processed_at FROM bars""")
def p18(v):
    out = classify.enrich_bars(named(v), processed_at=v.now(v.bars))
    return out.select(*KEYS, "estimated_spread", "trading_session", "volatility_score", "price_change_pct", "processed_at")


@query("p19_account_health", """SELECT account_id, timestamp, CASE WHEN balance > 0 THEN round(equity / balance * 100, 6) END AS equity_ratio,
CASE WHEN balance > 0 THEN round(profit / balance * 100, 6) + 0e0 END AS profit_pct FROM account_state""")
def p19(v):
    return v.account_state.select("account_id", "timestamp", *[F.round(c, 6).alias(n) for n, c in classify.account_health().items()])


@query("p20_trade_result", "SELECT id, profit, CASE WHEN profit > 0 THEN 'profit' WHEN profit < 0 THEN 'loss' ELSE 'breakeven' END AS result FROM closed_trades")
def p20(v):
    return v.closed_trades.select("id", "profit", classify.trade_result().alias("result"))


@query("p21_trade_duration", "SELECT trade_id, coalesce((epoch_us(close_time) - epoch_us(open_time)) // 60000000, 0) AS minutes FROM open_trades")
def p21(v):
    return v.open_trades.select("trade_id", classify.duration_minutes("open_time", "close_time").alias("minutes"))


AGE = f"(epoch_us({NOW}) - epoch_us(max(open_time))) / 60e6"


@query("p22_freshness_tier", f"""SELECT symbol, timeframe, CASE WHEN {AGE} <= 2 THEN 'Ready for Force-Fresh' WHEN {AGE} <= 5 THEN 'Usable' ELSE 'Too Stale' END AS tier
FROM bars GROUP BY 1, 2""")
def p22(v):
    newest = v.bars.groupBy("symbol", "timeframe").agg(F.max("open_time").alias("t"))
    return newest.select("symbol", "timeframe", classify.freshness_tier(classify.age_minutes("t", v.now(v.bars))).alias("tier"))


@query("p23_age_minutes", f"SELECT symbol, timeframe, round({AGE}, 4) AS age_minutes FROM bars GROUP BY 1, 2")
def p23(v):
    newest = v.bars.groupBy("symbol", "timeframe").agg(F.max("open_time").alias("t"))
    return newest.select("symbol", "timeframe", F.round(classify.age_minutes("t", v.now(v.bars)), 4).alias("age_minutes"))


@query("p27_numeric_text", "SELECT event_id, regexp_matches(json_extract_string(props, '$.k'), '^[0-9.]+$') AS numeric, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def p27(v):
    k = F.get_json_object("props", "$.k")
    return v.events.select("event_id", classify.is_numeric_text(k).alias("numeric"), k.try_cast("double").alias("k"))


@query("p28_two_decimals", "SELECT event_id, regexp_matches(CAST(value AS VARCHAR), '^[0-9]+\\.[0-9]{2}$') AS two_decimals FROM events")
def p28(v):
    return v.events.select("event_id", classify.has_two_decimals(F.col("value").cast("string")).alias("two_decimals"))


@query("p29_source_filter", f"SELECT {KEYSQL}, data_source FROM bars WHERE data_source LIKE '%lic%'")
def p29(v):
    return v.bars.where(F.col("data_source").like("%lic%")).select(*KEYS, "data_source")


@query("p30_status_filter", "SELECT trade_id, status FROM open_trades WHERE status IN ('open', 'pending')")
def p30(v):
    return v.open_trades.where(F.col("status").isin("open", "pending")).select("trade_id", "status")


@query("p31_bar_gain_loss", f"SELECT {KEYSQL}, round((high_price - open_price) / nullif(open_price, 0e0) * 100, 6) + 0e0 AS gain_pct, "
       "round((low_price - open_price) / nullif(open_price, 0e0) * 100, 6) + 0e0 AS loss_pct FROM bars")
def p31(v):
    o = F.col("open_price")
    pct = lambda c: F.round(F.try_divide(F.col(c) - o, o) * 100, 6)
    return v.bars.select(*KEYS, pct("high_price").alias("gain_pct"), pct("low_price").alias("loss_pct"))


# --- scalar functions ------------------------------------------------------------

@query("f01_math", f"SELECT event_id, {half_up('value * 0.1e0', 2)} AS r2, abs(value - 50) AS a, greatest(value, 50e0) AS g, least(value, 50e0) AS l, "
       "CAST(sign(value - 50) AS DOUBLE) AS s, round(sqrt(value), 6) AS q FROM events")
def f01(v):
    x = F.col("value")
    return v.events.select("event_id", F.round(x * 0.1, 2).alias("r2"), F.abs(x - 50).alias("a"), F.greatest(x, F.lit(50.0)).alias("g"),
                           F.least(x, F.lit(50.0)).alias("l"), F.signum(x - 50).alias("s"), F.round(F.sqrt(x), 6).alias("q"))


@query("f02_safe_division", "SELECT event_id, round(value / nullif(user_id % 3, 0), 6) AS q FROM events")
def f02(v):
    return v.events.select("event_id", F.round(F.try_divide(F.col("value"), F.col("user_id") % 3), 6).alias("q"))


@query("f03_dates", """SELECT event_id, CAST(hour(ts) AS INTEGER) AS h, CAST(ts AS DATE) AS d, date_trunc('hour', ts) AS hour_start, CAST(isodow(ts) - 1 AS INTEGER) AS wd,
epoch_us(ts) // 1000000 AS epoch, ts + INTERVAL 36 HOUR AS later, make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_ms FROM events""")
def f03(v):
    return v.events.select("event_id", F.hour("ts").alias("h"), F.to_date("ts").alias("d"), F.date_trunc("hour", "ts").alias("hour_start"),
                           F.weekday("ts").alias("wd"), F.unix_seconds("ts").alias("epoch"), (F.col("ts") + F.expr("INTERVAL 36 HOURS")).alias("later"),
                           F.timestamp_millis(F.unix_millis("ts")).alias("from_ms"))


@query("f04_zone", f"SELECT event_id, {ISO.format(t='ts')} AS utc, ts - INTERVAL 2 HOUR AS from_plus_two FROM events")
def f04(v):
    return v.events.select("event_id", scalar.utc_text(scalar.to_utc("ts")).alias("utc"), scalar.to_utc("ts", "+02:00").alias("from_plus_two"))


@query("f05_strings", "SELECT event_id, upper(event_type) AS u, split_part(concat(event_type, '-', symbol), '-', 2) AS s, event_type LIKE '%ew%' AS lk, "
       "concat(event_type, '|', user_id) AS cc, printf('%.2f', value) AS f2 FROM (SELECT *, concat('S', user_id % 5) AS symbol FROM events)")
def f05(v):
    joined = F.concat(F.col("event_type"), F.lit("-"), F.col("symbol"))
    return v.events.select("event_id", F.upper("event_type").alias("u"), F.split(joined, "-")[1].alias("s"), F.col("event_type").like("%ew%").alias("lk"),
                           F.concat(F.col("event_type"), F.lit("|"), F.col("user_id").cast("string")).alias("cc"), F.format_string("%.2f", "value").alias("f2"))


@query("f06_conditional", "SELECT event_id, CASE WHEN value > 50 THEN 'big' WHEN value > 10 THEN 'mid' ELSE 'small' END AS c, coalesce(CASE WHEN value > 50 THEN value END, -1e0) AS d FROM events")
def f06(v):
    x = F.col("value")
    return v.events.select("event_id", F.when(x > 50, "big").when(x > 10, "mid").otherwise("small").alias("c"),
                           F.coalesce(F.when(x > 50, x), F.lit(-1.0)).alias("d"))


@query("f07_json_read", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, list_contains(json_keys(props), 'k') AS has_k,
list_contains(json_keys(props), 'zz') AS has_zz FROM events""")
def f07(v):
    return v.events.select("event_id", scalar.json_number("props", "$.k").alias("k"), scalar.json_has_key("props", "k").alias("has_k"),
                           scalar.json_has_key("props", "zz").alias("has_zz"))


@query("f08_json_arrays", f"""SELECT symbol, timeframe, count(*) AS elements, count(*) AS array_length FROM (SELECT b.symbol, b.timeframe, l.lim,
row_number() OVER (PARTITION BY b.symbol, b.timeframe ORDER BY b.open_time DESC) AS rk FROM bars b JOIN {limits_sql(PATTERN_LIMITS).replace('lims(', 'l(')}
ON l.timeframe = b.timeframe) WHERE rk <= lim GROUP BY 1, 2""")
def f08(v):
    """Lengths of the candle arrays of the pattern documents, as JSON, and their elements exploded again."""
    from tickloom.operators.asof import last_per_timeframe
    text = last_per_timeframe(v.bars, PATTERN_LIMITS).groupBy("symbol", "timeframe").agg(F.to_json(F.collect_list("close_price")).alias("j"))
    rows = text.select("symbol", "timeframe", F.json_array_length("j").cast("long").alias("array_length"),
                       F.explode(F.from_json("j", "array<double>")).alias("x"))
    return rows.groupBy("symbol", "timeframe", "array_length").agg(F.count("x").alias("elements"))


@query("f09_json_keys", "SELECT key, count(*) AS documents FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1")
def f09(v):
    return v.events.select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("documents"))


@query("f10_json_text", """SELECT event_id, concat('{"t":"', event_type, '","v":', CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'null' END, '}') AS j,
length(concat('{"t":"', event_type, '","v":', CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'null' END, '}')) AS n FROM events""")
def f10(v):
    j = scalar.json_text(F.struct(F.col("event_type").alias("t"), F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("v")))
    return v.events.select("event_id", j.alias("j"), F.length(j).cast("long").alias("n"))


@query("f11_key_case", """SELECT key, count(*) AS documents FROM (SELECT CASE WHEN event_id % 3 = 0 THEN concat(event_type, 'Gain') ELSE concat(event_type, '_gain') END AS key FROM events)
WHERE NOT regexp_full_match(key, '[a-z][a-z0-9_]*') GROUP BY 1""")
def f11(v):
    """Keys of JSON documents (here named after each event) that are not snake_case."""
    kind = F.when(F.col("event_id") % 3 == 0, F.concat("event_type", F.lit("Gain"))).otherwise(F.concat("event_type", F.lit("_gain")))
    text = v.events.select(F.to_json(F.create_map(kind, "value")).alias("j"))
    keys = text.select(F.explode(F.json_object_keys("j")).alias("key")).where(~F.col("key").rlike("^[a-z][a-z0-9_]*$"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("documents"))


@query("f12_arrays", "SELECT vec_id, list_slice(vector, -5, -1) AS tail, list_reverse(list_slice(vector, 1, 3)) AS head_reversed, list_concat(list_slice(vector, 1, 1), list_slice(vector, -1, -1)) AS ends FROM vectors")
def f12(v):
    x = F.col("vector")
    return v.vectors.select("vec_id", F.slice(x, -5, 5).alias("tail"), F.reverse(F.slice(x, 1, 3)).alias("head_reversed"),
                            F.concat(F.slice(x, 1, 1), F.slice(x, -1, 1)).alias("ends"))


@query("f13_maps", f"SELECT symbol, timeframe, round(arg_max(rsi, open_time), 6) + 0e0 AS rsi, round(arg_max(atr, open_time), 6) + 0e0 AS atr FROM ind WHERE rsi IS NOT NULL GROUP BY 1, 2")
def f13(v):
    """indicator -> timeframe -> value maps of the newest rows, read back by key."""
    newest = v.indicators.where("rsi is not null").groupBy("symbol", "timeframe").agg(
        F.max_by(F.struct("rsi", "atr"), "open_time").alias("x"))
    doc = newest.groupBy("symbol").agg(F.map_from_entries(F.collect_list(F.struct("timeframe", "x.rsi"))).alias("r"),
                                       F.map_from_entries(F.collect_list(F.struct("timeframe", "x.atr"))).alias("a"))
    doc = doc.select("symbol", F.create_map(F.lit("rsi"), "r", F.lit("atr"), "a").alias("m"))
    return doc.select("symbol", F.explode(F.map_keys(F.col("m")["rsi"])).alias("timeframe"), "m").select(
        "symbol", "timeframe", *[F.round(F.col("m")[n][F.col("timeframe")], 6).alias(n) for n in ("rsi", "atr")])


@query("f14_candidate_field", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN value + 1 ELSE value + 2 END AS gain FROM events")
def f14(v):
    """First present of three alternative field names inside H1."""
    x = F.col("value")
    name = [F.struct(x.alias("max_gain")), F.struct((x + 1).alias("max_gain_pct")), F.struct((x + 2).alias("maxGain"))]
    j = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(name[0].alias("H1")))).when(
        F.col("event_id") % 3 == 1, F.to_json(F.struct(name[1].alias("H1")))).otherwise(F.to_json(F.struct(name[2].alias("H1"))))
    return v.events.select("event_id", scalar.first_present(j, ["$.H1.max_gain", "$.H1.max_gain_pct", "$.H1.maxGain"]).cast("double").alias("gain"))


@query("f15_document_structure", "SELECT timeframe, k AS key, count(*) AS documents FROM (SELECT timeframe, unnest(['open', 'max_gain']) AS k FROM bars) GROUP BY 1, 2")
def f15(v):
    """Keys of JSON documents per timeframe."""
    text = v.bars.select("timeframe", F.to_json(F.struct(F.col("open_price").alias("open"), F.col("high_price").alias("max_gain"))).alias("j"))
    return text.select("timeframe", F.explode(F.json_object_keys("j")).alias("key")).groupBy("timeframe", "key").agg(F.count(F.lit(1)).alias("documents"))


@query("p_safe_casts", "SELECT event_id, coalesce(TRY_CAST(t AS DOUBLE), 0e0) AS f, TRY_CAST(t AS DOUBLE) AS fn, CASE WHEN TRY_CAST(t AS DOUBLE) IS NULL OR t LIKE '%.%' THEN 0 ELSE CAST(t AS INTEGER) END AS i FROM "
       "(SELECT event_id, CASE event_id % 3 WHEN 0 THEN printf('%.2f', value) WHEN 1 THEN CAST(event_id AS VARCHAR) ELSE event_type END AS t FROM events)")
def safe_casts(v):
    t = F.when(F.col("event_id") % 3 == 0, F.format_string("%.2f", "value")).when(F.col("event_id") % 3 == 1, F.col("event_id").cast("string")).otherwise(F.col("event_type"))
    return v.events.select("event_id", scalar.safe_float(t).alias("f"), scalar.safe_float_nullable(t).alias("fn"), scalar.safe_int(t).alias("i"))


@query("u01_sql_function", f"SELECT {KEYSQL}, {session(ny='New_York')} AS session FROM bars")
def u01(v):
    from tickloom.functions.sqlfuncs import register
    register(v.spark)
    return v.bars.select(*KEYS, F.expr("get_trading_session(open_time)").alias("session"))


@query("u03_set_returning", "SELECT timeframe, 'v' AS kind, count(*) AS n FROM bars GROUP BY 1")
def u03(v):
    """VALUES list / inline of array elements per row, re-aggregated."""
    rows = v.bars.select(F.inline(F.array(F.struct("timeframe", F.lit("v").alias("kind")))))
    return rows.groupBy("timeframe", "kind").agg(F.count(F.lit(1)).alias("n"))


# --- monitoring --------------------------------------------------------------------

FRESH = f"""SELECT s.symbol, max(b.open_time) AS latest_data_time, (epoch_us({NOW}) - epoch_us(max(b.open_time))) / 60e6 AS age FROM
(SELECT DISTINCT symbol FROM bars UNION ALL SELECT 'XAUUSD') s LEFT JOIN bars b ON b.symbol = s.symbol GROUP BY 1"""


def watched(v):
    """All symbols of the data and one that has no rows."""
    return v.bars.select("symbol").distinct().unionByName(v.spark.range(1).select(F.lit("XAUUSD").alias("symbol")))


@query("a36_symbol_freshness", f"SELECT symbol, latest_data_time, round(coalesce(age, CAST('inf' AS DOUBLE)), 4) AS minutes_since_data, coalesce(age <= 5, false) AS is_fresh, "
       f"coalesce(age <= 2, false) AS is_connected FROM ({FRESH})")
def a36(v):
    f = monitor.freshness(watched(v), v.bars, v.now(v.bars))
    return f.select("symbol", "latest_data_time", F.round("minutes_since_data", 4).alias("minutes_since_data"), "is_fresh", "is_connected")


@query("a37_overall_health", f"""SELECT fresh AS symbols_fresh, con AS symbols_connected, total AS total_symbols, CASE WHEN fresh * 1e0 / total < 0.5e0 THEN 'critical'
WHEN fresh * 1e0 / total < 0.8e0 THEN 'degraded' ELSE 'healthy' END AS overall_health FROM (SELECT count(*) FILTER (age <= 5) AS fresh, count(*) FILTER (age <= 2) AS con, count(*) AS total FROM ({FRESH}))""")
def a37(v):
    return monitor.overall_health(monitor.freshness(watched(v), v.bars, v.now(v.bars)))


@query("a34_connection_health", f"""SELECT count(*) AS total_records, count(DISTINCT symbol) AS active_symbols, min(open_time) AS oldest, max(open_time) AS newest,
count(*) FILTER (data_source LIKE '%view%') AS source_records, count(*) > 0 AND count(DISTINCT symbol) >= 4 AS is_healthy FROM bars WHERE open_time >= {NOW} - INTERVAL 1 HOUR""")
def a34(v):
    return monitor.connection_health(v.bars, v.now(v.bars), n_symbols=5, source_pattern="%view%")


@query("a35_source_count", f"SELECT count(*) FILTER (data_source LIKE '%view%') AS source_records FROM bars WHERE open_time >= {NOW} - INTERVAL 1 HOUR")
def a35(v):
    return monitor.connection_health(v.bars, v.now(v.bars), 5, "%view%").select("source_records")


TRAIL = f"(SELECT *, avg(spread) OVER (PARTITION BY symbol ORDER BY open_time, timeframe ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_spread FROM bars WHERE spread > 0"


@query("w01_trailing_mean", f"SELECT {KEYSQL}, spread, round(avg_spread, 6) + 0e0 AS avg_spread FROM {TRAIL})")
def w01(v):
    return monitor.trailing_spread(v.bars).select(*KEYS, "spread", r("avg_spread"))


@query("w02_spread_anomaly", f"""SELECT symbol, spread AS latest_spread, round(m, 6) + 0e0 AS average_spread, spread > 3 * m AS is_anomaly, round(spread / m, 6) + 0e0 AS anomaly_factor FROM (
SELECT *, coalesce(nullif(avg_spread, 0e0), spread) AS m FROM {TRAIL} AND open_time >= {NOW} - INTERVAL 48 HOUR)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC, timeframe DESC) = 1)""")
def w02(v):
    out = monitor.spread_anomalies(v.bars, v.now(v.bars), seconds=48 * 3600)
    return out.select("symbol", "latest_spread", r("average_spread"), "is_anomaly", r("anomaly_factor"))


@query("w09_latest_per_group", "SELECT symbol, timeframe, max(open_time) AS open_time, arg_max(close_price, open_time) AS close_price FROM bars GROUP BY 1, 2")
def w09(v):
    from tickloom.operators.asof import latest_per_key
    return latest_per_key(v.bars, ["symbol", "timeframe"], "open_time", columns=["open_time", "close_price"])


@query("j12_timeframe_rank", f"SELECT symbol, timeframe, open_time FROM bars QUALIFY rank() OVER (PARTITION BY symbol, timeframe ORDER BY open_time DESC) = 1")
def j12_rank(v):
    from tickloom.operators.asof import top_n
    return top_n(v.bars, 1).select(*KEYS)


@query("s28_monitoring_log", f"""SELECT overall_health, symbols_fresh, total_symbols, {NOW} AS timestamp FROM (SELECT fresh AS symbols_fresh, total AS total_symbols, CASE WHEN fresh * 1e0 / total < 0.5e0 THEN 'critical'
WHEN fresh * 1e0 / total < 0.8e0 THEN 'degraded' ELSE 'healthy' END AS overall_health FROM (SELECT count(*) FILTER (age <= 5) AS fresh, count(*) AS total FROM ({FRESH})))""")
def s28(v):
    """One monitoring cycle appended to the log and read back."""
    path = shared_dir(v.spark, "log")
    now = v.now(v.bars)
    row = monitor.report_row(monitor.freshness(watched(v), v.bars, now), monitor.spread_anomalies(v.bars, now),
                             monitor.connection_health(v.bars, now, n_symbols=5), now)
    sinks.append_log(row, path)
    return v.spark.read.parquet(path).select("overall_health", "symbols_fresh", "total_symbols", "timestamp")


@query("s29_last_log_rows", f"SELECT timestamp, n FROM (SELECT date_trunc('hour', ts) AS timestamp, count(*) AS n FROM events GROUP BY 1) ORDER BY timestamp DESC LIMIT 24")
def s29(v):
    log = v.events.groupBy(floor_time("ts", 3600).alias("timestamp")).agg(F.count(F.lit(1)).alias("n"))
    return sinks.last_log_rows(log)


@query("t08_alert_rules", f"""SELECT 'stale_data' AS alert_type, symbol, CASE WHEN age < 10 THEN 'warning' ELSE 'critical' END AS severity FROM ({FRESH}) WHERE NOT coalesce(age <= 5, false)
UNION ALL SELECT 'connection_issue', 'ALL', 'critical' FROM (SELECT count(DISTINCT symbol) AS n FROM bars WHERE open_time >= {NOW} - INTERVAL 1 HOUR) WHERE n < 8
UNION ALL SELECT 'spread_anomaly', symbol, 'warning' FROM (SELECT *, coalesce(nullif(avg_spread, 0e0), spread) AS m FROM {TRAIL} AND open_time >= {NOW} - INTERVAL 48 HOUR)
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC, timeframe DESC) = 1) WHERE spread > 3 * m""")
def t08(v):
    now = v.now(v.bars)
    connection = monitor.connection_health(v.bars, now, n_symbols=10)
    out = monitor.alerts(monitor.freshness(watched(v), v.bars, now), monitor.spread_anomalies(v.bars, now, 48 * 3600), connection, now)
    return out.select("alert_type", "symbol", "severity")


# --- sentiment --------------------------------------------------------------------

SENT = ("SELECT currency, avg(score) AS m, stddev_pop(score) AS sd, coalesce(sum(score * relevance) / nullif(sum(relevance), 0e0), 0e0) AS w, count(*) AS n "
        "FROM articles GROUP BY 1")


@query("a47_weighted_sentiment", f"SELECT currency, round(m, 6) + 0e0 AS mean_sentiment, round(sd, 6) + 0e0 AS sentiment_std, round(w, 6) + 0e0 AS weighted_sentiment, n AS article_count, least(n / 10e0, 1e0) AS confidence FROM ({SENT})")
def a47(v):
    return sentiment.sentiment(v.articles).select("currency", r("mean_sentiment"), r("sentiment_std"), r("weighted_sentiment"), "article_count", "confidence")


def pairs(v):
    """Base / quote pairs: every language with its documents' next language by name (at most one per language)."""
    from pyspark.sql import Window
    langs = v.articles.select(F.col("currency").alias("base")).distinct()
    return langs.withColumn("quote", F.lead("base").over(Window.orderBy("base"))).where("quote is not null")


PAIRS = f"(SELECT currency AS base, w AS b, lead(currency) OVER (ORDER BY currency) AS quote, lead(w) OVER (ORDER BY currency) AS q FROM ({SENT}))"


@query("a48_composite_sentiment", f"SELECT currency, round(w, 6) + 0e0 AS composite_sentiment, round(w * 0.8e0, 6) + 0e0 AS base_currency_sentiment, "
       f"round(w * -0.6e0, 6) + 0e0 AS quote_currency_sentiment, n AS news_volume FROM ({SENT})")
def a48(v):
    out = sentiment.composite(sentiment.sentiment(v.articles))
    return out.select("currency", r("composite_sentiment"), r("base_currency_sentiment"), r("quote_currency_sentiment"), "news_volume")


@query("a52_policy_divergence", f"SELECT base, quote, round(abs(b - q), 6) + 0e0 AS policy_divergence FROM {PAIRS} WHERE quote IS NOT NULL")
def a52(v):
    return sentiment.divergence(pairs(v), sentiment.sentiment(v.articles)).select("base", "quote", r("policy_divergence"))


IMPACT = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'high' WHEN event_type = 'click' THEN 'medium' ELSE 'low' END"


@query("a49_event_impact", f"""SELECT symbol, round(sum(CASE impact WHEN 'high' THEN 1e0 WHEN 'medium' THEN 0.6e0 ELSE 0.3e0 END * greatest(0e0, 1e0 - h / 24e0)), 4) + 0e0 AS impact_score, count(*) AS events,
count(*) FILTER (impact = 'high') AS high_impact, count(*) FILTER (impact = 'medium') AS medium_impact, count(*) FILTER (impact = 'low') AS low_impact
FROM (SELECT concat('S', user_id % 5) AS symbol, {IMPACT} AS impact, CAST(hour(ts) * 2 AS DOUBLE) AS h FROM events) GROUP BY 1""")
def a49(v):
    rows = v.events.select("symbol", F.expr(IMPACT).alias("impact"), (F.hour("ts") * 2).cast("double").alias("hours_ahead"))
    return sentiment.impact_score(rows, by=("symbol",)).withColumn("impact_score", F.round("impact_score", 4))
