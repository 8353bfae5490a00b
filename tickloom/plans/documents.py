"""Snapshot documents: nested structs per (symbol, time), JSON text only at the sink.

The live form has one row per symbol (its newest M1 bar); the history form has one
row per requested (symbol, at) and is computed for all of them in one plan.
"""
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import (COMPACT_LIMITS, DOCUMENT_TIMEFRAMES, FULL_LIMITS, INDICATOR_COLUMNS, KEY_INDICATORS,
                                PATTERN_LIMITS)
from tickloom.functions import classify
from tickloom.functions.scalar import json_text, non_snake_case_fields, utc_text
from tickloom.operators import outcome
from tickloom.operators.asof import contexts, last_per_timeframe, latest_per_key
from tickloom.operators.ewm import HORIZON
from tickloom.operators.indicators import stored_indicators
from tickloom.operators.rangejoin import collect_valid_lists
from tickloom.operators.sequence import SERIES, block_window, literal_map, ranged
from tickloom.plans import trades

SHORT_NAMES = {"stochastic_k": "stoch_k", "stochastic_d": "stoch_d"}

# --- fixed values -----------------------------------------------------------
BROKER = {"name": "Fusion Markets", "min_stop": 0.0, "commission_per_lot": 4.0, "commission_currency": "USD",
          "commission_model": "per_lot"}
DAILY_LOSS_LIMIT_PCT = 6.0
REQUIRED_KEYS = ["symbol", "snapshot_time", "context", "indicators", "session", "volatility"]
MAX_CANDLES = 200
#: M1 bars of the four-hour range, both ends included.
RANGE_BARS = 241
# ----------------------------------------------------------------------------


def candle(indicators=KEY_INDICATORS, zero_nulls=False):
    """Candle fields: renamed prices and the chosen indicators."""
    value = (lambda c: F.coalesce(F.col(c), F.lit(0.0))) if zero_nulls else F.col
    return [utc_text("open_time").alias("open_time"), F.col("open_price").alias("open"),
            F.col("high_price").alias("high"), F.col("low_price").alias("low"), F.col("close_price").alias("close"),
            "volume", *[value(c).alias(SHORT_NAMES.get(c, c)) for c in indicators]]


def _by_timeframe(rows, keys):
    """Map timeframe -> candles per key, in document order (at most six entries)."""
    order = literal_map({t: i for i, t in enumerate(DOCUMENT_TIMEFRAMES)})[F.col("timeframe")]
    entry = F.struct(order.alias("o"), F.struct("timeframe", "candles").alias("e"))
    return (rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
            .withColumn("context", F.map_from_entries(F.transform("_e", lambda x: x["e"]))).drop("_e"))


def _history_context(points, bars, limits, fields, visible):
    """Map timeframe -> candles of every point, in document order; no bar yet: no candles."""
    ordered = {t: limits[t] for t in DOCUMENT_TIMEFRAMES if t in limits}
    rows = contexts(points.select("symbol", "at"), bars, fields, ordered, visible)
    empty = rows.select(F.col("context")[0]["candles"]).schema[0].dataType
    entries = F.transform("context", lambda c: F.struct(c["timeframe"], F.coalesce(c["candles"], F.array().cast(empty))))
    return rows.select("symbol", "at", F.map_from_entries(entries).alias("context"))


def _live_context(bars, limits, fields):
    """Last N bars of every timeframe without a time cut."""
    rows = last_per_timeframe(bars, limits).groupBy(*SERIES).agg(
        F.sort_array(F.collect_list(F.struct(F.col("open_time").alias("_k"), F.struct(*fields).alias("_c")))).alias("_l"))
    return _by_timeframe(rows.withColumn("candles", F.transform("_l", lambda x: x["_c"])).drop("_l"), ["symbol"])


def _newest_values(names=("rsi", "ema", "atr")):
    """Map indicator -> timeframe -> value of the newest candle."""
    filled = F.map_filter("context", lambda k, v: F.size(v) > 0)
    newest = lambda n: F.transform_values(filled, lambda k, v: F.element_at(v, -1)[n])
    return F.create_map(*[x for n in names for x in (F.lit(n), newest(n))])


def last_times(context="context"):
    """Map timeframe -> open time of its newest candle, null when empty."""
    return F.transform_values(context, lambda k, v: F.try_element_at(v, F.lit(-1))["open_time"])


def _atr(tf):
    return F.try_element_at(F.try_element_at(F.col("indicators"), F.lit("atr")), F.lit(tf))


def _atrs():
    return {tf: _atr(tf) for tf in ("H1", "H4", "M15", "M5")}


def total_candles(context="context"):
    return F.aggregate(F.map_values(context), F.lit(0), lambda a, v: a + F.size(v))


def newest_m1(bars):
    """(symbol, at) of the newest M1 bar; a symbol without M1 bars has no document."""
    return bars.where("timeframe = 'M1'").groupBy("symbol").agg(F.max("open_time").alias("at"))


# --- pattern ----------------------------------------------------------------------

def history_pattern(points, bars, visible="open"):
    """Pattern document of every point: context, indicators, outcome, session, volatility.
    Missing indicator values are 0.0; outcomes use the M1 bar at exactly that time."""
    ctx = _history_context(points, bars, PATTERN_LIMITS, candle(zero_nulls=True), visible)
    gain, loss = outcome.one_sided()
    later = outcome.forward_stats(bars.where("timeframe = 'M1'").select(*SERIES, "open_time", "high_price", "low_price",
                                                                        "close_price"))
    later = later.select("symbol", F.col("open_time").alias("at"), F.struct(
        gain.alias("max_gain_pct_1h"), loss.alias("max_loss_pct_1h")).alias("outcome_1h"))
    doc = ctx.join(later, ["symbol", "at"], "left").withColumn("indicators", _newest_values())
    return doc.select("symbol", F.col("at"), utc_text("at").alias("snapshot_time"), "context", "indicators", "outcome_1h",
                      classify.session_pattern("at").alias("session"),
                      classify.volatility_pattern(_atrs()).alias("volatility"))


def recent_with_indicators(bars, limits=PATTERN_LIMITS, indicators=KEY_INDICATORS):
    """Of stored bars what a live document looks at, with indicators: the last N bars of each timeframe (and of M1 the four
    hours of its ranges), computed from these and the HORIZON bars before them. Running totals need the whole series."""
    if "obv" in indicators:
        raise ValueError("on-balance volume is a total of the whole series: use a BarTail")
    rows = {tf: max(n, RANGE_BARS if tf == "M1" else 0) + HORIZON for tf, n in limits.items()}
    return stored_indicators(last_per_timeframe(bars, rows), indicators)


def live_pattern(bars):
    """Pattern document of every symbol at its newest M1 bar. Higher timeframes have
    no time cut; missing values stay null; spread and trailing ranges are added."""
    at = newest_m1(bars)
    m1 = bars.where("timeframe = 'M1'").join(at, "symbol")
    age = F.unix_seconds("at") - F.unix_seconds("open_time")
    span = lambda s: F.round(F.max(F.when(age.between(0, s), F.col("high_price")))
                             - F.min(F.when(age.between(0, s), F.col("low_price"))), 2)
    newest = lambda c: F.max_by(c, "open_time")
    ranges = m1.where(age <= 4 * 3600).groupBy("symbol", "at").agg(
        span(3600).alias("price_range_1h"), span(4 * 3600).alias("price_range_4h"),
        newest("high_price").alias("high_price"), newest("low_price").alias("low_price"))
    doc = _live_context(bars, PATTERN_LIMITS, candle()).join(ranges, "symbol").withColumn("indicators", _newest_values())
    nothing = F.lit(None).cast("double")
    return doc.select(
        "symbol", "at", utc_text("at").alias("snapshot_time"), "context", "indicators",
        # no bar follows the newest one, so the one-hour outcome of a live document is open
        F.struct(nothing.alias("max_gain_pct_1h"), nothing.alias("max_loss_pct_1h")).alias("outcome_1h"),
        classify.session_pattern("at").alias("session"),
        classify.volatility_pattern(_atrs(), "price_range_1h", "price_range_4h").alias("volatility"),
        F.struct("price_range_1h", "price_range_4h", nothing.alias("volatility_percentile")).alias("volatility_metrics"),
        classify.spread_from_range().alias("spread"), F.lit(False).alias("news_event"))


def fresh_document(bars, generated_at=None):
    """Minimal document of the newest M1 bar."""
    row = latest_per_key(bars.where("timeframe = 'M1'"), ["symbol"], "open_time", columns=["open_time", "high_price", "low_price"])
    return row.select("symbol", utc_text("open_time").alias("snapshot_time"), classify.session_pattern().alias("session"),
                      classify.spread_from_range().alias("spread"), F.lit("fresh_data").alias("volatility"),
                      F.lit(False).alias("news_event"), F.lit("force_generated").alias("data_freshness"),
                      *([] if generated_at is None else [utc_text(generated_at).alias("generation_time")]))


# --- full price history -------------------------------------------------------------

def history_ohlc(points, bars, visible="open"):
    ctx = _history_context(points, bars, FULL_LIMITS, candle(INDICATOR_COLUMNS, zero_nulls=True), visible)
    return ctx.select("symbol", "at", F.col("context").alias("ohlc"), last_times().alias("ohlc_last_time"))


def live_ohlc(bars, limits=FULL_LIMITS):
    ctx = _live_context(bars, limits, candle(INDICATOR_COLUMNS, zero_nulls=True)).join(newest_m1(bars), "symbol")
    return ctx.select("symbol", "at", F.col("context").alias("ohlc"), last_times().alias("ohlc_last_time"))


# --- market state ---------------------------------------------------------------------

def market_state_history(m1, m5):
    """Price, spread, 24h volume, 4h deviation of M5 closes and session of every M1 bar.

    M1 and M5 rows share one blocked frame, so both statistics need a single shuffle.
    """
    close = F.when(F.col("close_price") != 0, F.col("close_price"))
    rows = m1.select("symbol", "open_time", F.lit(True).alias("_point"), "volume", F.lit(None).cast("double").alias("_x"),
                     "high_price", "low_price", F.col("close_price").alias("current_price")).unionByName(
        m5.select("symbol", "open_time", F.lit(False).alias("_point"), close.alias("_x")), allowMissingColumns=True)
    w = block_window(["symbol"], "_t")
    upto = lambda end: F.coalesce(F.sum("volume").over(w.rangeBetween(Window.unboundedPreceding, end)), F.lit(0))
    w4 = w.rangeBetween(-(4 * 3600 - 1), 0)
    out = ranged(rows, {
        "volume_24h": F.nullif(upto(0) - upto(-86400), F.lit(0)).cast("double"),
        "volatility": F.when(F.count("_x").over(w4) > 1, F.round(F.stddev_pop("_x").over(w4), 5))},
        back=86400, keys=["symbol"], width=4 * 86400)
    priced = (F.col("high_price") != 0) & (F.col("low_price") != 0)
    return out.where("_point").select("symbol", F.col("open_time").alias("at"), "current_price",
                                      F.when(priced, classify.spread_range()).alias("spread"), "volume_24h", "volatility",
                                      classify.session_market_history("open_time").alias("market_session"))


def market_state_live(bars):
    row = latest_per_key(bars.where("timeframe = 'M1'"), ["symbol"], "open_time",
                         columns=["open_time", "high_price", "low_price", "atr"])
    return row.select("symbol", F.col("open_time").alias("at"), classify.volatility_live("atr").alias("volatility"),
                      classify.spread_from_range().alias("spread"), classify.session_market_live().alias("session"),
                      F.lit(False).alias("news_event"))


# --- combined ------------------------------------------------------------------------------

def combined_snapshot(bars, account_state, open_trades, planned):
    """Prices, account, market state, trades, broker constants and limits per symbol.

    Trades of the newest account are attached by account id."""
    account = trades.live_account_document(account_state)
    lists = trades.live_trade_documents(open_trades, planned)
    ohlc = live_ohlc(bars, COMPACT_LIMITS).withColumn("account_id", trades.newest_account(account_state))
    state = market_state_live(bars).select("symbol", F.struct("volatility", "spread", "session", "news_event").alias("market_state"))
    return (ohlc.join(account, "account_id").join(state, "symbol").join(lists, "account_id", "left")
            .select("symbol", "account_id", utc_text("at").alias("timestamp"), "ohlc", "ohlc_last_time", "account",
                    "market_state", "trades",
                    F.struct(*[F.lit(x).alias(k) for k, x in BROKER.items()]).alias("broker"),
                    F.struct(F.lit(DAILY_LOSS_LIMIT_PCT).alias("daily_loss_limit_pct")).alias("limits")))


# --- checks of documents ------------------------------------------------------------------

def validate_pattern(docs):
    """One row per document and check: (symbol, at, check, passed, detail)."""
    missing = [k for k in REQUIRED_KEYS if k not in docs.columns]
    bad = non_snake_case_fields(docs.select([c for c in docs.columns if c not in ("context", "indicators")]).schema)
    atr = F.nullif(_atr("H1"), F.lit(0.0))
    atr_ok = F.when(atr > 5.0, F.col("volatility") == "high_price").otherwise(
        F.col("volatility").isin("medium_price", "low_price"))
    outcome_ok = F.col("outcome_1h.max_gain_pct_1h").isNotNull() & F.col("outcome_1h.max_loss_pct_1h").isNotNull()
    want = classify.session_pattern("at")
    candles = total_candles()
    text = lambda c: c.cast("string")
    checks = [("volatility_rule", F.coalesce(atr_ok & atr.isNotNull(), F.lit(False)), F.col("volatility")),
              ("session_rule", F.col("session") == want, want),
              ("required_keys", F.lit(not missing), F.lit(",".join(missing))),
              ("snake_case", F.lit(not bad), F.lit(",".join(bad))),
              ("outcome_present", outcome_ok, F.lit("")),
              ("candle_count", candles <= MAX_CANDLES, text(candles))]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), ok.alias("passed"), text(d).alias("detail")) for n, ok, d in checks])
    return docs.select("symbol", "at", F.explode(rows).alias("_c")).select("symbol", "at", "_c.*")


# --- whole runs ------------------------------------------------------------------------------

PARTS = ["ohlc", "account", "open_trades", "closed_trades", "market", "outcome", "pattern"]
#: Parts that are lists of trades; a snapshot without trades has an empty one.
LISTS = {"open_trades": trades.open_lists, "closed_trades": trades.closed_lists}
COLUMNS = ["ohlc_all_json", "account_state_json", "open_trades_json", "closed_trades_json", "market_state_json",
           "max_gain_pct_1h", "max_loss_pct_1h", "calculation_range_minutes", "prediction_mode", "pattern_json"]


def in_last_days(points, days, now):
    """Points of the last ``days`` days before ``now`` (7: last week, 30: last month)."""
    return points.where(F.col("at") >= now - F.expr(f"INTERVAL {days * 86400} SECONDS"))


def history_snapshots(points, bars, account_state, open_trades, closed_trades, parts=PARTS, min_bars=60):
    """Snapshot rows of all points with the chosen JSON columns, joined on (symbol, at).

    One row per point; a snapshot without trades has empty lists.
    """
    unknown = [p for p in parts if p not in PARTS]
    if unknown:
        raise ValueError(f"unknown parts {unknown}")
    key = ["symbol", "at"]
    m1, m5 = bars.where("timeframe = 'M1'"), bars.where("timeframe = 'M5'")
    plain = lambda df: F.struct(*[c for c in df.columns if c not in key])
    made = []
    for part in [p for p in PARTS if p in parts and p not in LISTS]:
        if part == "ohlc":
            df = history_ohlc(points, bars)
            made.append(df.select(*key, plain(df).alias("ohlc_all_json")))
        elif part == "account":
            df = trades.history_account_documents(points, account_state)
            made.append(df.select(*key, F.col("account").alias("account_state_json")))
        elif part == "market":
            df = market_state_history(m1, m5)
            state = F.struct(utc_text("at").alias("timestamp"), "symbol", *[c for c in df.columns if c not in key])
            made.append(df.select(*key, state.alias("market_state_json")))
        elif part == "outcome":
            df = outcome.snapshot_outcomes(m1, min_bars).withColumnRenamed("snapshot_time", "at")
            made.append(df.select(*key, "max_gain_pct_1h", "max_loss_pct_1h", "calculation_range_minutes", "prediction_mode"))
        else:
            df = history_pattern(points, bars)
            made.append(df.select(*key, plain(df).alias("pattern_json")))
    rows = reduce(lambda a, b: a.join(b, key, "left"), made, points)
    # the lists come after all joins on the points, and the other texts after the lists: nothing shuffles the texts of lists
    lists = {f"{part}_json": LISTS[part](open_trades if part == "open_trades" else closed_trades) for part in LISTS if part in parts}
    texts = {c: json_text(c) for c in rows.columns if c not in points.columns and c.endswith("_json")}
    if lists:
        rows = collect_valid_lists(rows, lists, ["symbol"], "at", text=True, times=points)
        # the items are texts already
        texts |= {c: F.concat(F.lit("["), F.concat_ws(",", c), F.lit("]")) for c in lists}
    rows = rows.withColumns(texts)
    return rows.select(*points.columns, *[c for c in COLUMNS if c in rows.columns]).withColumnRenamed("at", "snapshot_time")


def live_snapshots(bars, account_state, open_trades, closed_trades, planned, snapshots=None):
    """One row per symbol with all live documents (the full exporter cycle)."""
    plain = lambda df: F.struct(*[c for c in df.columns if c not in ("symbol", "at")])
    ohlc, pattern, market = live_ohlc(bars), live_pattern(bars), market_state_live(bars)
    combined = trades.live_account_document(account_state)
    lists = trades.live_trade_documents(open_trades, planned)
    m1 = bars.where("timeframe = 'M1'")
    if snapshots is None:
        since = newest_m1(bars).select("symbol", F.timestamp_seconds(F.unix_seconds("at") - 3600).alias("since"))
    else:
        since = trades.last_snapshot_or_hour_ago(m1, snapshots, F.col("closed_trades_json").isNotNull())
    closed = trades.live_closed_documents(closed_trades, since)
    out = (ohlc.select("symbol", "at", json_text(plain(ohlc)).alias("ohlc_all_json"))
           .join(pattern.select("symbol", json_text(plain(pattern)).alias("pattern_json")), "symbol", "left")
           .join(market.select("symbol", json_text(plain(market)).alias("market_state_json")), "symbol", "left")
           .join(closed.select("symbol", json_text("trades").alias("closed_trades_json")), "symbol", "left")
           .withColumn("account_id", trades.newest_account(account_state))
           .join(combined.select("account_id", json_text("account").alias("account_state_json")), "account_id", "left")
           .join(lists.select("account_id", json_text("trades").alias("open_trades_json")), "account_id", "left"))
    done = sum((F.col(c).isNotNull().cast("int") for c in out.columns if c.endswith("_json")), F.lit(0))
    return out.withColumn("exported", done).drop("account_id").withColumnRenamed("at", "snapshot_time")
