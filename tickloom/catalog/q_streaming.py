"""Checks of the streaming jobs: each runs over the available data and returns its sink."""
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import half_up, session
from tickloom.catalog.q_classify import DEFAULTS
from tickloom.session import materialize, shared_dir
from tickloom.sources import changelog, sinks
from tickloom.streaming import bars as sbars
from tickloom.streaming import cycles, indicators, source
from tickloom.streaming.tail import BarTail

KEYS = ["symbol", "timeframe", "open_time"]
OHLC = ["open_price", "high_price", "low_price", "close_price"]
# append mode emits a bar once the watermark (newest tick minus one minute) has passed its end
CLOSED = "epoch_us(open_time) + secs * 1000000 <= (SELECT max(epoch_us(ts)) // 1000 * 1000 - 60000000 FROM events)"


def closed_table(v, seconds, timeframe):
    """Run the tick-to-bar job into a table and return its path."""
    path = shared_dir(v.spark, "bars")
    source.finish(source.to_table(sbars.closed_bars(source.event_ticks(v.spark, v.path), seconds, timeframe), path))
    return path


def bar_stream(v, path):
    return source.source(v.spark, "parquet", v.spark.read.parquet(path).schema, path=path)


def run_to_frame(v, stream):
    path = shared_dir(v.spark, "out")
    source.finish(source.to_table(stream, path))
    return v.spark.read.schema(stream.schema).parquet(path)


def stored_stream(v, frame):
    """A frame written as a table and read back as a stream."""
    path = shared_dir(v.spark, "feed")
    frame.write.parquet(path)
    return source.source(v.spark, "parquet", frame.schema, path=path)


@query("t04_stream_bars", f"SELECT symbol, timeframe, open_time, {', '.join(OHLC)}, volume FROM bars WHERE timeframe = 'H1' AND {CLOSED}")
def t04(v):
    return v.spark.read.parquet(closed_table(v, 3600, "H1")).select(*KEYS, *OHLC, "volume")


@query("t01_stream_enrichment", f"""SELECT symbol, timeframe, open_time, {session(ny='New_York')} AS trading_session, coalesce(CASE WHEN open_price <> 0 AND high_price <> 0 AND low_price <> 0 THEN
round((high_price - low_price) / open_price * 100, 4) END, 0e0) + 0e0 AS volatility_score FROM bars WHERE timeframe = 'H1' AND {CLOSED}""")
def t01(v):
    stream = bar_stream(v, closed_table(v, 3600, "H1")).withColumn("spread", F.lit(0.0))
    return run_to_frame(v, sbars.enriched(stream)).select(*KEYS, "trading_session", "volatility_score")


IND = ["atr", "adx", "ema", "macd", "macd_signal", "macd_hist", "rsi", "obv", "sma", "bb_middle", "bb_upper", "bb_lower", "cci",
       "stochastic_k", "stochastic_d", "willr"]


@query("t02_live_indicators", f"SELECT symbol, timeframe, open_time, n, {rs(*IND)} FROM ind WHERE timeframe = 'M15' AND n >= 150 AND {CLOSED}")
def t02(v):
    stream = indicators.live_indicators(bar_stream(v, closed_table(v, 900, "M15")))
    return run_to_frame(v, stream).select(*KEYS, "n", *[r(c) for c in IND])


def seeded_tail(v):
    """(tail of all bars up to a day before the newest, stream of the later ones)."""
    stored = materialize(v.bars, "stored")
    cut = v.now(stored) - F.expr("INTERVAL 1 DAY")
    tail = BarTail(shared_dir(v.spark, "tail"))
    tail.seed(stored.where(F.col("open_time") <= cut))
    return tail, stored_stream(v, stored.where(F.col("open_time") > cut))


@query("t03_live_exporters", """SELECT symbol, max(open_time) AS snapshot_time, 5 + CAST(max(x) AS INTEGER) AS exported FROM (SELECT m.symbol, m.open_time,
CAST(EXISTS (SELECT 1 FROM closed_trades c WHERE c.symbol = m.symbol AND c.time > (SELECT max(y.open_time) FROM m1 y WHERE y.symbol = m.symbol) - INTERVAL 1 HOUR) AS INTEGER) AS x FROM m1 m) GROUP BY 1""")
def t03(v):
    """The tail is seeded with all bars but those of the last day, which come as a stream."""
    path = shared_dir(v.spark, "snapshots")
    load = lambda: {"account_state": v.account_state, "open_trades": v.open_trades, "closed_trades": v.closed_trades,
                    "planned": v.planned_trades}
    tail, feed = seeded_tail(v)
    source.finish(source.per_batch(feed, cycles.exporters(tail, load, path)))
    return v.spark.read.parquet(path).select("symbol", "snapshot_time", "exported")


@query("t05_late_bar_merge", """SELECT symbol, timeframe, open_time, open_price, greatest(high_price, close_price + 2) AS high_price, least(low_price, close_price - 2) AS low_price,
close_price + 1e0 AS close_price, volume + 3 AS volume FROM bars WHERE timeframe = 'H4'""")
def t05(v):
    """The table holds all H4 bars; a stream of corrected bars is merged into it."""
    path = shared_dir(v.spark, "merged")
    old = v.bars_of("H4").select(*KEYS, *OHLC, "volume", "spread", F.lit(1).alias("ingest_time"))
    changelog.create(old, path)
    c = F.col("close_price")
    new = old.select(*KEYS, "open_price", (c + 2).alias("high_price"), (c - 2).alias("low_price"), (c + 1).alias("close_price"),
                     (F.col("volume") + 3).alias("volume"), "spread", F.lit(2).alias("ingest_time"))
    source.finish(source.per_batch(stored_stream(v, new), changelog.merge_into(path)))
    return changelog.read(v.spark, path).select(*KEYS, *OHLC, "volume")


@query("t05_repeated_bars", "SELECT symbol, timeframe, open_time, close_price FROM bars WHERE timeframe = 'H4'")
def t05_repeat(v):
    rows = v.bars_of("H4").select(*KEYS, "close_price")
    return run_to_frame(v, sbars.without_repeats(stored_stream(v, rows.unionByName(rows))))


@query("t06_delayed_outcome", """SELECT symbol, open_time AS snapshot_time, round((fwd_high - close_price) / close_price * 100e0, 4) AS max_gain_pct_1h,
round((fwd_low - close_price) / close_price * 100e0, 4) AS max_loss_pct_1h, fwd_bars AS later_bars FROM fwd f WHERE fwd_bars >= 1
AND open_time + INTERVAL 1 HOUR <= (SELECT max(open_time) FROM m1 m WHERE m.symbol = f.symbol AND epoch_us(open_time) + 60000000 <=
(SELECT max(epoch_us(ts)) // 1000 * 1000 - 60000000 FROM events))""")
def t06(v):
    """Outcomes appear one hour after their snapshot, from the closed-bar table."""
    return run_to_frame(v, cycles.delayed_outcomes(bar_stream(v, closed_table(v, 60, "M1"))))


@query("t07_freshness_scores", """SELECT symbol, max(open_time) AS latest, round((epoch_us((SELECT max(open_time) FROM m1)) - epoch_us(max(open_time))) / 60e6, 4) AS minutes_old,
(epoch_us((SELECT max(open_time) FROM m1)) - epoch_us(max(open_time))) / 60e6 <= 2 AS is_fresh,
round(greatest(0e0, 100 - (epoch_us((SELECT max(open_time) FROM m1)) - epoch_us(max(open_time))) / 6e6), 4) AS freshness_score FROM m1 GROUP BY 1""")
def t07(v):
    path = shared_dir(v.spark, "fresh")
    handle = lambda batch, i: cycles.freshness_scores(batch, batch.agg(F.max("open_time")).scalar()).write.mode("append").parquet(path)
    source.finish(source.per_batch(stored_stream(v, v.m1), handle))
    return v.spark.read.parquet(path).select("symbol", "latest", r("minutes_old", 4), "is_fresh", r("freshness_score", 4))


def raw_alerts(v):
    """Every M1 bar with a price above 100 raises an alert of its symbol."""
    return v.m1.where("high_price > 100").select(F.lit("spread_anomaly").alias("alert_type"), "symbol", F.lit("warning").alias("severity"),
                                                 F.col("open_time").alias("timestamp"))


@query("t09_alert_cooldown", """WITH RECURSIVE raw AS (SELECT symbol, open_time AS t, row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS n FROM {m1} WHERE high_price > 100),
sent(symbol, t) AS (SELECT symbol, min(t) FROM raw GROUP BY 1 UNION ALL
SELECT s.symbol, (SELECT min(w.t) FROM raw w WHERE w.symbol = s.symbol AND w.t >= s.t + INTERVAL 300 SECOND) FROM sent s WHERE s.t IS NOT NULL)
SELECT 'spread_anomaly' AS alert_type, symbol, 'warning' AS severity, t AS timestamp FROM sent WHERE t IS NOT NULL""".format(
    m1="(SELECT concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, make_timestamp((epoch_us(ts) // 60000000) * 60000000) AS open_time, "
       "max(value) AS high_price FROM events GROUP BY 1, 2)"))
def t09(v):
    return run_to_frame(v, cycles.sent_alerts(stored_stream(v, raw_alerts(v))))


@query("t10_health_cycle", """SELECT 'critical' AS overall_health, CAST(0 AS BIGINT) AS unused, count(DISTINCT symbol) AS total_symbols, max(open_time) AS timestamp FROM bars WHERE timeframe = 'H1'
HAVING count(DISTINCT symbol) > 0""".replace("'critical' AS overall_health, CAST(0 AS BIGINT) AS unused, ", ""))
def t10(v):
    path = shared_dir(v.spark, "health")
    rows = v.bars_of("H1").withColumn("data_source", F.lit("feed"))
    source.finish(source.per_batch(stored_stream(v, rows), cycles.health_cycle(path)))
    return v.spark.read.parquet(path).select("total_symbols", "timestamp")


@query("t11_sliding_ranges", """SELECT symbol, w AS window_start, w + INTERVAL 4 HOUR AS window_end, round(max(high_price) - min(low_price), 2) AS price_range, count(*) AS bars FROM (
SELECT *, unnest(range(make_timestamp((epoch_us(open_time) // 900000000) * 900000000 - 13500000000), make_timestamp((epoch_us(open_time) // 900000000) * 900000000 + 1), INTERVAL 15 MINUTE)) AS w FROM m1)
WHERE epoch_us(w) + 14400000000 <= (SELECT max(epoch_us(open_time)) - 60000000 FROM m1) GROUP BY 1, 2""")
def t11(v):
    return run_to_frame(v, sbars.sliding_ranges(stored_stream(v, v.m1), 4, "15 minutes"))


@query("t12_message_source", "SELECT symbol, count(*) AS bars, round(sum(close_price), 4) AS close_sum FROM bars WHERE timeframe = 'H1' GROUP BY 1")
def t12(v):
    """Values as a bus topic holds them (here lines of files) go through the parser of the bus source."""
    path = shared_dir(v.spark, "messages")
    v.bars_of("H1").select(F.to_json(F.struct("symbol", "close_price")).alias("value")).write.text(path)
    rows = run_to_frame(v, source.parse_messages(source.source(v.spark, "text", "value string", path=path), "symbol string, close_price double"))
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), F.round(F.sum("close_price"), 4).alias("close_sum"))


@query("t13_new_closed_trades", "SELECT id, symbol, time, profit FROM closed_trades")
def t13(v):
    path = shared_dir(v.spark, "closed")
    source.finish(source.per_batch(stored_stream(v, v.closed_trades.select("id", "symbol", "time", "profit")), cycles.new_closed_trades(path)))
    return v.spark.read.parquet(path).select("id", "symbol", "time", "profit")


@query("v03_live_vectors", """SELECT symbol, max(open_time) AS snapshot_time, CAST(152 AS INTEGER) AS length FROM m1 GROUP BY 1""")
def v03(v):
    """The vector of each symbol's newest bar, upserted per batch."""
    path = shared_dir(v.spark, "vectors")
    tail, feed = seeded_tail(v)
    source.finish(source.per_batch(feed, cycles.live_vectors(tail, path)))
    rows = v.spark.read.parquet(path)
    return rows.select("symbol", "snapshot_time", F.size("vector").alias("length"))
