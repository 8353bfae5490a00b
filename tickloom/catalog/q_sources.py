"""Checks of scans, ingestion, merges, sinks and row limits."""
import lzma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.q_quality import ANYNULL, IND, NOW, STORED, stored
from tickloom.constants import COMPACT_LIMITS, FULL_LIMITS, PATTERN_LIMITS
from tickloom.catalog.q_joins import limits_sql
from tickloom.operators.asof import last_per_timeframe, top_n
from tickloom.operators.incomplete import incomplete_indicators
from tickloom.operators.sequence import literal_map
from tickloom.plans import documents
from tickloom.session import materialize, shared_dir
from tickloom.sources import archive, readers, sinks

KEYS = ["symbol", "timeframe", "open_time"]
KEYSQL = "symbol, timeframe, open_time"
OHLC = ["open_price", "high_price", "low_price", "close_price"]
OHLCSQL = ", ".join(OHLC)


@query("s01_series_list", "SELECT DISTINCT symbol, timeframe FROM bars")
def s01(v):
    return readers.series_list(v.bars)


@query("s02_range_scan", f"""SELECT {KEYSQL}, close_price FROM bars WHERE timeframe = 'M15'
AND open_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""")
def s02(v):
    t = lambda x: F.lit(x).cast("timestamp")
    return readers.range_scan(v.bars_of("M15"), None, "M15", t("2024-01-05 00:00:00"), t("2024-01-20 12:00:00")).select(*KEYS, "close_price")


@query("s03_tail_scan", f"SELECT {KEYSQL}, close_price FROM bars QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY open_time DESC) <= 310")
def s03(v):
    return readers.tail_scan(v.bars, 310).select(*KEYS, "close_price")


@query("s04_minute_times", "SELECT DISTINCT symbol, open_time FROM m1 WHERE open_time >= TIMESTAMP '2024-01-10'")
def s04(v):
    return readers.minute_times(v.m1, start=F.lit("2024-01-10").cast("timestamp"))


@query("s05_symbols", "SELECT DISTINCT symbol FROM bars")
def s05(v):
    return readers.symbols(v.bars)


@query("s06_bar_csv_ingest", f"SELECT symbol, timeframe, open_time, {OHLCSQL}, CAST(0 AS BIGINT) AS volume FROM bars WHERE timeframe IN ('H1', 'H4')")
def s06(v):
    """Write bar files with millisecond times, then ingest them (fixed symbol form per
    timeframe, symbols from the file content are checked in the tests by file name)."""
    out = None
    base = shared_dir(v.spark, "csv")
    rows = v.bars_of("H1", "H4").select("symbol", "timeframe", (F.unix_seconds("open_time") * 1000 + 7).alias("timestamp"),
                                       F.col("open_price").alias("open"), F.col("high_price").alias("high"),
                                       F.col("low_price").alias("low"), F.col("close_price").alias("close"))
    rows.write.partitionBy("symbol", "timeframe").option("header", True).csv(base)
    for s in ("S0", "S1", "S2", "S3", "S4"):
        for t in ("H1", "H4"):
            one = readers.read_bar_files(v.spark, f"{base}/symbol={s}/timeframe={t}", symbol=s, timeframe=t)
            out = one if out is None else out.unionByName(one)
    return out


@query("s07_bar_csv_fixed_symbol", f"SELECT 'XAUUSD' AS symbol, 'D1' AS timeframe, open_time, {OHLCSQL}, CAST(0 AS BIGINT) AS volume FROM bars WHERE timeframe = 'D1'")
def s07(v):
    base = shared_dir(v.spark, "csv")
    v.bars_of("D1").select((F.unix_seconds("open_time") * 1000).alias("open_time"), F.col("open_price").alias("open"),
                           F.col("high_price").alias("high"), F.col("low_price").alias("low"),
                           F.col("close_price").alias("close")).write.option("header", True).csv(base)
    return readers.read_bar_files(v.spark, base, "open_time", "XAUUSD", "D1")


@query("s09_bulk_load", f"SELECT {KEYSQL}, {OHLCSQL}, volume FROM bars")
def s09(v):
    base = shared_dir(v.spark, "bars")
    sinks.write_bars(v.bars.select(*KEYS, *OHLC, "volume"), base)
    return v.spark.read.parquet(base).select(*KEYS, *OHLC, "volume")


# --- tick archive ----------------------------------------------------------------

def _pack(table):
    rec = np.zeros(len(table), dtype=archive.RECORD)
    order = pc.sort_indices(table, sort_keys=[("ts", "ascending"), ("tick_id", "ascending")]).to_numpy()
    for name in ("ms", "ask", "bid"):
        rec[name] = table[name].to_numpy()[order]
    rec["ask_volume"], rec["bid_volume"] = 1.5, 0.25
    half = len(rec) // 2
    content = lzma.compress(rec[:half].tobytes(), lzma.FORMAT_ALONE) + lzma.compress(rec[half:].tobytes(), lzma.FORMAT_XZ)
    return pa.table([table["symbol"][:1], table["day"][:1], pa.array([content], pa.binary())], names=["symbol", "day", "content"])


def archive_files(v):
    """Archive files of the ticks (one per symbol, day), packed in tasks."""
    us = F.unix_micros("ts")
    points = lambda x: F.round(F.col("price") * 100000 + x).cast("long")
    rows = v.ticks.select("symbol", F.to_date("ts").alias("day"), "ts", "tick_id", F.floor(F.pmod(us, F.lit(3600000000)) / 1000).alias("ms"),
                          points(0).alias("ask"), points(5).alias("bid"))
    return rows.groupBy("symbol", "day").applyInArrow(_pack, "symbol string, day date, content binary")


@query("s10_tick_archive", """SELECT symbol, epoch_ms(CAST(epoch_ms(day) + 3600000 * (wraps + start) + ms AS BIGINT)) AS time, price AS ask,
round(price + 5e-5, 6) AS bid, CAST(1500000 AS BIGINT) AS ask_volume, CAST(250000 AS BIGINT) AS bid_volume
FROM (SELECT *, sum(CASE WHEN prev > minute THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, day ORDER BY ts ROWS UNBOUNDED PRECEDING) AS wraps,
CASE WHEN isodow(day) = 7 OR (day(day) = 1 AND month(day) = 1) THEN 22 ELSE 0 END AS start
FROM (SELECT *, lag(minute) OVER (PARTITION BY symbol, day ORDER BY ts) AS prev FROM (SELECT symbol, ts, price, date_trunc('day', ts)::TIMESTAMP AS day,
minute(ts) AS minute, (epoch_us(ts) % 3600000000) // 1000 AS ms FROM ticks)))""")
def s10(v):
    return archive.decode(archive_files(v)).select("symbol", "time", "ask", F.round("bid", 6).alias("bid"), "ask_volume", "bid_volume")


@query("s11_hour_reconstruction", """SELECT symbol, day, CAST(max(wraps) AS BIGINT) AS wraps, count(*) AS ticks FROM (
SELECT symbol, day, sum(CASE WHEN prev > minute THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, day ORDER BY ts ROWS UNBOUNDED PRECEDING) AS wraps
FROM (SELECT symbol, ts, CAST(ts AS DATE) AS day, minute(ts) AS minute, lag(minute(ts)) OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts) AS prev FROM ticks))
GROUP BY 1, 2""")
def s11(v):
    special = (F.dayofweek("day") == 1) | (F.dayofyear("day") == 1)
    hours = F.floor((F.unix_seconds("time") - F.unix_seconds(F.col("day").cast("timestamp"))) / 3600)
    return archive.decode(archive_files(v)).groupBy("symbol", "day").agg(
        F.max(hours - F.when(special, 22).otherwise(0)).alias("wraps"), F.count(F.lit(1)).alias("ticks"))


@query("s12_us_dst", """SELECT day, day >= second_march AND day < first_november AS dst FROM (SELECT day,
CAST(make_date(year(day), 3, 1) + CAST((7 - isodow(make_date(year(day), 3, 1))) % 7 + 7 AS INTEGER) AS DATE) AS second_march,
CAST(make_date(year(day), 11, 1) + CAST((7 - isodow(make_date(year(day), 11, 1))) % 7 AS INTEGER) AS DATE) AS first_november
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders))""")
def s12(v):
    days = v.table("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select("day", archive.is_us_dst("day").alias("dst"))


@query("s13_trading_days", """SELECT day FROM (SELECT CAST(unnest(range(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day,
max(ts)::DATE AS today FROM ticks) WHERE isodow(day) <> 6 AND day <> today""")
def s13(v):
    """Trading days of the data; its last day stands for today."""
    first, last = v.ticks.agg(F.min("ts")).scalar().cast("date"), v.ticks.agg(F.max("ts")).scalar().cast("date")
    days = v.spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"), last.alias("today"))
    return days.where((F.dayofweek("day") != 7) & (F.col("day") != F.col("today"))).select("day")


@query("s14_candle_csv", f"""SELECT strftime(open_time, '%Y-%m-%d %H:%M:%S') AS time, format('{{:.5f}}', open_price) AS open,
format('{{:.5f}}', close_price) AS close, format('{{:.5f}}', high_price) AS high, format('{{:.5f}}', low_price) AS low
FROM bars WHERE timeframe = 'H4'""")
def s14(v):
    path = shared_dir(v.spark, "candles")
    sinks.write_candle_csv(v.bars_of("H4"), path, header=True)
    return v.spark.read.option("header", True).schema("time string, open string, close string, high string, low string").csv(path)


RANGE = """concat(symbol, '-', strftime(make_timestamp(epoch_us({t}) // {us} * {us}), '%Y_%m_%d'), '-',
strftime(make_timestamp(epoch_us({t}) // {us} * {us} + {us} - 86400000000), '%Y_%m_%d'), '.csv')"""


def read_files(v, path, schema):
    """The lines of all files with their file's name and their place in it."""
    rows = v.spark.read.option("header", True).schema(schema).csv(path)
    return rows.select(F.col("_metadata.file_name").alias("file_name"), "*")


@query("s14_candle_files", f"""SELECT {RANGE.format(t='open_time', us=7 * 86400000000)} AS file_name, strftime(open_time, '%Y-%m-%d %H:%M:%S') AS time, format('{{:.5f}}', open_price) AS open,
format('{{:.5f}}', close_price) AS close, format('{{:.5f}}', high_price) AS high, format('{{:.5f}}', low_price) AS low FROM bars WHERE timeframe = 'M15'""")
def s14_candles(v):
    """Candle files of a week per symbol, read back."""
    path = shared_dir(v.spark, "candles")
    sinks.write_candle_files(v.bars_of("M15"), path, days=7, header=True)
    return read_files(v, path, "time string, open string, close string, high string, low string")


@query("s14_tick_files", f"""SELECT {RANGE.format(t='ts', us=86400000000)} AS file_name, strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') AS time,
format('{{:.5f}}', price) AS ask, format('{{:.5f}}', price - 0.5e0) AS bid, tick_id % 7 AS ask_volume, tick_id % 5 AS bid_volume FROM ticks""")
def s14_ticks(v):
    """Tick files of a day per symbol, read back."""
    path = shared_dir(v.spark, "ticks")
    ticks = v.ticks.select("symbol", F.col("ts").alias("time"), F.col("price").alias("ask"), (F.col("price") - 0.5).alias("bid"),
                           (F.col("tick_id") % 7).alias("ask_volume"), (F.col("tick_id") % 5).alias("bid_volume"), "tick_id")
    sinks.write_tick_files(ticks, path, header=True, tie=["tick_id"])
    return read_files(v, path, "time string, ask string, bid string, ask_volume long, bid_volume long")


@query("s08_bar_file_folder", f"""SELECT symbol, timeframe, open_time, {OHLCSQL}, CAST(0 AS BIGINT) AS volume, CAST(NULL AS VARCHAR) AS reason FROM bars WHERE timeframe IN ('H1', 'H4', 'D1')
UNION ALL SELECT symbol, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'columns' FROM (SELECT DISTINCT symbol FROM bars)
UNION ALL SELECT 'notes', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'name' UNION ALL SELECT 'import', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'name'""")
def s08(v):
    """A folder of bar files of all symbols and three timeframes, beside it files without the close column, a file with a
    bad name and one that an earlier import wrote: good files are read, the others listed with the reason."""
    folder = shared_dir(v.spark, "folder")
    bars = v.bars_of("H1", "H4", "D1")
    lines = bars.select(F.concat(F.lower("symbol"), F.lit("-"), F.lower("timeframe")).alias("symbol"), F.col("open_time"),
                        (F.unix_seconds("open_time") * 1000).alias("timestamp"), F.col("open_price").alias("open"),
                        F.col("high_price").alias("high"), F.col("low_price").alias("low"), F.col("close_price").alias("close"))
    values = ["timestamp", "open", "high", "low", "close"]
    whole = 36500
    sinks._named_files(lines.withColumn("symbol", F.concat("symbol", F.lit("-bid"))), "open_time", values, folder, whole, True)
    short = lines.where("symbol like '%-d1'").withColumn("symbol", F.regexp_replace("symbol", "d1$", "m30-bid"))
    sinks._named_files(short, "open_time", values[:4], folder, whole, True)
    one = lines.where("symbol = 's0-d1'")
    for name in ("notes", "s0-d1-bid-1-2-import"):
        made = shared_dir(v.spark, "one")
        sinks._named_files(one.withColumn("symbol", F.lit("x")), "open_time", values, made, whole, True)
        rename(v.spark, made, f"{folder}/{name}.csv")
    good, bad = readers.read_bar_folder(v.spark, folder)
    name = F.when(F.col("reason") == "columns", F.upper(F.split("file_name", "-")[0])).when(
        F.col("file_name").endswith("-import.csv"), "import").otherwise(F.split("file_name", "\\.")[0])
    return good.select(*KEYS, *OHLC, "volume").withColumn("reason", F.lit(None).cast("string")).unionByName(
        bad.select(name.alias("symbol"), "reason"), allowMissingColumns=True)


def rename(spark, folder, target):
    """Give the only file of a folder its name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.rename(fs.globStatus(path(f"{folder}/*.csv"))[0].getPath(), path(target))


# --- merges ------------------------------------------------------------------------

def snapshot_halves(v):
    """Stored snapshots (London hours) and incoming ones (all with a close above 50)."""
    s = v.snapshots.select("symbol", "snapshot_time", F.col("close_price").alias("price"), F.hour("snapshot_time").alias("h"))
    old = s.where("h between 7 and 14").select("symbol", "snapshot_time", F.concat(F.lit("old"), "h").alias("snapshot_json"),
                                              F.lit("keep").alias("note"))
    new = s.where("price > 50").select("symbol", "snapshot_time", F.concat(F.lit("new"), "h").alias("snapshot_json"),
                                       F.lit(1).alias("attempt"))
    return old, new


HALVES = """(SELECT symbol, snapshot_time, concat('old', hour(snapshot_time)) AS j, 'keep' AS note FROM snapshots WHERE hour(snapshot_time) BETWEEN 7 AND 14) o
FULL JOIN (SELECT symbol, snapshot_time, concat('new', hour(snapshot_time)) AS j, 1 AS attempt FROM snapshots WHERE close_price > 50) n
ON o.symbol = n.symbol AND o.snapshot_time = n.snapshot_time"""
HALF_KEY = "coalesce(o.symbol, n.symbol) AS symbol, coalesce(o.snapshot_time, n.snapshot_time) AS snapshot_time"


@query("s15_snapshot_upsert", f"SELECT {HALF_KEY}, coalesce(n.j, o.j) AS snapshot_json, o.note, CASE WHEN o.symbol IS NOT NULL THEN n.attempt END AS attempt FROM {HALVES}")
def s15(v):
    old, new = snapshot_halves(v)
    return sinks.upsert(old, new, columns=["snapshot_json"], extras=["attempt"], extras_on_insert=False)


@query("s16_pattern_upsert", f"SELECT {HALF_KEY}, coalesce(n.j, o.j) AS snapshot_json, coalesce(n.j, o.j) AS pattern_json, o.note FROM {HALVES}")
def s16(v):
    old, new = snapshot_halves(v)
    old = old.withColumn("pattern_json", F.col("snapshot_json"))
    return sinks.upsert(old, new.select("symbol", "snapshot_time", "snapshot_json", F.col("snapshot_json").alias("pattern_json")))


@query("s17_insert_if_absent", f"SELECT {HALF_KEY}, coalesce(o.j, n.j) AS snapshot_json FROM {HALVES}")
def s17(v):
    old, new = snapshot_halves(v)
    return sinks.insert_absent(old.drop("note"), new.drop("attempt"))


@query("s18_update_incomplete", f"SELECT {KEYSQL}, {rs(*IND)} FROM ind")
def s18(v):
    """Filling the incomplete stored rows from the computed ones gives the full table."""
    out = sinks.fill_incomplete(materialize(stored(v), "bars"))
    return out.select(*KEYS, *[r(c) for c in IND])


@query("s19_update_overwrite", f"SELECT {KEYSQL}, CASE WHEN spread > 0 THEN 1e0 ELSE round(rsi, 6) END + 0e0 AS rsi FROM {STORED}")
def s19(v):
    new = v.bars.where("spread > 0").select(*KEYS, F.lit(1.0).alias("rsi"))
    return sinks.update(stored(v), new, columns=["rsi"]).select(*KEYS, r("rsi"))


@query("s20_update_set", f"SELECT i.symbol, i.timeframe, i.open_time, round(i.rsi, 6) + 0e0 AS rsi, round(i.adx, 6) + 0e0 AS adx FROM ind i JOIN {STORED} ON "
       f"st.symbol = i.symbol AND st.timeframe = i.timeframe AND st.open_time = i.open_time WHERE {ANYNULL.replace('(', '(st.', 1).replace(' OR ', ' OR st.')}")
def s20(v):
    base = materialize(stored(v), "bars")
    return sinks.update_set(base, incomplete_indicators(base)).select(*KEYS, r("rsi"), r("adx"))


@query("j09_update_from_temp_set", f"SELECT {KEYSQL}, {rs('atr', 'obv')} FROM ind")
def j09(v):
    base = materialize(stored(v), "bars")
    return sinks.update(base, sinks.update_set(base, incomplete_indicators(base))).select(*KEYS, r("atr"), r("obv"))


@query("j10_left_join_computed", f"""SELECT s.symbol, s.timeframe, s.open_time, round(i.ema, 6) + 0e0 AS ema FROM (SELECT * FROM bars WHERE spread > 0) s
LEFT JOIN (SELECT * FROM ind WHERE rsi > 50) i ON s.symbol = i.symbol AND s.timeframe = i.timeframe AND s.open_time = i.open_time""")
def j10(v):
    computed = v.indicators.where("rsi > 50").select(*KEYS, "ema")
    return v.bars.where("spread > 0").select(*KEYS).join(computed, KEYS, "left").select(*KEYS, r("ema"))


@query("s21_outcome_update", """SELECT symbol, snapshot_time, max_gain_pct_1h, max_loss_pct_1h, calculation_range_minutes, prediction_mode FROM snapshots""")
def s21(v):
    cols = ["max_gain_pct_1h", "max_loss_pct_1h", "calculation_range_minutes", "prediction_mode"]
    empty = v.m1.select("symbol", F.col("open_time").alias("snapshot_time"))
    empty = sinks.add_columns(empty, {"max_gain_pct_1h": "double", "max_loss_pct_1h": "double", "calculation_range_minutes": "long", "prediction_mode": "boolean"})
    return sinks.update(empty, v.snapshots.select("symbol", "snapshot_time", *cols), sinks.SNAPSHOT_KEY, cols)


@query("s22_bar_merge", f"""SELECT symbol, timeframe, open_time, open_price, greatest(high_price, close_price + 1) AS high_price,
least(low_price, close_price - 1) AS low_price, close_price + 0.5e0 AS close_price, volume + 1 AS volume, spread FROM bars WHERE timeframe = 'H1'""")
def s22(v):
    old = v.bars_of("H1").withColumn("ingest_time", F.lit(1))
    c = F.col("close_price")
    new = old.select(*KEYS, "open_price", (c + 1).alias("high_price"), (c - 1).alias("low_price"), (c + 0.5).alias("close_price"),
                     (F.col("volume") + 1).alias("volume"), "spread", F.lit(2).alias("ingest_time"))
    return sinks.merge_bars(old, new).drop("ingest_time")


LAST = "row_number() OVER (PARTITION BY symbol, timeframe ORDER BY open_time DESC) = 1"


@query("s23_latest_bar_patch", f"SELECT {KEYSQL}, CASE WHEN {LAST} THEN 0.77e0 ELSE spread END AS spread FROM bars")
def s23(v):
    patch = readers.series_list(v.bars).withColumn("spread", F.lit(0.77))
    return sinks.patch_latest(v.bars, patch).select(*KEYS, "spread")


@query("s24_work_queue", "SELECT symbol, snapshot_time FROM snapshots WHERE max_gain_pct_1h IS NULL AND snapshot_time >= TIMESTAMP '2024-01-05'")
def s24(v):
    return readers.pending(v.snapshots, "max_gain_pct_1h", start=F.lit("2024-01-05").cast("timestamp")).select("symbol", "snapshot_time")


@query("s25_skip_existing", "SELECT symbol, snapshot_time FROM snapshots WHERE close_price > 50 AND NOT hour(snapshot_time) BETWEEN 7 AND 14")
def s25(v):
    old, new = snapshot_halves(v)
    return sinks.skip_existing(new, old).select("symbol", "snapshot_time")


@query("s26_json_file", "SELECT account_id, symbol, timestamp, balance, profit, CASE WHEN profit > 0 THEN profit END AS gain FROM account_state")
def s26(v):
    path = shared_dir(v.spark, "json")
    rows = v.account_state.select("account_id", "symbol", "timestamp", "balance", "profit", F.when(F.col("profit") > 0, F.col("profit")).alias("gain"))
    sinks.write_json(rows, path)
    return v.spark.read.schema(rows.schema).option("timestampFormat", sinks.TIME_FORMAT).json(path)


@query("s27_attach_document", f"SELECT {KEYSQL}, CASE WHEN {LAST} THEN concat('doc-', symbol) END AS snapshot FROM bars")
def s27(v):
    docs = readers.symbols(v.bars).withColumn("snapshot", F.concat(F.lit("doc-"), "symbol"))
    return sinks.attach_to_latest(v.bars, docs).select(*KEYS, "snapshot")


@query("s30_selective_delete", f"SELECT {KEYSQL} FROM bars WHERE NOT (symbol = 'S1' AND timeframe = 'M1') AND open_time >= {NOW} - INTERVAL 7 DAY")
def s30(v):
    now = v.now(v.bars)
    old = F.col("open_time") < now - F.expr("INTERVAL 7 DAYS")
    kept = sinks.delete_where(v.bars, (F.col("symbol") == "S1") & (F.col("timeframe") == "M1"))
    return sinks.delete_where(kept, old).select(*KEYS)


@query("s31_schema_evolution", "SELECT account_id, timestamp, balance, margin_level, CAST(NULL AS DOUBLE) AS risk_score, CAST(NULL AS INTEGER) AS open_orders FROM account_state")
def s31(v):
    """Two columns are new, one is there already and keeps its values."""
    return sinks.add_columns(v.account_state, {"margin_level": "double", "risk_score": "double", "open_orders": "int"}).select(
        "account_id", "timestamp", "balance", "margin_level", "risk_score", "open_orders")


@query("s32_column_inspection", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS filled, count(*) - count({c}) AS empty FROM account_state" for c in ("margin", "free_margin", "margin_level")))
def s32(v):
    """The columns of a pattern with their filled and empty rows."""
    return readers.column_fill(v.account_state, "%margin%")


@query("s33_incremental_scan", f"""SELECT symbol, timeframe, open_time FROM bars WHERE open_time > {NOW} - INTERVAL 48 HOUR
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC, timeframe) <= 10""")
def s33(v):
    """Newest 10 bars per symbol since the last processed time (here: two days before the newest)."""
    from pyspark.sql import Window
    fresh = v.bars.where(F.col("open_time") > v.now(v.bars) - F.expr("INTERVAL 48 HOURS"))
    w = Window.partitionBy("symbol").orderBy(F.desc("open_time"), "timeframe")
    return fresh.withColumn("_k", F.row_number().over(w)).where("_k <= 10").select(*KEYS)


@query("s33_new_account_states", """SELECT account_id, timestamp, equity FROM account_state WHERE timestamp > (SELECT max(timestamp) FROM account_state) - INTERVAL 48 HOUR
ORDER BY timestamp DESC LIMIT 5""")
def s33_account(v):
    """The newest five account states since the last processed time."""
    since = v.now(v.account_state, "timestamp") - F.expr("INTERVAL 48 HOURS")
    return readers.newest_since(v.account_state, "timestamp", since, 5, tie="account_id").select("account_id", "timestamp", "equity")


@query("s33_new_trades", """SELECT 'open' AS kind, trade_id, open_time AS at FROM (SELECT * FROM open_trades WHERE open_time > (SELECT max(open_time) FROM open_trades) - INTERVAL 48 HOUR
ORDER BY open_time DESC LIMIT 10) UNION ALL SELECT 'closed', id, time FROM (SELECT * FROM closed_trades WHERE time > (SELECT max(open_time) FROM open_trades) - INTERVAL 48 HOUR
ORDER BY time DESC LIMIT 10)""")
def s33_trades(v):
    """The newest ten opened and the newest ten closed trades since the last processed time."""
    since = v.now(v.open_trades, "open_time") - F.expr("INTERVAL 48 HOURS")
    opened = readers.newest_since(v.open_trades, "open_time", since, 10, tie="trade_id")
    closed = readers.newest_since(v.closed_trades, "time", since, 10, tie="id")
    return opened.select(F.lit("open").alias("kind"), "trade_id", F.col("open_time").alias("at")).unionByName(
        closed.select(F.lit("closed").alias("kind"), F.col("id").alias("trade_id"), F.col("time").alias("at")))


# --- limits --------------------------------------------------------------------------

@query("k01_last_n_per_series", f"SELECT {KEYSQL}, close_price FROM bars QUALIFY row_number() OVER (PARTITION BY symbol, timeframe ORDER BY open_time DESC) <= 60")
def k01(v):
    return top_n(v.bars, 60).select(*KEYS, "close_price")


def limit_query(name, limits):
    @query(name, f"""SELECT symbol, timeframe, open_time, close_price FROM (SELECT b.*, l.lim, row_number() OVER (PARTITION BY b.symbol, b.timeframe ORDER BY b.open_time DESC) AS rk
FROM bars b JOIN {limits_sql(limits).replace('lims(', 'l(')} ON l.timeframe = b.timeframe) WHERE rk <= lim""")
    def _(v):
        return last_per_timeframe(v.bars, limits).select(*KEYS, "close_price")


limit_query("k02_pattern_limits", PATTERN_LIMITS)
limit_query("k03_full_limits", FULL_LIMITS)
limit_query("k04_compact_limits", COMPACT_LIMITS)


@query("k05_timeframe_order", """SELECT timeframe, row_number() OVER (ORDER BY min(secs)) AS position, count(*) AS total_rows FROM bars GROUP BY 1""")
def k05(v):
    """Timeframes in their own order (position by the fixed list)."""
    from tickloom.plans.quality import timeframe_totals, tf_order
    return timeframe_totals(v.bars).select("timeframe", (tf_order() + 1).cast("long").alias("position"), "total_rows")


@query("k07_outcome_rows", """SELECT symbol, snapshot_time, max_gain_pct_1h, 'latest' AS part FROM (SELECT * FROM snapshots WHERE max_gain_pct_1h IS NOT NULL
ORDER BY snapshot_time DESC, symbol LIMIT 10) UNION ALL SELECT symbol, snapshot_time, max_gain_pct_1h, 'oldest null' AS part FROM
(SELECT * FROM snapshots WHERE max_gain_pct_1h IS NULL ORDER BY snapshot_time, symbol LIMIT 10)""")
def k07(v):
    cols = ["symbol", "snapshot_time", "max_gain_pct_1h"]
    latest = v.snapshots.where("max_gain_pct_1h is not null").orderBy(F.desc("snapshot_time"), "symbol").limit(10)
    oldest = v.snapshots.where("max_gain_pct_1h is null").orderBy("snapshot_time", "symbol").limit(10)
    return latest.select(*cols, F.lit("latest").alias("part")).unionByName(oldest.select(*cols, F.lit("oldest null").alias("part")))
