"""Checks of the quality and coverage reports."""
from pyspark.sql import functions as F

from tickloom.catalog.base import query, r, rs
from tickloom.catalog.oracle_views import SERIES as OVER
from tickloom.catalog.oracle_views import half_up, session
from tickloom.constants import INDICATOR_COLUMNS
from tickloom.functions import classify
from tickloom.plans import quality as q

IND = INDICATOR_COLUMNS
NOW = "(SELECT max(open_time) FROM bars)"
PCT = "round({a} * 100e0 / {b}, 2)"


def stored(v, gap="error"):
    """Stored bars: indicator columns are still empty in rows last fed by one kind of event."""
    gap = F.col("data_source") == gap
    return v.indicators.withColumns({c: F.when(~gap, F.col(c)) for c in IND})


STORED = ("(SELECT symbol, timeframe, open_time, open_price, high_price, low_price, close_price, volume, data_source, spread, "
          + ", ".join(f"CASE WHEN data_source <> 'error' THEN {c} END AS {c}" for c in IND) + " FROM ind) AS st")
ANYNULL = "(" + " OR ".join(f"{c} IS NULL" for c in IND) + ")"


@query("a11_inventory", f"""SELECT symbol, timeframe, count(*) AS total_rows, min(open_time) AS earliest, max(open_time) AS latest,
count(rsi) AS with_indicator, {PCT.format(a='count(rsi)', b='count(*)')} AS coverage_pct FROM {STORED} GROUP BY 1, 2""")
def a11(v):
    return q.inventory(stored(v))


@query("a12_timeframe_totals", """SELECT timeframe, count(*) AS total_rows, count(DISTINCT symbol) AS symbols,
min(open_time) AS earliest, max(open_time) AS latest FROM bars GROUP BY 1""")
def a12(v):
    return q.timeframe_totals(v.bars)


DAYS = "(epoch_us(max(open_time)) - epoch_us(min(open_time))) // 86400000000"


@query("a13_density", f"""SELECT symbol, timeframe, count(*) AS total_rows, {DAYS} AS day_span,
round(count(*) / CAST({DAYS} + 1 AS DOUBLE), 2) AS rows_per_day FROM bars GROUP BY 1, 2 HAVING count(*) > 100""")
def a13(v):
    return q.density(v.bars)


@query("a14_totals_rollup", """SELECT coalesce(symbol, 'ALL') AS symbol, coalesce(timeframe, 'ALL') AS timeframe,
count(*) AS total_rows, min(open_time) AS earliest, max(open_time) AS latest FROM bars GROUP BY ROLLUP (symbol, timeframe)""")
def a14(v):
    return q.totals_rollup(v.bars)


@query("a15_duplicate_keys", """SELECT symbol, count(*) AS total_rows, count(DISTINCT (minute, source)) AS distinct_keys,
count(*) - count(DISTINCT (minute, source)) AS duplicates FROM (SELECT symbol, source, date_trunc('minute', ts) AS minute FROM ticks)
GROUP BY 1 HAVING count(*) - count(DISTINCT (minute, source)) > 0""")
def a15(v):
    return q.duplicate_keys(v.ticks.withColumn("minute", F.date_trunc("minute", "ts")), ["symbol"], ["minute", "source"])


def period_sql(src):
    return (f"SELECT symbol, min(open_time) AS earliest, max(open_time) AS latest, count(*) AS total_rows, {DAYS} AS days "
            f"FROM {src} GROUP BY 1")


@query("a16_collection_period", period_sql("bars"))
def a16(v):
    return q.collection_period(v.bars)


@query("a16_collection_period_m1", period_sql("m1"))
def a16_m1(v):
    return q.collection_period(v.m1)


@query("a17_series_counts", "SELECT symbol, timeframe, count(*) AS total_rows FROM bars GROUP BY 1, 2")
def a17(v):
    return q.series_counts(v.bars)


@query("a18_column_coverage", " UNION ALL ".join(
    f"SELECT '{c}' AS indicator, count(*) AS total, count({c}) AS calculated, count(*) - count({c}) AS missing, "
    f"{PCT.format(a=f'count({c})', b='count(*)')} AS coverage_pct FROM {STORED}" for c in IND))
def a18(v):
    return q.column_coverage(stored(v))


@query("a19_series_coverage", "SELECT symbol, timeframe, count(*) AS total_rows, " + ", ".join(
    f"count({c}) AS {c}_count, {PCT.format(a=f'count({c})', b='count(*)')} AS {c}_pct" for c in ("rsi", "macd", "adx", "bb_middle"))
    + f" FROM {STORED} GROUP BY 1, 2")
def a19(v):
    return q.series_coverage(stored(v))


@query("a20_value_ranges", " UNION ALL ".join(
    f"SELECT '{c}' AS indicator, count({c}) AS n, round(min({c}), 4) + 0e0 AS low, round(max({c}), 4) + 0e0 AS high, "
    f"round(avg({c}), 4) + 0e0 AS mean FROM {STORED}" for c in IND))
def a20(v):
    return q.value_ranges(stored(v))


@query("a21_latest_with_indicators", "SELECT symbol, timeframe, max(open_time) AS latest, " + ", ".join(
    f"max(CASE WHEN {c} IS NOT NULL THEN open_time END) AS latest_{c}" for c in ("rsi", "macd", "adx")) + f" FROM {STORED} GROUP BY 1, 2")
def a21(v):
    return q.latest_with(stored(v))


FILLED = "max(CASE WHEN rsi IS NOT NULL THEN open_time END)"


@query("a22_indicator_lag", f"""SELECT symbol, timeframe, max(open_time) AS latest, {FILLED} AS latest_filled,
(epoch(max(open_time)) - epoch({FILLED})) / 60e0 AS minutes_behind FROM {STORED.replace("'error'", "'view'")} GROUP BY 1, 2 HAVING max(open_time) > {FILLED}""")
def a22(v):
    return q.indicator_lag(stored(v, gap="view"))


def missing_sql(by, where="", having=0):
    return (f"SELECT {by}, count(*) AS missing FROM {STORED} WHERE rsi IS NULL {where} GROUP BY ALL HAVING count(*) > {having}")


@query("a23_missing_all", missing_sql("symbol, timeframe"))
def a23(v):
    return q.missing(stored(v))


@query("a23_missing_last_day", missing_sql("symbol, timeframe", f"AND open_time >= {NOW} - INTERVAL 24 HOUR"))
def a23_day(v):
    return q.missing(stored(v), when=q.since("open_time", v.now(v.bars), 86400))


@query("a23_missing_per_day", missing_sql("CAST(open_time AS DATE) AS day", f"AND open_time >= {NOW} - INTERVAL 7 DAY"))
def a23_week(v):
    s = stored(v).withColumn("day", F.to_date("open_time"))
    return q.missing(s, by=["day"], when=q.since("open_time", v.now(v.bars), 7 * 86400))


@query("a23_missing_over_threshold", missing_sql("symbol, timeframe", having=300))
def a23_many(v):
    return q.missing(stored(v), more_than=300)


@query("a24_missing_three_days_top", missing_sql("symbol, timeframe", f"AND open_time >= {NOW} - INTERVAL 3 DAY")
       + " ORDER BY missing DESC, symbol, timeframe LIMIT 10")
def a24(v):
    rows = q.missing(stored(v), when=q.since("open_time", v.now(v.bars), 3 * 86400))
    return rows.orderBy(F.desc("missing"), "symbol", "timeframe").limit(10)


@query("a25_coverage_with_latest", f"""SELECT symbol, timeframe, count(*) AS total_rows, count(rsi) AS with_indicator,
{PCT.format(a='count(rsi)', b='count(*)')} AS coverage_pct, max(open_time) AS latest, {FILLED} AS latest_filled
FROM {STORED} GROUP BY 1, 2 HAVING count(rsi) > 0 ORDER BY count(rsi) DESC, symbol, timeframe LIMIT 15""")
def a25(v):
    return q.coverage_with_latest(stored(v))


@query("a45_earliest_null", f"SELECT symbol, timeframe, min(CASE WHEN {ANYNULL} THEN open_time END) AS earliest_null FROM {STORED} GROUP BY 1, 2")
def a45(v):
    return q.earliest_null(stored(v))


@query("a46_null_ranking", f"""SELECT symbol, timeframe, count(*) FILTER ({ANYNULL} AND open_time >= {NOW} - INTERVAL 10 DAY) AS recent_nulls,
count(*) FILTER ({ANYNULL}) AS all_nulls FROM {STORED} GROUP BY 1, 2""")
def a46(v):
    return q.null_ranking(stored(v), v.now(v.bars), days=10)


@query("p25_flat_bars", """SELECT symbol, timeframe, count(*) AS flat_rows FROM bars WHERE open_price = high_price AND high_price = low_price
AND low_price = close_price GROUP BY 1, 2 HAVING count(*) > 10""")
def p25(v):
    return q.flat_bars(v.bars)


@query("p26_out_of_range", f"""SELECT symbol, timeframe, count(*) FILTER (rsi < 0 OR rsi > 100) AS rsi_out_of_range,
count(*) FILTER (atr <= 0) AS atr_not_positive, count(rsi) AS rsi_rows FROM {STORED} GROUP BY 1, 2""")
def p26(v):
    return q.out_of_range(stored(v))


@query("p03_any_null_rows", f"SELECT symbol, timeframe, open_time FROM {STORED} WHERE {ANYNULL}")
def p03(v):
    return stored(v).where(classify.any_null(IND)).select("symbol", "timeframe", "open_time")


@query("p24_coverage_status", f"""SELECT symbol, timeframe, coverage_pct, CASE WHEN coverage_pct >= 95 THEN 'complete'
WHEN coverage_pct >= 70 THEN 'partial' ELSE 'poor' END AS status FROM (SELECT symbol, timeframe,
{PCT.format(a='count(rsi)', b='count(*)')} AS coverage_pct FROM {STORED} GROUP BY 1, 2)""")
def p24(v):
    return q.coverage_status(q.inventory(stored(v))).select("symbol", "timeframe", "coverage_pct", "status")


# --- snapshot outcomes -----------------------------------------------------------

def outcome_sql(by, where=""):
    return (f"SELECT {by}, count(*) AS total, count(max_gain_pct_1h) AS with_gain, count(max_loss_pct_1h) AS with_loss, "
            f"{PCT.format(a='count(max_gain_pct_1h)', b='count(*)')} AS coverage_pct FROM snapshots {where} GROUP BY ALL")


SNOW = "(SELECT max(snapshot_time) FROM snapshots)"


@query("a26_outcome_coverage", outcome_sql("symbol"))
def a26(v):
    return q.outcome_coverage(v.snapshots)


@query("a26_outcome_coverage_by_day", outcome_sql("CAST(snapshot_time AS DATE) AS day, symbol"))
def a26_day(v):
    return q.outcome_coverage(v.snapshots.withColumn("day", F.to_date("snapshot_time")), ["day", "symbol"])


@query("a26_outcome_coverage_last_day", outcome_sql("symbol", f"WHERE snapshot_time >= {SNOW} - INTERVAL 24 HOUR"))
def a26_24(v):
    return q.outcome_coverage(v.snapshots, when=q.since("snapshot_time", v.now(v.m1), 86400))


@query("a26_outcome_coverage_since_date", outcome_sql("symbol", "WHERE snapshot_time >= TIMESTAMP '2024-01-08'"))
def a26_since(v):
    return q.outcome_coverage(v.snapshots, when=F.col("snapshot_time") >= F.lit("2024-01-08").cast("timestamp"))


@query("a26_outcome_coverage_range", outcome_sql(
    "symbol", "WHERE snapshot_time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15'"))
def a26_range(v):
    t = lambda x: F.lit(x).cast("timestamp")
    return q.outcome_coverage(v.snapshots, when=F.col("snapshot_time").between(t("2024-01-08"), t("2024-01-15")))


@query("a27_outcome_nulls", """SELECT coalesce(symbol, 'ALL') AS symbol, count(*) AS total,
count(*) FILTER (max_gain_pct_1h IS NULL) AS gain_null, count(*) FILTER (max_loss_pct_1h IS NULL) AS loss_null,
count(*) FILTER (max_gain_pct_1h IS NULL AND max_loss_pct_1h IS NULL) AS both_null FROM snapshots GROUP BY ROLLUP (symbol)""")
def a27(v):
    g, l = F.col("max_gain_pct_1h").isNull(), F.col("max_loss_pct_1h").isNull()
    return v.snapshots.rollup("symbol").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(g).alias("gain_null"), F.count_if(l).alias("loss_null"),
        F.count_if(g & l).alias("both_null")).withColumn("symbol", F.coalesce("symbol", F.lit("ALL")))


SUMMARY = ("count(*) AS total, count(max_gain_pct_1h) AS calculated, round(avg(max_gain_pct_1h), 4) + 0e0 AS avg_gain, "
           "round(avg(max_loss_pct_1h), 4) + 0e0 AS avg_loss, max(max_gain_pct_1h) AS max_gain, min(max_loss_pct_1h) AS min_loss")


@query("a28_outcome_summary", f"SELECT symbol, {SUMMARY} FROM snapshots GROUP BY 1")
def a28(v):
    return q.outcome_summary(v.snapshots)


@query("a29_latest_statistics", """SELECT count(*) AS n, round(avg(max_gain_pct_1h), 4) + 0e0 AS avg_gain,
round(avg(max_loss_pct_1h), 4) + 0e0 AS avg_loss, max(max_gain_pct_1h) AS max_gain, min(max_loss_pct_1h) AS min_loss,
round(avg(max_gain_pct_1h - max_loss_pct_1h), 4) + 0e0 AS avg_range FROM (SELECT * FROM snapshots
WHERE max_gain_pct_1h IS NOT NULL ORDER BY snapshot_time DESC, symbol LIMIT 50)""")
def a29(v):
    return q.latest_statistics(v.snapshots)


# --- spreads and activity --------------------------------------------------------

@query("a31_hourly_histogram", f"""SELECT CAST(hour(open_time) AS INTEGER) AS hour, count(*) AS total_rows FROM bars
WHERE open_time >= {NOW} - INTERVAL 24 HOUR GROUP BY 1""")
def a31(v):
    return q.hourly_histogram(v.bars, v.now(v.bars))


@query("a32_daily_spread_quality", """SELECT CAST(open_time AS DATE) AS day, count(*) AS total_rows,
round(avg(spread), 6) + 0e0 AS avg_spread, min(spread) AS min_spread, max(spread) AS max_spread,
CAST(sum(volume) AS BIGINT) AS volume FROM bars WHERE spread > 0 GROUP BY 1""")
def a32(v):
    return q.daily_spread(v.bars)


@query("a33_symbols_with_spread", f"""SELECT count(DISTINCT symbol) AS symbols, count(*) AS total_rows FROM bars WHERE spread > 0
AND open_time >= {NOW} - INTERVAL 1 HOUR""")
def a33(v):
    return q.symbols_with_spread(v.bars, v.now(v.bars))


SPREAD_A = half_up("greatest(0.01e0, (high_price - low_price) * 0.1e0)", 2)


@query("a38_hourly_spread_trend", f"""SELECT date_trunc('hour', open_time) AS hour, count(*) AS total_rows,
{half_up(f"(CAST(sum(CAST({SPREAD_A} AS DECIMAL(18, 2))) AS DOUBLE) / count(*))", 6)} AS avg_spread, min({SPREAD_A}) AS min_spread, max({SPREAD_A}) AS max_spread FROM bars GROUP BY 1""")
def a38(v):
    return q.hourly_spread(v.bars, classify.spread_from_range())


@query("a39_spread_validation", f"""SELECT symbol, count(*) AS total, count(s) AS with_spread, count(*) FILTER (s > 0) AS positive,
count(*) FILTER (s < 0) AS negative, count(*) FILTER (s = 0.01e0) AS at_minimum,
count(*) FILTER (regexp_matches(format('{{:.2f}}', s), '^[0-9]+\\.[0-9]{{2}}$')) AS two_decimals, max(s) AS max_spread
FROM (SELECT symbol, {SPREAD_A} AS s FROM bars) GROUP BY 1""")
def a39(v):
    return q.spread_validation(v.bars, classify.spread_from_range())


@query("a43_conditional_average", """SELECT symbol, count(*) AS total, count(*) FILTER (spread > 0) AS with_spread,
round(avg(CASE WHEN spread > 0 THEN spread END), 6) + 0e0 AS avg_positive_spread FROM bars GROUP BY 1""")
def a43(v):
    return q.conditional_average(v.bars)


@query("a43_session_counts", f"SELECT {session(ny='New_York')} AS session, count(*) AS total_rows FROM bars GROUP BY 1")
def a43_session(v):
    return v.bars.groupBy(classify.session_bridge().alias("session")).agg(F.count(F.lit(1)).alias("total_rows"))


@query("a44_symbol_timeframe_span", f"""SELECT count(DISTINCT symbol) AS symbols, count(DISTINCT timeframe) AS timeframes,
min(open_time) AS oldest, max(open_time) AS newest FROM bars WHERE open_time >= {NOW} - INTERVAL 24 HOUR""")
def a44(v):
    return q.symbol_timeframe_span(v.bars, v.now(v.bars))


@query("a50_recent_snapshots", f"""SELECT count(*) AS total, min(snapshot_time) AS earliest, max(snapshot_time) AS latest FROM snapshots
WHERE snapshot_time >= {SNOW} - INTERVAL 10 MINUTE""")
def a50(v):
    return q.recent_activity(v.snapshots, "snapshot_time", v.now(v.m1), 600)


@query("a51_timeframe_activity", f"""SELECT timeframe, count(*) AS total_rows, max(open_time) AS latest,
round(avg(close_price), 4) + 0e0 AS avg_close FROM bars WHERE open_time >= {NOW} - INTERVAL 24 HOUR GROUP BY 1""")
def a51(v):
    return q.timeframe_activity(v.bars, v.now(v.bars))


@query("a51_series_activity", f"""SELECT symbol, timeframe, count(*) AS total_rows, max(open_time) AS latest,
round(avg(spread), 6) + 0e0 AS avg_spread FROM bars WHERE open_time >= {NOW} - INTERVAL 24 HOUR GROUP BY 1, 2""")
def a51_series(v):
    return q.series_activity(v.bars, v.now(v.bars))


@query("p32_session_check", f"""SELECT {session()} AS expected, {session(ny='New_York')} AS actual, count(*) AS total_rows,
count(*) FILTER ({session()} <> {session(ny='New_York')}) AS mismatches FROM bars GROUP BY 1, 2""")
def p32(v):
    return q.session_mismatch(v.bars, classify.session_bridge())


RETURNS = f"(SELECT symbol, timeframe, open_time, (close_price - lag(close_price) OVER ({OVER})) / nullif(lag(close_price) OVER ({OVER}), 0e0) AS ret FROM bars)"


@query("a53_return_correlation", f"""SELECT x.symbol AS a, y.symbol AS b, x.timeframe, CASE WHEN count(*) > 1 THEN round(corr(x.ret, y.ret), 6) + 0e0 END AS correlation, count(*) AS n
FROM {RETURNS} x JOIN {RETURNS} y ON x.open_time = y.open_time AND x.timeframe = y.timeframe AND x.symbol < y.symbol
WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 2""")
def a53(v):
    some = v.bars.agg(F.array_sort(F.collect_set("symbol")).alias("s"))  # one row, as long as there are symbols
    pairs = some.select(F.explode("s").alias("a"), "s").select("a", F.explode("s").alias("b")).where("a < b")
    out = q.return_correlations(v.bars, pairs).where("n > 2")
    return out.select("a", "b", "timeframe", r("correlation"), "n")
