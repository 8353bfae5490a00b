"""Freshness, connection and spread monitoring; "now" is always passed in."""
from pyspark.sql import functions as F

from tickloom.functions.classify import age_minutes
from tickloom.operators.asof import latest_per_key
from tickloom.operators.sequence import rolling, rows_back
from tickloom.plans.quality import since

# --- fixed values -----------------------------------------------------------
STALE_MINUTES = 5
CONNECTION_MINUTES = 2
SPREAD_FACTOR = 3.0
COOLDOWN_SECONDS = 300
SPREAD_BLOCK = 2 * 86400  # span of a counting block: at most some 4,000 bars of all timeframes
FRESH_RATIO = (0.5, 0.8)
ACTIVE_RATIO = 0.8
# ----------------------------------------------------------------------------


def freshness(symbols, bars, now, stale=STALE_MINUTES, timeout=CONNECTION_MINUTES):
    """Newest row per symbol with ages and flags; a symbol without rows is infinitely old."""
    rows = bars if "mt5_collection_time" in bars.columns else bars.withColumn(
        "mt5_collection_time", F.lit(None).cast("timestamp"))
    newest = latest_per_key(rows, ["symbol"], "open_time", tie="timeframe" if "timeframe" in rows.columns else None,
                            columns=["open_time", "mt5_collection_time", "spread", "volume", "data_source"])
    far = F.lit(float("inf"))
    out = symbols.join(newest, "symbol", "left")
    out = out.withColumns({
        "minutes_since_data": F.coalesce(age_minutes("open_time", now), far),
        "minutes_since_collection": F.coalesce(age_minutes(F.coalesce("mt5_collection_time", "open_time"), now), far)})
    return out.select("symbol", F.col("open_time").alias("latest_data_time"), "minutes_since_data",
                      "minutes_since_collection", F.coalesce("spread", F.lit(0.0)).alias("spread"),
                      F.coalesce("volume", F.lit(0)).alias("volume"),
                      F.coalesce("data_source", F.lit("unknown")).alias("data_source"),
                      (F.col("minutes_since_data") <= stale).alias("is_fresh"),
                      (F.col("minutes_since_collection") <= timeout).alias("is_connected"))


def connection_health(bars, now, n_symbols, source_pattern=None, seconds=3600):
    """Row and symbol counts of the last hour; healthy with rows from 80 % of the symbols."""
    recent = since("open_time", now, seconds)
    source = recent if source_pattern is None else recent & F.col("data_source").like(source_pattern)
    active = F.countDistinct(F.when(recent, F.col("symbol")))
    total = F.count_if(recent)
    return bars.where(recent).agg(
        total.alias("total_records"), active.alias("active_symbols"), F.min("open_time").alias("oldest"),
        F.max("open_time").alias("newest"), F.count_if(source).alias("source_records"),
        ((total > 0) & (active >= n_symbols * ACTIVE_RATIO)).alias("is_healthy"))


def trailing_spread(bars, n=10):
    """Mean spread of the ``n`` rows of the symbol before each row with a positive spread.

    Rows of all timeframes follow each other by time, those of one time by timeframe.
    """
    w = rows_back(1, ["symbol"]).rowsBetween(-n, -1)
    return rolling(bars.where("spread > 0"), {"avg_spread": F.avg("spread").over(w)}, n, keys=["symbol"],
                   tie=["timeframe"], seconds=SPREAD_BLOCK)


def spread_anomalies(bars, now, seconds=3600, factor=SPREAD_FACTOR):
    """Newest spread per symbol against the mean of the ten rows before it, last hour only."""
    recent = trailing_spread(bars.where(since("open_time", now, seconds)))
    newest = latest_per_key(recent, ["symbol"], "open_time", tie="timeframe", columns=["open_time", "spread", "avg_spread"])
    # a mean of null or 0 falls back to the newest spread itself
    mean = F.coalesce(F.when(F.col("avg_spread") != 0, F.col("avg_spread")), F.col("spread"))
    return newest.select("symbol", F.col("spread").alias("latest_spread"), mean.alias("average_spread"),
                         (F.col("spread") > mean * factor).alias("is_anomaly"),
                         F.try_divide(F.col("spread"), mean).alias("anomaly_factor"))


def overall_health(fresh):
    """One row: share of fresh and connected symbols and the resulting state."""
    row = fresh.agg(F.count_if("is_fresh").alias("symbols_fresh"), F.count_if("is_connected").alias("symbols_connected"),
                    F.count(F.lit(1)).alias("total_symbols"))
    share = F.try_divide(F.col("symbols_fresh"), F.col("total_symbols"))
    return row.withColumn("overall_health", F.when(share < FRESH_RATIO[0], "critical")
                          .when(share < FRESH_RATIO[1], "degraded").otherwise("healthy"))


def alerts(fresh, anomalies, connection, at):
    """Alert rows: stale data per symbol (critical from ten minutes on), one for a failed connection check
    (the row of ``connection_health``; no row is a failure too), odd spread per symbol."""
    stale = fresh.where("not is_fresh").select(
        F.lit("stale_data").alias("alert_type"), "symbol",
        F.when(F.col("minutes_since_data") < 10, "warning").otherwise("critical").alias("severity"))
    lost = connection.agg(F.coalesce(F.bool_and("is_healthy"), F.lit(False)).alias("ok")).where("not ok").select(
        F.lit("connection_issue").alias("alert_type"), F.lit("ALL").alias("symbol"), F.lit("critical").alias("severity"))
    odd = anomalies.where("is_anomaly").select(F.lit("spread_anomaly").alias("alert_type"), "symbol",
                                               F.lit("warning").alias("severity"))
    return stale.unionByName(lost).unionByName(odd).withColumn("timestamp", at)


def report_row(fresh, anomalies, connection, at):
    """Monitoring log row of one cycle."""
    n_anomalies = anomalies.where("is_anomaly").agg(F.count(F.lit(1))).scalar()
    n_alerts = alerts(fresh, anomalies, connection, F.lit(None).cast("timestamp")).agg(F.count(F.lit(1))).scalar()
    row = overall_health(fresh).withColumns({"timestamp": at, "symbols_with_anomalies": n_anomalies, "alerts_count": n_alerts})
    data = F.struct("symbols_fresh", "symbols_connected", "symbols_with_anomalies", "total_symbols")
    return row.withColumn("status_data", F.to_json(data, {"ignoreNullFields": "false"}))
