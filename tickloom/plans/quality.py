"""Data-quality and coverage reports.

Every report is one aggregation with map-side combine. "Now" is a parameter
(a column, usually the newest time of the data as a scalar subquery).
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import INDICATOR_COLUMNS, TF_SECONDS
from tickloom.functions.classify import any_null, is_flat, session_pattern, status_tier
from tickloom.functions.scalar import pearson
from tickloom.operators.sequence import SERIES, literal_map


def n_rows():
    return F.count(F.lit(1))


def percent(part, whole, digits=2):
    return F.round(F.try_divide(part * 100.0, whole), digits)


def since(time, now, seconds):
    """time >= now - seconds, with the column bare, so that scans can skip by it."""
    return F.col(time) >= now - F.expr(f"INTERVAL {seconds} SECONDS")


def tf_order(timeframe="timeframe"):
    return literal_map({t: i for i, t in enumerate(TF_SECONDS)})[F.col(timeframe)]


def whole_days(first, last):
    """Whole days between two times, truncated."""
    return F.floor((F.unix_micros(last) - F.unix_micros(first)) / 86400000000)


def inventory(bars, column="rsi"):
    return (bars.groupBy(*SERIES).agg(
        n_rows().alias("total_rows"), F.min("open_time").alias("earliest"), F.max("open_time").alias("latest"),
        F.count(column).alias("with_indicator"), percent(F.count(column), n_rows()).alias("coverage_pct"))
        .orderBy("symbol", tf_order()))


def timeframe_totals(bars):
    return (bars.groupBy("timeframe").agg(
        n_rows().alias("total_rows"), F.countDistinct("symbol").alias("symbols"), F.min("open_time").alias("earliest"),
        F.max("open_time").alias("latest")).orderBy(tf_order()))


def density(bars, more_than=100):
    days = whole_days(F.min("open_time"), F.max("open_time"))
    return (bars.groupBy(*SERIES).agg(n_rows().alias("total_rows"), days.alias("day_span"),
                                      F.round(n_rows() / (days + 1), 2).alias("rows_per_day"))
            .where(F.col("total_rows") > more_than))


def totals_rollup(bars):
    """Totals per series, per symbol and overall."""
    return (bars.rollup("symbol", "timeframe").agg(n_rows().alias("total_rows"), F.min("open_time").alias("earliest"),
                                                   F.max("open_time").alias("latest"))
            .select(F.coalesce("symbol", F.lit("ALL")).alias("symbol"),
                    F.coalesce("timeframe", F.lit("ALL")).alias("timeframe"), "total_rows", "earliest", "latest"))


def duplicate_keys(rows, group, key):
    """Groups with more rows than distinct keys."""
    return (rows.groupBy(*group, *key).agg(n_rows().alias("_n")).groupBy(*group)
            .agg(F.sum("_n").alias("total_rows"), n_rows().alias("distinct_keys"), F.sum(F.col("_n") - 1).alias("duplicates"))
            .where("duplicates > 0"))


def collection_period(bars):
    return bars.groupBy("symbol").agg(
        F.min("open_time").alias("earliest"), F.max("open_time").alias("latest"), n_rows().alias("total_rows"),
        whole_days(F.min("open_time"), F.max("open_time")).alias("days"))


def series_counts(bars):
    return bars.groupBy(*SERIES).agg(n_rows().alias("total_rows"))


def unpivot_row(df, names, parts):
    """One wide row of ``<name>__<part>`` columns to one row per name."""
    entries = F.array(*[F.struct(F.lit(n).alias("indicator"), *[F.col(f"{n}__{p}").alias(p) for p in parts])
                        for n in names])
    return df.select(F.explode(entries).alias("_e")).select("_e.*")


def column_coverage(bars, columns=INDICATOR_COLUMNS):
    """Total, filled, missing and coverage of every indicator column; one pass."""
    wide = bars.agg(n_rows().alias("_total"), *[F.count(c).alias(f"{c}__calculated") for c in columns])
    wide = wide.withColumns({f"{c}__total": F.col("_total") for c in columns})
    wide = wide.withColumns({f"{c}__missing": F.col("_total") - F.col(f"{c}__calculated") for c in columns})
    wide = wide.withColumns({f"{c}__coverage_pct": percent(F.col(f"{c}__calculated"), F.col("_total")) for c in columns})
    return unpivot_row(wide, columns, ["total", "calculated", "missing", "coverage_pct"])


def series_coverage(bars, columns=("rsi", "macd", "adx", "bb_middle")):
    return bars.groupBy(*SERIES).agg(n_rows().alias("total_rows"), *[F.count(c).alias(f"{c}_count") for c in columns], *[
        percent(F.count(c), n_rows()).alias(f"{c}_pct") for c in columns])


def value_ranges(bars, columns=INDICATOR_COLUMNS, digits=4):
    wide = bars.agg(*[x for c in columns for x in (
        F.count(c).alias(f"{c}__n"), F.round(F.min(c), digits).alias(f"{c}__low"),
        F.round(F.max(c), digits).alias(f"{c}__high"), F.round(F.avg(c), digits).alias(f"{c}__mean"))])
    return unpivot_row(wide, columns, ["n", "low", "high", "mean"])


def latest_with(bars, columns=("rsi", "macd", "adx")):
    return bars.groupBy(*SERIES).agg(F.max("open_time").alias("latest"), *[
        F.max(F.when(F.col(c).isNotNull(), F.col("open_time"))).alias(f"latest_{c}") for c in columns])


def indicator_lag(bars, column="rsi"):
    filled = F.max(F.when(F.col(column).isNotNull(), F.col("open_time")))
    newest = F.max("open_time")
    return (bars.groupBy(*SERIES).agg(newest.alias("latest"), filled.alias("latest_filled"),
                                      ((F.unix_seconds(newest) - F.unix_seconds(filled)) / 60.0).alias("minutes_behind"))
            .where("latest > latest_filled"))


def missing(bars, column="rsi", by=SERIES, more_than=0, when=None):
    rows = bars.where(F.col(column).isNull())
    if when is not None:
        rows = rows.where(when)
    return rows.groupBy(*by).agg(n_rows().alias("missing")).where(F.col("missing") > more_than)


def coverage_with_latest(bars, column="rsi", limit=15):
    return (bars.groupBy(*SERIES).agg(
        n_rows().alias("total_rows"), F.count(column).alias("with_indicator"), percent(F.count(column), n_rows()).alias("coverage_pct"),
        F.max("open_time").alias("latest"),
        F.max(F.when(F.col(column).isNotNull(), F.col("open_time"))).alias("latest_filled"))
        .where("with_indicator > 0").orderBy(F.desc("with_indicator"), "symbol", "timeframe").limit(limit))


def earliest_null(bars, columns=INDICATOR_COLUMNS):
    return bars.groupBy(*SERIES).agg(F.min(F.when(any_null(columns), F.col("open_time"))).alias("earliest_null"))


def null_ranking(bars, now, days=30, columns=INDICATOR_COLUMNS):
    recent = any_null(columns) & since("open_time", now, days * 86400)
    return (bars.groupBy(*SERIES).agg(F.count_if(recent).alias("recent_nulls"), F.count_if(any_null(columns)).alias("all_nulls"))
            .orderBy(F.desc("recent_nulls")))


def flat_bars(bars, more_than=10):
    return bars.where(is_flat()).groupBy(*SERIES).agg(n_rows().alias("flat_rows")).where(F.col("flat_rows") > more_than)


def out_of_range(bars):
    rsi, atr = F.col("rsi"), F.col("atr")
    return bars.groupBy(*SERIES).agg(F.count_if((rsi < 0) | (rsi > 100)).alias("rsi_out_of_range"),
                                     F.count_if(atr <= 0).alias("atr_not_positive"), F.count("rsi").alias("rsi_rows"))


# --- snapshot outcomes -----------------------------------------------------------

OUT = ("max_gain_pct_1h", "max_loss_pct_1h")


def outcome_coverage(snapshots, by=("symbol",), when=None):
    rows = snapshots if when is None else snapshots.where(when)
    return rows.groupBy(*by).agg(n_rows().alias("total"), F.count(OUT[0]).alias("with_gain"), F.count(OUT[1]).alias("with_loss"),
                                 percent(F.count(OUT[0]), n_rows()).alias("coverage_pct"))


def outcome_summary(snapshots, by=("symbol",), digits=4):
    g, l = OUT
    return snapshots.groupBy(*by).agg(
        n_rows().alias("total"), F.count(g).alias("calculated"), F.round(F.avg(g), digits).alias("avg_gain"),
        F.round(F.avg(l), digits).alias("avg_loss"), F.max(g).alias("max_gain"), F.min(l).alias("min_loss"))


def latest_statistics(snapshots, n=50):
    """Averages, extremes and mean span of the newest ``n`` calculated snapshots."""
    g, l = OUT
    newest = snapshots.where(F.col(g).isNotNull()).orderBy(F.desc("snapshot_time"), "symbol").limit(n)
    return newest.agg(n_rows().alias("n"), F.round(F.avg(g), 4).alias("avg_gain"), F.round(F.avg(l), 4).alias("avg_loss"),
                      F.max(g).alias("max_gain"), F.min(l).alias("min_loss"),
                      F.round(F.avg(F.col(g) - F.col(l)), 4).alias("avg_range"))


def readiness(forward, min_bars=60):
    ready = F.col("fwd_bars") >= min_bars
    return forward.groupBy("symbol").agg(
        F.count_if(ready).alias("ready"), F.count_if(~ready).alias("not_ready"), n_rows().alias("missing"),
        F.min(F.when(ready, F.col("open_time"))).alias("earliest_ready"), percent(F.count_if(ready), n_rows()).alias("ready_pct"))


def by_label(rows, label, gain="gain", loss="loss"):
    return rows.groupBy(label).agg(n_rows().alias("total"), F.count(gain).alias("with_gain"), F.round(F.avg(gain), 4).alias("avg_gain"),
                                   F.round(F.avg(loss), 4).alias("avg_loss"), F.max(gain).alias("max_gain"),
                                   F.min(loss).alias("min_loss"))


# --- spreads, sessions, activity ----------------------------------------------------

def hourly_histogram(bars, now):
    return bars.where(since("open_time", now, 86400)).groupBy(F.hour("open_time").alias("hour")).agg(n_rows().alias("total_rows"))


def daily_spread(bars):
    return (bars.where("spread > 0").groupBy(F.to_date("open_time").alias("day")).agg(
        n_rows().alias("total_rows"), F.round(F.avg("spread"), 6).alias("avg_spread"), F.min("spread").alias("min_spread"),
        F.max("spread").alias("max_spread"), F.sum("volume").alias("volume")))


def symbols_with_spread(bars, now, seconds=3600):
    recent = bars.where((F.col("spread") > 0) & since("open_time", now, seconds))
    return recent.agg(F.countDistinct("symbol").alias("symbols"), n_rows().alias("total_rows"))


def hourly_spread(bars, spread):
    return bars.groupBy(F.date_trunc("hour", "open_time").alias("hour")).agg(
        n_rows().alias("total_rows"), F.avg(spread.cast("decimal(18,2)")).alias("avg_spread"), F.min(spread).alias("min_spread"),
        F.max(spread).alias("max_spread"))


def spread_validation(bars, spread):
    text = F.format_string("%.2f", spread)
    return bars.groupBy("symbol").agg(
        n_rows().alias("total"), F.count(spread).alias("with_spread"), F.count_if(spread > 0).alias("positive"),
        F.count_if(spread < 0).alias("negative"), F.count_if(spread == 0.01).alias("at_minimum"),
        F.count_if(text.rlike(r"^[0-9]+\.[0-9]{2}$")).alias("two_decimals"), F.max(spread).alias("max_spread"))


def session_mismatch(bars, actual):
    """Rows whose stored session differs from the one of their hour, per pair."""
    want = session_pattern()
    return bars.groupBy(want.alias("expected"), actual.alias("actual")).agg(
        n_rows().alias("total_rows"), F.count_if(want != actual).alias("mismatches"))


def documents_present(snapshots, columns):
    return snapshots.agg(n_rows().alias("total"), *[F.count(c).alias(f"{c}_present") for c in columns])


def recent_activity(rows, time, now, seconds):
    return rows.where(since(time, now, seconds)).agg(n_rows().alias("total"), F.min(time).alias("earliest"), F.max(time).alias("latest"))


def timeframe_activity(bars, now, seconds=86400):
    return bars.where(since("open_time", now, seconds)).groupBy("timeframe").agg(
        n_rows().alias("total_rows"), F.max("open_time").alias("latest"), F.round(F.avg("close_price"), 4).alias("avg_close"))


def series_activity(bars, now, seconds=86400):
    return bars.where(since("open_time", now, seconds)).groupBy(*SERIES).agg(
        n_rows().alias("total_rows"), F.max("open_time").alias("latest"), F.round(F.avg("spread"), 6).alias("avg_spread"))


def symbol_timeframe_span(bars, now, seconds=86400):
    return bars.where(since("open_time", now, seconds)).agg(
        F.countDistinct("symbol").alias("symbols"), F.countDistinct("timeframe").alias("timeframes"),
        F.min("open_time").alias("oldest"), F.max("open_time").alias("newest"))


def conditional_average(bars):
    s = F.col("spread")
    return bars.groupBy("symbol").agg(n_rows().alias("total"), F.count_if(s > 0).alias("with_spread"),
                                      F.round(F.avg(F.when(s > 0, s)), 6).alias("avg_positive_spread"))


def coverage_status(coverage, good=95, fair=70):
    return coverage.withColumn("status", status_tier("coverage_pct", good, fair, ("complete", "partial", "poor")))


# --- series against each other ---------------------------------------------------------

def return_correlations(bars, pairs):
    """Correlation of bar returns per timeframe for the pairs (a, b) of a table: the returns of both symbols
    meet on (timeframe, open_time), for listed pairs only."""
    from tickloom.operators.sequence import block_window, rolling
    prev = F.lag("close_price").over(block_window())
    back = rolling(bars, {"_return": F.try_divide(F.col("close_price") - prev, prev)}, 1).where("_return is not null")
    x = back.select(F.col("symbol").alias("a"), "timeframe", "open_time", F.col("_return").alias("_x")).join(pairs, "a")
    y = back.select(F.col("symbol").alias("b"), "timeframe", "open_time", F.col("_return").alias("_y"))
    return x.join(y, ["b", "timeframe", "open_time"]).groupBy("a", "b", "timeframe").agg(
        pearson("_x", "_y").alias("correlation"), F.count(F.lit(1)).alias("n"))
