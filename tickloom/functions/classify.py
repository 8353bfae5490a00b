"""Sessions, volatility, spreads and other classifiers as column expressions.

Several rules of the same name coexist (five sessions, four volatility rules,
three spreads); each keeps its own function.
"""
from pyspark.sql import functions as F

from tickloom.constants import (ATR_THRESHOLDS, DEFAULT_SPREAD, DEFAULT_SPREADS, FALLBACK_SPREAD, RANGE_1H_THRESHOLDS,
                                RANGE_4H_THRESHOLDS)


def _col(x):
    return F.col(x) if isinstance(x, str) else x


def _by_hour(time, rules, otherwise):
    hour = F.hour(_col(time))
    out = None
    for first, last, label in rules:
        test = hour.between(first, last) if first <= last else (hour >= first) | (hour <= last)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise)


def session_pattern(time="open_time", new_york="New York"):
    """Pattern documents (and, with label New_York, the bar enrichment)."""
    return _by_hour(time, [(22, 6, "Sydney"), (7, 14, "London"), (15, 21, new_york)], "Unknown")


def session_bridge(time="open_time"):
    return session_pattern(time, "New_York")


def session_market_live(time="open_time"):
    return _by_hour(time, [(7, 16, "London"), (13, 20, "NY")], "Other")


def session_market_history(time="open_time"):
    return _by_hour(time, [(0, 5, "Asian"), (6, 13, "European"), (14, 21, "American")], "Asian")


def session_dashboard(time="open_time"):
    return _by_hour(time, [(22, 6, "Sydney"), (8, 16, "London"), (17, 21, "New York")], "Transition")


def session_flags(time="open_time"):
    """Overlapping 0/1 flags plus hour and weekday (Monday = 0)."""
    hour = F.hour(_col(time))
    return {"hour": hour, "day_of_week": F.weekday(_col(time)), "is_london": hour.between(8, 16).cast("int"),
            "is_new_york": hour.between(13, 21).cast("int"), "is_overlap": hour.between(13, 16).cast("int")}


def _tier(value, high, medium, suffix=""):
    return (F.when(value > high, "high" + suffix).when(value > medium, "medium" + suffix)
            .when(value.isNotNull(), "low" + suffix))


def volatility_pattern(atr, range_1h=None, range_4h=None):
    """First timeframe with an ATR decides; else the price ranges; else no_data.

    ``atr`` maps H1, H4, M15, M5 to columns. A range of 0 counts as missing.
    """
    tests = [_tier(_col(atr[tf]), *ATR_THRESHOLDS[tf]) for tf in ("H1", "H4", "M15", "M5") if tf in atr]
    for value, limits in ((range_4h, RANGE_4H_THRESHOLDS), (range_1h, RANGE_1H_THRESHOLDS)):
        if value is not None:
            value = _col(value)
            tests.append(_tier(F.when(value != 0, value), *limits, suffix="_price"))
    return F.coalesce(*tests, F.lit("no_data"))


def volatility_live(atr):
    return F.when(F.coalesce(_col(atr), F.lit(0.0)) > 1.5, "high").otherwise("low")


def volatility_score(open="open_price", high="high_price", low="low_price"):
    """(high - low) / open in percent, 4 decimals; 0 if any of them is missing or 0."""
    o, h, l = _col(open), _col(high), _col(low)
    ok = (o != 0) & (h != 0) & (l != 0)
    return F.coalesce(F.when(ok, F.round(F.try_divide(h - l, o) * 100, 4)), F.lit(0.0))


def regime(deviation):
    d = _col(deviation)
    return F.when(d > 2.0, "high").when(d < 0.5, "low").otherwise("medium")


def bar_spread(high="high_price", low="low_price"):
    """Spread column of a bar: a tenth of its range, 6 decimals."""
    return F.round((_col(high) - _col(low)) * 0.1, 6)


def spread_from_range(high="high_price", low="low_price"):
    """A tenth of the last bar's range, at least 0.01; 0.40 without a bar."""
    tenth = (_col(high) - _col(low)) * 0.1
    known = F.when(tenth.isNotNull(), F.round(F.greatest(F.lit(0.01), tenth), 2))
    return F.coalesce(known, F.lit(FALLBACK_SPREAD))


def spread_range(high="high_price", low="low_price"):
    return F.round(_col(high) - _col(low), 5)


def spread_default(spread="spread", symbol="symbol"):
    """Per-symbol default where the spread is null or 0."""
    s = _col(spread)
    table = F.create_map(*[F.lit(x) for kv in DEFAULT_SPREADS.items() for x in kv])
    return F.coalesce(F.when(s != 0, s), F.try_element_at(table, _col(symbol)), F.lit(DEFAULT_SPREAD))


def enrich_bars(bars, processed_at=None):
    """Session, volatility score, relative change and estimated spread of a bar."""
    o, c = F.col("open_price"), F.col("close_price")
    change = F.coalesce(F.when((o != 0) & (c != 0), F.round(F.try_divide(c - o, o) * 100, 4)), F.lit(0.0))
    out = bars.withColumns({"estimated_spread": spread_default(), "trading_session": session_bridge(),
                            "volatility_score": volatility_score(), "price_change_pct": change})
    return out if processed_at is None else out.withColumn("processed_at", processed_at)


def account_health(balance="balance", equity="equity", profit="profit"):
    b = _col(balance)
    return {"equity_ratio": F.when(b > 0, F.try_divide(_col(equity), b) * 100),
            "profit_pct": F.when(b > 0, F.try_divide(_col(profit), b) * 100)}


def trade_result(profit="profit"):
    p = _col(profit)
    return F.when(p > 0, "profit").when(p < 0, "loss").when(p == 0, "breakeven")


def duration_minutes(opened, closed):
    """Whole minutes between two times, truncated toward zero; 0 if either is missing."""
    seconds = F.unix_micros(_col(closed)) - F.unix_micros(_col(opened))
    return F.coalesce((seconds / 60000000.0).cast("long"), F.lit(0).cast("long"))


def age_minutes(time, now):
    return (F.unix_micros(now) - F.unix_micros(_col(time))) / 60000000.0


def freshness_tier(minutes):
    m = _col(minutes)
    return F.when(m <= 2, "Ready for Force-Fresh").when(m <= 5, "Usable").otherwise("Too Stale")


def status_tier(value, good, fair, labels, descending=False):
    """Three-way tier: at least ``good`` / ``fair`` (or at most, when descending)."""
    v = _col(value)
    first, second = ((v <= good, v <= fair) if descending else (v >= good, v >= fair))
    return F.when(first, labels[0]).when(second, labels[1]).otherwise(labels[2])


def is_flat():
    """Bars whose four prices are equal."""
    o, h, l, c = (F.col(x) for x in ("open_price", "high_price", "low_price", "close_price"))
    return (o == h) & (h == l) & (l == c)


def any_null(columns):
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return test


def is_numeric_text(text):
    return _col(text).rlike(r"^[0-9.]+$")


def has_two_decimals(text):
    return _col(text).rlike(r"^[0-9]+\.[0-9]{2}$")
