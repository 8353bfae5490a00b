"""SQL texts of the views, for the check side only (DuckDB dialect)."""

TFS = "(VALUES ('M1', 60), ('M5', 300), ('M15', 900), ('M30', 1800), ('H1', 3600), ('H4', 14400), ('D1', 86400))"
SERIES = "PARTITION BY symbol, timeframe ORDER BY open_time"


def ewm(x, alpha, n="n"):
    """Closed form of the recursive mean (series of the check data are short enough)."""
    return (f"pow(1e0 - {alpha}, {n}) * sum(CASE WHEN {n} = 1 THEN {x} ELSE {x} * {alpha} END * pow(1e0 - {alpha}, -{n})) "
            f"OVER ({SERIES} ROWS UNBOUNDED PRECEDING)")


WILDER = "(1e0 / 14e0)"
SESSION = ("CASE WHEN hour({t}) >= 22 OR hour({t}) <= 6 THEN 'Sydney' WHEN hour({t}) BETWEEN 7 AND 14 THEN 'London' "
           "ELSE '{ny}' END")


def session(t="open_time", ny="New York"):
    return SESSION.format(t=t, ny=ny)


def full(fn, x, n):
    w = f"OVER ({SERIES} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {w} = {n} THEN {fn}({x}) {w} END"


def pct(value, price, digits):
    return f"round(({value} - {price}) / {price} * 100e0, {digits})"


def half_up(x, digits):
    """Round half up on the printed digits, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


ORDER_TYPE = "CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END"
COMMENT = "CASE WHEN event_id % 5 > 0 THEN concat('note ', event_id % 3) END"

CTES = {
    "ticks": "SELECT concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, ts, value AS price, event_id AS tick_id, "
             "event_type AS source FROM events",
    "tfs": f"SELECT timeframe, CAST(secs AS BIGINT) AS secs FROM {TFS} AS t(timeframe, secs)",
    "bars": "SELECT symbol, timeframe, secs, make_timestamp((epoch_us(ts) // (secs * 1000000)) * secs * 1000000) AS open_time, "
            "arg_min(price, ts) AS open_price, max(price) AS high_price, min(price) AS low_price, "
            "arg_max(price, ts) AS close_price, count(*) AS volume, arg_max(source, ts) AS data_source, "
            "round((max(price) - min(price)) * 0.1e0, 6) AS spread "
            "FROM ticks CROSS JOIN tfs GROUP BY 1, 2, 3, 4",
    "m1": "SELECT * FROM bars WHERE timeframe = 'M1'",
    "ind0": f"SELECT *, row_number() OVER ({SERIES}) AS n, lag(close_price) OVER ({SERIES}) AS pc, "
            f"lag(high_price) OVER ({SERIES}) AS ph, lag(low_price) OVER ({SERIES}) AS pl, "
            "(high_price + low_price + close_price) / 3e0 AS tp FROM bars",
    "ind1": "SELECT *, greatest(high_price - low_price, abs(high_price - pc), abs(low_price - pc)) AS true_range, "
            "CASE WHEN high_price - ph > 0 AND high_price - ph > pl - low_price THEN high_price - ph ELSE 0e0 END AS plus_dm, "
            "CASE WHEN pl - low_price > 0 AND pl - low_price > high_price - ph THEN pl - low_price ELSE 0e0 END AS minus_dm, "
            "CASE WHEN close_price - pc > 0 THEN close_price - pc WHEN pc IS NOT NULL THEN 0e0 END AS gain, "
            "CASE WHEN close_price - pc < 0 THEN pc - close_price WHEN pc IS NOT NULL THEN 0e0 END AS loss, "
            f"{full('avg', 'close_price', 20)} AS bb_middle, {full('stddev_samp', 'close_price', 20)} AS sd20, "
            f"{full('avg', 'close_price', 14)} AS sma, {full('min', 'low_price', 14)} AS low14, "
            f"{full('max', 'high_price', 14)} AS high14, {full('avg', 'tp', 20)} AS tp20, "
            f"{full('list', 'tp', 20)} AS tps, "
            f"coalesce(sum(sign(close_price - pc) * volume) OVER ({SERIES} ROWS UNBOUNDED PRECEDING), 0e0) AS obv FROM ind0",
    "ind2": "SELECT *, bb_middle + 2 * sd20 AS bb_upper, bb_middle - 2 * sd20 AS bb_lower, "
            "100e0 * (close_price - low14) / nullif(high14 - low14, 0e0) AS stochastic_k, "
            "-100e0 * (high14 - close_price) / nullif(high14 - low14, 0e0) AS willr, "
            "(tp - tp20) / nullif(0.015e0 * list_avg(list_transform(tps, lambda x: abs(x - tp20))), 0e0) AS cci, "
            f"{ewm('true_range', WILDER)} AS atr, {ewm('plus_dm', WILDER)} AS pdm, {ewm('minus_dm', WILDER)} AS mdm, "
            f"{ewm('gain', WILDER, '(n - 1)')} AS ag, {ewm('loss', WILDER, '(n - 1)')} AS al, "
            f"{ewm('close_price', '(2e0 / 21e0)')} AS ema, "
            f"{ewm('close_price', '(2e0 / 13e0)')} - {ewm('close_price', '(2e0 / 27e0)')} AS macd FROM ind1",
    "ind3": "SELECT *, 100e0 * pdm / nullif(atr, 0e0) AS plus_di, 100e0 * mdm / nullif(atr, 0e0) AS minus_di, "
            f"{ewm('macd', '(2e0 / 10e0)')} AS macd_signal, "
            f"{full('avg', 'stochastic_k', 3)} AS stochastic_d, "
            "100e0 - 100e0 / (1e0 + ag / nullif(al, 0e0)) AS rsi FROM ind2",
    "ind4": "SELECT *, 100e0 * abs(plus_di - minus_di) / nullif(plus_di + minus_di, 0e0) AS dx, "
            "macd - macd_signal AS macd_hist FROM ind3",
    "ind5": f"SELECT *, count(dx) OVER ({SERIES} ROWS UNBOUNDED PRECEDING) AS ndx FROM ind4",
    "ind": f"SELECT *, CASE WHEN ndx > 0 THEN {ewm('dx', WILDER, 'ndx')} END AS adx FROM ind5",
    "account_state": "SELECT CAST(user_id AS VARCHAR) AS account_id, concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, "
                     "ts AS timestamp, value * 100 AS balance, value * 100 + value AS equity, value * 10 AS margin, "
                     "value * 91 AS free_margin, value - 50 AS profit, 'USD' AS currency, CAST((user_id % 5 + 1) * 100 AS INTEGER) AS leverage, "
                     "value + 100 AS margin_level, CAST(nullif(event_id % 4, 0) AS INTEGER) AS total_positions, value * 0.5e0 AS risk_percent FROM events WHERE event_type = 'signup'",
    "open_trades": "SELECT event_id AS trade_id, CAST(user_id AS VARCHAR) AS account_id, "
                   "concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, user_id AS magic_number, value AS open_price, "
                   "value * 0.95e0 AS sl, value * 1.05e0 AS tp, ts AS open_time, close_time, "
                   "CASE WHEN close_time IS NULL THEN 'open' WHEN event_id % 3 = 0 THEN 'pending' ELSE 'closed' END AS status, "
                   f"{ORDER_TYPE} AS order_type, (event_id % 10 + 1) * 0.25e0 AS lot_size, {COMMENT} AS comment "
                   "FROM (SELECT *, min(CASE WHEN event_type = 'error' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts "
                   "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS close_time FROM events "
                   "WHERE event_type IN ('click', 'error')) WHERE event_type = 'click'",
    "closed_trades": "SELECT event_id AS id, concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, "
                     "CAST(user_id AS VARCHAR) AS account_id, ts AS time, value AS entry_price, "
                     "value + CAST(event_id % 7 - 3 AS DOUBLE) AS exit_price, CAST(event_id % 7 - 3 AS DOUBLE) AS profit, "
                     f"1e0 AS volume, {ORDER_TYPE} AS type, {COMMENT} AS comment FROM events WHERE event_type = 'purchase'",
    "planned_trades": "SELECT event_id AS id, user_id AS magic_number, ts AS timestamp, "
                      "concat('S', CAST(user_id % 5 AS VARCHAR)) AS symbol, "
                      "CASE WHEN event_id % 11 <> 0 THEN value * 0.9e0 END AS sl, value * 1.1e0 AS tp "
                      "FROM events WHERE event_type = 'view'",
    "articles": "SELECT d.doc_id, d.lang AS currency, d.source, CAST(l.quality - l.toxic AS DOUBLE) AS score, "
                "least(d.n_chars / 2e4, 1e0) AS relevance FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings",
    "fwd": "SELECT *, max(high_price) OVER w AS fwd_high, min(low_price) OVER w AS fwd_low, count(*) OVER w AS fwd_bars "
           "FROM m1 WINDOW w AS (PARTITION BY symbol ORDER BY open_time RANGE BETWEEN INTERVAL 1 SECOND FOLLOWING "
           "AND INTERVAL 1 HOUR FOLLOWING)",
    "snapshots": "SELECT symbol, open_time AS snapshot_time, close_price, high_price, low_price, "
                 "CASE WHEN fwd_bars >= 3 THEN coalesce(CASE WHEN close_price > 0 THEN "
                 f"{pct('fwd_high', 'close_price', 4)} END, 0e0) END AS max_gain_pct_1h, "
                 "CASE WHEN fwd_bars >= 3 THEN coalesce(CASE WHEN close_price > 0 THEN "
                 f"{pct('fwd_low', 'close_price', 4)} END, 0e0) END AS max_loss_pct_1h, "
                 "fwd_bars AS calculation_range_minutes, false AS prediction_mode FROM fwd",
}
