"""Account and trade lookups and their documents (set-based over all snapshots)."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.asof import asof_join, latest_per_key
from tickloom.operators.collect import collect_items
from tickloom.operators.rangejoin import collect_valid_lists, fold_valid, interval_join, range_join

DAY = 86400
#: Amounts that a trade document names but the trade tables do not store.
NOT_STORED = ["profit", "commission", "swap"]
MICRO = 1000000


def original_stops(planned):
    """Earliest plan with both stops per magic number; combined map-side."""
    ok = planned.where("sl is not null and tp is not null")
    first = F.min_by(F.struct("sl", "tp"), F.struct("timestamp", "id")).alias("_s")
    return (ok.groupBy("magic_number").agg(first)
            .select("magic_number", F.col("_s.sl").alias("original_sl"), F.col("_s.tp").alias("original_tp")))


def with_original_stops(trades, planned):
    return trades.join(original_stops(planned), "magic_number", "left")


def live_trades(trades, planned):
    """Open and pending trades with the stops they were planned with."""
    return with_original_stops(trades.where(F.col("status").isin("open", "pending")), planned)


def trades_open_at(points, trades):
    """(point, trade) pairs valid at the point's time ``at``."""
    return interval_join(points, trades.withColumnRenamed("open_time", "trade_time"), ["symbol"], "at", "trade_time",
                         "close_time")


def closed_before(points, closed, seconds=DAY):
    """(point, trade) pairs of trades closed in (at - seconds, at]."""
    return range_join(points, closed, ["symbol"], "at", "time", -seconds, 0)


def while_recent(closed, seconds=DAY):
    """Closed trades as intervals from their time until they are ``seconds`` old."""
    return closed.withColumn("_until", F.timestamp_micros(F.unix_micros("time") + seconds * MICRO))


def open_totals(points, trades):
    """Points with any open trade: number, price sum and highest id of those valid then, without pairs."""
    return fold_valid(points, trades, ["symbol"], "at", "open_time", "close_time", {
        "n_open": (F.lit(1).cast("long"), F.sum), "price_sum": (F.col("open_price"), F.sum), "newest_trade": (F.col("trade_id"), F.max)})


def closed_totals(points, closed, seconds=DAY):
    """Points with any trade closed in (at - seconds, at]: number, profit and newest id, without pairs."""
    out = fold_valid(points, while_recent(closed, seconds), ["symbol"], "at", "time", "_until", {
        "n_trades": (F.lit(1).cast("long"), F.sum), "profit": (F.col("profit"), F.sum), "_newest": (F.struct("time", "id"), F.max)})
    return out.withColumn("newest_id", F.col("_newest.id")).drop("_newest")


def newest_account(account_state):
    """Account id of the newest state row, as a scalar column."""
    return account_state.agg(F.max_by("account_id", F.struct("timestamp", "account_id"))).scalar()


def latest_account_state(account_state):
    """Newest state row of the account seen last."""
    mine = account_state.where(F.col("account_id") == newest_account(account_state))
    return latest_per_key(mine, ["account_id"], "timestamp")


def account_at(points, account_state):
    cols = ["balance", "equity", "margin", "free_margin", "margin_level", "profit", "total_positions", "risk_percent", "timestamp"]
    return asof_join(points, account_state, ["symbol"], "at", "timestamp", cols)


def recent_closed(closed, since, limit=50):
    """Newest trades per symbol closed after that symbol's ``since`` time."""
    late = closed.join(since, "symbol").where(F.col("time") > F.col("since"))
    w = Window.partitionBy("symbol").orderBy(F.desc("time"), F.desc("id"))
    return late.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def last_snapshot_or_hour_ago(m1, snapshots, done):
    """Per symbol: time of the last snapshot with its trades exported, else one hour
    before the newest M1 bar."""
    newest = m1.groupBy("symbol").agg(F.max("open_time").alias("_newest"))
    last = snapshots.where(done).groupBy("symbol").agg(F.max("snapshot_time").alias("_last"))
    hour = F.timestamp_seconds(F.unix_seconds("_newest") - 3600)
    return newest.join(last, "symbol", "left").select("symbol", F.coalesce("_last", hour).alias("since"))


# --- documents ------------------------------------------------------------------

def _utc(c):
    from tickloom.functions.scalar import utc_text
    return utc_text(c)


def live_account_document(account_state):
    row = latest_account_state(account_state)
    return row.select("account_id", F.struct(
        _utc("timestamp").alias("timestamp"), "balance", "equity", "margin", "free_margin", "leverage", "profit",
        "currency").alias("account"))


def history_account_documents(points, account_state):
    row = account_at(points, account_state).where(F.col("timestamp").isNotNull())
    return row.select("symbol", "at", F.struct("balance", "equity", "margin", "free_margin", "margin_level",
                                               F.col("profit").alias("profit_loss"),
                                               F.coalesce("total_positions", F.lit(0)).alias("total_positions"), "risk_percent",
                                               _utc("timestamp").alias("timestamp"), "symbol").alias("account"))


def live_trade_documents(trades, planned):
    """Per account the list of open and pending trades, oldest first."""
    item = F.struct("symbol", F.col("magic_number").alias("magic"), "order_type", "lot_size", "open_price", "sl", "tp",
                    _utc("open_time").alias("open_time"), "status", "comment", "original_sl", "original_tp")
    return collect_items(live_trades(trades, planned), ["account_id"], item, ["open_time", "trade_id"], "trades")


def open_lists(trades):
    """What lists of the trades valid at a time are made of, oldest first."""
    item = F.struct("trade_id", "symbol", F.col("order_type").alias("type"), F.col("lot_size").alias("volume"), "open_price",
                    F.col("sl").alias("stop_loss"), F.col("tp").alias("take_profit"), *[F.lit(0.0).alias(c) for c in NOT_STORED],
                    _utc("open_time").alias("open_time"), F.coalesce("comment", F.lit("")).alias("comment"),
                    F.coalesce("magic_number", F.lit(0)).alias("magic"))
    return trades, "open_time", "close_time", item, ["open_time", "trade_id"]


def closed_lists(closed, seconds=DAY):
    """What lists of the trades closed in (at - seconds, at] are made of, newest first."""
    none = F.lit(None).cast("double")
    item = F.struct(F.col("id").alias("trade_id"), "symbol", "type", "volume", F.col("entry_price").alias("open_price"),
                    F.col("exit_price").alias("close_price"), none.alias("stop_loss"), none.alias("take_profit"), "profit",
                    *[F.lit(0.0).alias(c) for c in NOT_STORED[1:]], _utc("time").alias("open_time"), _utc("time").alias("close_time"),
                    F.coalesce("comment", F.lit("")).alias("comment"), F.lit(0).alias("magic"))
    order = [(-F.unix_micros("time")).alias("t"), (-F.col("id")).alias("id")]
    return while_recent(closed, seconds), "time", "_until", item, order


def open_trade_documents(points, trades):
    """Per snapshot with any the list of trades valid then, oldest first. Points are distinct."""
    return collect_valid_lists(points.select("symbol", "at"), {"trades": open_lists(trades)}, ["symbol"], "at", some=True)


def closed_trade_documents(points, closed):
    """Per snapshot with any the trades closed in the 24 hours before it, newest first. Points are distinct."""
    return collect_valid_lists(points.select("symbol", "at"), {"trades": closed_lists(closed)}, ["symbol"], "at", some=True)


def live_closed_documents(closed, since):
    none = F.lit(None).cast("double")
    item = F.struct("symbol", F.coalesce(F.expr("try_cast(account_id AS INT)"), F.lit(0)).alias("magic"),
                    F.coalesce("type", F.lit("unknown")).alias("order_type"), F.col("volume").alias("lot_size"),
                    F.col("entry_price").alias("open_price"), F.col("exit_price").alias("close_price"), none.alias("sl"), none.alias("tp"),
                    "profit", F.lit(None).cast("string").alias("open_time"), _utc("time").alias("close_time"),
                    F.lit(None).cast("int").alias("duration_minutes"))
    return collect_items(recent_closed(closed, since), ["symbol"], item, ["rank"], "trades")
