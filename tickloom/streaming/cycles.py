"""Periodic jobs: outcomes, exporters, health, alerts, trades.

Handlers write each batch to its own folder, so a retried batch replaces itself.
"""
import pandas as pd
from pyspark.sql import functions as F

from tickloom.operators import outcome
from tickloom.plans import documents, monitor, vectors
from tickloom.sources.sinks import write_json
from tickloom.streaming import order

HOUR = 3600
ALERT = "alert_type string, symbol string, severity string, timestamp timestamp"


OUTCOME = ("symbol string, snapshot_time timestamp, close_price double, fwd_high double, fwd_low double, fwd_bars long")


FIELDS = {"t": "long", "close": "double", "high": "double", "low": "double", "n": "long"}


class Outcomes(order.InTimeOrder):
    """State of a symbol: the snapshots that are still open (at most one per bar of the span), each with its highest
    high, lowest low and bar count so far."""

    def __init__(self, seconds):
        super().__init__({"high_price": "double", "low_price": "double", "close_price": "double"}, "open_time",
                         ", ".join(f"{c} array<{t}>" for c, t in FIELDS.items()))
        self.micros = seconds * 1000000

    def span(self, key):
        return order.BLOCK_ROWS * 60 * 1000000

    def start(self):
        return ([],) * len(FIELDS)

    def take(self, key, state, rows):
        pending, done = [list(p) for p in zip(*state)], []
        for now, high, low, close in rows:
            still = []
            for p in pending:
                if now <= p[0] + self.micros:
                    p[2], p[3], p[4] = max(p[2], high), min(p[3], low), p[4] + 1
                (done if now >= p[0] + self.micros else still).append(p)
            pending = [*still, [now, close, float("-inf"), float("inf"), 0]]
        met = [p for p in done if p[4]]
        out = pd.DataFrame({
            "symbol": key[0], "snapshot_time": pd.to_datetime([p[0] for p in met], unit="us"),
            "close_price": [p[1] for p in met], "fwd_high": [p[2] for p in met], "fwd_low": [p[3] for p in met],
            "fwd_bars": [p[4] for p in met]})
        return tuple([p[i] for p in pending] for i in range(len(FIELDS))), out


def delayed_outcomes(m1, seconds=HOUR, delay="0 seconds"):
    """Outcomes of each M1 snapshot once a bar at least ``seconds`` later is closed."""
    bars = m1.withWatermark("open_time", delay).select("symbol", "open_time", "high_price", "low_price", "close_price")
    rows = order.run(bars, ["symbol"], Outcomes(seconds), OUTCOME)
    gain, loss = outcome.gain_loss()
    return rows.select("symbol", "snapshot_time", gain.alias("max_gain_pct_1h"), loss.alias("max_loss_pct_1h"),
                       F.col("fwd_bars").alias("later_bars"))


def exporters(tail, load, path):
    """Handler running all live exporters after each batch of bars. ``tail`` (a ``BarTail``) holds the bars that the
    documents need; ``load()`` returns the current frames of accounts and trades."""
    def handle(batch, batch_id):
        if not batch.isEmpty():
            bars = tail.with_indicators(tail.advance(batch, batch_id))
            documents.live_snapshots(bars=bars, **load()).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return handle


def live_vectors(tail, path, **options):
    """Handler writing the vector of each symbol's newest bar after each batch of bars, from the tail."""
    def handle(batch, batch_id):
        if not batch.isEmpty():
            bars = tail.advance(batch, batch_id)
            # only vectors in units of the average range look at an indicator
            bars = tail.with_indicators(bars) if options.get("mode") == "atr" else bars.withColumn("atr", F.lit(None).cast("double"))
            made = vectors.snapshot_vectors(documents.newest_m1(bars), bars, **options).withColumnRenamed("at", "snapshot_time")
            made.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return handle


def health_cycle(path, now=None):
    """Handler appending one monitoring row per batch of bars."""
    def handle(batch, batch_id):
        if batch.isEmpty():
            return
        at = now if now is not None else batch.agg(F.max("open_time")).scalar()
        fresh = monitor.freshness(batch.select("symbol").distinct(), batch, at)
        connection = monitor.connection_health(batch, at, batch.agg(F.countDistinct("symbol")).scalar())
        row = monitor.report_row(fresh, monitor.spread_anomalies(batch, at), connection, at)
        row.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return handle


def new_closed_trades(path, file_format="parquet"):
    """Handler writing the trades closed since the last batch (the checkpoint is the cursor)."""
    def handle(batch, batch_id):
        target = f"{path}/batch={batch_id}"
        write_json(batch, target) if file_format == "json" else batch.write.mode("overwrite").parquet(target)
    return handle


def freshness_scores(bars, now):
    """Freshness of each symbol in a batch: age in minutes, the two-minute rule, a 0-100 score."""
    newest = bars.groupBy("symbol").agg(F.max("open_time").alias("latest"))
    age = (F.unix_micros(now) - F.unix_micros("latest")) / 60000000.0
    return newest.select("symbol", "latest", age.alias("minutes_old"), (age <= 2).alias("is_fresh"),
                         F.greatest(F.lit(0.0), 100 - age * 10).alias("freshness_score"))


class SentAlerts(order.InTimeOrder):
    """State of an (alert type, symbol): the time of the last alert sent."""

    def __init__(self, seconds):
        super().__init__({"severity": "string"}, "timestamp", "last_us long")
        self.micros = seconds * 1000000

    def span(self, key):
        return HOUR * 1000000

    def start(self):
        return (None,)

    def take(self, key, state, rows):
        last, out = state[0], []
        for us, severity in rows:
            if last is None or us - last >= self.micros:
                out.append((key[0], key[1], severity, pd.Timestamp(us, unit="us")))
                last = us
        return (last,), order.frame(out, ["alert_type", "symbol", "severity", "timestamp"])


def sent_alerts(alerts, seconds=monitor.COOLDOWN_SECONDS, delay="0 seconds"):
    """Stream of alerts that are sent: each (type, symbol) is silent for ``seconds`` after one.

    Alerts are taken in time order over batches as well, up to ``delay`` behind the newest; whole elapsed time is compared."""
    rows = alerts.withWatermark("timestamp", delay).select("alert_type", "symbol", "severity", "timestamp")
    return order.run(rows, ["alert_type", "symbol"], SentAlerts(seconds), ALERT)
