"""Binding of the market-data model to the event tables used for checks.

A production deployment reads its own tables; these views give ticks, bars,
account rows and trades the same schemas from ``events`` / ``documents`` /
``labels`` / ``embeddings``.
"""
from functools import cached_property

from pyspark.sql import functions as F

from tickloom.functions import classify
from tickloom.operators import outcome, resample
from tickloom.operators.asof import asof_join
from tickloom.operators.indicators import stored_indicators
from tickloom.session import use_utc


def _order(n):
    """Order type, size and comment (absent on every fifth) of the trade of an event."""
    return [F.when(n % 2 == 0, "BUY").otherwise("SELL").alias("order_type"), ((n % 10 + 1) * 0.25).alias("lot_size"),
            F.when(n % 5 > 0, F.concat(F.lit("note "), (n % 3).cast("string"))).alias("comment")]


class Views:
    def __init__(self, spark, path):
        self.spark = use_utc(spark)
        self.path = path

    def table(self, name):
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def events(self):
        return (self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
                .withColumn("symbol", F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string"))))

    @cached_property
    def ticks(self):
        return self.events.select("symbol", "ts", F.col("value").alias("price"), F.col("event_id").alias("tick_id"),
                                  F.col("event_type").alias("source"))

    @cached_property
    def bars(self):
        """Bars of all timeframes, with the source of the last tick."""
        bars = resample.all_timeframes(
            self.ticks,
            extra_tick=[F.max_by("source", resample.tick_position()).alias("data_source")],
            extra_bar=[F.max_by("data_source", "open_time").alias("data_source")])
        return bars.withColumn("spread", classify.bar_spread())

    def bars_of(self, *timeframes):
        """Bars of the named timeframes only, resampled straight from the ticks."""
        out = None
        for tf in timeframes:
            one = resample.resample(self.ticks, resample.TF_SECONDS[tf], tf)
            out = one if out is None else out.unionByName(one)
        return out.withColumn("spread", classify.bar_spread())

    @cached_property
    def m1(self):
        return self.bars_of("M1")

    @cached_property
    def indicators(self):
        return stored_indicators(self.bars)

    @cached_property
    def account_state(self):
        v = F.col("value")
        return self.events.where("event_type = 'signup'").select(
            F.col("user_id").cast("string").alias("account_id"), "symbol", F.col("ts").alias("timestamp"),
            (v * 100).alias("balance"), (v * 100 + v).alias("equity"), (v * 10).alias("margin"),
            (v * 91).alias("free_margin"), (v - 50).alias("profit"), F.lit("USD").alias("currency"),
            ((F.col("user_id") % 5 + 1) * 100).cast("int").alias("leverage"), (v + 100).alias("margin_level"),
            F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 4).cast("int").alias("total_positions"), (v * 0.5).alias("risk_percent"))

    @cached_property
    def open_trades(self):
        """Clicks open a trade; the user's next error closes it (forward as-of join)."""
        errors = self.events.where("event_type = 'error'").select(
            "user_id", F.col("ts").alias("close_time"), F.col("event_id").alias("_tie"))
        v = F.col("value")
        return (asof_join(self.events.where("event_type = 'click'"), errors, ["user_id"], "ts", "close_time",
                          ["close_time"], tie="_tie", direction="forward")
                .select(F.col("event_id").alias("trade_id"), F.col("user_id").cast("string").alias("account_id"),
                        "symbol", F.col("user_id").alias("magic_number"), v.alias("open_price"),
                        (v * 0.95).alias("sl"), (v * 1.05).alias("tp"), F.col("ts").alias("open_time"), "close_time",
                        F.when(F.col("close_time").isNull(), "open")
                        .when(F.col("event_id") % 3 == 0, "pending").otherwise("closed").alias("status"), *_order(F.col("event_id"))))

    @cached_property
    def closed_trades(self):
        v = F.col("value")
        shift = (F.col("event_id") % 7 - 3).cast("double")
        return self.events.where("event_type = 'purchase'").select(
            F.col("event_id").alias("id"), "symbol", F.col("user_id").cast("string").alias("account_id"),
            F.col("ts").alias("time"), v.alias("entry_price"), (v + shift).alias("exit_price"),
            shift.alias("profit"), F.lit(1.0).alias("volume"), *_order(F.col("event_id"))[::2]).withColumnRenamed("order_type", "type")

    @cached_property
    def planned_trades(self):
        v = F.col("value")
        return self.events.where("event_type = 'view'").select(
            F.col("event_id").alias("id"), F.col("user_id").alias("magic_number"), F.col("ts").alias("timestamp"),
            "symbol", F.when(F.col("event_id") % 11 != 0, v * 0.9).alias("sl"), (v * 1.1).alias("tp"))

    @cached_property
    def articles(self):
        return (self.table("documents").join(self.table("labels"), "doc_id")
                .select("doc_id", F.col("lang").alias("currency"), "source",
                        (F.col("quality") - F.col("toxic")).cast("double").alias("score"),
                        F.least(F.col("n_chars") / 2e4, F.lit(1.0)).alias("relevance")))

    @cached_property
    def vectors(self):
        return self.table("embeddings").select(
            "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"), "label")

    @cached_property
    def snapshots(self):
        """One snapshot per M1 bar with its one-hour outcome (at least 3 later bars)."""
        return outcome.snapshot_outcomes(self.m1, min_bars=3)

    def now(self, df, time="open_time"):
        """Newest time of a frame as a scalar subquery column."""
        return df.agg(F.max(time)).scalar()
