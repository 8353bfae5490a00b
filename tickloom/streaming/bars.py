"""Ticks to bars, late bars, sliding ranges and the bar feed."""
from pyspark.sql import functions as F

from tickloom.functions import classify
from tickloom.sources.sinks import BAR_KEY


def closed_bars(ticks, seconds, timeframe, delay="1 minute"):
    """Bars of one timeframe, emitted once the watermark has passed their end."""
    pos = F.struct("ts", "tick_id")
    bars = (ticks.withWatermark("ts", delay).groupBy("symbol", F.window("ts", f"{seconds} seconds").alias("w"))
            .agg(F.min_by("price", pos).alias("open_price"), F.max("price").alias("high_price"),
                 F.min("price").alias("low_price"), F.max_by("price", pos).alias("close_price"),
                 F.count(F.lit(1)).alias("volume")))
    return bars.select("symbol", F.lit(timeframe).alias("timeframe"), F.col("w.start").alias("open_time"), "open_price",
                       "high_price", "low_price", "close_price", "volume")


def sliding_ranges(m1, hours=4, slide="1 minute", delay="1 minute"):
    """Highest high minus lowest low over sliding windows of M1 bars."""
    w = F.window("open_time", f"{hours} hours", slide).alias("w")
    out = m1.withWatermark("open_time", delay).groupBy("symbol", w).agg(
        F.round(F.max("high_price") - F.min("low_price"), 2).alias("price_range"), F.count(F.lit(1)).alias("bars"))
    return out.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "price_range", "bars")


def enriched(bars):
    """The bridge step: spread estimate, session, volatility score and change of new bars.
    The stream's checkpoint holds the position, so no row is read twice."""
    return classify.enrich_bars(bars)


def without_repeats(bars, delay="1 hour"):
    """Drop repeated deliveries of the same bar inside the watermark."""
    return bars.withWatermark("open_time", delay).dropDuplicatesWithinWatermark(BAR_KEY)
