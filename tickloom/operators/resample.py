"""Ticks to bars, gap filling and roll-up."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import TF_SECONDS, TICK_TF_SECONDS
from tickloom.operators.sequence import epoch, tf_seconds


def floor_time(time, seconds):
    """Start of the slot of ``seconds`` length holding ``time``."""
    s = epoch(time)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds) if isinstance(seconds, int) else seconds))


def tick_position(time="ts", tie="tick_id"):
    """One number that orders ticks by time and then id. Unlike a struct it has a fixed width, which keeps
    first and last prices in the hash aggregate."""
    shift = F.lit("20000000000000000000").cast("decimal(20,0)")
    micros = F.unix_micros(F.col(time)).cast("decimal(17,0)")
    return (micros * shift + F.col(tie).cast("decimal(20,0)")).cast("decimal(38,0)")


def resample(ticks, seconds, timeframe, price="price", time="ts", order=("ts", "tick_id"), extra=()):
    """OHLC bars of one timeframe; one shuffle on (symbol, slot) with map-side
    combine, so a hot symbol only costs its number of slots.

    ``extra`` adds further aggregates.
    """
    pos = tick_position(*order)
    return (ticks.withColumn("open_time", floor_time(time, seconds))
            .groupBy("symbol", "open_time")
            .agg(F.min_by(price, pos).alias("open_price"), F.max(price).alias("high_price"),
                 F.min(price).alias("low_price"), F.max_by(price, pos).alias("close_price"),
                 F.count(F.lit(1)).alias("volume"), *extra)
            .withColumn("timeframe", F.lit(timeframe)))


def roll_up(bars, timeframes, extra=()):
    """Higher timeframes from finer bars in one pass (explode to the target slots,
    then a combining aggregation keyed by time, which stays in the hash aggregate)."""
    targets = F.array(*[F.lit(t) for t in timeframes])
    return (bars.withColumn("timeframe", F.explode(targets))
            .withColumn("_slot", floor_time("open_time", tf_seconds()))
            .groupBy("symbol", "timeframe", "_slot")
            .agg(F.min_by("open_price", "open_time").alias("open_price"), F.max("high_price").alias("high_price"),
                 F.min("low_price").alias("low_price"), F.max_by("close_price", "open_time").alias("close_price"),
                 F.sum("volume").alias("volume"), *extra)
            .withColumnRenamed("_slot", "open_time"))


def all_timeframes(ticks, extra_tick=(), extra_bar=()):
    """Bars of all seven timeframes from one scan of the ticks: M1 bars first, then the coarser
    ones in one combining aggregation over the far fewer M1 bars."""
    m1 = resample(ticks, 60, "M1", extra=extra_tick)
    return m1.unionByName(roll_up(m1, [t for t in TF_SECONDS if t != "M1"], extra=extra_bar))


def tick_tool_timeframes(ticks, extra=()):
    """Bars of every timeframe of the tick tool that resamples (TICK, the ticks themselves, does not): 30-second bars
    first, the coarser ones from them."""
    finest = resample(ticks, TICK_TF_SECONDS["S_30"], "S_30", extra=extra)
    return finest.unionByName(roll_up(finest, [t for t, s in TICK_TF_SECONDS.items() if s > 30]))


def fill_gaps(bars, seconds):
    """Repeat the previous bar's full candle in empty slots between two bars of
    the same symbol and day. Partitions are one symbol-day, at most 86400/seconds rows."""
    day = Window.partitionBy("symbol", F.to_date("open_time")).orderBy("open_time")
    until = F.coalesce(F.lead("open_time").over(day) - F.expr(f"INTERVAL {seconds} SECONDS"), F.col("open_time"))
    step = F.expr(f"INTERVAL {seconds} SECONDS")
    return (bars.withColumn("_until", until)
            .withColumn("_slot", F.explode(F.sequence("open_time", "_until", step)))
            .withColumn("filled", F.col("_slot") != F.col("open_time"))
            .drop("open_time", "_until").withColumnRenamed("_slot", "open_time"))
