"""Tick archive files: one symbol and day per file, LZMA streams of 20-byte records."""
import lzma

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import THREE_DECIMAL_SYMBOLS
from tickloom.functions.scalar import is_us_dst

# big-endian record: millisecond in the hour, ask, bid, ask volume, bid volume
RECORD = np.dtype([("ms", ">u4"), ("ask", ">u4"), ("bid", ">u4"), ("ask_volume", ">f4"), ("bid_volume", ">f4")])
#: Ticks of a file that are handed on at once.
ROWS = 20_000
TICKS = "symbol string, day date, seq long, ms long, ask_points long, bid_points long, ask_raw double, bid_raw double"


def _unpack(data):
    """All complete streams of a file; junk after the first good stream is ignored."""
    out = []
    while data:
        stream = lzma.LZMADecompressor(lzma.FORMAT_AUTO)
        try:
            out.append(stream.decompress(data))
        except lzma.LZMAError:
            if not out:
                raise
            break
        if not stream.eof:
            raise lzma.LZMAError("truncated stream")
        data = stream.unused_data
    return b"".join(out)


def _decode(batches):
    for batch in batches:
        for symbol, day, content in zip(batch["symbol"], batch["day"], batch["content"]):
            raw = _unpack(bytes(content))
            whole = np.frombuffer(raw, dtype=RECORD, count=len(raw) // RECORD.itemsize)
            for at in range(0, len(whole), ROWS):
                rec = whole[at:at + ROWS]
                yield pd.DataFrame({
                    "symbol": symbol, "day": day, "seq": np.arange(at, at + len(rec), dtype="int64"),
                    "ms": rec["ms"].astype("int64"), "ask_points": rec["ask"].astype("int64"),
                    "bid_points": rec["bid"].astype("int64"), "ask_raw": rec["ask_volume"].astype("float64"),
                    "bid_raw": rec["bid_volume"].astype("float64")})


def decode(files):
    """Ticks of archive files given as (symbol, day, content); one file per task call."""
    rows = files.where(F.length("content") > 0).mapInPandas(_decode, TICKS)
    point = F.when(F.lower("symbol").isin(THREE_DECIMAL_SYMBOLS), 1000.0).otherwise(100000.0)
    return add_hours(rows.select("symbol", "day", "seq", "ms", (F.col("ask_points") / point).alias("ask"),
                                 (F.col("bid_points") / point).alias("bid"),
                                 F.bround(F.col("ask_raw") * 1000000, 0).cast("long").alias("ask_volume"),
                                 F.bround(F.col("bid_raw") * 1000000, 0).cast("long").alias("bid_volume")))


def add_hours(ticks):
    """Absolute times: records only hold the position in the hour, so each time the
    minute wraps the next hour begins. Sundays and 1 January start in the evening.
    Frames cover one file (a symbol's day)."""
    w = Window.partitionBy("symbol", "day").orderBy("seq")
    minute = F.floor(F.col("ms") / 60000)
    evening = F.when(is_us_dst("day"), 21).otherwise(22)
    special = (F.dayofweek("day") == 1) | ((F.dayofmonth("day") == 1) & (F.month("day") == 1))
    start = F.when(special, evening).otherwise(0)
    seconds = F.unix_seconds(F.col("day").cast("timestamp")) + start * 3600
    out = ticks.withColumn("_m", minute).withColumn("_lag", F.lag("_m").over(w))
    out = out.withColumn("_w", F.sum(F.when(F.col("_lag") > F.col("_m"), 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("time", F.timestamp_millis((seconds + F.col("_w") * 3600) * 1000 + F.col("ms"))).drop(
        "_m", "_lag", "_w", "ms")


def read_archives(spark, path):
    """Archive files named <symbol>/<yyyy-mm-dd>.bi5."""
    name = F.regexp_extract("path", r"([^/]+)/(\d{4}-\d{2}-\d{2})\.bi5$", 1)
    day = F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})\.bi5$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bi5").option("recursiveFileLookup", True).load(path)
    return decode(files.select(name.alias("symbol"), F.to_date(day).alias("day"), "content"))


def trading_days(spark, start, end, today=None):
    """Days from start to end (inclusive) without Saturdays and without today."""
    today = F.lit(today).cast("date") if today is not None else F.current_date()
    days = (spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
            .where("a <= b").select(F.explode(F.sequence("a", "b")).alias("day")))
    return days.where((F.dayofweek("day") != 7) & (F.col("day") != today))
