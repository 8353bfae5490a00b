"""Files, merges and streams run in several batches."""
import lzma
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickloom.constants import INDICATOR_COLUMNS
from tickloom.operators.indicators import stored_indicators
from tickloom.sources import archive, changelog, readers, sinks
from tickloom.streaming import bars as sbars
from tickloom.streaming import cycles, indicators, source

KEYS = ["symbol", "timeframe", "open_time"]


def test_bar_files(spark, tmp_path):
    good = tmp_path / "eurusd-m1-bid-2020-01-01-2025-08-12.csv"
    good.write_text("timestamp,open,high,low,close\n1577836800999,1.1,1.2,1.0,1.15\n")
    (tmp_path / "notes.csv").write_text("a,b\n1,2\n")
    (tmp_path / "gbpusd-m5-bid-2020-2025.csv").write_text("time,open,high\n1,2,3\n")
    bad = {r.file_name: r.reason for r in readers.rejected_files(spark, str(tmp_path)).collect()}
    assert bad == {"notes.csv": "name", "gbpusd-m5-bid-2020-2025.csv": "columns"}
    row = readers.read_bar_files(spark, str(good)).first()
    assert (row.symbol, row.timeframe, row.volume) == ("EURUSD", "M1", 0) and str(row.open_time) == "2020-01-01 00:00:00"


def test_archive_files(spark, tmp_path):
    rec = np.zeros(4, dtype=archive.RECORD)
    rec["ms"] = [1000, 3599000, 500, 60000]
    rec["ask"], rec["bid"], rec["ask_volume"] = 1234567, 1234500, 1.5
    (tmp_path / "XAUUSD").mkdir()
    data = lzma.compress(rec[:2].tobytes(), lzma.FORMAT_ALONE) + lzma.compress(rec[2:].tobytes(), lzma.FORMAT_XZ) + b"junk"
    (tmp_path / "XAUUSD" / "2016-03-16.bi5").write_bytes(data)
    (tmp_path / "XAUUSD" / "2016-07-03.bi5").write_bytes(data)
    (tmp_path / "XAUUSD" / "2016-03-17.bi5").write_bytes(b"")
    rows = archive.read_archives(spark, str(tmp_path)).orderBy("time").collect()
    assert [str(r.time)[:19] for r in rows[:4]] == ["2016-03-16 00:00:01", "2016-03-16 00:59:59", "2016-03-16 01:00:00", "2016-03-16 01:01:00"]
    assert str(rows[4].time)[:13] == "2016-07-03 21" and rows[0].ask == 1234.567 and rows[0].ask_volume == 1500000


def test_update_is_idempotent(small):
    full = small.indicators
    holes = full.withColumns({c: F.when(F.col("volume") > 1, F.col(c)) for c in INDICATOR_COLUMNS})
    once = sinks.update(holes, full, only_incomplete=True)
    assert once.select(*full.columns).exceptAll(full).count() == 0
    assert sinks.update(once, full, only_incomplete=True).exceptAll(once).count() == 0


def test_upsert_and_partition_overwrite(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "symbol string, snapshot_time int, doc string")
    new = spark.createDataFrame([("b", 1, "z", 5), ("c", 1, "w", 6)], "symbol string, snapshot_time int, doc string, extra int")
    got = {r.symbol: (r.doc, r.extra) for r in sinks.upsert(old, new, extras=["extra"]).collect()}
    assert got == {"a": ("x", None), "b": ("z", 5), "c": ("w", 6)}
    late = {r.symbol: r.extra for r in sinks.upsert(old, new, extras=["extra"], extras_on_insert=False).collect()}
    assert late == {"a": None, "b": 5, "c": None}
    path = str(tmp_path / "t")
    old.write.partitionBy("symbol").parquet(path)
    sinks.overwrite_partitions(spark.read.parquet(path).where("symbol = 'b'").withColumn("doc", F.lit("q")), path, ["symbol"])
    assert {r.symbol: r.doc for r in spark.read.parquet(path).collect()} == {"a": "x", "b": "q"}


def feed_in_batches(df, path, parts, time_column):
    edges = df.agg(F.percentile_approx(F.unix_seconds(time_column), [i / parts for i in range(1, parts)])).first()[0]
    bounds = [None, *edges, None]
    t = F.unix_seconds(time_column)
    for a, b in zip(bounds, bounds[1:]):
        piece = df if a is None else df.where(t > a)
        (piece if b is None else piece.where(t <= b)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def run(stream, path):
    source.finish(source.to_table(stream, path))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def test_streams_over_many_batches_equal_batch(spark, small, tmp_path):
    ticks, bars = str(tmp_path / "ticks"), str(tmp_path / "bars")
    feed_in_batches(small.ticks, ticks, 4, "ts")
    stream = source.source(spark, "parquet", small.ticks.schema, path=ticks, maxFilesPerTrigger=1)
    made = run(sbars.closed_bars(stream, 900, "M15"), bars)
    batch = small.bars_of("M15").select(*made.columns)
    open_still = batch.exceptAll(made)
    newest = small.ticks.agg(F.max("ts")).first()[0]
    assert made.exceptAll(batch).count() == 0 and made.count() > 500
    assert open_still.where(F.unix_seconds("open_time") + 960 <= F.unix_seconds(F.lit(newest))).count() == 0

    feed = lambda: source.source(spark, "parquet", made.schema, path=bars, maxFilesPerTrigger=3)
    live = run(indicators.live_indicators(feed(), minimum=20, delay="10 days"), str(tmp_path / "live"))
    both = live.join(stored_indicators(made).select(*KEYS, *[F.col(c).alias(f"b_{c}") for c in ("atr", "adx", "rsi", "obv", "macd_signal")]), KEYS)
    # everything up to the watermark, from batches that split the commits of the feed
    ripe = made.groupBy("symbol").agg(F.sum(F.when(F.unix_seconds("open_time") <= edge(made, 10), 1).otherwise(0)).alias("n"))
    assert both.count() == live.count() == ripe.agg(F.sum(F.greatest(F.col("n") - 19, F.lit(0)))).first()[0] > 100
    for c in ("atr", "adx", "rsi", "obv", "macd_signal"):
        assert both.where(F.abs(F.col(c) - F.col(f"b_{c}")) > 1e-8).count() == 0

    late = run(cycles.delayed_outcomes(feed(), 7200, delay="10 days"), str(tmp_path / "outcomes"))
    from tickloom.operators.outcome import forward_stats
    stats = forward_stats(made, 7200).select("symbol", F.col("open_time").alias("snapshot_time"), "fwd_bars")
    assert late.count() > 100
    assert late.join(stats, ["symbol", "snapshot_time"]).where(F.col("later_bars") != F.col("fwd_bars")).count() == 0


def edge(bars, days):
    return F.lit(bars.agg(F.max(F.unix_seconds("open_time"))).first()[0] - days * 86400)


def test_alert_cooldown(spark, tmp_path):
    start = pd.Timestamp("2024-01-01")
    rows = [("stale", "A", "warning", start + pd.Timedelta(seconds=s)) for s in (0, 100, 299, 300, 599, 601, 90000)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["alert_type", "symbol", "severity", "timestamp"]))
    feed_in_batches(df, str(tmp_path / "alerts"), 2, "timestamp")
    got = run(cycles.sent_alerts(source.source(spark, "parquet", df.schema, path=str(tmp_path / "alerts"), maxFilesPerTrigger=1)), str(tmp_path / "sent"))
    assert sorted((r.timestamp - start).total_seconds() for r in got.collect()) == [0, 300, 601, 90000]


def test_late_bars_merge_twice(spark, small, tmp_path):
    path = str(tmp_path / "table")
    rows = small.bars_of("H4").select(*KEYS, "open_price", "high_price", "low_price", "close_price", "volume", "spread", F.lit(1).alias("ingest_time"))
    handle = changelog.merge_into(path)
    handle(rows, 0)
    late = rows.withColumns({"high_price": F.col("high_price") + 1, "ingest_time": F.lit(2)})
    handle(late, 1)
    handle(late, 1)
    got = changelog.read(spark, path)
    assert got.count() == rows.count() and got.where("ingest_time = 2").count() == rows.count()
