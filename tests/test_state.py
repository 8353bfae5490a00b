"""Keyed state over long backlogs, the bar tail and the change log."""
import glob
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.constants import INDICATOR_COLUMNS
from tickloom.operators.indicators import stored_indicators
from tickloom.operators.outcome import forward_stats
from tickloom.plans import documents
from tickloom.sources import changelog
from tickloom.streaming import cycles, indicators, order, source
from tickloom.streaming.tail import BarTail

KEYS = ["symbol", "timeframe", "open_time"]
BARS = "symbol string, timeframe string, open_time timestamp, open_price double, high_price double, low_price double, close_price double, volume long"


def minute_bars(spark, n, symbol="HOT", start=0):
    i = F.col("id")
    price = 100 + 10 * F.sin(i / 7) + 3 * F.sin(i / 1.3) + (i % 17) / 10
    rows = spark.range(start, start + n).select(
        F.lit(symbol).alias("symbol"), F.lit("M1").alias("timeframe"), F.timestamp_seconds(1704067200 + i * 60).alias("open_time"), price.alias("open_price"),
        (price + 1 + (i % 3)).alias("high_price"), (price - 1 - (i % 4) / 2).alias("low_price"), (price + (i % 5) / 5 - 0.4).alias("close_price"), (10 + i % 9).alias("volume"))
    return rows


def feed(df, path, batches, shuffled=False):
    """Files of a feed, in time order or each with rows from everywhere."""
    part = F.pmod(F.xxhash64("open_time"), F.lit(batches)) if shuffled else F.floor((F.unix_seconds("open_time") - F.lit(1704067200)) / F.lit(60 * 4000 // batches))
    rows = df.withColumn("_p", part).toPandas()
    for _, piece in sorted(rows.groupby("_p"), key=lambda x: x[0]):
        df.sparkSession.createDataFrame(piece.drop(columns="_p"), df.schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


def run(stream, path):
    source.finish(source.to_table(stream, path))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def test_hot_backlog_goes_through_bounded_blocks(spark, tmp_path, monkeypatch):
    """One symbol, rows of all files in any order, nothing ready before the last batch: blocks stay small."""
    bars = minute_bars(spark, 4000)
    feed(bars, str(tmp_path / "in"), 6, shuffled=True)
    minute_bars(spark, 1, start=4000 + 4 * 1440).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = source.source(spark, "parquet", bars.schema, path=str(tmp_path / "in"), maxFilesPerTrigger=1)
    late = run(cycles.delayed_outcomes(stream, 3600, delay="3 days"), str(tmp_path / "outcomes"))
    want = forward_stats(bars, 3600).select("symbol", F.col("open_time").alias("snapshot_time"), "fwd_bars", "close_price", "fwd_high")
    both = late.join(want, ["symbol", "snapshot_time"])
    assert late.count() == 4000 - 60 == both.count()
    gain = F.round((F.col("fwd_high") - F.col("close_price")) / F.col("close_price") * 100, 4)
    assert both.where((F.col("later_bars") != F.col("fwd_bars")) | (F.abs(F.col("max_gain_pct_1h") - gain) > 1e-9)).count() == 0


def test_no_call_gets_more_than_a_block(tmp_path):
    """The processor alone, with a state that records what it holds."""
    class Held(dict):
        most = 0

        def containsKey(self, k):
            return k in self

        def getValue(self, k):
            return self[k]

        def updateValue(self, k, v):
            self[k] = v
            Held.most = max(Held.most, len(v[0]))

        def removeKey(self, k):
            del self[k]

    class One:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, v):
            self.value = v

    class Handle:
        timers = []

        def registerTimer(self, t):
            self.timers.append(t)

    p = indicators.LiveIndicators(1)
    p.handle, p.waiting, p.own = Handle(), Held(), One()
    n, start = 5000, pd.Timestamp("2024-01-01")
    frame = pd.DataFrame({"open_time": [start + pd.Timedelta(minutes=i) for i in range(n)], "high_price": 2.0, "low_price": 1.0, "close_price": 1.5, "volume": 1})
    for piece in (frame.sample(frac=1, random_state=k) for k in (1, 2)):
        list(p.handleInputRows(("HOT", "M1"), iter([piece[:2000], piece[2000:]]), None))
    assert Held.most <= 2 * order.BLOCK_ROWS and len(p.waiting) <= n // order.BLOCK_ROWS + 2

    class Now:
        def getCurrentWatermarkInMs(self):
            return int(start.value // 10 ** 6 + n * 60000)

    class Timer:
        def __init__(self, t):
            self.t = t

        def getExpiryTimeInMs(self):
            return self.t

    out = [f for t in sorted(set(Handle.timers)) for f in p.handleExpiredTimer(("HOT", "M1"), Now(), Timer(t))]
    assert sum(map(len, out)) == n and max(map(len, out)) <= order.BLOCK_ROWS and not p.waiting
    times = pd.concat(out)["open_time"]
    assert times.is_monotonic_increasing and times.is_unique


def test_stream_goes_on_from_a_stored_table(spark, tmp_path):
    old, new = minute_bars(spark, 3000), minute_bars(spark, 600, start=3000)
    feed(new, str(tmp_path / "in"), 12)
    stream = source.source(spark, "parquet", new.schema, path=str(tmp_path / "in"), maxFilesPerTrigger=2)
    live = run(indicators.live_indicators(stream, stored=old), str(tmp_path / "live"))
    want = stored_indicators(old.unionByName(new)).select(*KEYS, *[F.col(c).alias(f"_{c}") for c in INDICATOR_COLUMNS])
    both = live.join(want, KEYS)
    assert live.count() == both.count() == 600 and both.agg(F.min("n"), F.max("n")).first()[:] == (3001, 3600)
    for c in INDICATOR_COLUMNS:
        assert both.where(F.abs(F.col(c) - F.col(f"_{c}")) > 1e-7).count() == 0, c


def test_tail_gives_the_documents_of_the_whole_history(spark, small, tmp_path):
    path = str(tmp_path / "bars")
    small.bars.write.parquet(path)
    bars = spark.read.parquet(path)
    edges = bars.agg(F.percentile_approx(F.unix_seconds("open_time"), [0.5, 0.8])).first()[0]
    t = F.unix_seconds("open_time")
    tail = BarTail(str(tmp_path / "tail"), {"M1": 60, "M5": 30, "M15": 30, "H1": 20, "H4": 5, "D1": 7})
    tail.seed(bars.where(t <= edges[0]))
    tail.advance(bars.where((t > edges[0]) & (t <= edges[1])), 0)
    last = bars.where(t > edges[1])
    before = sorted(map(str, tail.advance(last, 1).collect()))
    read = tail.advance(last, 1)
    assert before == sorted(map(str, read.collect()))
    assert tail.versions(spark) == [0, 1]
    sizes = {r.timeframe: r.n for r in read.groupBy("symbol", "timeframe").count().groupBy("timeframe").agg(F.max("count").alias("n")).collect()}
    assert all(sizes[tf] <= n for tf, n in tail.rows.items() if tf in sizes)
    whole = documents.live_pattern(stored_indicators(bars)).orderBy("symbol").collect()
    made = documents.live_pattern(tail.with_indicators(read)).orderBy("symbol").collect()
    flat = lambda x: [flat(y) for y in x] if isinstance(x, (list, tuple)) else {k: flat(y) for k, y in sorted(x.items())} if isinstance(x, dict) else round(x, 7) if isinstance(x, float) else x
    assert [flat(r.asDict(True)) for r in whole] == [flat(r.asDict(True)) for r in made]
    recent = documents.live_pattern(documents.recent_with_indicators(bars)).orderBy("symbol").collect()
    assert [flat(r.asDict(True)) for r in whole] == [flat(r.asDict(True)) for r in recent]
    obv = read.join(stored_indicators(bars).select(*KEYS, F.col("obv").alias("_obv")), KEYS)
    assert obv.count() == read.count() and obv.where(F.abs(F.col("obv") - F.col("_obv")) > 1e-6).count() == 0


def test_batch_reads_the_tail_only(spark, tmp_path):
    old = minute_bars(spark, 20000)
    tail = BarTail(str(tmp_path / "tail"), {"M1": 60})
    tail.seed(old)
    assert tail.read(spark).count() == tail.rows["M1"] == 241 + 640
    new = minute_bars(spark, 5, start=20000)
    assert tail.advance(new, 7).count() == 881
    late = new.withColumn("close_price", F.col("close_price") + 1).unionByName(old.limit(1))
    got = tail.advance(late, 8)
    assert got.count() == 881 and got.join(late.select(*KEYS, F.col("close_price").alias("c")), KEYS).where("close_price = c").count() == 5


def test_change_log_is_merged_and_compacted(spark, tmp_path):
    path = str(tmp_path / "table")
    base = minute_bars(spark, 3000).withColumns({"spread": F.lit(0.1), "ingest_time": F.lit(0)})
    changelog.create(base, path)
    handle = changelog.merge_into(path)
    want = {r.open_time: [r.high_price, r.close_price] for r in base.collect()}
    for k in range(50):
        late = base.where(F.pmod(F.xxhash64("open_time", F.lit(k)), F.lit(40)) == 0).withColumns(
            {"high_price": F.col("high_price") + k % 5, "close_price": F.lit(float(k)), "ingest_time": F.lit(k + 1)}).repartition(6)
        for r in late.collect():
            want[r.open_time] = [max(want[r.open_time][0], r.high_price), float(k)]
        handle(late, k)
        if k % 7 == 0:
            handle(late, k)
        files = len(glob.glob(f"{path}/**/*.parquet", recursive=True))
        assert files <= 3 + changelog.COMPACT_AFTER
    got = changelog.read(spark, path).collect()
    assert len(got) == 3000 and all(want[r.open_time] == [r.high_price, r.close_price] for r in got)
    one = changelog.read(spark, path, where=F.col("day") == F.lit("2024-01-02").cast("date"))
    assert one.count() == 1440 and "PartitionFilters" in one._jdf.queryExecution().toString()


def test_change_log_without_a_base_and_without_anything(spark, tmp_path):
    with pytest.raises(ValueError):
        changelog.read(spark, str(tmp_path / "none"))
    path = str(tmp_path / "new")
    rows = minute_bars(spark, 50).withColumns({"spread": F.lit(0.1), "ingest_time": F.lit(0)})
    changelog.append(rows, path, 0)
    changelog.append(rows.limit(0), path, 1)
    assert changelog.read(spark, path).count() == 50
    changelog.compact(spark, path)
    changelog.compact(spark, path)
    assert changelog.read(spark, path).count() == 50 and changelog.batches(spark, path) == []
