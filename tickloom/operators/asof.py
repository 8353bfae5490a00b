"""Point-in-time joins: latest row at or before a time, and the last N bars.

A union with ``last(ignore nulls)`` would put a whole key into one task. Here both
sides are cut into (key, time block); inside a block the newest right row is found
with a window, and the newest row of all earlier blocks is carried over block
summaries, whose number depends on the time range only.
"""
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.constants import PATTERN_LIMITS
from tickloom.operators.sequence import SERIES, block_window, epoch, literal_map, rolling, tf_seconds, with_row_index
from tickloom.session import materialize

BLOCK = 4 * 3600  # span of the (key, time) blocks


def asof_join(left, right, keys, left_time, right_time, payload, tie=None, direction="backward", strict=False,
              width=BLOCK):
    """Left rows with the ``payload`` columns of the nearest right row per key.

    backward: newest right row with time <= the left time (< when ``strict``);
    forward: oldest right row with time > the left time. ``tie`` orders right rows
    of equal time. Left rows without a match keep nulls.
    """
    sign = -1 if direction == "forward" else 1
    strict = strict or direction == "forward"
    left_cols = left.columns
    row = F.struct(*left_cols)
    lt = sign * F.unix_micros(F.col(left_time))
    rt = sign * F.unix_micros(F.col(right_time))
    block = lambda t: F.floor(t / (width * 1000000)).cast("long")
    tie_col = F.col(tie).cast("string") if tie and dict(right.dtypes)[tie] == "string" else (
        F.col(tie).cast("long") if tie else F.lit(0).cast("long"))
    l = left.select(*keys, lt.alias("_t"), row.alias("_l")).withColumn("_b", block(F.col("_t")))
    r = right.select(*keys, rt.alias("_t"), tie_col.alias("_tie"), F.struct(*payload).alias("_r"))
    r = r.where(F.col("_t").isNotNull()).withColumn("_b", block(F.col("_t")))
    newest = r.groupBy(*keys, "_b").agg(F.max_by("_r", F.struct("_t", "_tie")).alias("_r"))
    blocks = newest.unionByName(l.select(*keys, "_b").distinct(), allowMissingColumns=True)
    blocks = blocks.groupBy(*keys, "_b").agg(F.first("_r", ignorenulls=True).alias("_r"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(*keys, "_b", F.last("_r", ignorenulls=True).over(earlier).alias("_carry"))
    both = l.withColumn("_side", F.lit(0 if strict else 1)).unionByName(
        r.withColumn("_side", F.lit(1 if strict else 0)), allowMissingColumns=True)
    inner = (Window.partitionBy(*keys, "_b").orderBy("_t", "_side", "_tie")
             .rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_hit", F.last("_r", ignorenulls=True).over(inner)).where(F.col("_l").isNotNull())
    joined = found.join(carry, [*keys, "_b"], "left").withColumn("_hit", F.coalesce("_hit", "_carry"))
    return joined.select("_l.*", *[F.col("_hit")[c].alias(c) for c in payload if c not in left_cols])


def last_bars(bars, limits, fields, name="candles"):
    """Every bar with the array of its last N bars, oldest first; N per timeframe.

    One window serves all timeframes although N differs: ordering by row index times
    (L / N), with L a common multiple of all N, makes "the last N rows" the same
    range, L - 1, everywhere.
    """
    common = math.lcm(*limits.values())
    stretch = literal_map({t: common // n for t, n in limits.items()})[F.col("timeframe")]
    frame = block_window(order=F.col("_rn") * stretch).rangeBetween(-(common - 1), 0)
    chosen = bars.where(F.col("timeframe").isin(*limits))
    return rolling(chosen, {name: F.collect_list(F.struct(*fields)).over(frame)}, halo=max(limits.values()) - 1)


#: Seconds of points that share one stretch of bars, and bars of a stored block.
CHUNK, STRETCH = 6 * 3600, 256


def contexts(points, bars, fields, limits=PATTERN_LIMITS, visible="open"):
    """For each (symbol, at) the last N bars of every timeframe at that time: the points with ``context``, an array of
    (timeframe, ref_time, candles) in the order of ``limits``; no bar yet: null ref_time and candles.

    ``visible='open'`` takes bars whose open time is not after ``at`` (the newest may still be forming); ``'closed'``
    only takes bars that had ended by then. Points are distinct.

    A point only looks up positions in its series. Bars are stored once, in blocks of ``STRETCH`` rows; the points of a
    time chunk get the stretch of blocks that they refer to, once, and each slices its candles from it by position. So
    bars that no point refers to are never collected, and nothing is shuffled once the candles are copied.
    """
    series = bars.where(F.col("timeframe").isin(*limits)).transform(with_row_index).select(*SERIES, "open_time", "_rn", F.struct(*fields).alias("_v"))
    series = materialize(series, "indexed")  # positions and candles are two reads
    opened = F.col("open_time") if visible == "open" else F.timestamp_seconds(F.unix_seconds("open_time") + tf_seconds())
    known = series.select(*SERIES, F.col("open_time").alias("ref_time"), "_rn", opened.alias("_known"))
    wanted = points.withColumn("timeframe", F.explode(F.array(*[F.lit(t) for t in limits])))
    found = asof_join(wanted, known, SERIES, "at", "_known", ["ref_time", "_rn"])
    place = F.struct("timeframe", F.struct("ref_time", "_rn").alias("v"))
    rows = found.groupBy(*points.columns, F.floor(epoch("at") / CHUNK).cast("long").alias("_chunk")).agg(
        F.map_from_entries(F.collect_list(place)).alias("_at"))
    rows = materialize(rows, "positions")  # stretches and slices are two reads
    n = literal_map(limits)[F.col("timeframe")]
    placed = rows.select("symbol", "_chunk", F.explode("_at").alias("timeframe", "_v")).select("symbol", "_chunk", "timeframe", "_v._rn")
    spans = placed.where(F.col("_rn").isNotNull()).groupBy(*SERIES, "_chunk").agg(
        F.greatest(F.min("_rn") - n + 1, F.lit(0)).alias("_base"), F.max("_rn").alias("_end"))
    block = lambda c: F.floor(F.col(c) / STRETCH).cast("long")
    needed = spans.withColumn("_blk", F.explode(F.sequence(block("_base"), block("_end"))))
    item = F.struct("_rn", "_v")
    blocks = series.groupBy(*SERIES, block("_rn").alias("_blk")).agg(F.sort_array(F.collect_list(item)).alias("_l"))
    blocks = blocks.select(*SERIES, "_blk", F.transform("_l", lambda x: x["_v"]).alias("_l"))
    cut = F.slice("_l", (F.greatest(F.col("_base") - F.col("_blk") * STRETCH, F.lit(0)) + 1).cast("int"), F.lit(STRETCH))
    pieces = needed.join(blocks, [*SERIES, "_blk"]).select(*SERIES, "_chunk", "_base", F.struct("_blk", cut.alias("_l")).alias("_p"))
    stretch = pieces.groupBy(*SERIES, "_chunk", "_base").agg(F.sort_array(F.collect_list("_p")).alias("_p"))
    entry = F.struct("timeframe", F.struct("_base", F.flatten(F.transform("_p", lambda x: x["_l"])).alias("_l")).alias("v"))
    stretch = stretch.groupBy("symbol", "_chunk").agg(F.map_from_entries(F.collect_list(entry)).alias("_bars"))
    rows = rows.join(stretch.withColumnsRenamed({"symbol": "_s", "_chunk": "_c"}),
                     F.col("symbol").eqNullSafe(F.col("_s")) & F.col("_chunk").eqNullSafe(F.col("_c")), "left")
    parts = []
    for tf, size in limits.items():
        at, held = F.try_element_at("_at", F.lit(tf)), F.try_element_at("_bars", F.lit(tf))
        first = F.greatest(at["_rn"] - (size - 1), F.lit(0))
        candles = F.slice(held["_l"], (first - held["_base"] + 1).cast("int"), (at["_rn"] - first + 1).cast("int"))
        parts.append(F.struct(F.lit(tf).alias("timeframe"), at["ref_time"].alias("ref_time"), candles.alias("candles")))
    return rows.select(*points.columns, F.array(*parts).alias("context"))


def context_at(points, bars, fields, limits=PATTERN_LIMITS, visible="open"):
    """``contexts`` as rows: points x timeframes, with ``ref_time`` and ``candles`` (null if none)."""
    rows = contexts(points, bars, fields, limits, visible)
    return rows.select(*[c for c in points.columns], F.explode("context").alias("_c")).select(*points.columns, "_c.*")


def latest_per_key(df, keys, time, tie=None, columns=None):
    """Newest row per key with a map-side combining aggregate (no window)."""
    columns = columns or [c for c in df.columns if c not in keys]
    order = F.struct(time, tie) if tie else F.col(time)
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_r")).select(*keys, "_r.*")


def top_n(df, n, keys=SERIES, time="open_time", newest=True):
    """Last N rows per key; ``n`` is a number or a column (limit per timeframe).

    row_number <= constant is pushed below the shuffle as a group limit, so each
    task sends at most that many rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc(time) if newest else F.asc(time))
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def last_per_timeframe(bars, limits):
    """Last N bars per series with N from a table of limits by timeframe.

    The largest N is a constant, so it becomes the group limit below the shuffle.
    """
    w = Window.partitionBy(*SERIES).orderBy(F.desc("open_time"))
    rows = bars.where(F.col("timeframe").isin(*limits)).withColumn("_k", F.row_number().over(w))
    return rows.where(F.col("_k") <= max(limits.values())).where(
        F.col("_k") <= literal_map(limits)[F.col("timeframe")]).drop("_k")
